"""Language identification: nearest of several clustered TF-IDF n-gram centroids per language, by cosine.

A text becomes hashed counts of its letter 1- to 3-grams (runs of other characters count as one blank),
weighted log(1+count) * idf and normalised. Each language's training vectors are clustered on the sphere into
a few centroids; a text gets the language of the centroid with the largest cosine, which is the score.

All training rows are learned from, on Spark: the idf counts every row, the centroids every distinct text of a language. A hashed
`HELD`th of the texts is held back from clustering, as are the share `OUTLIERS` of the others that is farthest from the language's mean (texts
as far as the last one that stays, to 2**-20, stay too). Cosines grow with a text's length. So the held-back texts are cut to
each number of letters in `CUTS`, and a text is rejected if its cosine with the nearest centroid is below `SLACK` times the
quantile `LOW` of those (to `DIGITS` digits) of held-back texts nearest to it, cut to the largest number that the text reaches. Where they are fewer
than 1/`LOW`, those of its language count, and where these are too, those of all languages. Texts of fewer letters
than the first number, and all with a letter if nothing was held back, are not rejected.

A text is cut into n-grams once; its counts are kept in the shared folder, and every round of clustering reads them there. Sums of vectors are
added as whole numbers, so a model does not depend on how rows are dealt to tasks.

Defined cases: null texts and texts without a letter get `und`, score 0 and are rejected; so does every text if
there are no training rows. Rows with a null language are not learned from. Repeated rows are judged alike.
Equal cosines go to the alphabetically first language.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm import common

BUCKETS = 8192
CLUSTERS = 4
ROUNDS = 12
SLACK, LOW, HELD = 0.8, 0.02, 4
CUTS = (8, 16, 32)
OUTLIERS = 0.1
DIGITS = 5
#: Steps of a value in sums of vectors, and of a cosine where texts are ordered by it.
STEP = 2**-24
LEVEL = 2**-20
UNKNOWN = "und"


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


def counts(texts: list[str]) -> np.ndarray:
    """One row of hashed n-gram counts per text."""
    points, lengths = common.code_points([f"{text.lower()} " for text in texts])
    owner = np.repeat(np.arange(len(texts), dtype=np.int64), lengths)
    letter = _letters()[points]
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first blank after a letter stays
    symbol, owner = np.where(letter, points, 32)[keep].astype(np.uint32), owner[keep]
    found = []
    for order in (1, 2, 3):
        end = len(symbol) - order + 1
        if end <= 0:
            break
        mixed = np.full(end, order, dtype=np.uint32)
        for step in range(order):
            mixed = (mixed ^ symbol[step : step + end]) * np.uint32(0x9E3779B1)
            mixed ^= mixed >> np.uint32(15)
        cell = owner[:end] * BUCKETS + (mixed & np.uint32(BUCKETS - 1))
        whole = owner[:end] == owner[order - 1 :]
        if order == 1:
            whole = whole & (symbol != 32)
        found.append(cell[whole])
    cells = np.concatenate(found) if found else np.zeros(0, np.int64)
    return np.bincount(cells, minlength=len(texts) * BUCKETS).reshape(len(texts), BUCKETS)


def vectors(texts: list[str], idf: np.ndarray) -> np.ndarray:
    weighted = np.log1p(counts(texts).astype(np.float32)) * idf
    norm = np.sqrt((weighted * weighted).sum(axis=1, keepdims=True))
    return weighted / np.where(norm > 0, norm, 1)


def letters(texts: list[str]) -> np.ndarray:
    """How many letters each text has."""
    points, lengths = common.code_points(texts)
    before, end = np.concatenate([[0], np.cumsum(_letters()[points])]), np.cumsum(lengths)
    return before[end] - before[end - lengths]


def _cut(text: str) -> list[tuple[int, str]]:
    """The text up to its n-th letter for each n of `CUTS` that it has, with n's place there."""
    place = np.flatnonzero(_letters()[common.code_points([text])[0]])
    return [(k, text[: place[n - 1] + 1]) for k, n in enumerate(CUTS) if n <= len(place)]


def _clustered(rows: np.ndarray, clusters: int, rounds: int = ROUNDS) -> np.ndarray:
    """Spherical k-means from a farthest-first start, without the share `OUTLIERS` farthest from the mean."""
    near = rows @ rows.mean(axis=0)
    rows = rows[np.argsort(-near, kind="stable")[: math.ceil((1 - OUTLIERS) * len(rows))]]
    centres = [rows[0]]
    while len(centres) < min(clusters, len(rows)):
        centres.append(rows[int(np.argmin(np.max(rows @ np.array(centres).T, axis=1)))])
    centres = np.array(centres)
    for _ in range(rounds):
        nearest = np.argmax(rows @ centres.T, axis=1)
        for k in range(len(centres)):
            if (nearest == k).any():
                centre = rows[nearest == k].sum(axis=0)
                centres[k] = centre / max(np.linalg.norm(centre), 1e-12)
    return centres


def _limits(held: np.ndarray, centres: np.ndarray, languages: list[str]) -> list[float]:
    """Each centroid's rejection limit from the held-back texts cut to one length."""
    if not len(held):
        return [0.0] * len(languages)
    cosine = held @ centres.T
    nearest, largest, names = cosine.argmax(axis=1), cosine.max(axis=1), np.array(languages, dtype=object)
    limits = []
    for k, name in enumerate(languages):
        groups = [largest[nearest == k], largest[names[nearest] == name], largest]
        limits.append(SLACK * float(np.quantile(next((x for x in groups if len(x) * LOW >= 1), largest), LOW)))
    return limits


class Centroids:
    """The fitted model: idf, centroids, their languages and their rejection limits below and from each length of `CUTS`."""

    def __init__(self, idf, centres, languages, limits):
        self.idf, self.centres, self.languages, self.limits = idf, centres, languages, limits

    def judge(self, texts: list[str | None]) -> pd.DataFrame:
        texts = ["" if text is None else text for text in texts]
        out = pd.DataFrame({"lang_pred": [UNKNOWN] * len(texts), "score": 0.0, "rejected": True})
        if not len(self.languages):
            return out
        names = np.array(self.languages, dtype=object)
        for part in common.pieces(texts, 1_000_000):
            for start in range(part.start, part.stop, 256):
                some = slice(start, min(start + 256, part.stop))
                cosine = vectors(texts[some], self.idf) @ self.centres.T
                best = np.argmax(cosine, axis=1)
                score = np.clip(cosine[np.arange(len(best)), best].astype(float), 0, 1)
                n = letters(texts[some])
                known = n > 0
                out.loc[some.start : some.stop - 1, "lang_pred"] = np.where(known, names[best], UNKNOWN)
                out.loc[some.start : some.stop - 1, "score"] = np.where(known, score, 0.0)
                out.loc[some.start : some.stop - 1, "rejected"] = ~known | (score < self.limits[best, np.searchsorted(CUTS, n, "right")])
        return out


def fit(rows: DataFrame, text: str = "text", lang: str = "lang", sample: int | None = None) -> Centroids:
    """Learns from all rows, on Spark. For trials: the centroids from about `sample` distinct texts, dealt evenly to the languages, on the driver."""
    rows = common.columns(rows, text=text, lang=lang).filter("lang IS NOT NULL AND text IS NOT NULL")
    if sample is not None:
        return _fit_some(rows, sample)
    known = common.written(_counted(rows), "ngrams")
    # a language whose texts are all held back learns from them
    both = known.filter("cut < 0").select("held", F.explode("lang").alias("lang")).groupBy("lang").agg(F.min("held").alias("held")).collect()
    languages = sorted(r.lang for r in both)
    whole = {r.lang for r in both if r.held}
    idf = _idf(known)
    learner = _Clusters(known, idf, languages, whole)
    centres, owner = learner.clustered()
    names = [languages[i] for i in owner]
    centres = centres.astype(np.float32).reshape(-1, BUCKETS)
    limits = [[0.0] * len(names), *_held_limits(known.filter("cut >= 0"), idf, centres, names, whole)] if names else []
    return Centroids(idf, centres, names, np.array(limits).T)


def _counted(rows: DataFrame) -> DataFrame:
    """The n-gram counts of each distinct text and language, many texts a row, with how many rows have them (n). Held-back texts follow cut, once for each of `CUTS`."""
    draw, turned = F.xxhash64("text", "lang"), F.xxhash64("lang", "text")
    rows = rows.select("text", "lang", draw.alias("draw"), turned.alias("turned"), (F.pmod(turned, F.lit(HELD)) == 0).alias("held"))

    def cut(batches):
        for batch in batches:
            texts, held = batch.column("text").to_pylist(), batch.column("held").to_pylist()
            some = [(i, -1, x) for i, x in enumerate(texts)] + [(i, k, x) for i, own in enumerate(held) if own for k, x in _cut(texts[i])]
            for part in common.pieces([x for *_, x in some], 1_000_000):
                for start in range(part.start, part.stop, 256):
                    now = some[start : min(start + 256, part.stop)]
                    found = counts([x for *_, x in now])
                    owner, at = np.nonzero(found)
                    ends = np.searchsorted(owner, np.arange(1, len(now)))
                    at = [common.pack(np.diff(x, prepend=0).astype(np.uint16)) for x in np.split(at, ends)]
                    count = [common.pack(x.astype(np.uint32)) for x in np.split(found[found > 0], ends)]
                    own = pa.array([i for i, *_ in now])
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(c).take(own) for c in ("lang", "draw", "turned", "held")] + [pa.array([k for _, k, _ in now], pa.int32()), pa.array(at, pa.binary()), pa.array(count, pa.binary())],
                        ["lang", "draw", "turned", "held", "cut", "at", "count"],
                    )

    found = rows.mapInArrow(cut, "lang string, draw long, turned long, held boolean, cut int, at binary, count binary")
    found = found.groupBy("lang", "draw", "turned", "held", "cut").agg(F.first("at").alias("at"), F.first("count").alias("count"), F.count("*").alias("n"))

    def joined(batches):
        for batch in batches:
            kinds = np.where(batch.column("cut").to_numpy() < 0, -1 - batch.column("held").to_numpy(zero_copy_only=False), batch.column("cut").to_numpy())
            for kind in np.unique(kinds):
                own = np.flatnonzero(kinds == kind)
                for start in range(0, len(own), 256):
                    some = batch.take(pa.array(own[start : start + 256]))
                    at = [np.cumsum(common.unpack(x.as_buffer(), np.uint16), dtype=np.uint16) for x in some.column("at")]
                    count = np.concatenate([common.unpack(x.as_buffer(), np.uint32) for x in some.column("count")])
                    packed = (np.array([len(x) for x in at], np.int32), np.concatenate(at), count)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([bool(kind != -1)]), pa.array([max(-1, int(kind))], pa.int32())]
                        + [pa.ListArray.from_arrays([0, some.num_rows], some.column(c)) for c in ("lang", "draw", "n")]
                        + [pa.array([common.pack(x)], pa.binary()) for x in packed],
                        ["held", "cut", "lang", "draw", "n", "sizes", "at", "count"],
                    )

    return found.mapInArrow(joined, "held boolean, cut int, lang array<string>, draw array<long>, n array<long>, sizes binary, at binary, count binary")


def _idf(known: DataFrame) -> np.ndarray:
    """From all rows: every text counts as often as it occurs."""

    def seen(batches):
        total = np.zeros(BUCKETS + 1, dtype=np.int64)
        for batch in batches:
            for n, sizes, at in zip(batch.column("n"), batch.column("sizes"), batch.column("at"), strict=True):
                n = n.values.to_numpy()
                total[0] += n.sum()
                np.add.at(total, 1 + common.unpack(at.as_buffer(), np.uint16).astype(np.int64), np.repeat(n, common.unpack(sizes.as_buffer(), np.int32)))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, BUCKETS)), pa.array(total)], ["bucket", "n"])

    found = known.filter("cut < 0").select("n", "sizes", "at").mapInArrow(seen, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    by_bucket = {r.bucket: r.n for r in found.collect()}
    df = np.array([by_bucket.get(i, 0) for i in range(BUCKETS)], dtype=np.float64)
    return (np.log((1 + by_bucket.get(-1, 0)) / (1 + df)) + 1).astype(np.float32)


class Texts:
    """The vectors of one row of `_counted`, as places and values; `owner` is the text of each. Texts without a letter are left out."""

    def __init__(self, record: dict, idf: np.ndarray):
        sizes = common.unpack(record["sizes"].as_buffer(), np.int32)
        self.lang, self.draw = np.array(record["lang"].as_py(), dtype=object)[sizes > 0], record["draw"].values.to_numpy()[sizes > 0]
        self.at, count = common.unpack(record["at"].as_buffer(), np.uint16).astype(np.int64), common.unpack(record["count"].as_buffer(), np.uint32)
        self.owner = np.repeat(np.arange(len(self.lang)), sizes[sizes > 0])
        value = np.log1p(count.astype(np.float32)) * idf[self.at]
        norm = np.sqrt(np.bincount(self.owner, value.astype(np.float64) ** 2, len(self.lang)))
        self.value = value / norm[self.owner]

    def only(self, some: np.ndarray) -> Texts:
        out, keep = object.__new__(Texts), some[self.owner]
        out.lang, out.draw, out.at, out.value = self.lang[some], self.draw[some], self.at[keep], self.value[keep]
        out.owner = (np.cumsum(some) - 1)[self.owner[keep]]
        return out

    def dot(self, flat: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Each text's product with its `row` of a flat matrix; terms are added in order, whatever other texts there are."""
        return np.bincount(self.owner, self.value * flat[(row * BUCKETS)[self.owner] + self.at], len(self.lang))

    def dense(self) -> np.ndarray:
        out = np.zeros((len(self.lang), BUCKETS), dtype=np.float32)
        out[self.owner, self.at] = self.value
        return out


def _texts(batches, idf: np.ndarray):
    for batch in batches:
        for record in zip(*batch.columns, strict=True):
            yield Texts(dict(zip(batch.schema.names, record, strict=True)), idf)


class _Clusters:
    """Spherical k-means as `_clustered`, for all languages at once; each step is a pass over the counts of all their texts."""

    def __init__(self, known: DataFrame, idf: np.ndarray, languages: list[str], whole: set[str]):
        context = known.sparkSession.sparkContext
        self.idf, self.place = idf, {name: i for i, name in enumerate(languages)}
        self.learned = np.array([(name in whole) for name in languages], dtype=bool)
        # each task hands on the sums of all centroids, so there are as many as cores need and not more with more texts
        self.known = known.filter("cut < 0" if whole else "cut < 0 AND NOT held").coalesce(2 * context.defaultParallelism)

    def _mapped(self, function, schema: str) -> DataFrame:
        """What `function` makes of the texts that are learned from and the number of each one's language, chunk by chunk in a task."""
        idf, place, learned = self.idf, self.place, self.learned

        def passed(batches):
            def some():
                for batch in batches:
                    held = batch.column("held").to_pylist()
                    for own, texts in zip(held, _texts([batch], idf), strict=True):
                        lang = np.array([place[x] for x in texts.lang], dtype=np.int64)
                        if own:
                            use = learned[lang]
                            texts, lang = texts.only(use), lang[use]
                        if len(lang):
                            yield texts, lang

            yield from function(some())

        return self.known.mapInArrow(passed, schema)

    def _sums(self, groups: int, group) -> tuple[np.ndarray, np.ndarray]:
        """The sum of the vectors of each group and their number; `group` gives each text's number, or -1."""

        def added(chunks):
            total, n = {}, np.zeros(groups, dtype=np.int64)
            for texts, lang in chunks:
                own = group(texts, lang)
                n += np.bincount(own[own >= 0], minlength=groups)
                distinct, code = np.unique(own, return_inverse=True)
                sums = np.bincount(code[texts.owner] * BUCKETS + texts.at, np.rint(texts.value / STEP), len(distinct) * BUCKETS)
                for k, x in zip(distinct.tolist(), sums.astype(np.int64).reshape(-1, BUCKETS), strict=True):
                    if k >= 0:
                        total[k] = total.get(k, 0) + x
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.int64()), pa.array([common.pack(x) for x in total.values()], pa.binary()), pa.array([n[k] for k in total], pa.int64())], ["k", "total", "n"]
            )

        def merged(some: pd.DataFrame) -> pd.DataFrame:
            total = np.zeros(BUCKETS, dtype=np.int64)
            for x in some["total"]:
                total += common.unpack(x, np.int64)
            return pd.DataFrame({"k": some["k"].iloc[:1], "total": [common.pack(total)], "n": [some["n"].sum()]})

        schema = "k long, total binary, n long"
        out, n = np.zeros((groups, BUCKETS)), np.zeros(groups, dtype=np.int64)
        for r in self._mapped(added, schema).groupBy("k").applyInPandas(merged, schema).collect():
            out[r.k], n[r.k] = common.unpack(r.total, np.int64) * STEP, r.n
        return out, n

    def _least(self, mean: np.ndarray, stay: np.ndarray) -> np.ndarray:
        """The level of each language's nearness to its mean that `stay` texts reach: found among wide ranges of levels, then in one of them."""
        out, above = np.zeros(len(self.place), dtype=np.int64), np.zeros(len(self.place), dtype=np.int64)
        for width in (1 << 10, 1):

            def ranges(chunks, width=width):
                for texts, lang in chunks:
                    at = (np.floor(texts.dot(mean, lang) / LEVEL).astype(np.int64) - out[lang]) // width
                    some = (width > 1) | ((at >= 0) & (at < 1 << 10))
                    yield pa.RecordBatch.from_arrays([pa.array(lang[some]), pa.array(at[some])], ["lang", "at"])

            found = self._mapped(ranges, "lang long, at long").groupBy("lang", "at").agg(F.count("*").alias("n")).collect()
            begin = out.copy()
            done = set()
            for r in sorted(found, key=lambda r: -r["at"]):
                if r.lang not in done:
                    out[r.lang] = begin[r.lang] + r["at"] * width
                    if above[r.lang] + r.n >= stay[r.lang]:
                        done.add(r.lang)
                    else:
                        above[r.lang] += r.n
        return out

    def _first(self, value) -> dict[int, np.ndarray]:
        """Each language's vector of the least `value`; `value` gives infinity for texts that are left out."""

        def best(chunks):
            found = {}
            for texts, lang in chunks:
                score = value(texts, lang)
                for k in np.unique(lang[score < np.inf]):
                    mine = np.flatnonzero(lang == k)
                    i = mine[np.lexsort((texts.draw[mine], score[mine]))[0]]
                    own = texts.owner == i
                    found[k] = min(found.get(k, (np.inf,)), (float(score[i]), int(texts.draw[i]), texts.at[own].tolist(), texts.value[own].tolist()))
            rows = [(int(k), *x) for k, x in found.items()]
            yield pa.RecordBatch.from_pylist([dict(zip(("lang", "score", "draw", "at", "value"), x, strict=True)) for x in rows], pa.schema([
                ("lang", pa.int64()), ("score", pa.float64()), ("draw", pa.int64()), ("at", pa.list_(pa.int64())), ("value", pa.list_(pa.float64()))]))

        rows = self._mapped(best, "lang long, score double, draw long, at array<long>, value array<double>").collect()
        out = {}
        for r in sorted(rows, key=lambda r: (r.score, r.draw, r["at"]), reverse=True):
            out[r.lang] = np.bincount(r["at"], r.value, BUCKETS)
        return out

    def clustered(self) -> tuple[np.ndarray, list[int]]:
        """All centroids, and the number of each one's language."""
        languages = len(self.place)
        total, n = self._sums(languages, lambda texts, lang: lang)
        mean = (total / np.maximum(n, 1)[:, None]).ravel()
        stay = np.array([math.ceil((1 - OUTLIERS) * x) for x in n.tolist()])
        least = self._least(mean, stay)

        def near(texts, lang):
            return texts.dot(mean, lang)

        def stays(nearness, lang):
            return np.floor(nearness / LEVEL) >= least[lang]

        first = self._first(lambda texts, lang: -near(texts, lang))
        known = {k: [vector] for k, vector in first.items()}

        def cosines(centres, have):
            """Each text's products with the centroids of its language; fewer than all of them count as -1."""

            def found(texts, lang):
                return np.array([np.where(have[lang, k], texts.dot(centres[k], lang), -1.0) for k in range(len(centres))])

            return found

        def table(size):
            centres, have = np.zeros((size, languages * BUCKETS)), np.zeros((languages, size), dtype=bool)
            for lang, own in known.items():
                for k, vector in enumerate(own):
                    centres[k, lang * BUCKETS : (lang + 1) * BUCKETS], have[lang, k] = vector, True
            return centres, have

        for size in range(1, CLUSTERS):
            of = cosines(*table(size))
            more = self._first(lambda texts, lang, of=of: np.where(stays(near(texts, lang), lang) & (stay[lang] > size), of(texts, lang).max(axis=0), np.inf))
            for lang, vector in more.items():
                known[lang].append(vector)
        for _ in range(ROUNDS):
            centres, have = table(CLUSTERS)
            of = cosines(centres, have)
            total, n = self._sums(languages * CLUSTERS, lambda texts, lang, of=of: np.where(stays(near(texts, lang), lang), lang * CLUSTERS + of(texts, lang).argmax(axis=0), -1))
            same = True
            for lang, own in known.items():
                for k in range(len(own)):
                    if n[lang * CLUSTERS + k]:
                        centre = total[lang * CLUSTERS + k]
                        centre = centre / max(np.linalg.norm(centre), 1e-12)
                        same, own[k] = same and np.array_equal(own[k], centre), centre
            if same:
                break
        owner = [lang for lang in sorted(known) for _ in known[lang]]
        return np.array([vector for lang in sorted(known) for vector in known[lang]]), owner


def _held_limits(cut: DataFrame, idf: np.ndarray, centres: np.ndarray, names: list[str], whole: set[str]) -> list[list[float]]:
    """For each of `CUTS`, what `_limits` gives."""

    def judged(batches):
        for batch in batches:
            for k, texts in zip(batch.column("cut").to_pylist(), _texts([batch], idf), strict=True):
                texts = texts.only(np.array([x not in whole for x in texts.lang], dtype=bool))
                cosine = texts.dense() @ centres.T
                level = np.round(cosine.max(axis=1).astype(float), DIGITS)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(level), k, np.int32)), pa.array(cosine.argmax(axis=1)), pa.array(level)], ["cut", "centre", "level"])

    found = cut.mapInArrow(judged, "cut int, centre long, level double").groupBy("cut", "centre", "level").agg(F.count("*").alias("n"))
    # a text counts for its centroid, for its language and for all
    first = F.element_at(F.array(*[F.lit(names.index(name)) for name in names]), (F.col("centre") + 1).cast("int"))
    groups = F.array(F.concat(F.lit("centre "), F.col("centre")), F.concat(F.lit("language "), first), F.lit("all"))
    found = found.select("cut", F.explode(groups).alias("group"), "level", "n").groupBy("cut", "group").agg(F.sum("n").alias("n"), F.percentile("level", F.lit(LOW), F.col("n")).alias("low"))
    by_group = {(r.cut, r.group): r for r in found.collect()}

    def limit(k: int, centre: int) -> float:
        groups = [by_group.get((k, x)) for x in (f"centre {centre}", f"language {names.index(names[centre])}", "all")]
        own = next((r for r in groups if r is not None and r.n * LOW >= 1), groups[-1])
        return 0.0 if own is None else SLACK * own.low

    return [[limit(k, centre) for centre in range(len(names))] for k in range(len(CUTS))]


def _fit_some(rows: DataFrame, sample: int) -> Centroids:
    per_lang = {r.lang: r.n for r in rows.groupBy("lang").agg(F.approx_count_distinct(F.xxhash64("text")).alias("n")).collect()}

    def seen(batches):
        total, n = np.zeros(BUCKETS, dtype=np.int64), 0
        for batch in batches:
            texts = batch["text"].tolist()
            for part in common.pieces(texts, 1_000_000):
                for start in range(part.start, part.stop, 256):
                    some = counts(texts[start : min(start + 256, part.stop)])
                    total += (some > 0).sum(axis=0)
                    n += len(some)
        yield pd.DataFrame({"bucket": np.arange(-1, BUCKETS), "n": np.concatenate([[n], total])})

    found = rows.select("text").mapInPandas(seen, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    by_bucket = {r.bucket: r.n for r in found.collect()}
    total = by_bucket.get(-1, 0)
    df = np.array([by_bucket.get(i, 0) for i in range(BUCKETS)], dtype=np.float64)
    idf = (np.log((1 + total) / (1 + df)) + 1).astype(np.float32)

    share = max(1, sample // max(1, len(per_lang)))
    chance = F.lit(0.0)
    for name, n in per_lang.items():
        chance = F.when(F.col("lang") == name, F.lit(min(1.0, 1.25 * share / n))).otherwise(chance)
    draw = F.pmod(F.xxhash64("text", "lang"), F.lit(1 << 30)) / F.lit(float(1 << 30))

    def reduced(batches):
        for batch in batches:
            some = []
            for text, lang, draw, held in zip(batch["text"], batch["lang"], batch["draw"], batch["held"], strict=True):
                some += [(lang, draw, held, -1, text), *((lang, draw, held, k, x) for k, x in (_cut(text) if held else ()))]
            for start in range(0, len(some), 256):
                part = pd.DataFrame(some[start : start + 256], columns=["lang", "draw", "held", "cut", "text"])
                found = vectors(part.pop("text").tolist(), idf)
                part["at"] = [np.flatnonzero(row).astype("<i4").tobytes() for row in found]
                part["value"] = [row[row != 0].astype("<f4").tobytes() for row in found]
                yield part

    def dense(some: pd.DataFrame) -> np.ndarray:
        out = np.zeros((len(some), BUCKETS), dtype=np.float32)
        for row, (at, value) in enumerate(zip(some["at"], some["value"], strict=True)):
            out[row, np.frombuffer(at, dtype="<i4")] = np.frombuffer(value, dtype="<f4")
        return out[(out != 0).any(axis=1)]

    held = F.pmod(F.xxhash64("lang", "text"), F.lit(HELD)) == 0
    # copies count once; somewhat more texts are drawn than are used, as their number is not exact
    chosen = rows.filter(draw < chance).dropDuplicates(["lang", "text"]).withColumn("draw", draw).withColumn("held", held)
    chosen = chosen.mapInPandas(reduced, "lang string, draw double, held boolean, cut int, at binary, value binary").toPandas()
    chosen = chosen.sort_values(["draw", "cut", "at", "value"])
    centres, names, backs = [], [], []
    for name in sorted(per_lang):
        mine = chosen[chosen["lang"] == name]
        whole = mine[mine["cut"] < 0][:share]
        if whole["held"].all():
            fitted = dense(whole)
        else:
            fitted = dense(whole[~whole["held"]])
            backs.append(mine[(mine["cut"] >= 0) & mine["draw"].isin(whole["draw"])])
        if not len(fitted):
            continue
        found = _clustered(fitted, CLUSTERS)
        centres += list(found)
        names += [name] * len(found)
    centres = np.array(centres, dtype=np.float32).reshape(-1, BUCKETS)
    back = pd.concat([chosen[:0], *backs])
    limits = [[0.0] * len(names)] + [_limits(dense(back[back["cut"] == k]), centres, names) for k in range(len(CUTS))] if names else []
    return Centroids(idf, centres, names, np.array(limits).T)


def predict(rows: DataFrame, model: Centroids, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score and rejected for every row."""
    rows = common.columns(rows, doc_id=key, text=text)
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def judged(batches):
        for batch in batches:
            out = shared.value.judge(batch["text"].tolist())
            out.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield out

    schema = f"doc_id {common.kind(rows, 'doc_id')}, lang_pred string, score double, rejected boolean"
    return rows.mapInPandas(judged, schema)


def kept(rows: DataFrame, model: Centroids, text: str = "text") -> DataFrame:
    """The rows that are not rejected, with all their columns; all rows if no language was learnt, as nothing can be judged then."""
    if not len(model.languages):
        return rows
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def filtered(batches):
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(batch.schema.names.index(text)).to_pylist()
            yield batch.filter(pa.array(~shared.value.judge(texts)["rejected"].to_numpy(dtype=bool)))

    return rows.mapInArrow(filtered, rows.schema)

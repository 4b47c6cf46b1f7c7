"""Near-duplicate detection by Order MinHash.

A text is the sequence of its `SHINGLE`-word shingles (lower-cased words between white space), each labelled with how often it
occurred before in the text. For each of `SKETCHES` hash functions the `MINIMA` smallest labelled shingles, in
text order, form one key, so texts meet in a bucket if they share shingles in the same order. A second sketch estimates how alike two texts of
a bucket are: the least hash in each of `BINS` bins of one hash function (one permutation hashing). Pairs whose share of equal bins is
`DEVIATIONS` standard deviations or more below `SIMILARITY` are left; the deviation follows from the number of bins that either text fills. All others are candidates,
verified by alignment: common labelled shingles in the same order within a band of offsets, as a longest increasing
run, over all labelled shingles of both; `SIMILARITY` or more links two texts. Links make classes.

Equal texts are one from the start. Each text of a bucket is first verified against the bucket's shortest one. Buckets that still hold
several classes are gone through once: a task holds two blocks of a bucket, finds which texts have partners of another class that look alike, and verifies
those with the words at hand, the most alike first, joining classes as it goes. A pair is looked at only in the first bucket that it shares. So
no pairs are listed, only links between classes, and no bucket is capped: large ones are compared block against block.

Defined cases: null texts and texts without words are a class each. Texts of fewer than `SHINGLE` words have one
shingle. Equal rows are one class. A class is named by its smallest key, null if all are null.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from clickweave.llm import common

SHINGLE = 5
SKETCHES, MINIMA = 16, 3
SIMILARITY = 0.8
BINS = 128
DEVIATIONS = 3.0
BLOCK = 2048
WORDS = 1 << 20  # of a block's texts, about
SLICE = 250  # texts handled at once
BYTES = 1 << 19  # of word hashes in the pairs verified at once
FIRST = 4  # partners that a text is verified against at once; four times as many in each later step
ROWS = 4096
_FACTORS = np.random.default_rng(8).integers(1, 1 << 63, SKETCHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return common.hashed_words(pc.utf8_split_whitespace(pc.utf8_lower(common.plain_texts(texts))))


def shingles(words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Labelled shingles of all texts, and how many each has."""
    words = words.astype(np.uint64)
    n = np.where(sizes >= SHINGLE, sizes - SHINGLE + 1, np.minimum(sizes, 1))
    begin, at = np.cumsum(sizes) - sizes, np.cumsum(n) - n
    first = np.repeat(begin - at, n) + np.arange(n.sum())
    end = np.repeat(begin + sizes, n)
    padded = np.append(words, np.zeros(SHINGLE, np.uint64))
    value = np.zeros(len(first), dtype=np.uint64)
    for step in range(SHINGLE):
        value = common.mixed(value * np.uint64(0x9E3779B97F4A7C15) + np.where(first + step < end, padded[first + step], np.uint64(0)))
    owner = np.repeat(np.arange(len(sizes)), n)
    own = value ^ common.mixed(owner.astype(np.uint64) + np.uint64(1))
    order = np.argsort(own, kind="stable")
    new = np.append(True, np.diff(own[order].view(np.int64)) != 0)[: len(own)]
    start = np.flatnonzero(new)
    seen = np.empty(len(own), dtype=np.uint64)
    seen[order] = np.arange(len(own)) - np.repeat(start, np.diff(np.append(start, len(own))))
    return common.mixed(value + seen * np.uint64(0xC2B2AE3D27D4EB4F)), n


def sketches(labelled: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each text (with at least one shingle) its keys, and 16 bits of the least hash in each bin, 0 in empty ones."""
    start = np.cumsum(n) - n
    keys = np.zeros((len(n), SKETCHES), np.uint64)
    most = np.uint64(2**64 - 1)
    for k, factor in enumerate(_FACTORS):
        value = labelled * factor
        value ^= value >> np.uint64(32)
        places = np.full((len(n), MINIMA), len(labelled), dtype=np.int64)
        for j in range(MINIMA):
            least = np.minimum.reduceat(value, start)
            hits = np.flatnonzero((value == np.repeat(least, n)) & (value != most))
            place = np.append(hits, len(labelled))[np.searchsorted(hits, start)]
            place = np.where(place < start + n, place, len(labelled))
            value[hits] = most
            places[:, j] = place
        places.sort(axis=1)
        key = np.full(len(n), k, dtype=np.uint64)
        chosen = np.append(labelled, np.uint64(0))
        for j in range(MINIMA):
            key = common.mixed(key * np.uint64(0x9E3779B97F4A7C15) + chosen[places[:, j]])
        keys[:, k] = key
    return keys, _bins(labelled, n)


def _bins(labelled: np.ndarray, n: np.ndarray) -> np.ndarray:
    value = common.mixed(labelled + np.uint64(0x9E3779B97F4A7C15))
    slot = np.repeat(np.arange(len(n), dtype=np.uint64), n) * np.uint64(BINS) + value % np.uint64(BINS)
    # slot and hash in one number, so one sort finds each slot's least hash
    both = np.sort(slot << np.uint64(36) | value >> np.uint64(28))
    first = np.flatnonzero(np.append(True, np.diff(both >> np.uint64(36)) != 0)[: len(both)])
    bins = np.zeros(len(n) * BINS, np.uint16)
    bins[(both[first] >> np.uint64(36)).astype(np.int64)] = np.maximum(both[first] & np.uint64(0xFFFF), np.uint64(1)).astype(np.uint16)
    return bins.reshape(len(n), BINS)


def similarities(a: np.ndarray, size_a: np.ndarray, b: np.ndarray, size_b: np.ndarray, least: float = SIMILARITY) -> np.ndarray:
    """For each pair of texts, their labelled shingles one text after the other: the share of those that both hold in the
    same order over all of both; 0 if surely below `least`.

    Labelled shingles occur once per text, so the longest common subsequence is a longest increasing run of
    places. With `least` reached, at most (1 - least) / (1 + least) of both are unmatched, which bounds the offsets.
    """
    sizes = size_a + size_b
    owner_a, place_a = _places(size_a)
    owner_b, place_b = _places(size_b)
    both = np.concatenate([a ^ common.mixed(owner_a.astype(np.uint64) + np.uint64(1)), b ^ common.mixed(owner_b.astype(np.uint64) + np.uint64(1))])
    order = np.argsort(both)
    hits = np.flatnonzero(both[order[1:]] == both[order[:-1]])
    in_a = np.minimum(order[hits], order[hits + 1])
    in_b = np.maximum(order[hits], order[hits + 1]) - len(a)
    band = ((1 - least) / (1 + least) * sizes).astype(np.int64) + 1
    near = np.abs(place_a[in_a] - place_b[in_b]) <= band[owner_a[in_a]]
    in_a, in_b = in_a[near], in_b[near]
    order = np.argsort(in_a)
    owner, place = owner_a[in_a[order]], place_b[in_b[order]]
    run = np.bincount(owner, minlength=len(sizes))
    able = (np.minimum(size_a, size_b) >= least * np.maximum(size_a, size_b)) & (run >= least / (1 + least) * sizes - 1e-9)
    falls = (np.diff(owner) == 0) & (np.diff(place) < 0)
    crossed = np.bincount(owner[1:][falls], minlength=len(sizes)) > 0
    for pair in np.flatnonzero(able & crossed):
        tails: list[int] = []
        for spot in place[np.searchsorted(owner, pair) : np.searchsorted(owner, pair, "right")].tolist():
            k = bisect_left(tails, spot)
            tails[k : k + 1] = [spot]
        run[pair] = len(tails)
    return np.where(able, run / np.maximum(sizes - run, 1), 0.0)


def similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    return float(similarities(a, np.array([len(a)]), b, np.array([len(b)]), least)[0])


def _places(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of all items of some lists, one list after the other: the list and the place in it."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return owner, np.arange(len(owner)) - (np.cumsum(sizes) - sizes)[owner]


def _digests(words: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """16 bytes per word sequence."""
    begin = np.cumsum(sizes) - sizes
    place = np.arange(len(words)) - np.repeat(begin, sizes)
    has = sizes > 0
    parts = []
    for seed in (0x1234567, 0x89ABCDE):
        value = common.mixed(words.astype(np.uint64) + common.mixed(place.astype(np.uint64) * np.uint64(2 * seed + 1)))
        total = np.zeros(len(sizes), np.uint64)
        if has.any():
            total[has] = np.add.reduceat(value, begin[has])
        parts.append(common.mixed(total + sizes.astype(np.uint64)))
    return [x.tobytes() for x in np.ascontiguousarray(np.stack(parts, axis=1))]


def numbered(rows: DataFrame, text: str = "text") -> DataFrame:
    """All columns, then `__row`, a number, and `__text`, which equal texts share and texts without words do not."""

    def named(batches):
        row = TaskContext.get().partitionId() << 36
        for batch in (x.slice(at, SLICE) for x in batches for at in range(0, x.num_rows, SLICE)):
            texts = batch.column(batch.schema.names.index(text))
            number = np.arange(row, row + batch.num_rows)
            row += batch.num_rows
            words, sizes = word_hashes(texts)
            digests = [d if n else b"%d" % i for d, n, i in zip(_digests(words, sizes), sizes, number, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(number), pa.array(digests, pa.binary())], [*batch.schema.names, "__row", "__text"])

    return rows.mapInArrow(named, StructType([*rows.schema.fields, StructField("__row", LongType()), StructField("__text", BinaryType())]))


def _sketched(texts: DataFrame) -> DataFrame:
    """Each text with words as its digest, its shingles' number, keys and bins."""

    def made(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                words, sizes = word_hashes(batch.column(0).slice(at, SLICE))
                sizes = sizes[sizes > 0]
                labelled, n = shingles(words, sizes)
                keys, bins = sketches(labelled, n) if len(n) else (np.zeros((0, SKETCHES), np.uint64), np.zeros((0, BINS), np.uint16))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_digests(words, sizes), pa.binary()), pa.array(n.astype(np.int64)), pa.array(list(keys.view(np.int64)), pa.list_(pa.int64())), pa.array([x.tobytes() for x in bins], pa.binary())],
                    ["key", "n", "bands", "bins"],
                )

    return texts.mapInArrow(made, "key binary, n long, bands array<long>, bins binary")


def _streams(texts: DataFrame) -> DataFrame:
    """Each text's word hashes, three bytes a word: enough, as shingles of five are compared."""

    def made(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                words, sizes = word_hashes(batch.column(0).slice(at, SLICE))
                sizes = sizes[sizes > 0]
                low = np.ascontiguousarray((words & 0xFFFFFF).astype("<u4")).view(np.uint8).reshape(-1, 4)[:, :3]
                ends = np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_digests(words, sizes), pa.binary()), pa.array([low[e - n : e].tobytes() for e, n in zip(ends, sizes, strict=True)], pa.binary())], ["key", "words"]
                )

    return texts.mapInArrow(made, "key binary, words binary")


def _labelled(packed: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Labelled shingles of all texts, and how many each has; repeated texts are worked out once."""
    code, distinct = pd.factorize(packed)
    low = np.frombuffer(b"".join(distinct), dtype=np.uint8).reshape(-1, 3)
    words = np.pad(low, ((0, 0), (0, 1))).view("<u4").ravel().astype(np.int64)
    value, n = shingles(words, np.array([len(x) // 3 for x in distinct], dtype=np.int64))
    owner, place = _places(n[code])
    return value[(np.cumsum(n) - n)[code][owner] + place], n[code]


def alike(x: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The share of the bins which one text or the other fills that are equal, for each other one, and whether the pair is a candidate."""
    filled = np.count_nonzero((others > 0) | (x > 0), axis=1)
    share = np.count_nonzero((others == x) & (x > 0), axis=1) / np.maximum(filled, 1)
    return share, share >= SIMILARITY - DEVIATIONS * np.sqrt(SIMILARITY * (1 - SIMILARITY) / np.maximum(filled, 1))


def _near(size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    return np.minimum(size_a, size_b) >= SIMILARITY * np.maximum(size_a, size_b)


def _verified(pairs: DataFrame, streams: DataFrame) -> DataFrame:
    """a, b and whether they are linked."""
    first = pairs.join(streams.select(F.col("key").alias("a"), F.col("words").alias("left")), "a")
    both = first.join(streams.select(F.col("key").alias("b"), F.col("words").alias("right")), "b").select("a", "b", "left", "right")

    def tested(batches):
        for batch in batches:
            # some pairs at a time; a pair of long texts is one by itself
            slot = (batch["left"].str.len() + batch["right"].str.len()).cumsum() // BYTES
            linked = [similarities(*_labelled(some["left"]), *_labelled(some["right"])) >= SIMILARITY for _, some in batch.groupby(slot)]
            yield pd.DataFrame({"a": batch["a"], "b": batch["b"], "linked": np.concatenate(linked) if linked else []})

    return both.mapInPandas(tested, "a binary, b binary, linked boolean")


def components(links: DataFrame) -> DataFrame:
    """key and component of everything that `links` (a, b) name: the smallest key reached, by spreading minima and jumping."""
    both = common.written(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = common.written(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("key"), F.least("a", "b").alias("component")), "labels")
    while True:
        spread = both.join(labels, both["b"] == labels["key"]).select(both["a"].alias("key"), "component").union(labels).groupBy("key").agg(F.min("component").alias("component"))
        ahead = labels.select(F.col("key").alias("component"), F.col("component").alias("further"))
        after = spread.join(ahead, "component", "left").select("key", F.least("component", F.coalesce("further", "component")).alias("component"))
        after = common.written(after, "labels")
        if after.join(labels, ["key", "component"], "left_anti").isEmpty():
            return after
        labels = after


def _apart(texts: DataFrame, members: DataFrame, labels: DataFrame) -> DataFrame:
    """The buckets that hold several components, each as all pairs of its blocks, a block with itself included."""
    now = members.join(labels, "key", "left").select("band", "key", "n", F.coalesce("component", "key").alias("component"))
    open_bands = now.groupBy("band").agg(F.min("component").alias("least"), F.max("component").alias("most"), F.count("*").alias("members"), F.sum("n").alias("words")).filter("least <> most")
    rows = now.join(open_bands.select("band", "members", "words"), "band").join(texts.select("key", "bands", "bins"), "key")
    rows = rows.withColumn("blocks", F.ceil(F.greatest(F.col("members") / BLOCK, F.col("words") / WORDS))).withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    return rows.select("band", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "key", "component", "n", "bands", "bins")


class Blocks:
    """The rows of some pairs of blocks, pair after pair."""

    def __init__(self, rows: pd.DataFrame):
        self.rows = rows = rows.iloc[np.lexsort((rows["key"], rows["high"], rows["low"], rows["band"]))]
        cuts = np.flatnonzero(np.any([np.diff(rows[x].to_numpy()) != 0 for x in ("band", "low", "high")], axis=0)) + 1
        self.parts = list(zip([0, *cuts], [*cuts, len(rows)], strict=True))
        self.bins = np.frombuffer(b"".join(rows["bins"]), dtype=np.uint16).reshape(len(rows), BINS)
        self.bands = np.stack(rows["bands"].to_numpy()) if len(rows) else np.zeros((0, SKETCHES), np.int64)
        self.nth = (self.bands == rows["band"].to_numpy()[:, None]).argmax(axis=1)
        self.root, self.size, self.block = pd.factorize(rows["component"])[0], rows["n"].to_numpy(), rows["block"].to_numpy()
        self.across = (rows["low"] != rows["high"]).to_numpy()

    def partners(self, i: int, end: int) -> np.ndarray:
        """Rows behind `i` that look like it, of other components and in no earlier bucket with it, the most alike first."""
        rest = slice(i + 1, end)
        open_ = (self.root[rest] != self.root[i]) & _near(self.size[rest], self.size[i])
        if self.across[i]:
            open_ &= self.block[rest] != self.block[i]
        others = i + 1 + np.flatnonzero(open_)
        others = others[(self.bands[others] == self.bands[i]).argmax(axis=1) == self.nth[i]] if len(others) else others
        if not len(others):
            return others
        share, able = alike(self.bins[i], self.bins[others])
        return others[able][np.argsort(-share[able], kind="stable")]


def _with_partners(rows: DataFrame, members: int) -> DataFrame:
    """Those rows of pairs of blocks that have a partner to be verified."""

    def chosen(some: pd.DataFrame) -> pd.DataFrame:
        blocks = Blocks(some)
        has = np.zeros(len(some), dtype=bool)
        for start, end in blocks.parts:
            for i in range(start, end - 1):
                others = blocks.partners(i, end)
                has[others] = True
                has[i] |= len(others) > 0
        return blocks.rows[has].drop(columns="slot")

    # many small buckets share a call; a call gets about `ROWS` rows
    return _dealt(rows, max(1, members // ROWS)).groupBy("slot").applyInPandas(chosen, rows.schema)


def _dealt(rows: DataFrame, slots: int) -> DataFrame:
    return rows.withColumn("slot", F.pmod(F.xxhash64("band", "low", "high"), F.lit(slots)))


def _links(rows: DataFrame, streams: DataFrame) -> DataFrame:
    """a, b: links that join the components in every pair of blocks; fewer than its rows."""

    def linked(some: pd.DataFrame) -> pd.DataFrame:
        blocks = Blocks(some)
        labelled, sizes = _labelled(blocks.rows["words"])
        begin, keys, root, found = np.cumsum(sizes) - sizes, blocks.rows["key"].to_numpy(), blocks.root, []
        for start, end in blocks.parts:
            for i in range(start, end - 1):
                others, step = blocks.partners(i, end), FIRST
                own = labelled[begin[i] : begin[i] + sizes[i]]
                while len(others):
                    now, others = others[:step], others[step:]
                    step = max(FIRST, min(step * 4, BYTES // 8 // max(1, len(own))))
                    both = np.concatenate([labelled[begin[j] : begin[j] + sizes[j]] for j in now])
                    for j in now[similarities(np.tile(own, len(now)), np.full(len(now), len(own)), both, sizes[now]) >= SIMILARITY]:
                        if root[j] != root[i]:
                            found.append((keys[i], keys[j]))
                            root[start:end][root[start:end] == root[j]] = root[i]
                    others = others[root[others] != root[i]]
        return pd.DataFrame(found, columns=["a", "b"])

    words = rows.agg(F.sum("n")).first()[0] or 0
    both = _dealt(rows, max(1, int(words // WORDS))).join(streams, "key")
    return both.groupBy("slot").applyInPandas(linked, "a binary, b binary")


def classes(rows: DataFrame) -> DataFrame:
    """key and component for those of the texts (one column) that are linked to another one."""
    texts = common.written(_sketched(rows).groupBy("key").agg(F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("bins").alias("bins")), "sketches")
    exploded = texts.select("key", "n", F.explode("bands").alias("band"))
    shared = exploded.groupBy("band").agg(F.count("*").alias("members"), F.min(F.struct("n", "key")).alias("least")).filter("members > 1")
    members = common.written(exploded.join(shared, "band").select("band", "key", "n", F.col("least.key").alias("least"), F.col("least.n").alias("least_n")), "buckets")
    pairs = members.filter("key <> least AND least_n >= n * " + str(SIMILARITY)).select(F.col("key").alias("a"), F.col("least").alias("b")).distinct()
    side = texts.select("key", "bins")
    pairs = pairs.join(side.select(F.col("key").alias("a"), F.col("bins").alias("left")), "a").join(side.select(F.col("key").alias("b"), F.col("bins").alias("right")), "b")

    def look_alike(batches):
        for batch in batches:
            able = [_candidates(*pair) for pair in zip(batch["left"], batch["right"], strict=True)]
            yield batch.loc[np.array(able, dtype=bool), ["a", "b"]]

    pairs = common.written(pairs.mapInPandas(look_alike, "a binary, b binary"), "pairs")
    streams = common.written(_streams(rows).join(members.select("key").distinct(), "key", "left_semi").dropDuplicates(["key"]), "streams")
    tested = common.written(_verified(pairs, streams), "tested")
    labels = components(tested.filter("linked"))
    apart = common.written(_with_partners(_apart(texts, members, labels), members.count()), "apart")
    if apart.isEmpty():
        return labels
    links = common.written(_links(apart, streams), "links")
    return components(tested.filter("linked").select("a", "b").union(links))


def _candidates(left: bytes, right: bytes) -> bool:
    left, right = np.frombuffer(left, np.uint16), np.frombuffer(right, np.uint16)
    return bool(alike(left, right[None])[1][0])


def deduplicate(rows: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, class_id (the smallest doc_id of the class), n_docs (its rows) and kept (one row of each class) for every row."""
    labels = classes(common.columns(rows, text=text))
    named = numbered(common.columns(rows, doc_id=key, text=text))
    rows = named.drop("text")
    by_text = rows.groupBy("__text").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "__row")).alias("first"))
    by_text = by_text.join(labels, by_text["__text"] == labels["key"], "left").select("__text", "least", "n", "first", F.coalesce("component", "__text").alias("component"))
    by_class = by_text.groupBy("component").agg(F.min("least").alias("class_id"), F.sum("n").alias("n_docs"), F.min("first").alias("first"))
    known = by_text.select("__text", "component").join(by_class, "component").select("__text", "class_id", "n_docs", F.col("first.__row").alias("keep"))
    return rows.join(known, "__text").select("doc_id", "class_id", "n_docs", (F.col("__row") == F.col("keep")).alias("kept"))


def kept(rows: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each class, the one with the smallest key, with all its columns."""
    named = numbered(rows, text)
    own = named.select(F.col(f"`{key}`").alias("doc_id"), "__row", "__text")
    labels = classes(common.columns(rows, text=text))
    by_text = own.groupBy("__text").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "__row")).alias("first"))
    by_text = by_text.join(labels, by_text["__text"] == labels["key"], "left").select("first", F.coalesce("component", "__text").alias("component"))
    chosen = by_text.groupBy("component").agg(F.min("first").alias("first")).select(F.col("first.__row").alias("__row"))
    return named.join(chosen, "__row", "left_semi").drop("__row", "__text")

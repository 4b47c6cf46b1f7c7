"""Benchmark decontamination by winnowing.

A span of `span` words that a document shares with a benchmark item must be found. Of every `span` consecutive words the
k-gram with the smallest hash (the last one, if several) is kept as a fingerprint; both sides choose alike, so texts that share the
span share its fingerprint. Fingerprints of documents are joined with those of items, and each hit is extended: the spans around it are
compared word by word (by 63-bit hashes) with the items' spans.

- Items of fewer than `span` words are one span of their own; each such length is winnowed by itself, as a *tier*.
- A bitmap of the items' fingerprints, of a fixed size, keeps nearly all other fingerprints from being shuffled. It only
  spares work: what it lets through is joined exactly.
- Equal spans of several items are one row, and so are equal sets of items; documents and items are never paired. Both joins are
  salted, so a passage that a third of all documents share is spread out.

Defined cases: null, empty and wordless texts have no words and are clean; such items match nothing, and neither do items
without an id. Items of equal id count once. Repeated documents are judged each.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.llm import common, words

SPAN = 10
#: Bits of the bitmap of item fingerprints; its size does not depend on the benchmark.
BITS = 1 << 26
SALTS = 16
MOST_CHARS = 4_000_000
_SEED = np.random.default_rng(13).integers(1, 1 << 62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
HIT = "struct<tier int, hash long, place int, words array<long>>"


def gram(span: int) -> int:
    """Words in a fingerprint; `span - gram + 1` of them compete in each span."""
    return (span + 1) // 2


def winnow(hashed: np.ndarray, counts: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the fingerprints in the words of all texts, in order, and their hashes."""
    k = gram(span)
    n, compete = len(hashed) - k + 1, span - k + 1
    if len(hashed) < span:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    grams = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        grams += hashed[j : j + n].astype(np.uint64) * _SEED[j]
    grams = (common.mixed(grams + np.uint64(span)) >> np.uint64(1)).astype(np.int64)
    starts = len(hashed) - span + 1
    least, at = grams[:starts].copy(), np.zeros(starts, dtype=np.int64)
    for j in range(1, compete):
        better = grams[j : j + starts] <= least
        least[better], at[better] = grams[j : j + starts][better], j
    ends = np.cumsum(counts)
    inside = np.zeros(starts + 1, dtype=np.int64)  # +1 where a text's spans begin, -1 where they end
    begins, full = ends - counts, counts >= span
    np.add.at(inside, begins[full], 1)
    np.add.at(inside, (ends - span + 1)[full], -1)
    chosen = np.zeros(n, dtype=bool)
    whole = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
    chosen[whole + at[whole]] = True
    places = np.flatnonzero(chosen)
    return places, grams[places]


def around(hashed: np.ndarray, counts: np.ndarray, places: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """For each fingerprint, its text and the words from which every span that holds it can be read: `span - k` before it, `span` from it on.

    Places outside the text are 0.
    """
    ends = np.cumsum(counts)
    owner = np.searchsorted(ends, places, side="right")
    at = places[:, None] + np.arange(gram(span) - span, span)[None, :]
    inside = (at >= (ends - counts)[owner][:, None]) & (at < ends[owner][:, None])
    return owner, np.where(inside, hashed[np.clip(at, 0, max(0, len(hashed) - 1))], 0)


def _lists(flat: pa.Array, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), flat)


def _hits(hashed, counts, span, passes) -> list[tuple]:
    places, found = winnow(hashed, counts, span)
    kept = passes(found)
    places, found = places[kept], found[kept]
    owner, near = around(hashed, counts, places, span)
    return owner, np.full(len(places), span), found, places - (np.cumsum(counts) - counts)[owner], near


def _spans(hits: DataFrame, *keys: str) -> DataFrame:
    """The spans around each fingerprint: `start` in the text, `words`."""
    k = (F.col("tier") + 1).cast("int").bitwiseAND(-2) / 2
    before = (F.col("tier") - k).cast("int")
    spans = F.transform(
        F.sequence(F.lit(0), before),
        lambda d: F.struct((F.col("place") - before + d).alias("start"), F.slice("words", d + 1, F.col("tier")).alias("span")),
    )
    return hits.select(*keys, "tier", F.explode(spans).alias("found")).select(*keys, "tier", "found.start", "found.span").filter(
        ~F.array_contains("span", 0))


def _item_hits(items: DataFrame, span: int) -> DataFrame:
    """Fingerprints of items, each under its own tier, with the words around."""
    def found(batches):
        for batch in batches:
            for part in words.batches(batch.column(1), MOST_CHARS):
                texts = batch.slice(part.start, part.stop - part.start)
                hashed, counts = words.hashes(texts.column(1))
                owner_word = np.repeat(np.arange(len(counts)), counts)
                for tier in np.unique(np.minimum(counts, span)):
                    if not tier:
                        continue
                    mine = np.minimum(counts, span) == tier
                    own, near = np.flatnonzero(mine), hashed[mine[owner_word]]
                    owner, tiers, prints, places, context = _hits(near, counts[mine], int(tier), lambda x: np.ones(len(x), bool))
                    yield pa.RecordBatch.from_arrays([
                        texts.column(0).take(pa.array(own[owner])), pa.array(tiers, pa.int32()), pa.array(prints), pa.array(places, pa.int32()),
                        _lists(pa.array(context.ravel(), pa.int64()), np.full(len(places), context.shape[1])),
                    ], ["item_id", "tier", "hash", "place", "words"])

    return items.mapInArrow(found, "item_id string, tier int, hash long, place int, words array<long>")


def _bitmap(prints: DataFrame, bits: int) -> bytes:
    """The fingerprints' bitmap, compressed; at most `bits` / 64 rows reach the driver."""
    bit = F.col("hash").bitwiseAND(bits - 1)
    rows = prints.select(F.shiftright(bit, 6).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(63).cast("int")).alias("mask"))
    found = rows.groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    bitmap = np.zeros(bits // 64, dtype=np.int64)
    bitmap[found.column("word").to_numpy()] = found.column("mask").to_numpy()
    return zlib.compress(bitmap.tobytes(), 1)


def _document_hits(documents: DataFrame, tiers: list[int], bitmap: bytes, bits: int) -> DataFrame:
    """A row per document: its number of words, a digest of its text and the fingerprints that items may have too."""
    def found(batches):
        bitmap_of = np.frombuffer(zlib.decompress(bitmap), dtype=np.uint8)

        def passes(prints):
            at = prints & (bits - 1)
            return (bitmap_of[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0

        for batch in batches:
            for part in words.batches(batch.column(1), MOST_CHARS):
                texts = batch.slice(part.start, part.stop - part.start)
                hashed, counts = words.hashes(texts.column(1))
                hits = [_hits(hashed, counts, tier, passes) for tier in tiers]
                owner = np.concatenate([np.zeros(0, np.int64), *(h[0] for h in hits)])
                order = np.argsort(owner, kind="stable")
                sizes = np.concatenate([np.zeros(0, np.int64), *(np.full(len(h[0]), h[4].shape[1]) for h in hits)])
                near = _lists(pa.array(np.concatenate([np.zeros(0, np.int64), *(h[4].ravel() for h in hits)])), sizes)
                flat = pa.StructArray.from_arrays([
                    pa.array(np.concatenate([np.zeros(0, np.int64), *(h[1] for h in hits)]), pa.int32()),
                    pa.array(np.concatenate([np.zeros(0, np.int64), *(h[2] for h in hits)])),
                    pa.array(np.concatenate([np.zeros(0, np.int64), *(h[3] for h in hits)]), pa.int32()),
                    near,
                ], ["tier", "hash", "place", "words"]).take(pa.array(order))
                yield pa.RecordBatch.from_arrays(
                    [texts.column(0), pa.array(counts), texts.column(2), _lists(flat, np.bincount(owner, minlength=len(counts)))],
                    ["doc_id", "n_words", "digest", "hits"])

    keyed = documents.withColumn("digest", F.md5(F.coalesce("text", F.lit(""))))
    return keyed.mapInArrow(found, f"doc_id {common.kind(documents, 'doc_id')}, n_words long, digest string, hits array<{HIT}>")


def _salted(left: DataFrame, right: DataFrame, on: list[str], how: str, salt: Column) -> DataFrame:
    """A join whose keys on the large left side are spread over `SALTS` tasks each; the small right side is repeated."""
    repeated = right.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
    return left.withColumn("_salt", F.pmod(salt, F.lit(SALTS))).join(repeated, [*on, "_salt"], how).drop("_salt")


def _merged(found: Column) -> Column:
    """Overlapping or touching spans, sorted by start, as one."""
    span = "array<struct<start int, end int>>"

    def merge(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        joined = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))))
        return F.when((F.size(done) > 0) & (F.get(done, F.size(done) - 1)["end"] >= x["start"]), joined).otherwise(F.concat(done, F.array(x)))

    return F.aggregate(F.array_sort(found), F.array().cast(span), merge)


def contaminated(
    documents: DataFrame, items: DataFrame, span: int = SPAN, bits: int = BITS,
    key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """Each document's id, `n_words`, the merged `spans` of words (start, end) that items hold too, and the sorted `items`."""
    documents = common.columns(documents, doc_id=key, text=text)
    items = common.columns(items, item_id=item_key, text=item_text).filter("item_id IS NOT NULL").withColumn("item_id", F.col("item_id").cast("string"))
    prints = common.written(_item_hits(items, span), "item-fingerprints")
    tiers = sorted(row.tier for row in prints.select("tier").distinct().collect())  # at most `span` rows
    judged = common.written(_document_hits(documents, tiers, _bitmap(prints, bits), bits), "document-fingerprints")

    spans = (
        _spans(prints, "item_id").groupBy("tier", "span").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
        .withColumn("class", F.sha2(F.to_json("items"), 256))
    )
    hits = judged.filter(F.size("hits") > 0).select("doc_id", "digest", F.explode("hits").alias("hit")).select("doc_id", "digest", "hit.*")
    salt = F.xxhash64("doc_id", "digest", "place")
    joined = _salted(hits, prints.select("tier", "hash").distinct(), ["tier", "hash"], "left_semi", salt)
    salt = F.xxhash64("doc_id", "digest", "start")
    extended = _salted(_spans(joined, "doc_id", "digest"), spans.select("tier", "span", "class"), ["tier", "span"], "inner", salt)
    found = extended.groupBy("doc_id", "digest").agg(
        F.collect_set(F.struct("start", (F.col("start") + F.col("tier")).alias("end"))).alias("spans"),
        F.sort_array(F.collect_set("class")).alias("classes"),
    ).select("doc_id", "digest", _merged(F.col("spans")).alias("spans"), "classes", F.sha2(F.to_json("classes"), 256).alias("set"))

    sets = found.groupBy("set").agg(F.any_value("classes").alias("classes")).select("set", F.explode("classes").alias("class"))
    named = (
        sets.join(spans.groupBy("class").agg(F.any_value("items").alias("items")), "class")
        .select("set", F.explode("items").alias("item")).groupBy("set").agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    found = found.drop("classes").join(named, "set").drop("set").withColumnRenamed("doc_id", "_doc")
    same = F.col("_doc").eqNullSafe(F.col("doc_id")) & (F.col("_digest") == F.col("digest"))
    none = F.array().cast("array<struct<start int, end int>>")
    return judged.select("doc_id", "digest", "n_words").join(found.withColumnRenamed("digest", "_digest"), same, "left").select(
        "doc_id", "n_words", F.coalesce("spans", none).alias("spans"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def digest(found: DataFrame) -> DataFrame:
    """Counts and a hash of the item ids for what `contaminated` returns."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, x: total + x["end"] - x["start"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


#: The same in DuckDB.
ORACLE = f"""
WITH doc AS (SELECT doc_id, row_number() OVER () AS r, coalesce({words.SQL}, []) AS w FROM documents),
item AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {words.SQL} AS w FROM benchmark WHERE item_id IS NOT NULL),
item_span AS (
  SELECT DISTINCT item_id, least(len(w), {SPAN}) AS tier, array_to_string(w[s : s + least(len(w), {SPAN}) - 1], ' ') AS span
  FROM (SELECT *, unnest(generate_series(1, greatest(1, len(w) - {SPAN - 1}))) AS s FROM item WHERE len(w) > 0)
),
doc_span AS (
  SELECT r, tier, s, array_to_string(w[s : s + tier - 1], ' ') AS span
  FROM (SELECT r, w, tier, unnest(generate_series(1, len(w) - tier + 1)) AS s FROM doc, (SELECT DISTINCT tier FROM item_span))
),
hit AS (SELECT r, tier, s, item_id FROM doc_span JOIN item_span USING (tier, span)),
n_hit AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(generate_series(s, s + tier - 1)) AS place FROM hit) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT r, item_id FROM hit) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  n_hit IS NOT NULL AS contaminated
FROM doc LEFT JOIN n_hit USING (r) LEFT JOIN named USING (r)
"""

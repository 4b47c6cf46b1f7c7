"""Ranked lexical search over a length-stratified index.

A term t of a query adds w(t) * ((10^9 * tf) div (1000 * tf + 8 * m)) to a document's score; m depends on the document's length alone.
So documents of equal m form a *stratum*, and within one a term's impact depends on tf alone.

- `index` cuts the documents into shards of about `SHARD_CHARS` bytes of text, a row each. A shard's documents are ordered by length, its
  postings by (term, length, tf): runs of documents that share term, length and tf.
- `search` reads N, L and the document frequencies off the index, turns lengths into strata, and computes every run's impact once.
  For a query, the largest impacts of its terms add up to a bound for each stratum. Strata are visited in falling order of their
  bounds, until no bound left can reach the k-th best score.
- Every block of queries meets every shard; the best k of each shard are merged by Spark.

Terms are compared by 63 hash bits. All scores are exact integers.

Defined cases: null, empty and wordless texts have no terms and are never found. Repeated documents are ranked each. Documents
without an id rank behind equal scores with one. Rows of queries that share an id are one query; those without an id are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickweave.llm import common, words

SHARD_CHARS = 24_000_000
#: Queries in a block.
QUERIES = 256
#: Strata visited at first; each further step takes twice as many.
FIRST_VISIT = 16
#: Shards per merge in the first of two steps.
FAN_IN = 64


class Shard:
    """Postings of some documents as runs of equal (term, length, tf), and their search."""

    def __init__(self, lengths, terms, runs_of, stratum, tf, size, docs):
        """`lengths` per stratum; `terms` sorted with `runs_of` runs each; per run its stratum, tf and size; `docs` run after run."""
        self.lengths, self.terms, self.stratum, self.tf, self.size, self.docs = lengths, terms, stratum, tf, size, docs
        self.first = np.concatenate([[0], np.cumsum(runs_of)])
        self.begin = np.cumsum(size) - size

    @staticmethod
    def build(hashed: np.ndarray, counts: np.ndarray) -> tuple[Shard, np.ndarray]:
        """The shard of texts given by their terms, and the texts' places in its order (those with terms only)."""
        order = np.argsort(counts, kind="stable")
        order = order[counts[order] > 0]
        number = np.zeros(len(counts), dtype=np.int64)
        number[order] = np.arange(len(order))
        terms, codes = np.unique(hashed, return_inverse=True)
        pairs, tf = np.unique(codes.astype(np.int64) * max(1, len(order)) + np.repeat(number, counts), return_counts=True)
        term, doc = np.divmod(pairs, max(1, len(order)))
        lengths, stratum_of = np.unique(counts[order], return_inverse=True)
        stratum = stratum_of[doc] if len(doc) else np.zeros(0, np.int64)
        by = np.lexsort((doc, tf, stratum, term))
        term, stratum, tf, doc = term[by], stratum[by], tf[by], doc[by]
        new = np.ones(len(by), dtype=bool)
        new[1:] = (term[1:] != term[:-1]) | (stratum[1:] != stratum[:-1]) | (tf[1:] != tf[:-1])
        starts = np.flatnonzero(new)
        size = np.diff(np.concatenate([starts, [len(by)]]))
        return Shard(lengths, terms, np.bincount(term[starts], minlength=len(terms)), stratum[starts], tf[starts], size, doc), order

    def packed(self) -> tuple[bytes, ...]:
        """As bytes, in the order of `unpacked`."""
        sized = lambda x: common.pack(x.astype(np.int32))
        return (common.pack(self.lengths.astype(np.int64)), common.steps(self.terms), sized(np.diff(self.first)), sized(self.stratum),
                sized(self.tf), sized(self.size), sized(self.docs))

    @staticmethod
    def unpacked(lengths, terms, runs_of, stratum, tf, size, docs) -> Shard:
        plain = lambda x: common.unpack(x, np.int32).astype(np.int64)
        return Shard(common.unpack(lengths, np.int64), common.sums(terms), plain(runs_of), plain(stratum), plain(tf), plain(size),
                     common.unpack(docs, np.int32))

    def weigh(self, n_documents: int, n_terms: int) -> None:
        """Impacts of all runs, given the numbers of documents and terms in all shards."""
        m = np.array([10 + 90 * int(n) * n_documents // n_terms for n in self.lengths], dtype=np.int64)
        self.impact = 1_000_000_000 * self.tf // (1000 * self.tf + 8 * m[self.stratum])
        # the last run of a term in a stratum has its largest tf
        self.largest = np.ones(len(self.tf), dtype=bool)
        self.largest[:-1] = self.stratum[1:] != self.stratum[:-1]
        self.largest[self.first[1:-1] - 1] = True
        self.visited = 0

    def top(self, terms: np.ndarray, weights: np.ndarray, k: int, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The k best documents' numbers and scores; `ids` ranks the documents where scores are equal."""
        at = np.searchsorted(self.terms, terms)
        known = np.flatnonzero((at < len(self.terms)) & (self.terms[np.minimum(at, len(self.terms) - 1)] == terms)) if len(self.terms) else []
        none = np.zeros(0, np.int64)
        if not len(known):
            return none, none
        at, weights = at[known], weights[known]
        spans = self.first[at + 1] - self.first[at]
        runs = np.repeat(self.first[at] - (np.cumsum(spans) - spans), spans) + np.arange(spans.sum())
        stratum, gain = self.stratum[runs], np.repeat(weights, spans) * self.impact[runs]
        peak = self.largest[runs]
        # sums of integers below 2^53 are exact in doubles
        bound = np.bincount(stratum[peak], weights=gain[peak], minlength=len(self.lengths))
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        found, scores, least, step, start = none, np.zeros(0), 1.0, FIRST_VISIT, 0
        while start < len(order) and bound[order[start]] >= least:
            visit = np.zeros(len(self.lengths), dtype=bool)
            visit[order[start : start + step]] = True
            start, step = start + step, 2 * step
            mine = visit[stratum]
            size = self.size[runs[mine]]
            docs = self.docs[np.repeat(self.begin[runs[mine]] - (np.cumsum(size) - size), size) + np.arange(size.sum())]
            self.visited += len(docs)
            total = np.bincount(docs, weights=np.repeat(gain[mine], size))
            new = np.flatnonzero(total >= least)
            found, scores = np.concatenate([found, new]), np.concatenate([scores, total[new]])
            if len(found) > k:
                best = np.lexsort((ids[found], -scores))[:k]
                found, scores = found[best], scores[best]
            if len(found) == k:
                least = scores.min()
        best = np.lexsort((ids[found], -scores))[:k]
        return found[best], scores[best].astype(np.int64)


PARTS = ("lengths", "terms", "runs_of", "stratum", "tf", "size", "docs")


def index(documents: DataFrame, key: str = "doc_id", text: str = "text", shard_chars: int = SHARD_CHARS) -> DataFrame:
    """The index: a row per shard with its documents' ids, their number, the number of their terms, and the packed postings."""
    documents = common.columns(documents, doc_id=key, text=text)

    def built(batches):
        task, number = TaskContext.get().partitionId(), 0
        kept, size = [], 0

        def shard():
            nonlocal number, kept, size
            found, counts = (np.concatenate(x) for x in zip(*(x[1:] for x in kept), strict=True))
            made, order = Shard.build(found, counts)
            ids = pa.concat_arrays([x[0] for x in kept]).take(pa.array(order))
            row = [pa.array([(task << 32) + number]), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                   pa.array([len(order)], pa.int64()), pa.array([int(counts.sum())], pa.int64()),
                   *(pa.array([part], pa.binary()) for part in made.packed())]
            number, kept, size = number + 1, [], 0
            return pa.RecordBatch.from_arrays(row, ["shard", "ids", "n_documents", "n_terms", *PARTS])

        for batch in batches:
            for part in words.batches(batch.column(1), shard_chars // 4):
                ids, texts = (column.slice(part.start, part.stop - part.start) for column in batch.columns)
                kept.append((ids, *words.hashes(texts)))
                size += pa.compute.sum(pa.compute.binary_length(texts)).as_py() or 0
                if size >= shard_chars:
                    yield shard()
        if kept:
            yield shard()

    binary = ", ".join(f"{name} binary" for name in PARTS)
    return documents.mapInArrow(
        built, f"shard long, ids array<{common.kind(documents, 'doc_id')}>, n_documents long, n_terms long, {binary}")


def document_frequencies(indexed: DataFrame) -> DataFrame:
    """`term` (its hash) and `df` over all shards."""
    def counted(batches):
        for batch in batches:
            for row in batch.to_pylist():
                terms, runs_of, size = common.sums(row["terms"]), common.unpack(row["runs_of"], np.int32), common.unpack(row["size"], np.int32)
                starts = np.cumsum(runs_of, dtype=np.int64) - runs_of
                df = np.add.reduceat(size.astype(np.int64), starts) if len(terms) else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(terms), pa.array(df)], ["term", "n"])

    return (
        indexed.select("terms", "runs_of", "size").mapInArrow(counted, "term long, n long")
        .groupBy("term").agg(F.sum("n").alias("df"))
    )


def query_terms(queries: DataFrame) -> DataFrame:
    """Distinct `query_id`, `term`."""
    def found(batches):
        for batch in batches:
            for part in words.batches(batch.column(1), SHARD_CHARS // 4):
                ids, texts = (column.slice(part.start, part.stop - part.start) for column in batch.columns)
                hashed, counts = words.hashes(texts)
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(np.repeat(np.arange(len(counts)), counts))), pa.array(hashed)], ["query_id", "term"])

    return queries.mapInArrow(found, f"query_id {common.kind(queries, 'query_id')}, term long").distinct()


def search(
    documents: DataFrame, queries: DataFrame, k: int = 10, key: str = "doc_id", text: str = "text",
    query_key: str = "item_id", query_text: str = "text", shard_chars: int = SHARD_CHARS,
) -> DataFrame:
    """The k highest-scoring documents with a score above 0 for each query: `query_id, rank, doc_id, score`."""
    queries = common.columns(queries, query_id=query_key, text=query_text).filter("query_id IS NOT NULL")
    indexed = common.written(index(documents, key, text, shard_chars), "strata-index")
    total = indexed.agg(F.sum("n_documents").alias("n"), F.sum("n_terms").alias("terms"), F.count(F.lit(1)).alias("shards")).first()
    n_documents, n_terms, shards = total.n or 0, total.terms or 0, max(1, total.shards)
    kinds = common.kind(queries, "query_id"), indexed.schema["ids"].dataType.elementType.simpleString()

    rarity = F.floor(1000 * F.log((2 * F.lit(n_documents) + 2) / (2 * F.col("df") + 1))).cast("long")
    weighed = query_terms(queries).join(document_frequencies(indexed).withColumn("weight", rarity), "term")
    weighed = weighed.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("term", "weight"))).alias("found"))
    weighed = weighed.select("query_id", "found.term", "found.weight")
    weighed = common.written(weighed, "strata-queries")
    n_blocks = max(1, -(-weighed.count() // QUERIES))
    blocks = weighed.groupBy(F.pmod(F.xxhash64("query_id"), F.lit(n_blocks)).alias("block")).agg(
        F.collect_list(F.struct("query_id", "term", "weight")).alias("queries"))
    # every block of queries goes to every group of shards, a group's shards first
    blocks = blocks.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).withColumn("shard", F.lit(None).cast("long"))
    placed = indexed.withColumn("group", F.pmod(F.xxhash64("shard"), F.lit(shards)).cast("int"))
    dealt = placed.drop("n_documents", "n_terms").unionByName(blocks, allowMissingColumns=True)
    dealt = dealt.repartition("group").sortWithinPartitions("group", F.col("shard").asc_nulls_last(), "block")

    def searched(batches):
        here, held = None, []
        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(name)[at] for name in batch.schema.names}
                if row["group"].as_py() != here:
                    here, held = row["group"].as_py(), []
                if row["shard"].is_valid:
                    shard = Shard.unpacked(*(row[name].as_py() for name in PARTS))
                    shard.weigh(n_documents, n_terms)
                    ids = row["ids"].values
                    order = np.empty(len(ids), dtype=np.int64)
                    order[pa.compute.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(ids))
                    held.append((shard, ids, order, row["shard"].as_py()))
                    continue
                for query in row["queries"].values:
                    terms = query["term"].values.to_numpy(zero_copy_only=False)
                    weights = query["weight"].values.to_numpy(zero_copy_only=False)
                    for shard, ids, order, number in held:
                        found, scores = shard.top(terms, weights, k, order)
                        if len(found):
                            yield pa.RecordBatch.from_arrays([
                                pa.array([query["query_id"].as_py()] * len(found), batch.schema.field("queries").type.value_type.field("query_id").type),
                                pa.array([number] * len(found), pa.int64()), ids.take(pa.array(found)), pa.array(scores),
                            ], ["query_id", "shard", "doc_id", "score"])

    best = dealt.mapInArrow(searched, f"query_id {kinds[0]}, shard long, doc_id {kinds[1]}, score long")
    ranking = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    part = Window.partitionBy("query_id", F.pmod(F.xxhash64("shard"), F.lit(-(-shards // FAN_IN)))).orderBy(*ranking)
    best = best.withColumn("rank", F.row_number().over(part)).filter(F.col("rank") <= k)
    return (
        best.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*ranking))).filter(F.col("rank") <= k)
        .select("query_id", "rank", "doc_id", "score")
    )


#: The same in DuckDB.
ORACLE = f"""
WITH word AS (SELECT r, doc_id, unnest(w) AS term FROM (SELECT row_number() OVER () AS r, doc_id, {words.SQL} AS w FROM documents)),
tf AS (SELECT r, doc_id, term, count(*) AS tf FROM word GROUP BY ALL),
len AS (SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY r),
total AS (SELECT count(*) AS n_documents, CAST(sum(n) AS BIGINT) AS n_terms FROM len),
weight AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_documents + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, total GROUP BY term, n_documents
),
item AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({words.SQL}) AS term FROM benchmark WHERE item_id IS NOT NULL)),
scored AS (
  SELECT item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_documents) // n_terms)))) AS BIGINT) AS score
  FROM item JOIN tf USING (term) JOIN weight USING (term) JOIN len USING (r), total GROUP BY ALL
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10
"""

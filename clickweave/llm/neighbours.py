"""Approximate nearest neighbours as a block matrix join with int8 products.

Vectors are cut into blocks, and query blocks meet candidate blocks. In a tile, int8 products give approximate distances, and
the norms of the quantisation errors bound how far they are off. Pairs whose lower bound is above the k-th smallest
upper bound of their query are dropped; the others are recomputed in float64 from the original vectors, and each tile
keeps the k nearest of each query in a heap. The heaps are merged by query. No neighbour is lost, so recall is 1.

Blocks hold about `BLOCK` rows, dealt by row number. A tile's task holds one block of either side.

Defined cases: vectors that are null, all zero, hold null or non-finite components, or have not the most common
length take no part, as do null ids. Of repeated ids the alphabetically smallest vector counts. Ties go to the smaller id. Fewer
candidates than k: all are returned. A query's own id is not its neighbour.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from clickweave.llm import common

BLOCK = 4096


def usable(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id and vector (array<float> as given), one row per id."""
    rows = common.columns(vectors, vec_id=key, vector=vector).filter("vec_id IS NOT NULL AND vector IS NOT NULL AND size(vector) > 0")
    good = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    rows = rows.filter(good)
    usual = rows.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").limit(1)
    rows = rows.join(F.broadcast(usual), F.size("vector") == F.col("size"), "left_semi")
    return rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, their scales, and the norm of what quantisation lost."""
    scale = np.abs(x).max(axis=1) / 127
    scale = np.where(scale > 0, scale, 1)
    q = np.rint(x / scale[:, None]).astype(np.int8)
    return q, scale, np.sqrt(((x - q * scale[:, None]) ** 2).sum(axis=1))


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    total = np.zeros(len(a))
    for d in range(a.shape[1]):
        total += (a[:, d] - b[:, d]) ** 2
    return np.sqrt(total)


def tile(query_ids, queries, ids, vectors, k: int):
    """The k nearest of each query in this tile: lists of (query, id, distance)."""
    q, q_scale, q_lost = quantised(queries)
    c, c_scale, c_lost = quantised(vectors)
    q_norm, c_norm = ((x.astype(np.float64) ** 2).sum(1) * s**2 for x, s in ((q, q_scale), (c, c_scale)))
    out = []
    for i in range(0, len(q), 256):
        # float64 holds every int8 product sum exactly
        product = q[i : i + 256].astype(np.float64) @ c.astype(np.float64).T
        squared = q_norm[i : i + 256, None] + c_norm - 2 * product * q_scale[i : i + 256, None] * c_scale
        near = np.sqrt(np.maximum(squared, 0))
        off = (q_lost[i : i + 256, None] + c_lost) * (1 + 1e-9) + 1e-7 * (1 + near)
        own = query_ids[i : i + 256, None] == ids
        upper = np.where(own, np.inf, near + off)
        limit = np.partition(upper, k - 1, axis=1)[:, k - 1] if upper.shape[1] >= k else np.full(len(upper), np.inf)
        row, col = np.nonzero(~own & (near - off <= limit[:, None]))
        exact = _exact(queries[i + row], vectors[col])
        bounds = np.searchsorted(row, np.arange(len(upper) + 1))
        for r in range(len(upper)):
            some = slice(bounds[r], bounds[r + 1])
            out += [(query_ids[i + r], v, d) for d, v in heapq.nsmallest(k, zip(exact[some].tolist(), ids[col[some]].tolist(), strict=True))]
    return out


def _packed(rows: DataFrame, block: Column) -> DataFrame:
    return rows.select(block.alias("block"), "vec_id", "vector")


def search(vectors: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score. `is_query` is a condition on `vec_id`."""
    rows = common.written(usable(vectors, key, vector), "neighbours")
    kind = common.kind(rows, "vec_id")
    n, n_queries = rows.count(), rows.filter(is_query).count()
    blocks, query_blocks = max(1, -(-n // BLOCK)), max(1, -(-n_queries // BLOCK))
    deal = lambda m: F.pmod(F.xxhash64(F.col("vec_id")), F.lit(m)).cast("int")
    # every block of one side meets every block of the other: rows are copied once per block of the other side
    candidates = _packed(rows, deal(blocks)).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    queries = _packed(rows.filter(is_query), deal(query_blocks)).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def found(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        a, b = (np.array(x["vector"].tolist(), dtype=np.float64) for x in (left, right))
        best = tile(left["vec_id"].to_numpy(), a, right["vec_id"].to_numpy(), b, k)
        return pd.DataFrame(best, columns=["query_id", "vec_id", "score"])

    tiles = queries.select("vec_id", "vector", F.col("block").alias("qb"), F.col("other").alias("cb")).groupBy("qb", "cb").cogroup(
        candidates.select("vec_id", "vector", F.col("other").alias("qb"), F.col("block").alias("cb")).groupBy("qb", "cb")
    )
    heaps = tiles.applyInPandas(found, f"query_id {kind}, vec_id {kind}, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return heaps.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

"""Exact top-k search and nearest neighbours against every pair."""

from __future__ import annotations

import collections
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickweave.llm import neighbours, topk_search


def bm25(rows, wanted, k):
    counts = [(key, collections.Counter(text.lower().split())) for key, text in rows if key is not None and text is not None]
    counts = [(key, own) for key, own in counts if own]
    df = collections.Counter(term for _, own in counts for term in own)
    n = len(counts)
    mean = sum(sum(own.values()) for _, own in counts) / max(1, n)
    out = []
    queries = {}
    for key, text in sorted((r for r in rows if r[0] is not None and wanted(r[0]) and r[1] is not None), key=lambda r: r[1], reverse=True):
        queries[key] = text
    for query, text in queries.items():
        scores = []
        for key, own in counts:
            if key != query:
                length = sum(own.values())
                score = sum(
                    times * math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * own[t] * 2.2 / (own[t] + 1.2 * (0.25 + 0.75 * length / mean))
                    for t, times in collections.Counter(text.lower().split()).items() if t in own
                )
                if round(score, 6) > 0:
                    scores.append((-round(score, 6), key))
        out += [(query, rank, key, -score) for rank, (score, key) in enumerate(sorted(scores)[:k], 1)]
    return out


def check(frame, wanted, condition, k=10):
    expected = sorted(bm25([(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()], wanted, k))
    got = sorted(tuple(r) for r in topk_search.search(frame, condition, k).collect())
    assert [x[:3] for x in got] == [x[:3] for x in expected]
    assert all(abs(a[3] - b[3]) < 2e-6 for a, b in zip(got, expected, strict=True))


@pytest.mark.parametrize(("shard", "block"), [(16384, 128), (40, 8)])
def test_bm25(documents, monkeypatch, shard, block):
    monkeypatch.setattr(topk_search, "SHARD", shard)
    monkeypatch.setattr(topk_search, "BLOCK", block)
    check(documents, lambda i: i % 10 == 0, F.col("doc_id") % 10 == 0)


def test_bm25_awkward_rows(awkward):
    check(awkward, lambda i: i % 2 == 0, F.col("doc_id") % 2 == 0, 3)


def test_bm25_queries_without_rare_terms(spark):
    rows = [(i, "all of these words are frequent" + " these" * (i % 5)) for i in range(30)]
    check(spark.createDataFrame(rows, "doc_id long, text string"), lambda i: i % 10 == 0, F.col("doc_id") % 10 == 0)


def test_bm25_empty_table(empty):
    assert topk_search.search(empty, F.lit(True)).collect() == []


def nearest(rows, wanted, k):
    good = {}
    for key, vector in rows:
        if key is None or not vector or any(x is None or not math.isfinite(x) for x in vector) or not any(vector):
            continue
        good[key] = min(good.get(key, vector), vector)
    usual = collections.Counter(len(v) for v in good.values()).most_common(1)[0][0]
    good = {key: np.array(v, dtype=float) for key, v in good.items() if len(v) == usual}
    out = []
    for query in filter(wanted, good):
        near = sorted((math.sqrt(float(((good[query] - v) ** 2).sum())), key) for key, v in good.items() if key != query)
        out += [(query, rank, key, d) for rank, (d, key) in enumerate(near[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [4096, 60])
def test_neighbours(spark, monkeypatch, block):
    monkeypatch.setattr(neighbours, "BLOCK", block)
    frame = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    expected = nearest([(r.vec_id, r.embedding) for r in frame.collect()], lambda i: i % 10 == 0, 10)
    got = sorted(tuple(r) for r in neighbours.search(frame, F.col("vec_id") % 10 == 0).collect())
    assert [x[:3] for x in got] == [x[:3] for x in expected]
    assert all(math.isclose(a[3], b[3], rel_tol=1e-12) for a, b in zip(got, expected, strict=True))


def test_neighbours_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, []),
        (9, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (10, [3.0, 4.0]), (10, [2.0, 4.0]), (11, [1e6, -1e6]), (12, [1e-6, 1e-6]),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS score", "2 AS vector", "3 AS block")
    expected = nearest([(r.vec_id, r.embedding) for r in frame.collect()], lambda i: True, 3)
    got = sorted(tuple(r) for r in neighbours.search(frame, F.lit(True), 3).collect())
    assert [x[:3] for x in got] == [x[:3] for x in expected]
    assert neighbours.search(frame.limit(0), F.lit(True)).collect() == []


@pytest.mark.parametrize(("groups", "most"), [(6000, 1.0), (400, 0.5)])
def test_bm25_skips_postings(groups, most):
    """Texts of three topics, each drawn from one of `groups` texts with a few words changed; alike texts leave much to skip."""
    rng = np.random.default_rng(5)
    n = 6000
    drafts = [np.concatenate([rng.integers(0, 100, 20), 100 + 250 * (i % 3) + rng.zipf(1.3, 20) % 250]) for i in range(groups)]
    texts = [np.where(rng.random(40) < 0.1, rng.integers(0, 850, 40), drafts[i % groups]) for i in range(n)]
    sizes = np.array([len(x) for x in texts])
    terms, doc, term, count = topk_search._counted(np.concatenate(texts) + 2, sizes)
    shard = topk_search.Shard(np.arange(n), sizes, terms, doc, term, count, float(sizes.mean()))
    idf = topk_search.inverse_frequency(n, np.bincount(term, minlength=len(terms)))
    impact = count * (topk_search.K1 + 1) / (count + topk_search.K1)
    for query in range(0, n, 300):
        own = np.unique(texts[query] + 2)
        at = np.searchsorted(terms, own)
        weight = np.zeros(len(terms))
        weight[at] = idf[at]
        score = np.bincount(doc, impact * weight[term], minlength=n)
        score[query] = 0
        expected = sorted((-round(s, 6), i) for i, s in enumerate(score.tolist()))[:10]
        got = shard.search(query, own, idf[at], 10)
        assert [i for i, _ in got] == [i for _, i in expected]
        assert np.allclose([s for _, s in got], [-s for s, _ in expected], atol=2e-6)
    assert shard.read < most * shard.postings


def test_bm25_lists_of_frequent_terms(monkeypatch):
    """The rows are the same to the last digit however lists are stored and read; near copies leave three quarters of the postings unread."""
    rng = np.random.default_rng(5)
    n = 6000
    drafts = [np.concatenate([rng.integers(0, 100, 20), 100 + 250 * (i % 3) + rng.zipf(1.3, 20) % 250]) for i in range(400)]
    texts = [np.where(rng.random(40) < 0.1, rng.integers(0, 850, 40), drafts[i % 400]) for i in range(n)]
    sizes = np.array([len(x) for x in texts])
    terms, doc, term, count = topk_search._counted(np.concatenate(texts) + 2, sizes)
    idf = topk_search.inverse_frequency(n, np.bincount(term, minlength=len(terms)))

    def found(**settings):
        for name, value in settings.items():
            monkeypatch.setattr(topk_search, name, value)
        shard = topk_search.Shard(np.arange(n), sizes, terms, doc, term, count, float(sizes.mean()))
        queries = [(query, np.unique(texts[query] + 2)) for query in range(0, n, 100)]
        return [shard.search(query, own, idf[np.searchsorted(terms, own)], 10) for query, own in queries], shard.read / shard.postings

    rows, read = found()
    assert read < 0.3
    for settings in ({"FREQUENT": 0}, {"FREQUENT": 2, "PART": 1000}, {"FREQUENT": 0.02, "STEPS": 1}, {"BLOCK": 7}):
        assert found(**settings)[0] == rows


def test_bm25_scores_are_sums_in_doubles():
    """Scores that differ by little, near the end of single precision, keep their order."""
    n = 500
    sizes = np.full(n, 2)
    sizes[::50] = 3
    terms, doc, term, count = topk_search._counted(np.concatenate([[2, 3] if size == 2 else [2, 3, 4] for size in sizes]), sizes)
    shard = topk_search.Shard(np.arange(n), sizes, terms, doc, term, count, 1e5)
    norm = topk_search.K1 * (1 - topk_search.B + topk_search.B * sizes / 1e5)
    score = 1000.0 * (topk_search.K1 + 1) / (1 + norm) * 2
    expected = sorted((-round(s, 6), i) for i, s in enumerate(score.tolist()))[:20]
    assert [(-s, i) for i, s in shard.search(-1, np.array([2, 3]), np.array([1000.0, 1000.0]), 20)] == expected


@pytest.mark.parametrize(("partitions", "runs", "shards"), [(32, 4, 16), (211, 1, 4), (1, 40, 7), (300, 20, 100)])
def test_runs_are_dealt_evenly(spark, partitions, runs, shards):
    index = spark.range(partitions * runs).select((F.col("id") / runs).cast("int").alias("partition"), (F.col("id") % runs).cast("int").alias("run"))
    dealt = collections.Counter(r[0] for r in index.select(topk_search._shard(shards)).collect())
    assert set(dealt) == set(range(shards))
    assert max(dealt.values()) <= 1.3 * partitions * runs / shards + 1


def test_bm25_queries_searched_together(monkeypatch):
    """Searches give the same rows alone and together, by pieces and by whole lists; a known limit spares more of them."""
    rng = np.random.default_rng(5)
    n = 6000
    drafts = [np.concatenate([rng.integers(0, 100, 20), 100 + 250 * (i % 3) + rng.zipf(1.3, 20) % 250]) for i in range(n)]
    texts = [np.where(rng.random(40) < 0.1, rng.integers(0, 850, 40), x) for x in drafts]
    sizes = np.array([len(x) for x in texts])
    terms, doc, term, count = topk_search._counted(np.concatenate(texts) + 2, sizes)
    idf = topk_search.inverse_frequency(n, np.bincount(term, minlength=len(terms)))
    queries = [(query, own, idf[np.searchsorted(terms, own)]) for query in range(0, n, 40) for own in [np.unique(texts[query] + 2)]]
    queries += [(-1, np.array([1]), np.array([1.0])), (-2, np.zeros(0, np.int64), np.zeros(0))]
    shard = topk_search.Shard(np.arange(n), sizes, terms, doc, term, count, float(sizes.mean()))
    alone = [shard.search(*query, 10) for query in queries]
    assert alone[-2:] == [[], []] and all(len(x) == 10 for x in alone[:-2])
    least = np.array([x[4][1] if x else 0 for x in alone])
    for whole in (-1, 9):
        for together in (8, 64, 512):
            monkeypatch.setattr(topk_search, "WHOLE", whole)
            monkeypatch.setattr(topk_search, "TOGETHER", together)
            shard.read = shard.rare_read = 0
            shard.rare_postings = 1
            assert shard.search_all(queries, 10) == alone
            read, shard.read = shard.read, 0
            some = shard.search_all(queries, 10, least)
            assert [[x for x in own if x[1] >= y] for own, y in zip(some, least, strict=True)] == [[x for x in own if x[1] >= y] for own, y in zip(alone, least, strict=True)]
            assert shard.read < read


def test_bm25_later_shards_begin_with_a_limit(documents, monkeypatch):
    """Every score that a later shard is searched for is the k-th best of the first shards' documents."""
    monkeypatch.setattr(topk_search, "SHARD", 40)
    seen, real = [], topk_search.common.written
    monkeypatch.setattr(topk_search.common, "written", lambda frame, purpose: seen.append((purpose, real(frame, purpose))) or seen[-1][1])
    found = topk_search.search(documents, F.col("doc_id") % 10 == 0).collect()
    begun = dict(seen)["first"].collect()
    last, best = ({r.query_id: r.score for r in rows if r["rank"] == 10} for rows in (begun, found))
    assert last and all(best[query] >= score for query, score in last.items())

"""Ranked lexical search against scoring every document."""

from __future__ import annotations

import collections
import math
import random
import re

import numpy as np
import pytest

from clickweave.llm import strata_search, words

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return [re.sub("[A-Z]", lambda c: c[0].lower(), term) for term in TERM.findall(text or "")]


def brute(documents, items, k=10):
    docs = [(doc, collections.Counter(terms_of(text))) for doc, text in documents]
    docs = [(doc, own, sum(own.values())) for doc, own in docs if own]
    df = collections.Counter(term for _, own, _ in docs for term in own)
    n_documents, n_terms = len(docs), sum(n for _, _, n in docs)
    queries = collections.defaultdict(set)
    for item, text in items:
        if item is not None:
            queries[item].update(terms_of(text))
    found = []
    for item, own_terms in queries.items():
        scores = []
        for doc, own, n in docs:
            m = 10 + 90 * n * n_documents // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_documents + 2) / (2 * df[t] + 1))) * (10**9 * own[t] // (1000 * own[t] + 8 * m)) for t in own_terms if t in own)
            if score > 0:
                scores.append((-score, doc is None, doc))
        found += [(item, rank, doc, -score) for rank, (score, _, doc) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(found, key=str)


def check(documents, items, k=10, **options):
    expected = brute([(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()], [(r.item_id, r.text) for r in items.select("item_id", "text").collect()], k)
    got = strata_search.search(documents, items, k, **options).collect()
    assert sorted((tuple(r) for r in got), key=str) == expected
    return expected


@pytest.fixture
def items(spark):
    return spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")


@pytest.mark.parametrize("options", [{}, {"shard_chars": 4000}])
def test_documents(documents, items, options, monkeypatch):
    monkeypatch.setattr(strata_search, "QUERIES", 7)  # several blocks
    monkeypatch.setattr(strata_search, "FIRST_VISIT", 2)
    assert len(check(documents, items, **options)) > 100


def test_ties_and_repeated_rows(spark):
    rows = [(i % 30, "The cat sat" if i % 2 else "a CAT; sat, the") for i in range(60)] + [(None, "the cat sat")]
    check(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1, "cat sat"), (1, "cat the"), (2, None), (None, "cat")], "item_id long, text string"))


def test_awkward_rows(awkward, empty, spark):
    awkward = awkward.withColumnRenamed("score", "rank")
    items = spark.createDataFrame([("x", "the same words", 1), ("y", "", 2), ("z", "日本語のテキスト 🙂 ß É wordx 123", 3)], "item_id string, text string, doc_id int")
    assert check(awkward, items)
    assert strata_search.search(empty, items).collect() == []
    assert strata_search.search(awkward, items.limit(0)).collect() == []


def test_words_are_those_of_the_pattern():
    import pyarrow as pa

    rng = random.Random(12)
    texts = ["".join(chr(rng.choice([rng.randrange(128), rng.randrange(0x80, 0x250), 0x1F642, 32])) for _ in range(30)) for _ in range(300)] + [None, ""]
    for batch in (pa.array(texts), pa.array(texts).slice(7, 100), pa.array(texts, pa.large_string())):
        assert [[w for w in found if w] for found in words.split(batch).to_pylist()] == [terms_of(text) for text in batch.to_pylist()]


def test_strata_that_cannot_reach_the_best_are_not_visited(spark):
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{x}" for x in rng.zipf(1.3, size=5 + 3 * i % 997) if x < 5000) for i in range(3000)]
    import pyarrow as pa

    shard, _ = strata_search.Shard.build(*words.hashes(pa.array(texts)))
    shard.weigh(3000, sum(len(terms_of(t)) for t in texts))
    asked, _ = words.hashes(pa.array(["w1 w70 w300"]))
    shard.top(np.unique(asked), np.array([10, 3000, 5000]), 10, np.arange(3000))
    postings = sum(shard.size[shard.first[i] : shard.first[i + 1]].sum() for i in np.searchsorted(shard.terms, np.unique(asked)))
    assert 0 < shard.visited < postings / 2

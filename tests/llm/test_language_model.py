"""The trie against plain search, and scores against a model counted text by text."""

from __future__ import annotations

import collections
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from clickweave.llm import language_model as lm


@pytest.mark.parametrize(("n", "top"), [(0, 10), (1, 5), (1000, 10**12), (5000, 6000), (3000, 2**61)])
def test_elias_fano_gives_back_and_finds(n, top):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, top, n))
    sequence = lm.EliasFano(values)
    assert (sequence.get(np.arange(n)) == values).all()
    wanted = np.concatenate([values, rng.integers(0, top, 500)])
    assert (sequence.successor(wanted) == np.searchsorted(values, wanted)).all()


def test_trie_finds_pairs_also_when_mapped(tmp_path):
    rng = np.random.default_rng(1)
    pairs = sorted({(int(a), int(b)) for a, b in zip(rng.integers(0, 50, 2000), rng.integers(0, 1 << 40, 2000), strict=True)})
    context, follower = (np.array(x, dtype=np.int64) for x in zip(*pairs, strict=True))
    count = rng.integers(1, 100_000, len(pairs))
    trie = lm.Trie(context, follower, count)
    trie.save(str(tmp_path / "trie"))
    for one in (trie, lm.Trie.load(str(tmp_path / "trie"))):
        codes, followers = one.find(context, follower)
        assert np.allclose(lm.restored(codes), count - lm.DISCOUNT, rtol=1e-3)
        assert (followers == np.bincount(context)[context]).all()
        codes, followers = one.find(np.array([3, 70]), np.array([5, 5]))
        assert codes.tolist() == [0, 0] and followers[1] == 0


def brute(rows, folds=10):
    def words(text):
        lowered = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
        return [*re.findall("[^\x20\x09-\x0d]+", lowered), "\0end"]

    unigrams, bigrams, followers = collections.Counter(), collections.Counter(), collections.Counter()
    for key, text in rows:
        if zlib.crc32(("" if key is None else str(key)).encode()) % folds:
            own = words(text)
            unigrams.update(own)
            unigrams["\0start"] += 1
            bigrams.update(zip(["\0start", *own], own))
    for first, _ in bigrams:
        followers[first] += 1
    total = sum(n for word, n in unigrams.items() if word != "\0start")
    distinct = len(unigrams) - ("\0start" in unigrams)
    out = []
    for key, text in rows:
        own = words(text)
        base = [(unigrams[w] + 0.1) / (total + 0.1 * (distinct + 1)) for w in own]
        score = 0.0
        for v, w, p in zip(["\0start", *own], own, base):
            c = unigrams[v]
            score += math.log10(max(bigrams[v, w] - 0.75, 0) / c + 0.75 * followers[v] / c * p if c else p)
        held = zlib.crc32(("" if key is None else str(key)).encode()) % folds == 0
        out.append((key, held, len(own), sum(unigrams[w] > 0 for w in own), total, sum(map(math.log10, base)), score))
    return out


def compare(frame, chars):
    order = lambda r: (r[0] is None, r[0] or 0, r[5])
    found = sorted((tuple(r) for r in lm.score(frame, chars=chars).collect()), key=order)
    expected = sorted(brute([(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]), key=order)
    assert len(found) == len(expected)
    for a, b in zip(found, expected, strict=True):
        assert a[:5] == b[:5]
        assert math.isclose(a[5], b[5], rel_tol=1e-9, abs_tol=1e-9)
        assert abs(a[6] - b[6]) <= 1e-3 * a[2]


@pytest.mark.parametrize("chars", [lm.BLOCK_CHARS, 40_000])
def test_scores_equal_a_plain_count(documents, chars):
    compare(documents, chars)


def test_awkward_rows(awkward):
    compare(awkward, 1000)


def test_empty_table(empty):
    assert lm.score(empty).collect() == []


def test_model_beats_its_base_on_held_out_texts(documents):
    rows = lm.score(documents).filter("held_out").agg({"score": "sum", "base_score": "sum"}).first()
    assert rows["sum(score)"] > rows["sum(base_score)"]


def test_hot_contexts_are_counted_without_collecting_texts(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    monkeypatch.setattr(DataFrame, "toPandas", lambda self: pytest.fail("texts are collected"))
    rows = spark.range(400).selectExpr("id AS doc_id", "concat('often ', repeat(concat('w', id, ' '), 3), if(id < 133, ' copied', '')) AS text")
    hot = set(lm._hot_contexts(rows).tolist())
    known = lambda word: int(lm.hashed(pa.array([word]))[0][0] >> 63 - lm.PAIR_BITS)
    assert {known("often"), known("copied"), 0} <= hot and known("w7") in hot and len(hot) <= 1001

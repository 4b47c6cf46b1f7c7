"""Decontamination by winnowing against looking for every window in every document."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from clickweave.llm import decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda c: c[0].lower(), text or ""))


def brute(documents, items, span=10):
    windows = {}
    for item, text in items:
        own = words_of(text)
        if item is not None and own:
            size = min(span, len(own))
            for i in range(len(own) - size + 1):
                windows.setdefault(tuple(own[i : i + size]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    rows = []
    for doc, text in documents:
        own, hit, names = words_of(text), set(), set()
        for size in sizes:
            for i in range(len(own) - size + 1):
                if (found := windows.get(tuple(own[i : i + size]))) is not None:
                    hit.update(range(i, i + size))
                    names |= found
        rows.append((doc, len(own), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return rows


def check(documents, items, span=10, **options):
    expected = brute([(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()], [(r.item_id, r.text) for r in items.select("item_id", "text").collect()], span)
    got = [tuple(r) for r in decontamination.digest(decontamination.contaminated(documents, items, span, **options)).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)
    return expected


@pytest.fixture
def items(spark):
    return spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")


@pytest.mark.parametrize(("span", "bits"), [(10, 1 << 26), (10, 64), (3, 1 << 20), (1, 1 << 20)])
def test_documents(documents, items, span, bits):
    assert any(row[-1] for row in check(documents, items, span, bits=bits))


def test_planted_passages(spark):
    """Passages of every length, at every place, with equal words in them, and items of fewer words than a window."""
    rng = random.Random(13)
    vocabulary = [f"w{i}" for i in range(6)] + ["É", "日本"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.randrange(1, 40))) for i in range(25)] + [(3, text(12)), (90, None), (91, "!!"), (None, text(11)), (92, "")]
    documents = [(i, text(rng.randrange(30))) for i in range(60)]
    for i in range(120):
        own = (items[i % 25][1] or "").split()
        cut = own[rng.randrange(len(own)) :][: rng.randrange(1, 25)]
        documents.append((100 + i, f"{text(rng.randrange(4))}. {', '.join(cut).upper()}!\n{text(rng.randrange(4))}"))
    found = check(spark.createDataFrame(documents, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert 60 < sum(row[-1] for row in found)


def test_every_long_shared_span_shares_a_fingerprint():
    rng = np.random.default_rng(3)
    for span in (1, 2, 5, 10):
        for _ in range(50):
            shared = rng.integers(2, 9, span)
            prints = []
            for _ in range(2):
                before, after = rng.integers(2, 9, rng.integers(0, 9)), rng.integers(2, 9, rng.integers(0, 9))
                text = np.concatenate([before, shared, after])
                places, found = decontamination.winnow(text, np.array([len(text)]), span)
                inside = (places >= len(before)) & (places + decontamination.gram(span) <= len(before) + span)
                prints.append(set(found[inside]))
            assert prints[0] & prints[1]


def test_spans_and_items(spark):
    item = "one two three four five six seven eight nine ten eleven twelve"
    documents = spark.createDataFrame([(1, f"x {item} y z {item}"), (2, "nothing here")], "doc_id long, text string")
    items = spark.createDataFrame([("b", item), ("a", item), ("c", "two three four")], "item_id string, text string")
    rows = {r.doc_id: r for r in decontamination.contaminated(documents, items).collect()}
    assert [tuple(s) for s in rows[1].spans] == [(1, 13), (15, 27)] and rows[1]["items"] == ["a", "b", "c"]
    assert rows[2].spans == [] and rows[2]["items"] == []


def test_awkward_rows(awkward, empty, spark):
    items = spark.createDataFrame([(1, "the same words again"), (2, " ".join(f"word{i}" for i in range(3, 40))), (2, "ids"), (3, None)], "item_id long, text string")
    items = items.selectExpr("*", "1 AS doc_id", "'x' AS hits", "2 AS tier")
    found = check(awkward.withColumnRenamed("score", "n_words").withColumnRenamed("held_out", "digest"), items)
    assert len(found) == 12 and sum(row[-1] for row in found) == 4
    assert decontamination.contaminated(empty, items).collect() == []
    assert not any(row[-1] for row in check(awkward, items.limit(0)))

"""Classes against all pairs of shingle multisets."""

from __future__ import annotations

import collections
import itertools
import random

import numpy as np
import pytest

from clickweave.llm import near_copies as near


def brute(rows):
    """Class of each row, by exact similarity of labelled shingles in the same order."""
    labelled = []
    for _, text in rows:
        words, seen, own = (text or "").lower().split(), collections.Counter(), []
        for i in range(max(min(1, len(words)), len(words) - near.SHINGLE + 1)):
            shingle = tuple(words[i : i + near.SHINGLE])
            own.append((shingle, seen[shingle]))
            seen[shingle] += 1
        labelled.append(own)
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = labelled[i], labelled[j]
        if not a or not b or min(len(a), len(b)) < 0.8 * max(len(a), len(b)):
            continue
        place = {x: k for k, x in enumerate(b)}
        spots = [place[x] for x in a if x in place]
        tails = []
        for spot in spots:  # longest increasing run
            k = sum(t < spot for t in tails)
            tails[k : k + 1] = [spot]
        if len(tails) >= 0.8 * (len(a) + len(b) - len(tails)):
            parent[root(j)] = root(i)
    classes = collections.defaultdict(list)
    for i in range(len(rows)):
        classes[root(i)].append(rows[i][0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in classes.items()}
    return sorted(((rows[i][0], least[root(i)], len(classes[root(i)])) for i in range(len(rows))), key=repr)


def found(frame):
    rows = near.deduplicate(frame).collect()
    return rows, sorted(((r.doc_id, r.class_id, r.n_docs) for r in rows), key=repr)


def test_documents(documents):
    rows, classes = found(documents)
    expected = brute([(r.doc_id, r.text) for r in documents.collect()])
    assert classes == expected
    assert sum(r.kept for r in rows) == len({c for _, c, _ in expected})


@pytest.mark.parametrize("block", [2048, 7])
def test_a_chain_of_edits_and_a_shared_passage(spark, monkeypatch, block):
    monkeypatch.setattr(near, "BLOCK", block)
    rng = random.Random(3)
    words = [f"w{i}" for i in range(2000)]
    base, passage = [rng.choice(words) for _ in range(150)], [rng.choice(words) for _ in range(60)]
    rows, text = [], list(base)
    for i in range(25):  # neighbours are alike, the ends are not
        rows.append((i, " ".join(text)))
        text[rng.randrange(150)] = f"new{i}"
    for i in range(25, 60):  # what documents share is too little
        rows.append((i, " ".join([rng.choice(words) for _ in range(rng.randrange(20, 60))] + passage)))
    _, classes = found(spark.createDataFrame(rows, "doc_id long, text string"))
    assert classes == brute(rows)


def test_pairs_of_a_large_group_are_not_listed(spark, monkeypatch):
    counts, real = [], near.common.written
    monkeypatch.setattr(near.common, "written", lambda frame, purpose: counts.append(real(frame, purpose)) or counts[-1])
    rng = random.Random(5)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(120):  # most pairs look alike, few are linked
        text = list(base)
        for k in range(rng.choice((1, 5))):
            text[rng.randrange(200)] = f"new{i}-{k}"
        rows.append((i, " ".join(text)))
    _, classes = found(spark.createDataFrame(rows, "doc_id long, text string"))
    assert classes == brute(rows)
    counts = [frame.count() for frame in counts]
    assert max(counts) <= near.SKETCHES * len(rows) and len(counts) < 40


def test_awkward_rows(awkward):
    rows, classes = found(awkward)
    assert classes == brute([(r.doc_id, r.text) for r in awkward.collect()])
    assert sum(r.kept for r in rows if r.class_id == 6) == 1


def test_the_stage_keeps_one_row_of_each_class(awkward):
    kept = near.kept(awkward)
    assert kept.columns == awkward.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([None, 1, 2, 3, 4, 5, 6, 8, 9, 100], key=repr)


def test_empty_table(empty):
    assert near.deduplicate(empty).collect() == []


def test_similarity_is_an_ordered_one():
    a = np.arange(100, dtype=np.uint64)
    assert near.similarity(a, a) == 1
    assert near.similarity(a, a[::-1].copy()) == 0 or near.similarity(a, a[::-1].copy()) < 0.1
    assert near.similarity(a, np.concatenate([a[:50], a[55:]])) == 0.95

"""Token alignment against tokenising whole texts and comparing all ends."""

from __future__ import annotations

import collections
import hashlib
import itertools
import random

import pytest
import sentencepiece
from tokenizers import Tokenizer

from clickweave.llm import queries, token_alignment


def brute(texts):
    """Rows in the order of `texts`, from whole texts and every pair of tokens whose ends meet."""
    a_model = Tokenizer.from_file(token_alignment.TOKENIZER_A)
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=token_alignment.TOKENIZER_B)
    letters = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spelt = {chr(b): b for b in letters} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in letters)}
    names = {i: bytes(spelt[c] for c in token) for token, i in a_model.get_vocab().items() if all(c in spelt for c in token)}
    rows, counts = [], collections.Counter()
    for text in texts:
        a, b = ([], []) if not text else (a_model.encode(" " + text, add_special_tokens=False).ids, b_model.encode(text))
        parts_a = [names[i] for i in a]
        parts_b = [bytes([int(p[3:5], 16)]) if b_model.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, b_model.id_to_piece(b), strict=True)]
        if text and not b"".join(parts_a) == b"".join(parts_b) == (" " + text).encode():
            a, b = [], []
        ends_a, ends_b = ({end: n for n, end in enumerate(itertools.accumulate(map(len, parts[: len(ids)])))} for parts, ids in ((parts_a, a), (parts_b, b)))
        groups, links, at_a, at_b = [], [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            links.append((a[ends_a[end]], b[ends_b[end]]))
            groups.append(",".join(map(str, a[at_a : ends_a[end] + 1])) + "|" + ",".join(map(str, b[at_b : ends_b[end] + 1])))
            at_a, at_b = ends_a[end] + 1, ends_b[end] + 1
        counts.update(links)
        rows.append((len(a), len(b), groups, links))
    best = collections.Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return [
        (n_a, n_b, len(groups), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links),
         hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
        for n_a, n_b, groups, links in rows
    ]


def check(frame):
    rows = frame.select("doc_id", "text").collect()
    expected = sorted(((r.doc_id is not None, r.doc_id or 0), *x) for r, x in zip(rows, brute([r.text for r in rows]), strict=True))
    got = sorted(((r.doc_id is not None, r.doc_id or 0), *tuple(r)[1:]) for r in token_alignment.align(frame).collect())
    assert got == expected
    return got


AWKWARD = [
    "two  spaces", "three   spaces and\n\nempty lines\n", " leading", "trailing ", "trailing  ", "\nline first", "line last\n", "a\tb\r\nc \n d", " ", "\n", "\t",
    "<|endoftext|> <s> </s> <0x41> <unk>", "a ▁ literal", "it's we'll I'd 'sfoo foo's. e.g. www.x.com, a.b", "No!? Yes... 3.14, 1,000;", "日本語のテキスト。", "é è nbsp em",
    "é combining", "🙂🙂 🏳️‍🌈", "\x00\x01 control \x1f\x85 end", "ﬁ ligature ² ½ Ⅷ", "A" * 300, "word." * 40, ".,;:!?", " . , ", "x .y", "ß É.\nÑo: si;",
]


def test_awkward_texts(spark):
    assert len(check(spark.createDataFrame(list(enumerate(AWKWARD)), "doc_id long, text string"))) == len(AWKWARD)


def test_random_texts(spark, monkeypatch):
    monkeypatch.setattr(token_alignment, "MOST_KEPT", 60)  # forgets between batches
    rng = random.Random(11)
    alphabet = ["a", "the", "ing", "é", "Ñ", " ", " ", "  ", "\n", ".", ",", "'s", "7", "_", "\t", "🙂", "▁"[:0], "ion"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(400)]
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_documents(documents):
    rows = check(documents)
    assert sum(r[3] for r in rows) > sum(r[5] for r in rows) > 0


def test_awkward_rows(awkward, empty):
    assert len(check(awkward)) == 12
    assert token_alignment.align(empty).collect() == []


def test_identity_map_leads_to_equal_bytes():
    of = token_alignment.Vocabularies()
    assert all(of.bytes_a[a] == of.bytes_b[b] for a, b in enumerate(of.same) if b >= 0)
    assert (of.same >= 0).sum() > 10_000


def test_only_irregular_pairs_are_shuffled(spark):
    made = token_alignment.blocks(spark.createDataFrame([(1, "the house and the tree"), (2, "unbelievablezzq")], "doc_id long, text string")).cache()
    same = token_alignment.Vocabularies().same
    pairs = token_alignment.block_pairs(made).collect()
    assert pairs and all(same[r.pair >> 32] != r.pair & 0xFFFFFFFF for r in pairs)
    assert token_alignment.identity_counts(made, len(same)).max() == 2


def test_query(spark):
    assert set(queries.op11_token_alignment(spark, "/root/testdata/sf0.001").columns) == {
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"}


if __name__ == "__main__":
    pytest.main([__file__])

"""Packing and segmentation sampling against the tokenizers themselves, and URL rules against a plain judge."""

from __future__ import annotations

import collections
import itertools
import math
import re
import zlib

import numpy as np
import pytest

from clickweave.llm import packing, piece_sampling, queries, url_filter

ODD = ["", "<|endoftext|>a b", "É ß ﬁ\u00a0x  y\x1cz 12,3 don't I'll Ünḯ '' <|x", "\n\n", "a\u0301 \u0301b", "ΑΣ. Σ", "x" * 3000, "🙂 日本語。。"]


def test_ids_equal_the_tokenizers(documents):
    encoder = packing.Encoder()
    texts = [r.text for r in documents.collect()] + ODD + [None]
    whole = [np.array([*e.ids, packing.END]) for e in encoder.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    for _ in range(2):  # the second time from memory
        ids, sizes = encoder.encode(texts)
        assert sizes.tolist() == [len(x) for x in whole]
        assert (ids == np.concatenate(whole)).all()


def check(frame):
    """Every id lies in one piece, and windows are full powers of two."""
    encoder = packing.Encoder()
    rows = frame.select("doc_id", "text").collect()
    ids, sizes = encoder.encode([r.text for r in rows])
    by_crc = collections.Counter()
    pieces = packing.pack(frame).collect()
    sequences = collections.defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
        by_crc[p.doc_id, p.start, p.length, p.ids_crc32, p.doc_tokens] += 1
    for own in sequences.values():
        assert [a for a, _ in sorted(own)] == [0, *itertools.accumulate(n for _, n in sorted(own))][:-1]
        total = sum(n for _, n in own)
        assert total <= packing.CONTEXT and total & (total - 1) == 0
    assert sum(p.length for p in pieces) == len(ids)
    texts = collections.defaultdict(list)
    for r, end, n in zip(rows, np.cumsum(sizes), sizes, strict=True):
        texts[r.doc_id].append(ids[end - n : end])
    for key, start, length, crc, total in by_crc:
        assert any(len(x) == total and zlib.crc32(x[start : start + length].astype("<u4")) == crc for x in texts[key])
    by_step = collections.Counter()
    for p in pieces:
        by_step[p.step_group] += p.length
    assert all(n <= packing.STEP for n in by_step.values())
    assert len({(p.sequence_id, p.step_group) for p in pieces}) == len(sequences)


def test_packing(documents):
    check(documents)


def test_packing_awkward_rows(awkward, empty):
    check(awkward)
    assert packing.pack(empty).collect() == []


def test_packer_with_any_lengths():
    rng = np.random.default_rng(4)
    for n in (1, 3, 200):
        packer = packing.Packer()
        lengths = rng.integers(1, 9000, n)
        for i, length in enumerate(lengths.tolist()):
            packer.add(i, np.arange(length, dtype=np.uint32))
            if i % 50 == 0:
                packer.pack()
        packer.close()
        by_doc = collections.defaultdict(list)
        for document, start, length, *_ in packer.rows:
            by_doc[document].append((start, length))
        for i, length in enumerate(lengths.tolist()):
            assert [a for a, _ in sorted(by_doc[i])] == [0, *itertools.accumulate(n for _, n in sorted(by_doc[i]))][:-1]
            assert sum(n for _, n in by_doc[i]) == length


def test_step_groups_are_balanced():
    rng = np.random.default_rng(9)
    packer, deals = packing.Packer(task=3, spread=5), []
    for i, length in enumerate((2 ** rng.uniform(0, 14, 900)).astype(int).tolist()):
        packer.add(i, np.arange(length, dtype=np.uint32))
        if i % 40 == 0:
            packer.pack()
            deals.append(packer.dealt())
    packer.close()
    deals.append(packer.dealt(last=True))
    deals = [rows for rows in deals if rows]
    assert len(deals) > 3 and not packer.rows and not packer.dealt(last=True)
    seen = set()
    for nth, rows in enumerate(deals, 1):
        windows = {row[5]: (row[7], row[8]) for row in rows}
        groups = collections.defaultdict(list)
        for size, group in windows.values():
            groups[group].append(size)
        assert not seen & set(groups)
        seen |= set(groups)
        total, most = sum(map(sum, groups.values())), max(map(max, groups.values()))
        assert max(map(sum, groups.values())) <= packing.STEP and len(groups) == -(-total // packing.STEP)
        assert max(map(sum, groups.values())) - min(map(sum, groups.values())) <= most
        longest = [own.count(most) for own in groups.values()]
        assert max(longest) - min(longest) <= 1
        # cut in order of emission, groups differ by far more in cost than when dealt
        cost = lambda sizes: sum(x * x for x in sizes)
        ends = np.cumsum([size for _, (size, _) in sorted(windows.items())])
        emitted = collections.defaultdict(list)
        for end, (size, _) in zip(ends.tolist(), (windows[x] for x in sorted(windows)), strict=True):
            emitted[(end - 1) // packing.STEP].append(size)
        if nth < len(deals):
            assert max(map(cost, groups.values())) / min(map(cost, groups.values())) <= max(map(cost, emitted.values())) / min(map(cost, emitted.values()))
    assert seen == {(3 << 36) + i for i in range(len(seen))}


def ways(word, known, model):
    """Every segmentation of a word with its log weight."""
    found = {}

    def go(rest, ids, log):
        if not rest:
            found[tuple(ids)] = log
            return
        single = False
        for size in range(1, min(16, len(rest)) + 1):
            piece = model.piece_to_id(rest[:size])
            if piece:
                single |= size == 1
                go(rest[size:], [*ids, piece], log + known.log[piece])
        if not single:
            spelled = [int(known.byte_id[x]) for x in rest[0].encode()]
            go(rest[1:], [*ids, *spelled], log + sum(known.log[x] for x in spelled))

    go(word, [], 0.0)
    return found


@pytest.mark.parametrize("text", ["abc a", "日Ḃ x", "  a\nb "])
def test_samples_follow_the_lattice(text):
    import sentencepiece

    known = piece_sampling.vocabulary(piece_sampling.MODEL)
    model = sentencepiece.SentencePieceProcessor(model_file=piece_sampling.MODEL)
    every = ways("▁" + text.replace(" ", "▁"), known, model)
    total = np.logaddexp.reduce(list(every.values()))
    p = {ids: math.exp(log - total) for ids, log in every.items()}
    n = 6000
    seeds = np.random.default_rng(1).integers(0, 2**63, n).astype(np.uint64)
    samples = piece_sampling.sample([text] * n, seeds, known, 3)
    drawn = [[tuple(row[0].tolist()) for row in own] for own in samples]
    assert all(len(set(own)) == len(own) == min(3, len(p)) for own in drawn)
    first = collections.Counter(own[0] for own in drawn)
    assert all(abs(first[ids] / n - share) < 0.03 for ids, share in p.items())
    if len(p) > 1:  # the second is drawn from the rest
        pairs = collections.Counter((own[0], own[1]) for own in drawn)
        assert all(abs(pairs[a, b] / n - p[a] * p[b] / (1 - p[a])) < 0.03 for a in p for b in p if a != b)
    assert all(math.isclose(math.exp(row[1]), p[tuple(row[0].tolist())], rel_tol=1e-9) for own in samples[:100] for row in own)
    # inclusion scores make weighted samples unbiased
    assert abs(np.mean([sum(math.exp(row[1]) / row[3] for row in own) for own in samples]) - 1) < 0.05


def test_lattices_hold_every_piece_that_fits():
    """Edges of each state by length, with their pieces, as a plain search finds them, in texts of any words."""
    known = piece_sampling.vocabulary(piece_sampling.MODEL)
    pieces = {x.decode().replace(" ", piece_sampling.BLANK): i for i, x in enumerate(known.bytes) if x and i not in known.byte_id}
    words = ["▁unlikely", "▁▁▁more", "▁日本語Ḃ🙂", "▁" + "x" * 70, "▁"]
    lattice = piece_sampling.Lattice(words, known)
    longest = len(known.by_length)
    for word, base in zip(words, lattice.base.tolist(), strict=True):
        for i in range(len(word)):
            edges = slice(lattice.first[base + i], lattice.first[base + i + 1])
            fits = {size: pieces[word[i : i + size]] for size in range(1, min(longest, len(word) - i) + 1) if word[i : i + size] in pieces}
            fits = {1: -ord(word[i]) - 1} | fits
            assert list(zip((lattice.target[edges] - base - i).tolist(), lattice.piece[edges].tolist(), strict=True)) == sorted(fits.items())
            assert math.isclose(np.exp(lattice.log[edges]).sum(), 1, rel_tol=1e-9)
            u = np.linspace(0.001, 0.999, 50)
            assert (lattice.draw(np.full(50, base + i), u) == np.searchsorted(lattice.key, base + i + u, "right")).all()
    values = np.array([5, 70_000, 3, 70_000, 0, 2**33, 5])
    assert (piece_sampling._order(values) == np.argsort(values, kind="stable")).all()


def test_round_trip_and_repeatability(documents):
    rows = documents.select("doc_id", "text")
    found = {(r.doc_id, r.sample): r for r in piece_sampling.segmentations(rows, k=3).collect()}
    again = {(r.doc_id, r.sample): r for r in piece_sampling.segmentations(rows.repartition(5), k=3).collect()}
    assert found == again and all(r.decodes for r in found.values())
    known = piece_sampling.vocabulary(piece_sampling.MODEL)
    texts = dict(rows.collect())
    for (key, _), r in found.items():
        assert piece_sampling.decode(np.array(r.ids), known).decode() == texts[key]
        assert r.n_pieces == len(r.ids)
        assert 0 <= r.inclusion <= 1 and (r.inclusion > 0 or r.log_prob < -700)


def test_edges_behind_unlikely_prefixes_are_drawn_where_they_matter(monkeypatch):
    known = piece_sampling.vocabulary(piece_sampling.MODEL)
    texts = ["unlikely prefixes of a longer text, 日本語 and more", "ab", "a b c d e f g h"] * 300
    seeds = np.random.default_rng(4).integers(0, 2**63, len(texts)).astype(np.uint64)
    found = []
    for deep in (1e9, 40, 3, 0.01):
        monkeypatch.setattr(piece_sampling, "DEEP", deep)
        found.append([[(row[0].tolist(), *row[1:]) for row in own] for own in piece_sampling.sample(texts, seeds, known, 3)])
    assert all(own == found[0] for own in found)


def test_the_query_returns_the_segmentations(spark, tmp_path):
    texts = {1: "some words and 日本語 Ḃ", 2: "", 3: "  more  words "}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    known = piece_sampling.vocabulary(piece_sampling.MODEL)
    rows = queries.op3_piece_sampling(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in rows} == set(texts)
    for r in rows:
        ids = np.array(r.ids, dtype=np.uint32)
        assert piece_sampling.decode(ids, known).decode() == texts[r.doc_id]
        assert (r.n_pieces, r.ids_crc32) == (len(ids), zlib.crc32(ids))


def test_pieces_awkward_rows(awkward, empty):
    rows = piece_sampling.segmentations(awkward).collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in awkward.collect()}
    assert [(r.n_pieces, r.inclusion) for r in rows if r.doc_id in (1, 2)] == [(0, 1.0), (0, 1.0)]
    assert all(r.decodes for r in rows)
    assert piece_sampling.segmentations(empty).collect() == []


def judge(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [
        (len(rule), rule, verdict) for rule, verdict in url_filter.HOST_RULES for own, start in [rule.split("/", 1)]
        if (host == own or host.endswith("." + own)) and path.startswith("/" + start)
    ]
    if fits:
        return host, path, max(fits)[1], max(fits)[2]
    hit = any(re.fullmatch(re.escape(pattern).replace(r"\*", ".*"), host + path) for pattern, _ in url_filter.PATTERNS)
    return host, path, None, "block" if hit else "allow"


def test_urls(spark):
    urls = [
        "https://www.example.com/en/1?x=1", "HTTP://Example.COM/EN/x", "http://example.com/en/", "http://a.b.example.com/en/x#y", "http://x.net/es/1", "x.net/es/",
        None, "", "http://", "http://com", "http://com/", "http://notcom/", "ftp://my.ads.org/x", "http://a.org/ads/x", "http://a.org/ADS/x", "http://net/fr/?", "a://b://c.net/fr/",
        "http://user@x.com:80/en/", "http://é.net/es/ü", "http://x.net?y=/es/", "http://www.example.com/enx", "http://x.ads-track.org/a", "http://x.ads.com/ads/y",
    ]
    frame = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls * 2)] + [(None, "http://x.net/es/", "y")], "page_id long, url string, host string")
    rows = url_filter.judge(frame, url_filter.rule_table(spark)).collect()
    expected = [(i, *judge(u)) for i, u in enumerate(urls * 2)] + [(None, *judge("http://x.net/es/"))]
    assert sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in rows), key=repr) == sorted(expected, key=repr)
    assert url_filter.judge(frame.limit(0), url_filter.rule_table(spark)).collect() == []
    assert {r.verdict for r in url_filter.judge(frame, url_filter.rule_table(spark, [], [])).collect()} == {"allow"}


def test_rules_run_no_python(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    plan = url_filter.judge(frame, url_filter.rule_table(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct", plan)

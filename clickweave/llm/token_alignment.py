"""Cross-tokenizer alignment: which tokens of a byte-level BPE (A) stand for which pieces of a sentencepiece model (B).

Both tokenise the same bytes (a space and the text). Byte offsets where tokens of both end cut them into groups; the last
tokens of a group are linked.

- *Identity map.* An array, made from the vocabularies, leads from an A id to the B id of the same bytes. A group of one A and one B token
  that it links is counted in a vector as long as A's vocabulary. Only the pairs of all other groups, summed up per block of texts, are
  shuffled; a linked pair of a longer group never has equal bytes, so no pair is counted in both ways.
- *Fragments.* Neither tokenizer merges across the places where texts are cut here: before a space or single line break that follows no
  white space, and between a letter and marks, where B has no piece that holds both. So every distinct fragment is tokenised, cut into
  groups and written out once per worker, and texts are put together from fragments.
- Each block of texts is written once, with its fragments' links. When the corpus-wide counts are known, they go to the blocks that
  hold the pair.

Defined cases: texts that are null or empty, or that B does not reproduce byte for byte, have no tokens. Repeated rows are counted each.
"""

from __future__ import annotations

import hashlib
import os
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm import common, words

TOKENIZER_A = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER_B = public_tokenizers.path("piece_bpe_32k.model")
BLOCK_CHARS = 4_000_000
#: Fragments, and words of a text, that a worker remembers at most.
MOST_KEPT = 800_000
_MARKS = ".,;:!?"
#: Without white space but for a line break in front.
_SIMPLE = r"^\n?[^\s\x0b\x1c-\x1f\x{85}\p{Z}]+$"
_LETTERS = r"^\n?\pL+$"
_BEFORE_SPACES = re.compile(r"(?<=[!-~])(?= )")
_SPACE, _EMPTY = pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())
#: Fragments that are tokenised as one text.
_TOGETHER = 500


def byte_of_character() -> dict[str, int]:
    """The characters that byte-level vocabularies spell bytes with: printable bytes by themselves, the others from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabularies:
    """Both tokenizers, the bytes of their tokens, and the identity map."""

    def __init__(self, path_a: str = TOKENIZER_A, path_b: str = TOKENIZER_B):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.a.encode_special_tokens = True
        spelt, named = byte_of_character(), self.a.get_vocab()
        self.bytes_a = [b""] * (max(named.values()) + 1)
        for token, i in named.items():
            self.bytes_a[i] = bytes(spelt[c] for c in token) if all(c in spelt for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode() for i, piece in enumerate(pieces)
        ]
        by_bytes: dict[bytes, int] = {}
        for i in sorted(range(len(pieces)), key=self.b.is_byte):  # pieces before single bytes
            if not self.b.is_control(i) and not self.b.is_unknown(i):
                by_bytes.setdefault(self.bytes_b[i], i)
        self.same = np.array([by_bytes.get(x, -1) for x in self.bytes_a], dtype=np.int64)
        if any("\n" in piece or "▁" in piece.lstrip("▁") for piece in pieces):
            raise ValueError("B must not merge across spaces and line breaks")
        bound = {re.escape(piece[i : i + 2]) for piece in pieces for i in range(len(piece) - 1) if piece[i + 1] in _MARKS and piece[i].isalpha()}
        self.bound = f"(?:{'|'.join(sorted(bound))})[{_MARKS}]*$" if bound else None
        self.starts_a, self.starts_b = (np.array([x.startswith(b" ") for x in found]) for found in (self.bytes_a, self.bytes_b))

    def _each(self, fragments: list[str]) -> tuple[list[int], list[int], list[int], list[int]]:
        a = [e.ids for e in self.a.encode_batch_fast(fragments, add_special_tokens=False)]
        # behind a line break, which is two ids with the space that B puts in front
        b = [ids[2:] for ids in self.b.encode(["\n" + fragment for fragment in fragments], num_threads=1)]
        return [i for x in a for i in x], [len(x) for x in a], [i for x in b for i in x], [len(x) for x in b]

    def _together(self, fragments: list[str]) -> tuple | None:
        """As one text, if every fragment begins where a token begins with a space, and nowhere else."""
        text, sizes = "".join(fragments), []
        a, b = self.a.encode(text, add_special_tokens=False).ids, self.b.encode("\n" + text, num_threads=1)[2:]
        for ids, starts in ((a, self.starts_a), (b, self.starts_b)):
            at = np.flatnonzero(starts[ids])
            if len(at) != len(fragments) or at[0]:
                return None
            sizes.append(np.diff(np.concatenate([at, [len(ids)]])).tolist())
        return a, sizes[0], b, sizes[1]

    def encode(self, fragments: list[str], words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of fragments by A and by B, each with how many every fragment has.

        They start as they do in a text: with a space, a line break, or marks. The first `words` ones are a space and no other white space.
        """
        found: tuple = ([], [], [], [])
        parts = [fragments[i : min(words, i + _TOGETHER)] for i in range(0, words, _TOGETHER)]
        for part, make in [*((part, self._together) for part in parts), (fragments[words:], self._each)]:
            for all_, new in zip(found, make(part) or self._each(part), strict=True):
                all_ += new
        return tuple(np.array(x, dtype=np.int64) for x in found)


class Aligner:
    """Fragments known so far, by number: their tokens, groups and links. A text's words are one or two fragments each."""

    def __init__(self, path_a: str = TOKENIZER_A, path_b: str = TOKENIZER_B):
        self.of = Vocabularies(path_a, path_b)
        self.size_a, self.size_b = (np.array([len(x) for x in found], dtype=np.int64) for found in (self.of.bytes_a, self.of.bytes_b))
        self.text_a, self.text_b = (
            pa.array([f"{i}{mark}" for mark in marks for i in range(len(found))])
            for found, marks in ((self.of.bytes_a, ",|"), (self.of.bytes_b, ",;"))
        )
        self.forget()

    def forget(self) -> None:
        """Fragment 0 is empty; words that are not cut by themselves have fragment -1."""
        self.words = pa.array([], pa.large_string())
        self.first, self.second = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.fragments = pa.array([""], pa.large_string())
        self.good, self.n_a, self.n_b, self.n_groups = np.array([True]), *(np.zeros(1, np.int32) for _ in range(3))
        self.link = np.zeros(0, dtype=np.int64)  # A id * 2^32 + B id
        self.texts = pa.array([""], pa.large_string())

    def _good(self, fragments: list[str], a, n_a, b, n_b) -> np.ndarray:
        """Whether both tokenizers reproduce a fragment."""
        whole = "".join(fragments).encode("utf-8", "surrogatepass")
        size = np.array([len(x.encode("utf-8", "surrogatepass")) for x in fragments], dtype=np.int64)
        spelt = [b"".join(map(names.__getitem__, ids.tolist())) for names, ids in ((self.of.bytes_a, a), (self.of.bytes_b, b))]
        sizes = [_sums(each[ids], n) for each, ids, n in ((self.size_a, a, n_a), (self.size_b, b, n_b))]
        if spelt[0] == spelt[1] == whole and (sizes[0] == size).all() and (sizes[1] == size).all():
            return np.ones(len(fragments), dtype=bool)
        ends = [np.cumsum(x).tolist() for x in (size, *sizes)]
        cut = lambda text, ends, i: text[ends[i - 1] if i else 0 : ends[i]]
        return np.array([cut(whole, ends[0], i) == cut(spelt[0], ends[1], i) == cut(spelt[1], ends[2], i) for i in range(len(fragments))], dtype=bool)

    def _learn(self, fragments: pa.Array) -> None:
        """Tokenises new fragments and cuts them into groups."""
        alone = pc.match_substring_regex(fragments, _SIMPLE.replace(r"\n?", " "))
        fragments = pa.concat_arrays([fragments.filter(alone), fragments.filter(pc.invert(alone))])
        plain = fragments.to_pylist()
        a, n_a, b, n_b = self.of.encode(plain, pc.sum(alone).as_py() or 0)
        good = self._good(plain, a, n_a, b, n_b)
        a, b, n_a, n_b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)], n_a * good, n_b * good
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        last_a, last_b = np.isin(ends_a, ends_b, assume_unique=True), np.isin(ends_b, ends_a, assume_unique=True)
        # each group's A tokens, then its B tokens
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        in_a, in_b = np.bincount(group_a, minlength=last_a.sum()), np.bincount(group_b, minlength=last_a.sum())
        token = np.empty(len(a) + len(b), dtype=np.int64)
        token[np.arange(len(a)) + (np.cumsum(in_b) - in_b)[group_a]] = a + last_a * len(self.size_a)
        token[np.arange(len(b)) + np.cumsum(in_a)[group_b]] = b + last_b * len(self.size_b) + len(self.text_a)
        texts = pa.concat_arrays([self.text_a, self.text_b]).take(pa.array(token))
        owner = np.repeat(np.arange(len(plain)), n_a)
        self.texts = pa.concat_arrays([self.texts, pc.binary_join(_lists(texts, n_a + n_b), "").cast(pa.large_string())])
        new = good, n_a, n_b, np.bincount(owner[last_a], minlength=len(plain))
        self.good, self.n_a, self.n_b, self.n_groups = (
            np.concatenate([old, x.astype(old.dtype)]) for old, x in zip((self.good, self.n_a, self.n_b, self.n_groups), new, strict=True))
        self.link = np.concatenate([self.link, a[last_a] << 32 | b[last_b]])
        self.fragments = pa.concat_arrays([self.fragments, fragments])

    def _numbers(self, fragments: pa.Array) -> np.ndarray:
        """Numbers of fragments, new ones learnt."""
        new = pc.unique(fragments.filter(pc.invert(pc.is_in(fragments, value_set=self.fragments))))
        if len(new):
            self._learn(new)
        return pc.index_in(fragments, value_set=self.fragments).to_numpy(zero_copy_only=False).astype(np.int32)

    def _add(self, words: pa.Array) -> None:
        """New words: letters and the marks behind them are fragments of their own unless a piece of B holds both."""
        simple = pc.match_substring_regex(words, _SIMPLE)
        head = pc.utf8_rtrim(words, _MARKS)
        cut = pc.match_substring_regex(head, _LETTERS)
        if self.of.bound:
            cut = pc.and_(cut, pc.invert(pc.match_substring_regex(words, self.of.bound)))
        tail = pc.if_else(cut, pc.replace_substring_regex(words, f"(?s)^.*[^{_MARKS}]", ""), _EMPTY)
        head = pc.if_else(cut, head, words)
        # words stand behind a space, unless they begin with a line break
        head = pc.if_else(pc.starts_with(head, "\n"), head, pc.binary_join_element_wise(_SPACE, head, _EMPTY))
        numbers = self._numbers(pa.concat_arrays([pc.if_else(simple, head, _EMPTY), pc.if_else(simple, tail, _EMPTY)]))
        first = np.where(simple.to_numpy(zero_copy_only=False), numbers[: len(words)], -1)
        self.words = pa.concat_arrays([self.words, words])
        self.first, self.second = np.concatenate([self.first, first.astype(np.int32)]), np.concatenate([self.second, numbers[len(words) :]])

    def cut(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the fragments of all texts, text after text, and how many each text has."""
        if max(len(self.words), len(self.fragments)) > MOST_KEPT:
            self.forget()
        split = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " \n"), " ")
        coded = split.flatten().dictionary_encode()
        known = pc.index_in(coded.dictionary, value_set=self.words)
        if known.null_count:
            self._add(coded.dictionary.filter(pc.is_null(known)))
            known = pc.index_in(coded.dictionary, value_set=self.words)
        words = known.to_numpy()[coded.indices.to_numpy()]
        found = np.stack([self.first[words], self.second[words]], axis=1).ravel()
        counts = 2 * pc.list_value_length(split).to_numpy().astype(np.int64)
        odd = np.unique(np.searchsorted(np.cumsum(counts), np.flatnonzero(found < 0), side="right"))
        if len(odd):
            found, counts = self._with_runs_of_white_space(texts, odd, found, counts)
        return found, counts

    def _with_runs_of_white_space(self, texts, odd, found, counts):
        """Texts with longer runs of white space are cut before spaces that follow a visible character only."""
        rows = np.split(found, np.cumsum(counts)[:-1])
        own = [_BEFORE_SPACES.split(" " + texts[i]) for i in odd]
        numbers = self._numbers(pa.array([fragment for fragments in own for fragment in fragments], pa.large_string()))
        for i, row in zip(odd, np.split(numbers, np.cumsum([len(x) for x in own])[:-1]), strict=True):
            rows[i] = row
        return np.concatenate(rows), np.array([len(row) for row in rows], dtype=np.int64)

    def links(self, fragments: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Links of these fragments, one after the other, and how many each has."""
        first, size = (np.cumsum(self.n_groups, dtype=np.int64) - self.n_groups)[fragments], self.n_groups[fragments].astype(np.int64)
        return self.link[np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())], size


def _lists(flat: pa.Array, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), flat)


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sum of each text's values."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def _aligner(path_a: str, path_b: str) -> Aligner:
    """One per worker process; what it remembers never changes results."""
    return _ALIGNERS.setdefault((path_a, path_b), None) or _ALIGNERS.update({(path_a, path_b): Aligner(path_a, path_b)}) or _ALIGNERS[path_a, path_b]


#: Arrays of a block, packed: fragments of its texts by their place among the block's distinct ones, their number per text, links per distinct
#: fragment, each link (an A id of the identity map, or the length of A's vocabulary plus the place of a pair), the pairs and their counts.
PARTS = ("codes", "sizes", "n_links", "links", "pairs", "counts")
DOCUMENT = "doc_id {kind}, n_a long, n_b long, n_groups long, groups_sha256 string"


def blocks(documents: DataFrame, path_a: str = TOKENIZER_A, path_b: str = TOKENIZER_B, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Texts tokenised and grouped, a row per block; a task's last row has the counts of its identity links by A id."""
    documents = common.columns(documents, doc_id=key, text=text)
    document = "struct<" + ", ".join(x.replace(" ", ": ") for x in DOCUMENT.format(kind=common.kind(documents, "doc_id")).split(", ")) + ">"

    def made(batches):
        aligner = _aligner(path_a, path_b)
        same, task, number = aligner.of.same, TaskContext.get().partitionId() << 32, 0
        identity = np.zeros(len(same), dtype=np.int64)
        names = ["block", "documents", *PARTS, "identity"]
        documents_type = None
        for batch in batches:
            for part in words.batches(batch.column(1), BLOCK_CHARS):
                ids, texts = (column.slice(part.start, part.stop - part.start) for column in batch.columns)
                texts = ["" if x is None else x for x in texts.to_pylist()]
                found, counts = aligner.cut(texts)
                ends = np.cumsum(counts)
                good = (_sums(~aligner.good[found], counts) == 0) & np.array([bool(x) for x in texts])
                kept = np.repeat(good, counts)
                counts = np.where(good, counts, 0)
                found = found[kept]
                spelt = pc.binary_join(_lists(aligner.texts.take(pa.array(found)), counts), _EMPTY).to_pylist()
                hashed = [hashlib.sha256(x[:-1].encode()).hexdigest() if x else "" for x in spelt]
                distinct, codes = np.unique(found, return_inverse=True)
                links, n_links = aligner.links(distinct)
                weight = np.repeat(np.bincount(codes, minlength=len(distinct)), n_links)
                a, b = links >> 32, links & 0xFFFFFFFF
                plain = same[a] == b
                identity += np.bincount(a[plain], weights=weight[plain], minlength=len(same)).astype(np.int64)
                pairs, place = np.unique(links[~plain], return_inverse=True)
                total = np.bincount(place, weights=weight[~plain], minlength=len(pairs)).astype(np.int64)
                a[~plain] = len(same) + place
                row = pa.StructArray.from_arrays([
                    ids, *(pa.array(_sums(x[found], counts)) for x in (aligner.n_a, aligner.n_b, aligner.n_groups)), pa.array(hashed, pa.string()),
                ], ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256"])
                documents_type = row.type
                packed = [common.pack(x.astype(np.int32)) for x in (codes, counts, n_links, a)] + [common.steps(pairs), common.pack(total)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([task + number]), _lists(row, np.array([len(row)])), *(pa.array([x], pa.binary()) for x in packed), pa.array([None], pa.binary()),
                ], names)
                number += 1
        if documents_type is not None:
            yield pa.RecordBatch.from_arrays([
                pa.array([None], pa.int64()), pa.array([None], pa.list_(documents_type)), *(pa.array([None], pa.binary()) for _ in PARTS),
                pa.array([common.pack(identity)], pa.binary()),
            ], names)

    binary = ", ".join(f"{name} binary" for name in (*PARTS, "identity"))
    return documents.mapInArrow(made, f"block long, documents array<{document}>, {binary}")


def _rows(frame: DataFrame, schema: str, names: list[str], unpacked) -> DataFrame:
    """Rows that `unpacked` reads from each block, as arrays."""
    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in unpacked(row)], names)

    return frame.mapInArrow(read, schema)


def block_pairs(made: DataFrame) -> DataFrame:
    """`block, pair, n` of the groups that the identity map does not cover."""
    def unpacked(row):
        pairs = common.sums(row["pairs"])
        return np.full(len(pairs), row["block"]), pairs, common.unpack(row["counts"], np.int64)

    return _rows(made.filter("block IS NOT NULL").select("block", "pairs", "counts"), "block long, pair long, n long", ["block", "pair", "n"], unpacked)


def identity_counts(made: DataFrame, length: int) -> np.ndarray:
    """Corpus-wide counts of identity links by A id; no more rows than A's vocabulary has reach the driver."""
    def unpacked(row):
        counts = common.unpack(row["identity"], np.int64)
        seen = np.flatnonzero(counts)
        return seen, counts[seen]

    rows = _rows(made.filter("identity IS NOT NULL").select("identity"), "a long, n long", ["a", "n"], unpacked)
    found = rows.groupBy("a").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(length, dtype=np.int64)
    total[found.column("a").to_numpy()] = found.column("n").to_numpy()
    return total


def align(documents: DataFrame, path_a: str = TOKENIZER_A, path_b: str = TOKENIZER_B, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document's tokens, groups and links: `n_best` links are their B id's most frequent ones, `count_sum` adds up the links' counts."""
    made = common.written(blocks(documents, path_a, path_b, key, text), "alignment-blocks")
    same = Vocabularies(path_a, path_b).same
    identity = identity_counts(made, len(same))
    totals = common.written(block_pairs(made).groupBy("pair").agg(F.sum("n").alias("total")), "alignment-pairs")
    # the most frequent link of each B id: one row per id of B's vocabulary at most
    best = np.zeros(max(1, same.max() + 1), dtype=np.int64)
    np.maximum.at(best, same[same >= 0], identity[same >= 0])
    found = totals.groupBy(F.col("pair").bitwiseAND(0xFFFFFFFF).alias("b")).agg(F.max("total").alias("total")).toArrow()
    b, total = (found.column(name).to_numpy() for name in ("b", "total"))
    best = np.concatenate([best, np.zeros(max(0, int(b.max(initial=0)) + 1 - len(best)), np.int64)])
    np.maximum.at(best, b, total)

    counted = block_pairs(made).select("block", "pair").join(totals, "pair").groupBy("block").agg(F.collect_list(F.struct("pair", "total")).alias("counted"))
    joined = made.filter("block IS NOT NULL").drop("identity", "counts").join(counted.withColumnRenamed("block", "_block"), F.col("block") == F.col("_block"), "left")
    document = made.schema["documents"].dataType.elementType
    kind = document["doc_id"].dataType.simpleString()

    def summed(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(name)[at] for name in batch.schema.names}
                codes, sizes, n_links, links = (common.unpack(row[name].as_py(), np.int32).astype(np.int64) for name in PARTS[:4])
                pairs = common.sums(row["pairs"].as_py())
                count, top = np.concatenate([identity, np.zeros(len(pairs), np.int64)]), np.concatenate([best[same], best[pairs & 0xFFFFFFFF]])
                if row["counted"].is_valid:
                    known = row["counted"].values
                    count[len(same) + np.searchsorted(pairs, known.field("pair").to_numpy())] = known.field("total").to_numpy()
                per_fragment = [_sums(x[links], n_links) for x in (count, (count == top).astype(np.int64))]
                count_sum, n_best = (_sums(x[codes], sizes) for x in per_fragment)
                docs = row["documents"].values
                yield pa.RecordBatch.from_arrays([
                    *(docs.field(i) for i in range(4)), docs.field(3), pa.array(n_best), pa.array(count_sum), docs.field(4),
                ], ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return joined.drop("_block").mapInArrow(
        summed, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")

"""Packing: hierarchical multi-length packing of tokenised documents.

A document of `CONTEXT` or more tokens fills whole windows first; what is left, like any shorter document, is routed to the
smallest tier that holds it. Tiers are packed from the longest to the shortest: a window opens with one document of
its tier, its gap takes the largest shorter ones that fit whole, and the last one is cut to fill it
exactly. So every window is as long as its tier, a power of two, and needs no padding. What a task has left at its end is cut
into windows of falling powers of two.

Windows are dealt to step groups of at most `STEP` tokens, `SPREAD` groups or more at a time (fewer at a task's end): the longest first, each to the
group with the fewest tokens, then the least cost (the square of the length). So groups that are dealt together differ by one window in
tokens at most, and by one in the number of their longest windows. No group exceeds `STEP`, as lengths are powers of two.

Each task packs its own rows batch by batch, and keeps only an unfilled window and the list of undealt windows between batches. Sequence and
step numbers hold the task's number, so they are unique without a shuffle.

Defined cases: null texts count as empty and give one piece, the end token. Repeated rows and ids are packed each.
"""

from __future__ import annotations

import bisect
import heapq
import os
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from clickweave.llm import common

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
CONTEXT = 4096
TIERS = (512, 1024, 2048, 4096)
STEP = 8 * CONTEXT
SPREAD = 32
END = 2
MOST_KEPT = 1_000_000
#: Words whose ids depend on their lower-cased letters alone, but for marks at their end.
_PLAIN, _MARKS = "^[A-Za-zÀ-ÖØ-öø-ÿ]+$", ".,!?;:"


class Encoder:
    """Ids of whole texts, found word by word: the tokenizer drops white space and never joins across it.

    Keeps the ids of up to `MOST_KEPT` words, then starts afresh.
    """

    def __init__(self, path: str = TOKENIZER, end: int = END):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.end = Tokenizer.from_file(path), end
        self.closes = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.closes[i] = token.endswith("</w>")
        self.forget()

    def forget(self) -> None:
        """Known words are one or two known parts each, letters then marks; part 0 is empty."""
        self.words, self.parts = pa.array([], pa.string()), pa.array([""])
        self.first, self.second = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.size, self.flat = np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.uint32)

    def _add(self, parts: pa.Array, ids: list[np.ndarray], sizes: np.ndarray) -> None:
        self.parts = pa.concat_arrays([self.parts, parts])
        self.flat, self.size = np.concatenate([self.flat, *ids]), np.concatenate([self.size, sizes])

    def _unknown(self, parts: pa.Array) -> pa.Array:
        return pc.unique(parts.filter(pc.invert(pc.is_in(parts, value_set=self.parts))))

    def _letters(self, words: pa.Array) -> None:
        """Ids of words of letters: encoded as one text and parted where a word's last token is."""
        known = words.to_pylist()
        texts = [" ".join(known[i : i + 1000]) for i in range(0, len(known), 1000)]
        found = [np.array(e.ids, dtype=np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        ends = np.flatnonzero(self.closes[np.concatenate(found)]) + 1 if found else np.zeros(0, np.int64)
        if len(ends) != len(words):
            raise ValueError("the tokenizer does not end words as expected")
        self._add(words, found, np.diff(np.concatenate([[0], ends])))

    def _learn(self, words: pa.Array) -> None:
        bare = pc.utf8_rtrim(words, _MARKS)
        plain = pc.match_substring_regex(bare, _PLAIN)
        heads = pc.if_else(plain, pc.utf8_lower(bare), words)
        tails = pc.if_else(plain, pc.replace_substring_regex(words, f"^.*[^{_MARKS}]", ""), "")
        self._letters(self._unknown(heads.filter(plain)))
        others = self._unknown(pa.concat_arrays([heads, tails]))
        found = [np.array(e.ids, dtype=np.uint32) for e in self.tokenizer.encode_batch_fast(others.to_pylist(), add_special_tokens=False)]
        self._add(others, found, np.array([len(x) for x in found], dtype=np.int64))
        self.words = pa.concat_arrays([self.words, words])
        self.first, self.second = (
            np.concatenate([old, pc.index_in(x, value_set=self.parts).to_numpy()]) for old, x in ((self.first, heads), (self.second, tails))
        )

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids one text after the other, each with the end token, and how many each text has."""
        if len(self.words) > MOST_KEPT:
            self.forget()
        texts = pa.array([text or "" for text in texts], pa.string())
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = split.flatten().dictionary_encode()
        rows = pc.index_in(coded.dictionary, value_set=self.words)
        if rows.null_count:
            self._learn(coded.dictionary.filter(pc.is_null(rows)))
            rows = pc.index_in(coded.dictionary, value_set=self.words)
        rows = rows.to_numpy()[coded.indices.to_numpy()]
        parts = np.stack([self.first[rows], self.second[rows]], axis=1).ravel()
        start, take = (np.cumsum(self.size) - self.size)[parts], self.size[parts]
        reach = np.concatenate([[0], np.cumsum(take)])
        ids = self.flat[np.repeat(start - reach[:-1], take) + np.arange(reach[-1])]
        ends = reach[2 * np.cumsum(pc.list_value_length(split).to_numpy())] if len(texts) else np.zeros(0, np.int64)
        return np.insert(ids, ends, np.uint32(self.end)), np.diff(np.concatenate([[0], ends])) + 1


class Packer:
    """Packs pieces (document, start, ids); `rows` are the finished windows' pieces, still without a step group."""

    def __init__(self, task: int = 0, tiers: tuple[int, ...] = TIERS, step: int = STEP, spread: int = SPREAD):
        self.base, self.tiers, self.step, self.spread = task << 36, tiers, step, spread
        self.windows = self.steps = self.tokens = 0  # windows and groups so far, tokens in windows not yet dealt
        self.undealt: list[tuple[int, int]] = []  # length and number of each window
        self.pool: list[tuple[int, int]] = []  # length and number of each piece, sorted
        self.pieces: dict[int, tuple] = {}
        self.number = self.held = 0  # pieces so far, tokens in the pool
        self.rows = []

    def _keep(self, piece) -> None:
        self.number += 1
        self.held += len(piece[2])
        self.pieces[self.number] = piece
        bisect.insort(self.pool, (len(piece[2]), self.number))

    def _pop(self, at: int):
        length, number = self.pool.pop(at)
        self.held -= length
        return self.pieces.pop(number)

    def add(self, document, ids: np.ndarray) -> None:
        start = 0
        while len(ids) - start >= self.tiers[-1]:
            self._window([((document, len(ids)), start, ids[start : start + self.tiers[-1]])], self.tiers[-1])
            start += self.tiers[-1]
        if start < len(ids):
            self._keep(((document, len(ids)), start, ids[start:]))

    def _window(self, pieces, size: int) -> None:
        offset = 0
        for (document, total), start, ids in pieces:
            ids = np.ascontiguousarray(ids, dtype="<u4")
            self.rows.append((document, start, len(ids), zlib.crc32(ids), total, self.base + self.windows, offset, size))
            offset += len(ids)
        self.undealt.append((size, self.base + self.windows))
        self.windows += 1
        self.tokens += size

    def _take(self, most: int):
        """The largest piece of at most `most` tokens; without one, the head of the smallest longer one."""
        at = bisect.bisect_left(self.pool, (most + 1, 0))
        if at:
            return self._pop(at - 1)
        owner, start, ids = self._pop(0)
        self._keep((owner, start + most, ids[most:]))
        return owner, start, ids[:most]

    def pack(self) -> None:
        """Fills windows with what there is; an unfilled one's pieces stay."""
        while self.pool:
            length = self.pool[-1][0]
            size = next(tier for tier in self.tiers if tier >= length)
            if self.held < size:  # too little for its own tier: cut what fills the next smaller one
                smaller = [tier for tier in self.tiers if tier <= length]
                if not smaller:
                    break
                size = smaller[-1]
            first = self._pop(len(self.pool) - 1)
            if length > size:
                self._keep((first[0], first[1] + size, first[2][size:]))
                first = (first[0], first[1], first[2][:size])
            pieces, gap = [first], size - len(first[2])
            while gap:
                pieces.append(self._take(gap))
                gap -= len(pieces[-1][2])
            self._window(pieces, size)
        self.pieces = {k: (owner, start, ids.copy()) for k, (owner, start, ids) in self.pieces.items()}

    def close(self) -> None:
        self.pack()
        for size in (1 << k for k in range(self.tiers[-1].bit_length(), -1, -1)):
            if self.held & size:
                pieces, gap = [], size
                while gap:
                    pieces.append(self._take(gap))
                    gap -= len(pieces[-1][2])
                self._window(pieces, size)

    def dealt(self, last: bool = False) -> list[tuple]:
        """The finished rows, each with its window's step group; none as long as there is too little to balance."""
        if not self.undealt or not last and self.tokens < self.spread * self.step:
            return []
        groups = [(0, 0, self.base + self.steps + i) for i in range(-(-self.tokens // self.step))]
        self.steps += len(groups)
        group_of = {}
        for size, window in sorted(self.undealt, key=lambda x: (-x[0], x[1])):
            tokens, cost, group = groups[0]
            heapq.heapreplace(groups, (tokens + size, cost + size * size, group))
            group_of[window] = group
        rows = [(*row, group_of[row[5]]) for row in self.rows]
        self.rows, self.undealt, self.tokens = [], [], 0
        return rows


FIELDS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "context", "step_group")


def pack(rows: DataFrame, path: str = TOKENIZER, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per piece; `context` is its window's length and `step_group` its step."""
    rows = common.columns(rows, doc_id=key, text=text)

    def packed(batches):
        encoder, packer = Encoder(path), Packer(TaskContext.get().partitionId())

        def finished(last: bool = False):
            found = list(zip(*packer.dealt(last), strict=True)) or [()] * len(FIELDS)
            return pa.RecordBatch.from_arrays([pa.array(x, pa_kind if name == "doc_id" else pa.int64()) for x, name in zip(found, FIELDS, strict=True)], FIELDS)

        pa_kind = None
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            pa_kind = keys.type
            for i in range(0, len(texts), 4000):
                ids, sizes = encoder.encode(texts[i : i + 4000].to_pylist())
                for document, end, size in zip(keys[i : i + 4000].to_pylist(), np.cumsum(sizes), sizes, strict=True):
                    packer.add(document, ids[end - size : end])
                packer.pack()
                yield finished()
        if pa_kind is not None:
            packer.close()
            yield finished(last=True)

    longs = ", ".join(f"{name} long" for name in FIELDS[1:])
    return rows.mapInArrow(packed, f"doc_id {common.kind(rows, 'doc_id')}, {longs}")

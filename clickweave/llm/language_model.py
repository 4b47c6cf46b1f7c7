"""Language-model scoring: an Elias-Fano trie of word pairs, sharded by context.

Texts are cut into blocks of about `BLOCK_CHARS` characters. A block sends each word and each pair of neighbouring words
once, with its count in training texts, to the shard that owns it. A shard merges what all blocks sent, builds
its part of the trie, and answers each block: exact word counts, and for each pair the quantised discounted
frequency with the number of different followers of its context. Blocks then score their texts. Neither the corpus nor
the model passes through the driver or one task, and shards grow in number, not in size.

The model is a bigram model with absolute discounting:
    p(w | v) = max(c(v w) - D, 0) / c(v) + D * followers(v) / c(v) * base(w)
over the base probability (c(w) + 0.1) / (N + 0.1 (V + 1)); after an unseen context it is the base. Texts begin in a start
context and close with an end token.

Contexts with a large share of a sample's tokens (`HOT_SHARE`; there can be 1/HOT_SHARE at most) are dealt to
shards by follower too. The sample only decides where they are counted.
Words are compared by 63 hash bits, pairs by the first 40 bits of each word.

Defined cases: null texts count as empty and are scored as the end token alone. Without training texts all
counts are 0 and V is 0, so every token has probability 1. Repeated rows count and are scored each.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm import common

BLOCK_CHARS = 8_000_000
SHARD_CHARS = 16_000_000
HOT_SHARE = 1e-3
HOT_ROWS = 500
DISCOUNT = 0.75
PAIR_BITS = 40
EXACT = 4096  # discounted counts up to here have their own code
#: Hashes of what stands before the first word and after the last; words have larger ones.
START, END = 0, 1


def hashed(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """63-bit hashes of all tokens, one text after the other, and how many each text has.

    A-Z are lower-cased, words end at ASCII white space, and each text ends with the end token.
    """
    stream, sizes = common.hashed_words(pc.ascii_split_whitespace(pc.ascii_lower(common.plain_texts(texts))))
    return np.insert(stream, np.cumsum(sizes), END), sizes + 1


class EliasFano:
    """A monotone sequence: low bits packed, high bits in unary, with a running count of ones per 64 bits."""

    def __init__(self, values: np.ndarray | None = None, *, parts: list[np.ndarray] | None = None):
        if parts is not None:
            head, self.low, self.high, self.ones = parts
            self.n, self.bits = int(head[0]), int(head[1])
            return
        self.n = len(values)
        top = int(values[-1]) + 1 if self.n else 1
        self.bits = max(0, int(math.log2(top / self.n))) if self.n else 0
        low = (values & np.int64((1 << self.bits) - 1)).astype(np.uint64)
        place = np.arange(self.n, dtype=np.uint64) * np.uint64(self.bits)
        self.low = np.zeros(self.n * self.bits // 64 + 2, dtype=np.uint64)
        word, shift = (place >> np.uint64(6)).astype(np.int64), place & np.uint64(63)
        np.bitwise_or.at(self.low, word, low << shift)
        over = shift + np.uint64(self.bits) > 64
        np.bitwise_or.at(self.low, word[over] + 1, low[over] >> (np.uint64(64) - shift[over]))
        spots = (values >> self.bits) + np.arange(self.n)
        bits = np.zeros(((int(spots[-1]) + 2 if self.n else 1) + 63) // 64 * 64, dtype=np.uint8)
        bits[spots] = 1
        self.high = np.packbits(bits, bitorder="little").view(np.uint64)
        self.ones = np.concatenate([[0], np.cumsum(bits.reshape(-1, 64).sum(axis=1))]).astype(np.int64)

    def parts(self) -> list[np.ndarray]:
        return [np.array([self.n, self.bits], dtype=np.int64), self.low, self.high, self.ones]

    def _select(self, count: np.ndarray, zeros: bool) -> np.ndarray:
        """The place of the count-th (from 0) zero or one."""
        before = 64 * np.arange(len(self.ones)) - self.ones if zeros else self.ones
        block = np.searchsorted(before, count, "right") - 1
        block = np.minimum(block, len(self.high) - 1)
        bits = np.unpackbits(self.high[block].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        if zeros:
            bits = 1 - bits
        inside = np.cumsum(bits, axis=1, dtype=np.uint8) > (count - before[block])[:, None]
        found = inside.argmax(axis=1)
        return 64 * block + np.where(inside[np.arange(len(inside)), found] if len(inside) else False, found, 64)

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), dtype=np.int64)
        place = i.astype(np.uint64) * np.uint64(self.bits)
        word, shift = (place >> np.uint64(6)).astype(np.int64), place & np.uint64(63)
        rest = np.where(shift > 0, self.low[word + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
        return ((self.low[word] >> shift | rest) & np.uint64((1 << self.bits) - 1)).astype(np.int64)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self._select(i, False) - i << self.bits) | self._low(i)

    def successor(self, values: np.ndarray) -> np.ndarray:
        """The first index whose entry is at least the value; n if there is none."""
        high = values >> self.bits
        # entries with a smaller high part end before the high-th zero
        start = np.where(high > 0, self._select(np.maximum(high - 1, 0), True) - np.maximum(high - 1, 0), 0)
        stop = self._select(high, True) - high
        start, stop = np.minimum(start, self.n), np.minimum(stop, self.n)
        low = values & np.int64((1 << self.bits) - 1)
        while (start < stop).any():
            middle = (start + stop) // 2
            less = (start < stop) & (self._low(np.minimum(middle, max(0, self.n - 1))) < low)
            start, stop = np.where(less, middle + 1, start), np.where(less, stop, np.where(start < stop, middle, stop))
        return start


class Trie:
    """Contexts in order, pointers to their followers, and followers as places relative to their context."""

    def __init__(self, context: np.ndarray, follower: np.ndarray, count: np.ndarray, discount: float = DISCOUNT):
        """The pairs sorted by context and follower, without repeats."""
        first = np.flatnonzero(np.diff(context, prepend=-1)) if len(context) else np.zeros(0, np.int64)
        self.contexts = EliasFano(context[first])
        self.pointers = EliasFano(np.append(first, len(context)).astype(np.int64))
        rank = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(context))))
        self.bits = max(1, min(PAIR_BITS, 62 - max(1, len(first)).bit_length()))
        self.followers = EliasFano((rank << self.bits) + (follower >> (PAIR_BITS - self.bits)))
        self.codes = quantised(count - discount)

    def save(self, path: str) -> None:
        """One file per array, so that they can be mapped."""
        parts = [p for x in (self.contexts, self.pointers, self.followers) for p in x.parts()]
        for i, part in enumerate([*parts, self.codes, np.array([self.bits])]):
            np.save(f"{path}-{i}.npy", part)

    @classmethod
    def load(cls, path: str) -> "Trie":
        """Memory-mapped levels."""
        parts = [np.load(f"{path}-{i}.npy", mmap_mode="r") for i in range(14)]
        trie = cls.__new__(cls)
        trie.contexts, trie.pointers, trie.followers = (EliasFano(parts=parts[i : i + 4]) for i in (0, 4, 8))
        trie.codes, trie.bits = parts[12], int(parts[13][0])
        return trie

    def find(self, context: np.ndarray, follower: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each pair's code (0 if unseen) and how many followers its context has."""
        n, codes = np.zeros(len(context), np.int64), np.zeros(len(context), np.uint16)
        if not self.contexts.n or not len(context):
            return codes, n
        distinct, which = np.unique(context, return_inverse=True)
        at = self.contexts.successor(distinct)
        known = at < self.contexts.n
        known[known] = self.contexts.get(at[known]) == distinct[known]
        begin, end = (self.pointers.get(np.where(known, at + k, 0)) for k in (0, 1))
        n = np.where(known, end - begin, 0)[which]
        use = np.flatnonzero(known[which])
        wanted = (at[which[use]] << self.bits) + (follower[use] >> (PAIR_BITS - self.bits))
        place = self.followers.successor(wanted)
        inside = place < self.followers.n
        use, wanted, place = use[inside], wanted[inside], place[inside]
        same = self.followers.get(place) == wanted
        codes[use[same]] = self.codes[place[same]]
        return codes, n


def quantised(value: np.ndarray) -> np.ndarray:
    """16-bit codes: whole steps above the discount up to `EXACT`, then steps of 0.1 %. 0 stands for unseen."""
    steps = value + DISCOUNT
    large = EXACT + np.rint(1000 * np.log(np.maximum(steps, 1) / EXACT))
    return np.where(steps <= EXACT, np.rint(steps), np.minimum(large, 65535)).astype(np.uint16)


def restored(code: np.ndarray) -> np.ndarray:
    """The discounted count a code stands for."""
    code = code.astype(np.float64)
    steps = np.where(code <= EXACT, code, EXACT * np.exp((code - EXACT) / 1000))
    return np.where(code > 0, np.maximum(steps - DISCOUNT, 0), 0)


class Block:
    """The words and pairs of a run of texts, each once, and where they go."""

    def __init__(self, number: int, held: np.ndarray, sizes: np.ndarray, known: np.ndarray, stream: np.ndarray, shards: int, hot: np.ndarray):
        """known: the words' hashes in order, the start among them; stream: the texts' tokens as places in `known`."""
        self.number, self.held, self.sizes, self.known, self.stream = number, held, sizes, known, stream
        before = np.concatenate([[0], stream[:-1]])[: len(stream)]
        before[np.cumsum(sizes) - sizes] = 0  # the start has the smallest hash
        used = np.repeat(~held, sizes)
        self.word_count = np.bincount(stream[used], minlength=len(known))
        self.word_count[0] = (~held).sum()
        pairs, self.pair = np.unique(before.astype(np.int64) * len(known) + stream, return_inverse=True)
        self.pair_count = np.bincount(self.pair[used], minlength=len(pairs))
        self.first, self.second = pairs // len(known), pairs % len(known)
        self.context, self.follower = known[self.first] >> 63 - PAIR_BITS, known[self.second] >> 63 - PAIR_BITS
        # by shard, then hash; hot contexts are dealt by their followers too
        mix = lambda x: (x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
        self.word_shard = (mix(known) % np.uint64(shards)).astype(np.int64)
        self.word_order = np.lexsort((known, self.word_shard))
        salt = np.where(np.isin(self.context, hot), mix(self.follower), np.uint64(0))
        self.pair_shard = ((mix(self.context) + salt) % np.uint64(shards)).astype(np.int64)
        self.pair_order = np.lexsort((self.follower, self.context, self.pair_shard))

    def requests(self) -> pd.DataFrame:
        rows = []
        word_shard, pair_shard = self.word_shard[self.word_order], self.pair_shard[self.pair_order]
        # only the shards that the run needs: there may be far more
        needed = np.union1d(word_shard, pair_shard)
        cuts = [np.searchsorted(x, needed, side) for x in (word_shard, pair_shard) for side in ("left", "right")]
        for s, word_at, word_end, pair_at, pair_end in zip(needed.tolist(), *cuts, strict=True):
            w, p = self.word_order[word_at:word_end], self.pair_order[pair_at:pair_end]
            context = self.context[p]
            rows.append((
                s, self.number, common.steps(self.known[w]), common.pack(self.word_count[w].astype(np.int64)),
                common.steps(context), common.pack(self.follower[p]), common.pack(self.pair_count[p].astype(np.int64)),
            ))
        return pd.DataFrame(rows, columns=["shard", "block", "words", "word_counts", "contexts", "followers", "pair_counts"])


def _runs(batches, chars: int):
    """The partition's texts in runs cut by size alone, so that every pass over the same table cuts them alike.

    Yields the number, keys, held-out flags, sizes, known hashes and stream of each.
    """
    task, number, parts, size = TaskContext.get().partitionId(), 0, [], 0

    def run():
        keys, held, tokens, sizes = zip(*parts, strict=True)
        known, stream = np.unique(np.concatenate([[START], *tokens]), return_inverse=True)
        return (task << 20) + number, pa.concat_arrays(keys), np.concatenate(held), np.concatenate(sizes), known, stream[1:].astype(np.int32)

    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            some = batch.slice(at, 2000)
            texts = some.column("text")
            parts.append((some.column("doc_id"), some.column("held_out").to_numpy(zero_copy_only=False), *hashed(texts)))
            size += (pc.sum(pc.binary_length(texts)).as_py() or 0) + len(texts)
            if size >= chars:
                yield run()
                number, parts, size = number + 1, [], 0
    if parts:
        yield run()


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    distinct, which = np.unique(np.concatenate(keys), return_inverse=True)
    return distinct, np.bincount(which, weights=np.concatenate(counts), minlength=len(distinct)).astype(np.int64)


def _followers_of(hot: np.ndarray, contexts: np.ndarray) -> np.ndarray:
    return np.searchsorted(contexts, hot, "right") - np.searchsorted(contexts, hot)


def _answer(requests: pd.DataFrame, hot: np.ndarray) -> pd.DataFrame:
    """One shard: counts words, builds its trie and answers every block."""
    requests = requests.sort_values("block")
    asked = [common.sums(x) for x in requests["words"]]
    word, count = _merged(asked, [common.unpack(x, np.int64) for x in requests["word_counts"]])
    contexts, followers = [common.sums(x) for x in requests["contexts"]], [common.unpack(x, np.int64) for x in requests["followers"]]
    sizes = [len(x) for x in contexts]
    context, which = np.unique(np.concatenate(contexts), return_inverse=True)
    order = np.lexsort((np.concatenate(followers), which))
    left, right = which[order], np.concatenate(followers)[order]
    new = (np.diff(left, prepend=-1) != 0) | (np.diff(right, prepend=-1) != 0)
    group = np.cumsum(new) - 1
    total = np.bincount(group, weights=np.concatenate([common.unpack(x, np.int64) for x in requests["pair_counts"]])[order]).astype(np.int64) if len(order) else np.zeros(0, np.int64)
    left, right = context[left[new]], right[new]
    trie = Trie(left[total > 0], right[total > 0], total[total > 0])
    codes, n_followers = trie.find(left, right)
    back = np.empty(len(order), dtype=np.int64)
    back[order] = group
    seen = (count > 0) & (word != START)
    by_hot = _followers_of(hot, left[total > 0])
    rows, at = [], 0
    for k, (block, own) in enumerate(zip(requests["block"], asked, strict=True)):
        mine = back[at : at + sizes[k]]
        at += sizes[k]
        rows.append((
            requests["shard"].iloc[0], block, common.pack(count[np.searchsorted(word, own)]), common.pack(codes[mine]), common.pack(n_followers[mine].astype(np.int32)),
            int(seen.sum()) if k == 0 else 0, int(count[seen].sum()) if k == 0 else 0, by_hot.tolist() if k == 0 else [],
        ))
    return pd.DataFrame(rows, columns=["shard", "block", "word_counts", "codes", "followers", "distinct", "tokens", "hot"])


def _scored(block: Block, keys: list, answers: pd.DataFrame, distinct: int, tokens: int, hot: np.ndarray, hot_followers: np.ndarray) -> pd.DataFrame:
    answers = answers.sort_values("shard")
    counts = np.empty(len(block.known), dtype=np.int64)
    counts[block.word_order] = np.concatenate([common.unpack(x, np.int64) for x in answers["word_counts"]])
    numerator, followers = np.empty(len(block.first)), np.empty(len(block.first))
    numerator[block.pair_order] = restored(np.concatenate([common.unpack(x, np.uint16) for x in answers["codes"]]))
    followers[block.pair_order] = np.concatenate([common.unpack(x, np.int32) for x in answers["followers"]])
    place = np.minimum(np.searchsorted(hot, block.context), len(hot) - 1)
    followers = np.where(hot[place] == block.context, hot_followers[place], followers)
    total = counts[block.first]
    base = (counts + 0.1) / (tokens + 0.1 * (distinct + 1))
    rest = np.where(total > 0, DISCOUNT * followers / np.maximum(total, 1), 1.0)
    p = np.where(total > 0, numerator / np.maximum(total, 1), 0.0) + rest * base[block.second]
    owner = np.repeat(np.arange(len(block.sizes)), block.sizes)
    add = lambda x: np.bincount(owner, weights=x, minlength=len(block.sizes))
    return pd.DataFrame({
        "doc_id": pd.Series(keys, dtype=object), "held_out": block.held, "n_tokens": block.sizes,
        "n_known": add(counts[block.stream] > 0).astype(np.int64), "train_tokens": tokens,
        "base_score": add(np.log10(base)[block.stream]), "score": add(np.log10(np.maximum(p, 1e-300))[block.pair]),
    })


def _hot_contexts(rows: DataFrame) -> np.ndarray:
    """The contexts that hold a large share of a sample's tokens, and the start."""
    n = rows.count()
    # copies of a text are drawn one by one, by their keys
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))

    def counted(batches):
        for batch in batches:
            stream, _ = hashed(batch.column(0))
            context, count = np.unique(stream >> 63 - PAIR_BITS, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(context, -1)), pa.array(np.append(count, len(stream)))], ["context", "n"])

    found = rows.filter(draw < min(1.0, HOT_ROWS / max(1, n))).select("text").mapInArrow(counted, "context long, n long")
    # -1 stands for all tokens, of which 1/HOT_SHARE contexts at most have that share
    top = found.groupBy("context").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "context").limit(int(1 / HOT_SHARE) + 2).collect()
    total = sum(r.n for r in top if r.context == -1)
    return np.unique(np.array([START >> 63 - PAIR_BITS] + [r.context for r in top if r.context >= 0 and r.n >= HOT_SHARE * max(1, total)], dtype=np.int64))


def score(rows: DataFrame, key: str = "doc_id", text: str = "text", folds: int = 10, chars: int = BLOCK_CHARS) -> DataFrame:
    """Learns from rows whose key's crc32 modulo `folds` is not 0, and scores every row."""
    rows = common.columns(rows, doc_id=key, text=text)
    rows = rows.withColumn("held_out", common.fold("doc_id", folds) == 0)
    kind = common.kind(rows, "doc_id")
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    shards = max(8, -(-size // SHARD_CHARS))
    hot = _hot_contexts(rows)

    def asked(batches):
        for number, _, held, sizes, known, stream in _runs(batches, chars):
            yield pa.RecordBatch.from_pandas(Block(number, held, sizes, known, stream, shards, hot).requests(), preserve_index=False)

    requests = rows.mapInArrow(asked, "shard long, block long, words binary, word_counts binary, contexts binary, followers binary, pair_counts binary")
    shape = "shard long, block long, word_counts binary, codes binary, followers binary, distinct long, tokens long, hot array<long>"
    answers = common.written(requests.groupBy("shard").applyInPandas(lambda group: _answer(group, hot), shape), "language-model")
    known = answers.agg(F.sum("distinct").alias("distinct"), F.sum("tokens").alias("tokens")).first()
    distinct, tokens = known.distinct or 0, known.tokens or 0
    by_hot = {r.pos: r.n for r in answers.select(F.posexplode("hot")).groupBy("pos").agg(F.sum("col").alias("n")).collect()}
    hot_followers = np.array([by_hot.get(i, 0) for i in range(len(hot))])

    def streams(batches):
        for number, keys, held, sizes, known, stream in _runs(batches, chars):
            packed = [np.packbits(held).tobytes(), common.pack(sizes), common.steps(known), common.pack(stream)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.ListArray.from_arrays([0, len(keys)], keys), *[pa.array([x], pa.binary()) for x in packed]],
                ["block", "keys", "held", "sizes", "known", "stream"],
            )

    def scored(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if len(left) != 1:
            raise ValueError(f"{len(left)} runs of texts have one number: the table changed between passes")
        run = left.iloc[0]
        sizes = common.unpack(run["sizes"], np.int64)
        held = np.unpackbits(np.frombuffer(run["held"], dtype=np.uint8))[: len(sizes)].astype(bool)
        block = Block(run["block"], held, sizes, common.sums(run["known"]), common.unpack(run["stream"], np.int32), shards, hot)
        return _scored(block, list(run["keys"]), right, distinct, tokens, hot, hot_followers)

    return (
        rows.mapInArrow(streams, f"block long, keys array<{kind}>, held binary, sizes binary, known binary, stream binary")
        .groupBy("block").cogroup(answers.drop("hot").groupBy("block"))
        .applyInPandas(scored, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    )

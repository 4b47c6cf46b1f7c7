"""SentencePiece encoding and decoding: distinct segmentations by Gumbel top-k sampling without replacement.

A text's lattice has an edge for each vocabulary piece that fits, and for a character without a piece one for its bytes.
The piece of rank r in the vocabulary has weight 1/(r+1) (Zipf's law over the model's own order; it stores no
probabilities), so every segmentation has a probability. Perturbed A* search finds the `k` segmentations with the
largest Gumbel-perturbed log probability, which is a sample without replacement: a node is a partial segmentation; its
value is the largest perturbed log probability below it; taking the best node draws the rest of its path from the lattice and
leaves the path's unchosen edges as new nodes, with Gumbels truncated at the taken value. A segmentation's
inclusion score is the probability that its perturbed log probability exceeds the (k+1)-th: 1 - exp(-exp(log_prob - threshold)).

No piece spans the end of a word, so a text's lattice is a chain of its words' lattices, and equal words share theirs.
Random numbers are hashes of the row key, the sample and the place, so they don't depend on partitions. No edge's Gumbel is more than
`REACH` above its log probability, the random numbers being what they are. So unchosen edges behind a prefix of log probability below -`DEEP` are
only drawn for texts where one of them could still be among the samples or set the threshold; all others are drawn in any case.

Encoding puts one blank before the text, as the model does; decoding drops it. Both keep every character, but for U+2581, which
stands for a blank.

Defined cases: null and empty texts have one segmentation, without pieces. Texts with fewer than k
segmentations give all of them, with inclusion 1. An inclusion score below the smallest double is 0. Rows with equal keys and texts give equal samples.
"""

from __future__ import annotations

import heapq
import re
import zlib
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm import common

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SAMPLES = 2
DEEP = 40
REACH = 37  # the largest number of `_uniform` is 1 - 2**-53, whose Gumbel is 36.74
BLANK = "▁"
DIGITS = 6  # of the scores returned, as the last ones depend on what texts share a batch
_RUN = re.compile(f"{BLANK}+[^{BLANK}]*")


class Vocabulary:
    """The model's pieces: hashes by length for matching, log weights, and bytes for decoding."""

    def __init__(self, path: str = MODEL):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        pieces, ranks, self.bytes = [], np.full(n, n, dtype=np.int64), [b""] * n
        self.byte_id = np.zeros(256, dtype=np.int64)
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                self.bytes[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i)):
                pieces.append((piece, i))
                self.bytes[i] = piece.replace(BLANK, " ").encode()
                if model.get_score(i) > -n:
                    ranks[i] = round(-model.get_score(i))
        weight = 1 / (ranks + 1.0)
        self.log = np.log(weight / weight.sum())
        self.size = np.array([len(x) for x in self.bytes], dtype=np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(self.bytes), dtype=np.uint8)
        points, lengths = common.code_points([piece for piece, _ in pieces])
        begin = np.cumsum(lengths) - lengths
        ids = np.array([i for _, i in pieces])
        # by length: the pieces and the beginnings of longer ones
        self.by_length = []
        value = np.zeros(len(pieces), dtype=np.uint64)
        for size in range(1, int(lengths.max()) + 1):
            long = np.flatnonzero(lengths >= size)
            value[long] = _extended(value[long], points[begin[long] + size - 1])
            self.by_length.append(Beginnings(value[long], np.where(lengths[long] == size, ids[long], -1), lengths[long] > size))


def _extended(value: np.ndarray, points: np.ndarray) -> np.ndarray:
    return common.mixed(value * np.uint64(0x9E3779B97F4A7C15) + points.astype(np.uint64) + np.uint64(1))


@lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Beginnings:
    """Beginnings of pieces, of one length, by their hashes: the piece that ends there (-1: none), and whether longer ones go on."""

    def __init__(self, values: np.ndarray, pieces: np.ndarray, longer: np.ndarray):
        known, which = np.unique(values, return_inverse=True)
        # none is greater than the last, and it is no piece
        self.values = np.append(known, np.uint64(2**64 - 1))
        self.piece, self.longer = np.full(len(known) + 1, -1, dtype=np.int32), np.zeros(len(known) + 1, dtype=bool)
        np.maximum.at(self.piece, which, pieces)
        np.logical_or.at(self.longer, which, longer)
        # hashes lie evenly, so that their highest bits tell the place but for a few steps
        bits = max(1, int(8 * len(known)).bit_length())
        self.shift = np.uint64(64 - bits)
        per_slot = np.bincount((known >> self.shift).astype(np.int64), minlength=1 << bits)
        self.start = (np.cumsum(per_slot) - per_slot).astype(np.int32)
        self.steps = int(per_slot.max())

    def find(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = self.start[values >> self.shift]
        for _ in range(self.steps):
            at = at + (self.values[at] < values)
        same = self.values[at] == values
        return np.where(same, self.piece[at], -1), same & self.longer[at]


def _order(values: np.ndarray) -> np.ndarray:
    """The stable order of whole numbers from 0, by 16 bits at a time, for which numpy has a radix sort."""
    order = np.argsort((values & 0xFFFF).astype(np.uint16), kind="stable")
    for shift in range(16, int(values.max(initial=0)).bit_length(), 16):
        order = order[np.argsort((values[order] >> shift & 0xFFFF).astype(np.uint16), kind="stable")]
    return order


class Lattice:
    """The lattices of some words. States are places in the words, `end` of each included."""

    def __init__(self, words: list[str], known: Vocabulary):
        points, lengths = common.code_points([f"{word}\n" for word in words])
        self.base = np.cumsum(lengths) - lengths
        self.end = self.base + lengths - 1
        left = np.repeat(self.end, lengths) - np.arange(len(points))  # characters up to the word's end
        active = np.flatnonzero(left > 0)
        value = np.zeros(len(active), dtype=np.uint64)
        sources, ids, nths = [], [], []
        degree = np.zeros(len(points), dtype=np.int64)
        for size, beginnings in enumerate(known.by_length, 1):
            inside = left[active] >= size
            active, value = active[inside], value[inside]
            if not len(active):
                break
            value = _extended(value, points[active + size - 1])
            piece, goes_on = beginnings.find(value)
            if size == 1:  # bytes for the rest: negative, by code point
                source, piece = active, np.where(piece >= 0, piece, -points[active].astype(np.int32) - 1)
            else:
                found = piece >= 0
                source, piece = active[found], piece[found]
            sources.append(source)
            ids.append(piece)
            nths.append(degree[source])
            degree[source] += 1
            active, value = active[goes_on], value[goes_on]
        # each state's edges side by side, the shorter ones first
        self.first = np.concatenate([[0], np.cumsum(degree)])
        self.source = np.repeat(np.arange(len(points), dtype=np.int32), degree)
        self.piece, self.target = np.empty_like(self.source), np.empty_like(self.source)
        for size, (source, piece, nth) in enumerate(zip(sources, ids, nths, strict=True), 1):
            at = self.first[source] + nth
            self.piece[at], self.target[at] = piece, source + size
        weight = known.log[np.maximum(self.piece, 0)]
        spelled = np.flatnonzero(self.piece < 0)
        code = -self.piece[spelled]
        weight[spelled] = (1 + (code > 0x80) + (code > 0x800) + (code > 0x10000)) * known.log[known.byte_id[0]]
        # log weight of all ways from a state to its word's end, from the ends backwards
        total = np.zeros(len(points))
        away = np.repeat(left, degree)
        by_left = _order(away)
        cuts = np.cumsum(np.bincount(away, minlength=int(left.max(initial=0)) + 1))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            edges = by_left[a:b]  # of states equally far from their end, state by state
            if len(edges):
                state = self.source[edges]
                new = np.flatnonzero(np.diff(state, prepend=-1))
                total[state[new]] = np.logaddexp.reduceat(weight[edges] + total[self.target[edges]], new)
        self.log = weight + total[self.target] - total[self.source]
        reach = np.cumsum(np.exp(self.log))
        before = np.repeat(np.concatenate([[0], reach])[self.first[:-1]], degree)
        self.key = self.source + np.minimum(reach - before, 1.0)
        last = self.first[1:][degree > 0] - 1
        self.key[last] = self.source[last] + 1.0

    def draw(self, state: np.ndarray, u: np.ndarray) -> np.ndarray:
        """An edge of each state, by its probability."""
        chosen, last, place = self.first[state], self.first[state + 1] - 1, state + u
        open_ = np.flatnonzero((chosen < last) & (self.key[chosen] <= place))
        while len(open_):
            chosen[open_] += 1
            at = chosen[open_]
            open_ = open_[(at < last[open_]) & (self.key[at] <= place[open_])]
        return chosen


def _seeded(seed: np.ndarray, *places) -> np.ndarray:
    for place in places:
        seed = common.mixed(seed * np.uint64(0x9E3779B97F4A7C15) + np.asarray(place).astype(np.uint64) + np.uint64(1))
    return seed


def _uniform(seed: np.ndarray, *places) -> np.ndarray:
    """Numbers in (0, 1) from hashes."""
    seed = _seeded(seed, *places)
    return ((seed >> np.uint64(12)).astype(np.float64) + 0.5) / float(1 << 52)


def _words(texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray]:
    """The code of each word of all texts, the distinct words, and how many words each text has."""
    # a word without its first blank; only runs of blanks need care, as pieces may hold several
    odd = np.array(["  " in text or text[:1] == " " or text[-1:] == " " for text in texts], dtype=bool)
    split = pc.split_pattern(pa.array([text for text, x in zip(texts, odd, strict=True) if not x], pa.large_string()), " ")
    runs = [_RUN.findall(BLANK + text.replace(" ", BLANK)) for text, x in zip(texts, odd, strict=True) if x]
    coded = pa.concat_arrays([split.flatten(), pa.array([run[1:] for own in runs for run in own], pa.large_string())]).dictionary_encode()
    sizes = np.zeros(len(texts), dtype=np.int64)
    sizes[~odd], sizes[odd] = pc.list_value_length(split).to_numpy(), [len(own) for own in runs]
    owner = np.concatenate([np.repeat(np.flatnonzero(x), sizes[x]) for x in (~odd, odd)])
    code = coded.indices.to_numpy().astype(np.int64)
    if odd.any():
        code = code[_order(owner)]
    return code, [BLANK + word for word in coded.dictionary.to_pylist()], sizes


class Path:
    """One segmentation of each text (or of some): edges by word occurrence and rank in it."""

    def __init__(self, word: np.ndarray, rank: np.ndarray, edge: np.ndarray, n_words: int):
        per_word = np.bincount(word, minlength=n_words)
        at = np.cumsum(per_word) - per_word
        self.edge = np.empty(len(edge), dtype=np.int64)
        self.edge[at[word] + rank] = edge
        self.word = np.repeat(np.arange(n_words), per_word)
        self.rank = np.arange(len(edge)) - at[self.word]


def _spelled(piece: np.ndarray, begin: np.ndarray, known: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids with characters without a piece as their bytes, and where each text's begin."""
    missing, which = np.unique(piece[piece < 0], return_inverse=True)
    spelled = [known.byte_id[list(chr(-x - 1).encode("utf-8", "surrogatepass"))] for x in missing.tolist()]
    size, start = np.ones(len(piece), dtype=np.int64), piece.copy()
    lengths = np.array([len(x) for x in spelled], dtype=np.int64)
    size[piece < 0], start[piece < 0] = lengths[which], (len(known.size) + np.cumsum(lengths) - lengths)[which]
    reach = np.concatenate([[0], np.cumsum(size)])
    source = np.concatenate([np.arange(len(known.size)), *spelled]).astype(np.uint32)
    return source[np.repeat(start - reach[:-1], size) + np.arange(reach[-1])], reach[np.append(begin, len(piece))]


def sample(texts: list[str], seeds: np.ndarray, known: Vocabulary, k: int = SAMPLES):
    """For each text its samples: (ids, log probability, perturbed log probability, inclusion), best first. No text may be empty."""
    code, distinct, sizes = _words(texts)
    lattice = Lattice(distinct, known)
    n_words, n = len(code), len(texts)
    text_of = np.repeat(np.arange(n), sizes)
    first_word = np.cumsum(sizes) - sizes
    place = np.arange(n_words) - first_word[text_of]
    near = _order(code)  # neighbours in memory
    value = -np.log(-np.log(_uniform(seeds, 0)))
    queues = [[] for _ in range(n)]
    paths, logs, found = [], [], [[] for _ in range(n)]
    taken = [(0, -1, -1, g, 0.0) for g in value.tolist()]  # parent path, node, edge, value, log of the prefix
    for turn in range(k):
        alive = np.array([x is not None for x in taken])
        parent, node, edge = (np.array([x[i] if x else 0 for x in taken], dtype=np.int64) for i in range(3))
        value = np.array([x[3] if x else 0.0 for x in taken])
        kept_word, kept_rank, kept_edge = [], [], []
        from_word, from_state, from_rank = np.where(alive, first_word, n_words), np.full(n, -1), np.zeros(n, np.int64)
        if turn:
            for p in range(turn):
                path, begin = paths[p]
                mine = np.flatnonzero(alive & (parent == p))
                if not len(mine):
                    continue
                a, b = begin[mine], begin[mine] + node[mine]
                spots = np.repeat(a - (np.cumsum(b - a) - (b - a)), b - a) + np.arange((b - a).sum())
                kept_word += [path.word[spots], path.word[b]]
                kept_rank += [path.rank[spots], path.rank[b]]
                kept_edge += [path.edge[spots], edge[mine]]
                from_word[mine], from_state[mine], from_rank[mine] = path.word[b], lattice.target[edge[mine]], path.rank[b] + 1
        state = lattice.base[code]
        rank = np.zeros(n_words, dtype=np.int64)
        forced = np.flatnonzero(alive & (from_state >= 0))
        state[from_word[forced]], rank[from_word[forced]] = from_state[forced], from_rank[forced]
        free = near[(np.arange(n_words) >= np.repeat(from_word, sizes))[near]]
        state, rank, end = state[free], rank[free], lattice.end[code[free]]
        seed = _seeded(seeds[text_of[free]], turn + 1, place[free])
        while True:
            goes_on = state < end
            free, state, rank, end, seed = (x[goes_on] for x in (free, state, rank, end, seed))
            if not len(free):
                break
            chosen = lattice.draw(state, _uniform(seed, rank))
            kept_word.append(free)
            kept_rank.append(rank)
            kept_edge.append(chosen)
            state, rank = lattice.target[chosen], rank + 1
        path = Path(np.concatenate(kept_word), np.concatenate(kept_rank), np.concatenate(kept_edge), n_words)
        owner = text_of[path.word]
        begin = np.searchsorted(owner, np.arange(n))
        log = lattice.log[path.edge]
        reach = np.concatenate([[0.0], np.cumsum(log)])
        stop = np.append(begin[1:], len(owner))
        before = reach[:-1] - np.repeat(reach[begin], stop - begin)
        total = reach[stop] - reach[begin]
        paths.append((path, begin))
        logs.append(total)
        # unchosen edges of the new part become nodes
        after = np.where(np.array([x[1] if x else -1 for x in taken]) >= 0, node, -1)

        def opened(spots):
            number = spots - begin[owner[spots]]
            state = lattice.source[path.edge[spots]]
            degree = lattice.first[state + 1] - lattice.first[state]
            keep = (degree > 1) & (number > after[owner[spots]]) & alive[owner[spots]]
            spots, number, degree = spots[keep], number[keep], degree[keep]
            first_edge = lattice.first[lattice.source[path.edge[spots]]]
            which, number = np.repeat(spots, degree), np.repeat(number, degree)
            edges = np.repeat(first_edge - (np.cumsum(degree) - degree), degree) + np.arange(degree.sum())
            other = edges != path.edge[which]
            which, edges, number, nth_edge = which[other], edges[other], number[other], (edges - np.repeat(first_edge, degree))[other]
            mass = before[which] + lattice.log[edges]
            limit = value[owner[which]]
            u = _uniform(seeds[owner[which]], turn + 1, number, nth_edge, 7)
            g = mass - np.log(np.exp(np.minimum(mass - limit, 700)) - np.log(u))
            text = owner[which]
            high = g > value[text] - 12  # sort only those, where they are enough
            use = np.flatnonzero(high | (np.bincount(text[high], minlength=n) <= k)[text])
            best = use[np.lexsort((-g[use], text[use]))]
            nth = np.arange(len(best)) - np.searchsorted(text[best], text[best])
            for i in best[nth <= k].tolist():
                heapq.heappush(queues[text[i]], (-g[i], turn, int(number[i]), int(edges[i]), float(mass[i])))

        opened(np.flatnonzero(before > -DEEP))
        # `k - turn` nodes are still to be taken; those that cannot be among them are left
        deep = before <= -DEEP
        least = np.array([-heapq.nsmallest(k - turn, own)[-1][0] if len(own) >= k - turn else -np.inf for own in queues])
        opened(np.flatnonzero(deep & (before + REACH > np.repeat(least, stop - begin))))
        for t in range(n):
            if taken[t] is not None:
                found[t].append((turn, taken[t][3]))
            taken[t] = None
            if queues[t]:
                top = heapq.heappop(queues[t])
                taken[t] = (top[1], top[2], top[3], -top[0], top[4])
        if all(x is None for x in taken):
            break
    ids = [_spelled(lattice.piece[path.edge], begin, known) for path, begin in paths]
    out = []
    for t in range(n):
        threshold = taken[t][3] if taken[t] is not None else -np.inf
        rows = []
        for turn, g in found[t]:
            flat, begin = ids[turn]
            log = float(logs[turn][t])
            rows.append((flat[begin[t] : begin[t + 1]], log, g, 1.0 if threshold == -np.inf else float(-np.expm1(-np.exp(log - threshold)))))
        out.append(rows)
    return out


def decode(ids: np.ndarray, known: Vocabulary) -> bytes:
    """The text as UTF-8."""
    ids = np.asarray(ids, dtype=np.int64)
    size, start = known.size[ids], known.start[ids]
    flat = known.flat[np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())].tobytes()
    return flat[1:] if flat[:1] == b" " else flat


def segmentations(rows: DataFrame, k: int = SAMPLES, path: str = MODEL, key: str = "doc_id", text: str = "text", with_ids: bool = True) -> DataFrame:
    """doc_id, sample (from 1), n_pieces, ids_crc32, log_prob, perturbed, inclusion, decodes, and with `with_ids` the ids."""
    kind = common.kind(common.columns(rows, doc_id=key), "doc_id")
    rows = common.columns(rows, doc_id=key, text=text).withColumn("seed", F.xxhash64(F.col("doc_id").cast("string")))

    def sampled(batches):
        known = vocabulary(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                some = batch.slice(at, 1000)
                texts = [x or "" for x in some.column("text").to_pylist()]
                seeds = some.column("seed").to_numpy().view(np.uint64)
                full = [i for i, x in enumerate(texts) if x]
                found = [[(np.zeros(0, np.uint32), 0.0, float(-np.log(-np.log(u))), 1.0)] for u in _uniform(seeds, 0)]
                if full:
                    for i, own in zip(full, sample([texts[i] for i in full], seeds[full], known, k), strict=True):
                        found[i] = own
                flat = [(i, nth, *row) for i, own in enumerate(found) for nth, row in enumerate(own, 1)]
                owner, nth, ids, log, g, inclusion = zip(*flat, strict=True)
                plain = [x.encode("utf-8", "surrogatepass") for x in texts]
                arrays = [
                    some.column("doc_id").take(pa.array(owner)), pa.array(nth, pa.int32()), pa.array([len(x) for x in ids]),
                    pa.array([zlib.crc32(x) for x in ids], pa.int64()), pa.array(np.round(log, DIGITS)), pa.array(np.round(g, DIGITS)), pa.array([float(f"{x:.{DIGITS}g}") for x in inclusion]),
                    pa.array([decode(x, known) == plain[i] for i, x in zip(owner, ids, strict=True)]),
                ]
                if with_ids:
                    ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                    arrays.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids).astype(np.int32))))
                yield pa.RecordBatch.from_arrays(arrays, names)

    shape = f"doc_id {kind}, sample int, n_pieces long, ids_crc32 long, log_prob double, perturbed double, inclusion double, decodes boolean"
    names = ["doc_id", "sample", "n_pieces", "ids_crc32", "log_prob", "perturbed", "inclusion", "decodes"]
    if with_ids:
        shape, names = f"{shape}, ids array<int>", [*names, "ids"]
    return rows.mapInArrow(sampled, shape)

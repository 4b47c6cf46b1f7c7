"""Secret scans: a character convolutional network over every candidate and its surrounding context.

Base findings, per kind leftmost and without overlap: `assign` (a keyword, `:` or `=`, and a value of 12 or more
characters), `access` (key ids) and `hex` (16 or more hex digits). Candidates are all runs of 12 or more
key-like characters with a digit and a letter, or 16 or more hex digits. The network reads windows of `MIDDLE`
characters, one every `STEP` and one at the end, over the whole candidate, each with the `AROUND` characters before and behind
the candidate. It embeds, convolves and pools them over the window and over the context, and gives a probability; a
candidate has its windows' largest. It is trained in numpy on labelled findings: windows that a base finding touches count as
secrets, those of candidates without a base finding as none, and the other windows of candidates with one are not learned
from; to keep it from learning the keywords alone, training also shows each window with its context blanked.

It learns from the candidates of all texts, with all their windows; candidates that are equal with their context are one. Both classes weigh the same.
Spark deals the windows into parts of `PART` or fewer, but for chance; in each of `ROUNDS` rounds every part is gone through once from the same state, and the
states that they come to are averaged. About a fifth of the candidates of either class, held back from training by a hash, calibrates the
probability (Platt, then moved to the share of secrets in all rows) and sets the threshold: the largest one, but for rounding, that still
finds at least `RECALL` of their secrets, however low. Their logits reach the driver as counts by thousandths. A class of which all or none are held back is used for both. Candidates at or
above the threshold that base findings do not cover whole are added, whole, as kind `model`.

Defined cases: null texts count as empty; without both kinds of labelled candidates nothing is added.
Offsets are code points, ends exclusive. Repeated rows are judged alike.
"""

from __future__ import annotations

import hashlib
import pickle
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm import common

ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
KEYWORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
KINDS = ("assign", "access", "hex", "model")
#: Rows where a base finding has a digit, so that a candidate touches it; it only decides which rows are drawn.
ROWS = (
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?(?=[A-Za-z+/_.=-]*+[0-9])[A-Za-z0-9+/_.=-]{12,}"""
    r"|AKIA(?=[A-Z]*+[0-9])[A-Z0-9]{14,}|(?<![0-9a-f])(?=[a-f]*+[0-9])[0-9a-f]{16,}"
)

AROUND, MIDDLE = 20, 44
LENGTH = AROUND + MIDDLE + AROUND
STEP = MIDDLE // 4
SIZE, FILTERS, WIDTH = 8, 16, 5
PART, ROUNDS = 5_000, 6
RECALL = 0.98
MASK = "[SECRET]"


def _class(test) -> np.ndarray:
    return np.array([test(chr(i)) for i in range(128)] + [False])


_HEX = _class(lambda c: c in "0123456789abcdef")
_KEY = _class(lambda c: c.isascii() and (c.isalnum() or c in "+/_.=-"))
_DIGIT = _class(str.isdigit)
_ALPHA = _class(lambda c: c.isascii() and c.isalpha())


def _runs(inside: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
    start, end = edge[::2], edge[1::2]
    long = end - start >= least
    return start[long], end[long]


def findings(texts: list[str]) -> tuple[list[list[tuple[int, int, str]]], list[list[tuple[int, int]]], np.ndarray, np.ndarray]:
    """Base findings and candidates of each text; all code points (128 for others than ASCII) and where each text starts there.

    A blank parts the texts, so no run spans two of them.
    """
    points, lengths = common.code_points([f"{text}\n" for text in texts])
    points = np.minimum(points, 128)
    begin = np.concatenate([[0], np.cumsum(lengths)])
    base = [[] for _ in texts]
    for i, text in enumerate(texts):
        low = text.lower()
        if any(word in low for word in KEYWORDS):
            base[i] += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
        if "AKIA" in text:
            base[i] += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    candidates = [[] for _ in texts]
    hex_start, hex_end = _runs(_HEX[points], 16)
    for i, a, b in zip(np.searchsorted(begin, hex_start, "right") - 1, hex_start, hex_end, strict=True):
        base[i].append((int(a - begin[i]), int(b - begin[i]), "hex"))
    start, end = _runs(_KEY[points], 12)
    if len(start):
        digits, letters = (np.add.reduceat(np.append(k[points], False).astype(np.int32), np.stack([start, end], 1).ravel())[::2] for k in (_DIGIT, _ALPHA))
        whole_hex = np.isin(start, hex_start) & (digits > 0)
        for i, a, b in zip(*(x[(digits > 0) & (letters > 0) | whole_hex] for x in (np.searchsorted(begin, start, "right") - 1, start, end)), strict=True):
            candidates[i].append((int(a - begin[i]), int(b - begin[i])))
    order = {kind: k for k, kind in enumerate(KINDS)}
    for spans in base:
        spans.sort(key=lambda x: (x[0], order[x[2]]))
    return base, candidates, points, begin


def _covered(base: list[list[tuple[int, int, str]]], begin: np.ndarray) -> np.ndarray:
    """How many of the code points before each place lie in base findings."""
    edge = np.zeros(begin[-1] + 1, dtype=np.int32)
    for i, spans in enumerate(base):
        for a, b, _ in spans:
            edge[begin[i] + a] += 1
            edge[begin[i] + b] -= 1
    return np.concatenate([[0], np.cumsum(np.cumsum(edge) > 0)])


def windows(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The candidate of each window, and how many of its characters lie before the window."""
    last = np.maximum(sizes - MIDDLE, 0)
    n = 1 - (-last // STEP)
    owner = np.repeat(np.arange(len(sizes)), n)
    return owner, np.minimum((np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)) * STEP, last[owner])


def inputs(points: np.ndarray, low: np.ndarray, high: np.ndarray, start: np.ndarray, end: np.ndarray, skip: np.ndarray) -> np.ndarray:
    """A row of `LENGTH` symbols per window: the candidate's context, `MIDDLE` characters from `skip` on, context. 0 stands for nothing."""
    place = np.arange(LENGTH)
    inner = np.minimum(end - start, MIDDLE)[:, None]
    at = np.where(place < AROUND + inner, start[:, None] - AROUND + place, end[:, None] + place - AROUND - inner)
    at = at + np.where((place >= AROUND) & (place < AROUND + inner), skip[:, None], 0)
    valid = (at >= low[:, None]) & (at < high[:, None]) & (place < 2 * AROUND + inner)
    return np.where(valid, points[np.clip(at, 0, max(0, len(points) - 1))], 0).astype(np.int16)


class Network:
    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        normal = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        self.p = {
            "embed": normal(129, SIZE, scale=0.5), "conv": normal(WIDTH * SIZE, FILTERS, scale=0.2), "shift": np.zeros(FILTERS, np.float32),
            "out": normal(2 * FILTERS, scale=0.3), "bias": np.zeros(1, np.float32),
        }
        self.scale, self.move, self.threshold = 1.0, 0.0, 2.0

    def run(self, symbols: np.ndarray, sizes: np.ndarray, keep: bool = False):
        p = self.p
        padded = np.pad(symbols, ((0, 0), (WIDTH // 2, WIDTH // 2)))
        embedded = p["embed"][padded] * (padded > 0)[:, :, None]
        windows = np.lib.stride_tricks.sliding_window_view(embedded, WIDTH, axis=1).transpose(0, 1, 3, 2).reshape(len(symbols), LENGTH, WIDTH * SIZE)
        hidden = np.maximum(windows @ p["conv"] + p["shift"], 0)
        place = np.arange(LENGTH)
        inner = (place >= AROUND) & (place < AROUND + np.minimum(sizes, MIDDLE)[:, None])
        masks = [inner[:, :, None], ~inner[:, :, None]]
        pooled = np.concatenate([(hidden * masks[0]).sum(1) / masks[0].sum(1), (hidden * masks[1]).max(1)], axis=1)
        logit = pooled @ p["out"] + p["bias"][0]
        return (logit, padded, windows, hidden, masks, pooled) if keep else logit

    def gradient(self, symbols, sizes, target, weight=1.0):
        logit, padded, windows, hidden, masks, pooled = self.run(symbols, sizes, keep=True)
        p, n = self.p, len(symbols)
        d = (weight * (1 / (1 + np.exp(-logit)) - target) / n).astype(p["out"].dtype)
        g = {"out": pooled.T @ d, "bias": np.array([d.sum()])}
        dpooled = d[:, None] * p["out"]
        dhidden = masks[0] * (dpooled[:, None, :FILTERS] / masks[0].sum(1)[:, :, None])
        top = (hidden * masks[1]).argmax(1)
        rows, cols = np.arange(n)[:, None], np.arange(FILTERS)
        dhidden[rows, top, cols] += dpooled[:, FILTERS:] * masks[1][rows, top, 0]
        dhidden *= hidden > 0
        g["shift"] = dhidden.sum((0, 1))
        g["conv"] = np.einsum("nlk,nlf->kf", windows, dhidden, optimize=True)
        dwindows = (dhidden @ p["conv"].T).reshape(n, LENGTH, WIDTH, SIZE)
        g["embed"] = np.zeros_like(p["embed"])
        for k in range(WIDTH):
            seen = padded[:, k : k + LENGTH]
            np.add.at(g["embed"], seen, dwindows[:, :, k] * (seen > 0)[:, :, None])
        return float(np.mean(weight * (np.logaddexp(0, logit) - target * logit))), g

    def probability(self, symbols, sizes) -> np.ndarray:
        logit = np.concatenate([self.run(symbols[i : i + 512], sizes[i : i + 512]) for i in range(0, len(symbols), 512)] or [np.zeros(0)]).astype(float)
        return 1 / (1 + np.exp(-(self.scale * logit + self.move)))


class Candidates:
    """All candidates of some texts, and their windows."""

    def __init__(self, texts: list[str]):
        self.base, found, self.points, begin = findings(texts)
        self.flat = [(i, a, b) for i, spans in enumerate(found) for a, b in spans]
        owner, start, end = (np.array([x[k] for x in self.flat], dtype=np.int64) for k in range(3))
        self.sizes, self.low, self.high = end - start, begin[owner], begin[owner + 1] - 1
        self.start, self.end = self.low + start, self.low + end
        self.covered = _covered(self.base, begin)
        self.inside = self.covered[self.end] - self.covered[self.start]
        self.owner, self.skip = windows(self.sizes)

    def symbols(self, some) -> np.ndarray:
        own = self.owner[some]
        return inputs(self.points, self.low[own], self.high[own], self.start[own], self.end[own], self.skip[some])

    def touched(self, some) -> np.ndarray:
        """Which windows have a character of a base finding."""
        at = self.start[self.owner[some]] + self.skip[some]
        return self.covered[at + np.minimum(self.sizes[self.owner[some]], MIDDLE)] > self.covered[at]

    def probability(self, model: Network) -> np.ndarray:
        """Each candidate's largest of all its windows."""
        largest = np.zeros(len(self.flat))
        for i in range(0, len(self.owner), 512):
            some = slice(i, i + 512)
            own = self.owner[some]
            np.maximum.at(largest, own, model.probability(self.symbols(some), self.sizes[own]))
        return largest

    def contexts(self):
        """For each candidate its characters with `AROUND` before and behind it, 0 outside of the text, and which of its windows base findings touch."""
        marks = self.touched(slice(None))
        first = np.searchsorted(self.owner, np.arange(len(self.flat) + 1))
        for i, (low, high, start, end) in enumerate(zip(self.low, self.high, self.start - AROUND, self.end + AROUND, strict=True)):
            inner = self.points[max(low, start) : min(high, end)].astype(np.uint8).tobytes()
            yield bytes(max(0, low - start)) + inner + bytes(max(0, end - high)), marks[first[i] : first[i + 1]].tobytes()


def unpacked(contexts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The symbols of all windows of some candidates in their contexts, the windows' candidates, and the candidates' sizes."""
    lengths = np.array([len(x) for x in contexts], dtype=np.int64)
    points, high = np.frombuffer(b"".join(contexts), dtype=np.uint8), np.cumsum(lengths)
    owner, skip = windows(lengths - 2 * AROUND)
    low = (high - lengths)[owner]
    return inputs(points, low, high[owner], low + AROUND, high[owner] - AROUND, skip), owner, lengths - 2 * AROUND


def _largest(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    out = np.full(n, -np.inf)
    np.maximum.at(out, owner, values)
    return out


class Learner:
    """A network on its way: its parameters and the running means of their gradients."""

    def __init__(self, seed: int = 3):
        self.model, self.steps = Network(seed), 0
        self.first, self.second = ({k: np.zeros_like(v) for k, v in self.model.p.items()} for _ in range(2))

    def round(self, x: np.ndarray, sizes: np.ndarray, y: np.ndarray, weight: np.ndarray, rng, rate: float = 0.005) -> None:
        """Once through all windows."""
        mixed = rng.permutation(len(x))
        for i in range(0, len(mixed), 128):
            some = mixed[i : i + 128]
            _, g = self.model.gradient(x[some], sizes[some], y[some], weight[some])
            self.steps += 1
            for name, grad in g.items():
                self.first[name] = 0.9 * self.first[name] + 0.1 * grad
                self.second[name] = 0.999 * self.second[name] + 0.001 * grad * grad
                change = (self.first[name] / (1 - 0.9**self.steps)) / (np.sqrt(self.second[name] / (1 - 0.999**self.steps)) + 1e-8)
                self.model.p[name] -= (rate * change).astype(np.float32)

    def average(self, others: list[tuple[Learner, int]]) -> None:
        """Becomes the mean of others, weighted."""
        total = sum(n for _, n in others)
        self.steps = max(other.steps for other, _ in others)
        for name, old in self.model.p.items():
            self.model.p[name] = (sum(other.model.p[name] * (n / total) for other, n in others)).astype(old.dtype)
            self.first[name] = sum(other.first[name] * (n / total) for other, n in others)
            self.second[name] = sum(other.second[name] * (n / total) for other, n in others)


def _with_bare(symbols: np.ndarray, sizes: np.ndarray, y: np.ndarray, weight: np.ndarray):
    """The windows, and once more with their context blanked; `sizes` has an entry per window."""
    bare = symbols.copy()
    place = np.arange(LENGTH)
    bare[(place < AROUND) | (place >= AROUND + np.minimum(sizes, MIDDLE)[:, None])] = 0
    return np.concatenate([symbols, bare]), np.tile(sizes, 2), np.tile(y, 2).astype(np.float32), np.tile(weight, 2).astype(np.float32)


def _logits(model: Network, symbols: np.ndarray, sizes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """The largest of each candidate's windows."""
    logit = np.concatenate([model.run(symbols[i : i + 512], sizes[owner[i : i + 512]]) for i in range(0, len(symbols), 512)] or [np.zeros(0)])
    return _largest(logit, owner, len(sizes))


def calibrate(model: Network, logit: np.ndarray, secret: np.ndarray, n: np.ndarray, share: float | None = None) -> None:
    """Scale, shift and threshold from the logits of candidates held back, `n` of each. `share` is that of secrets in all rows."""
    y, n = secret.astype(float), n / n.sum()
    a, b = 1.0, 0.0
    for _ in range(100):
        fit = 1 / (1 + np.exp(-(a * logit + b)))
        w = fit * (1 - fit) + 1e-6
        grad = np.array([(n * (fit - y) * logit).sum() + 1e-3 * (a - 1), (n * (fit - y)).sum()])
        hess = np.array([[(n * w * logit * logit).sum() + 1e-3, (n * w * logit).sum()], [(n * w * logit).sum(), (n * w).sum()]])
        change = np.clip(np.linalg.solve(hess, grad), -0.5, 0.5)
        a, b = max(a - change[0], 1e-3), b - change[1]
    held = (n * y).sum()
    if share:
        b += np.log(share / (1 - share)) - np.log(held / (1 - held))
    model.scale, model.move = float(a), float(b)
    order = np.flatnonzero(secret)[np.argsort(logit[secret])]
    missed = np.cumsum(n[order]) / held
    least = logit[order[np.searchsorted(missed, 1 - RECALL + 1e-12, "right")]]
    # a text's own logit may be rounded otherwise than here
    model.threshold = float(1 / (1 + np.exp(-(a * (least - 1e-4) + b))))


def train(
    symbols: np.ndarray, sizes: np.ndarray, touched: np.ndarray, owner: np.ndarray, secret: np.ndarray, held: np.ndarray,
    rounds: int = ROUNDS, rate: float = 0.005, seed: int = 3, share: float | None = None,
) -> Network:
    """Learns from the windows of candidates not held back; `sizes`, `secret` and `held` have an entry per candidate.

    Where all or none of a class are held back, it is used for both. `share` is that of secrets in all rows.
    """
    learned, held = ~held, held.copy()
    for own in (secret, ~secret):
        learned[own] |= not learned[own].any()
        held[own] |= not held[own].any()
    learner, rng = Learner(seed), np.random.default_rng(seed)
    use = learned[owner] & (touched | ~secret[owner])
    x, s, y, weight = _with_bare(symbols[use], sizes[owner[use]], touched[use], np.ones(use.sum()))
    for _ in range(rounds):
        learner.round(x, s, y, weight, rng, rate)
    if held.any() and 0 < secret[held].mean() < 1:
        calibrate(learner.model, _logits(learner.model, symbols, sizes, owner)[held], secret[held], np.ones(held.sum()), share)
    return learner.model


def examples(rows: DataFrame, text: str = "text") -> DataFrame:
    """Each distinct candidate in its context: context, secret, touched (of its windows), n (how often it occurs in `rows`, weighted by their column n)."""

    def found(batches):
        for batch in batches:
            texts = batch[text].tolist()
            for part in common.pieces(texts, 4_000_000):
                candidates = Candidates(texts[part])
                contexts, touched = zip(*candidates.contexts(), strict=True) if candidates.flat else ((), ())
                own = np.array([i for i, _, _ in candidates.flat], dtype=np.int64)
                yield pd.DataFrame({"context": contexts, "secret": candidates.inside > 0, "touched": touched, "n": batch["n"].to_numpy()[part][own]})

    every = rows.select(text, F.col("n").cast("double").alias("n")).mapInPandas(found, "context binary, secret boolean, touched binary, n double")
    return every.groupBy("context", "secret").agg(F.min("touched").alias("touched"), F.sum("n").alias("n"))


def fit(rows: DataFrame, text: str = "text", sample: int | None = None) -> Network:
    """Trains on the candidates of all rows, on Spark. For trials: of about `sample` rows, half of them with a base finding, on the driver."""
    rows = common.columns(rows, text=text).filter(F.col("text").rlike("[0-9]"))
    if sample is not None:
        return _fit_some(rows, sample)
    known = common.written(examples(rows.withColumn("n", F.lit(1))), "candidates").withColumn("held", F.pmod(F.xxhash64("context", "secret"), F.lit(5)) == 0)
    # a candidate's windows that train, in the classes that they are marked with
    used = F.when(F.col("secret"), F.length(F.replace(F.hex("touched"), F.lit("00"), F.lit(""))) / 2).otherwise(F.length("touched"))
    counts = known.groupBy("secret").agg(
        F.count("*").alias("all"), F.count_if("held").alias("held"), F.sum("n").alias("n"), F.sum(used).alias("windows"), F.sum(F.when(~F.col("held"), used)).alias("learned"),
    ).collect()
    counts = {r.secret: r for r in counts}
    if len(counts) < 2:
        return Network()
    whole = [k for k, r in counts.items() if r["held"] in (0, r["all"])]  # classes used for both
    both = F.col("secret").isin(whole)
    total = {k: (r["windows"] if k in whole else r["learned"]) for k, r in counts.items()}
    weight = {k: sum(total.values()) / 2 / n for k, n in total.items()}
    parts = -(-int(sum(total.values())) // PART)
    learned = known.filter(both | ~F.col("held")).select("context", "secret", "touched", F.pmod(F.xxhash64("secret", "context", F.lit(1)), F.lit(parts)).alias("part"))
    learner = Learner()
    for turn in range(ROUNDS):
        learner.average(_one_round(learned, parts, learner, weight, turn))
    logits = _held_back(known.filter(both | F.col("held")), learner.model)
    share = counts[True].n / (counts[True].n + counts[False].n)
    calibrate(learner.model, np.array([r.logit for r in logits]), np.array([r.secret for r in logits]), np.array([float(r.n) for r in logits]), share)
    return learner.model


def _one_round(learned: DataFrame, parts: int, before: Learner, weight: dict[bool, float], turn: int) -> list[tuple[Learner, int]]:
    """Where each part comes to from one state, and of how many windows."""

    def trained(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["context", "secret"])
        symbols, owner, sizes = unpacked(part["context"])
        touched, secret = np.frombuffer(b"".join(part["touched"]), dtype=bool), part["secret"].to_numpy(dtype=bool)
        use = touched | ~secret[owner]
        windows = _with_bare(symbols[use], sizes[owner[use]], touched[use], np.where(secret[owner[use]], weight[True], weight[False]))
        learner = pickle.loads(pickle.dumps(before))
        learner.round(*windows, np.random.default_rng((turn, int(part["part"].iloc[0]))))
        return pd.DataFrame({"part": part["part"].iloc[:1], "state": [pickle.dumps(learner)], "n": [int(use.sum())]})

    # a part is a task: by itself Spark would put many small ones together
    rows = learned.repartition(parts, "part").groupBy("part").applyInPandas(trained, "part long, state binary, n long").collect()
    return [(pickle.loads(r.state), r.n) for r in sorted(rows, key=lambda r: r.part) if r.n]


def _held_back(held: DataFrame, model: Network) -> list:
    """How many candidates of either class have a logit, rounded down to thousandths."""

    def judged(batches):
        for batch in batches:
            symbols, owner, sizes = unpacked(batch["context"])
            logit = np.floor(np.clip(_logits(model, symbols, sizes, owner), -60, 60) * 1000) / 1000
            yield pd.DataFrame({"secret": batch["secret"], "logit": logit})

    return held.select("context", "secret").mapInPandas(judged, "secret boolean, logit double").groupBy("secret", "logit").agg(F.count("*").alias("n")).orderBy("logit", "secret").collect()


def _fit_some(rows: DataFrame, sample: int) -> Network:
    rows = rows.withColumn("marked", F.col("text").rlike(ROWS))
    texts = rows.groupBy("marked").agg(F.approx_count_distinct(F.xxhash64("text")).alias("n"))
    rate = {True: 1.0, False: 1.0} | {r.marked: min(1.0, sample / 2 / r.n) for r in texts.collect()}
    chance = F.when(F.col("marked"), F.lit(rate[True])).otherwise(F.lit(rate[False]))
    draw = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # copies of texts, and of candidates in the same context, are collapsed before they are collected
    chosen = rows.filter(draw < chance).groupBy("text", "marked").agg((F.count("*") / chance).alias("n"))
    chosen = examples(chosen).toPandas().sort_values(["context", "secret"])
    secret = chosen["secret"].to_numpy(dtype=bool)
    if not len(chosen) or secret.all() or not secret.any():
        return Network()
    symbols, owner, sizes = unpacked(chosen["context"])
    touched = np.frombuffer(b"".join(chosen["touched"]), dtype=bool)
    held = (chosen.groupby("secret").cumcount() % 5 == 0).to_numpy()
    weight = chosen["n"].to_numpy()
    return train(symbols, sizes, touched, owner, secret, held, share=float(weight[secret].sum() / weight.sum()))


def spans(texts: list[str | None], model: Network) -> list[list[tuple[int, int, str, float]]]:
    """Each text's findings in order, with the model's probability (1 for base findings)."""
    out = []
    known = ["" if text is None else text for text in texts]
    for part in common.pieces(known, 4_000_000):
        candidates = Candidates(known[part])
        found = [[(a, b, kind, 1.0) for a, b, kind in own] for own in candidates.base]
        for (i, a, b), p, inside in zip(candidates.flat, candidates.probability(model), candidates.inside, strict=True):
            if p >= model.threshold and inside < b - a:
                found[i].append((a, b, "model", float(p)))
        out += [sorted(own, key=lambda x: (x[0], KINDS.index(x[2]))) for own in found]
    return out


def scan(rows: DataFrame, model: Network, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and findings (start, end, kind, probability) for every row."""
    rows = common.columns(rows, doc_id=key, text=text)
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def found(batches):
        for batch in batches:
            own = spans(batch["text"].tolist(), shared.value)
            yield pd.DataFrame({"doc_id": batch["doc_id"].to_numpy(), "findings": [[{"start": a, "end": b, "kind": k, "probability": p} for a, b, k, p in x] for x in own]})

    kind = common.kind(rows, "doc_id")
    return rows.mapInPandas(found, f"doc_id {kind}, findings array<struct<start: long, end: long, kind: string, probability: double>>")


def digest(found: DataFrame) -> DataFrame:
    """Counts by kind, the hash of the base findings and all findings as text."""
    as_text = lambda x: F.concat_ws(",", F.transform(x, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))))
    of = lambda kind: F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", of("assign"), of("access"), of("hex"),
        F.sha2(as_text(F.filter("findings", lambda f: f["kind"] != "model")).cast("binary"), 256).alias("base_sha256"),
        as_text(F.col("findings")).alias("spans"), of("model"),
    )


def masked(text: str | None, found) -> str | None:
    """The text with its findings, overlapping ones as one, replaced by `MASK`."""
    if text is None or not found:
        return text
    parts, at, reach = [], 0, -1
    for a, b, *_ in sorted(found):
        if a >= reach:
            parts += [text[at:a], MASK]
        at = reach = max(reach, b)
    return "".join([*parts, text[at:]])


def mask(rows: DataFrame, model: Network, text: str = "text", length: str = "n_chars") -> DataFrame:
    """All rows and columns, with findings masked in the text and, where that changed it, the length set anew."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def changed(batches):
        import pyarrow as pa

        for batch in batches:
            names = batch.schema.names
            before = batch.column(names.index(text)).to_pylist()
            after = [masked(x, own) for x, own in zip(before, spans(before, shared.value), strict=True)]
            batch = batch.set_column(names.index(text), batch.schema.field(text), pa.array(after, batch.schema.field(text).type))
            if length in names:
                old = batch.column(names.index(length)).to_pylist()
                new = [n if x == y else len(y) for n, x, y in zip(old, before, after, strict=True)]
                batch = batch.set_column(names.index(length), batch.schema.field(length), pa.array(new, batch.schema.field(length).type))
            yield batch

    return rows.mapInArrow(changed, rows.schema)

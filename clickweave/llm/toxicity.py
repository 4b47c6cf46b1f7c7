"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word's input is the embedding of its hash plus those of its hashed character 4- and 5-grams. Windows of `WINDOW`
words start every `STRIDE` words; every window of every text is scored, and a text's logit is its largest
window's, calibrated on training texts held back. Labels mark texts, not windows, so training takes, round by round,
each toxic text's strongest window and, of each other text, the strongest and another one.

Fitted on at most about `SAMPLE` toxic and twice as many other labelled rows, chosen by a hash of the text; copies are
collapsed before they are collected. Embeddings start from the
class log-odds of their feature in that sample.

Defined cases: null and empty texts are scored as one window of no words. Without labelled rows of both
classes every score is the share of class 1 (0 without any). Repeated rows score alike.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm import common

WORDS, CHARS = 1 << 15, 1 << 17
ORDERS = (4, 5)
SIZE, HIDDEN = 8, 8
WINDOW, STRIDE = 32, 16
SAMPLE = 1200
GATES = 3 * HIDDEN
#: Steps of 256 windows in a round of training at least, in all at most; rounds without a better loss before it ends.
STEPS_A_ROUND, MOST_STEPS, PATIENCE = 15, 300, 3
LEAST_SLOPE = 0.05


def _features(words: list[str]) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Word buckets, and for each order the character n-gram buckets, one word after the other, with each word's start."""
    if not words:
        return np.zeros(0, np.int64), [(np.zeros(0, np.int64), np.zeros(1, np.int64)) for _ in ORDERS]
    points, lengths = common.code_points([f"<{word}>" for word in words])
    begin = np.cumsum(lengths) - lengths
    place = (np.arange(len(points)) - np.repeat(begin, lengths)).astype(np.uint32)
    mixed = (points ^ place * np.uint32(0x9E3779B1)) * np.uint32(0xC2B2AE35)
    mixed ^= mixed >> np.uint32(16)
    word = (np.add.reduceat(mixed, begin, dtype=np.uint32) * np.uint32(0x27D4EB2F)) >> np.uint32(17)
    left, grams = np.repeat(lengths, lengths) - place, []
    for order in ORDERS:
        stop = max(0, len(points) - order + 1)
        mixed = np.full(stop, order, dtype=np.uint32)
        for step in range(order):
            mixed = (mixed ^ points[step : step + stop]) * np.uint32(0x85EBCA6B)
            mixed ^= mixed >> np.uint32(13)
        own = mixed[left[:stop] >= order] & np.uint32(CHARS - 1)
        grams.append((own.astype(np.int64), np.concatenate([[0], np.cumsum(np.maximum(0, lengths - order + 1))])))
    return word.astype(np.int64), grams


class Batch:
    """Texts as windows over the table of their distinct words; the last entry of that table is no word."""

    def __init__(self, texts: list[str | None]):
        split = [(text or "").lower().split() for text in texts]
        codes, distinct = pd.factorize(np.array([word for words in split for word in words], dtype=object))
        self.words = list(distinct)
        self.word, self.grams = _features(self.words)
        sizes = np.array([len(words) for words in split], dtype=np.int64)
        per_text = np.maximum(1, -(-(sizes - WINDOW) // STRIDE) + 1)
        self.owner = np.repeat(np.arange(len(texts)), per_text)
        self.first = np.concatenate([[0], np.cumsum(per_text)])
        begin = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        nth = np.arange(len(self.owner)) - np.repeat(self.first[:-1], per_text)
        at = (nth * STRIDE)[:, None] + np.arange(WINDOW)
        inside = at < sizes[self.owner][:, None]
        spots = np.where(inside, at + begin[self.owner][:, None], len(codes))
        self.windows = np.append(codes, len(self.words))[spots].astype(np.int32)

    def embedded(self, model: "Network", words: np.ndarray | None = None) -> np.ndarray:
        """A row per word (of all, or of `words`), then one of zeros."""
        out = np.zeros((len(self.words if words is None else words) + 1, SIZE), dtype=np.float32)
        out[:-1] = model.p["word"][self.word if words is None else self.word[words]]
        for k in range(len(ORDERS)):
            gram, per_word = self.grams_of(k, words)
            has = np.flatnonzero(per_word)
            damp = (per_word[has] ** -0.5).astype(np.float32)[:, None]  # else long words would outweigh all others
            begin = np.concatenate([[0], np.cumsum(per_word[has])])
            for i in range(0, len(has), 20_000):  # in pieces that stay in cache
                j = min(i + 20_000, len(has))
                out[has[i:j]] += np.add.reduceat(model.p["char"][gram[begin[i] : begin[j]]], begin[i:j] - begin[i]) * damp[i:j]
        return out

    def grams_of(self, k: int, words: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """The n-gram buckets of the kth order, word after word, and how many each word has."""
        gram, starts = self.grams[k]
        if words is None:
            return gram, np.diff(starts)
        per_word = np.diff(starts)[words]
        shift = starts[words] - (np.cumsum(per_word) - per_word)
        return gram[np.repeat(shift, per_word) + np.arange(per_word.sum())], per_word


def _soft(x):
    """x / (1 + |x|): the gates' and states' nonlinearity, cheaper than exponentials; its slope is (1 - |y|)^2."""
    return x / (1 + np.abs(x))


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


class Inputs:
    """A word table's share of the gates, for either direction."""

    def __init__(self, model: "Network", embedded: np.ndarray, rows: int):
        self.sides, self.rows = [embedded @ model.p[f"x{side}"] + model.p[f"c{side}"] for side in "fb"], rows

    def __len__(self):
        return self.rows


class Network:
    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        normal = lambda *shape, scale=0.3: (rng.standard_normal(shape) * scale).astype(np.float32)
        self.p = {"word": normal(WORDS, SIZE, scale=0.01), "char": normal(CHARS, SIZE, scale=0.01)}
        for side in "fb":
            self.p |= {f"x{side}": normal(SIZE, GATES), f"h{side}": normal(HIDDEN, GATES), f"c{side}": np.zeros(GATES, np.float32)}
        self.p |= {"attend": normal(2 * HIDDEN), "out": normal(2 * HIDDEN), "bias": np.zeros(1, np.float32)}
        self.scale, self.shift = 1.0, 0.0

    def run(self, embedded: np.ndarray, windows: np.ndarray, keep: bool = False):
        """Logits of windows; with `keep`, also what the gradient needs. Axis 0 of the states is the direction."""
        n, real = len(windows), (windows != len(embedded) - 1).T[:, :, None]
        inputs = [embedded @ self.p[f"x{side}"] + self.p[f"c{side}"] for side in "fb"] if not isinstance(embedded, Inputs) else embedded.sides
        inner = np.stack([self.p["hf"], self.p["hb"]])
        states, h, steps = np.empty((2, WINDOW, n, HIDDEN), inner.dtype), np.zeros((2, n, HIDDEN), inner.dtype), []
        x = np.empty((2, n, GATES), inner.dtype)
        for t in range(WINDOW):
            back = WINDOW - 1 - t
            np.take(inputs[0], windows[:, t], axis=0, out=x[0])
            np.take(inputs[1], windows[:, back], axis=0, out=x[1])
            u = h @ inner
            gate = 0.5 + 0.5 * _soft(x[:, :, : 2 * HIDDEN] + u[:, :, : 2 * HIDDEN])
            z, r = gate[:, :, :HIDDEN], gate[:, :, HIDDEN:]
            new = _soft(x[:, :, 2 * HIDDEN :] + r * u[:, :, 2 * HIDDEN :])
            if keep:
                steps.append((h, z, r, u[:, :, 2 * HIDDEN :], new))
            h = new + z * (h - new)
            h[0] *= real[t]
            h[1] *= real[back]
            states[0, t], states[1, back] = h[0], h[1]
        raw = states[0] @ self.p["attend"][:HIDDEN] + states[1] @ self.p["attend"][HIDDEN:]
        raw = np.where(real[:, :, 0], raw, -30)
        weight = np.exp(raw - raw.max(axis=0))
        weight /= weight.sum(axis=0)
        values = states[0] @ self.p["out"][:HIDDEN] + states[1] @ self.p["out"][HIDDEN:]
        logit = (weight * values).sum(axis=0) + self.p["bias"][0]
        return (logit, states, weight, values, steps, real) if keep else logit

    def gradient(self, embedded, windows, target):
        """Mean cross entropy and its gradient; `embedded` holds the gradient of the word table."""
        logit, states, weight, values, steps, real = self.run(embedded, windows, keep=True)
        n, p, g = len(windows), self.p, {}
        loss = float(np.mean(np.logaddexp(0, logit) - target * logit))
        d = (_sigmoid(logit) - target) / n
        g["bias"] = np.array([d.sum()])
        dvalues = weight * d
        draw = dvalues * (values - (weight * values).sum(axis=0)) * real[:, :, 0]
        g["out"] = np.concatenate([np.einsum("tn,tnk->k", dvalues, states[k]) for k in (0, 1)])
        g["attend"] = np.concatenate([np.einsum("tn,tnk->k", draw, states[k]) for k in (0, 1)])
        dembedded = np.zeros_like(embedded)
        for k, side in enumerate("fb"):
            part = slice(k * HIDDEN, (k + 1) * HIDDEN)
            g[f"h{side}"], dinputs, dh = np.zeros_like(p[f"h{side}"]), np.zeros((len(embedded), GATES), p["out"].dtype), 0.0
            for t in range(WINDOW - 1, -1, -1):
                at = t if k == 0 else WINDOW - 1 - t
                h, z, r, un, new = (x[k] for x in steps[t])
                dnext = (dh + dvalues[at][:, None] * p["out"][part] + draw[at][:, None] * p["attend"][part]) * real[at]
                dnew = dnext * (1 - z) * (1 - np.abs(new)) ** 2
                dz = dnext * (h - new) * 0.5 * (1 - np.abs(2 * z - 1)) ** 2
                dr = dnew * un * 0.5 * (1 - np.abs(2 * r - 1)) ** 2
                du = np.concatenate([dz, dr, dnew * r], axis=1)
                g[f"h{side}"] += h.T @ du
                dh = dnext * z + du @ p[f"h{side}"].T
                np.add.at(dinputs, windows[:, at], np.concatenate([dz, dr, dnew], axis=1))
            g[f"x{side}"], g[f"c{side}"] = embedded.T @ dinputs, dinputs.sum(axis=0)
            dembedded += dinputs @ p[f"x{side}"].T
        g["embedded"] = dembedded
        return loss, g

    def window_logits(self, batch: Batch, some: int = 512) -> np.ndarray:
        """Logits to four digits. Blocks are full, so that no window's sums depend on how many others there are."""
        table = batch.embedded(self)
        inputs = Inputs(self, np.concatenate([table, np.zeros((-len(table) % some, SIZE), table.dtype)]), len(table))
        blank = np.full((-len(batch.windows) % some, WINDOW), len(table) - 1, np.int32)
        windows = np.concatenate([batch.windows, blank])
        found = np.concatenate([self.run(inputs, windows[i : i + some]) for i in range(0, len(windows), some)])
        return np.round(found[: len(batch.windows)], 4)

    def logits(self, texts: list[str | None]) -> np.ndarray:
        """Each text's largest window logit."""
        out = np.zeros(len(texts), np.float32)
        known = ["" if text is None else text for text in texts]
        for part in common.pieces(known, 16_000_000):
            batch = Batch(known[part])
            out[part] = np.maximum.reduceat(self.window_logits(batch), batch.first[:-1])
        return out

    def scores(self, texts: list[str | None]) -> np.ndarray:
        return _sigmoid(self.scale * self.logits(texts).astype(float) + self.shift) if len(texts) else np.zeros(0)


class Constant:
    """What is known without rows of both classes."""

    def __init__(self, share: float):
        self.share = share

    def scores(self, texts):
        return np.full(len(texts), self.share)


def _log_odds(seen: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """`seen` counts, by class and feature, the texts that hold it."""
    # ten more texts, dealt like the classes: rare features say little, unseen ones nothing
    share = [(seen[k] + 10 * (toxic == k).mean()) / ((toxic == k).sum() + 10 * (toxic == k).mean()) for k in (0, 1)]
    return np.log(share[1] / share[0]).astype(np.float32)


def _count(seen: np.ndarray, features: np.ndarray, texts: np.ndarray, toxic: np.ndarray) -> None:
    pairs = np.unique(texts * seen.shape[1] + features)
    for k in (0, 1):
        seen[k] += np.bincount(pairs[toxic[pairs // seen.shape[1]] == k] % seen.shape[1], minlength=seen.shape[1])


def _loss(top: np.ndarray, toxic: np.ndarray) -> float:
    """Cross entropy of texts after the best calibration, both classes counting alike."""
    a, b = _calibration(top, toxic)
    x = a * top + b
    each = np.logaddexp(0, x) - toxic * x
    return float(sum(each[toxic == k].mean() for k in (0, 1) if (toxic == k).any()))


def _calibration(top: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Slope, which stays positive, and shift that turn logits into probabilities, by Newton steps."""
    a, b = 1.0, 0.0
    for _ in range(200):
        fit = _sigmoid(a * top + b)
        grad = np.array([((fit - toxic) * top).mean() + 1e-3 * (a - 1), (fit - toxic).mean()])
        w = fit * (1 - fit) + 1e-6
        hess = np.array([[(w * top * top).mean() + 1e-3, (w * top).mean()], [(w * top).mean(), w.mean() + 1e-6]])
        change = np.clip(np.linalg.solve(hess, grad), -0.5, 0.5)
        a, b = max(LEAST_SLOPE, a - change[0]), b - change[1]
    return a, b


def train(
    texts: list[str], toxic: np.ndarray, share: float | None = None, rate: float = 0.01, seed: int = 7, part: int = STEPS_A_ROUND, patience: int = PATIENCE,
) -> Network:
    """`share`: of toxic texts among all labelled ones, if the given texts don't show it.

    Every eighth text of a class is held back. Training goes on, `part` steps or once through the sample a round, until their loss
    has not fallen for `patience` rounds, and the best round's parameters count.
    """
    model, batch, rng = Network(seed), Batch(texts), np.random.default_rng(seed)
    nth = np.zeros(len(texts), dtype=np.int64)
    for k in (0, 1):
        nth[toxic == k] = np.arange((toxic == k).sum())
    held = nth % 8 == 7
    if not all((held & (toxic == k)).any() for k in (0, 1)):
        held[:] = False
    judged = np.flatnonzero(held) if held.any() else np.arange(len(texts))
    owner = np.repeat(batch.owner, WINDOW)
    inside = batch.windows.ravel() < len(batch.words)
    occurs = np.unique(owner[inside].astype(np.int64) * len(batch.words) + batch.windows.ravel()[inside])
    text_of, word_of = occurs // max(1, len(batch.words)), occurs % max(1, len(batch.words))
    by_word, by_gram = np.zeros((2, WORDS), np.int64), np.zeros((2, CHARS), np.int64)
    for start in range(0, len(texts), 100):  # some texts at a time, to bound the memory
        some = slice(*np.searchsorted(text_of, [start, start + 100]))
        _count(by_word, batch.word[word_of[some]], text_of[some], toxic)
        grams, owners = [], []
        for k in range(len(ORDERS)):
            found, per_word = batch.grams_of(k, word_of[some])
            grams.append(found)
            owners.append(np.repeat(text_of[some], per_word))
        _count(by_gram, np.concatenate(grams), np.concatenate(owners), toxic)
    model.p["word"][:, 0] = np.clip(_log_odds(by_word, toxic), -1, 5)
    model.p["char"][:, 1] = np.clip(_log_odds(by_gram, toxic), -0.5, 4) / 2
    first, second = ({k: np.zeros_like(v) for k, v in model.p.items()} for _ in range(2))
    step, waited = 0, 0
    scores = model.window_logits(batch)
    largest = lambda: np.maximum.reduceat(scores, batch.first[:-1]).astype(float)[judged]
    best, top = {k: v.copy() for k, v in model.p.items()}, largest()
    least = _loss(top, toxic[judged])
    while waited < patience and step < MOST_STEPS:
        order = np.lexsort((scores, batch.owner))
        strongest = order[batch.first[1:] - 1]
        other = batch.first[:-1] + rng.integers(0, 1 << 30, len(texts)) % np.diff(batch.first)
        chosen = np.concatenate([strongest[~held], other[(toxic == 0) & ~held]])
        target = np.concatenate([toxic[~held], np.zeros(int(((toxic == 0) & ~held).sum()))]).astype(np.float32)
        steps = max(part, -(-len(chosen) // 256))
        mixed = np.concatenate([rng.permutation(len(chosen)) for _ in range(-(-steps * 256 // len(chosen)))])[: steps * 256]
        for i in range(0, len(mixed), 256):
            some = mixed[i : i + 256]
            used, windows = np.unique(batch.windows[chosen[some]], return_inverse=True)
            windows = windows.reshape(len(some), WINDOW)
            blank = used[-1] == len(batch.words)
            words = used[:-1] if blank else used
            table = batch.embedded(model, words)
            _, g = model.gradient(table, windows.astype(np.int32), target[some])
            change = g.pop("embedded")[:-1]
            step += 1
            for name, grad in g.items():
                first[name] = 0.9 * first[name] + 0.1 * grad
                second[name] = 0.999 * second[name] + 0.001 * grad * grad
                model.p[name] -= rate * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
            np.add.at(model.p["word"], batch.word[words], -rate * 5 * change)
            for k in range(len(ORDERS)):
                gram, per_word = batch.grams_of(k, words)
                np.add.at(model.p["char"], gram, -rate * 5 * np.repeat(change * np.maximum(per_word, 1)[:, None] ** -0.5, per_word, axis=0))
        scores = model.window_logits(batch)
        loss, waited = _loss(largest(), toxic[judged]), waited + 1
        if loss < least - 1e-3:
            best, least, waited, top = {k: v.copy() for k, v in model.p.items()}, loss, 0, largest()
    model.p = best
    a, b = _calibration(top, toxic[judged])
    if share:
        b += np.log(share / (1 - share)) - np.log(toxic[judged].mean() / (1 - toxic[judged].mean()))
    model.scale, model.shift = float(a), float(b)
    return model


def fit(rows: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE) -> Network | Constant:
    """Trains on labelled rows. A key with several labels, or several rows, counts as each combination."""
    marked = common.columns(labels, doc_id=key, toxic=label).filter("toxic IS NOT NULL AND doc_id IS NOT NULL").distinct()
    n = {0: 0, 1: 0}
    for r in marked.groupBy((F.col("toxic") > 0).cast("int").alias("toxic")).agg(F.count("*").alias("n")).collect():
        n[r.toxic] = r.n
    draw = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    limits = [min(1.0, 2 * sample / max(1, n[0])), min(1.0, sample / max(1, n[1]))]
    # texts beyond both limits are not sent to the join
    texts = common.columns(rows, doc_id=key, text=text).filter("text IS NOT NULL").filter(draw < max(limits))
    found = texts.join(marked, "doc_id").filter(draw < F.when(F.col("toxic") > 0, limits[1]).otherwise(limits[0]))
    found = found.select("text", (F.col("toxic") > 0).cast("int").alias("toxic")).dropDuplicates(["text", "toxic"])
    found = found.withColumn("draw", draw).toPandas().sort_values(["draw", "text", "toxic"])
    found = pd.concat([found[found["toxic"] == k][: (4 - 2 * k) * sample] for k in (0, 1)])
    if found["toxic"].nunique() < 2:
        return Constant(float(found["toxic"].mean()) if len(found) else 0.0)
    return train(found["text"].tolist(), found["toxic"].to_numpy(), n[1] / (n[0] + n[1]))


def predict(rows: DataFrame, model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score and predicted for every row."""
    rows = common.columns(rows, doc_id=key, text=text)
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def judged(batches):
        for batch in batches:
            score = shared.value.scores(batch["text"].tolist())
            yield pd.DataFrame({"doc_id": batch["doc_id"].to_numpy(), "score": score, "predicted": (score >= 0.5).astype(np.int32)})

    return rows.mapInPandas(judged, f"doc_id {common.kind(rows, 'doc_id')}, score double, predicted int")


def kept(rows: DataFrame, model, text: str = "text", limit: float = 0.5) -> DataFrame:
    """The rows that score below `limit`, with all their columns."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def filtered(batches):
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(batch.schema.names.index(text)).to_pylist()
            yield batch.filter(pa.array(shared.value.scores(texts) < limit))

    return rows.mapInArrow(filtered, rows.schema)

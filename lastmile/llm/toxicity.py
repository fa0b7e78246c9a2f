"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

Input of a word: its own embedding if the training windows have it often enough, else none,
beside the mean embedding of its character trigrams (of the word between two edge marks).
Two gated recurrent units read a window of ``WINDOW`` words from either side, attention pools
their states, and a logistic unit scores the window. A text is cut into windows that overlap
by half, all of them are scored, and the highest one counts, on a scale fitted to texts.

Training: labels are known per text, not per window. A bounded sample of labelled texts gives
all its windows to the driver, which trains with Adam: first with the text's label for each window,
then with the windows of toxic texts that score highest there. The frozen network (under
1 MB) is sent to the executors.

Defined results: null, empty and blank texts have no window and get the score of an empty
one, which is low; texts shorter than a window are one window; without labels of both kinds
every score is the share of label 1 (0 if there is none); equal texts get equal scores; an
empty table gives none; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import others
from .tokens import LOWERED, HashIndex, Words, constants, mixed, words

WINDOW, STRIDE = 24, 12
HIDDEN, ATTENTION, WORD_SIZE, GRAM_SIZE = 8, 8, 8, 12
GRAMS = 1 << 13
_U = np.uint64
_MIX = constants(4, 606)


# -- inputs -----------------------------------------------------------------------------------


@dataclass
class Inputs:
    """Distinct words of some texts: trigram buckets with bounds, and the tokens as numbers."""

    hashes: np.ndarray
    grams: np.ndarray
    bounds: np.ndarray
    tokens: np.ndarray


def inputs(part: Words) -> Inputs:
    found, first, inverse = np.unique(part.hashes(), return_index=True, return_inverse=True)
    starts, ends = part.starts[first], part.ends[first]
    size = ends - starts
    ends_at = np.cumsum(size)
    total = int(ends_at[-1]) if len(size) else 0
    at = np.arange(total) + np.repeat(starts - (ends_at - size), size)
    middle = LOWERED[part.data[at]].astype(_U)
    before, after = np.empty_like(middle), np.empty_like(middle)
    before[1:], after[:-1] = middle[:-1], middle[1:]
    before[ends_at - size] = 1  # edge marks; no word has bytes 1 and 2 by chance worth minding
    after[ends_at - 1] = 2
    grams = (mixed(before * _MIX[0] + middle * _MIX[1] + after * _MIX[2]) % _U(GRAMS)).astype(np.int32)
    return Inputs(found, grams, ends_at - size, inverse)


def windows(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first token, length) of the windows of texts with such token bounds."""
    n = np.diff(bounds)
    count = np.where(n > 0, 1 + np.maximum(0, -(-(n - WINDOW) // STRIDE)), 0)
    text = np.repeat(np.arange(len(n)), count)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    start = np.where(n[text] <= WINDOW, 0, np.minimum(nth * STRIDE, n[text] - WINDOW))
    return text, bounds[:-1][text] + start, np.minimum(n[text], WINDOW)


# -- the network ------------------------------------------------------------------------------


def _summed(at: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows of ``values`` by their places, of which there are ``n``."""
    out = np.zeros((n, values.shape[1]), values.dtype)
    if len(at):
        order = np.argsort(at, kind="stable")
        ranked = at[order]
        first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
        out[ranked[first]] = np.add.reduceat(values[order], first, axis=0)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Network:
    """Weights by name; ``index`` numbers the words that have an embedding (row 0: none)."""

    weights: dict[str, np.ndarray]
    vocabulary: np.ndarray
    scale: tuple[float, float] = (1.0, 0.0)

    def __post_init__(self) -> None:
        self.index = HashIndex(10)
        if len(self.vocabulary):
            self.index.add(self.vocabulary, np.arange(1, len(self.vocabulary) + 1, dtype=np.int32))

    def embedded(self, x: Inputs) -> np.ndarray:
        """A row for each distinct word; row -1 is padding."""
        w = self.weights
        out = np.zeros((len(x.hashes) + 1, WORD_SIZE + GRAM_SIZE), np.float32)
        if len(x.hashes):
            out[:-1, :WORD_SIZE] = w["words"][np.maximum(self.index.find(x.hashes), 0)]
            counts = np.diff(np.append(x.bounds, len(x.grams)))
            out[:-1, WORD_SIZE:] = np.add.reduceat(w["grams"][x.grams], x.bounds, axis=0) / counts[:, None]
        return out

    def forward(self, rows: np.ndarray, places: np.ndarray, mask: np.ndarray, keep: list | None = None) -> np.ndarray:
        """Logits of windows; ``places`` (windows, WINDOW) are rows, ``mask`` tells padding."""
        w = self.weights
        n, steps = places.shape
        states = np.zeros((steps, n, 2 * HIDDEN), rows.dtype)
        trace = []
        for side, order in enumerate((range(steps), range(steps - 1, -1, -1))):
            projected = rows @ w[f"in{side}"] + w[f"bias{side}"]
            u_gates, u_new = w[f"gates{side}"], w[f"new{side}"]
            h = np.zeros((n, HIDDEN), rows.dtype)
            for t in order:
                x = projected[places[:, t]]
                gates = _sigmoid(x[:, : 2 * HIDDEN] + h @ u_gates)
                z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
                rh = r * h
                new = np.tanh(x[:, 2 * HIDDEN :] + rh @ u_new)
                after = h + mask[:, t, None] * z * (new - h)
                if keep is not None:
                    trace.append((side, t, h, z, r, rh, new))
                h = after
                states[t, :, side * HIDDEN : (side + 1) * HIDDEN] = h
        seen = np.tanh(states @ w["look"] + w["look_bias"])
        weight = seen @ w["point"]
        weight = np.where(mask.T > 0, weight, -1e9)
        weight = np.exp(weight - weight.max(0))
        weight /= weight.sum(0)
        pooled = (weight[:, :, None] * states).sum(0)
        logits = pooled @ w["out"] + w["out_bias"][0]
        if keep is not None:
            keep += [trace, states, seen, weight, pooled]
        return logits

    def backward(self, rows: np.ndarray, places: np.ndarray, mask: np.ndarray, kept: list, slope: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of the weights and of ``rows``, from those of the logits."""
        w = self.weights
        trace, states, seen, weight, pooled = kept
        g = {"out": pooled.T @ slope, "out_bias": np.array([slope.sum()])}
        d_pooled = slope[:, None] * w["out"]
        d_states = weight[:, :, None] * d_pooled
        d_weight = (states * d_pooled).sum(2)
        d_score = weight * (d_weight - (weight * d_weight).sum(0))
        g["point"] = np.tensordot(seen, d_score, ((0, 1), (0, 1)))
        d_seen = d_score[:, :, None] * w["point"] * (1 - seen * seen)
        g["look"] = np.tensordot(states, d_seen, ((0, 1), (0, 1)))
        g["look_bias"] = d_seen.sum((0, 1))
        d_states = d_states + d_seen @ w["look"].T
        d_rows = np.zeros_like(rows)
        for side in (0, 1):
            for name in ("in", "bias", "gates", "new"):
                g[f"{name}{side}"] = np.zeros_like(w[f"{name}{side}"])
            each = np.empty((*places.T.shape, 3 * HIDDEN), rows.dtype)
            d_h = np.zeros((len(places), HIDDEN), rows.dtype)
            for s, t, h, z, r, rh, new in reversed([x for x in trace if x[0] == side]):
                d_after = d_h + d_states[t, :, side * HIDDEN : (side + 1) * HIDDEN]
                m = mask[:, t, None]
                d_new = d_after * m * z * (1 - new * new)
                d_z = d_after * m * (new - h) * z * (1 - z)
                d_rh = d_new @ w[f"new{side}"].T
                d_r = d_rh * h * r * (1 - r)
                d_gates = np.concatenate([d_z, d_r], 1)
                g[f"new{side}"] += rh.T @ d_new
                g[f"gates{side}"] += h.T @ d_gates
                each[t, :, : 2 * HIDDEN], each[t, :, 2 * HIDDEN :] = d_gates, d_new
                d_h = d_after * (1 - m * z) + d_rh * r + d_gates @ w[f"gates{side}"].T
            d_projected = _summed(places.T.ravel(), each.reshape(-1, 3 * HIDDEN), len(rows))
            g[f"in{side}"] = rows.T @ d_projected
            g[f"bias{side}"] = d_projected.sum(0)
            d_rows += d_projected @ w[f"in{side}"].T
        return g, d_rows


def new_network(vocabulary: np.ndarray, seed: int = 1) -> Network:
    rng = np.random.default_rng(seed)
    size = WORD_SIZE + GRAM_SIZE
    w = {"words": rng.normal(0, 0.02, (len(vocabulary) + 1, WORD_SIZE)), "grams": rng.normal(0, 0.02, (GRAMS, GRAM_SIZE))}
    w["words"][0] = 0
    for side in (0, 1):
        w[f"in{side}"] = rng.normal(0, size**-0.5, (size, 3 * HIDDEN))
        w[f"bias{side}"] = np.zeros(3 * HIDDEN)
        w[f"gates{side}"] = rng.normal(0, HIDDEN**-0.5, (HIDDEN, 2 * HIDDEN))
        w[f"new{side}"] = rng.normal(0, HIDDEN**-0.5, (HIDDEN, HIDDEN))
    w |= {"look": rng.normal(0, 0.25, (2 * HIDDEN, ATTENTION)), "look_bias": np.zeros(ATTENTION), "point": rng.normal(0, 0.5, ATTENTION)}
    w |= {"out": rng.normal(0, 0.25, 2 * HIDDEN), "out_bias": np.zeros(1)}
    return Network({k: v.astype(np.float32) for k, v in w.items()}, vocabulary)


def _places(tokens: np.ndarray, starts: np.ndarray, lengths: np.ndarray, padding: int) -> tuple[np.ndarray, np.ndarray]:
    step = np.arange(WINDOW)
    mask = step[None, :] < lengths[:, None]
    at = np.minimum(starts[:, None] + step, max(len(tokens) - 1, 0))
    return np.where(mask, tokens[at], padding), mask.astype(np.float32)


def window_logits(network: Network, x: Inputs, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    rows = network.embedded(x)
    out = np.empty(len(starts))
    for lo in range(0, len(starts), 2048):
        places, mask = _places(x.tokens, starts[lo : lo + 2048], lengths[lo : lo + 2048], len(rows) - 1)
        out[lo : lo + 2048] = network.forward(rows, places, mask)
    return out


# -- training ---------------------------------------------------------------------------------


def fit(texts: list[str], group: np.ndarray, label: np.ndarray, epochs: int = 6, batch: int = 128, rate: float = 0.01, decay: float = 3e-3, often: int = 4, seed: int = 1, clean: float = 1.0) -> Network:
    """A network from windows (one text each), the labelled text each is of, and its label.

    The weights are learnt from four of five texts, the scale from the fifth, where each
    clean text stands for ``clean`` of them.
    """
    part = next(words(pa.array(texts), 1 << 40))
    x = inputs(part)
    starts, lengths = part.bounds[:-1], np.diff(part.bounds)
    met = np.unique(np.stack([x.tokens, np.repeat(group, lengths)]), axis=1)[0]
    vocabulary = x.hashes[np.flatnonzero(np.bincount(met, minlength=len(x.hashes)) >= often)]
    vocabulary = vocabulary[vocabulary != 0]
    network = new_network(vocabulary, seed)
    number = network.index.find(x.hashes)
    number[number < 0] = 0
    ends = np.append(x.bounds, len(x.grams))
    rng = np.random.default_rng(seed)
    moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in network.weights.items()}
    step, steps = 0, epochs * -(-len(texts) // batch)
    kept_out = (mixed(np.arange(group.max() + 1, dtype=_U) + _U(1)) % _U(5) == 0)[group]
    per_text = 1.0 / np.bincount(group)[group]
    balance = np.where(label > 0, 0.5 / max(1e-9, per_text[label > 0].sum()), 0.5 / max(1e-9, per_text[label == 0].sum()))
    weight = per_text * balance * len(texts)
    for epoch in range(epochs):
        if epoch >= 2:  # a toxic text's highest windows count as toxic, a clean one's count more
            logits = window_logits(network, x, starts, lengths)
            highest = np.full(group.max() + 1, -np.inf)
            np.maximum.at(highest, group, logits)
            chosen = (label == 0) | (logits >= np.minimum(highest[group], 2.0))
            count = np.bincount(group[chosen & (label > 0)], minlength=group.max() + 1)[group]
            share = np.exp(np.minimum(logits - highest[group], 0.0))
            share /= np.bincount(group, share)[group]
            share = np.where(label > 0, chosen / np.maximum(count, 1), 0.5 * per_text + 0.5 * share)
            weight = balance * len(texts) * share
        order = rng.permutation(np.flatnonzero((lengths > 0) & (weight > 0) & ~kept_out))
        for lo in range(0, len(order), batch):
            some = order[lo : lo + batch]
            places, mask = _places(x.tokens, starts[some], lengths[some], -1)
            used, places = np.unique(places, return_inverse=True)
            places = places.reshape(mask.shape)
            real = used >= 0
            u = used[real]
            size = ends[u + 1] - ends[u]
            first = np.cumsum(size) - size
            grams = x.grams[np.arange(int(size.sum())) + np.repeat(ends[u] - first, size)]
            w = network.weights
            rows = np.zeros((len(used), WORD_SIZE + GRAM_SIZE), np.float32)
            rows[real, :WORD_SIZE] = w["words"][number[u]]
            rows[real, WORD_SIZE:] = np.add.reduceat(w["grams"][grams], first, axis=0) / size[:, None]
            kept: list = []
            logits = network.forward(rows, places, mask, kept)
            slope = ((_sigmoid(logits) - label[some]) * weight[some] / len(some)).astype(np.float32)
            g, d_rows = network.backward(rows, places, mask, kept, slope)
            d = d_rows[real]
            g["words"] = _summed(number[u], d[:, :WORD_SIZE], len(w["words"]))
            g["words"][0] = 0
            g["grams"] = _summed(grams, np.repeat(d[:, WORD_SIZE:] / size[:, None], size, axis=0), GRAMS)
            step += 1
            for name, slope_ in g.items():
                if name in ("words", "grams"):
                    slope_ += decay * w[name]
                m, v = moments[name]
                m += 0.1 * (slope_ - m)
                v += 0.001 * (slope_ * slope_ - v)
                w[name] -= (max(0.05, 1 - step / steps) * rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    logits = window_logits(network, x, starts, lengths)
    highest = np.full(group.max() + 1, -20.0)
    np.maximum.at(highest, group, logits)
    truth = np.zeros(group.max() + 1)
    truth[group] = label
    known = np.unique(group[kept_out])
    if len(np.unique(truth[known])) < 2:
        known = np.unique(group)
    network.scale = _scaled(highest[known], truth[known], clean)
    return network


def _scaled(logits: np.ndarray, truth: np.ndarray, clean: float = 1.0) -> tuple[float, float]:
    """Slope and offset that fit the texts' highest logits to their labels (Platt's method)."""
    n1, n0 = truth.sum(), (1 - truth).sum()
    target = np.where(truth > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(truth > 0, 1.0, clean)
    a, b = 1.0, 0.0
    for _ in range(200):
        p = _sigmoid(a * logits + b)
        s = weight * p * (1 - p) + 1e-6
        miss = weight * (p - target)
        g = np.array([(miss * logits).sum() + 1e-2 * (a - 1), miss.sum()])
        h = np.array([[(s * logits * logits).sum() + 1e-2, (s * logits).sum()], [(s * logits).sum(), s.sum() + 1e-6]])
        move = np.linalg.solve(h, g)
        a, b = a - np.clip(move[0], -1, 1), b - np.clip(move[1], -1, 1)
    return float(max(a, 0.05)), float(b)


def _training_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names, labels = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for part in words(batch.column(2)):
            text, start, length = windows(part.bounds)
            raw = part.data.tobytes()
            rows = (text + part.first).tolist()
            own = [raw[part.starts[a] : part.ends[a + n - 1]].decode("utf-8", "replace") for a, n in zip(start.tolist(), length.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([names[k] for k in rows], pa.int64()), pa.array([labels[k] for k in rows], pa.int32()), pa.array(own, pa.string())], names=["name", "label", "text"]
            )


def train(docs: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text", per_label: int = 800) -> Network | float:
    """A network of the labelled ``docs``; with one label only, the share of label 1.

    Bound: about ``per_label`` texts of each label, by a hash of id and text, with all their
    windows reach the driver. So a toxic passage is met wherever it stands, and the scale is
    fitted to the same maxima that ``score`` takes.
    """
    name = F.xxhash64(F.col(id_col), F.col(text_col))
    rows = docs.filter(F.col(label_col).isin(0, 1)).select(name.alias("name"), F.col(label_col).cast("int").alias("label"), F.col(text_col).alias("text"))
    counts = {label: n for label, n in rows.groupBy("label").count().collect()}
    if len(counts) < 2:
        return float(1 in counts)
    keep = F.lit(False)
    for label, n in counts.items():
        keep = keep | ((F.col("label") == label) & (F.pmod("name", F.lit(1 << 30)) < int(min(1.0, per_label / n) * (1 << 30))))
    found = rows.filter(keep).mapInArrow(_training_windows, "name long, label int, text string").toPandas()
    found = found.sort_values(["name", "text"], kind="stable")
    if found["label"].nunique() < 2:
        return float(found["label"].max()) if len(found) else 0.0
    _, group = np.unique(found["name"].to_numpy(), return_inverse=True)
    # a clean text of the sample stands for as many as the labels have more of them
    sampled = found.drop_duplicates("name")["label"].value_counts()
    clean = (counts[0] / counts[1]) / (sampled[0] / sampled[1])
    return fit(found["text"].tolist(), group, found["label"].to_numpy().astype(np.float32), clean=float(clean))


def score(docs: DataFrame, network: Network | float, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with the score (0 to 1) of every whole text."""
    sent = docs.sparkSession.sparkContext.broadcast(network)

    @F.pandas_udf("double")
    def scores(texts: pd.Series) -> pd.Series:
        net = sent.value
        if isinstance(net, float):
            return pd.Series(np.full(len(texts), net))
        out = np.empty(len(texts))
        for part in words(pa.array(texts, pa.string())):
            n = len(part.bounds) - 1
            highest = np.full(n, -20.0)
            if len(part.starts):
                text, start, length = windows(part.bounds)
                np.maximum.at(highest, text, window_logits(net, inputs(part), start, length))
            out[part.first : part.first + n] = _sigmoid(net.scale[0] * highest + net.scale[1])
        return pd.Series(out)

    return docs.select(*others(docs, score_col), scores(F.coalesce(F.col(text_col), F.lit(""))).alias(score_col))

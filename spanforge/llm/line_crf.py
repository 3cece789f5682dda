"""Quality classifier: a linear-chain conditional random field over a text's lines.

Each line is described by binned features of itself and of its neighbours; the chain labels every line good or bad.
Learning takes a text's label for all its lines (at most PER_CLASS texts of each label: a bounded, documented sample) and
maximises the chain's conditional likelihood by Adam.  A text's score is the average of its lines' forward-backward
marginals for good, weighted by line length.  Whole texts are scored.

Defined results: null and empty texts, and texts of blank lines only, score 0; equal texts get equal scores; an empty table
gives an empty table; without labels of both kinds the score is the base rate.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, is_held_out, narrow, ragged_sums, texts_of
from .labelled import labelled_texts

PER_CLASS = 1500
THRESHOLD = 0.7
STEPS, RATE, DECAY = 150, 0.05, 1e-3
#: Classes of bytes: other, lower, upper, digit, blank, stop, symbol, bang, beyond ASCII.
_CLASS = np.zeros(256, np.int64)
for _k, _s in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r\x0b\x0c", b".,;:?'\"()-", b"#*$%&|<>", b"!"), 1):
    _CLASS[np.frombuffer(_s, np.uint8)] = _k
_CLASS[128:] = 8
KINDS, BINS = 9, 8
#: Measures of a line; each becomes one of BINS bins, and a line sees its own, the previous and the next line's bins.
MEASURES = 9


def lines_of(text: str) -> list[str]:
    return [x for x in text.split("\n") if x.strip()]


def measures(lines: list[str], again: np.ndarray) -> np.ndarray:
    """Bins of every line: lower, upper, digits, stops, symbols and bangs as shares, word length, distinct words, size or copy."""
    raw = [x.encode("utf-8", "surrogatepass") for x in lines]
    n = np.fromiter(map(len, raw), np.int64, len(raw))
    kinds = _CLASS[np.frombuffer(b"".join(raw), np.uint8)]
    counts = np.bincount(np.repeat(np.arange(len(raw)) * KINDS, n) + kinds, minlength=len(raw) * KINDS).reshape(-1, KINDS)
    words = [x.split() for x in lines]
    n_words = np.fromiter(map(len, words), np.int64, len(words))
    distinct = np.fromiter((len(set(w)) for w in words), np.int64, len(words))
    solid = np.maximum(n - counts[:, 4], 1)
    share = lambda x, scale: np.minimum((x / solid * scale).astype(np.int64), BINS - 1)
    columns = [share(counts[:, 1], 7.99), share(counts[:, 2], 12), share(counts[:, 3], 12), share(counts[:, 5], 40), share(counts[:, 6], 40), share(counts[:, 7], 40)]
    columns.append(np.minimum((solid / np.maximum(n_words, 1)).astype(np.int64) // 2, BINS - 1))
    columns.append(np.minimum((distinct / np.maximum(n_words, 1) * 7.99).astype(np.int64), BINS - 1))
    columns.append(np.where(again, BINS - 1, np.minimum(np.log2(np.maximum(n_words, 1)).astype(np.int64), BINS - 2)))
    return np.stack(columns, 1)


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Active weights of every line (own, previous, next), each line's length, and how many lines each text has."""
    parts = [lines_of(t) for t in texts]
    counts = np.fromiter(map(len, parts), np.int64, len(parts))
    lines = [x for p in parts for x in p]
    if not lines:
        return np.zeros((0, 3 * MEASURES + 1), np.int64), np.zeros(0), counts
    again: list[bool] = []
    for p in parts:
        seen: set[str] = set()
        for x in p:
            again.append(x in seen)
            seen.add(x)
    own = measures(lines, np.array(again)) + np.arange(MEASURES) * BINS
    width, none = MEASURES * BINS, 3 * MEASURES * BINS + 1
    ends = np.cumsum(counts)
    has = np.flatnonzero(counts)
    before, after = np.roll(own, 1, 0) + width, np.roll(own, -1, 0) + 2 * width
    before[(ends - counts)[has]], after[ends[has] - 1] = none, none + 1
    bias = np.full((len(own), 1), none - 1)
    return np.concatenate([own, before, after, bias], 1), np.fromiter(map(len, lines), np.float64, len(lines)), counts


N_WEIGHTS = 3 * MEASURES * BINS + 3


def chains(counts: np.ndarray) -> list[np.ndarray]:
    """For each place in a text: rows of the lines there, of all texts that are that long, longest text first."""
    starts = np.cumsum(counts) - counts
    order = np.argsort(-counts, kind="stable")
    lengths = counts[order]
    return [starts[order[: int(np.searchsorted(-lengths, -t, "left"))]] + t for t in range(int(counts.max(initial=0)))]


def _both(x: np.ndarray, pair: np.ndarray) -> np.ndarray:
    """log of sums over the first label of exp(x + pair)."""
    return np.logaddexp(x[:, :1] + pair[0], x[:, 1:] + pair[1])


def marginals(unary: np.ndarray, pair: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward in log space over all texts at once: marginals of every line, expected transitions over all."""
    rows = chains(counts)
    forward, backward = unary.copy(), np.zeros_like(unary)
    for now, before in zip(rows[1:], rows, strict=False):
        forward[now] += _both(forward[before[: len(now)]], pair)
    moves = np.zeros((2, 2))
    for now, after in zip(rows[-2::-1], rows[:0:-1], strict=True) if len(rows) > 1 else ():
        at = now[: len(after)]
        backward[at] = _both(unary[after] + backward[after], pair.T)
        joint = forward[at][:, :, None] + pair + (unary[after] + backward[after])[:, None, :]
        joint = np.exp(joint - joint.max((1, 2), keepdims=True))
        moves += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
    p = forward + backward
    p = np.exp(p - p.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True), moves


class Model:
    def __init__(self, weights: np.ndarray, pair: np.ndarray, empty: float = 0.0, constant: float | None = None) -> None:
        self.weights, self.pair, self.empty, self.constant = weights, pair, empty, constant

    def scores(self, texts: list[str]) -> np.ndarray:
        active, length, counts = features(texts)
        if self.constant is not None:
            return np.where(counts > 0, self.constant, self.empty)
        good = marginals(self.weights[active].sum(1), self.pair, counts)[0][:, 1] if len(active) else np.zeros(0)
        total = ragged_sums(length, counts)
        return np.where(counts > 0, np.clip(ragged_sums(good * length, counts) / np.maximum(total, 1), 0, 1), self.empty)


def fit(sample: list[tuple[str, int]], base_rate: float) -> Model:
    y = np.array([s[1] for s in sample], np.int64)
    if not 0 < y.sum() < len(y):
        return Model(np.zeros((N_WEIGHTS, 2)), np.zeros((2, 2)), constant=base_rate)
    active, _, counts = features([t for t, _ in sample])
    truth = np.repeat(y, counts)
    # texts count alike, so that long texts of many lines do not drown the others
    weight = np.repeat(1.0 / np.maximum(counts, 1), counts) / len(y)
    gold = np.zeros((len(truth), 2))
    gold[np.arange(len(truth)), truth] = 1
    stay = np.array([[((counts - 1) * (y == 0)).clip(0).sum(), 0], [0, ((counts - 1) * (y == 1)).clip(0).sum()]], np.float64)
    params = [np.zeros((N_WEIGHTS, 2)), np.zeros((2, 2))]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    flat, width = active.ravel(), active.shape[1]
    for step in range(1, STEPS + 1):
        p, moves = marginals(params[0][active].sum(1), params[1], counts)
        diff = (p - gold) * weight[:, None]
        g = np.stack([np.bincount(flat, np.repeat(diff[:, k], width), N_WEIGHTS) for k in range(2)], 1)
        grads = [g + DECAY * params[0] / 10, (moves - stay) / max(stay.sum(), 1) / 10 + DECAY * params[1]]
        for i, grad in enumerate(grads):
            first[i] = 0.9 * first[i] + 0.1 * grad
            second[i] = 0.999 * second[i] + 0.001 * grad * grad
            params[i] = params[i] - RATE * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return Model(*params)


def train(docs: DataFrame, labels: DataFrame, value: str = "quality", modulus: int = 4, remainder: int = 2) -> Model:
    return fit(*labelled_texts(docs, labels, value, modulus, remainder, PER_CLASS))


def score(docs: DataFrame, model: Model, modulus: int = 4, remainder: int = 2) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def over(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.record_batch({"doc_id": batch.column("doc_id"), "score": pa.array(shared.value.scores(texts_of(batch)), pa.float64())})

    out = arrow_map(narrow(docs, "doc_id", "text"), over, "doc_id bigint, score double")
    return out.select("doc_id", is_held_out(F.col("doc_id"), modulus, remainder).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))

"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the bag of its character n-grams, each with a vector; a text is the average of its words' vectors; a linear
softmax over that average gives the score.  Vectors and softmax are trained together.  A misspelling that was never seen
shares most n-grams with the word it distorts, and so its vector.

Learning takes at most PER_CLASS texts of each label (a bounded, documented sample).  Since the model is linear in the
words, scoring looks each distinct word up once per worker; whole texts are scored.

Defined results: null, empty and wordless texts get the score of the softmax's bias (the label's base rate); equal texts
get equal scores; an empty table gives an empty table; without labels of both kinds the score is the base rate, or 0.5.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, is_held_out, narrow, ragged_sums, texts_of
from .labelled import labelled_texts
from .word_table import WordTable, flat_codes, mix

PER_CLASS = 1000
ORDERS, BUCKETS, WIDTH = (3, 4, 5), 1 << 17, 6
STEPS, RATE, DECAY, GAIN, LEAST = 80, 0.04, 6.0, 24.0, 10
THRESHOLD = 0.7
_BREAKS = str.maketrans(dict.fromkeys('.,;:?()"[]{}|<>', " "))


def words_in(text: str) -> list[str]:
    return text.lower().translate(_BREAKS).split()


def ngrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words' n-grams and whole words, word by word, and how many each word has."""
    bare = [w.strip("!*'#$%&-_+=/\\~`@^") or w for w in words]
    codes, lengths = flat_codes(bare, "<", ">")
    ends = np.cumsum(lengths)
    word = np.repeat(np.arange(len(words)), lengths)
    at, left = np.arange(len(codes)), ends[word]
    hashes, owners = [], []
    for n in ORDERS:
        ok = np.flatnonzero(at + n <= left)
        h = np.full(len(ok), n, np.uint64)
        for k in range(n):
            h = h * np.uint64(0x100000001B3) + codes[ok + k]
        hashes.append(mix(h))
        owners.append(word[ok])
    power = np.cumprod(np.full(int(lengths.max(initial=1)), 0x100000001B3, np.uint64))
    whole = codes * power[at - (ends - lengths)[word]]
    running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(whole, dtype=np.uint64)])
    hashes.append(mix(running[ends] - running[ends - lengths]))
    owners.append(np.arange(len(words)))
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return (np.concatenate(hashes) % np.uint64(BUCKETS)).astype(np.int64)[order], np.bincount(owner, minlength=len(words))


class Model:
    """u: what each bucket adds to the logit of label 1 (vectors times softmax, folded); bias: the softmax's."""

    def __init__(self, u: np.ndarray, bias: float) -> None:
        self.u, self.bias = u, bias

    def word_scores(self, words: list[str]) -> np.ndarray:
        ids, counts = ngrams(words)
        return (ragged_sums(self.u[ids], counts) / np.maximum(counts, 1))[:, None]

    def table(self) -> WordTable:
        return WordTable(self.word_scores, 1)

    def scores(self, texts: list[str], table: WordTable) -> np.ndarray:
        parts = [words_in(t) for t in texts]
        counts = np.fromiter(map(len, parts), np.int64, len(parts))
        rows = table.lookup([w for p in parts for w in p])[:, 0]
        logit = self.bias + GAIN * ragged_sums(rows, counts) / np.maximum(counts, 1)
        return 1 / (1 + np.exp(-np.clip(logit, -40, 40)))


def _matrix(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, bucket and value of the sparse matrix that turns bucket scores into text averages.

    A vector is learned for a bucket that LEAST or more words of texts hold, rarer ones only tell single texts apart; so
    only those have entries.  They are laid out a slice at a time, to hold no more than the result.
    """
    parts = [words_in(t) for t in texts]
    vocabulary: dict[str, int] = {}
    ids = np.fromiter((vocabulary.setdefault(w, len(vocabulary)) for p in parts for w in p), np.int64)
    doc = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    del parts
    pair, counts = np.unique(doc * max(len(vocabulary), 1) + ids, return_counts=True)
    doc, word = pair // max(len(vocabulary), 1), pair % max(len(vocabulary), 1)
    share = counts / np.bincount(doc, counts, len(texts))[doc]
    del pair, ids, counts
    grams, total = ngrams(list(vocabulary))
    grams = grams.astype(np.int32)
    held_by = np.repeat(np.bincount(word, minlength=len(total)), total)
    common = (np.bincount(grams, held_by, BUCKETS) >= LEAST)[grams]
    per_word = np.bincount(np.repeat(np.arange(len(total)), total)[common], minlength=len(total))
    grams = grams[common]
    del held_by, common
    first = np.cumsum(per_word) - per_word
    rows, buckets, values = [], [], []
    for i in range(0, len(word), 100_000):
        w, n = word[i : i + 100_000], per_word[word[i : i + 100_000]]
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        rows.append(np.repeat(doc[i : i + 100_000].astype(np.int32), n))
        buckets.append(grams[np.repeat(first[w], n) + inside])
        values.append(np.repeat((GAIN * share[i : i + 100_000] / np.maximum(total[w], 1)).astype(np.float32), n))
    none = [np.zeros(0, np.int32)]
    return np.concatenate(rows or none), np.concatenate(buckets or none), np.concatenate(values or none).astype(np.float32)


def _calibrate(logit: np.ndarray, y: np.ndarray, base_rate: float) -> tuple[float, float]:
    """Slope and shift that make a logistic of the logits fit held-back labels at the base rate (Newton's method)."""
    weight = np.where(y == 1, base_rate / max(y.sum(), 1), (1 - base_rate) / max((1 - y).sum(), 1))
    x, theta = np.stack([logit, np.ones_like(logit)], 1), np.array([1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(2)
        theta = theta - np.linalg.solve(hessian, x.T @ (weight * (p - y)) + 1e-4 * (theta - [1, 0]))
    return (float(theta[0]), float(theta[1])) if np.isfinite(theta).all() and theta[0] > 0 else (1.0, 0.0)


def fit(sample: list[tuple[str, int]], base_rate: float, seed: int = 42) -> Model:
    """Train vectors E and softmax W together by Adam, classes weighted alike; calibrate on every fifth text, held back.

    A text's average is X E and its logit X E W, so a step needs E W and the gradient per bucket, X' d, once each.
    """
    base_rate = float(np.clip(base_rate, 1e-3, 1 - 1e-3))
    odds = float(np.log(base_rate / (1 - base_rate)))
    y = np.array([s[1] for s in sample], np.float64)
    held = np.arange(len(y)) % 5 == 4
    if not 0 < y[~held].sum() < (~held).sum():
        return Model(np.zeros(BUCKETS), odds)
    doc, gram, value = _matrix([t for t, _ in sample])
    held &= bool(0 < y[held].sum() < held.sum())
    use = ~held[doc]
    used = np.unique(gram[use])
    place = np.zeros(BUCKETS, np.int32)
    place[used] = np.arange(len(used), dtype=np.int32)
    local, doc_n, doc_value = place[gram[use]], doc[use], value[use]
    del use
    weight = np.where(held, 0, np.where(y == 1, 0.5 / y[~held].sum(), 0.5 / (1 - y[~held]).sum()))
    rng = np.random.default_rng(seed)
    params = [rng.normal(0, 0.1, (len(used), WIDTH)), rng.normal(0, 0.5, WIDTH), np.zeros(1)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, STEPS + 1):
        e, w, b = params
        logit = np.bincount(doc_n, doc_value * (e @ w)[local], len(y)) + b[0]
        d = weight * (1 / (1 + np.exp(-np.clip(logit, -40, 40))) - y)
        g = np.bincount(local, doc_value * d[doc_n], len(used))
        for i, grad in enumerate((g[:, None] * w + DECAY * e / len(used), e.T @ g, np.array([d.sum()]))):
            first[i] = 0.9 * first[i] + 0.1 * grad
            second[i] = 0.999 * second[i] + 0.001 * grad * grad
            params[i] = params[i] - RATE * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-10)
    u, bias = np.zeros(BUCKETS), float(params[2][0])
    u[used] = params[0] @ params[1]
    if not held.any():
        return Model(u, bias + odds)
    logit = np.bincount(doc, value * u[gram], len(y))[held] + bias
    slope, shift = _calibrate(logit, y[held], base_rate)
    return Model(u * slope, bias * slope + shift)


def train(docs: DataFrame, labels: DataFrame, value: str = "toxic", modulus: int = 3, remainder: int = 1) -> Model:
    return fit(*labelled_texts(docs, labels, value, modulus, remainder, PER_CLASS))


def score(docs: DataFrame, model: Model, modulus: int = 3, remainder: int = 1) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept: dict[str, WordTable] = {}

    def over(batch: pa.RecordBatch) -> pa.RecordBatch:
        table = kept.setdefault("table", shared.value.table())
        return pa.record_batch({"doc_id": batch.column("doc_id"), "score": pa.array(shared.value.scores(texts_of(batch), table), pa.float64())})

    out = arrow_map(narrow(docs, "doc_id", "text"), over, "doc_id bigint, score double")
    return out.select("doc_id", is_held_out(F.col("doc_id"), modulus, remainder).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))

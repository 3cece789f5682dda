"""Language ID by interpolated Kneser-Ney character models, one per language, in sorted hash arrays.

A word between boundary marks is a sequence of characters; each order's n-grams and contexts are kept as sorted arrays of
64-bit hashes with their discounted probability and back-off weight.  The language with the lowest cross-entropy
per character wins.  A temperature, fitted on texts held back from the counts, turns cross-entropies into the
score; texts whose best cross-entropy is above that language's calibrated limit are marked as rejected, so that a caller can
treat them as unknown.  Models are fitted on a bounded sample: PER_LANGUAGE texts a language, and ALL_TEXTS in all, so with more than ten
languages each has fewer; beyond ALL_TEXTS languages the first in code-point order are learned.  A language with under ten texts rejects
nothing.  Whole texts are scored.

Defined results: null text and text without a letter give `und` with score 0; equal texts give equal results; ties go to the
first language in code-point order; an empty table gives an empty table; without learnable texts all is `und`.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, cut, group_join, is_held_out, narrow, ragged_sums, texts_of
from .labelled import MAX_LEARN_CHARS
from .word_table import WordTable, flat_codes, mix

ORDER, DISCOUNT, ALPHABET = 4, 0.75, 1 << 16
PER_LANGUAGE, ALL_TEXTS = 400, 4000
#: A calibration text is rejected with about this probability.
REJECT = 0.005
UNKNOWN = "und"
_WORD = re.compile(r"[^\W\d_]+")
_STEP = np.uint64(0x9E3779B97F4A7C15)


def words_in(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _grams(codes: np.ndarray, lengths: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places of the last character, hash of the n-gram, hash of its context, hash of its suffix (without the first character)."""
    start = np.repeat(np.cumsum(lengths) - lengths, lengths)
    at = np.flatnonzero(np.arange(len(codes)) - start >= max(n - 1, 1))  # the boundary mark itself is never predicted
    gram, suffix, context = (np.full(len(at), n, np.uint64) for _ in range(3))
    suffix, context = suffix - np.uint64(1), context - np.uint64(1)
    for k in range(n):
        c = codes[at - (n - 1 - k)]
        gram = gram * _STEP + c
        suffix = suffix * _STEP + c if k else suffix
        context = context * _STEP + c if k < n - 1 else context
    return at, mix(gram), mix(context), mix(suffix)


class Counts:
    """One language's model: for each order sorted n-gram hashes with discounted shares, sorted contexts with back-off weights."""

    def __init__(self, words: list[str], times: np.ndarray) -> None:
        codes, lengths = flat_codes(words, " ", " ")
        times = np.repeat(times, lengths).astype(np.float64)
        self.tables = []
        lower: np.ndarray | None = None  # suffixes of the distinct n-grams one order up: their counts are continuation counts
        for n in range(ORDER, 0, -1):
            at, gram, context, suffix = _grams(codes, lengths, n)
            keys, first, back = np.unique(gram, return_index=True, return_inverse=True)
            count = np.bincount(back, times[at], len(keys))
            if lower is not None:
                found, many = np.unique(lower, return_counts=True)
                place = np.minimum(np.searchsorted(found, keys), len(found) - 1)
                # an n-gram at a word's start has no character before it, so there its own count stands
                count = np.where(found[place] == keys, many[place], count) if len(found) else count
            contexts, owner = np.unique(context[first], return_inverse=True)
            total, kinds = np.bincount(owner, count, len(contexts)), np.bincount(owner, minlength=len(contexts))
            share = np.maximum(count - DISCOUNT, 0) / np.maximum(total[owner], 1e-9)
            self.tables.append((keys, share, contexts, np.minimum(DISCOUNT * kinds / np.maximum(total, 1e-9), 1.0)))
            lower = suffix[first]
        self.tables.reverse()

    def cost(self, codes: np.ndarray, lengths: np.ndarray, grams: list) -> np.ndarray:
        """Negative log probability of every character."""
        p = np.full(len(codes), 1.0 / ALPHABET)
        for (at, gram, context, _), (keys, share, contexts, weight) in zip(grams, self.tables, strict=True):
            if not len(keys):
                continue
            i, j = np.minimum(np.searchsorted(keys, gram), len(keys) - 1), np.minimum(np.searchsorted(contexts, context), len(contexts) - 1)
            known = contexts[j] == context
            p[at] = np.where(known, np.where(keys[i] == gram, share[i], 0.0) + np.where(known, weight[j], 1.0) * p[at], p[at])
        return -np.log(p)


class Model:
    def __init__(self, samples: dict[str, list[str]]) -> None:
        self.languages, self.temperature = sorted(samples), 1.0
        self.limits = np.full(len(self.languages), np.inf)
        self.counts = []
        held: list[tuple[str, int]] = []
        for k, lang in enumerate(self.languages):
            texts = samples[lang]
            back = texts[4::5] if len(texts) >= 10 else []
            held += [(t, k) for t in back]
            bag: dict[str, int] = {}
            for t in (texts if not back else [t for i, t in enumerate(texts) if i % 5 != 4]):
                for w in words_in(t):
                    bag[w] = bag.get(w, 0) + 1
            self.counts.append(Counts(list(bag), np.fromiter(bag.values(), np.int64, len(bag))))
        if held:
            self._calibrate([t for t, _ in held], np.array([k for _, k in held]))

    def _calibrate(self, texts: list[str], truth: np.ndarray) -> None:
        entropy = self.entropies(texts, self.table())
        ok = np.isfinite(entropy).all(axis=1)
        entropy, truth = entropy[ok], truth[ok]
        if not len(truth):
            return
        losses = []
        for t in (grid := np.geomspace(0.5, 64, 29)):
            x = -t * entropy
            losses.append(float(np.mean(np.log(np.exp(x - x.max(1, keepdims=True)).sum(1)) + x.max(1) - x[np.arange(len(x)), truth])))
        self.temperature = float(grid[int(np.argmin(losses))])
        own = entropy.argmin(1)
        for k in range(len(self.languages)):
            if (mine := entropy[(own == k) & (truth == k), k]).size >= 10:
                self.limits[k] = np.quantile(mine, 1 - REJECT) * 1.05

    def word_costs(self, words: list[str]) -> np.ndarray:
        """Per word: its cost under each language and its number of predicted characters; without a letter (such as ²) both are zero."""
        lettered = np.fromiter((any(map(str.isalpha, w)) for w in words), bool, len(words))
        codes, lengths = flat_codes(words, " ", " ")
        grams = [_grams(codes, lengths, n) for n in range(1, ORDER + 1)]
        predicted = np.ones(len(codes), bool)
        predicted[np.cumsum(lengths) - lengths] = False
        columns = [ragged_sums(np.where(predicted, c.cost(codes, lengths, grams), 0.0), lengths) for c in self.counts]
        return np.where(lettered[:, None], np.stack([*columns, lengths - 1.0], 1), 0.0)

    def table(self) -> WordTable:
        return WordTable(self.word_costs, len(self.languages) + 1, 300_000)

    def entropies(self, texts: list[str], table: WordTable) -> np.ndarray:
        parts = [words_in(t) for t in texts]
        counts = np.fromiter(map(len, parts), np.int64, len(parts))
        sums = ragged_sums(table.lookup([w for p in parts for w in p]), counts)
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(sums[:, -1:] > 0, sums[:, :-1] / sums[:, -1:], np.nan)

    def predict(self, texts: list[str], table: WordTable) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Language, score, cross-entropy of the best language, and whether it is rejected as unlike any language learned."""
        n = len(texts)
        if not self.languages:
            return [UNKNOWN] * n, np.zeros(n), np.full(n, np.nan), np.ones(n, bool)
        entropy = self.entropies(texts, table)
        ok = np.isfinite(entropy).all(axis=1)
        safe = np.where(ok[:, None], entropy, 0.0)
        best = safe.argmin(1)
        x = -self.temperature * safe
        p = np.exp(x - x.max(1, keepdims=True))
        score = np.where(ok, p[np.arange(n), best] / p.sum(1), 0.0)
        lowest = np.where(ok, safe[np.arange(n), best], np.nan)
        return [self.languages[k] if o else UNKNOWN for k, o in zip(best, ok, strict=True)], score, lowest, ~ok | (lowest > self.limits[best])


def train(docs: DataFrame, modulus: int = 3, remainder: int = 1) -> Model:
    """Fit on at most PER_LANGUAGE texts a language, and ALL_TEXTS texts in all, picked by a hash of the id."""
    own = narrow(docs, "doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id"), modulus, remainder) & (F.length("text") <= MAX_LEARN_CHARS))
    ids = cut(own.select("lang", "doc_id"))  # ids first, so that no text is shuffled
    languages = cut(ids.groupBy("lang").agg(F.count("*").alias("n")))
    per = max(1, min(PER_LANGUAGE, ALL_TEXTS // max(1, languages.count())))
    # the pre-cut by hash keeps a language's window at a few times `per` rows
    cut_off = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) * F.col("n") < F.lit(4.0 * per * (1 << 20))
    ranked = group_join(ids, languages, ["lang"], "n").where(cut_off | (F.col("n") <= 16 * per))
    picked = ranked.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))).where(F.col("k") <= per)
    chosen = [(r["lang"], r["doc_id"]) for r in picked.orderBy("lang", "k").limit(ALL_TEXTS).collect()]
    if not chosen:
        return Model({})
    few = F.broadcast(docs.sparkSession.createDataFrame(chosen, "lang string, doc_id bigint"))  # at most ALL_TEXTS rows
    samples: dict[str, list[str]] = {}
    for r in own.join(few, ["lang", "doc_id"]).groupBy("lang", "doc_id").agg(F.min("text").alias("text")).collect():
        samples.setdefault(r["lang"], []).append(r["text"])
    return Model({k: sorted(v) for k, v in samples.items()})


def predict(docs: DataFrame, model: Model, modulus: int = 3, remainder: int = 1) -> DataFrame:
    """doc_id, held_out, lang_pred, score, entropy (nats a character), rejected: one row per document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept: dict[str, WordTable] = {}

    def over(batch: pa.RecordBatch) -> pa.RecordBatch:
        table = kept.setdefault("table", shared.value.table())
        lang, score, entropy, rejected = shared.value.predict(texts_of(batch), table)
        return pa.record_batch({"doc_id": batch.column("doc_id"), "lang_pred": pa.array(lang), "score": pa.array(score), "entropy": pa.array(entropy, pa.float64(), from_pandas=True), "rejected": pa.array(rejected)})

    out = arrow_map(narrow(docs, "doc_id", "text"), over, "doc_id bigint, lang_pred string, score double, entropy double, rejected boolean")
    return out.select("doc_id", is_held_out(F.col("doc_id"), modulus, remainder).alias("held_out"), "lang_pred", "score", "entropy", "rejected")

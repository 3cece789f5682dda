"""Quality rules with thresholds that adapt to each language and source.  DataFrame functions only.

Base rules are fixed: a text fails with under 20 words, or when over 30 % of its words lie in 8-word windows that the
text holds twice.  Beyond them, four rates are compared with limits learned from the corpus: each (lang, source) gets a
quantile sketch per rate and one of its texts' words, histograms over buckets of bounded relative width, which merge by adding counts.  Sketches
of a source with few texts are merged into the language's, and that into the corpus's.

The limit of a rate is its upper quartile plus FENCE times the spread between median and quartiles, but at least the rate's
grain: what one event (a symbol, a doubled line, a window and its copy) makes in a text of the group's median length, since rates
of rare events have quartiles of zero.  Where over a quarter of a group is junk, its upper quartile is junk too; so no limit lies further than
2 * FENCE times the lower spread (or the grain) above the median, which holds as long as no more than half of a group is
junk.  A text shorter than the median has coarser rates, so what it may exceed the median by grows in proportion.

Defined results: null or empty text has no words and fails the base rules; a null lang or source is a group of its own; equal
rows get equal results; an empty table gives an empty table; extra columns are ignored by ``score`` and kept by ``keep``.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, group_join, narrow, nested, words_of, written

MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 20, 30, 8
#: Multiple of the spread beyond the upper quartile at which a text is an outlier of its group.
FENCE = 4
#: A group with fewer texts than this uses its language's sketch, and a language with fewer the corpus's.
MIN_GROUP = 64
#: Rates are whole numbers: symbols, doubled lines and repeated words per SCALE words, code points per LENGTH_SCALE words.
SCALE = 100_000
#: Events whose rate in a text of the median length is a rate's grain; the mean length of n words is grained by 1 / sqrt(n) code points.
EVENTS = {"symbol_rate": 1, "line_rate": 1, "repeat_rate": 2 * WINDOW}
RATES = (*EVENTS, "length_rate")
LENGTH_SCALE = 1000
#: Buckets keep this many leading bits of a rate: a relative width of 1/32.
BITS = 6


def _let(value: Column, use) -> Column:
    """use(value) with value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _windows(hashes: Column) -> Column:
    """A hash of each window of WINDOW word hashes; one window for a shorter text.  Reads by index, as slices copy."""
    return F.transform(F.sequence(F.lit(0), F.greatest(F.size(hashes) - WINDOW, F.lit(0))), lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)]))


def repeated_words(windows: Column) -> Column:
    """Words that lie in a window occurring twice or more.  Sorting keeps long texts at n log n."""

    def covered(starts: Column) -> Column:
        gaps = F.zip_with(starts, F.slice(starts, 2, F.size(starts)), lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW)).cast("bigint"))
        return F.aggregate(gaps, F.lit(0).cast("bigint"), lambda a, x: a + x)

    def doubled(placed: Column) -> Column:
        same = F.zip_with(placed, F.slice(placed, 2, F.size(placed)), lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False)))
        either = _let(same, lambda e: F.zip_with(e, F.concat(F.array(F.lit(False)), e), lambda x, y: F.coalesce(x, F.lit(False)) | F.coalesce(y, F.lit(False))))
        return F.array_sort(F.filter(F.zip_with(placed, either, lambda a, d: F.when(d, a["i"])), lambda i: i.isNotNull()))

    placed = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("bigint")).otherwise(_let(_let(placed, doubled), covered))


def with_metrics(docs: DataFrame) -> DataFrame:
    """Replace text by its five counts: words, their code points, symbols, doubled lines and repeated words."""
    t = docs.withColumn("text", F.coalesce("text", F.lit("")))
    parts = t.withColumn("w", words_of(F.col("text"))).withColumn("lines", F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))).withColumn("hashes", F.transform("w", lambda x: F.xxhash64(x))).withColumn("windows", _windows(F.col("hashes")))
    counts = [
        F.size("w").cast("bigint"),
        F.char_length(F.array_join("w", "")).cast("bigint"),
        (F.char_length("text") - F.char_length(F.translate("text", "#*$%&|<>", ""))).cast("bigint"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint"),
        repeated_words(F.col("windows")),
    ]
    return parts.select(*[c for c in docs.columns if c != "text"], *[c.alias(k) for k, c in zip(METRICS, counts, strict=True)])


METRICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def base_failed(n_words: Column, repeats: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * n_words)


def rates() -> dict[str, Column]:
    """The rates of a text with words, as whole numbers."""
    n, chars, symbols, dup_lines, repeats = map(F.col, METRICS)
    per = lambda x, scale: F.floor(x * scale / F.greatest(n, F.lit(1))).cast("bigint")
    return {"symbol_rate": per(symbols, SCALE), "line_rate": per(dup_lines, SCALE), "repeat_rate": per(repeats, SCALE), "length_rate": per(chars, LENGTH_SCALE)}


def bucket(v: Column) -> Column:
    """Lower edge of a value's bucket: its BITS leading bits."""
    step = F.greatest(F.length(F.bin(v)) - BITS, F.lit(0))
    width = F.pow(F.lit(2.0), step).cast("bigint")
    return F.floor(v / width).cast("bigint") * width


def sketches(metrics: DataFrame) -> DataFrame:
    """lang, source, rate, edge, n: a mergeable histogram per group and rate, and one of n_words.  Partial counts come before the shuffle."""
    values = {**rates(), "n_words": F.col("n_words")}
    long = metrics.where(F.col("n_words") > 0).select("lang", "source", F.explode(F.create_map(*[x for k, c in values.items() for x in (F.lit(k), bucket(c))])).alias("rate", "edge"))
    return long.groupBy("lang", "source", "rate", "edge").agg(F.count("*").alias("n"))


def _quantile(q: int) -> Column:
    """Lower edge of the bucket of a sketch `s` that holds its q-th percentile."""
    state = F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(None).cast("bigint").alias("edge"))
    found = F.aggregate(
        "s",
        state,
        lambda a, x: F.struct((a["seen"] + x["n"]).alias("seen"), F.when(a["edge"].isNull() & ((a["seen"] + x["n"]) * 100 >= F.col("texts") * q), x["edge"]).otherwise(a["edge"]).alias("edge")),
    )
    return found["edge"]


def limits_of(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Per group its texts, median words, and limit and median of each rate, out of the merged sketches."""
    merged = sketch.groupBy(*keys, "rate", "edge").agg(F.sum("n").alias("n"))
    # A sketch has a bounded number of buckets (64 and 32 for each further doubling), so one row can hold it.
    whole = merged.groupBy(*keys, "rate").agg(F.array_sort(F.collect_list(F.struct("edge", "n"))).alias("s"), F.sum("n").alias("texts"))
    quartiles = whole.select(*keys, "rate", "texts", F.struct(*[_quantile(q).alias(f"q{q}") for q in (25, 50, 75)]).alias("q"))
    wide = quartiles.groupBy(*keys).agg(F.max("texts").alias("texts"), *[F.max(F.when(F.col("rate") == k, F.col("q"))).alias(k) for k in (*RATES, "n_words")])
    words = F.col("n_words.q50")

    def limit(rate: str) -> Column:
        q25, q50, q75 = (F.col(f"{rate}.q{q}") for q in (25, 50, 75))
        grain = F.floor(EVENTS[rate] * SCALE / words) if rate in EVENTS else F.floor(LENGTH_SCALE / F.sqrt(words))
        return F.least(q75 + FENCE * F.greatest(q75 - q50, q50 - q25, grain), q50 + 2 * FENCE * F.greatest(q50 - q25, grain))

    return wide.select(*keys, "texts", words.alias("median_words"), *[x for k in RATES for x in (limit(k).alias(f"max_{k}"), F.col(f"{k}.q50").alias(f"median_{k}"))])


LIMITS = ["median_words", *[f"{x}_{k}" for k in RATES for x in ("max", "median")]]


def thresholds(metrics: DataFrame) -> DataFrame:
    """One row per (lang, source): its texts, and the limits and medians that hold for it."""
    s = cut(sketches(metrics))
    own, by_lang = limits_of(s, ["lang", "source"]), limits_of(s, ["lang"]).select(F.col("lang").alias("of_lang"), *[F.col(c).alias(f"lang_{c}") for c in ("texts", *LIMITS)])
    whole = limits_of(s, []).first()  # one row for the corpus; none if it has no words
    first = lambda c: F.when(F.col("texts") >= MIN_GROUP, F.col(c)).when(F.col("lang_texts") >= MIN_GROUP, F.col(f"lang_{c}")).otherwise(F.lit(whole[c] if whole else None).cast("bigint"))
    return own.join(by_lang, F.col("lang").eqNullSafe(F.col("of_lang"))).select("lang", "source", "texts", *[first(c).alias(c) for c in LIMITS])


def verdict(metrics: DataFrame, limits: DataFrame) -> DataFrame:
    """Add base_failed and kept.

    A group without a text that has words has no limits, and its texts fail the base rules.  ``kept`` is one CASE rather than a conjunction: a
    filter on it then stays above the join, where the counts are columns, and is not pushed below the projections that compute them.
    """
    wordless = metrics.where("n_words = 0").withColumns({c: F.lit(None).cast("bigint") for c in LIMITS})
    out = group_join(metrics.where("n_words > 0"), limits, ["lang", "source"], "texts").drop("texts").unionByName(wordless)
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))

    def off(rate: str, value: Column) -> Column:
        most, middle, words = (F.col(c) for c in (f"max_{rate}", f"median_{rate}", "median_words"))
        return (value - middle) * F.least(F.col("n_words"), words) > (most - middle) * words

    bad = reduce(or_, [F.coalesce(off(k, c), F.lit(False)) for k, c in rates().items()])
    return out.withColumn("base_failed", failed).withColumn("kept", F.when(failed, F.lit(False)).otherwise(~bad))


def score(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, the five counts, base_failed, kept and the limits that applied: one row per document."""
    metrics = cut(with_metrics(narrow(docs, "doc_id", "text", "lang", "source")))
    return verdict(metrics, thresholds(metrics)).select("doc_id", "lang", "source", *METRICS, "base_failed", "kept", *LIMITS)


def keep(docs: DataFrame) -> DataFrame:
    """The documents that pass, with all their columns.

    Documents and counts are written once as a table, so nothing is counted twice and the sketches read the counts alone.
    """
    rows = written(with_metrics(nested(docs, "text", "lang", "source")), "quality")
    return verdict(rows, thresholds(rows.drop("document"))).where("kept").select("document.*")

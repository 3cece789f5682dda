"""Line dedup: a suffix array over line-id sequences by distributed prefix doubling, and its intervals of repeated runs.

The corpus is a sequence of lines.  Only lines found twice or more can lie in a repeated run, so each stretch of such lines is a string of its
own, its end a sentinel.  Prefix doubling ranks every suffix by its first 1, 2, 4, ... lines: a suffix's pair of ranks (its own,
and that of the suffix 2^k further) is sorted over the cluster, and its place in that order is its next rank.

A run counts when it holds MIN_WORDS words or more.  From each line on there is a shortest run that does, and up to each line there is one;
any longer repeated run is the union of such runs inside it.  The suffixes that share a run's lines are an interval of the suffix
array with a common prefix of that length; the run of m lines with 2^k <= m is known by its rank of 2^k lines at its start and that at its end less 2^k.  Where an
interval's first place lies before a run, the run is a later copy and its lines are deleted; overlapping runs make up the maximal repeated
run.  The array is therefore bounded on purpose: it sorts suffixes by as many lines as the longest shortest run has, which is MIN_WORDS at most,
and doubling ends after log2(MIN_WORDS) rounds; ranks of a run's two ends stand for the intervals of longer common prefixes.

Order is by doc_id (null last), then the text's md5, then line.  Blank lines are never deleted and do not break a run.

Defined results: null text stays null; repeated rows (same doc_id and text) are one document, and all get its result; a document all of
whose lines are copies is left with an empty text or its blank lines; an empty table gives an empty table; extra columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Stored, counted_join, cut, narrow, nested, removed, running, words_of

MIN_WORDS = 50

_DOC = ["no_id", "doc_id", "key_a", "key_b"]


def keyed(rows: DataFrame) -> DataFrame:
    """Replace doc_id by the key of its document, in whose order documents come: id, null last, then the 60 leading bits of the text's md5."""
    text = F.coalesce("text", F.lit(""))
    order = F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")
    others = [c for c in rows.columns if c != "doc_id"]
    return rows.select(F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("doc_id"), order.alias("key_a"), F.xxhash64(text).alias("key_b"), *others)


def lines(docs: DataFrame) -> DataFrame:
    """The lines with a word of every distinct document: its key, line (place among them), at (place in the text), hash, words."""
    own = keyed(narrow(docs, "doc_id", "text").where(F.col("text").isNotNull()))
    split = own.select(*_DOC, F.split("text", "\n").alias("all"))
    # the place among lines with a word is counted inside the row, before anything is exploded
    worded = F.filter(F.transform("all", lambda x, i: F.struct(i.alias("at"), x.alias("x"))), lambda s: s["x"].rlike(r"[^\x20\x09-\x0D]"))
    each = split.select(*_DOC, F.posexplode(worded).alias("line", "s"))
    return each.select(*_DOC, "line", F.col("s.at").alias("at"), F.xxhash64(F.lit(3), "s.x").alias("h1"), F.xxhash64("s.x", F.lit(5)).alias("h2"), F.size(words_of(F.col("s.x"))).alias("words")).distinct()


def ranked(df: DataFrame, keys: list[str]) -> DataFrame:
    """keys and n of each distinct combination, with the number of rows in combinations before it as rank."""
    return cut(running(df.groupBy(*keys).agg(F.count("*").alias("n")), keys, {"rank": "n"}))


def suffixes(all_lines: DataFrame) -> DataFrame:
    """Suffixes that begin with a repeated line: p, a place in the whole sequence (gaps end a string), words and rank 0."""
    repeated = ranked(all_lines.select("h1", "h2"), ["h1", "h2"]).where("n > 1").withColumnRenamed("rank", "r0")
    kept = cut(counted_join(all_lines, repeated, ["h1", "h2"]).drop("n", "h1", "h2"))
    # documents get consecutive ranges of places in their order, with a gap after each
    sizes = kept.groupBy(*_DOC).agg((F.max("line") + 2).cast("bigint").alias("size"))
    first = running(sizes, _DOC, {"first": "size"})
    return kept.join(first, _DOC).select(*_DOC, "at", (F.col("first") + F.col("line")).alias("p"), "words", "r0")


def runs(found: DataFrame, min_words: int) -> DataFrame:
    """p, m: the shortest runs of min_words words from each line and up to each line, inside strings of consecutive places."""
    w = Window.partitionBy(*_DOC, "string").orderBy("p")
    doc = Window.partitionBy(*_DOC).orderBy("p")
    strings = found.withColumn("string", F.col("p") - F.row_number().over(doc))
    near = strings.withColumn("ahead", F.collect_list("words").over(w.rowsBetween(0, min_words - 1))).withColumn("behind", F.collect_list("words").over(w.rowsBetween(-min_words + 1, 0)))

    def shortest(a):
        state = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("n"))
        step = lambda s, x: F.struct(F.when(s["sum"] < min_words, s["sum"] + x).otherwise(s["sum"]).alias("sum"), F.when(s["sum"] < min_words, s["n"] + 1).otherwise(s["n"]).alias("n"))
        return F.aggregate(a, state, step, lambda s: F.when(s["sum"] >= min_words, s["n"]))

    sized = near.select("p", shortest(F.col("ahead")).alias("m"), shortest(F.reverse("behind")).alias("e"))
    from_here = sized.where("m is not null").select("p", "m")
    up_to_here = sized.where("e is not null").select((F.col("p") - F.col("e") + 1).alias("p"), F.col("e").alias("m"))
    return from_here.union(up_to_here).distinct()


def copies(found: DataFrame, min_words: int) -> DataFrame:
    """p of every line that lies in a run found earlier too."""
    wanted = cut(runs(found, min_words))
    longest = wanted.agg(F.max("m")).first()[0] or 0
    rank, state, k, hits = found.select("p", F.col("r0").alias("r")), None, 0, None
    while (1 << k) <= longest:
        # runs of 2^k to 2^(k+1) - 1 lines: suffixes that agree in both ranks form one interval
        own = wanted.where((F.col("m") >= 1 << k) & (F.col("m") < 2 << k))
        tail = rank.select(F.col("p").alias("q"), F.col("r").alias("t"))
        named = cut(own.join(rank, "p").withColumn("q", F.col("p") + F.col("m") - (1 << k)).join(tail, "q").select("p", "m", "r", "t"))
        first = cut(named.groupBy("m", "r", "t").agg(F.min("p").alias("first"), F.count("*").alias("n")).where("n > 1"))
        later = cut(counted_join(named, first, ["m", "r", "t"]).where("p > first").select("p", "m"))
        hits = later if hits is None else hits.union(later)
        k += 1
        if (1 << k) > longest:
            break
        # prefix doubling: the pair of ranks, sorted, gives the rank by twice as many lines; no suffix there is the sentinel
        further = rank.select((F.col("p") - (1 << (k - 1))).alias("p"), F.col("r").alias("s"))
        pairs = cut(rank.join(further, "p", "left").select("p", "r", F.coalesce("s", F.lit(-1).cast("bigint")).alias("s")))
        doubled = counted_join(pairs, ranked(pairs, ["r", "s"]), ["r", "s"]).select("p", F.col("rank").alias("r"))
        state = Stored(doubled, "ranks") if state is None else state.replaced(doubled, "ranks")
        rank = state.table
    if state:
        removed(found.sparkSession, state.folder)
    return found.select("p").limit(0) if hits is None else hits.select(F.explode(F.expr("sequence(p, p + m - 1)")).alias("p")).distinct()


def _text(docs: DataFrame) -> Column:
    return F.col("document.text") if any(c.lower() == "text" for c in docs.columns) else F.lit(None).cast("string")


def deletions(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """A document's key, gone (places of deleted lines, in order), gone_words: one row per document that loses lines."""
    found = cut(suffixes(cut(lines(docs))))
    lost = found.join(copies(found, min_words), "p")
    return lost.groupBy(*_DOC).agg(F.array_sort(F.collect_list("at")).alias("gone"), F.sum("words").alias("gone_words"))


def apply(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """document (all its columns), text without its later copies, gone, gone_words."""
    # the lists grow with the corpus, so they meet the texts by shuffle at every size
    lost = cut(deletions(docs, min_words))
    # the text goes through the shuffle once, inside its document
    joined = keyed(nested(docs, "doc_id", "text")).drop("text").join(lost, _DOC, "left").withColumn("text", _text(docs))
    # both lists are in order, so one pass over the deleted places cuts the kept stretches between them
    all_lines = F.split("text", "\n")
    bounds = F.concat(F.array(F.lit(-1)), "gone", F.array(F.size(all_lines)))
    stretches = F.zip_with(bounds, F.slice(bounds, 2, F.size(bounds)), lambda a, b: F.when(b - a > 1, F.struct((a + 2).alias("at"), (b - a - 1).alias("n"))))
    left = F.array_join(F.flatten(F.transform(F.filter(stretches, lambda s: s.isNotNull()), lambda s: F.slice(all_lines, s["at"], s["n"]))), "\n")
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(left)
    return joined.select("document", text.alias("text"), F.coalesce("gone", F.array().cast("array<int>")).alias("gone"), F.coalesce("gone_words", F.lit(0)).cast("bigint").alias("gone_words"))


def dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents with their later copies of line runs deleted, all columns as they were."""
    done = apply(docs, min_words)
    return done.select(*[F.col("text").alias(c) if c.lower() == "text" else F.col(f"document.`{c}`").alias(c) for c in docs.columns])

"""Mixing sources to target weights by the cube method.

Every source's target number of words over its size is the expected number of copies of each of its documents.  The whole part is given
to all; the fraction is an inclusion probability.  The flight moves three documents' probabilities at a time along the null space of two
constraints, the source's number of documents and its number of words, until one is 0 or 1; so both totals hold exactly
throughout.  Documents are dealt to groups by hash; what each group leaves undecided (at most two) is dealt again, until one group per
source remains, whose last two are landed on the rounding nearest to the words that are due.  Random choices come from hashes, so reruns agree.

Defined results: null text has size 0 and is taken for 0 words; a null source is a source, the last; rows equal in doc_id, text and source
are decided together; a source without words has target 0; an empty table gives an empty table; extra columns are kept by ``mix``.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import counted_join, cut, group_join, narrow, nested, words_of

#: Weights of the sources in code-point order, repeating; share of all words that the mix holds; most a source is repeated.
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2.0
GROUP = 2_000
_EPS = 1e-9


def _key() -> list[Column]:
    d, t, s = (F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in ("doc_id", "text", "source"))
    return [F.xxhash64(F.lit(1), d, t, s).alias("key_a"), F.xxhash64(s, t, F.lit(2), d).alias("key_b")]


def ranks(sources: DataFrame) -> DataFrame:
    """Add place, the number of sources before each in code-point order, null last; sorted over the cluster."""
    null = F.col("source").isNull()
    placed = cut(sources.repartitionByRange(null, F.col("source")).sortWithinPartitions(null, "source").withColumn("part", F.spark_partition_id()).withColumn("inside", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)))
    parts = placed.groupBy("part").agg(F.count("*").alias("n"))
    before = parts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return placed.join(F.broadcast(before), "part").withColumn("place", F.col("before") + F.col("inside")).drop("part", "inside", "before", "n")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """source, source_size, rows, target: shares by weight, a source above its most held there and the excess shared anew."""
    totals = ranks(sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows")))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod("place", F.lit(len(weights))) + 1).cast("int"))
    open_ = cut(totals.withColumn("weight", weight).withColumn("cap", most * F.col("source_size")))
    whole = share * float(open_.agg(F.sum("source_size")).first()[0] or 0)
    held = F.lit(False)
    level = None
    while True:  # each round holds at least one more source
        r = open_.agg(F.sum(F.when(held, F.col("cap"))).alias("cap"), F.sum(F.when(~held, F.col("weight"))).alias("weight"), F.sum(F.when(held, 1).otherwise(0)).alias("n")).first()
        if not r["weight"]:
            return open_.select("source", "source_size", "rows", F.col("cap").alias("target"))
        level = (whole - (r["cap"] or 0.0)) / r["weight"]
        now = F.lit(level) * F.col("weight") >= F.col("cap")
        if open_.where(now).count() == r["n"]:
            break
        held = now
    return open_.select("source", "source_size", "rows", F.when(now, F.col("cap")).otherwise(F.lit(level) * F.col("weight")).alias("target"))


def flight(p: np.ndarray, count: np.ndarray, size: np.ndarray, seed: int) -> np.ndarray:
    """Probabilities moved until at most two are undecided, with sum(p * count) and sum(p * size) unchanged."""
    rng = np.random.default_rng(seed)
    draws = iter(rng.random(2 * len(p) + 8).tolist())
    p, a, b = p.tolist(), count.tolist(), size.tolist()
    hand: list[int] = []
    for k in range(len(p)):
        if _EPS < p[k] < 1 - _EPS:
            hand.append(k)
        else:
            p[k] = float(round(p[k]))
        while len(hand) == 3:
            i, j, m = hand
            u = (a[j] * b[m] - a[m] * b[j], a[m] * b[i] - a[i] * b[m], a[i] * b[j] - a[j] * b[i])
            if not any(u):  # the two constraints are in proportion: any two of the three may trade
                u = (a[j], -a[i], 0.0) if a[i] or a[j] else (1.0, 0.0, 0.0)
            up = min((1 - p[x]) / v if v > 0 else -p[x] / v for x, v in zip(hand, u, strict=True) if v)
            down = min(p[x] / v if v > 0 else (p[x] - 1) / v for x, v in zip(hand, u, strict=True) if v)
            step = up if next(draws, 0.5) * (up + down) < down else -down
            for x, v in zip(hand, u, strict=True):
                p[x] = min(1.0, max(0.0, p[x] + step * v))
                if p[x] < _EPS or p[x] > 1 - _EPS:
                    p[x] = float(round(p[x]))
            hand = [x for x in hand if 0 < p[x] < 1]
    return np.array(p)


def land(p: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The rounding of at most two undecided probabilities whose words are nearest to those due."""
    left = np.flatnonzero((p > 0) & (p < 1))
    due = float((p[left] * size[left]).sum())
    choices = [[(k >> i) & 1 for i in range(len(left))] for k in range(1 << len(left))]
    best = min(choices, key=lambda c: (abs(float(np.dot(c, size[left])) - due), abs(sum(c) - p[left].sum()), c))
    p = p.copy()
    p[left] = best
    return p


def _flown(units: DataFrame, last: bool) -> DataFrame:
    schema = "source string, key_a bigint, key_b bigint, n bigint, words bigint, p double"

    def over(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["key_a", "key_b"], kind="stable")
        seed = zlib.crc32(f"{pdf['source'].iloc[0]}/{int(pdf['part'].iloc[0])}".encode())
        size = pdf["words"].to_numpy(np.float64)
        p = flight(pdf["p"].to_numpy(np.float64), pdf["n"].to_numpy(np.float64), size, seed)
        return pdf.assign(p=land(p, size) if last else p)[["source", "key_a", "key_b", "n", "words", "p"]]

    return units.groupBy("source", "part").applyInPandas(over, schema)


def decide(sizes: DataFrame, goals: DataFrame) -> DataFrame:
    """key_a, key_b, copies: how often each document is taken; n rows have that key."""
    goals = goals.select("source", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)).alias("rate"), "rows")
    own = sizes.groupBy("key_a", "key_b").agg(F.first("source").alias("source"), F.first("size").alias("size"), F.count("*").alias("n"))
    units = cut(group_join(own, goals, ["source"], "rows").select("source", "key_a", "key_b", "n", (F.col("n") * F.col("size")).alias("words"), "rate", "rows"))
    whole = units.select("key_a", "key_b", "n", F.floor("rate").alias("copies"))
    left = units.withColumn("p", F.col("rate") - F.floor("rate")).where(F.col("p") > _EPS)
    many, taken = F.ceil(F.col("rows") / GROUP), None
    while True:
        dealt = left.withColumn("part", F.pmod(F.xxhash64("key_a", F.lit(9)), many).cast("int")).drop("rows", "rate")
        most = left.select(F.max(many)).first()[0] or 1
        flown = cut(_flown(dealt, last=most <= 1))
        sure = flown.where(F.col("p").isin(0.0, 1.0)).select("key_a", "key_b", F.col("p").cast("bigint").alias("more"))
        taken = sure if taken is None else taken.unionByName(sure)
        if most <= 1:
            break
        rest = flown.where(~F.col("p").isin(0.0, 1.0))
        left = cut(group_join(rest, rest.groupBy("source").agg(F.count("*").alias("rows")), ["source"], "rows"))
        many = F.ceil(F.col("rows") / GROUP)
    return whole.join(taken, ["key_a", "key_b"], "left").select("key_a", "key_b", "n", (F.col("copies") + F.coalesce("more", F.lit(0))).cast("bigint").alias("copies"))


def plan(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sizes of all rows, targets of all sources, copies of all documents."""
    sizes = cut(narrow(docs, "doc_id", "text", "source").select("doc_id", "source", F.size(words_of(F.col("text"))).cast("bigint").alias("size"), *_key()))
    goals = cut(targets(sizes))
    return sizes, goals, cut(decide(sizes, goals))


def taken(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies: one row per document."""
    sizes, goals, copies = plan(docs)
    rows = group_join(counted_join(sizes, copies, ["key_a", "key_b"]), goals, ["source"], "rows")
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def mix(docs: DataFrame) -> DataFrame:
    """The documents as often as the mix takes them, with all their columns."""
    _, _, copies = plan(docs)
    whole = nested(docs, "doc_id", "text", "source").select("document", *_key())
    found = counted_join(whole, copies, ["key_a", "key_b"]).where("copies > 0")
    return found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))).select("document.*")

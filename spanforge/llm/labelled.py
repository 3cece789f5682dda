"""Bounded samples of labelled texts, for fitting classifiers on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import is_held_out, narrow

#: A text longer than this is not picked for learning, so a sample's size in memory is bounded; it is scored like any other.
MAX_LEARN_CHARS = 50_000


def learnable(labels: DataFrame, value: str, modulus: int, remainder: int) -> DataFrame:
    """doc_id, y of the labelled rows that may be learned from; an id labelled twice has its largest label."""
    own = labels.where(F.col("doc_id").isNotNull() & F.col(value).isNotNull() & ~is_held_out(F.col("doc_id"), modulus, remainder))
    return own.groupBy("doc_id").agg(F.max(value).alias("y"))


def labelled_texts(docs: DataFrame, labels: DataFrame, value: str, modulus: int, remainder: int, per_class: int) -> tuple[list[tuple[str, int]], float]:
    """At most per_class texts of each label, picked by a hash of the id, and the share of label 1 among all that may be learned from."""
    own = learnable(labels, value, modulus, remainder).cache()
    counts = {int(r["y"]): r["n"] for r in own.groupBy("y").agg(F.count("*").alias("n")).collect() if r["y"] in (0, 1)}
    picked = [r for y in (0, 1) for r in own.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class).collect()]
    own.unpersist()
    if not picked:
        return [], 0.5
    chosen = F.broadcast(docs.sparkSession.createDataFrame([(r["doc_id"], int(r["y"])) for r in picked], "doc_id bigint, y int"))  # at most 2 * per_class rows
    found = narrow(docs, "doc_id", "text").where(F.col("text").isNotNull() & (F.length("text") <= MAX_LEARN_CHARS)).join(chosen, "doc_id")
    rows = found.groupBy("doc_id", "y").agg(F.min("text").alias("text")).collect()
    total = sum(counts.values())
    return sorted((r["text"], r["y"]) for r in rows), counts.get(1, 0) / total if total else 0.5

"""A training-data pipeline over ``documents``: rules, line dedup, near-dedup, mixing and packing.

Each stage takes what its predecessor kept.  ``run`` writes every stage as Parquet under the shared folder of
spark.checkpoint.dir and reads it again, so a lost executor never costs more than one stage.  A stage's table is removed
when the next one is written, the last ones when the application ends.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spanforge.llm import line_dedup, mixing, near_copies, packing, quality_rules
from spanforge.llm.common import removed, scratch
from spanforge.llm.queries import tokenizer_path


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.keep(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of line runs; their n_chars, where there is one, stays that of the source."""
    return line_dedup.dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, Jaccard 0.8 or more), the one with the smallest doc_id."""
    return near_copies.keep(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token windows: one row per piece of a document."""
    return packing.pack(docs, tokenizer_path())


STAGES = [("quality_rules", rules), ("line_dedup", lines), ("simhash_near_dedup", near), ("mixing", mixture), ("packing", packed)]

#: Suffix arrays, components, sampling and packing have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if k:
            removed(spark, f"{folder}/{STAGES[k - 1][0]}")
    return STAGES[-1][1](spark, docs, sf_dir)

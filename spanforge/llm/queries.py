"""The operators' registered queries over whole tables, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import langid, line_crf, line_dedup, media_audio, mixing, packing, quality_rules, sharding, simhash, toxicity
from .sql import ORACLE_SQL

__all__ = ["ORACLE_SQL", "QUERIES"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.score(_table(spark, sf_dir, "documents")).select("doc_id", *quality_rules.METRICS, "base_failed", "kept", *quality_rules.LIMITS)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))


def op3_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return line_crf.score(docs, line_crf.train(docs, _table(spark, sf_dir, "labels")))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(_table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.apply(_table(spark, sf_dir, "documents"))
    return done.select(F.col("document.doc_id").cast("bigint").alias("doc_id"), "text", F.size("gone").cast("bigint").alias("n_deleted"), "gone_words", F.array_join(F.col("gone").cast("array<string>"), ",").alias("deleted_lines"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op7_media_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_audio.audio_features(_table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path())


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(_table(spark, sf_dir, "documents"))


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.train(docs))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_quality_rules, op2_toxicity, op3_quality_crf, op4_sharding, op5_line_dedup, op6_simhash, op7_media_audio, op8_packing, op9_mixing, op10_langid)
}

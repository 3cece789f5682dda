"""Incremental builds as a stream: new shot tables land in a folder, and their segments are appended once.

An addition to the batch plans: the same functions run per micro-batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def build_on_arrival(spark: SparkSession, folder: str, schema: str, build: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Process what has arrived since the last call, then stop; the checkpoint remembers what was done."""
    arrivals = spark.readStream.schema(schema).parquet(folder)

    def write(batch: DataFrame, number: int) -> None:
        # a batch that is repeated after a failure replaces its own folder, so rows appear once
        build(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return arrivals.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def speech_sessions(words: DataFrame, gap: str = "30 seconds", late: str = "1 minute") -> DataFrame:
    """Runs of words no further apart than gap, per video, closed by the watermark."""
    timed = words.withWatermark("ts", late)
    return timed.groupBy("video_id", F.session_window("ts", gap).alias("s")).agg(F.count("*").alias("n_words")).select("video_id", F.col("s.start").alias("start"), F.col("s.end").alias("end"), "n_words")

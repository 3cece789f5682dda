"""Writers: prediction, shot and transcript documents, frames, and counts for the console."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .functions.ids import frame_file, transcript_file


def prediction_documents(scored: DataFrame, ranges: DataFrame) -> DataFrame:
    """video_id, video, document: soundbites and segments in order, as JSON."""
    rows = F.struct(
        F.col("segment_index").alias("index"), F.col("segment_start").alias("start"), F.col("segment_end").alias("end"),
        F.col("predicted").alias("prediction"), F.round("confidence", 4).alias("confidence"),
    )
    segments = scored.groupBy("video_id").agg(F.min("video_name").alias("video"), F.array_sort(F.collect_list(rows)).alias("segments"))
    bites = F.array_sort(F.collect_list(F.struct("place", "soundbite_start", "soundbite_end", "confidence")))
    found = ranges.groupBy("video_id").agg(F.transform(bites, lambda b: F.struct(b["soundbite_start"].alias("soundbite_start"), b["soundbite_end"].alias("soundbite_end"), b["confidence"].alias("confidence"))).alias("soundbites"))
    none = F.array().cast("array<struct<soundbite_start:double,soundbite_end:double,confidence:double>>")
    both = segments.join(found, "video_id", "left").withColumn("soundbites", F.coalesce("soundbites", none))
    return both.select("video_id", "video", F.to_json(F.struct("video", "soundbites", "segments"), {"pretty": "true"}).alias("document"))


def write_documents(documents: DataFrame, path: str, by: str = "video_id") -> None:
    """One text file per document, in a folder per video."""
    documents.select(by, F.col("document").alias("value")).write.mode("overwrite").partitionBy(by).text(path)


def transcript_documents(transcripts: DataFrame) -> DataFrame:
    """video_id, file_name, document: raw transcripts (video_id, path, document) as indented JSON; one that is no JSON fails the query."""

    def over(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            yield pdf.assign(document=[json.dumps(json.loads(d), ensure_ascii=False, indent=2) for d in pdf["document"]])

    named = transcripts.select("video_id", transcript_file(F.col("path")).alias("file_name"), "document")
    return named.mapInPandas(over, "video_id string, file_name string, document string")


def write_frames(frames: DataFrame, path: str) -> None:
    """Sampled frames as Parquet with the file name each would have."""
    name = frame_file(F.col("video_name"), F.col("segment_index"), F.col("sample_no"))
    frames.withColumn("file_name", name).write.mode("overwrite").parquet(path)


def summary(scored: DataFrame, ranges: DataFrame) -> DataFrame:
    """n_segments, n_positive, n_ranges over all videos."""
    counts = scored.agg(F.count("*").alias("n_segments"), F.count_if(F.col("predicted") == 1).alias("n_positive"))
    # both sides are one row
    return counts.withColumn("one", F.lit(1)).join(ranges.agg(F.count("*").alias("n_ranges")).withColumn("one", F.lit(1)), "one").drop("one")


def range_line(start: Column, end: Column, confidence: Column) -> Column:
    return F.format_string("%.3f - %.3f (%.4f)", start, end, confidence)

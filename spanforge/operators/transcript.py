"""Transcript features of segments: words that start in a segment, and audio activity that overlaps it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from .range_join import overlapping, points_in_segments

_KEY = ["video_id", "segment_index"]
_WORD_FEATURES = [c for c in C.TRANSCRIPT_COLUMNS if c != "num_audio_segments_overlap"]


def word_features(segments: DataFrame, words: DataFrame, width: float | None = None) -> DataFrame:
    """All features that come from words, one row per segment; a segment without words has its defaults."""
    placed = points_in_segments(segments, words, "start_time", width)
    order = Window.partitionBy(*_KEY).orderBy("start_time", "item_pos")
    gap = F.col("start_time") - F.lag("end_time").over(order)
    n = F.count("*")
    found = placed.withColumn("gap", gap).groupBy(*_KEY).agg(
        n.alias("n"),
        F.avg("conf").alias("confidence_mean"),
        F.stddev_pop("conf").alias("confidence_std"),
        F.min("conf").alias("confidence_min"),
        (F.count_if(F.col("conf") < C.LOW_CONFIDENCE) / n).alias("low_confidence_ratio"),
        (F.count_if(F.col("word").isin(*C.FILLERS)) / n).alias("filler_word_ratio"),
        F.sum(F.col("end_time") - F.col("start_time")).alias("spoken"),
        F.greatest(F.lit(0.0), F.max("gap")).alias("gap"),
    )
    length = F.col("segment_end") - F.col("segment_start")
    per_second = lambda c: F.when(length > 0, F.coalesce(c, F.lit(0.0)) / length).otherwise(F.lit(0.0))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    computed = {
        "word_count": F.coalesce(F.col("n"), F.lit(0)).cast("double"),
        "speech_rate": per_second(F.col("n").cast("double")),
        "confidence_mean": F.col("confidence_mean"),
        "confidence_std": F.col("confidence_std"),
        "confidence_min": F.col("confidence_min"),
        "low_confidence_ratio": zero("low_confidence_ratio"),
        "filler_word_ratio": zero("filler_word_ratio"),
        "speech_coverage": per_second(F.col("spoken")),
        "max_silence_gap": F.when(F.col("n").isNull(), length).otherwise(F.col("gap")),
    }
    return segments.join(found, _KEY, "left").select(*segments.columns, *[computed[c].alias(c) for c in _WORD_FEATURES])


def overlap_counts(segments: DataFrame, audio_segments: DataFrame, width: float | None = None) -> DataFrame:
    """num_audio_segments_overlap of every segment."""
    met = overlapping(segments, audio_segments, "start_time", "end_time", width).groupBy(*_KEY).agg(F.count("*").alias("n"))
    return segments.join(met, _KEY, "left").select(*segments.columns, F.coalesce(F.col("n"), F.lit(0)).cast("double").alias("num_audio_segments_overlap"))


def transcript_features(segments: DataFrame, words: DataFrame, audio_segments: DataFrame, width: float | None = None) -> DataFrame:
    own = word_features(segments, words, width)
    counts = overlap_counts(segments, audio_segments, width).select(*_KEY, "num_audio_segments_overlap")
    return own.join(counts, _KEY).select(*segments.columns, *C.TRANSCRIPT_COLUMNS)

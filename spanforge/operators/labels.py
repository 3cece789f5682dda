"""Labels of segments by overlap with annotated ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.intervals import is_match
from .range_join import overlapping

_KEY = ["video_id", "segment_index"]
_RULE = ("segment_start", "segment_end", "gt_start", "gt_end")


def positives(segments: DataFrame, truth: DataFrame, width: float | None = None) -> DataFrame:
    """The segments that any range makes positive, as a semi-join."""
    if width is None:
        s, g = segments.alias("s"), truth.alias("g")
        return s.join(g, (F.col("s.video_id") == F.col("g.video_id")) & is_match(*map(F.col, _RULE)), "left_semi")
    hit = overlapping(segments, truth, "gt_start", "gt_end", width).where(is_match(*map(F.col, _RULE))).select(*_KEY)
    return segments.join(hit, _KEY, "left_semi")


def label_segments(segments: DataFrame, truth: DataFrame | None, width: float | None = None) -> DataFrame:
    """label 1 or 0 for every segment; without a truth table (labels off) null, without ranges of a video 0."""
    if truth is None:
        return segments.withColumn("label", F.lit(None).cast("int"))
    met = overlapping(segments, truth, "gt_start", "gt_end", width)
    hit = met.groupBy(*_KEY).agg(F.max(is_match(*map(F.col, _RULE)).cast("int")).alias("label"))
    return segments.join(hit, _KEY, "left").select(*segments.columns, F.coalesce("label", F.lit(0)).alias("label"))


def label_counts(labelled: DataFrame, by: str = "video_id") -> DataFrame:
    return labelled.groupBy(by).agg(F.count("*").alias("n_segments"), F.coalesce(F.sum(F.col("label").cast("bigint")), F.lit(0)).alias("n_positive"))

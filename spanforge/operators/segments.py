"""Segments out of shot boundaries, and their temporal features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C


def build_segments(shots: DataFrame, videos: DataFrame) -> DataFrame:
    """Each shot lasts to the next in list order, the last one to the video's end; a video without shots has no segments."""
    order = Window.partitionBy("video_id").orderBy("shot_index")
    following = F.lead("shot_time").over(order)
    index = (F.row_number().over(order) - 1).alias("segment_index")
    listed = shots.select("video_id", index, F.col("shot_time").alias("segment_start"), following.alias("next"), F.lead("shot_index").over(order).isNull().alias("last"))
    ended = F.when(F.col("last"), F.col("duration")).otherwise(F.col("next"))
    return listed.join(videos.select("video_id", "duration"), "video_id").select("video_id", "segment_index", "segment_start", ended.alias("segment_end"))


def explode_shots(lists: DataFrame, times: str = "shot_times") -> DataFrame:
    """video_id and an array of times to the relational form; places start at 0."""
    return lists.select("video_id", F.posexplode(times).alias("shot_index", "shot_time"))


def temporal(start: Column, end: Column, duration: Column) -> list[Column]:
    """segment_duration, and the middle's place in the video (0 where that has no length)."""
    place = F.when(duration > 0, (start + end) / 2 / duration).otherwise(F.lit(0.0))
    return [(end - start).alias("segment_duration"), place.alias("relative_position")]


def with_temporal(segments: DataFrame, videos: DataFrame) -> DataFrame:
    known = segments.join(videos.select("video_id", "duration"), "video_id")
    return known.select(*segments.columns, *temporal(F.col("segment_start"), F.col("segment_end"), F.col("duration")))


def sample_times(segments: DataFrame) -> DataFrame:
    """sample_no and sample_time of the frames looked at in each segment; without length, its start."""
    length = F.greatest(F.col("segment_end") - F.col("segment_start"), F.lit(0.0))
    times = F.array(*[F.col("segment_start") + f * length for f in C.SAMPLE_FRACTIONS])
    return segments.select(*segments.columns, F.posexplode(times).alias("sample_no", "sample_time"))

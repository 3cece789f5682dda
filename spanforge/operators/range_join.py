"""Range joins per video.

The plain form is an equi-join on the video with the range as a residual condition.  Its work grows with segments times items
of a video, so for long videos ``width`` buckets time: both sides are joined on (video, bucket) as well.  An item's point has
one bucket and an interval all that it meets; a pair of intervals is kept in the bucket where their intersection begins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.intervals import inside, touches


def _bucket(x: Column, width: float) -> Column:
    return F.floor(x / width).cast("bigint")


def _spread(df: DataFrame, start: str, end: str, width: float) -> DataFrame:
    """A row per bucket that the interval meets; an empty or reversed interval meets none."""
    real = F.col(end) > F.col(start)
    return df.where(real).withColumn("bucket", F.explode(F.sequence(_bucket(F.col(start), width), _bucket(F.col(end), width))))


def points_in_segments(segments: DataFrame, points: DataFrame, at: str, width: float | None = None) -> DataFrame:
    """Inner join of segments and points with segment_start <= at < segment_end."""
    held = inside(F.col(at), F.col("segment_start"), F.col("segment_end"))
    if width is None:
        return segments.join(points, "video_id").where(held)
    dealt = points.withColumn("bucket", _bucket(F.col(at), width))
    return _spread(segments, "segment_start", "segment_end", width).join(dealt, ["video_id", "bucket"]).where(held).drop("bucket")


def overlapping(segments: DataFrame, ranges: DataFrame, start: str, end: str, width: float | None = None) -> DataFrame:
    """Inner join of segments and ranges that strictly overlap."""
    held = touches(F.col(start), F.col(end), F.col("segment_start"), F.col("segment_end"))
    if width is None:
        return segments.join(ranges, "video_id").where(held)
    # Only ranges and segments of positive length can be bucketed; others are joined plainly, and are few.
    first = _bucket(F.greatest(F.col(start), F.col("segment_start")), width) == F.col("bucket")
    both = _spread(segments, "segment_start", "segment_end", width).join(_spread(ranges, start, end, width), ["video_id", "bucket"]).where(held & first).drop("bucket")
    odd_segments, odd_ranges = segments.where("segment_end <= segment_start"), ranges.where(F.col(end) <= F.col(start))
    rest = odd_segments.join(ranges, "video_id").where(held).unionByName(segments.where("segment_end > segment_start").join(odd_ranges, "video_id").where(held))
    return both.unionByName(rest)

"""Visual features: the largest face's share of the frame, from a table of detected boxes or a pluggable detector."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C

BOXES = "array<struct<x1: double, y1: double, x2: double, y2: double, conf: double>>"


def confident(boxes: Column) -> Column:
    return F.filter(boxes, lambda b: b["conf"] >= C.MIN_FACE_CONFIDENCE)


def scaled(boxes: Column, width: Column, height: Column) -> Column:
    """Relative boxes in pixels: the upper left corner is held at 0 or more, the lower right one at 1 or less."""
    return F.transform(
        boxes,
        lambda b: F.struct(
            (F.greatest(F.lit(0.0), b["x1"]) * width).alias("x1"), (F.greatest(F.lit(0.0), b["y1"]) * height).alias("y1"),
            (F.least(F.lit(1.0), b["x2"]) * width).alias("x2"), (F.least(F.lit(1.0), b["y2"]) * height).alias("y2"), b["conf"].alias("conf"),
        ),
    )


def face_ratio(boxes: Column, width: Column, height: Column) -> Column:
    """Largest box area over the frame's; 0 without boxes or with an empty frame."""
    area = F.array_max(F.transform(boxes, lambda b: (b["x2"] - b["x1"]) * (b["y2"] - b["y1"])))
    return F.coalesce(area / F.nullif(width * height, F.lit(0)), F.lit(0.0))


def visual_features(segments: DataFrame, faces: DataFrame) -> DataFrame:
    """face_area_ratio: the larger ratio of a segment's sampled frames; frames that failed have no row."""
    best = faces.groupBy("video_id", "segment_index").agg(F.max(face_ratio(F.col("boxes"), F.col("width"), F.col("height"))).alias("face_area_ratio"))
    return segments.join(best, ["video_id", "segment_index"], "left").select(*segments.columns, F.coalesce("face_area_ratio", F.lit(0.0)).alias("face_area_ratio"))


def detect_faces(frames: DataFrame, load: Callable[[], Callable[[bytes], tuple[int, int, Iterable[tuple]] | None]], fallback: Callable | None = None) -> DataFrame:
    """height, width and boxes of encoded frames by a detector that ``load`` makes once per worker.

    A loader that fails hands over to ``fallback``; a frame that the detector cannot read has no row.
    """
    kinds = ", ".join(f"`{k}` {t}" for k, t in frames.dtypes if k != "content")

    def over(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        try:
            detector = load()
        except Exception:
            if fallback is None:
                raise
            detector = fallback()
        for pdf in parts:
            found = [detector(bytes(c)) if c is not None else None for c in pdf["content"]]
            kept = [f for f in found if f is not None]
            if not kept:
                continue
            ok = [f is not None for f in found]
            names = ("x1", "y1", "x2", "y2", "conf")
            yield pdf[ok].drop(columns="content").assign(height=[f[0] for f in kept], width=[f[1] for f in kept], boxes=[[dict(zip(names, map(float, b), strict=True)) for b in f[2]] for f in kept])

    return frames.mapInPandas(over, f"{kinds}, height int, width int, boxes {BOXES}")


def frame_lookup(samples: DataFrame, frames: DataFrame, fps: float = C.FRAMES_PER_SECOND) -> DataFrame:
    """Join sampled times with decoded frames by the nearest frame index; frames that are missing have no row."""
    return samples.withColumn("frame_index", F.round(F.col("sample_time") * fps).cast("int")).join(frames, ["video_id", "frame_index"])


def frame_statistics(frames: DataFrame, decode: Callable[[bytes], object]) -> DataFrame:
    """brightness and readable of encoded frames; ``decode`` returns an array of pixels or None."""

    def over(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            pixels = [decode(bytes(c)) if c is not None else None for c in pdf["content"]]
            yield pdf[["video_id", "frame_index"]].assign(brightness=[None if p is None else float(p.mean()) for p in pixels], readable=[p is not None for p in pixels])

    return frames.select("video_id", "frame_index", "content").mapInPandas(over, "video_id string, frame_index int, brightness double, readable boolean")


def frame_differences(pairs: DataFrame, decode: Callable[[bytes], object]) -> DataFrame:
    """mean_abs_diff of frame pairs (before_index, after_index, before, after)."""

    def over(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            values = [abs(decode(bytes(a)).astype("float32") - decode(bytes(b)).astype("float32")).mean() for a, b in zip(pdf["before"], pdf["after"], strict=True)]
            yield pdf[["video_id", "before_index", "after_index"]].assign(mean_abs_diff=[float(v) for v in values])

    return pairs.mapInPandas(over, "video_id string, before_index int, after_index int, mean_abs_diff double")

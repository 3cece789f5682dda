"""Shot detection over decoded frame tables: adaptive cuts, flash filter, and the shot document."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import ShotSettings
from ..functions.timecode import frame_to_smpte, scene_fps, smpte_to_seconds


def content_score(deltas: list[Column], settings: ShotSettings = ShotSettings()) -> Column:
    """Weighted mean of a frame's mean absolute changes of hue, saturation, luma and edges."""
    whole = sum(abs(w) for w in settings.weights)
    return reduce(add, [d * w for d, w in zip(deltas, settings.weights, strict=True)]) / whole


def cut_ratio(frames: DataFrame, settings: ShotSettings = ShotSettings()) -> DataFrame:
    """Add ratio: a frame's score over the mean of its neighbours in a full centred window; null where the window is cut off."""
    w = settings.window_width
    frame = Window.partitionBy("video_id").orderBy("frame_index").rowsBetween(-w, w)
    around = (F.sum("score").over(frame) - F.col("score")) / (2 * w)
    full = F.count("*").over(frame) == 2 * w + 1
    flat = F.when(F.col("score") >= settings.min_content_val, F.lit(255.0)).otherwise(F.lit(0.0))
    ratio = F.when(F.abs(around) < 1e-5, flat).otherwise(F.least(F.col("score") / F.nullif(around, F.lit(0.0)), F.lit(255.0)))
    return frames.withColumn("ratio", F.when(full, ratio))


def candidates(frames: DataFrame, settings: ShotSettings = ShotSettings()) -> DataFrame:
    """Frames that are cuts but for the least distance."""
    return cut_ratio(frames, settings).where((F.col("ratio") >= settings.adaptive_threshold) & (F.col("score") >= settings.min_content_val))


#: Kept points are collected in lists of this size, so that a point is copied with its list and not with all before it.
_LIST = 256


def greedy_min_gap(points: DataFrame, at: str, gap: float) -> DataFrame:
    """From left to right, keep each point at least `gap` after the last kept one (a distance of exactly `gap` is enough).

    Only candidate cuts of one video are folded in a row, not its frames.
    """
    kind = dict(points.dtypes)[at]
    ordered = points.groupBy("video_id").agg(F.array_sort(F.collect_list(at)).alias("all"))
    state = F.struct(F.array().cast(f"array<array<{kind}>>").alias("full"), F.array().cast(f"array<{kind}>").alias("open"), F.lit(None).cast(kind).alias("last"))

    def step(s: Column, x: Column) -> Column:
        crowded = F.size(s["open"]) >= _LIST
        full = F.when(crowded, F.concat(s["full"], F.array(s["open"]))).otherwise(s["full"])
        longer = F.struct(full.alias("full"), F.when(crowded, F.array(x)).otherwise(F.concat(s["open"], F.array(x))).alias("open"), x.alias("last"))
        return F.when(s["last"].isNull() | (x - s["last"] >= gap), longer).otherwise(s)

    kept = F.aggregate("all", state, step, lambda s: F.concat(F.flatten(s["full"]), s["open"]))
    return ordered.select("video_id", F.explode(kept).alias(at))


def detect(frames: DataFrame, settings: ShotSettings = ShotSettings()) -> DataFrame:
    """scene_start (frame) per scene; a video without cuts has no scenes, otherwise frame 0 begins the first.

    The first cut has to be min_scene_len frames after frame 0, the distance being enough when it is equal.
    """
    cuts = candidates(frames, settings).where(F.col("frame_index") >= settings.min_scene_len).select("video_id", "frame_index")
    kept = greedy_min_gap(cuts, "frame_index", settings.min_scene_len)
    begin = kept.select("video_id").distinct().withColumn("frame_index", F.lit(0))
    return begin.unionByName(kept.withColumn("frame_index", F.col("frame_index").cast("int"))).withColumnRenamed("frame_index", "scene_start")


def flash_verdicts(cuts: DataFrame, stats: DataFrame, diffs: DataFrame, settings: ShotSettings = ShotSettings()) -> DataFrame:
    """Add peak and keep to (video_id, scene_start).

    ``stats`` has brightness and readable per frame, ``diffs`` the mean absolute difference per (before_index, after_index).  A cut goes when the
    brightest frame around it jumps over a frame shortly before, and the frames before and after it look alike.

    All frames that a cut may look at are met in one join and kept as a map of brightness by frame.
    """
    back, ahead = settings.look_back, settings.look_ahead
    last = stats.groupBy("video_id").agg(F.max("frame_index").alias("last"))
    readable = stats.where("readable").select("video_id", F.col("frame_index").alias("look"), "brightness")
    held = lambda i: F.least(F.col("last"), F.greatest(F.lit(0), i))
    at = F.col("scene_start")
    placed = cuts.join(last, "video_id").withColumns({"before_index": F.greatest(F.lit(0), at - back), "after_index": held(at + ahead)})
    # a reference lies `back` before a peak, so at most twice that before the cut; frames beyond the ends are those at the ends
    looks = placed.withColumn("look", F.explode(F.sequence(F.greatest(F.lit(0), F.least(F.col("last"), at) - 2 * back), held(at + ahead))))
    seen = looks.join(readable, ["video_id", "look"]).groupBy("video_id", "scene_start").agg(F.map_from_entries(F.collect_list(F.struct("look", "brightness"))).alias("seen"))
    known = placed.join(seen, ["video_id", "scene_start"], "left").join(diffs.select("video_id", "before_index", "after_index", "mean_abs_diff"), ["video_id", "before_index", "after_index"], "left")
    around = F.transform(F.sequence(F.lit(-back), F.lit(ahead)), lambda o: F.struct(F.col("seen")[held(at + o)].alias("brightness"), (-o).alias("first"), held(at + o).alias("look")))
    best = F.array_max(F.filter(around, lambda x: x["brightness"].isNotNull()))
    peaked = known.withColumn("best", best).withColumn("peak", F.col("best.look")).withColumn("reference", F.col("seen")[F.greatest(F.lit(0), F.col("peak") - back)])
    jumps = F.col("best.brightness") - F.col("reference") > settings.flash_brightness_jump
    alike = F.col("seen")[F.col("before_index")].isNotNull() & F.col("seen")[F.col("after_index")].isNotNull() & (F.col("mean_abs_diff") <= settings.flash_similarity_threshold)
    drop = (at != 0) & F.coalesce(jumps & alike, F.lit(False))
    return peaked.select("video_id", "scene_start", "peak", (~drop).alias("keep"))


def filter_flash_cuts(cuts: DataFrame, stats: DataFrame, diffs: DataFrame, settings: ShotSettings = ShotSettings()) -> DataFrame:
    return flash_verdicts(cuts, stats, diffs, settings).where("keep").select("video_id", "scene_start")


def shot_times(cuts: DataFrame, videos: DataFrame) -> DataFrame:
    """video_id, shot_index, timecode, shot_time of the scenes, from the videos' frame rates."""
    order = Window.partitionBy("video_id").orderBy("scene_start")
    smpte = frame_to_smpte(F.col("scene_start"), F.col("fps"))
    timed = cuts.join(videos.select("video_id", "fps"), "video_id").withColumn("timecode", smpte)
    return timed.select("video_id", (F.row_number().over(order) - 1).alias("shot_index"), "timecode", smpte_to_seconds(F.col("timecode"), scene_fps(F.col("fps"))).alias("shot_time"))


def shot_documents(shots: DataFrame, videos: DataFrame, settings: ShotSettings = ShotSettings()) -> DataFrame:
    """video_id, video_name, document: a JSON object of the settings and, under the video's name, its times."""
    ordered = shots.groupBy("video_id").agg(F.array_sort(F.collect_list(F.struct("shot_index", "timecode", "shot_time"))).alias("s"))
    names = [k for k in ShotSettings.__dataclass_fields__ if k != "weights"]
    fixed = F.to_json(F.struct(*[F.lit(getattr(settings, k)).alias(k) for k in names]))
    empty = F.array().cast("array<struct<shot_index:int,timecode:string,shot_time:double>>")
    s = F.coalesce("s", empty)
    own = F.to_json(F.create_map("video_name", F.struct(F.transform(s, lambda x: x["timecode"]).alias("timecode"), F.transform(s, lambda x: x["shot_time"]).alias("timecodes_seconds"))))
    # two objects become one: the first without its closing brace, the second without its opening one
    document = F.concat(F.expr("substring(fixed, 1, length(fixed) - 1)"), F.lit(","), F.expr("substring(own, 2, length(own))"))
    return videos.join(ordered, "video_id", "left").withColumns({"fixed": fixed, "own": own}).select("video_id", "video_name", document.alias("document"))


def new_videos(videos: DataFrame, written: DataFrame) -> DataFrame:
    """The videos that have no shot document yet."""
    return videos.join(written.select("video_id").distinct(), "video_id", "left_anti")


def detect_documents(frames: DataFrame, videos: DataFrame, diffs: DataFrame, written: DataFrame | None = None, settings: ShotSettings = ShotSettings()) -> DataFrame:
    """From scored frames to shot documents, for the videos that have none yet: cuts, flash filter, times, document.

    ``frames`` has score, brightness and readable per (video_id, frame_index).  A video without cuts gets a document without times.
    """
    left = videos if written is None else new_videos(videos, written)
    own = frames.join(left.select("video_id"), "video_id", "left_semi")
    cuts = filter_flash_cuts(detect(own, settings), own.select("video_id", "frame_index", "brightness", "readable"), diffs, settings)
    return shot_documents(shot_times(cuts, left), left, settings)


def frame_pairs(frames: DataFrame) -> DataFrame:
    """Each frame with the one before it: video_id, frame_index, content, previous (null for the first)."""
    order = Window.partitionBy("video_id").orderBy("frame_index")
    return frames.select("video_id", "frame_index", "content", F.lag("content").over(order).alias("previous"))


def frame_deltas(pairs: DataFrame, components: Callable[[bytes], list[np.ndarray] | None]) -> DataFrame:
    """video_id, frame_index and mean absolute changes of hue, saturation, luma and edges against the frame before; zero for the first.

    ``components`` decodes a frame to those four arrays, or to None if it cannot; such a frame counts as unchanged.
    """
    names = ("delta_hue", "delta_sat", "delta_lum", "delta_edges")

    def change(now: bytes | None, before: bytes | None) -> list[float]:
        a, b = (components(bytes(x)) if x is not None else None for x in (now, before))
        if a is None or b is None:
            return [0.0] * 4
        return [float(np.abs(x.astype(np.float64) - y).mean()) for x, y in zip(a, b, strict=True)]

    def over(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            rows = [change(a, b) for a, b in zip(pdf["content"], pdf["previous"], strict=True)]
            yield pdf[["video_id", "frame_index"]].assign(**{n: [r[i] for r in rows] for i, n in enumerate(names)})

    return pairs.mapInPandas(over, "video_id string, frame_index int, " + ", ".join(f"{n} double" for n in names))


def with_scores(deltas: DataFrame, settings: ShotSettings = ShotSettings()) -> DataFrame:
    names = ("delta_hue", "delta_sat", "delta_lum", "delta_edges")
    return deltas.select("video_id", "frame_index", content_score([F.col(n) for n in names], settings).alias("score"))

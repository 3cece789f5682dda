"""Plans over all videos: the feature table, incremental builds, and inference."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from .. import sinks
from ..operators import audio, islands, labels, scoring, segments, transcript, visual
from ..sources import files

_KEY = ["video_id", "segment_index"]


@dataclass(frozen=True)
class Inputs:
    """Decoded tables.  Missing samples or faces give null or zero features; missing truth turns labels off."""

    videos: DataFrame
    shots: DataFrame
    words: DataFrame
    audio_segments: DataFrame
    samples: DataFrame | None = None
    faces: DataFrame | None = None
    truth: DataFrame | None = None


def conform(rows: DataFrame, *more: str) -> DataFrame:
    """The 23 columns in order, absent ones null; columns named besides come first."""
    kinds = {**dict.fromkeys(C.FEATURE_COLUMNS, "double"), "video_name": "string", "segment_index": "int", "segment_start": "double", "segment_end": "double", C.LABEL: "int"}
    order = [*C.META_COLUMNS, *C.FEATURE_COLUMNS, C.LABEL]
    return rows.select(*more, *[(F.col(c) if c in rows.columns else F.lit(None)).cast(kinds[c]).alias(c) for c in order])


def feature_rows(inputs: Inputs, width: float | None = C.BUCKET_SECONDS) -> DataFrame:
    """video_id and all features of all segments of all videos.

    Every group of features is keyed by (video_id, segment_index), so the joins reuse one partitioning.  Range joins deal each video out by
    buckets of `width` seconds, so a very long video is no large group; None joins whole videos.
    """
    segs = segments.build_segments(inputs.shots, inputs.videos)
    rows = segments.with_temporal(segs, inputs.videos)
    groups = [(transcript.transcript_features(segs, inputs.words, inputs.audio_segments, width), C.TRANSCRIPT_COLUMNS)]
    if inputs.samples is not None:
        groups.append((audio.audio_features(segs, inputs.samples), C.AUDIO_COLUMNS))
    if inputs.faces is not None:
        groups.append((visual.visual_features(segs, inputs.faces), C.VISUAL_COLUMNS))
    groups.append((labels.label_segments(segs, inputs.truth, width), (C.LABEL,)))
    for group, columns in groups:
        rows = rows.join(group.select(*_KEY, *columns), _KEY)
    rows = rows.join(inputs.videos.select("video_id", "video_name"), "video_id")
    return rows if inputs.faces is not None else rows.withColumn("face_area_ratio", F.lit(0.0))


def features(inputs: Inputs, video_name: str | None = None, width: float | None = C.BUCKET_SECONDS) -> DataFrame:
    """The feature table of all videos, or of one."""
    rows = feature_rows(inputs, width)
    return conform(rows if video_name is None else rows.where(F.col("video_name") == video_name))


def features_incremental(inputs: Inputs, skip: DataFrame, width: float | None = C.BUCKET_SECONDS) -> DataFrame:
    """The feature table of the videos that are not in the skip-list."""
    return features(replace(inputs, videos=files.not_skipped(inputs.videos, skip)), width=width)


def per_shot_file(inputs: Inputs, listing: DataFrame) -> Inputs:
    """The inputs keyed by shot file rather than video: a video with two shot files is there, and gives its rows, twice.

    ``listing`` has shot_file and video_id; the shots are keyed by shot file already (as video_id).
    """
    def again(t: DataFrame | None) -> DataFrame | None:
        return t if t is None else t.join(listing.select("video_id", "shot_file"), "video_id").drop("video_id").withColumnRenamed("shot_file", "video_id")

    others = {f: again(getattr(inputs, f)) for f in ("videos", "words", "audio_segments", "samples", "faces", "truth")}
    return Inputs(shots=inputs.shots, **others)


def soundbites(scored: DataFrame) -> DataFrame:
    return islands.merge_adjacent(scored, ["video_id"], ["segment_index"], "segment_start", "segment_end", "predicted", "confidence")


def infer(inputs: Inputs, params: DataFrame, model, threshold: float = C.DECISION_THRESHOLD, columns: list[str] | None = None, width: float | None = C.BUCKET_SECONDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Scored segments, merged ranges and prediction documents of all videos, labels off.  Videos are told apart by video_id, not by name."""
    rows = conform(feature_rows(replace(inputs, truth=None), width), "video_id")
    scored = scoring.score(rows, params, model, columns or list(C.FEATURE_COLUMNS), threshold)
    ranges = soundbites(scored)
    return scored, ranges, sinks.prediction_documents(scored, ranges)

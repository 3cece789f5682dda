"""File listings, what a run may skip, and how names resolve to paths.  Nothing here lists a folder on the driver."""

from __future__ import annotations

import io
import wave
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions.ids import base_name, checked_s3, media_id, stem
from ..operators.audio import BLOCK, resample

VIDEO, TRANSCRIPT, SHOTS = ".MP4", "_transcript_raw.json", "_weighted_adaptive_prediction.json"


def listing(spark: SparkSession, folder: str, glob: str = "*.mp4") -> DataFrame:
    """path, name, size of the files in a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    return files.select("path", base_name(F.col("path")).alias("name"), F.col("length").alias("size"))


def to_fetch(wanted: DataFrame, local: DataFrame, remote: DataFrame) -> DataFrame:
    """uri, name of files to fetch: missing ones, and those whose size is known to differ."""
    named = wanted.withColumn("s3", checked_s3(F.col("uri"))).select("uri", base_name(F.col("s3.key")).alias("name"))
    here = local.groupBy("name").agg(F.max("size").alias("local_size"))
    there = remote.groupBy("name").agg(F.max("size").alias("remote_size"))
    both = named.join(here, "name", "left").join(there, "name", "left")
    return both.where(needs_fetch(F.col("local_size"), F.col("remote_size"))).select("uri", "name")


def needs_fetch(local: Column, remote: Column) -> Column:
    return local.isNull() | (remote.isNotNull() & (local != remote))


def to_transcribe(videos: DataFrame, transcripts: DataFrame) -> DataFrame:
    """The videos without a transcript file that holds anything."""
    done = transcripts.where("size > 0").select(F.regexp_replace("name", "_transcript_raw\\.json$", "").alias("stem")).distinct()
    return videos.withColumn("stem", stem(F.col("path"))).join(done, "stem", "left_anti").drop("stem")


def without_artifact(videos: DataFrame, artifacts: DataFrame, key: str = "video_id") -> DataFrame:
    return videos.join(artifacts.select(key).distinct(), key, "left_anti")


def find_by_id(wanted: DataFrame, files: DataFrame, suffix: str = "") -> DataFrame:
    """media_id, path: by equality of the ids inside the names, ties by the least path.

    Names that merely contain an id as part of a longer one do not match, and RW names match their LOV form.
    """
    found = files.where(F.col("name").endswith(suffix)).select(media_id(F.col("name")).alias("media_id"), "path").where("media_id is not null")
    best = found.groupBy("media_id").agg(F.min("path").alias("path"))
    return wanted.where("media_id is not null").select("media_id").distinct().join(best, "media_id")


def resolve(videos: DataFrame, files: DataFrame, folder: str, suffix: str, column: str, any_suffix: bool = False) -> DataFrame:
    """Fill column: an explicit path, else the file with the video's id, else the folder, the plain name and the suffix."""
    named = videos.withColumn("media_id", media_id(F.col("video_name")))
    found = find_by_id(named, files, "" if any_suffix else suffix).withColumnRenamed("path", "_found")
    plain = F.concat(F.lit(folder.rstrip("/") + "/"), F.regexp_replace("video_name", r"(?:\.MP4|\.mp4)$", ""), F.lit(suffix))
    explicit = F.col(column) if column in videos.columns else F.lit(None).cast("string")
    return named.join(found, "media_id", "left").withColumn(column, F.coalesce(explicit, F.col("_found"), plain)).drop("_found", "media_id")


def available_videos(shot_files: DataFrame, video_files: DataFrame) -> DataFrame:
    """shot_file, video_name in order of shot files; a video with two shot files is there twice."""
    shots = shot_files.where(F.col("name").endswith(SHOTS)).select(F.col("name").alias("shot_file"), media_id(F.col("name")).alias("media_id"))
    videos = video_files.select(media_id(F.col("name")).alias("media_id"), "path").groupBy("media_id").agg(F.min("path").alias("path"))
    return shots.join(videos, "media_id").select("shot_file", base_name(F.col("path")).alias("video_name")).orderBy("shot_file")


def not_skipped(videos: DataFrame, skip: DataFrame) -> DataFrame:
    return videos.join(skip.select("video_name").distinct(), "video_name", "left_anti")


def decode(files: DataFrame, decoder: Callable[[bytes], dict], schema: str) -> DataFrame:
    """Run a media decoder (duration, samples or frames) over binary files: one row per file, the decoder's fields as columns."""

    def over(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            yield pd.DataFrame([{"path": p, **decoder(bytes(c))} for p, c in zip(pdf["path"], pdf["content"], strict=True)])

    return files.select("path", "content").mapInPandas(over, f"path string, {schema}")


def decode_wav(content: bytes, rate: int = C.AUDIO_RATE) -> dict:
    """Duration and mono samples, at `rate`, of a PCM WAV file of 8, 16, 24 or 32 bits."""
    with wave.open(io.BytesIO(content)) as w:
        raw, width, channels, own, n = w.readframes(w.getnframes()), w.getsampwidth(), w.getnchannels(), w.getframerate(), w.getnframes()
    if width == 1:  # the only unsigned width
        y = (np.frombuffer(raw, np.uint8).astype(np.float64) - 128) / 128
    elif width == 3:
        high = np.zeros((len(raw) // 3, 4), np.uint8)
        high[:, 1:] = np.frombuffer(raw, np.uint8).reshape(-1, 3)
        y = high.view("<i4")[:, 0] / 2**31
    elif width in (2, 4):
        y = np.frombuffer(raw, f"<i{width}") / 2 ** (8 * width - 1)
    else:
        raise ValueError(f"WAV samples of {width} bytes")
    return {"duration": n / own, "y": resample(y.reshape(-1, channels).mean(axis=1), own, rate).astype(np.float32)}


def decode_audio(files: DataFrame, decoder: Callable[[bytes], dict] = decode_wav, size: int = BLOCK) -> DataFrame:
    """path, duration, block, y of audio files, cut into blocks where they are decoded; a silent file of no samples has no row."""

    def over(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                told = decoder(bytes(content))
                y = np.asarray(told["y"], np.float32)
                for at in range(0, len(y), size):
                    yield pd.DataFrame([{"path": path, "duration": told["duration"], "block": at // size, "y": y[at : at + size]}])

    return files.select("path", "content").mapInPandas(over, "path string, duration double, block int, y array<float>")

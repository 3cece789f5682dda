"""Duration, audio and frames of video files by the external tools ffprobe and ffmpeg, run where the files' rows are.

Paths have to be readable on every executor.  ``run`` starts a command and returns its exit code and output; it can be replaced, so the
plans do not depend on the tools being installed.  Nothing is written to local files: the tools write to standard output.
"""

from __future__ import annotations

import subprocess
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from .. import config as C
from ..operators.audio import BLOCK
from .files import decode_wav

Run = Callable[[list[str]], tuple[int, bytes]]


def run(command: list[str]) -> tuple[int, bytes]:
    done = subprocess.run(command, capture_output=True, check=False)
    return done.returncode, done.stdout


def duration_command(path: str) -> list[str]:
    return ["ffprobe", "-v", "quiet", "-show_entries", "format=duration", "-of", "csv=p=0", path]


def audio_command(path: str, rate: int = C.AUDIO_RATE) -> list[str]:
    """Mono 16-bit WAV of the whole file."""
    return ["ffmpeg", "-v", "quiet", "-i", path, "-vn", "-ac", "1", "-ar", str(rate), "-c:a", "pcm_s16le", "-f", "wav", "-"]


def frame_command(path: str, seconds: float) -> list[str]:
    """One JPEG frame at a time."""
    return ["ffmpeg", "-v", "quiet", "-ss", str(seconds), "-i", path, "-frames:v", "1", "-q:v", "2", "-f", "image2pipe", "-c:v", "mjpeg", "-"]


def _output(start: Run, command: list[str]) -> bytes:
    code, out = start(command)
    if code:
        raise RuntimeError(f"{command[0]} ended with {code} for {command[-2] if command[-1] == '-' else command[-1]}")
    return out


def durations(videos: DataFrame, start: Run = run) -> DataFrame:
    """video_id, duration in seconds; a file that cannot be read fails the query."""

    def over(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            yield pdf[["video_id"]].assign(duration=[float(_output(start, duration_command(p)).decode().strip()) for p in pdf["path"]])

    return videos.select("video_id", "path").mapInPandas(over, "video_id string, duration double")


def streamed_wav(raw: bytes, rate: int) -> np.ndarray:
    """Samples of a WAV stream; a header written before the length was known holds a length that is too large."""
    at = raw.find(b"data")
    if at < 0:
        return np.zeros(0, np.float32)
    body = raw[at + 8 :]
    told = int.from_bytes(raw[at + 4 : at + 8], "little")
    if told <= len(body):
        return decode_wav(raw, rate)["y"]
    return (np.frombuffer(body[: len(body) // 2 * 2], "<i2") / 32768).astype(np.float32)


def audio(videos: DataFrame, start: Run = run, rate: int = C.AUDIO_RATE, size: int = BLOCK) -> DataFrame:
    """video_id, block, y: mono samples at `rate`, each video converted once and cut into blocks."""

    def over(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for video, path in zip(pdf["video_id"], pdf["path"], strict=True):
                y = streamed_wav(_output(start, audio_command(path, rate)), rate)
                for at in range(0, len(y), size):
                    yield pd.DataFrame([{"video_id": video, "block": at // size, "y": y[at : at + size]}])

    return videos.select("video_id", "path").mapInPandas(over, "video_id string, block int, y array<float>")


def frames_at(samples: DataFrame, videos: DataFrame, start: Run = run) -> DataFrame:
    """The samples (video_id, segment_index, sample_no, sample_time) with content, the frame at that time; null where there is none."""

    def over(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            got = [start(frame_command(p, t)) for p, t in zip(pdf["path"], pdf["sample_time"], strict=True)]
            yield pdf.drop(columns="path").assign(content=[out if not code and out else None for code, out in got])

    known = samples.select("video_id", "segment_index", "sample_no", "sample_time").join(videos.select("video_id", "path"), "video_id")
    return known.mapInPandas(over, "video_id string, segment_index int, sample_no int, sample_time double, content binary")

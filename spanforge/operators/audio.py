"""Audio features of segments: energy, spectral centroid and signal-to-noise estimate.

Signals are decoded samples at 16 kHz.  Frames of 2048 samples every 512 are centred, with zeros beyond the ends, so n samples
have 1 + n // 512 frames.  The spectrum needs Python; everything after the frame values is a column expression.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C

FRAME, HOP = 2048, 512
#: Samples of a block of a long signal: ten seconds.
BLOCK = 160_000


def frame_values(y: np.ndarray, rate: int = C.AUDIO_RATE) -> tuple[np.ndarray, np.ndarray]:
    """Root mean square and spectral centroid (0 for silence) of each frame."""
    padded = np.pad(np.asarray(y, np.float64), FRAME // 2)
    frames = np.lib.stride_tricks.sliding_window_view(padded, FRAME)[::HOP]
    rms = np.sqrt((frames**2).mean(axis=1))
    window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(FRAME) / FRAME)
    size = np.abs(np.fft.rfft(frames * window, axis=1))
    total = size.sum(axis=1)
    weighted = size @ np.fft.rfftfreq(FRAME, 1 / rate)
    return rms, np.divide(weighted, total, out=np.zeros_like(total), where=total > 1e-12)


def resample(y: np.ndarray, own: int, rate: int = C.AUDIO_RATE, zeros: int = 16) -> np.ndarray:
    """A signal of `own` samples a second at `rate`, by a windowed sinc at the lower of the two Nyquist rates."""
    if own == rate or not len(y):
        return np.asarray(y, np.float64)
    cut = min(1.0, rate / own)
    half = math.ceil(zeros / cut)
    padded = np.pad(np.asarray(y, np.float64), half + 1)
    taps = np.arange(1 - half, half + 1)
    out = np.empty(-(-len(y) * rate // own))
    for i in range(0, len(out), 4096):
        at = np.arange(i, min(len(out), i + 4096)) * (own / rate)
        first = np.floor(at).astype(np.int64)
        x = (at - first)[:, None] - taps
        weight = np.sinc(cut * x) * np.cos(np.pi * x / (2 * half)) ** 2
        out[i : i + len(at)] = (padded[first[:, None] + taps + half + 1] * weight).sum(1) / weight.sum(1)
    return out


def frames_of(samples: DataFrame, column: str = "y", rate: int = C.AUDIO_RATE) -> DataFrame:
    """Add rms and centroid, arrays of frame values; null for missing signals and those under 0.05 s."""
    kinds = ", ".join(f"`{k}` {t}" for k, t in samples.dtypes if k != column)
    least = int(rate * C.MIN_SAMPLE_SECONDS)

    def over(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            values = [frame_values(y, rate) if y is not None and len(y) >= least else (None, None) for y in pdf[column]]
            yield pdf.drop(columns=column).assign(rms=[v[0] for v in values], centroid=[v[1] for v in values])

    return samples.mapInPandas(over, f"{kinds}, rms array<double>, centroid array<double>")


def mean(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x) / F.nullif(F.size(values), F.lit(0))


def std(values: Column) -> Column:
    """Population standard deviation."""
    return F.sqrt(mean(F.transform(values, lambda x: F.pow(x - mean(values), F.lit(2.0)))))


def noise_floor(rms: Column) -> Column:
    """Mean of the lowest tenth of the frames, of one at least."""
    return mean(F.slice(F.array_sort(rms), 1, F.greatest(F.lit(1), F.floor(F.size(rms) / 10).cast("int"))))


def snr(rms: Column) -> Column:
    """20 log10 of mean over floor; 60 without noise, null under five frames."""
    floor = noise_floor(rms)
    level = F.when(floor > 0, 20 * F.log10(mean(rms) / floor)).otherwise(F.lit(C.SILENT_SNR))
    return F.when(F.size(rms) >= C.MIN_RMS_FRAMES, level)


def audio_features(segments: DataFrame, samples: DataFrame, rate: int = C.AUDIO_RATE) -> DataFrame:
    """The five audio columns; ``samples`` holds y per (video_id, segment_index).  Segments under 0.1 s have nulls."""
    key = ["video_id", "segment_index"]
    # moments are aggregated over exploded frames, so a long segment's deviation is not quadratic in its frames
    frames = frames_of(samples.select(*key, "y"), "y", rate)
    each = frames.select(*key, F.posexplode(F.arrays_zip("rms", "centroid")).alias("k", "f"))
    moments = each.groupBy(*key).agg(
        F.avg("f.rms").alias("rms_mean"), F.stddev_pop("f.rms").alias("rms_std"),
        F.avg("f.centroid").alias("spectral_centroid_mean"), F.stddev_pop("f.centroid").alias("spectral_centroid_std"),
    )
    found = frames.select(*key, snr(F.col("rms")).alias("snr_estimate")).join(moments, key, "left")
    long_enough = F.col("segment_end") - F.col("segment_start") >= C.MIN_AUDIO_SECONDS
    return segments.join(found, key, "left").select(*segments.columns, *[F.when(long_enough, F.col(c)).alias(c) for c in C.AUDIO_COLUMNS])


def blocks_of(signals: DataFrame, size: int = BLOCK) -> DataFrame:
    """video_id, block, y: whole signals (video_id, y) as blocks of `size` samples."""
    many = F.ceil(F.size("y") / size).cast("int")
    cut = F.transform(F.sequence(F.lit(0), many - 1), lambda i: F.slice("y", i * size + 1, size))
    return signals.where(F.size("y") > 0).select("video_id", F.posexplode(cut).alias("block", "y"))


def segment_samples(segments: DataFrame, blocks: DataFrame, rate: int = C.AUDIO_RATE, size: int = BLOCK) -> DataFrame:
    """video_id, segment_index, y of every segment that meets a signal, given in blocks.

    A segment is joined with the blocks it meets and takes its part of each, so what moves is what is used, however long the video.
    """
    at = F.floor(F.col("segment_start") * rate).cast("bigint")
    end = at + F.floor((F.col("segment_end") - F.col("segment_start")) * rate).cast("bigint")
    placed = segments.select("video_id", "segment_index", at.alias("at"), end.alias("end")).where("end > at AND at >= 0")
    met = F.sequence(F.floor(F.col("at") / size).cast("int"), F.floor((F.col("end") - 1) / size).cast("int"))
    each = placed.withColumn("block", F.explode(met)).join(blocks, ["video_id", "block"])
    begin = F.col("block").cast("bigint") * size
    first, past = F.greatest(F.col("at") - begin, F.lit(0)), F.least(F.col("end") - begin, F.lit(size))
    part = F.slice("y", (first + 1).cast("int"), (past - first).cast("int"))
    parts = each.select("video_id", "segment_index", F.struct("block", part.alias("part")).alias("p"))
    whole = F.flatten(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["part"]))
    return parts.groupBy("video_id", "segment_index").agg(whole.alias("y"))

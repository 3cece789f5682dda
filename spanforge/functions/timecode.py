"""Conversions between HH:MM:SS:FF timecodes, frame numbers and seconds, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C


def _seconds(parts: Column, fps: Column | float) -> Column:
    field = lambda k: F.element_at(parts, k).cast("double")
    return field(1) * 3600 + field(2) * 60 + field(3) + field(4) / fps


def timecode_to_seconds(timecode: Column, fps: Column | float = C.FRAMES_PER_SECOND) -> Column:
    """Seconds, unrounded.  Parts beyond four are ignored; with fewer the query fails."""
    return _seconds(F.split(F.trim(timecode), ":"), F.lit(fps) if isinstance(fps, (int, float)) else fps)


def smpte_to_seconds(smpte: Column, fps: Column | float) -> Column:
    """Seconds to six places; any other number of parts than four fails the query."""
    parts = F.split(smpte, ":")
    message = F.concat(F.lit("not HH:MM:SS:FF: "), smpte)
    checked = F.when(F.size(parts) == 4, parts).otherwise(F.raise_error(message).cast("array<string>"))
    return F.round(_seconds(checked, F.lit(fps) if isinstance(fps, (int, float)) else fps), 6)


def frame_to_smpte(frame: Column, framerate: Column) -> Column:
    """Non-drop-frame timecode of a frame number; the rate is rounded half to even, hours are unbounded."""
    fps = F.bround(framerate, 0).cast("bigint")
    frame = frame.cast("bigint")
    seconds = F.floor(frame / fps)
    return F.format_string("%02d:%02d:%02d:%02d", F.floor(seconds / 3600), F.floor(seconds / 60) % 60, seconds % 60, frame % fps)


def scene_fps(first_framerate: Column) -> Column:
    """The rate that turns a video's timecodes into seconds: its first scene's, rounded, or 25 without scenes."""
    return F.coalesce(F.bround(first_framerate, 0), F.lit(float(C.FRAMES_PER_SECOND)))

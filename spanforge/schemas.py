"""Schemas of the documents that are read and of the tables that operators exchange."""

from __future__ import annotations

from . import config as C

TRANSCRIPT_JSON = (
    "results struct<items: array<struct<type: string, start_time: string, end_time: string, alternatives: array<struct<confidence: string, content: string>>>>,"
    " audio_segments: array<struct<start_time: string, end_time: string>>>"
)
SHOT_ENTRY = "timecode array<string>, timecodes_seconds array<double>"
TRUTH_ENTRY = "soundbite_start string, soundbite_end string"
SEGMENTS = "video_id string, segment_index int, segment_start double, segment_end double"
FEATURES = ", ".join(["video_name string", "segment_index int", "segment_start double", "segment_end double", *(f"{c} double" for c in C.FEATURE_COLUMNS), f"{C.LABEL} int"])

"""They must be exactly these for results to agree."""

from __future__ import annotations

from dataclasses import dataclass, field

FRAMES_PER_SECOND = 25
AUDIO_RATE = 16_000
#: Overlap rules of ground-truth labels: over, over, over, and at least.
MIN_IOU, MIN_SEGMENT_SHARE, MIN_TRUTH_SHARE, MIN_SHARE_FOR_TRUTH = 0.3, 0.5, 0.5, 0.2
LOW_CONFIDENCE = 0.5
FILLERS = ("uh", "um", "ah", "er", "hmm")
MIN_FACE_CONFIDENCE = 0.5
SAMPLE_FRACTIONS = (1 / 3, 2 / 3)
DECISION_THRESHOLD, DEFAULT_THRESHOLD = 0.19999999999999996, 0.5
#: Not a fixed value: width of the time buckets of range joins, a few segments of a usual video.
BUCKET_SECONDS = 60.0
MIN_AUDIO_SECONDS, MIN_SAMPLE_SECONDS, MIN_RMS_FRAMES, SILENT_SNR = 0.1, 0.05, 5, 60.0

META_COLUMNS = ("video_name", "segment_index", "segment_start", "segment_end")
AUDIO_COLUMNS = ("rms_mean", "rms_std", "spectral_centroid_mean", "spectral_centroid_std", "snr_estimate")
TRANSCRIPT_COLUMNS = (
    "word_count", "speech_rate", "confidence_mean", "confidence_std", "confidence_min", "low_confidence_ratio",
    "filler_word_ratio", "speech_coverage", "num_audio_segments_overlap", "max_silence_gap",
)
TEMPORAL_COLUMNS = ("segment_duration", "relative_position")
VISUAL_COLUMNS = ("face_area_ratio",)
FEATURE_COLUMNS = AUDIO_COLUMNS + TRANSCRIPT_COLUMNS + TEMPORAL_COLUMNS + VISUAL_COLUMNS
#: The short list of features that separate best.
REDUCED_FEATURE_COLUMNS = ("word_count", "rms_std", "rms_mean", "confidence_mean", "face_area_ratio", "segment_duration", "speech_coverage", "speech_rate")
LABEL = "label"


@dataclass(frozen=True)
class ShotSettings:
    """Settings of shot detection; ``weights`` are those of hue, saturation, luma and edges."""

    adaptive_threshold: float = 2.5
    min_scene_len: int = 30
    window_width: int = 4
    min_content_val: float = 20
    flash_similarity_threshold: float = 20
    look_back: int = 2
    look_ahead: int = 2
    flash_brightness_jump: float = 20
    weights: tuple[float, ...] = field(default=(1.0, 1.0, 0.0, 1.0))

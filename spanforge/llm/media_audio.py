"""Audio features of media columns: polyphase resampling, log-mel filterbanks and energy segments as fixed-shape tensors.

The payload is 8-bit PCM in a WAV container.  Samples read back from it are resampled by UP / DOWN with a polyphase windowed-sinc
filter; frames of FRAME samples overlap by half; their power spectra go through triangular mel filters and a logarithm.  Frames
whose energy rises above the high mark open a span of time, and it lasts until the energy falls below the low mark (hysteresis).  Log-mels are stored as
Arrow fixed-shape tensors of BLOCK frames by MELS bands, the last block filled with the floor; beside each tensor stand its real frames and
its span of time.  What describes a signal is computed from the tensors read back.  Long signals are worked through in pieces.

Defined results: null text is the empty text; its payload is 64 zero bytes; equal texts have equal values; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import io
import struct
import wave
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import arrow_map, narrow, texts_of

RATE, UP, DOWN, TAPS = 16_000, 5, 8, 16
FRAME, HOP, MELS, BLOCK = 256, 128, 24, 32
FLOOR = 1e-6
#: Nats above the median energy at which a span opens, and below which it closes.
HIGH, LOW = 0.25, 0.0
PIECE = 4096


def payload_of(text: str) -> tuple[int, bytes]:
    raw = text.encode("utf-8", "surrogatepass")
    return len(raw), raw.ljust(max(64, -(-len(raw) // 64) * 64), b"\0")


def to_wav(samples: bytes, rate: int = RATE) -> bytes:
    """Unsigned 8-bit mono PCM in a RIFF container; samples are kept byte by byte."""
    head = struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(samples) + len(samples) % 2, b"WAVE", b"fmt ", 16, 1, 1, rate, rate, 1, 8, b"data", len(samples))
    return head + samples + b"\0" * (len(samples) % 2)


def from_wav(media: bytes) -> tuple[bytes, int]:
    with wave.open(io.BytesIO(media)) as w:
        return w.readframes(w.getnframes()), w.getframerate()


def filters(up: int = UP, down: int = DOWN, taps: int = TAPS) -> np.ndarray:
    """One row of taps per phase of a Hann-windowed sinc at the lower of the two Nyquist rates, each of unit sum."""
    n = np.arange(up * taps) - (up * taps - 1) / 2
    h = np.sinc(n / max(up, down)) * np.hanning(up * taps + 2)[1:-1]
    phases = h.reshape(taps, up).T
    return (phases / phases.sum(1, keepdims=True)).astype(np.float32)


_FILTERS = filters()


def resample(x: np.ndarray, up: int = UP, down: int = DOWN, bank: np.ndarray = _FILTERS) -> np.ndarray:
    """y[n] = sum over k of bank[n * down % up][k] * x[n * down // up - k + taps // 2], zero beyond the ends."""
    taps = bank.shape[1]
    n_out = -(-len(x) * up // down)
    pad = np.zeros(len(x) + 2 * taps + down, np.float32)
    pad[taps : taps + len(x)] = x
    y = np.zeros(n_out, np.float32)
    for r in range(min(up, n_out)):
        # outputs r, r + up, ... share a phase, and their inputs are `down` apart
        first = r * down // up + taps // 2 + 1
        rows = np.lib.stride_tricks.sliding_window_view(pad, taps)[first :: down][: -(-(n_out - r) // up)]
        taps_back = np.ascontiguousarray(bank[r * down % up][::-1])
        for i in range(0, len(rows), 1 << 16):
            part = rows[i : i + (1 << 16)]
            y[r + i * up : r + (i + len(part)) * up : up] = part @ taps_back
    return y


def mel_bank(rate: float, frame: int = FRAME, mels: int = MELS) -> np.ndarray:
    top = 2595 * np.log10(1 + rate / 2 / 700)
    edges = 700 * (10 ** (np.linspace(0, top, mels + 2) / 2595) - 1)
    f = np.fft.rfftfreq(frame, 1 / rate)
    rise, fall = (f - edges[:-2, None]) / (edges[1:-1] - edges[:-2])[:, None], (edges[2:, None] - f) / (edges[2:] - edges[1:-1])[:, None]
    return np.maximum(0, np.minimum(rise, fall)).T.astype(np.float32)


_BANK = mel_bank(RATE * UP / DOWN)
_WINDOW = np.hanning(FRAME + 1)[:-1].astype(np.float32)


def log_mels(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-mel frames and each frame's log energy; a signal shorter than a frame is one frame."""
    n = max(1, 1 + -(-(len(y) - FRAME) // HOP))
    padded = np.zeros((n - 1) * HOP + FRAME, np.float32)
    padded[: len(y)] = y
    frames = np.lib.stride_tricks.sliding_window_view(padded, FRAME)[::HOP]
    mels, energy = np.empty((n, MELS), np.float32), np.empty(n, np.float32)
    for i in range(0, n, PIECE):
        part = frames[i : i + PIECE] * _WINDOW
        spectrum = np.fft.rfft(part, axis=1)
        power = (spectrum.real**2 + spectrum.imag**2).astype(np.float32)
        mels[i : i + PIECE] = np.log(power @ _BANK + FLOOR)
        energy[i : i + PIECE] = np.log((part**2).sum(1) + FLOOR)
    return mels, energy


def active_spans(energy: np.ndarray, high: float, low: float) -> np.ndarray:
    """First and past-last frames of spans that open at `high` or more and close below `low`."""
    event = np.where(energy >= high, 1, np.where(energy < low, -1, 0))
    last = np.maximum.accumulate(np.where(event != 0, np.arange(1, len(event) + 1), 0))
    on = np.concatenate([[False], np.concatenate([[0], event])[last] == 1, [False]])
    edges = np.flatnonzero(on[1:] != on[:-1])
    return edges.reshape(-1, 2)


SECONDS = HOP * DOWN / UP / RATE


def features(samples: bytes) -> tuple[np.ndarray, list[tuple[float, float]]]:
    """Log-mel frames (frames, MELS) and active spans in seconds."""
    x = (np.frombuffer(samples, np.uint8).astype(np.float32) - 128) / 128
    mels, energy = log_mels(resample(x))
    middle = float(np.median(energy))
    return mels, [(a * SECONDS, b * SECONDS) for a, b in active_spans(energy, middle + HIGH, middle + LOW).tolist()]


def to_tensors(mels: np.ndarray) -> bytes:
    """An Arrow stream of fixed-shape tensors (BLOCK, MELS), each with its real frames and its time from start to end."""
    n = -(-len(mels) // BLOCK)
    blocks = np.full((n * BLOCK, MELS), np.log(np.float32(FLOOR)), np.float32)
    blocks[: len(mels)] = mels
    first = np.arange(n) * BLOCK
    last = np.minimum(first + BLOCK, len(mels))
    batch = pa.record_batch({"log_mel": pa.FixedShapeTensorArray.from_numpy_ndarray(blocks.reshape(n, BLOCK, MELS)), "frames": (last - first).astype(np.int32), "start": first * SECONDS, "end": last * SECONDS})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def from_tensors(stored: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The tensors (blocks, BLOCK, MELS) and the real frames of each."""
    table = pa.ipc.open_stream(stored).read_all().combine_chunks()
    return table.column("log_mel").combine_chunks().to_numpy_ndarray(), table.column("frames").to_numpy()


def describe(stored: bytes, spans: list[tuple[float, float]]) -> str:
    """Blocks, spans, their seconds, and the mean of each band over the real frames."""
    blocks, frames = from_tensors(stored)
    means = blocks.reshape(-1, MELS)[: frames.sum()].mean(0, dtype=np.float64)
    return f"blocks={len(blocks)};frames={frames.sum()};spans={len(spans)};active={sum(b - a for a, b in spans):.3f};mel=" + ",".join(f"{m:.1f}" for m in means)


def audio_features(docs: DataFrame) -> DataFrame:
    """One row per document: payload figures, feature, spans of time, the stored form (media) and its tensors."""
    kinds = {"doc_id": pa.int64(), "n_bytes": pa.int64(), "payload_bytes": pa.int64(), "payload_sha256": pa.string(), "tail_crc32": pa.int64(), "media_bytes": pa.int64(), "media_sha256": pa.string(), "feature": pa.string(), "spans": pa.list_(pa.struct([("start", pa.float64()), ("end", pa.float64())])), "media": pa.binary(), "tensors": pa.binary()}
    schema = "doc_id bigint, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string, spans array<struct<start:double,end:double>>, media binary, tensors binary"

    def one(doc_id: int | None, text: str) -> tuple:
        n, payload = payload_of(text)
        stored = to_wav(payload)
        samples, _ = from_wav(stored)
        mels, spans = features(samples)
        tensors = to_tensors(mels)
        figures = (doc_id, n, len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-64:]), len(stored), hashlib.sha256(stored).hexdigest())
        return (*figures, describe(tensors, spans), [{"start": a, "end": b} for a, b in spans], stored, tensors)

    def over(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [one(d, t) for d, t in zip(batch.column("doc_id").to_pylist(), texts_of(batch), strict=True)]
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds.values(), strict=True)], list(kinds))

    return arrow_map(narrow(docs, "doc_id", "text"), over, schema)

"""Media columns for audio: a lossless 8-bit PCM container and log-mel features with time spans.

Samples are resampled by a polyphase filter, cut into overlapped Hann frames, turned into log-mel filterbanks and
stored as tensors of one fixed shape (FRAMES x MELS, the last one padded with FLOOR), each with the time span that it
covers: an Arrow table with a column of the fixed-shape tensor type, as one value of a binary column. A segment starts where the energy of a frame reaches the upper threshold and ends where it falls below the
lower one. Every document is computed by itself, in blocks of whole tensors, so equal media have equal features.
"""

from __future__ import annotations

import hashlib
import io
import wave
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmill.llm.tables import small_batches
from docmill.llm.textbatch import slices

RATE, UP, DOWN, HALF = 8000, 3, 4, 8
WINDOW, HOP, MELS, FRAMES = 256, 128, 16, 32
FLOOR, EMPHASIS = -100.0, 0.97
HIGH, LOW = 65, 35
#: Bytes of a payload are a positive multiple of this.
UNIT = 192
#: Frames that are transformed at once.
BLOCK = 256 * FRAMES
SCHEMA = (
    "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, "
    "media binary, tensors binary, segments array<struct<start_ms: double, end_ms: double>>"
)
COLUMNS = [x.split()[0] for x in SCHEMA.split(", ")[:11]]
TENSOR = pa.fixed_shape_tensor(pa.float32(), (FRAMES, MELS))
STORED = pa.schema([("tensor", TENSOR), ("start_ms", pa.float64()), ("end_ms", pa.float64())])


def payload(text: str | None) -> bytes:
    """UTF-8, filled up with spaces to a positive multiple of UNIT."""
    data = (text or "").encode()
    return data.ljust(max(1, -(-len(data) // UNIT)) * UNIT, b" ")


def stored_form(samples: bytes, rate: int = RATE) -> bytes:
    """A WAV file of unsigned 8-bit mono samples."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(rate)
        w.writeframes(samples)
    return out.getvalue()


def read_back(media: bytes) -> tuple[int, bytes]:
    with wave.open(io.BytesIO(media)) as w:
        return w.getframerate(), w.readframes(w.getnframes())


@cache
def _lowpass(up: int, down: int, half: int) -> np.ndarray:
    """Taps of the anti-alias filter by phase; row p holds those that meet the inputs at and before an output."""
    wide = max(up, down)
    n = np.arange(-half * wide, half * wide + 1)
    taps = np.sinc(n / wide) * np.hanning(len(n) + 2)[1:-1] * up / wide
    taps = np.pad(taps, (0, -len(taps) % up))
    return taps.reshape(-1, up).T[:, ::-1].copy()


def resample(x: np.ndarray, up: int = UP, down: int = DOWN, half: int = HALF) -> np.ndarray:
    """Polyphase: output n needs only the taps of phase n*down mod up, and no sample is computed that is not kept."""
    phases = _lowpass(up, down, half)
    width, lag = phases.shape[1], half * max(up, down)
    n = -(-len(x) * up // down)
    padded = np.pad(x, (width, width + down + lag))
    windows = np.lib.stride_tricks.sliding_window_view(padded, width)
    out = np.empty(n)
    for first in range(min(up, n)):
        at = first * down + lag
        own = windows[at // up + 1 :: down][: len(range(first, n, up))]
        out[first::up] = own @ phases[at % up]
    return out


@cache
def _mel(rate: float, window: int, mels: int) -> np.ndarray:
    """Triangles evenly spaced on the mel scale: bins x mels."""
    top = 2595 * np.log10(1 + rate / 2 / 700)
    edges = 700 * (10 ** (np.linspace(0, top, mels + 2) / 2595) - 1)
    bins = np.fft.rfftfreq(window, 1 / rate)[:, None]
    up, down = (bins - edges[:-2]) / (edges[1:-1] - edges[:-2]), (edges[2:] - bins) / (edges[2:] - edges[1:-1])
    return np.maximum(0, np.minimum(up, down))


def log_mel(x: np.ndarray, rate: float) -> tuple[np.ndarray, np.ndarray]:
    """Log-mel energies (frames x MELS) in dB and the energy of each frame in dB; frames are centred on every HOP-th sample."""
    n = max(1, -(-len(x) // HOP))
    x = x - EMPHASIS * np.concatenate((x[:1], x[:-1]))
    x = np.pad(x, (WINDOW // 2, max(0, (n - 1) * HOP + WINDOW // 2 - len(x))))
    frames = np.lib.stride_tricks.sliding_window_view(x, WINDOW)[::HOP][:n]
    mels, energy = np.empty((n, MELS)), np.empty(n)
    for at in range(0, n, BLOCK):
        own = frames[at : at + BLOCK] * np.hanning(WINDOW)
        power = np.abs(np.fft.rfft(own)) ** 2 / WINDOW
        mels[at : at + BLOCK] = 10 * np.log10(np.maximum(power @ _mel(rate, WINDOW, MELS), 1e-10))
        energy[at : at + BLOCK] = 10 * np.log10(np.maximum((own**2).mean(axis=1), 1e-10))
    return mels, energy


def segments(energy: np.ndarray) -> list[tuple[int, int]]:
    """Frames from one that reaches the HIGH percentile to before one under the LOW percentile."""
    if not len(energy):
        return []
    high, low = np.percentile(energy, [HIGH, LOW])
    said = np.where(energy >= high, 1, np.where(energy < low, 0, -1))
    known = np.maximum.accumulate(np.where(said >= 0, np.arange(len(said)), -1))
    on = np.where(known >= 0, said[known], 0)
    turns = np.flatnonzero(np.diff(np.concatenate(([0], on, [0]))))
    return list(zip(turns[::2].tolist(), turns[1::2].tolist(), strict=True))


def features(samples: bytes, rate: int = RATE) -> tuple[np.ndarray, list[tuple[float, float]], list[tuple[float, float]]]:
    """Tensors (n x FRAMES x MELS, float32) with the span of each, and the spans of segments, in milliseconds."""
    x = resample((np.frombuffer(samples, np.uint8).astype(np.float64) - 128) / 128)
    new = rate * UP / DOWN
    mels, energy = log_mel(x, new)
    n = -(-len(mels) // FRAMES)
    tensors = np.full((n * FRAMES, MELS), FLOOR, np.float32)
    tensors[: len(mels)] = mels

    def span(first: int, end: int) -> tuple[float, float]:
        return max(0, first * HOP - WINDOW // 2) / new * 1000, min(len(x), (end - 1) * HOP + WINDOW // 2) / new * 1000

    spans = [span(k * FRAMES, min(len(mels), (k + 1) * FRAMES)) for k in range(n)]
    return tensors.reshape(n, FRAMES, MELS), spans, [span(a, b) for a, b in segments(energy)]


def digest(tensors: np.ndarray, found: list[tuple[float, float]]) -> str:
    """Tensors, segments, their milliseconds, and a checksum of the features in sixteenths of a dB."""
    steps = np.rint(np.asarray(tensors, np.float64) * 16).astype("<i2")
    return f"{len(tensors)}x{FRAMES}x{MELS};{len(found)};{round(sum(b - a for a, b in found))};{zlib.crc32(steps.tobytes()):08x}"


def tensor_array(tensors: np.ndarray) -> pa.ExtensionArray:
    """The tensors as an Arrow array of the fixed-shape type."""
    flat = pa.FixedSizeListArray.from_arrays(pa.array(np.ascontiguousarray(tensors, np.float32).reshape(-1)), FRAMES * MELS)
    return pa.ExtensionArray.from_storage(TENSOR, flat)


def store_tensors(tensors: np.ndarray, spans: list[tuple[float, float]]) -> bytes:
    """The tensors and the time span of each as an Arrow IPC stream."""
    starts, ends = zip(*spans, strict=True)
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, STORED) as w:
        w.write_batch(pa.RecordBatch.from_arrays([tensor_array(tensors), pa.array(starts, pa.float64()), pa.array(ends, pa.float64())], schema=STORED))
    return out.getvalue().to_pybytes()


def read_tensors(stored: bytes) -> tuple[np.ndarray, list[tuple[float, float]]]:
    """What store_tensors() was given: tensors (n x FRAMES x MELS) and spans."""
    table = pa.ipc.open_stream(stored).read_all()
    column = table["tensor"].combine_chunks()
    return column.to_numpy_ndarray(), list(zip(table["start_ms"].to_pylist(), table["end_ms"].to_pylist(), strict=True))


def audio_columns(docs: DataFrame) -> DataFrame:
    """The media columns and features of every text, and what they were computed from: media, tensors (read_tensors() reads
    them) and segments. The digests are those of the stored forms, read back.

    A null text is empty; an empty one is UNIT spaces. Repeated rows are kept. An empty table gives an empty table; further
    columns are not read.
    """

    small_batches(docs.sparkSession)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start_ms", pa.float64()), ("end_ms", pa.float64())]))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary(), pa.binary(), span]
        for batch in slices(batches):
            out = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                media = stored_form(data := payload(text.as_py()))
                rate, samples = read_back(media)
                tensors, spans, found = features(samples, rate)
                held = store_tensors(tensors, spans)
                size = len((text.as_py() or "").encode())
                out.append((doc, size, len(data), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-16:]), len(media), hashlib.sha256(media).hexdigest(),
                            digest(read_tensors(held)[0], found), media, held, [{"start_ms": a, "end_ms": b} for a, b in found]))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=COLUMNS)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SCHEMA)


def op10_audio_features(spark, sf_dir: str) -> DataFrame:
    return audio_columns(spark.read.parquet(f"{sf_dir}/documents.parquet"))

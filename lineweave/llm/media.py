"""Audio columns: 8-bit samples in WAV form, and features computed from the stored bytes.

``encode_wav`` wraps bytes as unsigned 8-bit mono samples. ``store_media`` writes them as a Parquet table in the shared
folder. ``audio_tensors`` and ``store_tensors`` read the samples back from the stored form and compute, in blocks of
bounded size whatever the length of the audio:

1. polyphase resampling from ``rate`` to ``rate * up / down``: one windowed-sinc filter, split into ``up`` phases;
2. log-mel energies of overlapping frames (``frame_ms`` every ``hop_ms``) over overlapping triangular filters;
3. hysteresis energy segmentation: a segment opens at ``open_db`` below the loudest frame and closes below ``close_db``.

Features are cut into windows of ``frames`` by ``mels`` values with their time span; ``fixed_shape`` turns the column
into an Arrow fixed-shape tensor array. ``store_tensors`` writes them so, with the time spans of windows and segments, to
the shared folder, in half precision (log energies to about three decimal digits); ``audio_features`` derives its column
from the rows read back. Everything is computed for one audio at a
time, so equal bytes have equal features.

Defined cases: null bytes or texts count as empty; payloads are padded with bytes 0 to a positive multiple of 64, so
that even an empty text has 64 samples; rows may repeat and ids be null, every row gives a row (``audio_features``) or
one row per window, at least one (``audio_tensors``); other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineweave.llm.common import slices, small_batches, written

UNIT = 64
HEADER = struct.Struct("<4sI4s4sIHHIIHH4sI")


def encode_wav(payload: bytes, rate: int = 16_000) -> bytes:
    """RIFF/WAVE form of the bytes as unsigned 8-bit mono samples; the payload must have an even length."""
    n = len(payload)
    return HEADER.pack(b"RIFF", 36 + n, b"WAVE", b"fmt ", 16, 1, 1, rate, rate, 1, 8, b"data", n) + payload


def decode_wav(media: bytes) -> tuple[int, bytes]:
    """Sample rate and samples of a stored audio; raises if it isn't 8-bit mono."""
    riff, _, wave, fmt, _, kind, channels, rate, _, _, bits, data, n = HEADER.unpack_from(media)
    if (riff, wave, fmt, data, kind, channels, bits) != (b"RIFF", b"WAVE", b"fmt ", b"data", 1, 1, 8) or len(media) != HEADER.size + n:
        raise ValueError("not 8-bit mono samples in WAV form")
    return rate, media[HEADER.size :]


@dataclass(frozen=True)
class Features:
    """Parameters of the features."""

    up: int = 3
    down: int = 4
    taps: int = 16  #: per phase
    frame_ms: int = 25
    hop_ms: int = 10
    mels: int = 24
    frames: int = 64  #: per tensor
    open_db: float = 6.0
    close_db: float = 12.0
    block: int = 1 << 16  #: samples that are resampled at once


def _filter(p: Features) -> np.ndarray:
    """The low-pass filter as (up, taps): row r has the taps of phase r."""
    n = p.up * p.taps
    at = np.arange(n) - (n - 1) / 2
    low = np.sinc(at / max(p.up, p.down)) * np.hamming(n)
    return np.ascontiguousarray((low / low.sum() * p.up).reshape(p.taps, p.up).T[:, ::-1]).astype(np.float32)


def resample(samples: np.ndarray, p: Features = Features()) -> Iterator[np.ndarray]:
    """Blocks of the resampled signal: output m is the dot product of a run of inputs and the taps of phase m*down mod up."""
    phases, n = _filter(p), len(samples)
    out = -(-n * p.up // p.down)
    step = max(p.up, p.block // p.up * p.up)
    for first in range(0, out, step):
        m = np.arange(first, min(out, first + step))
        newest = m * p.down // p.up
        low, high = newest[0] - p.taps + 1, newest[-1] + 1
        part = np.zeros(high - low, dtype=np.float32)
        have = samples[max(low, 0) : min(high, n)]
        part[max(low, 0) - low : max(low, 0) - low + len(have)] = (have.astype(np.float32) - 128) / 128
        runs = np.lib.stride_tricks.sliding_window_view(part, p.taps)
        y = np.empty(len(m), dtype=np.float32)
        for r in range(p.up):
            mine = np.flatnonzero(m * p.down % p.up == r)
            if len(mine):
                y[mine] = runs[newest[mine] - newest[0]] @ phases[r]
        yield y


def _mel_filters(p: Features, rate: float, size: int) -> np.ndarray:
    """Triangles evenly spaced in mel, each overlapping its neighbours by half: (bins, mels)."""
    mel = lambda hz: 2595 * np.log10(1 + hz / 700)
    points = 700 * (10 ** (np.linspace(mel(20.0), mel(rate / 2), p.mels + 2) / 2595) - 1)
    hz = np.fft.rfftfreq(size, 1 / rate)
    rise = (hz[:, None] - points[:-2]) / (points[1:-1] - points[:-2])
    fall = (points[2:] - hz[:, None]) / (points[2:] - points[1:-1])
    return np.maximum(0, np.minimum(rise, fall)).astype(np.float32)


def log_mel(samples: np.ndarray, rate: int, p: Features = Features()) -> tuple[np.ndarray, np.ndarray]:
    """Log-mel energies (frames, mels) and energy in dB of each frame; what is left behind the last whole frame makes a padded one.

    Silence of one filter's length is put behind the samples, as the last ones would reach no output otherwise.
    """
    new = rate * p.up / p.down
    size, hop = int(new * p.frame_ms / 1000), int(new * p.hop_ms / 1000)
    fft = 1 << (size - 1).bit_length()
    window, filters = np.hanning(size).astype(np.float32), _mel_filters(p, new, fft)
    rest, mels, energy, done = np.zeros(0, dtype=np.float32), [], [], 0

    def add(frames: np.ndarray) -> None:
        power = np.abs(np.fft.rfft(frames * window, fft)).astype(np.float32) ** 2
        mels.append(np.log(power @ filters + 1e-6))
        energy.append(10 * np.log10(np.mean(frames**2, axis=1) + 1e-9))

    for y in resample(np.concatenate((samples, np.full(p.taps, 128, dtype=np.uint8))), p):
        rest = np.concatenate((rest, y))
        n = (len(rest) - size) // hop + 1 if len(rest) >= size else 0
        if n:
            add(np.lib.stride_tricks.sliding_window_view(rest, size)[: n * hop : hop])
            rest, done = rest[n * hop :], done + n
    if not done or len(rest) > size - hop:
        add(np.pad(rest, (0, size - len(rest)))[None])
    return np.concatenate(mels), np.concatenate(energy)


def segments(energy: np.ndarray, p: Features = Features()) -> np.ndarray:
    """Frames (first, end) of the runs that open at the upper threshold and last until below the lower one."""
    top = energy.max()
    mark = np.where(energy >= top - p.open_db, 1, np.where(energy < top - p.close_db, 0, -1))
    last = np.maximum.accumulate(np.where(mark >= 0, np.arange(len(mark)), -1))
    on = (last >= 0) & (mark[last] == 1)
    edge = np.diff(np.concatenate(([0], on, [0])).astype(np.int8))
    return np.stack([np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)], axis=1)


def tensors(mels: np.ndarray, p: Features = Features()) -> list[tuple[float, float, int, np.ndarray]]:
    """Windows of fixed shape: (start s, end s, frames with data, values), the last one padded with its smallest value."""
    out, hop, frame = [], p.hop_ms / 1000, p.frame_ms / 1000
    for a in range(0, len(mels), p.frames):
        part = mels[a : a + p.frames]
        full = np.full((p.frames, p.mels), part.min(), dtype=np.float32)
        full[: len(part)] = part
        out.append((a * hop, (a + len(part) - 1) * hop + frame, len(part), full))
    return out


def fixed_shape(values: pa.Array, p: Features = Features(), kind: pa.DataType = pa.float32()) -> pa.Array:
    """The ``tensor`` column of ``audio_tensors`` as an Arrow fixed-shape tensor array."""
    storage = pa.FixedSizeListArray.from_arrays(values.flatten().cast(kind), p.frames * p.mels)
    return pa.ExtensionArray.from_storage(pa.fixed_shape_tensor(kind, (p.frames, p.mels), dim_names=("frame", "mel")), storage)


def payload(text: str | None) -> tuple[int, bytes]:
    """Length of the UTF-8 form and the form padded to a positive multiple of UNIT."""
    raw = (text or "").encode()
    return len(raw), raw + bytes(-len(raw) % UNIT or (UNIT if not raw else 0))


def encode_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rate: int = 16_000) -> DataFrame:
    """Rows (id, n_bytes, media): each text as an audio."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            made = [payload(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([n for n, _ in made], pa.int64()), pa.array([encode_wav(x, rate) for _, x in made], pa.binary())], names=["id", "n_bytes", "media"]
            )

    rows = small_batches(docs).select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(encode, f"id {rows.schema['id'].dataType.simpleString()}, n_bytes long, media binary")


def store_media(media: DataFrame) -> DataFrame:
    """Writes the media column to the shared folder and reads it back."""
    return written(media, "media")


def audio_tensors(stored: DataFrame, p: Features = Features()) -> DataFrame:
    """Rows (id, tensor_no, start_s, end_s, frames, tensor) of stored audios; ``tensor`` has frames * mels values."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "media"):
            for i, media in enumerate(batch.column("media").to_pylist()):
                rate, samples = decode_wav(media or encode_wav(bytes(UNIT)))
                mels, _ = log_mel(np.frombuffer(samples, dtype=np.uint8), rate, p)
                found = tensors(mels, p)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.concat_arrays([batch.column("id").slice(i, 1)] * len(found)), pa.array(range(len(found)), pa.int32()),
                        *(pa.array([x[k] for x in found], t) for k, t in ((0, pa.float64()), (1, pa.float64()), (2, pa.int32()))),
                        pa.array([x[3].ravel() for x in found], pa.list_(pa.float32())),
                    ],
                    names=["id", "tensor_no", "start_s", "end_s", "frames", "tensor"],
                )

    rows = stored.select("id", "media")
    return rows.mapInArrow(read, f"id {rows.schema['id'].dataType.simpleString()}, tensor_no int, start_s double, end_s double, frames int, tensor array<float>")


def packed(found: list[tuple[float, float, int, np.ndarray]], p: Features = Features()) -> bytes:
    """What ``tensors`` gives as an Arrow stream: start_s, end_s, frames and a column of fixed-shape tensors in half precision."""
    flat = pa.array(np.concatenate([x[3].ravel() for x in found]).astype(np.float16))
    values = fixed_shape(pa.FixedSizeListArray.from_arrays(flat, p.frames * p.mels), p, pa.float16())
    spans = [pa.array([x[k] for x in found], t) for k, t in ((0, pa.float64()), (1, pa.float64()), (2, pa.int32()))]
    batch = pa.RecordBatch.from_arrays([*spans, values], names=["start_s", "end_s", "frames", "tensor"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpacked(stream: bytes, p: Features = Features()) -> list[tuple[float, float, int, np.ndarray]]:
    """The windows of a stored Arrow stream; raises if its tensors don't have the shape."""
    found = pa.ipc.open_stream(stream).read_all().combine_chunks()
    values = found.column("tensor").chunk(0)
    if not isinstance(values.type, pa.FixedShapeTensorType) or list(values.type.shape) != [p.frames, p.mels]:
        raise ValueError("not tensors of the fixed shape")
    return list(zip(*(found.column(c).to_pylist() for c in ("start_s", "end_s", "frames")), values.to_numpy_ndarray().astype(np.float32)))


def summary(found: list[tuple[float, float, int, np.ndarray]], runs: list[dict], p: Features = Features()) -> str:
    """The stored features of one audio as a short string: counts, spans' total and a checksum of all tensors."""
    crc = 0
    for start, end, n, values in found:
        crc = zlib.crc32(np.rint(values * 8).astype("<i2").tobytes(), zlib.crc32(f"{start:.3f} {end:.3f} {n}".encode(), crc))
    mels = np.concatenate([values[:n] for _, _, n, values in found])
    active = sum(r["end"] - r["first"] for r in runs) * p.hop_ms
    return f"frames={len(mels)} tensors={len(found)}x{p.frames}x{p.mels} end_s={found[-1][1]:.3f} segments={len(runs)} active_ms={active} mean={mels.mean(dtype=np.float64):.2f} crc={crc:08x}"


#: What the stored bytes of an audio are, beside its id.
_BYTES = {"n_bytes": "long", "payload_bytes": "long", "payload_sha256": "string", "tail_crc32": "long", "media_bytes": "long", "media_sha256": "string"}
_RUNS = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32()), ("start_s", pa.float64()), ("end_s", pa.float64())]))


def store_tensors(stored: DataFrame, p: Features = Features(), most: int = 4 << 20) -> DataFrame:
    """Writes a row per stored audio to the shared folder and reads it back: what its bytes are, ``segments`` and ``tensors``.

    ``segments`` has frames and time span of each segment, ``tensors`` an Arrow stream with a fixed-shape tensor and the
    time span of each window.
    """

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "media"):
            rows, first, held = [], 0, 0
            for i, media in enumerate(batch.column("media").to_pylist()):
                media = media or encode_wav(bytes(UNIT))
                rate, x = decode_wav(media)
                mels, energy = log_mel(np.frombuffer(x, dtype=np.uint8), rate, p)
                runs = [{"first": a, "end": b, "start_s": a * p.hop_ms / 1000, "end_s": ((b - 1) * p.hop_ms + p.frame_ms) / 1000} for a, b in segments(energy, p).tolist()]
                rows.append((len(x), hashlib.sha256(x).hexdigest(), zlib.crc32(x[-UNIT:]), len(media), hashlib.sha256(media).hexdigest(), runs, packed(tensors(mels, p), p)))
                held += len(rows[-1][-1])
                if held >= most or i == batch.num_rows - 1:
                    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), _RUNS, pa.binary())
                    of = batch.slice(first, len(rows))
                    yield pa.RecordBatch.from_arrays(
                        [of.column("id"), of.column("n_bytes"), *(pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds))], names=["id", *_BYTES, "segments", "tensors"]
                    )
                    rows, first, held = [], i + 1, 0

    rows = stored.select("id", "n_bytes", "media")
    columns = ", ".join(f"{name} {kind}" for name, kind in {"id": rows.schema["id"].dataType.simpleString(), **_BYTES}.items())
    return written(rows.mapInArrow(compute, f"{columns}, segments array<struct<first:int,end:int,start_s:double,end_s:double>>, tensors binary"), "tensors")


def audio_features(stored: DataFrame, p: Features = Features()) -> DataFrame:
    """One row per stored audio: what the stored bytes are, and its features, from tensors and spans stored and read back."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "tensors"):
            feature = [summary(unpacked(x, p), runs, p) for x, runs in zip(batch.column("tensors").to_pylist(), batch.column("segments").to_pylist())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", *_BYTES)), pa.array(feature, pa.string())], names=["id", *_BYTES, "feature"])

    rows = store_tensors(stored, p)
    columns = ", ".join(f"{name} {kind}" for name, kind in {"id": rows.schema["id"].dataType.simpleString(), **_BYTES}.items())
    return rows.mapInArrow(read, f"{columns}, feature string")

"""Audio features: polyphase resampling, log-mel filterbanks and hysteresis segmentation.

A clip is a mono WAV file with unsigned 8-bit samples at ``RATE_IN``. It is resampled to ``RATE`` by a windowed-sinc
polyphase filter (up 2, down 3), cut into overlapping frames of ``WINDOW`` samples every ``HOP``, and turned into
``MELS`` log-mel energies a frame. Frames are grouped into blocks of ``FRAMES``: each block is one tensor of the fixed
shape [FRAMES, MELS] with its time span in seconds, and the tensors of a clip are an Arrow fixed-shape tensor
array in an Arrow IPC stream (float16; the last block is padded with the energy floor, its span is not).
Segments are runs of frames whose energy rises above ``ON`` times the clip's median frame energy and stay above ``OFF``
times it; a silent clip has none.

Clips are read in chunks of whole blocks, so memory does not grow with a clip's length.

Defined results: a null clip, or one without samples, has no blocks and no segments; equal clips have equal features
and equal bytes; an empty table gives an empty result. Extra columns are carried.
"""

from __future__ import annotations

import hashlib
import io
import wave
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

RATE_IN, UP, DOWN = 12_000, 2, 3
RATE = RATE_IN * UP // DOWN
TAPS = 24
WINDOW, HOP, FFT, MELS, FRAMES = 200, 80, 256, 40, 96
FLOOR = 1e-10
ON, OFF = 1.25, 1.05
#: Payloads are padded with this byte to a positive multiple of BLOCK_BYTES.
PAD, BLOCK_BYTES = b"\xff", 576
FEATURES = "media_rate int, n_samples long, duration_s double, n_blocks int, tensors binary, segments array<struct<start_s:double,end_s:double>>"


def polyphase_taps() -> np.ndarray:
    """Filter of each output phase: TAPS input samples -> UP outputs for every DOWN inputs."""
    cut = 1.0 / max(UP, DOWN)
    out = np.zeros((TAPS, UP))
    for p in range(UP):
        at = p * DOWN / UP + TAPS // 2 - 1  # place of the output among the taps
        x = (np.arange(TAPS) - at) * UP * cut
        w = 0.5 + 0.5 * np.cos(np.pi * np.clip((np.arange(TAPS) - at) / (TAPS / 2), -1, 1))
        h = np.sinc(x) * w
        out[:, p] = h / h.sum()
    return out.astype(np.float32)


def mel_filters() -> np.ndarray:
    """Triangular filters, evenly spaced in mel from 60 Hz to half the rate."""
    mel = lambda f: 2595 * np.log10(1 + f / 700)
    edges = 700 * (10 ** (np.linspace(mel(60.0), mel(RATE / 2), MELS + 2) / 2595) - 1)
    f = np.arange(FFT // 2 + 1) * RATE / FFT
    up = (f[:, None] - edges[None, :-2]) / (edges[1:-1] - edges[:-2])
    down = (edges[None, 2:] - f[:, None]) / (edges[2:] - edges[1:-1])
    return np.clip(np.minimum(up, down), 0, None).astype(np.float32)


class Kernels:
    def __init__(self) -> None:
        self.taps, self.mels, self.hann = polyphase_taps(), mel_filters(), np.hanning(WINDOW).astype(np.float32)


def resample(samples: np.ndarray, taps: np.ndarray) -> np.ndarray:
    """float32 samples at RATE_IN -> RATE. Ends are continued with silence."""
    half = TAPS // 2 - 1
    groups = -(-len(samples) // DOWN)
    padded = np.zeros((groups - 1) * DOWN + TAPS if groups else 0, np.float32)
    padded[half : half + len(samples)] = samples[: len(padded) - half]
    steps = np.lib.stride_tricks.as_strided(padded, (groups, TAPS), (4 * DOWN, 4)) if groups else np.zeros((0, TAPS), np.float32)
    return (np.ascontiguousarray(steps) @ taps).reshape(-1)[: -(-len(samples) * UP // DOWN)]


def log_mel(signal: np.ndarray, kernels: Kernels) -> tuple[np.ndarray, np.ndarray]:
    """(log-mel energies, frame energies) of the overlapping frames of a resampled signal."""
    n = max(1, -(-(len(signal) - WINDOW + HOP) // HOP)) if len(signal) else 0
    mel, energy = np.zeros((n, MELS), np.float32), np.zeros(n, np.float64)
    padded = np.zeros((n - 1) * HOP + WINDOW if n else 0, np.float32)
    padded[: len(signal)] = signal[: len(padded)]
    for at in range(0, n, 8 * FRAMES):
        m = min(8 * FRAMES, n - at)
        frames = np.lib.stride_tricks.as_strided(padded[at * HOP :], (m, WINDOW), (4 * HOP, 4)) * kernels.hann
        energy[at : at + m] = (frames.astype(np.float64) ** 2).sum(axis=1)
        power = np.abs(np.fft.rfft(frames, FFT, axis=1)).astype(np.float32) ** 2
        mel[at : at + m] = np.log(power @ kernels.mels + np.float32(FLOOR))
    return mel, energy


def hysteresis(energy: np.ndarray) -> list[tuple[int, int]]:
    """Frame runs [a, b) above OFF x median that reach ON x median somewhere."""
    if not len(energy) or (mid := float(np.median(energy))) <= 0:
        return []
    low = np.concatenate([[0], (energy > OFF * mid).astype(np.int8), [0]])
    starts, ends = np.flatnonzero(np.diff(low) == 1), np.flatnonzero(np.diff(low) == -1)
    high = np.concatenate([[0], np.cumsum(energy > ON * mid)])
    return [(int(a), int(b)) for a, b in zip(starts, ends) if high[b] > high[a]]


TENSOR = pa.fixed_shape_tensor(pa.float16(), [FRAMES, MELS], dim_names=["frame", "mel"])


def tensor_stream(mel: np.ndarray) -> bytes:
    """The blocks as an Arrow IPC stream: log_mel (fixed-shape tensor), start_s, end_s."""
    n = -(-len(mel) // FRAMES)
    blocks = np.full((n * FRAMES, MELS), np.log(FLOOR), np.float16)
    blocks[: len(mel)] = mel
    storage = pa.FixedSizeListArray.from_arrays(pa.array(blocks.reshape(-1)), FRAMES * MELS)
    start = np.arange(n) * FRAMES * HOP / RATE
    end = (np.minimum((np.arange(n) + 1) * FRAMES, len(mel)) - 1) * HOP / RATE + WINDOW / RATE
    batch = pa.record_batch([pa.ExtensionArray.from_storage(TENSOR, storage), pa.array(start), pa.array(end)], ["log_mel", "start_s", "end_s"])
    out = io.BytesIO()
    with pa.ipc.new_stream(out, batch.schema) as w:
        w.write_batch(batch)
    return out.getvalue()


def to_wav(payload: bytes) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(RATE_IN)
        w.writeframes(payload)
    return out.getvalue()


def from_wav(media: bytes) -> tuple[int, bytes]:
    with wave.open(io.BytesIO(media), "rb") as w:
        return w.getframerate(), w.readframes(w.getnframes())


def clip_features(media: bytes | None, kernels: Kernels) -> dict:
    rate, payload = from_wav(media) if media else (RATE_IN, b"")
    mels, energies = [], []
    # A chunk gives whole hops; each starts at the chunk before it, less what frames and filters overlap.
    samples = np.frombuffer(payload, np.uint8)
    step = FRAMES * HOP * DOWN // UP * 64
    lead, tail = TAPS * DOWN, (WINDOW * DOWN // UP + TAPS) // DOWN * DOWN + DOWN
    for at in range(0, len(samples), step):
        a, b = max(0, at - lead), min(len(samples), at + step + tail)
        signal = resample((samples[a:b].astype(np.float32) - 128) / 128, kernels.taps)[(at - a) * UP // DOWN :]
        last = at + step >= len(samples)
        mel, energy = log_mel(signal, kernels)
        frames = len(mel) if last else step * UP // DOWN // HOP
        mels.append(mel[:frames])
        energies.append(energy[:frames])
        if not last and len(samples) - at - step < (WINDOW - HOP) * DOWN // UP:
            # What is left is covered by the frames above but for their end.
            mels[-1], energies[-1] = mel, energy
            break
    mel = np.concatenate(mels) if mels else np.zeros((0, MELS), np.float32)
    energy = np.concatenate(energies) if energies else np.zeros(0)
    runs = [{"start_s": a * HOP / RATE, "end_s": ((b - 1) * HOP + WINDOW) / RATE} for a, b in hysteresis(energy)]
    return {"media_rate": rate, "n_samples": len(payload), "duration_s": len(payload) / rate, "n_blocks": -(-len(mel) // FRAMES), "tensors": tensor_stream(mel), "segments": runs}


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at, names = batch.schema.get_field_index("_au_text"), [x for x in batch.schema.names if x != "_au_text"]
        for row in range(0, batch.num_rows, 512):
            part = batch.slice(row, 512)
            raw = [(v.as_py() or "").encode() for v in part.column(at)]
            media = [to_wav(r + PAD * (-len(r) % BLOCK_BYTES if r else BLOCK_BYTES)) for r in raw]
            rest = [part.column(part.schema.get_field_index(x)) for x in names]
            yield pa.record_batch([*rest, pa.array([len(r) for r in raw], pa.int64()), pa.array(media, pa.binary())], [*names, "n_bytes", "media"])


def encode_texts(docs: DataFrame, text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry`` with n_bytes and media: the UTF-8 text, padded, as the samples of a WAV file."""
    schema = StructType([*[docs.schema[c] for c in carry], *_parse_datatype_string("n_bytes long, media binary").fields])
    return docs.select(*carry, F.col(text).alias("_au_text")).mapInArrow(_encode, schema)


def audio_features(clips: DataFrame, media: str = "media") -> DataFrame:
    """The rows of ``clips`` with media_rate, n_samples, duration_s, n_blocks, tensors and segments."""
    schema = StructType([*[StructField(f.name, f.dataType, True) for f in clips.schema if f.name not in {x.name for x in _parse_datatype_string(FEATURES)}], *_parse_datatype_string(FEATURES).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kernels = Kernels()
        run_type = pa.list_(pa.struct([("start_s", pa.float64()), ("end_s", pa.float64())]))
        types = [pa.int32(), pa.int64(), pa.float64(), pa.int32(), pa.binary(), run_type]
        for batch in batches:
            for row in range(0, batch.num_rows, 256):
                part = batch.slice(row, 256)
                found = [clip_features(v.as_py(), kernels) for v in part.column(part.schema.get_field_index(media))]
                names = ["media_rate", "n_samples", "duration_s", "n_blocks", "tensors", "segments"]
                kept = [x for x in part.schema.names if x not in names]
                new = [pa.array([f[k] for f in found], t) for k, t in zip(names, types)]
                yield pa.record_batch([*[part.column(part.schema.get_field_index(x)) for x in kept], *new], [*kept, *names])

    return clips.mapInArrow(run, schema)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What op2 returns of each stored clip: sums of its payload, read back."""
    for batch in batches:
        for row in range(0, batch.num_rows, 256):
            part = batch.slice(row, 256)
            col = lambda c: part.column(part.schema.get_field_index(c))  # noqa: B023, E731
            media = [v.as_py() for v in col("media")]
            payload = [from_wav(m)[1] for m in media]
            yield pa.record_batch(
                [
                    col("doc_id"),
                    col("n_bytes"),
                    pa.array([len(p) for p in payload], pa.int64()),
                    pa.array([hashlib.sha256(p).hexdigest() for p in payload]),
                    pa.array([zlib.crc32(p[-32:]) for p in payload], pa.int64()),
                    pa.array([len(m) for m in media], pa.int64()),
                    pa.array([hashlib.sha256(m).hexdigest() for m in media]),
                    pa.array([f"{n} blocks of {FRAMES}x{MELS}, {len(s)} segments, {hashlib.sha256(t).hexdigest()}" for n, s, t in zip(col("n_blocks").to_pylist(), col("segments").to_pylist(), col("tensors").to_pylist())]),
                ],
                ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"],
            )


def op2_audio_features(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return audio_features(encode_texts(docs)).mapInArrow(_digest, schema)

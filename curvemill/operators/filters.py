"""Filters and resampling of whole curves: NumPy on Arrow batches. Curves of a batch may differ in length."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from curvemill.operators.fitting import ragged
from curvemill.operators.preprocess import baseline_derivative, major_peaks, onset_walk, shift_to_zero

PAD = 12


def butterworth(order: int = 3, cutoff: float = 4.0, rate: float = 15.0) -> tuple[np.ndarray, np.ndarray]:
    """Numerator and denominator of the digital low-pass: analogue poles through the bilinear transform."""
    warped = 4 * np.tan(np.pi * cutoff / rate)
    poles = warped * np.exp(1j * np.pi * (2 * np.arange(1, order + 1) + order - 1) / (2 * order))
    gain = (warped**order / np.prod(4 - poles)).real
    return gain * np.poly(-np.ones(order)), np.poly((4 + poles) / (4 - poles)).real


def zero_phase_matrix(n: int, order: int = 3, cutoff: float = 4.0, rate: float = 15.0) -> np.ndarray:
    """The n x n matrix of filtering forwards and backwards with odd extension: curves @ matrix.T are filtered."""
    b, a = butterworth(order, cutoff, rate)
    k = len(a) - 1
    pad = min(PAD, n - 1)
    # The state that a constant input of 1 leaves unchanged.
    companion = np.eye(k, k=1)
    companion[:, 0] -= a[1:]
    steady = np.linalg.solve(np.eye(k) - companion, b[1:] - a[1:] * b[0])

    def run(x: np.ndarray) -> np.ndarray:
        state, out = steady[:, None] * x[0][None, :], np.empty_like(x)
        for i in range(len(x)):
            out[i] = b[0] * x[i] + state[0]
            state = np.vstack([state[1:], np.zeros_like(state[:1])]) + b[1:, None] * x[i] - a[1:, None] * out[i]
        return out

    eye = np.eye(n)
    long = np.vstack([2 * eye[0] - eye[pad:0:-1], eye, 2 * eye[-1] - eye[-2 : -2 - pad : -1]])
    return run(run(long)[::-1])[::-1][pad : pad + n]


def by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, their curves as a matrix) for each length of curve in a list column; null curves are in none."""
    flat, starts, lengths = ragged(column)
    for n in np.unique(lengths[lengths >= 0]):
        rows = np.flatnonzero(lengths == n)
        yield rows, flat[starts[rows][:, None] + np.arange(n)]


def over_batches(curves: DataFrame, kernel: Callable[[np.ndarray], np.ndarray], *, values: str = "values") -> DataFrame:
    """curves with ``values`` replaced by kernel(values[B, T]) -> [B, T']; null curves stay null."""
    names, at = curves.columns, curves.columns.index(values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list = [None] * b.num_rows
            for rows, block in by_length(b.column(at)):
                for r, v in zip(rows, kernel(block) if block.shape[1] else block):
                    out[r] = v
            columns = [b.column(i) for i in range(len(names))]
            columns[at] = pa.array(out, pa.list_(pa.float64()))
            yield pa.record_batch(columns, names)

    return curves.mapInArrow(run, curves.schema)


def per_curve(curves: DataFrame, kernel: Callable[[np.ndarray], dict[str, np.ndarray]], outputs: dict[str, str], *, values: str = "values") -> DataFrame:
    """curves with columns of kernel(values[B, T]) -> numbers by name; null where a curve is null or a result is not a number."""
    names, at = curves.columns, curves.columns.index(values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = {o: np.full(b.num_rows, np.nan) for o in outputs}
            for rows, block in by_length(b.column(at)):
                with np.errstate(all="ignore"):
                    for o, v in kernel(block).items():
                        out[o][rows] = v
            made = [pa.array(v, mask=~np.isfinite(v)).cast(pa.int64() if outputs[o] == "long" else pa.float64()) for o, v in out.items()]
            yield pa.record_batch([*b.columns, *made], [*names, *outputs])

    schema = StructType([*curves.schema.fields, *[StructField(o, LongType() if t == "long" else DoubleType()) for o, t in outputs.items()]])
    return curves.mapInArrow(run, schema)


def lowpass_column(curves: DataFrame, values: str, **options) -> DataFrame:
    def kernel(v: np.ndarray) -> np.ndarray:
        return v @ zero_phase_matrix(v.shape[1], **options).T if v.shape[1] > 1 else v

    return over_batches(curves, kernel, values=values)


def lowpass(curves: DataFrame, **options) -> DataFrame:
    """Zero-phase low-pass: one matrix product a batch."""
    return lowpass_column(curves, "values", **options)


def onset_gradient(curves: DataFrame, *, default: int = 10) -> DataFrame:
    """onset: the frame before the first of the two highest peaks of the smoothed gradient, the first frame left out."""

    def kernel(v: np.ndarray) -> np.ndarray:
        tail = v[:, 1:]
        return np.gradient(tail @ zero_phase_matrix(tail.shape[1]).T, axis=1) if tail.shape[1] > 1 else tail

    slopes = over_batches(curves.withColumn("_g", F.col("values")), kernel, values="_g")
    peaks = major_peaks(F.col("_g"))
    first = F.array_min(F.transform(peaks, lambda p: p["frame"]))
    return slopes.withColumn("onset", F.coalesce(first, F.lit(default))).drop("_g")


def baseline_shift(curves: DataFrame, *, default: int = 10) -> DataFrame:
    """Zeros before each curve's onset, the rest moved to start at zero."""
    found = onset_gradient(curves, default=default)
    return found.withColumn("values", shift_to_zero(F.col("values"), F.col("onset")))


def pchip_slopes(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Slopes at x of the shape-preserving cubics through y (rows)."""
    h, d = np.diff(x), np.diff(y, axis=1) / np.diff(x)
    m = np.zeros_like(y)
    if y.shape[1] == 2:
        m[:] = d
    else:
        w1, w2 = 2 * h[1:] + h[:-1], h[1:] + 2 * h[:-1]
        same = d[:, :-1] * d[:, 1:] > 0
        with np.errstate(all="ignore"):
            m[:, 1:-1] = np.where(same, (w1 + w2) / (w1 / d[:, :-1] + w2 / d[:, 1:]), 0.0)
        for end, h0, h1, d0, d1 in ((0, h[0], h[1], d[:, 0], d[:, 1]), (-1, h[-1], h[-2], d[:, -1], d[:, -2])):
            e = ((2 * h0 + h1) * d0 - h0 * d1) / (h0 + h1)
            e = np.where(np.sign(e) != np.sign(d0), 0.0, e)
            m[:, end] = np.where((np.sign(d0) != np.sign(d1)) & (np.abs(e) > 3 * np.abs(d0)), 3 * d0, e)
    return m


def pchip(x: np.ndarray, y: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Shape-preserving cubic interpolation of y (rows) at increasing x; outside, the end pieces go on. Rows share the places ``at``, or have one row of them each."""
    h, m = np.diff(x), pchip_slopes(x, y)
    i = np.clip(np.searchsorted(x, at, side="right") - 1, 0, len(x) - 2)
    t, g = (at - x[i]) / h[i], h[i]
    i = np.broadcast_to(i, (len(y), at.shape[-1]))
    y0, y1, m0, m1 = (np.take_along_axis(a, k, axis=1) for a, k in ((y, i), (y, i + 1), (m, i), (m, i + 1)))
    return (2 * t**3 - 3 * t**2 + 1) * y0 + (t**3 - 2 * t**2 + t) * g * m0 + (3 * t**2 - 2 * t**3) * y1 + (t**3 - t**2) * g * m1


def shift_rows(v: np.ndarray, t: np.ndarray, seconds: float | np.ndarray) -> np.ndarray:
    """Rows delayed by ``seconds`` (one for all, or one each): zeros before the start of delayed ones, the last value after the end of advanced ones."""
    places = t - np.atleast_1d(seconds)[:, None]
    return np.where(places < t[0], 0.0, pchip(t, v, np.clip(places, t[0], t[-1])))


def shift_curves(curves: DataFrame, seconds: float, *, dt: float) -> DataFrame:
    """Curves delayed by ``seconds``: zeros before the start of a delayed one, the last value after the end of an advanced one."""

    def kernel(v: np.ndarray) -> np.ndarray:
        return shift_rows(v, np.arange(v.shape[1]) * dt, seconds) if v.shape[1] > 1 else v

    return over_batches(curves, kernel)


def upsample(curves: DataFrame, factor: int) -> DataFrame:
    """(n - 1) * factor + 1 points by shape-preserving interpolation."""

    def kernel(v: np.ndarray) -> np.ndarray:
        n = v.shape[1]
        return pchip(np.arange(n, dtype=float), v, np.arange((n - 1) * factor + 1) / factor)

    return over_batches(curves, kernel)


def baseline_gradient(curves: DataFrame, *, default: int = 10) -> DataFrame:
    """nbf: the onset by the smoothed gradient of each curve, else that by its steepest slope; at least 3."""
    found = onset_gradient(curves, default=-1)
    return found.withColumn("nbf", F.greatest(F.when(F.col("onset") >= 0, F.col("onset")).otherwise(baseline_derivative(F.col("values"), fallback=default)), F.lit(3))).drop("onset")


def norm_legacy_shift(curves: DataFrame, *, baseline: int = 10) -> DataFrame:
    """Less the mean of frames [2, baseline), zeros before ``baseline``, then zeros before each curve's onset and the rest from zero up.

    The onset is found on the smoothed curve. Curves of only zeros or without a number are zeros.
    """

    def flat(v: np.ndarray) -> np.ndarray:
        n = v.shape[1]
        b = min(max(baseline, 3), n)
        if n < 3 or b <= 2:
            return v
        base = v[:, 2:b].mean(1)
        out = v - np.where(np.isfinite(base), base, 0.0)[:, None]
        out[:, :b] = 0.0
        return out

    dead = ~F.exists("values", lambda v: F.coalesce(~F.isnan(v) & (v != 0), F.lit(False)))
    less = over_batches(curves.withColumn("_dead", dead), flat)
    smoothed = lowpass_column(less.withColumn("_y", F.col("values")), "_y")
    moved = shift_to_zero(F.col("values"), onset_walk(F.col("_y")))
    return smoothed.withColumn("values", F.when(F.col("_dead"), F.transform("values", lambda v: F.lit(0.0))).otherwise(moved)).select(*curves.columns)

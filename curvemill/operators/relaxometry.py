"""Relaxation fits: T1 and M0 of each voxel."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curvemill.functions.percentiles import percentiles
from curvemill.functions.tables import small
from curvemill.operators.filters import per_curve


def fit_flip_angle(long: DataFrame, *, keys: list[str], tr_s: float, least_ms: float = 0.0, most_ms: float | None = None) -> DataFrame:
    """Variable flip angles (keys, angle_deg, signal, perhaps b1_scale): least squares of S / sin a on S / tan a, two angles or more.

    b1_scale multiplies the angles. T1 outside (least_ms, most_ms] is null, and M0 with it.
    """
    a = F.radians(F.col("angle_deg") * (F.coalesce("b1_scale", F.lit(1.0)) if "b1_scale" in long.columns else F.lit(1.0)))
    points = long.select(*keys, (F.col("signal") / F.sin(a)).alias("y"), (F.col("signal") / F.tan(a)).alias("x"))
    fits = points.groupBy(*keys).agg(F.regr_slope("y", "x").alias("slope"), F.regr_intercept("y", "x").alias("cut"), F.regr_sxx("y", "x").alias("sxx"))
    e1 = F.least(F.greatest(F.col("slope"), F.lit(1e-6)), F.lit(1 - 1e-6))
    t1 = F.when(F.col("sxx") > 0, -1000 * tr_s / F.ln(e1))  # two different angles or more
    inside = (t1 > least_ms) & (t1 <= most_ms if most_ms is not None else F.lit(True))
    return fits.select(*keys, F.when(inside, t1).alias("t1_ms"), F.when(inside, F.col("cut") / F.greatest(1 - e1, F.lit(1e-12))).alias("m0"))


def resolve_axis(series: DataFrame, configured: list[float]) -> DataFrame:
    """``axis`` (seconds): the configured values where the stored axis is missing, has fewer than 2 distinct values or only counts frames, and as many values are configured."""
    given = F.array(*[F.lit(float(x)) for x in configured])
    counts = F.forall(F.transform("axis", lambda v, i: F.abs(v - i) <= 0.01), lambda ok: ok)
    poor = F.col("axis").isNull() | (F.size(F.array_distinct("axis")) < 2) | counts
    fits = F.size("values") == len(configured)
    return series.withColumn("axis", F.when(F.coalesce(poor, F.lit(True)) & fits, given).otherwise(F.col("axis")))


def _best(t1: np.ndarray, sse: np.ndarray) -> np.ndarray:
    """The node of least squared error (in single precision, the first of equals), moved by a parabola in log T1 inside the grid."""
    small = np.nan_to_num(sse, nan=np.inf).astype(np.float32)
    best = small.argmin(1)
    rows, inner = np.arange(len(sse)), np.clip(best, 1, len(t1) - 2)
    l, m, r = sse[rows, inner - 1], sse[rows, inner], sse[rows, inner + 1]
    with np.errstate(all="ignore"):
        move = np.clip(0.5 * (l - r) / (l - 2 * m + r), -0.5, 0.5)
    return np.exp(np.log(t1[best]) + np.where((inner == best) & np.isfinite(move), move, 0.0) * math.log(t1[1] / t1[0]))


def _fit(curves: DataFrame, ti_s: list[float], keys: list[str], kernel: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """t1_ms and m0 of the curves that have a number at every inversion time; null for others."""

    def run(y: np.ndarray) -> dict[str, np.ndarray]:
        out = np.full((2, len(y)), np.nan)
        ok = np.isfinite(y).all(1) & (y.shape[1] == len(ti_s))
        if ok.any():
            out[:, ok] = kernel(y[ok])
        return {"t1_ms": out[0], "m0": out[1]}

    return per_curve(curves.select(*keys, "values"), run, {"t1_ms": "double", "m0": "double"}).drop("values")


def fit_recovery(curves: DataFrame, ti_s: list[float], *, keys: list[str], lo_ms: float = 100, hi_ms: float = 6000, nodes: int = 200) -> DataFrame:
    """S = A - B exp(-TI / T1) by variable projection: A and B in closed form at every node, the best node refined by a parabola."""
    t1, ti = np.logspace(math.log10(lo_ms), math.log10(hi_ms), nodes), 1000 * np.asarray(ti_s)

    def kernel(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        e = np.exp(-ti[:, None] / t1)
        n, me, my = len(ti), e.mean(0), y.mean(1)
        see, sye = (e * e).sum(0) - n * me**2, y @ e - n * my[:, None] * me
        sse = ((y * y).sum(1) - n * my**2)[:, None] - sye**2 / np.where(see > 1e-15, see, np.nan)
        fine = _best(t1, sse)
        fe = np.exp(-ti / fine[:, None])
        fm = fe.mean(1)
        slope = ((fe - fm[:, None]) * (y - my[:, None])).sum(1) / ((fe - fm[:, None]) ** 2).sum(1)
        return fine, my - slope * fm

    return _fit(curves, ti_s, keys, kernel)


def foreground(curves: DataFrame, *, by: list[str], share: float = 0.08, quantile: float = 0.98) -> DataFrame:
    """Voxels whose largest |S| exceeds a share of the 98th percentile of the positive maxima of their group."""
    with_max = curves.withColumn("_m", F.array_max(F.transform("values", lambda v: F.abs(v))))
    limit = percentiles(with_max.where("_m > 0"), by=by, column="_m", at={"_limit": quantile})
    found = with_max.join(small(limit), by) if by else with_max.crossJoin(F.broadcast(limit))
    return found.where(F.col("_m") > share * F.col("_limit")).drop("_m", "_limit")


def turbo_readout(ti_s: np.ndarray, t1_s: np.ndarray, *, alpha_deg: float = 30.0, tr_s: float = 0.00396, nph: int = 1) -> np.ndarray:
    """Signal per unit of M0 after inversion, read by a train of nph small flips: ti x t1."""
    sin, cos = math.sin(math.radians(alpha_deg)), math.cos(math.radians(alpha_deg))
    e = np.exp(-tr_s / t1_s)
    a, b = cos * e, 1 - e
    free = 1 - np.exp(-np.asarray(ti_s)[:, None] / t1_s[None, :])
    return sin * (free * a ** (nph - 1) + b * (1 - a ** (nph - 1)) / (1 - a))


def fit_recovery_turbo(curves: DataFrame, ti_s: list[float], *, keys: list[str], lo_ms: float = 100, hi_ms: float = 6000, nodes: int = 240, **readout) -> DataFrame:
    """S = M0 g(TI; T1): M0 in closed form at every node of T1, at least 0; the best node refined by a parabola."""
    t1, ti = np.logspace(math.log10(lo_ms), math.log10(hi_ms), nodes), np.asarray(ti_s)

    def kernel(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        g = turbo_readout(ti, t1 / 1000, **readout)
        gg = (g * g).sum(0)
        m0 = np.clip(y @ g / gg, 0, None)
        fine = _best(t1, (y * y).sum(1)[:, None] - 2 * m0 * (y @ g) + m0**2 * gg)
        fg = turbo_readout(ti, fine / 1000, **readout).T
        return fine, np.clip((fg * y).sum(1) / (fg * fg).sum(1), 0, None)

    return _fit(curves, ti_s, keys, kernel)

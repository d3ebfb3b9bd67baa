"""Signal to concentration, voxel by voxel. Curves carry signal, t1_ms and m0; acquisition constants are arguments."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curvemill.functions import arrays as A
from curvemill.functions.percentiles import median, percentiles
from curvemill.functions.tables import small
from curvemill.operators.aggregate import same_keys


def _less_baseline(c: Column, baseline: int, zero: bool) -> Column:
    """Minus the mean of frames [2, baseline); with zero, the frames before baseline are 0. NaN and inf become 0."""

    def of(x: Column) -> Column:
        base = F.coalesce(A.mean(A.finite_values(A.span(x, 2, baseline))), F.lit(0.0))
        shifted = F.transform(x, lambda v, i: F.when(F.lit(zero) & (i < baseline), F.lit(0.0)).otherwise(v - base))
        return A.nan_to_zero(shifted)

    return A.let(c, of)


def saturation_recovery(curves: DataFrame, *, flip_deg: float, delay_s: float = 0.120, r1: float = 4.0, baseline: int = 10, log_abs: bool = False) -> DataFrame:
    """C = -(ln(1 - S / (M0 sin a)) / TD + 1 / T1) / r1."""
    sin = math.sin(math.radians(flip_deg))
    scale, t1 = F.col("m0") * sin, F.col("t1_ms") / 1000

    def of(s: Column) -> Column:
        ratio = s / scale
        left = F.greatest(F.abs(1 - ratio), F.lit(1e-12)) if log_abs else F.when(ratio < 1, 1 - ratio)
        return F.coalesce(F.when((scale > 0) & (t1 > 0), -(F.ln(left) / delay_s + 1 / t1) / r1), F.lit(A.NAN))

    raw = F.transform("signal", (lambda s: F.lit(A.NAN)) if abs(sin) < 1e-8 else of)
    return curves.withColumn("conc", _less_baseline(raw, baseline, True))


def spgr(curves: DataFrame, *, flip_deg: float, tr_s: float, r1: float = 4.0, baseline: int = 10) -> DataFrame:
    """Spoiled gradient echo: E1 = (A - 1) / (A cos a - 1), C = -ln(E1) / (r1 TR) less the baseline."""
    sin, cos = math.sin(math.radians(flip_deg)), math.cos(math.radians(flip_deg))

    def of(s: Column) -> Column:
        a = s / (F.col("m0") * sin)
        den = a * cos - 1
        e1 = A.clip((a - 1) / F.when(F.abs(den) > 1e-12, den), 1e-12, 1.0)
        return F.coalesce(F.when(den.isNotNull() & (F.abs(den) > 1e-12), 1000 / F.col("t1_ms") / r1 - F.ln(e1) / (r1 * tr_s)), F.lit(A.NAN))

    return curves.withColumn("conc", _less_baseline(F.transform("signal", of), baseline, False))


def spgr_ratio(curves: DataFrame, *, flip_deg: float, tr_s: float, r1: float = 4.0, baseline: int = 10, skip: int = 2, limit: float = 20.0, t1_0_ms: float = 0.0) -> DataFrame:
    """M0-free: signal over its baseline median gives E1; clipped to +-limit mM where limit is positive."""
    cos = math.cos(math.radians(flip_deg))
    t1 = F.lit(t1_0_ms / 1000) if t1_0_ms > 0 else F.when((F.col("t1_ms") > 50) & (F.col("t1_ms") < 8000), F.col("t1_ms") / 1000)
    r10 = 1 / t1
    e10 = F.exp(-tr_s * r10)
    f0 = (1 - e10) / (1 - cos * e10)
    s0 = A.median(A.finite_values(A.span(F.col("signal"), skip, max(baseline, skip + 2))))

    def conc(base: Column) -> Column:
        def of(s: Column) -> Column:
            g = s / base * f0
            e1 = A.clip((1 - g) / (1 - cos * g), 1e-6, 1 - 1e-9)
            return (-F.ln(e1) / tr_s - r10) / r1

        return F.transform("signal", of)

    less = _less_baseline(A.let(s0, conc), baseline, False)
    return curves.withColumn("conc", F.transform(less, lambda v: A.clip(v, -limit, limit)) if limit > 0 else less)


def vfa_spgr(curves: DataFrame, *, flip_deg: float, tr_s: float, r1: float = 4.0) -> DataFrame:
    """E1 = (M0 sin a - S) / (M0 sin a - S cos a), C = (1/T1(t) - 1/T10) / r1; no baseline step."""
    sin, cos = math.sin(math.radians(flip_deg)), math.cos(math.radians(flip_deg))

    def of(s: Column) -> Column:
        top = F.col("m0") * sin
        e1 = A.clip((top - s) / (top - s * cos), 1e-9, 1 - 1e-9)
        return (-F.ln(e1) / tr_s - 1000 / F.col("t1_ms")) / r1

    return curves.withColumn("conc", F.transform("signal", of))


def spgr_bounded(
    curves: DataFrame, *, flip_deg: float, tr_s: float, r1: float = 4.0, baseline: int = 10, skip: int = 2, limit: float = 0.0, t1_0_ms: float = 0.0, rate: tuple[float, float] = (0.033, 30.0)
) -> DataFrame:
    """Like ``spgr_ratio`` with the relaxation rate held between bounds: signal that no rate in them gives stays at the nearer bound.

    The steady state rises with the rate, so clipping the target to its values at the bounds is the whole of it.
    """
    cos = math.cos(math.radians(flip_deg))
    t1 = F.lit(t1_0_ms / 1000) if t1_0_ms > 0 else F.when((F.col("t1_ms") > 50) & (F.col("t1_ms") < 8000), F.col("t1_ms") / 1000)
    e10 = F.exp(-tr_s / t1)
    f0 = (1 - e10) / (1 - cos * e10)
    lo, hi = ((1 - math.exp(-tr_s * r)) / (1 - cos * math.exp(-tr_s * r)) for r in rate)
    stop = max(baseline, skip + 2)
    s0 = A.median(A.finite_values(A.span(F.col("signal"), skip, stop)))

    def conc(base: Column) -> Column:
        def of(s: Column) -> Column:
            g = A.clip(s / F.when(base > 0, base) * f0, lo, hi)
            return (-F.ln((1 - g) / (1 - cos * g)) / tr_s - 1 / t1) / r1

        return F.transform("signal", of)

    def less(x: Column) -> Column:
        base = F.coalesce(A.mean(A.finite_values(A.span(x, skip, stop))), F.lit(0.0))
        return A.let(base, lambda b: F.transform(x, lambda v: v - b))

    found = A.let(A.let(s0, conc), less)
    return curves.withColumn("conc", F.transform(found, lambda v: A.clip(v, -limit, limit)) if limit > 0 else found)


def fixed_prior(curves: DataFrame, convert, *, blood_t1_ms: float, hematocrit: float = 0.0, **options) -> DataFrame:
    """The input curve's voxels converted with one T1 of blood; with a hematocrit, their concentration in plasma."""
    found = convert(curves.withColumn("t1_ms", F.lit(float(blood_t1_ms))) if blood_t1_ms > 0 else curves, **options)
    return found.withColumn("conc", F.transform("conc", lambda v: v / (1 - hematocrit))) if hematocrit > 0 else found


def acquisition(option: Column, sidecar: Column, default: Column) -> Column:
    """An acquisition parameter: the option, else the sidecar's value, else the default."""
    return F.coalesce(option, sidecar, default)


def saturation_report(curves: DataFrame, *, by: list[str], flip_deg: float, tr_s: float, baseline: int = 5) -> DataFrame:
    """ceiling (median of 1 / f0) and wrap (the ceiling over cos a), and over the foreground the shares of peaks above the one and
    at or above the other, with the peaks' median and 95th percentile."""
    cos = math.cos(math.radians(flip_deg))
    e10 = F.exp(-tr_s * 1000 / F.col("t1_ms"))
    found = curves.withColumns({"_c": (1 - cos * e10) / (1 - e10), "_s0": A.median(A.finite_values(A.span(F.col("signal"), 0, baseline)))})
    found = found.withColumn("_peak", F.array_max(A.finite_values(F.col("signal"))) / F.when(F.col("_s0") > 0, F.col("_s0"))).select(*by, "_c", "_s0", "_peak")
    middle = median(found.where("_s0 > 0"), by=by, column="_s0", name="_mid")
    limits = same_keys(median(found, by=by, column="_c", name="ceiling"), middle, by)
    front = same_keys(found, small(limits), by, "inner").where((F.col("_s0") > 0.25 * F.col("_mid")) & F.col("_peak").isNotNull())
    over, wrapped = (F.avg(c.cast("double")) for c in (F.col("_peak") > F.col("ceiling"), F.col("_peak") >= F.col("ceiling") / cos))
    shares = front.groupBy(*by, "ceiling").agg(F.count(F.lit(1)).alias("n"), over.alias("share_over"), wrapped.alias("share_wrapped"))
    peaks = percentiles(front, by=by, column="_peak", at={"peak_p50": 0.5, "peak_p95": 0.95})
    return same_keys(shares, peaks, by).withColumn("wrap", F.col("ceiling") / cos).select(*by, "ceiling", "wrap", "n", "share_over", "share_wrapped", "peak_p50", "peak_p95")

"""Ordered-frame operators: baselines, shifts, peaks and normalisation of curves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curvemill.functions import arrays as A
from curvemill.functions.percentiles import percentiles
from curvemill.functions.tables import small
from curvemill.sources.curves import subjects, to_curves, to_long


def high_signal_mean_curve(curves: DataFrame, *, keys: list[str], early: int = 5, share: float = 0.75) -> DataFrame:
    """Mean curve of the voxels whose early mean is in the top quarter, for each of ``keys``."""
    with_early = curves.withColumn("_early", A.finite(A.mean(A.finite_values(A.span(F.col("values"), 0, early)))))
    limit = percentiles(with_early, by=keys, column="_early", at={"_limit": share})
    high = with_early.join(small(limit), keys).where("_early >= _limit")
    mean = to_long(high, *keys).groupBy(*keys, "frame").agg(F.avg(A.finite(F.col("value"))).alias("value"))
    return to_curves(mean, keys)


def baseline_auto(a: Column, *, skip: int = 3, height: float = 0.5, fallback: int = 10) -> Column:
    """Place of the least value before the curve first rises to half of its height; at least 3."""

    def of(x: Column) -> Column:
        base = F.get(x, F.lit(0))
        onset = A.let(base + height * (F.array_max(x) - base), lambda level: A.first_index(x, lambda v: v >= level))
        before = A.span(x, skip, onset)
        return F.when(onset > skip, F.greatest(A.argmin(before) + skip, F.lit(3))).otherwise(fallback)

    return A.let(a, of)


def baseline_derivative(a: Column, *, fallback: int = 10) -> Column:
    """One past the last slope before the steepest that does not rise; at least 3."""

    def of(d: Column) -> Column:
        top = A.argmax(d)
        flat = F.filter(F.transform(F.slice(d, F.lit(1), top), lambda v, i: F.when(v <= 0, i)), lambda i: i.isNotNull())
        return F.greatest(F.coalesce(F.array_max(flat) + 1, F.lit(fallback)), F.lit(3))

    return A.let(A.differences(a), of)


BASELINES = {"auto": baseline_auto, "derivative": baseline_derivative, "fixed": lambda a, fallback=10: F.lit(max(3, fallback))}


def baseline_frames(curves: DataFrame, *, method: str = "auto", **options) -> DataFrame:
    if method not in BASELINES:
        raise ValueError(f"method must be one of {sorted(BASELINES)}")
    return curves.withColumn("nbf", BASELINES[method](F.col("values"), **options))


def local_maxima(a: Column) -> Column:
    """(height, frame) of every strict local maximum."""

    def of(x: Column) -> Column:
        inner = F.transform(x, lambda v, i: F.when((i > 0) & (i < F.size(x) - 1) & (v > F.get(x, i - 1)) & (v > F.get(x, i + 1)), F.struct(v.alias("height"), i.alias("frame"))))
        return F.filter(inner, lambda p: p.isNotNull())

    return A.let(a, of)


def major_peaks(a: Column, *, radius: int = 10, most: int = 2) -> Column:
    """The highest local maxima, each at least ``radius`` frames from the ones before, in order of height."""
    ranked = F.array_sort(local_maxima(a), lambda p, q: F.when(p["height"] > q["height"], -1).when(p["height"] < q["height"], 1).otherwise(p["frame"] - q["frame"]))
    empty = F.array().cast("array<struct<height:double,frame:int>>")

    def add(kept: Column, p: Column) -> Column:
        far = F.forall(kept, lambda k: F.abs(k["frame"] - p["frame"]) >= radius)
        return F.when(far & (F.size(kept) < most), F.concat(kept, F.array(p))).otherwise(kept)

    return F.aggregate(ranked, empty, add)


def onset_walk(a: Column, *, default: int = 8) -> Column:
    """The first frame from 8 on with three values in a row above the baseline's threshold, less one; at least 3."""

    def of(x: Column) -> Column:
        base = A.span(x, 3, 9)

        def run(limit: Column) -> Column:
            above = F.transform(x, lambda v: (v > limit).cast("int"))
            three = F.zip_with(F.zip_with(above, F.slice(above, F.lit(2), F.size(x)), lambda p, q: p + q), F.slice(above, F.lit(3), F.size(x)), lambda p, q: p + q)
            at = A.first_index(F.transform(three, lambda n, i: F.when(i >= 8, n)), lambda n: n == 3)
            return F.when(at.isNotNull(), F.greatest(at - 1, F.lit(3))).otherwise(default)

        span = 0.05 * (F.array_max(x) - F.array_min(x))
        return A.let(A.mean(base) + F.greatest(4 * A.std_pop(base), span, F.lit(5e-4)), run)

    return A.let(a, of)


def shift_to_zero(a: Column, start: Column | int, *, always: bool = False) -> Column:
    """Zeros before ``start``; from there on, the curve less its minimum if that is positive or any value is negative."""

    def from_zero(at: Column, tail: Column) -> Column:
        low = F.array_min(tail)
        drop = low if always else F.when((low > 0) | (low < 0), low).otherwise(F.lit(0.0))
        return F.concat(F.array_repeat(F.lit(0.0), at), A.let(drop, lambda d: F.transform(tail, lambda v: v - d)))

    def of(x: Column) -> Column:
        at = F.greatest(F.least(F.lit(start) if isinstance(start, int) else start, F.size(x)), F.lit(0))
        return A.let(at, lambda k: A.let(F.slice(x, k + 1, F.size(x)), lambda tail: from_zero(k, tail)))

    return A.let(a, of)


def norm_baseline_p95(curves: DataFrame, *, baseline: int = 5, percent: float = 95.0) -> DataFrame:
    """Less the baseline's mean, over the percentile of what is left; a scale of 0 counts as 1."""

    def of(x: Column) -> Column:
        less = A.let(A.mean(A.span(x, 0, baseline)), lambda m: F.transform(x, lambda v: v - m))
        return A.let(less, lambda c: A.let(A.quantile(F.transform(c, F.abs), percent / 100), lambda s: F.transform(c, lambda v: v / F.when(s == 0, F.lit(1.0)).otherwise(s))))

    return curves.withColumn("values", A.let(F.col("values"), of))


def peak_time_subsample(curves: DataFrame) -> DataFrame:
    """peak_frame and height: each curve's first peak, moved by the top of a parabola through its neighbours (one frame at most)."""

    def of(x: Column) -> Column:
        def moved(at: Column) -> Column:
            b, v, a = F.get(x, at - 1), F.get(x, at), F.get(x, at + 1)
            den = b - 2 * v + a
            move = F.when((at > 0) & (at < F.size(x) - 1) & (den != 0), A.clip(0.5 * (b - a) / F.when(den != 0, den), -1.0, 1.0))
            return F.struct((at + F.coalesce(move, F.lit(0.0))).alias("peak_frame"), v.alias("height"))

        return A.let(A.argmax(x), moved)

    return curves.withColumn("_p", A.let(F.col("values"), of)).withColumns({"peak_frame": F.col("_p.peak_frame"), "height": F.col("_p.height")}).drop("_p")


def norm_identity(curves: DataFrame) -> DataFrame:
    """The curves as they are."""
    return curves


def align_lengths(*columns: str) -> dict[str, Column]:
    """The named arrays cut to their common length, for withColumns."""
    n = F.least(*[F.size(c) for c in columns]) if len(columns) > 1 else F.size(columns[0])
    return {c: F.slice(c, F.lit(1), n) for c in columns}


def crop_to_onset(curves: DataFrame, inputs: DataFrame, *, share: float = 0.05) -> DataFrame:
    """Curves from one frame before their subject's input curve first exceeds a share of its maximum, if that lies within the curve."""
    by = subjects(curves, inputs)
    onset = A.let(F.array_max("c_a"), lambda top: A.first_index(F.col("c_a"), lambda v: v > share * top)) - 1
    starts = inputs.select(*by, F.when((onset > 0) & (onset < F.size("c_a") - 5), onset).otherwise(0).alias("_i0"))
    few = small(starts)
    found = curves.join(few, by, "left") if by else curves.crossJoin(few)
    return found.withColumn("values", F.slice("values", F.coalesce("_i0", F.lit(0)) + 1, F.size("values"))).drop("_i0")


def tail_slope(a: Column, dt: float, share: float) -> Column:
    """Slope of the least-squares line through the last ``share`` of a curve; 0 with fewer than 3 frames there."""

    def of(x: Column) -> Column:
        i0 = F.floor(F.size(x) * (1 - share)).cast("int")
        tail = F.slice(x, i0 + 1, F.size(x))

        def line(y: Column) -> Column:
            middle = (F.size(y) - 1) / 2
            up = A.let(A.mean(y), lambda m: A.total(F.transform(y, lambda v, i: (v - m) * (i - middle))))
            return up / (A.total(F.transform(y, lambda v, i: (i - middle) * (i - middle))) * dt)

        return F.when(F.size(tail) >= 3, A.let(tail, line)).otherwise(0.0)

    return A.let(a, of)


def detrend_tail(curves: DataFrame, *, dt: float, tail: float = 0.30) -> DataFrame:
    """Curves less the slope of their last frames times t."""
    slope = tail_slope(F.col("values"), dt, tail)
    return curves.withColumn("values", A.let(slope, lambda k: F.transform("values", lambda v, i: v - k * i * dt)))


def detrend(curves: DataFrame, inputs: DataFrame, *, keys: list[str], mode: str = "auto", tail: float = 0.30, threshold: float = 5e-4) -> DataFrame:
    """keys and ``values`` without drift: that of the subject's input curve (aif, auto above a normalised threshold, rigid or
    rigid-auto beside washout), each curve's own (self), or none."""
    from curvemill.operators import tails
    from curvemill.operators.fitting import over_inputs

    def prepare(c_a, t):
        return {"t": t, "slope": tails.drift_slope(c_a, t, mode, tail, threshold)}

    def kernel(values, c, carried):
        slope, own = c["slope"]
        slopes = tails.tail_slopes(values, c["t"], tail)[:, None] if own else slope
        return {"values": (values - slopes * c["t"]).tolist()}

    return over_inputs(curves, inputs, prepare, kernel, keys=keys, outputs={"values": "array<double>"})


def detect_boluses(a: Column, *, share: float = 0.2, most: int = 2) -> Column:
    """Frames of the highest maxima of at least a share of the top, apart by a twentieth of the curve (2 at least), in order."""

    def of(x: Column) -> Column:
        radius, top = F.greatest(F.lit(2), F.floor(F.size(x) / 20).cast("int")), F.array_max(x)
        high = A.let(top, lambda t: F.filter(local_maxima(x), lambda p: p["height"] >= share * t))
        ranked = F.array_sort(high, lambda p, q: F.when(p["height"] > q["height"], -1).when(p["height"] < q["height"], 1).otherwise(p["frame"] - q["frame"]))
        kept = F.aggregate(ranked, F.array().cast("array<int>"), lambda s, p: F.when(F.forall(s, lambda k: F.abs(k - p["frame"]) >= radius) & (F.size(s) < most), F.concat(s, F.array(p["frame"]))).otherwise(s))
        return F.array_sort(kept)

    return A.let(a, of)


def trailing_artifacts(input_curve: Column, mean_curve: Column, *, most: int = 3) -> Column:
    """How many frames at the end to drop: those where either curve falls 4 robust deviations and by half below its tail."""

    def low(x: Column) -> Column:
        tail = F.slice(x, F.floor(F.size(x) / 2).cast("int") + 1, F.size(x) - 3 - F.floor(F.size(x) / 2).cast("int"))

        def of(mid: Column) -> Column:
            mad = A.median(F.transform(tail, lambda v: F.abs(v - mid)))
            return A.let(F.least(mid - 4 * 1.4826 * mad, 0.5 * mid), lambda limit: F.transform(x, lambda v: v < limit))

        return A.let(A.median(tail), of)

    both = F.zip_with(low(input_curve), low(mean_curve), lambda p, q: p | q)

    def count(bad: Column) -> Column:
        n = F.size(bad)
        run = F.lit(0)
        for k in range(most, 0, -1):
            all_bad = F.lit(True)
            for j in range(1, k + 1):
                all_bad = all_bad & F.coalesce(F.get(bad, n - j), F.lit(False))
            run = F.when((run == 0) & all_bad, k).otherwise(run)
        return F.when(n >= 20, run).otherwise(0)

    return A.let(both, count)

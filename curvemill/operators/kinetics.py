"""Kinetic models on curves against their subject's input curve. Rates come out x 6000 (mL/100 g/min), fractions x 100 (mL/100 g)."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curvemill.functions.tables import small
from curvemill.operators import tails
from curvemill.operators.fitting import MODELS, Model, fit_model, over_inputs, register_model, subject_columns

__all__ = ["MODELS", "fit_by_label", "fit_model", "long_input", "patlak", "patlak_coordinates", "patlak_predict", "patlak_window", "pin_flow", "residue_moments", "tofts_predict"]


def long_input(inputs: DataFrame) -> DataFrame:
    """One row a subject (c_a, t_s) -> (subject columns, curve, frame, c_a, t)."""
    subject = subject_columns(inputs)
    each = inputs.select(*subject, F.lit(0).alias("curve"), F.posexplode(F.arrays_zip("c_a", "t_s")).alias("frame", "s"))
    return each.select(*subject, "curve", "frame", F.col("s.c_a").alias("c_a"), F.col("s.t_s").alias("t"))


def patlak_coordinates(long: DataFrame, *, inclusive: bool = False) -> DataFrame:
    """(frame, t, c_a) -> x: the integral of c_a up to the frame over c_a; exclusive left rule, or inclusive with a fixed step.

    One row a frame of each subject's input curve: the window is over a curve, not over voxels.
    """
    subject = [c for c in long.columns if c not in ("frame", "t", "c_a")]
    w = Window.partitionBy(*subject).orderBy("frame")
    c_a = F.when(F.col("c_a") != 0, F.col("c_a"))
    if inclusive:
        step = F.max(F.when(F.col("frame") == 1, F.col("t"))).over(Window.partitionBy(*subject)) - F.min("t").over(Window.partitionBy(*subject))
        x = F.sum("c_a").over(w.rowsBetween(Window.unboundedPreceding, 0)) * step / c_a
        return long.withColumn("x", F.coalesce(x, F.lit(0.0)))
    with_area = long.withColumn("_area", F.col("c_a") * (F.lead("t").over(w) - F.col("t")))
    return with_area.withColumn("x", F.coalesce(F.sum("_area").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)) / c_a).drop("_area")


def _patlak_prepare(
    c_a: np.ndarray,
    t: np.ndarray,
    window: float = 1 / 3,
    inclusive: bool = False,
    per_voxel: bool = True,
    floor: float = 0.0,
    single_bolus: bool = False,
    single_bolus_start_s: float = 60.0,
    start: int | None = None,
    stop: int | None = None,
    tail: str | None = None,
    huber: bool = False,
    delta: float = 1.345,
    steps: int = 20,
    tolerance: float = 1e-7,
    detrend: str = "none",
    detrend_tail: float = 0.30,
    detrend_threshold: float = 5e-4,
) -> dict | None:
    if len(t) < 2:
        return None
    drift, own = tails.drift_slope(c_a, t, detrend, detrend_tail, detrend_threshold)
    c_a = c_a - drift * t
    with np.errstate(all="ignore"):
        area = np.cumsum(c_a) * (t[1] - t[0]) if inclusive else np.concatenate([[0.0], np.cumsum(c_a[:-1] * np.diff(t))])
        x = np.where(c_a != 0, area / c_a, 0.0) if inclusive else area / c_a
    usable = np.isfinite(x) & np.isfinite(c_a) & ((c_a != 0) | inclusive)
    if (floor or single_bolus) and np.nanmax(c_a) > 0:
        usable &= c_a >= (floor or 0.05) * np.nanmax(c_a)
    if single_bolus:
        usable &= t >= t[int(np.argmax(c_a))] + single_bolus_start_s
    if tail:
        start, stop = tails.tail_frames(c_a, t, tail)
    frames = np.arange(len(t))
    if start is not None:
        usable &= (frames >= start) & (frames < (len(t) if stop is None else stop))
    return {
        "t": t, "c_a": c_a, "x": np.where(usable, x, 0.0), "usable": usable, "drift": drift, "own": own, "detrend_tail": detrend_tail, "inclusive": inclusive,
        "window": None if single_bolus or start is not None else window if 0 < window < 1 else 1 / 3,
        "strict": not per_voxel, "huber": huber, "delta": delta, "steps": steps, "tolerance": tolerance,
    }


def _line(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, ...]:
    """Weighted slope, intercept, sum of weights, sxx and sum of squared residuals of every row."""
    n = w.sum(1)
    mx, my = (w * x).sum(1) / n, (w * y).sum(1) / n
    dx, dy = x - mx[:, None], y - my[:, None]
    sxx = (w * dx * dx).sum(1)
    slope = (w * dx * dy).sum(1) / sxx
    return slope, my - slope * mx, n, sxx, (w * (dy - slope[:, None] * dx) ** 2).sum(1)


def _patlak(values: np.ndarray, c: dict, carried: dict) -> dict[str, np.ndarray]:
    """Least squares of c_t / c_a on x inside the window of each curve, or Huber's estimate by reweighting.

    Every curve stops by itself, so results don't depend on batches.
    """
    if c["own"]:
        values = values - tails.tail_slopes(values, c["t"], c["detrend_tail"])[:, None] * c["t"]
    else:
        values = values - c["drift"] * c["t"]
    y = np.where(c["c_a"] != 0, values / c["c_a"], 0.0) if c["inclusive"] else values / c["c_a"]
    good = c["usable"] & (np.isfinite(y) | c["inclusive"])
    x, y = np.broadcast_to(c["x"], y.shape), np.where(good, y, 0.0)
    if c["window"] is not None:
        top = np.where(good, x, -np.inf).max(1, initial=-np.inf)[:, None]
        good = good & (x >= c["window"] * top) & (x <= top)
    w = good.astype(float)
    slope, cut, n, sxx, sse = _line(x, y, w)
    ok = (n >= 2) & np.isfinite(sxx) & (sxx > 0)
    dof = np.where(n > 2, n - 2, np.nan if c["strict"] else 1.0)
    sd = np.sqrt(np.maximum(sse, 0) / sxx / dof)
    if c["huber"]:
        live = ok.copy()
        for _ in range(c["steps"]):
            r = np.where(good[live], y[live] - slope[live, None] * x[live] - cut[live, None], np.nan)
            scale = 1.4826 * np.nanmedian(np.abs(r - np.nanmedian(r, axis=1, keepdims=True)), axis=1)
            u = np.abs(r) / np.where(scale > 1e-12, scale, 1.0)[:, None]
            weight = w[live] * np.where(u <= c["delta"], 1.0, c["delta"] / np.maximum(np.nan_to_num(u, nan=1.0), 1e-12))
            new, new_cut, total, spread, _ = _line(x[live], y[live], weight)
            take = np.isfinite(new) & (spread > 0) & (total >= 2)
            moved = np.where(take, np.abs(new - slope[live]), 0.0)
            at = np.flatnonzero(live)
            slope[at[take]], cut[at[take]] = new[take], new_cut[take]
            live[at] = take & (moved >= c["tolerance"])
            if not live.any():
                break
    blank = np.where(ok, 1.0, np.nan)
    return {"ki": slope * 6000 * blank, "vb": cut * 100 * blank, "sd_ki": sd * 6000 * blank, "n": n}


_PATLAK = {
    "window": 1 / 3, "inclusive": False, "per_voxel": True, "floor": 0.0, "single_bolus": False, "single_bolus_start_s": 60.0, "start": None, "stop": None, "tail": None,
    "huber": False, "delta": 1.345, "steps": 20, "tolerance": 1e-7, "detrend": "none", "detrend_tail": 0.30, "detrend_threshold": 5e-4,
}
for _name, _options in {
    "patlak": {},
    "patlak_huber": {"huber": True},
    "patlak_inclusive": {"inclusive": True},
    "patlak_legacy": {"per_voxel": False},
    "patlak_tail": {"tail": "curvature"},
}.items():
    register_model(_name, Model(("ki", "vb", "sd_ki", "n"), _patlak_prepare, _patlak, options={**_PATLAK, **_options}))


def patlak(curves: DataFrame, inputs: DataFrame, *, keys: Sequence[str], **options) -> DataFrame:
    """ki, vb, sd_ki and n of every curve: least squares of c_t / c_a on x over x >= window * its largest x.

    A projection of the curves: nothing is exploded or shuffled.
    """
    return fit_model(curves, inputs, "patlak", keys=keys, **options).withColumn("n", F.col("n").cast("long"))


def patlak_window(curves: DataFrame, inputs: DataFrame, *, keys: Sequence[str], start: int, stop: int, **options) -> DataFrame:
    """ki and vb of every curve by least squares (or ``huber``) over the frames [start, stop), the same for all."""
    return fit_model(curves, inputs, "patlak", keys=keys, start=start, stop=stop, **options).select(*keys, "ki", "vb")


def patlak_predict(fits: DataFrame, inputs: DataFrame) -> DataFrame:
    """fits with ``predicted``: ki/6000 times the running integral of c_a plus vb/100 times c_a of the fit's subject."""
    subject = subject_columns(inputs)
    long = long_input(inputs)
    w = Window.partitionBy(*subject, "curve").orderBy("frame")
    area = long.withColumn("_a", F.col("c_a") * (F.lead("t").over(w) - F.col("t")))
    area = area.withColumn("_i", F.coalesce(F.sum("_a").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    one = area.groupBy(*subject, "curve").agg(F.array_sort(F.collect_list(F.struct("frame", "_i", "c_a"))).alias("_s"))
    few = F.broadcast(one) if inputs.count() <= 10_000 else one
    joined = fits.join(few, subject) if subject else fits.crossJoin(few)
    return joined.withColumn("predicted", F.transform("_s", lambda s: F.col("ki") / 6000 * s["_i"] + F.col("vb") / 100 * s["c_a"])).drop("curve", "_s")


def trapezoid_exponential(c_a: np.ndarray, t: np.ndarray, k: np.ndarray) -> np.ndarray:
    """c_a convolved with exp(-k t) by the trapezoid recurrence, one column a rate."""
    out = np.zeros((len(t), len(k)))
    for i in range(1, len(t)):
        dt = t[i] - t[i - 1]
        decay = np.exp(-k * dt)
        out[i] = out[i - 1] * decay + 0.5 * dt * (c_a[i - 1] * decay + c_a[i])
    return out


def _tofts_prepare(c_a: np.ndarray, t: np.ndarray, nodes: int = 400, lo: float = 1e-4, hi: float = 2.0) -> dict | None:
    if len(t) < 3:
        return None
    k = np.logspace(np.log10(lo), np.log10(hi), nodes)
    return {"c_a": c_a, "k": k, "basis": trapezoid_exponential(c_a, t, k)}


def _tofts(values: np.ndarray, c: dict, carried: dict) -> dict[str, np.ndarray]:
    """The two linear parameters in closed form at every rate; the rate with the least squared error."""
    b, a = c["basis"], c["c_a"]
    bb, ab, aa = (b * b).sum(0) + 1e-12, a @ b, a @ a + 1e-12
    yb, ya = values @ b, values @ a
    det = aa * bb - ab**2
    k_trans = (yb * aa - ya[:, None] * ab) / det
    v_p = (ya[:, None] * bb - yb * ab) / det
    sse = (values**2).sum(1)[:, None] - k_trans * yb - v_p * ya[:, None]
    best = np.nan_to_num(sse, nan=np.inf).argmin(1)
    rows = np.arange(len(values))
    kt, vp, kep = np.clip(k_trans[rows, best], 0, 0.25), np.clip(v_p[rows, best], 0, 1), c["k"][best]
    return {"ktrans": kt * 6000, "ve": np.clip(kt / kep, 0, 1), "vp": vp, "kep": kep + 0 * kt}


def _tofts_out(values: np.ndarray, c: dict, carried: dict) -> dict[str, np.ndarray]:
    found = _tofts(values, c, carried)
    return {**found, "kep": found["kep"] * 60}


register_model("extended_tofts", Model(("ktrans", "ve", "vp", "kep"), _tofts_prepare, _tofts_out, options={"nodes": 400, "lo": 1e-4, "hi": 2.0}, dear=True))


def tofts_predict(fits: DataFrame, inputs: DataFrame, *, keys: Sequence[str]) -> DataFrame:
    """keys and ``predicted`` of fits (ktrans x 6000, ve, vp): ktrans times c_a convolved with exp(-ktrans / ve t), plus vp c_a."""

    def kernel(values, c, carried):
        k, ve, vp = carried["ktrans"] / 6000, np.maximum(carried["ve"], 1e-12), carried["vp"]
        return {"predicted": (k[:, None] * trapezoid_exponential(c["c_a"], c["t"], k / ve).T + vp[:, None] * c["c_a"]).tolist()}

    return over_inputs(fits, inputs, lambda c_a, t: {"c_a": c_a, "t": t}, kernel, keys=keys, outputs={"predicted": "array<double>"}, values=None, carried=["ktrans", "ve", "vp"])


def residue_moments(curves: DataFrame, *, dt: float) -> DataFrame:
    """mtt and cth of residue curves in ``values``: clipped at 0, made to fall, then the integral and the spread of minus its slope.

    Null where the slope's area is 1e-12 or less, or a curve has fewer than 5 values.
    """
    from curvemill.operators.deconvolution import residue_mtt_cth
    from curvemill.operators.filters import per_curve

    def kernel(v: np.ndarray) -> dict[str, np.ndarray]:
        mtt, cth = residue_mtt_cth(v, dt)
        return {"mtt": mtt, "cth": cth}

    return per_curve(curves, kernel, {"mtt": "double", "cth": "double"})


def pin_flow(curves: DataFrame, inputs: DataFrame, model: str, *, keys: Sequence[str], deconvolution: dict | None = None, **options) -> DataFrame:
    """A model whose flow is pinned to each curve's own flow by deconvolution, in two passes over the curves."""
    flow = fit_model(curves, inputs, "deconvolve", keys=keys, **(deconvolution or {})).select(*keys, F.col("cbf").alias("flow"))
    return fit_model(curves.drop("flow").join(flow, [*keys]), inputs, model, keys=keys, **options)


def fit_by_label(curves: DataFrame, inputs: DataFrame, *, label: str = "label", keys: Sequence[str], model: str = "patlak", flow: str | None = None, **options) -> DataFrame:
    """A model's fit of each label's median curve, painted on its voxels; labels of only zeros or no numbers are null.

    With ``flow``, a column of the curves, a label's flow is pinned to the median of that column.
    """
    from curvemill.functions.percentiles import median
    from curvemill.operators.aggregate import group_median_curve

    groups = [*subject_columns(inputs), label]
    middle = group_median_curve(curves.where(F.col(label) > 0), by=groups, least=1)
    middle = middle.where(F.exists("values", lambda v: F.coalesce(v != 0, F.lit(False))))
    if flow:
        middle = middle.join(median(curves, by=groups, column=flow, name="flow"), groups)
    fits = fit_model(middle, inputs, model, keys=groups, **options)
    outputs = [c for c in fits.columns if c not in groups]
    painted = curves.select(*dict.fromkeys([*keys, *groups])).join(small(fits), groups, "left")
    return painted.select(*dict.fromkeys([*keys, label]), *outputs)

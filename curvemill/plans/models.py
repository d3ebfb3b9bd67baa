"""Queries of kinetic models, their variants and the cohort: they go into the tables of plans.queries.

The cohort's subjects are the embeddings dealt three ways, with voxel ids of their own that overlap.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from curvemill.functions import arrays as A
from curvemill.operators import aggregate, aif, cohort, concentration, diffusion, filters, kinetics, labels, preprocess, relaxometry
from curvemill.operators import deconvolution as _deconvolution  # noqa: F401  (registers its model)
from curvemill.operators import transit as _transit  # noqa: F401  (registers its models)
from curvemill.operators.fitting import MODELS, fit_model
from curvemill.plans import sql_parts
from curvemill.plans.queries import COORDS, INPUT, LONG, OTSU, REGION_SQL, _curves, _gradients, _long_out, _maps, _r, _region_map, _streamlines, query
from curvemill.sources import curves as C
from curvemill.sources import headers

COHORT = """c as (select 's' || vec_id % 3 as subject_id, vec_id // 3 as voxel_id, (vec_id // 3) % 8 as x, (vec_id // 24) % 8 as y, vec_id // 192 as z, label + 1 as label,
    (800 + 10 * (vec_id % 100))::double as t1_ms, unnest(range(len(embedding))) as frame, unnest(embedding)::double as v from embeddings)"""
COHORT_INPUT = """ca as (select subject_id, frame, 1 + avg(v) as c_a, frame * 2.463 as t from c group by subject_id, frame),
co as (select subject_id, frame, c_a, coalesce(sum(area) over (partition by subject_id order by frame rows between unbounded preceding and 1 preceding), 0) / c_a as x
    from (select *, c_a * (lead(t) over (partition by subject_id order by frame) - t) as area from ca))"""


def _cohort(spark, sf):
    return C.cohort_curves(spark, sf)


def _bolus_input(spark, sf):
    """An input curve with zeros before its arrival: the mean curve, less its first value, from frame 4 on."""
    c = _curves(spark, sf)
    i = C.input_curve(c)
    return i.withColumn("c_a", F.transform("c_a", lambda v, k: F.when(k < 4, 0.0).otherwise(v)))


ZEROED = "ca as (select frame, case when frame < 4 then 0 else 1 + avg(v) end as c_a, frame * 2.463 as t from c group by frame)"


@query(
    "k03_patlak_cohort",
    f"""with {COHORT}, {COHORT_INPUT}, p as (select c.subject_id, c.voxel_id, co.x, c.v / co.c_a as y from c join co using (subject_id, frame) where co.x >= (select max(x) from co o where o.subject_id = c.subject_id) / 3)
select subject_id, voxel_id, round(regr_slope(y, x) * 6000, 6) as ki, round(regr_intercept(y, x) * 100, 6) as vb from p group by subject_id, voxel_id""",
)
def k03c(spark, sf):
    c = _cohort(spark, sf)
    return kinetics.patlak(c, C.input_curve(c), keys=["subject_id", "voxel_id"]).select("subject_id", "voxel_id", *_r("ki", "vb"))


def _huber_sql(rounds: int) -> str:
    """Rounds of reweighted least squares in SQL; a curve whose slope no longer moves keeps it."""
    parts = [
        f"{LONG}, {ZEROED}, {COORDS.replace('/ c_a as x', '/ nullif(c_a, 0) as x')}",
        "p as (select voxel_id, x, y from (select c.voxel_id, co.x, c.v / nullif(co.c_a, 0) as y, max(co.x) over (partition by c.voxel_id) as xm from c join co using (frame) where co.c_a <> 0) where x >= xm / 3)",
        "f0 as (select voxel_id, regr_slope(y, x) as k, regr_intercept(y, x) as b, true as live from p group by voxel_id)",
    ]
    for i in range(rounds):
        parts += [
            f"r{i} as materialized (select p.voxel_id, x, y, k, b, live, y - k * x - b as r, median(y - k * x - b) over (partition by p.voxel_id) as m from p join f{i} using (voxel_id))",
            f"s{i} as materialized (select *, 1.4826 * median(abs(r - m)) over (partition by voxel_id) as mad from r{i})",
            f"w{i} as (select *, case when abs(r) / case when mad > 1e-12 then mad else 1 end <= 1.345 then 1 else 1.345 * case when mad > 1e-12 then mad else 1 end / abs(r) end as w from s{i})",
            f"""m{i} as materialized (select voxel_id, any_value(k) as k, any_value(b) as b, any_value(live) as live, sum(w * x) / sum(w) as mx, sum(w * y) / sum(w) as my from w{i} group by voxel_id),
n{i} as (select voxel_id, sum(w * (w{i}.x - mx) * (w{i}.y - my)) / sum(w * (w{i}.x - mx) * (w{i}.x - mx)) as nk from w{i} join m{i} using (voxel_id) group by voxel_id)""",
            f"f{i + 1} as materialized (select voxel_id, case when live then nk else k end as k, case when live then my - nk * mx else b end as b, live and abs(nk - k) >= 1e-7 as live from m{i} join n{i} using (voxel_id))",
        ]
    return f"with {', '.join(parts)} select voxel_id, round(k * 6000, 4) as ki, round(b * 100, 4) as vb from f{rounds}"


@query("k04_patlak_huber", _huber_sql(20))
def k04(spark, sf):
    return fit_model(_curves(spark, sf), _bolus_input(spark, sf), "patlak_huber", keys=["voxel_id"]).select("voxel_id", *_r("ki", "vb", digits=4))


@query(
    "k06_patlak_legacy",
    f"""with {LONG}, {ZEROED}, {COORDS.replace('/ c_a as x', '/ nullif(c_a, 0) as x')}, p as (select c.voxel_id, co.x, c.v / nullif(co.c_a, 0) as y from c join co using (frame) where co.x >= (select max(x) from co) / 3),
s as (select voxel_id, count(*) as n, regr_slope(y, x) as k, regr_intercept(y, x) as b, regr_sxx(y, x) as sxx, regr_syy(y, x) as syy, regr_sxy(y, x) as sxy from p group by voxel_id)
select voxel_id, round(k * 6000, 6) as ki, round(b * 100, 6) as vb, round(sqrt(greatest(syy - k * sxy, 0) / sxx / nullif(n - 2, 0)) * 6000, 6) as sd_ki from s""",
)
def k06(spark, sf):
    return fit_model(_curves(spark, sf), _bolus_input(spark, sf), "patlak_legacy", keys=["voxel_id"]).select("voxel_id", *_r("ki", "vb", "sd_ki"))


@query(
    "k06_patlak_single_bolus",
    f"""with {LONG}, {INPUT}, {COORDS}, pk as (select arg_max(frame, (c_a, -frame)) * 2.463 + 60 as t0, max(c_a) * 0.05 as low from ca),
p as (select c.voxel_id, co.x, c.v / co.c_a as y from c join co using (frame), pk where c.frame * 2.463 >= t0 and c_a >= low)
select e.vec_id as voxel_id, round(regr_slope(y, x) * 6000, 6) as ki, round(case when count(x) >= 2 then regr_intercept(y, x) end * 100, 6) as vb from embeddings e left join p on p.voxel_id = e.vec_id group by e.vec_id""",
)
def k06s(spark, sf):
    c = _curves(spark, sf)
    return fit_model(c, C.input_curve(c), "patlak_legacy", keys=["voxel_id"], single_bolus=True).select("voxel_id", *_r("ki", "vb"))


def _tail_query(name: str, mode: str, sql: str | None):
    @query(name, sql)
    def run(spark, sf):
        c = _curves(spark, sf)
        return fit_model(c, C.input_curve(c), "patlak_tail", keys=["voxel_id"], tail=mode).select("voxel_id", *_r("ki", "vb"))


_TAIL_SQL = """with {long}, {input}, {coords}, p as (select c.voxel_id, co.x, c.v / co.c_a as y from c join co using (frame) where {frames})
select voxel_id, round(regr_slope(y, x) * 6000, 6) as ki, round(regr_intercept(y, x) * 100, 6) as vb from p group by voxel_id"""
_tail_query("k07_tail_fixed", "fixed", _TAIL_SQL.format(long=LONG, input=INPUT, coords=COORDS, frames="frame >= 21"))
_tail_query("k07_tail_x_max_fraction", "x_max_fraction", _TAIL_SQL.format(long=LONG, input=INPUT, coords=COORDS, frames="frame >= (select min(frame) from co where x >= (select max(x) from co) / 3)"))
for _mode, _start in sql_parts.TAIL_STARTS.items():
    _tail_query(f"k07_tail_{_mode}", _mode, _TAIL_SQL.replace("with", "with recursive", 1).format(long=LONG, input=INPUT, coords=f"{COORDS}, {_start}", frames="frame >= (select i0 from st)"))


def _tissue(spark, sf):
    """Curves of the uptake that the embeddings' first values set, plus a hundredth of the embedding; and a bolus for input."""
    c = _curves(spark, sf)
    i = C.input_curve(c).withColumn("c_a", F.transform("c_a", lambda v, k: v * F.pow(k / 6, F.lit(3.0)) * F.exp(3 * (1 - k / 6))))
    first = [F.abs(F.get("values", F.lit(k))) for k in range(3)]
    fits = c.select("voxel_id", "label", "values", (40 + 100 * first[0]).alias("ktrans"), (0.04 + 0.1 * first[1]).alias("ve"), (0.01 + 0.1 * first[2]).alias("vp"))
    uptake = kinetics.tofts_predict(fits, i, keys=["voxel_id", "label", "values"])
    return uptake.select("voxel_id", "label", F.zip_with("predicted", "values", lambda p, v: p + 0.01 * v).alias("values")), i


def _model_query(name: str, model: str, digits: int = 6, pinned: bool = False, sql: str | None = None, **options):
    @query(name, sql)
    def run(spark, sf):
        c, i = _tissue(spark, sf)
        fits = (kinetics.pin_flow if pinned else fit_model)(c, i, model, keys=["voxel_id"], **options)
        return fits.select("voxel_id", *_r(*MODELS[model].outputs, digits=digits))


_model_query("k10_deconvolve", "deconvolve")
_model_query("k10_deconvolve_lcurve", "deconvolve", preset="legacy")
_model_query("k12_deconvolve_exact", "deconvolve", preset="matlab")
_model_query("k15_deconvolve_sd", "deconvolve", preset="bayes")
_model_query("k15_deconvolve_sampled", "deconvolve", digits=4, preset="bayes", samples=200)
_model_query("k19_gamma_transit", "gamma_transit", factor=10)
_model_query("k20_mittag_leffler", "mittag_leffler", sql=sql_parts.MITTAG_LEFFLER, factor=10)
_model_query("k21_inverse_gaussian", "inverse_gaussian", factor=10)
_model_query("k22_rate_spectrum", "rate_spectrum", digits=4)
_model_query("k23_transit_spectrum", "transit_spectrum", digits=4)
_model_query("k25_pin_flow", "mittag_leffler", pinned=True, factor=10)


@query("k14_outflow_cth")
def k14(spark, sf):
    """The spread by the outflow of a residue that the deconvolution finds, beside that by the residue's slope."""
    c, i = _tissue(spark, sf)
    a = fit_model(c, i, "deconvolve", keys=["voxel_id"], moments="central_volume").select("voxel_id", F.round("cth", 6).alias("cth_outflow"))
    b = fit_model(c, i, "deconvolve", keys=["voxel_id"], moments="residue_integral").select("voxel_id", F.round("cth", 6).alias("cth_slope"))
    return a.join(b, "voxel_id")


@query("k16_delay_groups")
def k16(spark, sf):
    c, i = _tissue(spark, sf)
    return fit_model(c.withColumn("delay", (F.col("voxel_id") % 4) * 0.6), i, "deconvolve", keys=["voxel_id"]).select("voxel_id", *_r("cbf", "cbv", "mtt"))


_TOFTS_SQL = f"""with recursive {LONG}, {INPUT}, g as (select i, pow(10, -4 + i * (log10(2) + 4) / 399) as k from (select unnest(range(400)) as i)),
b as (select 0 as frame, i, k, 0.0::double as b from g union all
    select b.frame + 1, i, k, b.b * exp(-k * (n.t - o.t)) + 0.5 * (n.t - o.t) * (o.c_a * exp(-k * (n.t - o.t)) + n.c_a) from b join ca o on o.frame = b.frame join ca n on n.frame = b.frame + 1),
q as (select i, any_value(k) as k, sum(b * b) + 1e-12 as bb, sum(b * c_a) as ab from b join ca using (frame) group by i), aa as (select sum(c_a * c_a) + 1e-12 as aa from ca),
y as (select voxel_id, sum(v * c_a) as ya, sum(v * v) as yy from c join ca using (frame) group by voxel_id), yb as (select voxel_id, i, sum(v * b) as yb from c join b using (frame) group by voxel_id, i),
s as (select voxel_id, i, k, (yb * aa - ya * ab) / (aa * bb - ab * ab) as kt, (ya * bb - yb * ab) / (aa * bb - ab * ab) as vp, yb, ya, yy from yb join y using (voxel_id) join q using (i), aa),
t as (select voxel_id, arg_min((k, kt, vp), yy - kt * yb - vp * ya) as r from s group by voxel_id)
select voxel_id, round(least(greatest(r[2], 0), 0.25) * 6000, 3) as ktrans, round(least(greatest(least(greatest(r[2], 0), 0.25) / r[1], 0), 1), 4) as ve, round(least(greatest(r[3], 0), 1), 4) as vp, round(r[1] * 60, 4) as kep from t"""


@query("k17_extended_tofts", _TOFTS_SQL)
def k17(spark, sf):
    c = _curves(spark, sf)
    return fit_model(c, C.input_curve(c), "extended_tofts", keys=["voxel_id"]).select("voxel_id", *_r("ktrans", digits=3), *_r("ve", "vp", "kep", digits=4))


@query(
    "k18_tofts_predict",
    f"""with recursive {LONG}, {INPUT}, f as (select vec_id as voxel_id, 60 + vec_id % 50 as kt, 0.2 as ve, 0.05 as vp from embeddings),
b as (select voxel_id, 0 as frame, 0.0::double as b from f union all
    select b.voxel_id, b.frame + 1, b.b * exp(-kt / 6000 / ve * (n.t - o.t)) + 0.5 * (n.t - o.t) * (o.c_a * exp(-kt / 6000 / ve * (n.t - o.t)) + n.c_a) from b join f using (voxel_id) join ca o on o.frame = b.frame join ca n on n.frame = b.frame + 1)
select voxel_id, frame, round(kt / 6000 * b + vp * c_a, 6) as value from b join f using (voxel_id) join ca using (frame)""",
)
def k18(spark, sf):
    c = _curves(spark, sf)
    fits = c.select("voxel_id", (60 + F.col("voxel_id") % 50).cast("double").alias("ktrans"), F.lit(0.2).alias("ve"), F.lit(0.05).alias("vp"))
    return _long_out(kinetics.tofts_predict(fits, C.input_curve(c), keys=["voxel_id"]), "predicted")


@query("k24_fit_by_parcel_pinned")
def k24p(spark, sf):
    c, i = _tissue(spark, sf)
    flow = fit_model(c, i, "deconvolve", keys=["voxel_id"]).select("voxel_id", F.col("cbf").alias("flow"))
    return kinetics.fit_by_label(c.join(flow, "voxel_id"), i, keys=["voxel_id"], model="inverse_gaussian", flow="flow", factor=10).select("voxel_id", "label", *_r("cbf", "mtt", "cth"))


# Preprocessing


@query("b04_baseline_gradient", sql_parts.BASELINE_GRADIENT)
def b04(spark, sf):
    return filters.baseline_gradient(_curves(spark, sf).select("voxel_id", "values")).select("voxel_id", "nbf")


@query("b05_baseline_fixed", "select vec_id as voxel_id, 3 as nbf from embeddings")
def b05(spark, sf):
    return preprocess.baseline_frames(_curves(spark, sf), method="fixed", fallback=2).select("voxel_id", "nbf")


@query("b08_onset_gradient", sql_parts.ONSET_GRADIENT)
def b08(spark, sf):
    return filters.onset_gradient(_curves(spark, sf).select("voxel_id", "values")).select("voxel_id", "onset")


@query("b12_norm_identity", f"with {LONG} select voxel_id, frame, round(v, 6) as value from c")
def b12(spark, sf):
    return _long_out(preprocess.norm_identity(_curves(spark, sf)), "values")


@query("b14_norm_legacy_shift", sql_parts.LEGACY_SHIFT)
def b14(spark, sf):
    return _long_out(filters.norm_legacy_shift(_curves(spark, sf).select("voxel_id", "values")), "values")


@query("b16_align_lengths", f"with {LONG} select voxel_id, count(*)::int as n, round(sum(v), 6) as total from c where frame < 60 - voxel_id % 3 group by voxel_id")
def b16(spark, sf):
    c = _curves(spark, sf).withColumn("other", F.slice("signal", F.lit(1), (60 - F.col("voxel_id") % 3).cast("int")))
    cut = c.withColumns(preprocess.align_lengths("values", "other"))
    return cut.select("voxel_id", F.size("values").alias("n"), F.round(A.total(F.col("values")), 6).alias("total"))


@query(
    "b18_find_top_peaks",
    f"""with {LONG}, p as (select voxel_id, frame, v from c where v > 0), f as (select voxel_id, arg_max(frame, (v, -frame)) as f0 from p group by voxel_id), g as (select voxel_id, arg_max(p.frame, (p.v, -p.frame)) as f1 from p join f using (voxel_id) where abs(p.frame - f0) > 10 group by voxel_id)
select e.vec_id as voxel_id, case when f0 is null then '' when f1 is null then f0::varchar else least(f0, f1) || ',' || greatest(f0, f1) end as frames from embeddings e left join f on f.voxel_id = e.vec_id left join g on g.voxel_id = e.vec_id""",
)
def b18(spark, sf):
    return _curves(spark, sf).select("voxel_id", F.array_join(aif.find_top_peaks(F.col("values")).cast("array<string>"), ",").alias("frames"))


@query("b20_align_to_reference", sql_parts.ALIGNED)
def b20(spark, sf):
    c = _curves(spark, sf)
    pairs = c.select("voxel_id", F.col("values").alias("vein")).join(c.select((F.col("voxel_id") + 1).alias("voxel_id"), F.col("values").alias("artery")), "voxel_id")
    return aif.align_to_reference(pairs, dt=C.DT, rescale=True).select("voxel_id", *_r("shift_s", "scale"), F.round(A.total(F.col("aligned")), 6).alias("total"))


def _detrend_query(mode: str, sql: str | None):
    @query(f"b25_detrend_{mode.replace('-', '_')}", sql)
    def run(spark, sf):
        c = _curves(spark, sf)
        return _long_out(preprocess.detrend(c, C.input_curve(c), keys=["voxel_id"], mode=mode), "values")


_SLOPE = f"with {LONG}, {INPUT}, s as (select regr_slope(c_a, t) as k, avg(c_a) as late from ca where frame >= 44)"
_detrend_query("aif", f"{_SLOPE} select voxel_id, frame, round(v - k * frame * 2.463, 6) as value from c, s")
_detrend_query("auto", f"{_SLOPE} select voxel_id, frame, round(v - case when abs(k / late) >= 5e-4 then k else 0 end * frame * 2.463, 6) as value from c, s")
_RIGID = f"with {LONG}, {INPUT}, {sql_parts.RIGID}"
_detrend_query("rigid", f"{_RIGID} select voxel_id, frame, round(v - k * frame * 2.463, 6) as value from c, s")
_detrend_query("rigid-auto", f"{_RIGID} select voxel_id, frame, round(v - case when abs(k / late) >= 5e-4 then k else 0 end * frame * 2.463, 6) as value from c, s")


# Conversion


@query(
    "c05_conc_spgr_bounded",
    f"""with {LONG}, k as (select cos(radians(15)) as ca), s as (select voxel_id, frame, 1000 / t1_ms as r10, 100 * (1 + v) as s from c), base as (select voxel_id, median(s) as s0 from s where frame >= 2 and frame < 10 group by voxel_id),
g as (select voxel_id, frame, r10, ca, least(greatest(s / s0 * (1 - exp(-0.005 * r10)) / (1 - ca * exp(-0.005 * r10)), (1 - exp(-0.005 * 0.033)) / (1 - ca * exp(-0.005 * 0.033))), (1 - exp(-0.005 * 30)) / (1 - ca * exp(-0.005 * 30))) as g from s join base using (voxel_id), k),
r as (select voxel_id, frame, (-ln((1 - g) / (1 - ca * g)) / 0.005 - r10) / 4 as c from g), b as (select voxel_id, avg(c) as base from r where frame >= 2 and frame < 10 group by voxel_id)
select voxel_id, frame, round(c - base, 5) as value from r join b using (voxel_id)""",
)
def c05(spark, sf):
    return _long_out(concentration.spgr_bounded(_curves(spark, sf), flip_deg=15, tr_s=0.005), "conc", 5)


@query(
    "c06_conc_fixed_prior",
    f"""with {LONG}, e as (select voxel_id, frame, m0 * sin(radians(15)) as top, 100 * (1 + v) as s from c)
select voxel_id, frame, round((-ln(least(greatest((top - s) / (top - s * cos(radians(15))), 1e-9), 1 - 1e-9)) / 0.005 - 1000 / 1650.0) / 4 / 0.58, 6) as value from e""",
)
def c06(spark, sf):
    return _long_out(concentration.fixed_prior(_curves(spark, sf), concentration.vfa_spgr, blood_t1_ms=1650, hematocrit=0.42, flip_deg=15, tr_s=0.005), "conc")


@query("c08_acquisition_params", "select p_partkey as scan_id, coalesce(case when p_size % 3 = 0 then 0.01 end, case when p_size % 2 = 0 then p_size / 1000.0 end, 0.005)::double as tr_s from part")
def c08(spark, sf):
    p = spark.read.parquet(f"{sf}/part.parquet")
    given, stored = F.when(F.col("p_size") % 3 == 0, 0.01), F.when(F.col("p_size") % 2 == 0, F.col("p_size") / 1000)
    return p.select(F.col("p_partkey").alias("scan_id"), concentration.acquisition(given, stored, F.lit(0.005)).alias("tr_s"))


# Relaxometry

_GRID = "g as (select i, 100 * pow(60, i / {last}.0) as t1 from (select unnest(range({n})) as i))"
_REFINE = """w as (select voxel_id, arg_min(i, (sse::float, i)) as i from s group by voxel_id),
m as (select w.voxel_id, w.i, case when w.i between 1 and {n} - 2 and l.sse - 2 * s.sse + r.sse <> 0 then least(greatest(0.5 * (l.sse - r.sse) / (l.sse - 2 * s.sse + r.sse), -0.5), 0.5) else 0 end as move
    from w join s on s.voxel_id = w.voxel_id and s.i = w.i left join s l on l.voxel_id = w.voxel_id and l.i = w.i - 1 left join s r on r.voxel_id = w.voxel_id and r.i = w.i + 1),
f as (select voxel_id, 100 * pow(60, (i + move) / {last}.0) as t1 from m)"""
_TI = "ti as (select unnest(range(7)) as frame, unnest([0.12, 0.3, 0.6, 1, 2, 4, 10])::double as ti)"


@query(
    "t01_fit_recovery",
    f"""with {LONG}, {_TI}, {_GRID.format(last=199, n=200)}, y as (select voxel_id, ti, 100 * (1 + v) as y from c join ti using (frame)),
s as (select voxel_id, i, regr_syy(y, exp(-1000 * ti / t1)) - power(regr_sxy(y, exp(-1000 * ti / t1)), 2) / regr_sxx(y, exp(-1000 * ti / t1)) as sse from y, g group by voxel_id, i), {_REFINE.format(last=199, n=200)}
select voxel_id, round(t1, 1) as t1_ms, round(regr_intercept(y, exp(-1000 * ti / t1)), 2) as m0 from f join y using (voxel_id) group by voxel_id, t1""",
)
def t01(spark, sf):
    c = _curves(spark, sf).select("voxel_id", F.slice("signal", F.lit(1), F.lit(7)).alias("values"))
    return relaxometry.fit_recovery(c, [0.12, 0.3, 0.6, 1, 2, 4, 10], keys=["voxel_id"]).select("voxel_id", F.round("t1_ms", 1).alias("t1_ms"), F.round("m0", 2).alias("m0"))


@query(
    "t02_fit_recovery_turbo",
    f"""with {LONG}, {_TI}, {_GRID.format(last=239, n=240)}, y as (select voxel_id, ti, 100 * (1 + v) as y from c join ti using (frame)),
q as (select voxel_id, i, sum(y * (1 - exp(-1000 * ti / t1)) * 0.5) as yg, sum(power((1 - exp(-1000 * ti / t1)) * 0.5, 2)) as gg, sum(y * y) as yy from y, g group by voxel_id, i),
s as (select voxel_id, i, yy - 2 * greatest(yg / gg, 0) * yg + power(greatest(yg / gg, 0), 2) * gg as sse from q), {_REFINE.format(last=239, n=240)}
select voxel_id, round(t1, 1) as t1_ms, round(greatest(sum(y * (1 - exp(-1000 * ti / t1)) * 0.5) / sum(power((1 - exp(-1000 * ti / t1)) * 0.5, 2)), 0), 2) as m0 from f join y using (voxel_id) group by voxel_id, t1""",
)
def t02(spark, sf):
    c = _curves(spark, sf).select("voxel_id", F.slice("signal", F.lit(1), F.lit(7)).alias("values"))
    return relaxometry.fit_recovery_turbo(c, [0.12, 0.3, 0.6, 1, 2, 4, 10], keys=["voxel_id"]).select("voxel_id", F.round("t1_ms", 1).alias("t1_ms"), F.round("m0", 2).alias("m0"))


@query(
    "t05_resolve_axis",
    "select p_partkey as series, case when p_size % 4 < 3 then 2 else 15 end as first_s from part",
)
def t05(spark, sf):
    p = spark.read.parquet(f"{sf}/part.parquet")
    axis = F.when(F.col("p_size") % 4 == 1, F.array(F.lit(0.0), F.lit(1.0), F.lit(2.0))).when(F.col("p_size") % 4 == 2, F.array(F.lit(7.0), F.lit(7.0), F.lit(7.0))).when(F.col("p_size") % 4 == 3, F.array(F.lit(15.0), F.lit(3.0), F.lit(9.0)))
    series = p.select(F.col("p_partkey").alias("series"), axis.alias("axis"), F.array(*[F.col("p_retailprice").cast("double")] * 3).alias("values"))
    return relaxometry.resolve_axis(series, [2, 5, 10]).select("series", F.get("axis", F.lit(0)).cast("int").alias("first_s"))


# Sources


@query("s04_read_input_curve", f"with {LONG}, {INPUT} select frame, round(c_a, 9) as c_a from ca where frame < 50")
def s04(spark, sf):
    i = C.input_curve(_curves(spark, sf)).withColumn("t_s", F.slice("t_s", F.lit(1), F.lit(50)))
    return headers.read_input_curve(i).select(F.posexplode("c_a").alias("frame", "c_a")).select("frame", F.round("c_a", 9).alias("c_a"))


@query("s06_read_parcellation", "select s_suppkey as voxel_id, case when s_nationkey < 12 then s_nationkey else 0 end as label, coalesce(n_name, 'label_' || case when s_nationkey < 12 then s_nationkey else 0 end) as name from supplier left join nation on n_nationkey = case when s_nationkey < 12 then s_nationkey else 0 end and n_nationkey % 2 = 1")
def s06(spark, sf):
    s = spark.read.parquet(f"{sf}/supplier.parquet").select(F.col("s_suppkey").alias("voxel_id"), F.col("s_nationkey").cast("int").alias("label"))
    names = spark.read.parquet(f"{sf}/nation.parquet").where("n_nationkey % 2 = 1").select(F.col("n_nationkey").cast("int").alias("label"), F.col("n_name").alias("name"))
    return headers.read_parcellation(s, names, include=list(range(12))).select("voxel_id", "label", "name")


@query(
    "s09_assemble_flip_series",
    """with r as (select l_suppkey as subject_id, l_partkey as voxel_id, [3, 9, 15, 24][l_linenumber % 4 + 1] as deg, l_returnflag as geom, l_quantity::double as v, 'scan_' || l_orderkey as name from lineitem),
g as (select subject_id, arg_min(geom, (deg, name)) as geom from r group by subject_id), f as (select subject_id, voxel_id, deg, arg_min(v, name) as v from r semi join g using (subject_id, geom) group by subject_id, voxel_id, deg)
select subject_id, voxel_id, string_agg(deg::varchar, ',' order by deg) as angles, round(sum(v), 6) as total from f group by subject_id, voxel_id having count(*) >= 2""",
)
def s09(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    deg = F.element_at(F.array(*[F.lit(x) for x in (3, 9, 15, 24)]), (F.col("l_linenumber") % 4 + 1).cast("int"))
    scans = li.select(F.col("l_suppkey").alias("subject_id"), F.col("l_partkey").alias("voxel_id"), deg.alias("flip_deg"), F.col("l_returnflag").alias("geom"), F.col("l_quantity").cast("double").alias("value"), F.concat(F.lit("scan_"), F.col("l_orderkey")).alias("name"))
    out = cohort.assemble_flip_series(scans)
    return out.select("subject_id", "voxel_id", F.array_join(F.col("axis_deg").cast("array<string>"), ",").alias("angles"), F.round(A.total(F.col("values")), 6).alias("total"))


# Cohort


@query("r01_mask_otsu", f"with p as (select list_max(embedding)::double as mean, vec_id from embeddings), {OTSU} select vec_id as voxel_id, (mean > edge)::int as label from p, edge")
def r01(spark, sf):
    return labels.mask_otsu(_maps(spark, sf)).select("voxel_id", "label")


@query(
    "j01_run_cohort",
    f"""with {COHORT}, {REGION_SQL}, s as (select subject_id, voxel_id, label, frame, 1000 / t1_ms as r10, 100 * (1 + v) as s from c), base as (select subject_id, voxel_id, median(s) as s0 from s where frame >= 2 and frame < 10 group by all),
g as (select subject_id, voxel_id, label, frame, r10, s / s0 * (1 - exp(-0.005 * r10)) / (1 - cos(radians(15)) * exp(-0.005 * r10)) as g from s join base using (subject_id, voxel_id)),
raw as (select subject_id, voxel_id, label, frame, (-ln(least(greatest((1 - g) / (1 - cos(radians(15)) * g), 1e-6), 1 - 1e-9)) / 0.005 - r10) / 4 as k from g),
b as (select subject_id, voxel_id, avg(k) as base from raw where frame >= 2 and frame < 10 group by all), q as (select subject_id, voxel_id, label, frame, least(greatest(k - base, -20), 20) as v from raw join b using (subject_id, voxel_id)),
pk as (select subject_id, voxel_id, max(v) filter (frame >= 5) - avg(v) filter (frame < 5) as peak from q group by all), top as (select * from (select *, row_number() over (partition by subject_id order by peak desc, voxel_id) as r from pk) where r <= 32),
ca as (select subject_id, frame, avg(v) as c_a, frame * 2.463 as t from q semi join top using (subject_id, voxel_id) group by subject_id, frame),
co as (select subject_id, frame, c_a, coalesce(sum(area) over (partition by subject_id order by frame rows between unbounded preceding and 1 preceding), 0) / c_a as x from (select *, c_a * (lead(t) over (partition by subject_id order by frame) - t) as area from ca)),
p as (select q.subject_id, voxel_id, label, co.x, q.v / co.c_a as y from q join co using (subject_id, frame) where co.x >= (select max(x) from co o where o.subject_id = q.subject_id) / 3),
f as (select subject_id, voxel_id, label, case when regr_count(y, x) >= 2 and regr_sxx(y, x) > 0 then regr_slope(y, x) * 6000 end as ki from p group by all)
select subject_id, region, round(avg(ki), 4) as mean, round(median(ki), 4) as median, count(ki) as n from (select * from (select distinct subject_id from c), region_map) left join f using (subject_id, label) group by subject_id, region""",
)
def j01(spark, sf):
    return _run(spark, sf, _cohort(spark, sf)).maps.where("map = 'ki'").select("subject_id", "region", *_r("mean", "median", digits=4), "n")


def _run(spark, sf, c, lost: str | None = None):
    """The cohort's run; the subject ``lost`` has a time axis without numbers."""
    at = lambda v, i: F.when(F.col("subject_id").eqNullSafe(F.lit(lost)), F.lit(None)).otherwise(i * F.lit(C.DT))
    c = c.withColumn("t_s", F.transform("values", at))
    curves = c.select("subject_id", "voxel_id", "signal", "t_s")
    return cohort.run_cohort(curves, c.select("subject_id", "voxel_id", "t1_ms", "m0"), c.select("subject_id", "voxel_id", "label"), _region_map(spark), flip_deg=15, tr_s=0.005, models=["patlak", "deconvolve"])


@query(
    "j01_cohort_report",
    f"""with {COHORT}, v as (select distinct subject_id, voxel_id from c where v is not null), m as (select unnest(['patlak', 'deconvolve']) as model)
select subject_id, model, case when subject_id = 's1' then 'failed' else 'ok' end as status, count(*) as n_curves, case when subject_id = 's1' then count(*) else 0 end as n_failed,
    case when subject_id = 's1' then 'the input curve has no numbers' end as error from v, m group by subject_id, model""",
)
def j01r(spark, sf):
    """One subject's time axis is lost: its models fail, with a reason, and the others' don't."""
    return _run(spark, sf, _cohort(spark, sf), lost="s1").report


@query(
    "d06_track_density_cohort",
    "select 's' || l_orderkey % 3 as subject_id, (l_partkey % 32)::int as x, (l_partkey // 32)::int as y, (l_linenumber % 2)::int as z, count(distinct l_orderkey) as density from lineitem group by all",
)
def d06c(spark, sf):
    return diffusion.track_density(_cohort_streamlines(spark, sf))


@query(
    "d07_streamline_filter_cohort",
    """with p as (select l_orderkey as sid, (l_partkey % 32)::double as x, (l_partkey // 32)::double as y, (l_linenumber % 2)::double as z, (l_linenumber, l_partkey, l_suppkey) as i from lineitem),
d as (select sid, sqrt(power(x - lag(x) over w, 2) + power(y - lag(y) over w, 2) + power(z - lag(z) over w, 2)) as d from p window w as (partition by sid order by i)),
l as (select 's' || sid % 3 as subject_id, sid, round(coalesce(sum(d), 0), 6) as length from d group by sid having coalesce(sum(d), 0) >= 20)
select subject_id, sid, length from (select *, row_number() over (partition by subject_id order by sid) as r from l) where r <= 100""",
)
def d07c(spark, sf):
    return diffusion.streamline_filter(_cohort_streamlines(spark, sf), least_length=20.0, most=100).select("subject_id", "sid", *_r("length"))


_COHORT_EDGES = f"""with {COHORT}, p as (select 's' || l_orderkey % 3 as subject_id, l_orderkey as sid, l_partkey % 32 as x, l_partkey // 32 as y, l_linenumber % 2 as z,
    row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey) as a, row_number() over (partition by l_orderkey order by l_linenumber desc, l_partkey desc, l_suppkey desc) as b from lineitem),
v as (select distinct subject_id, voxel_id // 2 % 32 as x, voxel_id // 64 as y, voxel_id % 2 as z, label from c where label > 1),
e as (select a.subject_id, least(s.label, t.label) as src_label, greatest(s.label, t.label) as dst_label, count(*) as n from p a join p b using (sid) join v s on (s.subject_id, s.x, s.y, s.z) = (a.subject_id, a.x, a.y, a.z)
    join v t on (t.subject_id, t.x, t.y, t.z) = (b.subject_id, b.x, b.y, b.z) where a.a = 1 and b.b = 1 group by all)"""


@query("d08_connectome_cohort", f"{_COHORT_EDGES} select * from e")
def d08c(spark, sf):
    v = F.col("voxel_id")
    place = [(F.floor(v / 2) % 32).cast("int").alias("x"), F.floor(v / 64).cast("int").alias("y"), (v % 2).cast("int").alias("z")]
    parcels = _cohort(spark, sf).select("subject_id", *place, F.when(F.col("label") > 1, F.col("label")).otherwise(0).alias("label"))
    return diffusion.connectome(_cohort_streamlines(spark, sf), parcels)


@query(
    "d09_connectome_groups_cohort",
    f"""{_COHORT_EDGES}, g as (select n_nationkey as label, n_name as name from nation where n_nationkey >= 3)
select subject_id, least(a.name, b.name) as src_group, greatest(a.name, b.name) as dst_group, sum(n)::bigint as n from e join g a on a.label = src_label join g b on b.label = dst_label group by all""",
)
def d09c(spark, sf):
    groups = spark.read.parquet(f"{sf}/nation.parquet").select(F.col("n_nationkey").alias("label"), F.col("n_name").alias("name"))
    return diffusion.connectome_groups(d08c(spark, sf), groups, skip=groups.where("label < 3").select("label"))


def _cohort_streamlines(spark, sf):
    return _streamlines(spark, sf).withColumn("subject_id", F.concat(F.lit("s"), (F.col("sid") % 3).cast("string")))


@query(
    "a06_select_slices_cohort",
    f"""with {COHORT}, s as (select subject_id, y as slice, frame, avg(v) as score from c group by all), b as (select subject_id, slice, max(score) as score, arg_max(frame, (score, -frame)) as frame from s group by all),
l as (select *, case when score >= 0.2 then 0 when score >= 0.1 then 1 when score >= 0.05 then 2 else 3 end as level from b)
select subject_id, slice, frame, round(score, 6) as score, rank from (select *, row_number() over (partition by subject_id order by score desc, slice) as rank from l where level <= (select min(level) from l o where o.subject_id = l.subject_id) and score > 0) where rank <= 3""",
)
def a06c(spark, sf):
    long = C.to_long(_cohort(spark, sf).withColumn("slice", F.col("y")), "subject_id", "slice")
    scores = long.groupBy("subject_id", "slice", "frame").agg(F.avg("value").alias("score"))
    return aif.select_slices(scores, thresholds=[0.2, 0.1, 0.05]).select("subject_id", "slice", "frame", *_r("score"), "rank")


def _affine(turn: float, shear: float, offset: tuple[float, float, float], size: float) -> list[list[float]]:
    """Index to world: turned about z, sheared along x, scaled and moved."""
    c, s = math.cos(turn), math.sin(turn)
    return [[size * c, size * (shear * c - s), 0.0, offset[0]], [size * s, size * (shear * s + c), 0.1 * size, offset[1]], [0.0, 0.05, size, offset[2]]]


#: Pairs of affines, target and source, of the cohort's subjects.
_PAIRS = {f"s{k}": (_affine(0.1 * k, 0.05 * k, (0.3 + k / 7, -0.7, 0.21), 1.1), _affine(-0.2 + 0.1 * k, 0.1, (0.11, 0.17 * k, -0.13), 1.3)) for k in range(3)}


def _index_map(target: list[list[float]], source: list[list[float]]) -> list[list[float]]:
    t, s = (np.vstack([m, [0, 0, 0, 1]]) for m in (target, source))
    return (np.linalg.inv(s) @ t)[:3].tolist()


_MAPS_SQL = "a(subject_id, " + ", ".join(f"m{i}{j}" for i in range(3) for j in range(4)) + ") as (values " + ", ".join(f"('{k}', " + ", ".join(f"{v!r}::double" for r in _index_map(*pair) for v in r) + ")" for k, pair in _PAIRS.items()) + ")"
_PLACES_SQL = ", ".join(f"x * m{i}0 + y * m{i}1 + z * m{i}2 + m{i}3 as {a}" for i, a in enumerate("pqr"))


def _affines(spark):
    return spark.createDataFrame([(k, *v) for k, v in _PAIRS.items()], "subject_id string, target array<array<double>>, source array<array<double>>")


@query(
    "r07_resample_nearest_affine",
    f"""with {COHORT}, {_MAPS_SQL}, v as (select distinct subject_id, voxel_id, x, y, z, label from c), t as (select subject_id, voxel_id, {_PLACES_SQL} from v join a using (subject_id))
select t.subject_id, t.voxel_id, coalesce(v.label, 0) as label from t left join v on v.subject_id = t.subject_id and v.x = round_even(p, 0) and v.y = round_even(q, 0) and v.z = round_even(r, 0)""",
)
def r07a(spark, sf):
    c = _cohort(spark, sf)
    return labels.resample_nearest(c, c, _affines(spark))


@query(
    "r08_resample_linear_affine",
    f"""with {COHORT}, {_MAPS_SQL}, v as (select subject_id, voxel_id, x, y, z, max(v) as value from c group by all), t as (select subject_id, voxel_id, {_PLACES_SQL} from v join a using (subject_id)),
k as (select subject_id, voxel_id, floor(p) + dx as x, floor(q) + dy as y, floor(r) + dz as z, (case dx when 1 then p - floor(p) else 1 - p + floor(p) end) * (case dy when 1 then q - floor(q) else 1 - q + floor(q) end) * (case dz when 1 then r - floor(r) else 1 - r + floor(r) end) as w
    from t, (select unnest([0, 1]) as dx), (select unnest([0, 1]) as dy), (select unnest([0, 1]) as dz))
select k.subject_id, k.voxel_id, round(sum(w * coalesce(v.value, 0)), 6) as value from k left join v on (v.subject_id, v.x, v.y, v.z) = (k.subject_id, k.x, k.y, k.z) group by all""",
)
def r08a(spark, sf):
    c = _cohort(spark, sf).withColumn("value", F.array_max("values"))
    return labels.resample_linear(c, c, _affines(spark)).select("subject_id", "voxel_id", F.round("value", 6).alias("value"))


@query(
    "g05_region_fit",
    f"""with {LONG}, {REGION_SQL}, {INPUT}, {COORDS}, {sql_parts.REGION_CURVES}, q as (select region, n_slices, co.x, rc.v / co.c_a as y from rc join co using (frame) where co.x >= (select max(x) from co) / 3)
select region, n_slices, round(regr_slope(y, x) * 6000, 6) as ki, round(regr_intercept(y, x) * 100, 6) as vb from q group by region, n_slices""",
)
def g05f(spark, sf):
    c = _curves(spark, sf)
    return aggregate.region_curve_fit(c, _region_map(spark), C.input_curve(c)).select("region", "n_slices", *_r("ki", "vb"))


@query(
    "g02_agg_parcel_whole",
    "select l_suppkey as subject_id, 0 as label, round(avg(l_quantity::double), 6) as mean, round(median(l_quantity::double), 6) as median, count(*) as n from lineitem where l_suppkey % 2 = 0 group by 1 union all select l_suppkey, l_linenumber::int, round(avg(l_quantity::double), 6), round(median(l_quantity::double), 6), count(*) from lineitem where l_suppkey % 2 = 1 group by 1, 2",
)
def g02w(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    label = F.when(F.col("l_suppkey") % 2 == 1, F.col("l_linenumber").cast("int")).otherwise(0)
    maps = li.select(F.col("l_suppkey").alias("subject_id"), label.alias("label"), F.col("l_quantity").cast("double").alias("value"))
    return aggregate.by_label(maps, keys=["subject_id"]).select("subject_id", "label", *_r("mean", "median"), "n")


@query(
    "g04_all_levels",
    f"""with {REGION_SQL}, m as (select 's' || vec_id % 3 as subject_id, label + 1 as label, (vec_id // 48) % 16 as s, list_max(embedding)::double as v from embeddings),
u as (select subject_id, 'whole' as level, null as unit, v from m union all select subject_id, 'label', label::varchar, v from m union all select subject_id, 'region', region, v from m join region_map using (label)
    union all select subject_id, 'slice', s::varchar, v from m where s < 14),
f as (select subject_id, level, unit, avg(v) as mean, median(v) as median, coalesce(stddev_samp(v), 0) as sd, count(*) as n, quantile_cont(v, 0.05) as p5, quantile_cont(v, 0.25) as p25, quantile_cont(v, 0.75) as p75, quantile_cont(v, 0.95) as p95 from u group by all),
e as (select distinct subject_id, k.level, k.unit from m, (select 'region' as level, region as unit from region_map union select 'slice', unnest(range(14))::varchar) k)
select subject_id, level, unit, {", ".join(f"round({c}, 6) as {c}" for c in ("mean", "median", "sd"))}, n, {", ".join(f"round({c}, 6) as {c}" for c in ("p5", "p25", "p75", "p95"))}
from (select * from f union all select subject_id, level, unit, null, null, null, 0, null, null, null, null from e anti join f using (subject_id, level, unit))""",
)
def g04l(spark, sf):
    v = F.col("voxel_id")
    m = _maps(spark, sf).select(F.concat(F.lit("s"), (v % 3).cast("string")).alias("subject_id"), "label", (F.floor(v / 48) % 16).alias("slice"), "value")
    found = aggregate.by_levels(m, _region_map(spark), keys=["subject_id"], axis="slice", n_slices=14)
    return found.select("subject_id", "level", "unit", *_r("mean", "median", "sd"), "n", *_r("p5", "p25", "p75", "p95"))


# Vessels


@query("a04_roi_median", f"with {LONG} select label, frame, round(median(v), 9) as value from c where voxel_id % 3 < 2 group by label, frame")
def a04m(spark, sf):
    c = _curves(spark, sf)
    found = aif.curve_from_members(c, c.where("voxel_id % 3 < 2").select("voxel_id"), by=["label"], method="median")
    return found.select("label", F.posexplode("values").alias("frame", "value")).select("label", "frame", F.round("value", 9).alias("value"))


@query("a04_adaptive_max", f"with {LONG} select label, frame, round(max(v), 9) as value from c where voxel_id % 3 < 2 group by label, frame")
def a04a(spark, sf):
    c = _curves(spark, sf)
    found = aif.curve_from_members(c, c.where("voxel_id % 3 < 2").select("voxel_id"), by=["label"], method="adaptive_max")
    return found.select("label", F.posexplode("values").alias("frame", "value")).select("label", "frame", F.round("value", 9).alias("value"))


@query(
    "a04_max_voxel_ceiling",
    f"""with {LONG}, p as (select voxel_id, label, max(100 * (1 + v)) filter (frame >= 5) - avg(100 * (1 + v)) filter (frame < 5) as peak, max(v) as top from c group by voxel_id, label),
r as (select *, row_number() over (partition by label order by top <= 0.2 desc, case when top <= 0.2 then peak else -top end desc, voxel_id) as r from p)
select label, voxel_id, round(peak, 6) as peak, round(top, 6) as top from r where r = 1""",
)
def a04c(spark, sf):
    c = _curves(spark, sf).withColumnRenamed("values", "conc").withColumnRenamed("signal", "values")
    found = aif.max_voxel(c, by=["label"], conc="conc", ceiling=0.2)
    return found.select("label", "voxel_id", F.round("peak", 6).alias("peak"), F.round(F.array_max("values"), 6).alias("top"))


@query("a05_max_prior_over_roi", "select vec_id as voxel_id, label as roi, max((1000 + vec_id % 50)::double) over (partition by label) as m0 from embeddings where vec_id % 2 = 0")
def a05(spark, sf):
    c = _curves(spark, sf)
    members = c.where("voxel_id % 2 = 0").select("voxel_id", (F.col("label") - 1).alias("roi"))
    return aif.max_prior_over_roi(c.select("voxel_id", "m0"), members).select("voxel_id", "roi", "m0")


@query(
    "a07_auto_vessel",
    f"""with {LONG}, b as (select voxel_id, avg(100 * (1 + v)) filter (frame < 6) as base from c group by voxel_id), k as (select voxel_id from b where base > (select quantile_cont(base, 0.6) from b)),
d as (select voxel_id, frame, v from c semi join k using (voxel_id)), mc as (select frame, avg(v) as m from d group by frame), mx as (select max(m) as top from mc),
bt as (select least(case when top > 0 then coalesce((select min(frame) from mc where m > 0.2 * top), 0) else 6 end, 7)::int as bat from mx),
s as (select voxel_id, bat, max(v) filter (frame between bat and bat + 19) as peak, arg_max(frame, (v, -frame)) filter (frame between bat and bat + 19) as ttp, max(v) filter (frame >= bat + 20) as after, max(abs(v)) as top from d, bt group by voxel_id, bat),
w as (select s.voxel_id, coalesce(min(frame) filter (v <= peak / 2 and frame > ttp), 64) - coalesce(max(frame) filter (v <= peak / 2 and frame < ttp), -1) - 1 as n from s join d using (voxel_id) group by s.voxel_id),
g as (select s.*, greatest(n, 1) * 2.463 as fwhm, coalesce(after / greatest(peak, 1e-6), 0) as late from s join w using (voxel_id)),
f as (select *, peak > 0.05 and top < 0.95 * 19 and late <= 1.3 as g0, peak > 0.05 and late <= 1.3 as g1, peak > 0.05 as g2 from g),
n as (select count(*) filter (g0) as n0, count(*) filter (g1) as n1, count(*) filter (g2) as n2 from f),
c2 as (select f.*, case when n0 >= 15 then g0 when n1 >= 15 then g1 else g2 end as ok, case when n0 >= 15 then n0 when n1 >= 15 then n1 else n2 end as total from f, n),
r as (select voxel_id, row_number() over (order by peak / (greatest((ttp - bat + 1) * 2.463, 2.463) * greatest(fwhm, 2.463)) desc, voxel_id) as rank, greatest(least(floor(0.05 * greatest(total, 1)), 250), 15) as take from c2 where ok)
select voxel_id, rank from r where rank <= take""",
)
def a07(spark, sf):
    members, _ = aif.auto_vessel(_curves(spark, sf), dt=C.DT)
    return members.select("voxel_id", F.col("rank").cast("long").alias("rank"))


@query("a07_auto_vessel_curve")
def a07c(spark, sf):
    _, curve = aif.auto_vessel(_cohort(spark, sf), dt=C.DT, hematocrit=0.42)
    return curve.select("subject_id", F.posexplode("c_a").alias("frame", "value")).select("subject_id", "frame", F.round("value", 6).alias("value"))


@query("a08_pca_vessel")
def a08(spark, sf):
    members, _ = aif.pca_vessel(_cohort(spark, sf), n=10, percent=0.8)
    return members.select("subject_id", "voxel_id", F.col("rank").cast("long").alias("rank"), F.round("score", 6).alias("score"))


#: A mask of the cohort's voxels: a tube with what else has a label of 9 or more.
_MASK = "pow(x - 3.5, 2) + pow(y - 4, 2) <= 5 or label >= 9"


@query(
    "a08_mask_shell",
    f"""with {COHORT}, v as (select distinct subject_id, voxel_id, x, y, z, {_MASK} as m from c)
select a.subject_id, a.voxel_id, round(min(sqrt(pow((a.x - b.x) * 0.5, 2) + pow((a.y - b.y) * 0.5, 2) + pow((a.z - b.z) * 1.0, 2))) * case when a.m then -1 else 1 end, 6) as distance
from v a join v b on a.subject_id = b.subject_id and a.m <> b.m and pow((a.x - b.x) * 0.5, 2) + pow((a.y - b.y) * 0.5, 2) + pow((a.z - b.z) * 1.0, 2) <= 1.44 group by a.subject_id, a.voxel_id, a.m""",
)
def a08s(spark, sf):
    c = _cohort(spark, sf)
    return labels.mask_shell(c, c.where(_MASK), limit=1.2, mm=(0.5, 0.5, 1.0)).select("subject_id", "voxel_id", *_r("distance"))


@query("a08_pca_vessel_shell")
def a08p(spark, sf):
    c = _cohort(spark, sf)
    members, _ = aif.pca_vessel(c, n=10, percent=0.8, mask=c.where(_MASK), shell_mm=0.5, voxel_mm=(0.5, 0.5, 1.0))
    return members.select("subject_id", "voxel_id", F.col("rank").cast("long").alias("rank"), F.round("score", 6).alias("score"))


def _vessels(spark, sf):
    v = aif.vesselness(_cohort(spark, sf), by=[], percent=0.5)
    return v, aif.vessel_candidates(v, percent=0.3, least=3)


_CANDIDATES = f"""{COHORT}, b as (select subject_id, voxel_id, avg(v) as m from c where frame < 5 group by all),
p as (select c.subject_id, c.voxel_id, c.x, c.y, c.z, max(v - m) filter (frame < 32) as e, max(v - m) filter (frame >= 32) as l, max(v - m) as p, max(v) filter (frame >= 5) - avg(v) filter (frame < 5) as peak from c join b using (subject_id, voxel_id) group by all),
q as (select subject_id, quantile_cont(p, 0.5) as lim from p group by subject_id), s as (select p.*, case when p > lim and p > 0 then e / greatest(l, 0.05 * p) else 0 end as score from p join q using (subject_id)),
t as (select subject_id, greatest(quantile_cont(score, 0.3), 1e-6) as lim from s where score > 0 group by subject_id), h as (select s.* from s join t using (subject_id) where score >= t.lim),
n as (select a.subject_id, a.voxel_id as a, o.voxel_id as b from h a join h o on a.subject_id = o.subject_id and abs(a.x - o.x) + abs(a.y - o.y) + abs(a.z - o.z) = 1),
r as (select subject_id, voxel_id, voxel_id as root from h union select n.subject_id, n.b, r.root from r join n on n.subject_id = r.subject_id and n.a = r.voxel_id),
k as (select subject_id, voxel_id, min(root) as component from r group by all)"""


@query(
    "a16_vessel_candidates",
    f"""with recursive {_CANDIDATES} select subject_id, component, count(*) as n_voxels, round(avg(x), 6) as x, round(avg(y), 6) as y, round(avg(z), 6) as z, arg_max(voxel_id, (peak, -voxel_id)) as voxel_id
from k join h using (subject_id, voxel_id) group by subject_id, component having count(*) >= 3""",
)
def a16(spark, sf):
    return _vessels(spark, sf)[1].select("subject_id", "component", "n_voxels", "voxel_id", *_r("x", "y", "z"))


@query("a17_label_vessels", f"with recursive {_CANDIDATES}, {sql_parts.ROLES}")
def a17(spark, sf):
    v, found = _vessels(spark, sf)
    projection = aif.max_projection(v).select("subject_id", "voxel_id", "x", "y", "z", "projection")
    return aif.label_vessels(found.withColumn("kind", F.lit("vessel")), projection, n_slices=4).select("subject_id", "component", "role", "n_voxels", *_r("role_score"))


@query("a19_grow_region")
def a19(spark, sf):
    peaks = _cohort(spark, sf).select("subject_id", "voxel_id", "x", "y", "z", F.array_max("values").alias("value"))
    return aif.grow_region(peaks, peaks.where("voxel_id between 10 and 14").select("subject_id", "voxel_id"), margin=2)


@query(
    "a19_grow_box",
    """with recursive m as (select vec_id as voxel_id, vec_id % 16 as x, (vec_id // 16) % 16 as y, vec_id // 256 as z, list_max(embedding)::double as v from embeddings where vec_id % 16 between 2 and 12 and (vec_id // 16) % 16 between 2 and 12),
t as (select max(v) as top, arg_max(voxel_id, (v, -voxel_id)) as seed from m), h as (select m.* from m, t where v >= 0.8 * top),
r as (select seed as voxel_id from t union select b.voxel_id from r join h a on a.voxel_id = r.voxel_id join h b on abs(a.x - b.x) + abs(a.y - b.y) + abs(a.z - b.z) = 1) select voxel_id from r""",
)
def a19b(spark, sf):
    return aif.grow_box(_maps(spark, sf), {"x": (2, 12), "y": (2, 12)}, share=0.8)


@query(
    "a22_input_saturation",
    f"""with s as (select vec_id as voxel_id, (1 - cos(radians(15)) * exp(-5.0 / (800 + 10 * (vec_id % 100)))) / (1 - exp(-5.0 / (800 + 10 * (vec_id % 100)))) as c, list_median(list_transform(embedding[1:5], lambda v: 100 * (1 + v::double))) as s0,
    list_max(list_transform(embedding, lambda v: 100 * (1 + v::double))) as top from embeddings)
select round(avg((top / s0 > 1.3)::int), 6) as share_over from s where voxel_id % 4 = 0 and s0 > 0""",
)
def a22(spark, sf):
    c = _curves(spark, sf)
    ceiling = c.limit(1).select(F.lit(1.3).alias("ceiling"))
    return aif.input_saturation(c, c.where("voxel_id % 4 = 0").select("voxel_id"), ceiling).select(*_r("share_over"))


@query("a22_clipped_share", f"with {LONG}, s as (select voxel_id, max(v) as hi, max(v) - min(v) as span from c group by voxel_id) select voxel_id, round(avg((v >= hi - 0.001 * span)::int), 6) as share from c join s using (voxel_id) group by voxel_id")
def a22c(spark, sf):
    return _curves(spark, sf).select("voxel_id", F.round(aif.clipped_share(F.col("values")), 6).alias("share"))


# Regions


@query(
    "r09_hyperintensity_region",
    """with f as (select l_partkey as x, l_linenumber::int as y, (ascii(l_returnflag) % 3)::int as z, max(l_extendedprice::double) as v from lineitem group by 1, 2, 3), m as (select median(v) as m from f), d as (select f.*, m, abs(v - m) as d from f, m),
s as (select 1.4826 * median(d) + 1e-6 as s from d), h as (select x, y, z from d, s where (v - m) / s > -0.5 and (v - m) / s < 12), st as (select unnest([1, -1, 0, 0, 0, 0]) as dx, unnest([0, 0, 1, -1, 0, 0]) as dy, unnest([0, 0, 0, 0, 1, -1]) as dz),
e as (select h.x, h.y, h.z from h, st, h n where n.x = h.x + dx and n.y = h.y + dy and n.z = h.z + dz group by all having count(*) = 6), o as (select x, y, z from e union select x + dx, y + dy, z + dz from e, st),
k as (select p_partkey as voxel_id, p_partkey as x, (p_size % 8)::int as y, (p_partkey % 3)::int as z, (p_size % 4)::int as label from part)
select voxel_id, case when label > 0 and o.x is not null then 9000 else label end::int as label from k left join o using (x, y, z)""",
)
def r09(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    fine = li.groupBy(F.col("l_partkey").alias("x"), F.col("l_linenumber").cast("int").alias("y"), (F.ascii("l_returnflag") % 3).cast("int").alias("z")).agg(F.max(F.col("l_extendedprice").cast("double")).alias("value"))
    p = spark.read.parquet(f"{sf}/part.parquet")
    coarse = p.select(F.col("p_partkey").alias("voxel_id"), F.col("p_partkey").alias("x"), (F.col("p_size") % 8).cast("int").alias("y"), (F.col("p_partkey") % 3).cast("int").alias("z"), (F.col("p_size") % 4).cast("int").alias("label"))
    return labels.hyperintensity_region(coarse, fine, scale=1.0, least=10, least_fine=10, low=-0.5).select("voxel_id", "label")


@query(
    "r10_orientation_check",
    f"""with {COHORT}, m as (select distinct subject_id, voxel_id, label, x - 4 as wx, 3 * y as wy, 2 * z + 1 as wz from c), g as (select subject_id, case when label <= 3 then 'olf' when label <= 6 then 'cer' else 'cor' end as g, avg(wx) as wx, avg(wy) as wy, avg(wz) as wz from m group by 1, 2),
e as (select subject_id, (max(wy) - min(wy)) - (max(wz) - min(wz)) as gap from m group by subject_id),
k as (select subject_id, 'extent' as relation, gap from e union all select a.subject_id, 'olfactory > cerebellum', a.wy - b.wy from g a join g b using (subject_id) where a.g = 'olf' and b.g = 'cer' union all select a.subject_id, 'cerebellum < cortex', a.wy - b.wy from g a join g b using (subject_id) where a.g = 'cer' and b.g = 'cor')
select subject_id, relation, round(gap, 6) as separation, case relation when 'cerebellum < cortex' then gap < 0 else gap > 0 end as passed from k""",
)
def r10(spark, sf):
    names = spark.createDataFrame([("olfactory bulb", x) for x in (1, 2, 3)] + [("cerebellar cortex", x) for x in (4, 5, 6)] + [("isocortex", x) for x in (7, 8, 9, 10)], "region string, label int")
    m = _cohort(spark, sf).select("subject_id", "voxel_id", "x", "y", "z", "label")
    return labels.orientation_check(m, names, [[1, 0, 0, -4], [0, 3, 0, 0], [0, 0, 2, 1]]).select("subject_id", "relation", *_r("separation"), "passed")


@query(
    "d04_diffusion_foreground",
    f"""with recursive {LONG}, b as (select voxel_id, x, y, z, avg(100 * (1 + v)) as b0 from c where frame % 4 = 0 group by voxel_id, x, y, z), h as (select * from b where b0 > (select quantile_cont(b0, 0.6) from b where b0 > 0)),
n as (select a.voxel_id as a, o.voxel_id as b from h a join h o on abs(a.x - o.x) + abs(a.y - o.y) + abs(a.z - o.z) = 1), r as (select voxel_id, voxel_id as root from h union select n.b, r.root from r join n on n.a = r.voxel_id),
k as (select voxel_id, min(root) as component from r group by voxel_id) select voxel_id from k where component = (select arg_max(component, (n, -component)) from (select component, count(*) as n from k group by component))""",
)
def d04(spark, sf):
    c = _curves(spark, sf).select("voxel_id", "x", "y", "z", F.col("signal").alias("values"))
    return diffusion.diffusion_foreground(c, _gradients(spark))

"""The registered queries over the driver's tables, each with SQL that DuckDB can run where SQL can express it.

Embeddings are curves (64 frames, 2.463 s apart), label + 1 is their parcellation; orders are runs, lineitem's prices
are maps, events are long curves. Floats are rounded alike on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curvemill.functions import arrays as A
from curvemill.operators import aggregate, aif, cohort, concentration, diffusion, kinetics, labels, preprocess, qc, relaxometry
from curvemill.sources import curves as C

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

REGIONS = [("GM", x) for x in range(1, 5)] + [("WM", x) for x in range(5, 9)] + [("MIXED", 4), ("MIXED", 5), ("EMPTY", 99)]
REGION_SQL = "region_map as (select unnest(['GM','GM','GM','GM','WM','WM','WM','WM','MIXED','MIXED','EMPTY']) as region, unnest([1,2,3,4,5,6,7,8,4,5,99]) as label)"
LONG = """c as (select vec_id as voxel_id, vec_id % 16 as x, (vec_id // 16) % 16 as y, vec_id // 256 as z, label + 1 as label,
    (800 + 10 * (vec_id % 100))::double as t1_ms, (1000 + vec_id % 50)::double as m0, unnest(range(len(embedding))) as frame, unnest(embedding)::double as v from embeddings)"""
INPUT = "ca as (select frame, 1 + avg(v) as c_a, frame * 2.463 as t from c group by frame)"
COORDS = """co as (select frame, c_a, coalesce(sum(area) over (order by frame rows between unbounded preceding and 1 preceding), 0) / c_a as x
    from (select *, c_a * (lead(t) over (order by frame) - t) as area from ca))"""


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def _curves(spark: SparkSession, sf: str) -> DataFrame:
    return C.embedding_curves(spark, sf)


def _region_map(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(REGIONS, "region string, label int")


def _maps(spark: SparkSession, sf: str) -> DataFrame:
    c = _curves(spark, sf)
    return c.select("voxel_id", "x", "y", "z", "label", A.mean(F.col("values")).alias("mean_value"), F.array_max("values").alias("value"))


def _long_out(df: DataFrame, values: str, digits: int = 6) -> DataFrame:
    long = df.select("voxel_id", F.posexplode(values).alias("frame", "value"))
    return long.select("voxel_id", "frame", F.round("value", digits).alias("value"))


def _r(*names: str, digits: int = 6) -> list:
    return [F.round(n, digits).alias(n) for n in names]


@query(
    "k02_patlak_ols",
    f"""with {LONG}, {INPUT}, {COORDS}, p as (select c.voxel_id, co.x, c.v / co.c_a as y from c join co using (frame) where co.x >= (select max(x) from co) / 3),
s as (select voxel_id, count(*) as n, regr_slope(y, x) as slope, regr_intercept(y, x) as cut, regr_sxx(y, x) as sxx, regr_syy(y, x) as syy, regr_sxy(y, x) as sxy from p group by voxel_id)
select voxel_id, n, round(slope * 6000, 6) as ki, round(cut * 100, 6) as vb, round(sqrt(greatest(syy - slope * sxy, 0) / sxx / (n - 2)) * 6000, 6) as sd_ki from s""",
)
def k02(spark, sf):
    c = _curves(spark, sf)
    return kinetics.patlak(c, C.input_curve(c), keys=["voxel_id"], per_voxel=False).select("voxel_id", "n", *_r("ki", "vb", "sd_ki"))


@query(
    "k03_patlak_voxelwise",
    f"""with {LONG}, {INPUT}, {COORDS}, a as (select c.voxel_id, co.x, c.v / co.c_a as y, max(co.x) over (partition by c.voxel_id) as xm from c join co using (frame)),
s as (select voxel_id, count(*) as n, regr_slope(y, x) as slope, regr_intercept(y, x) as cut, regr_sxx(y, x) as sxx, regr_syy(y, x) as syy, regr_sxy(y, x) as sxy from a where x >= xm / 3 group by voxel_id)
select voxel_id, n, round(slope * 6000, 6) as ki, round(cut * 100, 6) as vb, round(sqrt(greatest(syy - slope * sxy, 0) / sxx / greatest(n - 2, 1)) * 6000, 6) as sd_ki from s""",
)
def k03(spark, sf):
    c = _curves(spark, sf)
    return kinetics.patlak(c, C.input_curve(c), keys=["voxel_id"]).select("voxel_id", "n", *_r("ki", "vb", "sd_ki"))


@query("k01_patlak_coordinates", f"with {LONG}, {INPUT}, {COORDS} select frame, round(x, 6) as x, round(c_a, 9) as c_a from co")
def k01(spark, sf):
    return kinetics.patlak_coordinates(kinetics.long_input(C.input_curve(_curves(spark, sf)))).select("frame", *_r("x"), *_r("c_a", digits=9))


@query(
    "k05_patlak_inclusive",
    f"""with {LONG}, {INPUT}, co as (select frame, c_a, sum(c_a) over (order by frame) * 2.463 / c_a as x from ca),
p as (select c.voxel_id, co.x, c.v / co.c_a as y from c join co using (frame) where co.x >= (select max(x) from co) / 3)
select voxel_id, count(*) as n, round(regr_slope(y, x) * 6000, 6) as ki, round(regr_intercept(y, x) * 100, 6) as vb from p group by voxel_id""",
)
def k05(spark, sf):
    c = _curves(spark, sf)
    return kinetics.patlak(c, C.input_curve(c), keys=["voxel_id"], inclusive=True).select("voxel_id", "n", *_r("ki", "vb"))


PATLAK = f"""{LONG}, {INPUT}, {COORDS}, pa as (select c.voxel_id, co.x, c.v / co.c_a as y from c join co using (frame) where co.x >= (select max(x) from co) / 3),
fit as (select voxel_id, regr_slope(y, x) as k, regr_intercept(y, x) as b from pa group by voxel_id),
pred as (select voxel_id, frame, k * x * c_a + b * c_a as value from fit, co)"""


@query("k09_patlak_predict", f"with {PATLAK} select voxel_id, frame, round(value, 6) as value from pred")
def k09(spark, sf):
    c = _curves(spark, sf)
    i = C.input_curve(c)
    fits = kinetics.patlak(c, i, keys=["voxel_id"])
    return _long_out(kinetics.patlak_predict(fits, i), "predicted")


@query(
    "k24_fit_by_parcel",
    f"""with {LONG}, {INPUT}, {COORDS}, m as (select label, frame, median(v) as v from c group by label, frame),
p as (select m.label, co.x, m.v / co.c_a as y from m join co using (frame) where co.x >= (select max(x) from co) / 3),
s as (select label, regr_slope(y, x) * 6000 as ki, regr_intercept(y, x) * 100 as vb from p group by label)
select e.vec_id as voxel_id, e.label + 1 as label, round(ki, 6) as ki, round(vb, 6) as vb from embeddings e join s on s.label = e.label + 1""",
)
def k24(spark, sf):
    c = _curves(spark, sf)
    return kinetics.fit_by_label(c, C.input_curve(c), keys=["voxel_id"]).select("voxel_id", "label", *_r("ki", "vb"))


@query(
    "k13_residue_moments",
    f"""with {LONG}, r as (select voxel_id, frame, greatest(min(v) over (partition by voxel_id order by frame), 0) as r from c),
h as (select voxel_id, frame, r, greatest(case when frame = 0 then 3 * r - 4 * lead(r, 1) over w + lead(r, 2) over w when frame = 63 then 4 * lag(r, 1) over w - lag(r, 2) over w - 3 * r
    else lag(r, 1) over w - lead(r, 1) over w end / (2 * 2.463), 0) as h, case when frame in (0, 63) then 0.5 else 1 end * 2.463 as w from r window w as (partition by voxel_id order by frame)),
a as (select voxel_id, sum(w * r) as mtt, sum(w * h) as area, sum(w * h * frame * 2.463) as m1 from h group by voxel_id),
s as (select voxel_id, any_value(mtt) as mtt, any_value(area) as area, sum(w * h / area * power(frame * 2.463 - m1 / area, 2)) as var from h join a using (voxel_id) group by voxel_id)
select voxel_id, round(case when area > 1e-12 then mtt end, 6) as mtt, round(case when area > 1e-12 then sqrt(greatest(var, 0)) end, 6) as cth from s""",
)
def k13(spark, sf):
    return kinetics.residue_moments(_curves(spark, sf), dt=C.DT).select("voxel_id", *_r("mtt", "cth"))


@query(
    "c01_conc_saturation_recovery",
    f"""with {LONG}, s as (select voxel_id, frame, 100 * (1 + v) / (m0 * sin(radians(30))) as r, t1_ms / 1000 as t1 from c),
raw as (select voxel_id, frame, case when r < 1 then -(ln(1 - r) / 0.12 + 1 / t1) / 4 end as k from s),
b as (select voxel_id, avg(k) as base from raw where frame >= 2 and frame < 10 group by voxel_id)
select voxel_id, frame, round(case when frame < 10 then 0 else coalesce(k - coalesce(base, 0), 0) end, 6)::double as value from raw join b using (voxel_id)""",
)
def c01(spark, sf):
    return _long_out(concentration.saturation_recovery(_curves(spark, sf), flip_deg=30), "conc")


@query(
    "c02_conc_spgr",
    f"""with {LONG}, s as (select voxel_id, frame, t1_ms, 100 * (1 + v) / (m0 * sin(radians(15))) as a from c),
e as (select voxel_id, frame, t1_ms, least(greatest((a - 1) / nullif(a * cos(radians(15)) - 1, 0), 1e-12), 1.0) as e1 from s),
raw as (select voxel_id, frame, 1000 / t1_ms / 4 - ln(e1) / (4 * 0.005) as k from e),
b as (select voxel_id, avg(k) as base from raw where frame >= 2 and frame < 10 group by voxel_id)
select voxel_id, frame, round(coalesce(k - base, 0), 6) as value from raw join b using (voxel_id)""",
)
def c02(spark, sf):
    return _long_out(concentration.spgr(_curves(spark, sf), flip_deg=15, tr_s=0.005), "conc")


@query(
    "c03_conc_spgr_ratio",
    f"""with {LONG}, s as (select voxel_id, frame, 1000 / t1_ms as r10, 100 * (1 + v) as s from c),
base as (select voxel_id, median(s) as s0 from s where frame >= 2 and frame < 10 group by voxel_id),
g as (select voxel_id, frame, r10, s / s0 * (1 - exp(-0.005 * r10)) / (1 - cos(radians(15)) * exp(-0.005 * r10)) as g from s join base using (voxel_id)),
raw as (select voxel_id, frame, (-ln(least(greatest((1 - g) / (1 - cos(radians(15)) * g), 1e-6), 1 - 1e-9)) / 0.005 - r10) / 4 as k from g),
b as (select voxel_id, avg(k) as base from raw where frame >= 2 and frame < 10 group by voxel_id)
select voxel_id, frame, round(least(greatest(k - base, -20), 20), 6) as value from raw join b using (voxel_id)""",
)
def c03(spark, sf):
    return _long_out(concentration.spgr_ratio(_curves(spark, sf), flip_deg=15, tr_s=0.005), "conc")


@query(
    "c04_conc_vfa_spgr",
    f"""with {LONG}, e as (select voxel_id, frame, t1_ms, m0 * sin(radians(15)) as top, 100 * (1 + v) as s from c)
select voxel_id, frame, round((-ln(least(greatest((top - s) / (top - s * cos(radians(15))), 1e-9), 1 - 1e-9)) / 0.005 - 1000 / t1_ms) / 4, 6) as value from e""",
)
def c04(spark, sf):
    return _long_out(concentration.vfa_spgr(_curves(spark, sf), flip_deg=15, tr_s=0.005), "conc")


@query(
    "b01_high_signal_mean_curve",
    f"""with {LONG}, e as (select voxel_id, avg(v) as early from c where frame < 5 group by voxel_id)
select frame, round(avg(v), 9) as value from c join e using (voxel_id) where early >= (select quantile_cont(early, 0.75) from e) group by frame""",
)
def b01(spark, sf):
    one = _curves(spark, sf).withColumn("one", F.lit(1))
    return preprocess.high_signal_mean_curve(one, keys=["one"]).select(F.posexplode("values").alias("frame", "value")).select("frame", F.round("value", 9).alias("value"))


@query(
    "b02_baseline_auto",
    f"""with {LONG}, s as (select voxel_id, max(v) as mx, max(v) filter (frame = 0) as b0 from c group by voxel_id),
o as (select voxel_id, min(frame) as onset from c join s using (voxel_id) where v >= b0 + 0.5 * (mx - b0) group by voxel_id),
m as (select voxel_id, arg_min(frame, (v, frame)) as nbf from c join o using (voxel_id) where frame >= 3 and frame < onset group by voxel_id)
select voxel_id, coalesce(case when onset > 3 then greatest(nbf, 3) end, 10)::int as nbf from o left join m using (voxel_id)""",
)
def b02(spark, sf):
    return preprocess.baseline_frames(_curves(spark, sf), method="auto").select("voxel_id", "nbf")


@query(
    "b03_baseline_derivative",
    f"""with {LONG}, d as (select voxel_id, frame - 1 as f, v - lag(v) over (partition by voxel_id order by frame) as d from c),
t as (select voxel_id, min(f) as top from (select *, max(d) over (partition by voxel_id) as mx from d) where d = mx group by voxel_id),
l as (select voxel_id, max(f) + 1 as nbf from d join t using (voxel_id) where d <= 0 and f < top group by voxel_id)
select voxel_id, greatest(coalesce(nbf, 10), 3)::int as nbf from t left join l using (voxel_id)""",
)
def b03(spark, sf):
    return preprocess.baseline_frames(_curves(spark, sf), method="derivative").select("voxel_id", "nbf")


@query(
    "b07_local_maxima",
    f"""with {LONG}, n as (select *, lag(v) over w as b, lead(v) over w as a from c window w as (partition by voxel_id order by frame))
select voxel_id, frame, round(v, 6) as height from n where v > b and v > a""",
)
def b07(spark, sf):
    c = _curves(spark, sf).select("voxel_id", F.explode(preprocess.local_maxima(F.col("values"))).alias("p"))
    return c.select("voxel_id", "p.frame", F.round("p.height", 6).alias("height"))


@query(
    "b07_major_peaks",
    f"""with {LONG}, n as (select *, lag(v) over w as b, lead(v) over w as a from c window w as (partition by voxel_id order by frame)), m as (select voxel_id, frame, v from n where v > b and v > a),
f as (select voxel_id, arg_max(frame, (v, -frame)) as f0 from m group by voxel_id), g as (select voxel_id, arg_max(m.frame, (m.v, -m.frame)) as f1 from m join f using (voxel_id) where abs(m.frame - f0) >= 10 group by voxel_id)
select voxel_id, r.rank::int as rank, m.frame, round(m.v, 6) as height from (select voxel_id, 0 as rank, f0 as frame from f union all select voxel_id, 1, f1 from g) r join m using (voxel_id, frame)""",
)
def b07m(spark, sf):
    c = _curves(spark, sf).select("voxel_id", F.posexplode(preprocess.major_peaks(F.col("values"))).alias("rank", "p"))
    return c.select("voxel_id", "rank", "p.frame", F.round("p.height", 6).alias("height"))


@query(
    "b09_onset_walk",
    f"""with {LONG}, s as (select voxel_id, avg(v) filter (frame between 3 and 8) as m, stddev_pop(v) filter (frame between 3 and 8) as sd, max(v) - min(v) as span from c group by voxel_id),
e as (select voxel_id, frame, (v > m + greatest(4 * sd, 0.05 * span, 5e-4))::int as e from c join s using (voxel_id)),
t as (select voxel_id, frame, sum(e) over (partition by voxel_id order by frame rows between current row and 2 following) as k, count(*) over (partition by voxel_id order by frame rows between current row and 2 following) as n from e)
select s.voxel_id, case when min(t.frame) is null then 8 else greatest(min(t.frame) - 1, 3) end::int as onset from s left join t on t.voxel_id = s.voxel_id and t.frame >= 8 and t.k = 3 and t.n = 3 group by s.voxel_id""",
)
def b09(spark, sf):
    return _curves(spark, sf).select("voxel_id", preprocess.onset_walk(F.col("values")).alias("onset"))


@query(
    "b10_shift_to_zero",
    f"""with {LONG}, l as (select voxel_id, min(v) as low from c where frame >= 8 group by voxel_id)
select voxel_id, frame, round(case when frame < 8 then 0 else v - low end, 6)::double as value from c join l using (voxel_id)""",
)
def b10(spark, sf):
    return _long_out(_curves(spark, sf).withColumn("values", preprocess.shift_to_zero(F.col("values"), 8)), "values")


@query(
    "b13_norm_baseline_p95",
    f"""with {LONG}, b as (select voxel_id, avg(v) as base from c where frame < 5 group by voxel_id),
d as (select voxel_id, frame, v - base as d from c join b using (voxel_id)), s as (select voxel_id, quantile_cont(abs(d), 0.95) as scale from d group by voxel_id)
select voxel_id, frame, round(d / case when scale = 0 then 1 else scale end, 6) as value from d join s using (voxel_id)""",
)
def b13(spark, sf):
    return _long_out(preprocess.norm_baseline_p95(_curves(spark, sf)), "values")


@query(
    "b19_peak_time",
    f"""with {LONG}, n as (select *, lag(v) over w as b, lead(v) over w as a, row_number() over (partition by voxel_id order by v desc, frame) as r from c window w as (partition by voxel_id order by frame))
select voxel_id, round(frame + coalesce(case when b - 2 * v + a <> 0 then least(greatest(0.5 * (b - a) / (b - 2 * v + a), -1), 1) end, 0), 6) as peak_frame, round(v, 6) as height from n where r = 1""",
)
def b19(spark, sf):
    return preprocess.peak_time_subsample(_curves(spark, sf)).select("voxel_id", *_r("peak_frame", "height"))


@query("b23_moving_average", f"with {LONG} select voxel_id, frame, round(sum(v) over (partition by voxel_id order by frame rows between 1 preceding and 1 following) / 3, 6) as value from c")
def b23(spark, sf):
    return _long_out(_curves(spark, sf).withColumn("values", A.smooth3(F.col("values"))), "values")


OTSU = """e as (select min(mean) as lo, (max(mean) - min(mean)) / 256 as w from p), h as (select least(floor((mean - lo) / w), 255)::int as bin, count(*) as n from p, e group by 1),
o as (select bin, sum(n) over (order by bin) as w0, sum(n * (lo + (bin + 0.5) * w)) over (order by bin) as m0, sum(n) over () as wt, sum(n * (lo + (bin + 0.5) * w)) over () as mt from h, e),
edge as (select any_value(lo) + arg_max(bin, (round(coalesce(w0 * (wt - w0) * power(m0 / w0 - (mt - m0) / nullif(wt - w0, 0), 2), 0), 9), -bin)) * any_value(w) as edge from o, e)"""


@query(
    "a01_top_peak",
    f"""with {LONG}, p as (select voxel_id, label, y, max(v) filter (frame >= 5) - avg(v) filter (frame < 5) as peak, avg(v) as mean from c group by voxel_id, label, y), {OTSU},
m as (select *, count(*) filter (y between 0 and 6) over (partition by label) as inside from p, edge where mean > edge)
select label, voxel_id, round(peak, 6) as peak, rank from (select *, row_number() over (partition by label order by peak desc, voxel_id) as rank from m where inside < 8 or y between 0 and 6) where rank <= 8""",
)
def a01(spark, sf):
    found = aif.top_peak(_curves(spark, sf).withColumn("z", F.col("y")), by=["label"], n=8, masked=True, band=(0.0, 0.4), n_slices=16)
    return found.select("label", "voxel_id", F.round("peak", 6).alias("peak"), F.col("rank").cast("long").alias("rank"))


@query(
    "a03_curve_from_mask",
    f"""with {LONG}, p as (select voxel_id, max(v) filter (frame >= 5) - avg(v) filter (frame < 5) as peak from c group by voxel_id),
m as (select voxel_id from p order by peak desc, voxel_id limit 32) select frame, round(avg(v), 9) as value from c semi join m using (voxel_id) group by frame""",
)
def a03(spark, sf):
    c = _curves(spark, sf).withColumn("one", F.lit(1))
    found = aif.curve_from_members(c, aif.top_peak(c, by=[]).select("voxel_id"), by=["one"])
    return found.select(F.posexplode("values").alias("frame", "value")).select("frame", F.round("value", 9).alias("value"))


@query(
    "a04_max_voxel",
    f"""with {LONG}, p as (select voxel_id, label, max(v) filter (frame >= 5) - avg(v) filter (frame < 5) as peak from c group by voxel_id, label)
select label, voxel_id, round(peak, 6) as peak from (select *, row_number() over (partition by label order by peak desc, voxel_id) as r from p) where r = 1""",
)
def a04(spark, sf):
    return aif.max_voxel(_curves(spark, sf), by=["label"]).select("label", "voxel_id", F.round("peak", 6).alias("peak"))


@query(
    "a02_otsu",
    """with p as (select l_extendedprice::double as v from lineitem), e as (select min(v) as lo, (max(v) - min(v)) / 256 as w from p),
h as (select least(floor((v - lo) / w), 255)::int as bin, count(*) as n from p, e group by 1),
s as (select bin, sum(n) over (order by bin) as w0, sum(n * (lo + (bin + 0.5) * w)) over (order by bin) as m0, sum(n) over () as wt, sum(n * (lo + (bin + 0.5) * w)) over () as mt from h, e)
select round(lo + arg_max(bin, (round(coalesce(w0 * (wt - w0) * power(m0 / w0 - (mt - m0) / nullif(wt - w0, 0), 2), 0), 9), -bin)) * any_value(w), 6) as threshold from s, e group by lo""",
)
def a02(spark, sf):
    prices = spark.read.parquet(f"{sf}/lineitem.parquet").select(F.col("l_extendedprice").cast("double").alias("value"))
    return labels.otsu_threshold(prices).select(F.round("threshold", 6).alias("threshold"))


@query(
    "a12_temporal_features",
    f"""with {LONG}, b as (select voxel_id, avg(v) as m from c where frame < 5 group by voxel_id), d as (select voxel_id, frame, v - m as d from c join b using (voxel_id)),
s as (select voxel_id, max(d) as peak, arg_max(frame, (d, -frame)) as ttp, max(d) filter (frame < 32) as early, max(d) filter (frame >= 32) as late, avg(d) filter (frame >= 51) as tail from d group by voxel_id),
a as (select voxel_id, min(frame) as arrival from d join s using (voxel_id) where d > 0.1 * peak group by voxel_id),
f as (select voxel_id, ttp::int as ttp, arrival::int as arrival, ttp / 63 as ttp_frac, case when peak > 0 then (peak - tail) / peak end as washout, case when peak > 0 then early / greatest(late, 0.05 * peak) end as early_late from s left join a using (voxel_id))
select voxel_id, ttp, arrival, case when early_late is null then 'none' when early_late >= 1.5 and ttp_frac <= 0.55 then 'vessel' else 'mucosa' end as kind, round(ttp_frac, 6) as ttp_frac, round(washout, 6) as washout, round(early_late, 6) as early_late from f""",
)
def a12(spark, sf):
    f = aif.classify_curve(aif.temporal_features(_curves(spark, sf)))
    return f.select("voxel_id", "ttp", "arrival", "kind", *_r("ttp_frac", "washout", "early_late"))


@query("a15_max_projection", f"with {LONG} select voxel_id, round(coalesce(max(v), 0), 6) as projection from c group by voxel_id")
def a15(spark, sf):
    return aif.max_projection(_curves(spark, sf)).select("voxel_id", *_r("projection"))


METRICS = f"""{LONG}, sm as (select voxel_id, label, frame, v, sum(v) over (partition by voxel_id order by frame rows between 1 preceding and 1 following) / 3 as s, v - lag(v) over (partition by voxel_id order by frame) as dv from c),
p as (select voxel_id, label, max(s) as peak, arg_max(frame, (s, -frame)) as pk from sm group by voxel_id, label),
w as (select voxel_id, coalesce(max(frame) filter (s < peak / 2 and frame < pk), 0) as lo, coalesce(min(frame) filter (s < peak / 2 and frame > pk), 63) as hi, min(frame) filter (s >= 0.1 * peak) as arrival,
    sum(greatest(s, 0)) filter (frame <= pk) * 2.463 / any_value(peak) as auc, stddev_pop(v) filter (case when pk < 63 then frame > pk else frame >= 43 end) / abs(avg(v) filter (case when pk < 63 then frame > pk else frame >= 43 end)) as cv,
    stddev_pop(v) filter (frame < 5) as base_sd, avg(abs(dv)) / any_value(peak) as rough, max(v) filter (frame = pk) as raw, max(v) filter (frame <= pk) as first_pass from sm join p using (voxel_id) group by voxel_id),
q as (select voxel_id, label, arrival::int as arrival, arrival * 2.463 as arrival_s, (hi - lo)::int as fwhm_frames, (hi - lo) * 2.463 as fwhm_s, peak, auc as auc_peak, cv as tail_cv, base_sd, rough as roughness,
    hi - lo < 2.5 or raw > 1.5 * peak or first_pass > 1.6 * peak as vetoed from p join w using (voxel_id) where peak > 0)"""


@query(
    "a09_curve_metrics",
    f"""with {METRICS} select e.vec_id as voxel_id, arrival, fwhm_frames, round(peak, 6) as peak, round(fwhm_s, 6) as fwhm_s, round(auc_peak, 6) as auc_peak, round(tail_cv, 6) as tail_cv, round(base_sd, 6) as base_sd, round(roughness, 6) as roughness
from embeddings e left join q on q.voxel_id = e.vec_id""",
)
def a09(spark, sf):
    m = aif.curve_metrics(_curves(spark, sf), dt=C.DT)
    return m.select("voxel_id", "arrival", "fwhm_frames", *_r("peak", "fwhm_s", "auc_peak", "tail_cv", "base_sd", "roughness"))


_UNITS = " + ".join(
    f"{w} * case when hi_{m} > lo_{m} then {'' if more else '1 - '}({m} - lo_{m}) / (hi_{m} - lo_{m}) else {0.5 if more else 0.0} end" for m, w, more in aif.RANKING
)
_LIMITS = ", ".join(f"min({m}) as lo_{m}, max({m}) as hi_{m}" for m, _, _ in aif.RANKING)


@query(
    "a11_rank_candidates",
    f"""with {METRICS}, u as (select e.vec_id as voxel_id, e.label + 1 as label, case when e.vec_id % 5 = 0 then null else e.vec_id - e.vec_id % 5 end as parent, q.* exclude (voxel_id, label, vetoed), coalesce(vetoed, true) as own from embeddings e left join q on q.voxel_id = e.vec_id),
v as (select u.*, u.own or coalesce(a.own, false) as vetoed from u left join u a on a.voxel_id = u.parent and a.label = u.label), l as (select label, {_LIMITS} from u where peak is not null group by label),
s as (select v.label, voxel_id, vetoed, case when peak is not null then ({_UNITS}) / 6.7 end as score from v join l using (label))
select label, voxel_id, vetoed, round(score, 6) as score, row_number() over (partition by label order by vetoed, round(score, 9) desc nulls last, voxel_id) as rank from s""",
)
def a11(spark, sf):
    c = _curves(spark, sf)
    named = c.withColumn("parent", F.when(F.col("voxel_id") % 5 != 0, F.col("voxel_id") - F.col("voxel_id") % 5))
    return aif.rank_candidates(aif.spike_veto(named, dt=C.DT), by=["label"], parent="parent").select("label", "voxel_id", "vetoed", "rank", *_r("score"))


@query(
    "a21_washout",
    f"""with {LONG}, s as (select voxel_id, max(v) as peak, median(v) filter (frame >= 52) as tail from c group by voxel_id),
r as (select voxel_id, case when peak > 0 then tail / peak end as ratio, tail, case when voxel_id % 4 > 0 then voxel_id % 4 * 0.001 / (72.0 / 1000 * (1 - 0.45)) end as mixed from s)
select voxel_id, round(ratio, 6) as tail_ratio, coalesce(ratio >= 0.6, false) as flagged, round(mixed, 6) as mixed_mm, case when mixed is not null then coalesce(ratio >= 0.6, false) and tail >= mixed end as over_mixed from r""",
)
def a21(spark, sf):
    c = _curves(spark, sf).withColumn("dose", (F.col("voxel_id") % 4) * 0.001)
    return aif.washout_flag(c, dose_mmol_kg="dose").select("voxel_id", *_r("tail_ratio", "mixed_mm"), "flagged", "over_mixed")


_ANGLES = "a as (select l_suppkey as subject_id, l_partkey as voxel_id, [3, 9, 15, 24][l_linenumber % 4 + 1]::double as deg, (l_quantity * 10 + l_linenumber)::double as s, 0.9 + (l_partkey % 3) * 0.1 as b1 from lineitem)"


@query(
    "t03_fit_flip_angle",
    f"""with {_ANGLES}, p as (select subject_id, voxel_id, s / sin(radians(deg * b1)) as y, s / tan(radians(deg * b1)) as x from a),
f as (select subject_id, voxel_id, regr_slope(y, x) as k, regr_sxx(y, x) as sxx, count(*) as n from p group by subject_id, voxel_id)
select subject_id, voxel_id, round(case when t1 > 20 and t1 <= 8000 then t1 end, 3) as t1_ms, n from (select *, case when sxx > 0 then -11.18 / ln(least(greatest(k, 1e-6), 1 - 1e-6)) end as t1 from f)""",
)
def t03(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    deg = F.element_at(F.array(*[F.lit(float(x)) for x in (3, 9, 15, 24)]), (F.col("l_linenumber") % 4 + 1).cast("int"))
    long = li.select(F.col("l_suppkey").alias("subject_id"), F.col("l_partkey").alias("voxel_id"), deg.alias("angle_deg"), (F.col("l_quantity") * 10 + F.col("l_linenumber")).cast("double").alias("signal"), (0.9 + (F.col("l_partkey") % 3) * 0.1).alias("b1_scale"))
    n = long.groupBy("subject_id", "voxel_id").agg(F.count(F.lit(1)).alias("n"))
    fits = relaxometry.fit_flip_angle(long, keys=["subject_id", "voxel_id"], tr_s=0.01118, least_ms=20, most_ms=8000)
    return fits.join(n, ["subject_id", "voxel_id"]).select("subject_id", "voxel_id", F.round("t1_ms", 3).alias("t1_ms"), "n")


@query(
    "t04_foreground",
    f"""with {LONG}, m as (select voxel_id, label, max(abs(v)) as m from c group by voxel_id, label), l as (select label, 0.8 * quantile_cont(m, 0.98) as lim from m where m > 0 group by label)
select voxel_id, label from m join l using (label) where m > lim""",
)
def t04(spark, sf):
    return relaxometry.foreground(_curves(spark, sf), by=["label"], share=0.8).select("voxel_id", "label")


@query(
    "r02_mask_positive",
    "with m as (select vec_id as voxel_id, list_max(embedding)::double as v from embeddings) select voxel_id, (v > 0)::int as positive from m",
)
def r02(spark, sf):
    return _maps(spark, sf).select("voxel_id", (F.col("value") > 0).cast("int").alias("positive"))


@query("r03_restrict_labels", "select vec_id as voxel_id, case when label + 1 in (2, 5, 7) then label + 1 else 0 end as label from embeddings")
def r03(spark, sf):
    return labels.restrict_labels(_maps(spark, sf).select("voxel_id", "label"), [2, 5, 7])


@query("r04_combine_masks", "select l_partkey as voxel_id, min(l_linenumber)::int as label from lineitem group by l_partkey")
def r04(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    return labels.combine_masks(li.select(F.col("l_partkey").alias("voxel_id"), F.col("l_linenumber").cast("int").alias("label")))


@query("r05_assign_region", f"with {REGION_SQL} select vec_id as voxel_id, e.label + 1 as label, region from embeddings e join region_map r on r.label = e.label + 1")
def r05(spark, sf):
    return labels.assign_region(_maps(spark, sf).select("voxel_id", "label"), _region_map(spark))


@query("r12_label_names", "select s_suppkey as voxel_id, s_nationkey as label, coalesce(case when n_nationkey % 2 = 0 then n_name end, 'label_' || s_nationkey) as name from supplier left join nation on s_nationkey = n_nationkey")
def r12(spark, sf):
    s = spark.read.parquet(f"{sf}/supplier.parquet").select(F.col("s_suppkey").alias("voxel_id"), F.col("s_nationkey").alias("label"))
    names = spark.read.parquet(f"{sf}/nation.parquet").where("n_nationkey % 2 = 0").select(F.col("n_nationkey").alias("label"), F.col("n_name").alias("name"))
    return labels.label_names(s, names).select("voxel_id", "label", "name")


@query("r11_exclude_voxels", "select vec_id as voxel_id, label + 1 as label from embeddings where label <> 3")
def r11(spark, sf):
    m = _maps(spark, sf).select("voxel_id", "label")
    return labels.exclude_voxels(m, m.where("label = 4").select("voxel_id"))


@query(
    "r07_resample_nearest",
    """with s as (select vec_id % 16 as x, (vec_id // 16) % 16 as y, vec_id // 256 as z, label + 1 as label from embeddings),
t as (select vec_id as voxel_id, round_even((vec_id % 16) * 0.9 + 0.2, 0)::int as x, round_even(((vec_id // 16) % 16) * 0.9 + 0.2, 0)::int as y, (vec_id // 256)::int as z from embeddings)
select voxel_id, coalesce(label, 0) as label from t left join s using (x, y, z)""",
)
def r07(spark, sf):
    m = _maps(spark, sf)
    return labels.resample_nearest(m, m, [[0.9, 0, 0, 0.2], [0, 0.9, 0, 0.2], [0, 0, 1, 0]])


@query(
    "r08_resample_linear",
    """with m as (select vec_id as voxel_id, vec_id % 16 as x, (vec_id // 16) % 16 as y, vec_id // 256 as z, list_max(embedding)::double as v from embeddings),
k as (select voxel_id, (floor(x * 0.75) + dx)::bigint as x, (floor(y * 0.75) + dy)::bigint as y, (floor(z * 0.75) + dz)::bigint as z, (case dx when 1 then x * 0.75 - floor(x * 0.75) else 1 - x * 0.75 + floor(x * 0.75) end)
    * (case dy when 1 then y * 0.75 - floor(y * 0.75) else 1 - y * 0.75 + floor(y * 0.75) end) * (case dz when 1 then z * 0.75 - floor(z * 0.75) else 1 - z * 0.75 + floor(z * 0.75) end) as w
    from m, (select unnest([0, 1]) as dx), (select unnest([0, 1]) as dy), (select unnest([0, 1]) as dz))
select k.voxel_id, round(sum(w * coalesce(m.v, 0)), 6) as value from k left join m using (x, y, z) where w > 0 group by k.voxel_id""",
)
def r08(spark, sf):
    m = _maps(spark, sf)
    return labels.resample_linear(m, m, 0.75).select("voxel_id", F.round("value", 6).alias("value"))


_MASKED = "m as (select vec_id as voxel_id, vec_id % 16 as x, (vec_id // 16) % 16 as y, vec_id // 256 as z from embeddings where label < 4)"


@query(
    "z01_connected_components",
    f"""with recursive {_MASKED}, e as (select a.voxel_id as a, b.voxel_id as b from m a join m b on abs(a.x - b.x) + abs(a.y - b.y) + abs(a.z - b.z) = 1),
r as (select voxel_id, voxel_id as root from m union select e.b, r.root from r join e on e.a = r.voxel_id) select voxel_id, min(root) as component from r group by voxel_id""",
)
def z01(spark, sf):
    return labels.connected_components(_maps(spark, sf).where("label <= 4"))


@query(
    "z02_binary_open",
    """with m as (select distinct l_partkey as x, l_linenumber::int as y, (ascii(l_returnflag) % 3)::int as z from lineitem where l_quantity > 5),
d as (select unnest([1, -1, 0, 0, 0, 0]) as dx, unnest([0, 0, 1, -1, 0, 0]) as dy, unnest([0, 0, 0, 0, 1, -1]) as dz),
e as (select m.x, m.y, m.z from m, d, m n where n.x = m.x + dx and n.y = m.y + dy and n.z = m.z + dz group by all having count(*) = 6)
select x, y, z from e union select x + dx, y + dy, z + dz from e, d""",
)
def z02(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet").where("l_quantity > 5")
    return labels.binary_open(li.select(F.col("l_partkey").alias("x"), F.col("l_linenumber").cast("int").alias("y"), (F.ascii("l_returnflag") % 3).cast("int").alias("z")))


@query(
    "a18_roi_agreement",
    """with v as (select vec_id as voxel_id, vec_id % 16 as x, (vec_id // 16) % 16 as y, vec_id // 256 as z, label from embeddings),
j as (select a.x as ax, a.y as ay, a.z as az, b.x as bx, b.y as by_, b.z as bz from (select * from v where label < 6) a full join (select * from v where label > 2) b using (voxel_id)),
s as (select count(ax) as n_a, count(bx) as n_b, count(*) filter (ax is not null and bx is not null) as overlap, sqrt(power(avg(ax) - avg(bx), 2) + power(avg(ay) - avg(by_), 2) + power(avg(az) - avg(bz), 2)) as d from j)
select n_a, n_b, overlap, round(d, 6) as distance, round(overlap / (n_a + n_b - overlap), 6) as iou from s""",
)
def a18(spark, sf):
    m = _maps(spark, sf)
    return labels.voxel_set_agreement(m.where("label < 7"), m.where("label > 3")).select("n_a", "n_b", "overlap", *_r("distance", "iou"))


@query("d01_spherical_mean", f"with {LONG} select voxel_id, (frame % 4) * 1000 as shell, round(avg(100 * (1 + v)), 6) as mean from c group by voxel_id, frame % 4")
def d01(spark, sf):
    return diffusion.spherical_mean(_dwi(spark, sf), _gradients(spark), keys=["voxel_id"]).select("voxel_id", "shell", *_r("mean"))


def _dwi(spark, sf):
    return _curves(spark, sf).select("voxel_id", F.col("signal").alias("values"))


def _gradients(spark):
    """64 directions on a spiral over the sphere; b is 0, 1000, 2000, 3000 in turn."""
    d = spark.range(64).select(F.col("id").cast("int").alias("dir"), ((F.col("id") % 4) * 1000).cast("double").alias("bval"))
    z, a = (2 * F.col("dir") + 1) / 64 - 1, F.col("dir") * 2.399963229728653
    return d.withColumns({"gx": F.sqrt(1 - z * z) * F.cos(a), "gy": F.sqrt(1 - z * z) * F.sin(a), "gz": z})


_RSI = diffusion.rsi_matrix([1000, 2000, 3000])
_RSI_SQL = ", ".join("greatest(" + " + ".join([f"m{i + 1} / m0 * {float(_RSI[k, i])!r}::double" for i in range(3)]) + f" + {float(_RSI[k, 3] * 100.0)!r}::double, 0) as r{k}" for k in range(3))


@query(
    "d02_rsi_fractions",
    f"""with {LONG}, m as (select voxel_id, {", ".join(f"avg(100 * (1 + v)) filter (frame % 4 = {i}) as m{i}" for i in range(4))} from c group by voxel_id), r as (select voxel_id, {_RSI_SQL} from m)
select voxel_id, round(r0 / nullif(r0 + r1 + r2, 0), 6) as f_restricted, round(r1 / nullif(r0 + r1 + r2, 0), 6) as f_hindered, round(r2 / nullif(r0 + r1 + r2, 0), 6) as f_free from r""",
)
def d02(spark, sf):
    means = diffusion.spherical_mean(_dwi(spark, sf), _gradients(spark), keys=["voxel_id"])
    return diffusion.rsi_fractions(means, [1000, 2000, 3000], keys=["voxel_id"]).select("voxel_id", *_r("f_restricted", "f_hindered", "f_free"))


@query("d03_fit_tensor")
def d03(spark, sf):
    return diffusion.fit_tensor(_dwi(spark, sf), _gradients(spark), keys=["voxel_id"])


def _streamlines(spark, sf):
    """Each order's lines, in order, are the points of a streamline."""
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    p = F.struct((F.col("l_partkey") % 32).cast("double").alias("x"), F.floor(F.col("l_partkey") / 32).cast("double").alias("y"), (F.col("l_linenumber") % 2).cast("double").alias("z"))
    each = li.select(F.col("l_orderkey").alias("sid"), F.struct("l_linenumber", "l_partkey", "l_suppkey", p.alias("p")).alias("s"))
    return each.groupBy("sid").agg(F.transform(F.array_sort(F.collect_list("s")), lambda s: s["p"]).alias("points"))


@query("d06_track_density", "select (l_partkey % 32)::int as x, (l_partkey // 32)::int as y, (l_linenumber % 2)::int as z, count(distinct l_orderkey) as density from lineitem group by 1, 2, 3")
def d06(spark, sf):
    return diffusion.track_density(_streamlines(spark, sf))


@query(
    "d08_connectome",
    """with p as (select l_orderkey as sid, l_partkey % 32 as x, l_partkey // 32 as y, l_linenumber % 2 as z,
    row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey) as a, row_number() over (partition by l_orderkey order by l_linenumber desc, l_partkey desc, l_suppkey desc) as b from lineitem),
v as (select vec_id // 2 % 32 as x, vec_id // 64 as y, vec_id % 2 as z, label + 1 as label from embeddings where label > 0)
select least(s.label, t.label) as src_label, greatest(s.label, t.label) as dst_label, count(*) as n from p a join p b using (sid) join v s on (s.x, s.y, s.z) = (a.x, a.y, a.z) join v t on (t.x, t.y, t.z) = (b.x, b.y, b.z)
where a.a = 1 and b.b = 1 group by 1, 2""",
)
def d08(spark, sf):
    v = F.col("voxel_id")
    place = [(F.floor(v / 2) % 32).cast("int").alias("x"), F.floor(v / 64).cast("int").alias("y"), (v % 2).cast("int").alias("z")]
    parcels = _maps(spark, sf).select(*place, F.when(F.col("label") > 1, F.col("label")).otherwise(0).alias("label"))
    return diffusion.connectome(_streamlines(spark, sf), parcels)


@query(
    "d10_micro_scalars",
    """with s as (select vec_id as voxel_id, abs(embedding[1])::double as fa, abs(embedding[2])::double as kfa, abs(embedding[3])::double as dp, abs(embedding[4])::double as dt from embeddings)
select voxel_id, round(sqrt(least(greatest(fa * fa + kfa * kfa * (1 - fa * fa), 0), 1)), 6) as ufa, round(dp / nullif(dt, 0), 4) as tortuosity from s""",
)
def d10(spark, sf):
    names = ["fa", "kfa", "d_par", "d_perp"]
    c = _curves(spark, sf).select("voxel_id", *[F.abs(F.get("values", F.lit(i))).alias(n) for i, n in enumerate(names)])
    return diffusion.micro_scalars(c).select("voxel_id", *_r("ufa"), F.round("tortuosity", 4).alias("tortuosity"))


@query(
    "g01_agg_voxelwise",
    """with m as (select unnest(['quantity', 'extendedprice', 'discount']) as map, unnest([l_quantity::double, l_extendedprice::double, l_discount::double]) as v from lineitem)
select map, count(v) as n_finite, round(quantile_cont(v, 0.05), 6) as p5, round(quantile_cont(v, 0.5), 6) as p50, round(quantile_cont(v, 0.95), 6) as p95 from m group by map""",
)
def g01(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_orderkey", *[F.col(f"l_{n}").alias(n) for n in ("quantity", "extendedprice", "discount")])
    return aggregate.voxelwise(aggregate.unpivot(li, ["l_orderkey"], ["quantity", "extendedprice", "discount"]), keys=["map"]).select("map", "n_finite", *_r("p5", "p50", "p95"))


@query(
    "g02_agg_parcel",
    "select l_suppkey as subject_id, l_linenumber::int as label, round(avg(l_extendedprice::double), 6) as mean, round(median(l_extendedprice::double), 6) as median, round(coalesce(stddev_samp(l_extendedprice::double), 0), 6) as sd, count(*) as n from lineitem group by 1, 2",
)
def g02(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet").select(F.col("l_suppkey").alias("subject_id"), F.col("l_linenumber").cast("int").alias("label"), F.col("l_extendedprice").cast("double").alias("value"))
    return aggregate.by_label(li, keys=["subject_id"]).select("subject_id", "label", *_r("mean", "median", "sd"), "n")


@query(
    "g03_agg_region",
    f"""with {REGION_SQL}, m as (select label + 1 as label, list_max(embedding)::double as v from embeddings)
select region, round(avg(v), 6) as mean, round(median(v), 6) as median, round(case when count(v) > 0 then coalesce(stddev_samp(v), 0) end, 6) as sd, count(v) as n from region_map left join m using (label) group by region""",
)
def g03(spark, sf):
    return aggregate.by_region(_maps(spark, sf), _region_map(spark)).select("region", *_r("mean", "median", "sd"), "n")


@query(
    "g04_agg_slice",
    """with m as (select (vec_id // 16) % 16 as y, list_max(embedding)::double as v from embeddings)
select s.slice::int as slice, round(avg(v), 6) as mean, round(median(v), 6) as median, round(quantile_cont(v, 0.25), 6) as p25, round(quantile_cont(v, 0.75), 6) as p75, count(v) as n from (select unnest(range(18)) as slice) s left join m on m.y = s.slice group by s.slice""",
)
def g04(spark, sf):
    return aggregate.by_slice(_maps(spark, sf), axis="y", n_slices=18).select("slice", *_r("mean", "median", "p25", "p75"), "n")


@query(
    "g05_region_median_curve",
    f"""with {LONG}, {REGION_SQL}, s as (select region, z, count(distinct voxel_id) as n from c join region_map using (label) group by region, z having n >= 3),
p as (select region, z, frame, median(v) as v from c join region_map using (label) semi join s using (region, z) group by region, z, frame)
select region, frame, round(median(v), 9) as value, count(*) as n_slices from p group by region, frame""",
)
def g05(spark, sf):
    found = aggregate.label_slice_median_curve(_curves(spark, sf), _region_map(spark))
    return found.select("region", F.posexplode("values").alias("frame", "value"), "n_slices").select("region", "frame", F.round("value", 9).alias("value"), "n_slices")


@query(
    "g06_paint_back",
    "select vec_id as voxel_id, label + 1 as label, round(median(list_max(embedding)::double) over (partition by label), 6) as painted from embeddings",
)
def g06(spark, sf):
    return aggregate.paint_back(_maps(spark, sf)).select("voxel_id", "label", *_r("painted"))


@query("g07_mean_curve", f"with {LONG} select label, frame, round(avg(v), 9) as value from c group by label, frame")
def g07(spark, sf):
    return aggregate.mean_curve(_curves(spark, sf), by=["label"]).select("label", F.posexplode("values").alias("frame", "value")).select("label", "frame", F.round("value", 9).alias("value"))


@query("g08_group_median_curve", f"with {LONG}, b as (select label + 1 as label from embeddings group by 1 having count(*) >= 50) select label, frame, round(median(v), 9) as value from c semi join b using (label) group by label, frame")
def g08(spark, sf):
    return aggregate.group_median_curve(_curves(spark, sf), by=["label"]).select("label", F.posexplode("values").alias("frame", "value")).select("label", "frame", F.round("value", 9).alias("value"))


@query(
    "g09_representative_voxel",
    """with m as (select vec_id as voxel_id, label + 1 as label, list_max(embedding)::double as v from embeddings), d as (select label, median(v) as med from m group by label)
select label, voxel_id, round(v, 6) as value from (select *, row_number() over (partition by label order by abs(v - med), voxel_id) as r from m join d using (label)) where r = 1""",
)
def g09(spark, sf):
    return aggregate.representative_voxel(_maps(spark, sf), by="label").select("label", "voxel_id", *_r("value"))


@query(
    "q01_cnr",
    f"""with {LONG}, s as (select voxel_id, max(v) as mx, avg(v) filter (frame < 5) as m, stddev_pop(v) filter (frame < 5) as sd from c group by voxel_id)
select voxel_id, round(coalesce((mx - m) / nullif(sd, 0), 0), 6) as cnr from s""",
)
def q01(spark, sf):
    return qc.cnr(_curves(spark, sf)).select("voxel_id", *_r("cnr"))


@query(
    "q02_cnr_summary",
    f"""with {LONG}, s as (select voxel_id, label, coalesce((max(v) - avg(v) filter (frame < 5)) / nullif(stddev_pop(v) filter (frame < 5), 0), 0) as cnr from c group by voxel_id, label)
select label, round(median(cnr), 6) as median, round(avg((cnr < 2)::int), 6) as low_share, count(*) as n, case when avg((cnr < 2)::int) > 0.5 then 'warn' else 'pass' end as status from s group by label""",
)
def q02(spark, sf):
    return qc.cnr_summary(qc.cnr(_curves(spark, sf)), by=["label"]).select("label", *_r("median", "low_share"), "n", "status")


@query(
    "q03_range_check",
    """with m as (select unnest(['quantity', 'discount', 'tax']) as map, unnest([l_quantity::double, l_discount::double, l_tax::double]) as v from lineitem), d as (select map, median(v) as md from m group by map)
select map, round(md, 6) as median, case when (map = 'quantity' and (md < 0 or md > 10)) or (map = 'discount' and (md < 0 or md > 1)) then 'warn' else 'pass' end as status from d""",
)
def q03(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_orderkey", *[F.col(f"l_{n}").alias(n) for n in ("quantity", "discount", "tax")])
    ranges = spark.createDataFrame([("quantity", 0.0, 10.0), ("discount", 0.0, 1.0)], "map string, lo double, hi double")
    return qc.range_check(aggregate.unpivot(li, ["l_orderkey"], ["quantity", "discount", "tax"]), ranges).select("map", *_r("median"), "status")


@query(
    "q06_fit_quality",
    f"""with {PATLAK}, m as (select voxel_id, avg(v) as m from c group by voxel_id), s as (select voxel_id, sum(power(v - value, 2)) as sse, sum(power(v - m, 2)) as sst from c join pred using (voxel_id, frame) join m using (voxel_id) group by voxel_id)
select voxel_id, round(1 - sse / nullif(sst, 0), 6) as r2 from s""",
)
def q06(spark, sf):
    c = _curves(spark, sf)
    i = C.input_curve(c)
    predicted = kinetics.patlak_predict(kinetics.patlak(c, i, keys=["voxel_id"]), i).select("voxel_id", "predicted")
    return qc.fit_quality(c.join(predicted, "voxel_id")).select("voxel_id", *_r("r2"))


_STATUS = "case o_orderstatus when 'F' then 'pass' when 'O' then 'fail' else 'warn' end"


@query("q07_overall_status", f"select o_custkey as subject_id, ['pass', 'warn', 'fail'][max(case {_STATUS} when 'fail' then 2 when 'warn' then 1 else 0 end) + 1] as status from orders group by o_custkey")
def q07(spark, sf):
    return qc.overall_status(_runs(spark, sf), by=["subject_id"])


def _runs(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet")
    status = F.when(F.col("o_orderstatus") == "F", "pass").when(F.col("o_orderstatus") == "O", "fail").otherwise("warn")
    stage = F.element_at(F.array(*[F.lit(x) for x in STAGES]), (F.col("o_orderkey") % 3 + 1).cast("int"))
    return o.select(F.col("o_custkey").alias("subject_id"), stage.alias("stage"), status.alias("status"), F.col("o_orderdate").alias("finished_at"), F.col("o_orderkey"))


STAGES = ["convert", "fit", "reduce"]


@query(
    "j02_pending_work",
    f"""with r as (select o_custkey as subject_id, ['convert', 'fit', 'reduce'][o_orderkey % 3 + 1] as stage, {_STATUS} as status, o_orderdate as f from orders),
l as (select * from (select *, row_number() over (partition by subject_id, stage order by f desc, status) as k from r) where k = 1),
w as (select distinct c_custkey as subject_id, s.stage, s.p from customer, (select unnest(['convert', 'fit', 'reduce']) as stage, unnest([0, 1, 2]) as p) s),
o as (select subject_id, min(p) as first from w where not exists (select 1 from l where l.subject_id = w.subject_id and l.stage = w.stage and l.status in ('pass', 'warn')) group by subject_id)
select w.subject_id, w.stage from w join o using (subject_id) where p >= first""",
)
def j02(spark, sf):
    subjects = spark.read.parquet(f"{sf}/customer.parquet").select(F.col("c_custkey").alias("subject_id"))
    return cohort.pending_work(subjects, _runs(spark, sf), STAGES)


@query(
    "j03_scan_roles",
    """with p as (select p_brand as subject_id, p_partkey as scan_id, p_name as protocol, p_type as technique, case when p_size % 5 = 0 then p_size else 1 end as n_reps, p_size as flip_deg, p_partkey % 97 as voxels, p_partkey % 3 as geom from part),
k as (select *, n_reps > 1 as dyn, contains(upper(technique), 'STEEL') as spin, contains(upper(technique), 'BRASS') and n_reps <= 1 as gre from p),
f as (select *, dyn and row_number() over (partition by subject_id order by dyn desc, n_reps desc, voxels desc, scan_id) = 1 as is_dyn, spin and row_number() over (partition by subject_id order by spin desc, voxels desc, scan_id) = 1 as is_anat from k),
d as (select subject_id, geom from f where is_dyn),
g as (select f.subject_id, f.geom, count(*) as n, count(distinct flip_deg) as a, coalesce(bool_or(f.geom = d.geom), false) as same from f left join d using (subject_id) where gre group by f.subject_id, f.geom),
s as (select subject_id, geom from (select *, row_number() over (partition by subject_id order by same desc, n desc, geom) as r from g where a >= 2) where r = 1)
select f.subject_id, scan_id, case when is_dyn then 'dynamic' when gre and s.geom is not null then 'flip' when is_anat then 'anatomical' else 'other' end as role from f left join s on s.subject_id = f.subject_id and s.geom = f.geom""",
)
def j03(spark, sf):
    p = spark.read.parquet(f"{sf}/part.parquet")
    technique = F.when(F.contains(F.upper("p_type"), F.lit("STEEL")), "RARE").when(F.contains(F.upper("p_type"), F.lit("BRASS")), "FLASH").otherwise("OTHER")
    scans = p.select(F.col("p_brand").alias("subject_id"), F.col("p_partkey").alias("scan_id"), F.lit("scan").alias("protocol"), technique.alias("technique"), F.when(F.col("p_size") % 5 == 0, F.col("p_size")).otherwise(1).alias("n_reps"),
        F.col("p_size").cast("double").alias("flip_deg"), (F.col("p_partkey") % 97).alias("voxels"), (F.col("p_partkey") % 3).alias("geom"))
    return cohort.scan_roles(scans).select("subject_id", "scan_id", "role")


_ANY = lambda column, parts: "(" + " or ".join(f"contains({column}, '{p}')" for p in parts) + ")"
#: Protocol names of parts: what their kind stands for, followed by their own names.
_PROTOCOLS = [("STEEL", "WIP hPerf "), ("BRASS", "pCASL_perf "), ("COPPER", "perf_T1 "), ("TIN", "cs_T1W_3D_TFE "), ("NICKEL", "ax VWIP T1W_3D ")]


@query(
    "j03_protocol_roles",
    f"""with p as (select p_brand as subject_id, p_partkey as scan_id, p_size as n_slices, lower(case {" ".join(f"when contains(p_type, '{k}') then '{v}'" for k, v in _PROTOCOLS)} end || p_name || case when p_size % 7 = 0 then ' Gd' else '' end) as name from part),
k as (select *, contains(name, 'hperf') or (contains(name, 'perf') and not {_ANY("name", ("casl", "qflow", "pold", "asl"))}) as d, {_ANY("name", ("3di", "3d_tfe", "t1w_3d", "3dt1"))} as strict,
    name like 'ax %' or contains(name, 'vwip') as again, not contains(name, 'gd') and (strict or (contains(name, 't1') and {_ANY("name", ("3d", "tfe"))})) as a from p),
r as (select *, d and row_number() over (partition by subject_id order by d desc, scan_id) = 1 as is_d, a and row_number() over (partition by subject_id order by a desc, strict desc, again, n_slices desc, scan_id) = 1 as is_a from k)
select subject_id, scan_id, case when is_d then 'dynamic' when is_a then 'anatomical' else 'other' end as role from r""",
)
def j03p(spark, sf):
    p = spark.read.parquet(f"{sf}/part.parquet")
    kind = F.coalesce(*[F.when(F.contains("p_type", F.lit(k)), v) for k, v in _PROTOCOLS])
    protocol = F.concat(kind, "p_name", F.when(F.col("p_size") % 7 == 0, " Gd").otherwise(""))
    scans = p.select(F.col("p_brand").alias("subject_id"), F.col("p_partkey").alias("scan_id"), protocol.alias("protocol"), F.col("p_size").alias("n_slices"))
    return cohort.protocol_roles(scans).select("subject_id", "scan_id", "role")


@query("j05_exclude_subjects", "select o_orderkey, o_custkey as subject_id from orders where o_custkey not in (select c_custkey from customer where c_nationkey < 5)")
def j05(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", F.col("o_custkey").alias("subject_id"))
    bad = spark.read.parquet(f"{sf}/customer.parquet").where("c_nationkey < 5").select(F.col("c_custkey").alias("subject_id"))
    return cohort.exclude_subjects(o, bad).select("o_orderkey", "subject_id")


_TI = [120, 300, 600, 1000, 2000, 4000, 10000]


@query(
    "s08_completeness_report",
    """with t as (select distinct l_suppkey as subject_id, [120, 300, 600, 1000, 2000, 4000, 10000][l_linenumber] as ti from lineitem)
select subject_id, count(*)::int as n_have, array_to_string(list_sort(list_filter([120, 300, 600, 1000, 2000, 4000, 10000], lambda x: not list_contains(list(ti), x))), ',') as missing, count(*) = 7 as complete from t group by subject_id""",
)
def s08(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    present = li.select(F.col("l_suppkey").alias("subject_id"), F.element_at(F.array(*[F.lit(x) for x in _TI]), F.col("l_linenumber").cast("int")).alias("ti"))
    out = cohort.completeness_report(present, _TI)
    return out.select("subject_id", "n_have", F.array_join(F.col("missing").cast("array<string>"), ",").alias("missing"), "complete")


@query(
    "s07_assemble_series",
    """with r as (select l_suppkey as subject_id, l_partkey as voxel_id, [120, 300, 600, 1000, 2000, 4000, 10000][l_linenumber] as ti, l_orderkey, l_quantity::double as v, l_orderkey % 3 as pref, l_returnflag = 'R' as geom,
    'scan_TI_' || [120, 300, 600, 1000, 2000, 4000, 10000][l_linenumber] || '_' || l_orderkey as name from lineitem where l_orderkey % 5 <> 0),
g as (select subject_id, arg_min(geom, (ti, pref, name)) as geom from r group by subject_id),
f as (select * from (select *, row_number() over (partition by subject_id, voxel_id, ti order by pref, name) as k from r semi join g using (subject_id, geom)) where k = 1)
select subject_id, voxel_id, string_agg(ti::varchar, ',' order by ti) as axis, round(sum(v + 0.5), 6) as total, count(*) >= 7 as complete from f group by subject_id, voxel_id having count(*) >= 3""",
)
def s07(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    ti = F.element_at(F.array(*[F.lit(x) for x in _TI]), F.col("l_linenumber").cast("int"))
    kind = F.when(F.col("l_orderkey") % 5 == 0, "phase").otherwise("scan")
    dynamics = F.array(F.col("l_quantity").cast("double"), F.col("l_quantity") + F.lit(0.5))
    scans = li.select(F.col("l_suppkey").alias("subject_id"), F.col("l_partkey").alias("voxel_id"), F.concat_ws("_", kind, F.lit("TI"), ti, F.col("l_orderkey")).alias("name"), (F.col("l_orderkey") % 3).alias("preference"), dynamics.cast("array<double>").alias("values"), (F.col("l_returnflag") == "R").alias("geom"))
    out = cohort.assemble_series(scans)
    axis = F.array_join(F.transform("axis_s", lambda t: F.round(t * 1000).cast("int").cast("string")), ",")
    return out.select("subject_id", "voxel_id", axis.alias("axis"), F.round(A.total(F.col("values")), 6).alias("total"), "complete")


@query(
    "s01_event_curves",
    """with e as (select user_id as voxel_id, event_type as label, date_diff('day', timestamp '2024-01-01', ts::timestamp) as frame, value::double as v from events)
select voxel_id, label, count(*) as n_frames, round(sum(s), 6) as total, round(max(s), 6) as peak from (select voxel_id, label, frame, sum(v) as s from e group by 1, 2, 3) group by 1, 2""",
)
def s01(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet")
    day = F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date"))
    long = e.groupBy(F.col("user_id").alias("voxel_id"), F.col("event_type").alias("label"), day.alias("frame")).agg(F.sum(F.col("value").cast("double")).alias("value"))
    c = C.to_curves(long, ["voxel_id", "label"])
    return c.select("voxel_id", "label", F.size("values").cast("long").alias("n_frames"), F.round(A.total(F.col("values")), 6).alias("total"), F.round(F.array_max("values"), 6).alias("peak"))

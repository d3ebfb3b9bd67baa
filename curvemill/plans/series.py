"""More registered queries: series assembly, detrending, reports. They go into the tables of plans.queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from curvemill.functions.tables import shared_path
from curvemill.operators import aggregate, aif, concentration, diffusion, filters, labels, preprocess, qc
from curvemill.plans import sql_parts
from curvemill.plans.queries import COORDS, INPUT, LONG, METRICS, _curves, _long_out, _maps, _r, _streamlines, query
from curvemill.sources import curves as C
from curvemill.sources import headers, sinks


@query(
    "b25_detrend_tail",
    f"""with {LONG}, s as (select voxel_id, regr_slope(v, frame * 2.463) as k from c where frame >= floor(64 * 0.7) group by voxel_id)
select voxel_id, frame, round(v - k * frame * 2.463, 6) as value from c join s using (voxel_id)""",
)
def b25(spark, sf):
    return _long_out(preprocess.detrend_tail(_curves(spark, sf), dt=C.DT), "values")


@query("b22_crop_to_onset", f"with {LONG}, {INPUT}, o as (select min(frame) - 1 as i0 from ca where c_a > 0.05 * (select max(c_a) from ca)), k as (select case when i0 > 0 and i0 < 59 then i0 else 0 end as i0 from o) select voxel_id, (frame - i0)::int as frame, round(v, 6) as value from c, k where frame >= i0")
def b22(spark, sf):
    c = _curves(spark, sf)
    return _long_out(preprocess.crop_to_onset(c, C.input_curve(c)), "values")


@query(
    "b24_detect_boluses",
    f"""with {LONG}, n as (select *, lag(v) over w as b, lead(v) over w as a, max(v) over (partition by voxel_id) as top from c window w as (partition by voxel_id order by frame)), m as (select voxel_id, frame, v from n where v > b and v > a and v >= 0.2 * top),
f as (select voxel_id, arg_max(frame, (v, -frame)) as f0 from m group by voxel_id), g as (select voxel_id, arg_max(m.frame, (m.v, -m.frame)) as f1 from m join f using (voxel_id) where abs(m.frame - f0) >= 3 group by voxel_id)
select e.vec_id as voxel_id, case when f0 is null then '' when f1 is null then f0::varchar else least(f0, f1) || ',' || greatest(f0, f1) end as frames from embeddings e left join f on f.voxel_id = e.vec_id left join g on g.voxel_id = e.vec_id""",
)
def b24(spark, sf):
    return _curves(spark, sf).select("voxel_id", F.array_join(preprocess.detect_boluses(F.col("values")).cast("array<string>"), ",").alias("frames"))


@query(
    "b15_trailing_artifacts",
    f"""with {LONG}, m as (select label, frame, avg(v) as v from c group by label, frame), b as (select voxel_id, frame, c.v as a, m.v as b from c join m using (label, frame)),
t as (select voxel_id, median(a) filter (frame between 32 and 60) as ma, median(b) filter (frame between 32 and 60) as mb from b group by voxel_id),
d as (select voxel_id, median(abs(a - ma)) filter (frame between 32 and 60) as da, median(abs(b - mb)) filter (frame between 32 and 60) as db from b join t using (voxel_id) group by voxel_id),
l as (select voxel_id, frame, a < least(ma - 4 * 1.4826 * da, 0.5 * ma) or b < least(mb - 4 * 1.4826 * db, 0.5 * mb) as low from b join t using (voxel_id) join d using (voxel_id)),
k as (select voxel_id, bool_or(low) filter (frame = 63) as l1, bool_or(low) filter (frame = 62) as l2, bool_or(low) filter (frame = 61) as l3 from l group by voxel_id)
select voxel_id, case when not l1 then 0 when not l2 then 1 when not l3 then 2 else 3 end::int as n_drop from k""",
)
def b15(spark, sf):
    c = _curves(spark, sf)
    mean = aggregate.mean_curve(c, by=["label"]).withColumnRenamed("values", "mean_curve")
    return c.select("voxel_id", "label", "values").join(F.broadcast(mean), "label").select("voxel_id", preprocess.trailing_artifacts(F.col("values"), F.col("mean_curve")).alias("n_drop"))


@query("a10_spike_veto", f"with {METRICS} select e.vec_id as voxel_id, coalesce(vetoed, true) as vetoed from embeddings e left join q on q.voxel_id = e.vec_id")
def a10(spark, sf):
    return aif.spike_veto(_curves(spark, sf)).select("voxel_id", "vetoed")


@query(
    "a14_vesselness",
    f"""with {LONG}, b as (select voxel_id, label, avg(v) as m from c where frame < 5 group by voxel_id, label),
p as (select c.voxel_id, c.label, max(v - m) filter (frame < 32) as e, max(v - m) filter (frame >= 32) as l, max(v - m) as p from c join b using (voxel_id) group by c.voxel_id, c.label),
q as (select label, quantile_cont(p, 0.85) as lim from p group by label)
select voxel_id, label, round(case when p > lim and p > 0 then e / greatest(l, 0.05 * p) else 0 end, 6)::double as vesselness from p join q using (label)""",
)
def a14(spark, sf):
    return aif.vesselness(_curves(spark, sf), by=["label"]).select("voxel_id", "label", *_r("vesselness"))


@query(
    "a06_select_slices",
    f"""with {LONG}, s as (select y as slice, frame, avg(v) as score from c group by y, frame), b as (select slice, max(score) as score, arg_max(frame, (score, -frame)) as frame from s group by slice),
l as (select *, case when score >= 0.2 then 0 when score >= 0.1 then 1 when score >= 0.05 then 2 else 3 end as level from b)
select slice, frame, round(score, 6) as score, rank from (select *, row_number() over (order by score desc, slice) as rank from l where level <= (select min(level) from l) and score > 0) where rank <= 3""",
)
def a06(spark, sf):
    long = C.to_long(_curves(spark, sf).withColumn("slice", F.col("y")), "slice")
    scores = long.groupBy("slice", "frame").agg(F.avg("value").alias("score"))
    return aif.select_slices(scores, thresholds=[0.2, 0.1, 0.05]).select("slice", "frame", *_r("score"), "rank")


@query(
    "c07_saturation_report",
    """with s as (select label + 1 as label, (1 - cos(radians(15)) * exp(-5.0 / (800 + 10 * (vec_id % 100)))) / (1 - exp(-5.0 / (800 + 10 * (vec_id % 100)))) as c,
    list_median(list_transform(embedding[1:5], lambda v: 100 * (1 + v::double))) as s0, list_max(list_transform(embedding, lambda v: 100 * (1 + v::double))) as top from embeddings),
l as (select label, median(c) as ceiling, median(case when s0 > 0 then s0 end) as mid from s group by label),
f as (select s.label, ceiling, top / s0 as peak from s join l using (label) where s0 > 0.25 * mid)
select label, round(ceiling, 6) as ceiling, round(ceiling / cos(radians(15)), 6) as wrap, count(*) as n, round(avg((peak > ceiling)::int), 6) as share_over, round(avg((peak >= ceiling / cos(radians(15)))::int), 6) as share_wrapped, round(median(peak), 6) as peak_p50, round(quantile_cont(peak, 0.95), 6) as peak_p95 from f group by label, ceiling""",
)
def c07(spark, sf):
    return concentration.saturation_report(_curves(spark, sf), by=["label"], flip_deg=15, tr_s=0.005).select("label", *_r("ceiling", "wrap"), "n", *_r("share_over", "share_wrapped", "peak_p50", "peak_p95"))


@query(
    "k08_ols_window",
    f"""with {LONG}, {INPUT}, {COORDS}, p as (select c.voxel_id, co.x, c.v / co.c_a as y from c join co using (frame) where frame between 20 and 59)
select voxel_id, round(regr_slope(y, x) * 6000, 6) as ki, round(regr_intercept(y, x) * 100, 6) as vb from p group by voxel_id""",
)
def k08(spark, sf):
    from curvemill.operators import kinetics

    c = _curves(spark, sf)
    return kinetics.patlak_window(c, C.input_curve(c), keys=["voxel_id"], start=20, stop=60).select("voxel_id", *_r("ki", "vb"))


@query(
    "d07_streamline_filter",
    """with p as (select l_orderkey as sid, (l_partkey % 32)::double as x, (l_partkey // 32)::double as y, (l_linenumber % 2)::double as z, (l_linenumber, l_partkey, l_suppkey) as i from lineitem),
d as (select sid, sqrt(power(x - lag(x) over w, 2) + power(y - lag(y) over w, 2) + power(z - lag(z) over w, 2)) as d from p window w as (partition by sid order by i))
select sid, round(coalesce(sum(d), 0), 6) as length from d group by sid having coalesce(sum(d), 0) >= 20""",
)
def d07(spark, sf):
    return diffusion.streamline_filter(_streamlines(spark, sf), least_length=20.0).select("sid", *_r("length"))


@query(
    "d09_connectome_groups",
    """select least(a.n_name, b.n_name) as src_group, greatest(a.n_name, b.n_name) as dst_group, count(*) as n from orders o join customer c on o_custkey = c_custkey join lineitem l on l_orderkey = o_orderkey join supplier s on l_suppkey = s_suppkey
join nation a on a.n_nationkey = c_nationkey join nation b on b.n_nationkey = s_nationkey where c_nationkey >= 3 and s_nationkey >= 3 group by 1, 2""",
)
def d09(spark, sf):
    t = lambda n: spark.read.parquet(f"{sf}/{n}.parquet")
    pairs = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("lineitem"), F.col("o_orderkey") == F.col("l_orderkey")).join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    edges = pairs.groupBy(F.col("c_nationkey").alias("src_label"), F.col("s_nationkey").alias("dst_label")).agg(F.count(F.lit(1)).alias("n"))
    groups = t("nation").select(F.col("n_nationkey").alias("label"), F.col("n_name").alias("name"))
    return diffusion.connectome_groups(edges, groups, skip=groups.where("label < 3").select("label"))


@query(
    "g07_median_maps",
    "with m as (select unnest(['discount', 'tax']) as map, unnest([l_discount::double, l_tax::double]) as v from lineitem) select map, round(median(v) filter (v <> 0), 6) as median from m group by map",
)
def g07m(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_orderkey", F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"))
    return aggregate.median_nonzero(aggregate.unpivot(li, ["l_orderkey"], ["discount", "tax"]), keys=["map"]).select("map", *_r("median"))


@query("q04_cnr_gate", f"with {LONG} select voxel_id from c group by voxel_id having coalesce((max(v) - avg(v) filter (frame < 5)) / nullif(stddev_pop(v) filter (frame < 5), 0), 0) >= 2")
def q04(spark, sf):
    return qc.cnr_gate(qc.cnr(_curves(spark, sf)), 2.0).select("voxel_id")


@query(
    "q05_conversion_summary",
    f"""with {LONG}, b as (select voxel_id, label, any_value(t1_ms) as t1, avg(v) filter (frame < 10) as base, max(v) > 0.25 as over from c group by voxel_id, label),
p as (select label, arg_max(frame, (v, -frame))::int as peak_frame from (select label, frame, avg(v) as v from c group by label, frame) group by label)
select label, count(*) as n, sum(over::int)::bigint as n_over, round(median(base), 6) as baseline, round(median(t1), 6) as t1_ms, any_value(peak_frame) as peak_frame from b join p using (label) group by label""",
)
def q05(spark, sf):
    return qc.conversion_summary(_curves(spark, sf).withColumn("conc", F.col("values")), by=["label"], most=0.25).select("label", "n", "n_over", *_r("baseline", "t1_ms"), "peak_frame")


@query(
    "r06_foreground_component",
    f"""with recursive {LONG}, e as (select voxel_id, x, y, z, avg(v) as m from c where frame < 10 group by voxel_id, x, y, z), f as (select * from e where m > 0.8 * (select quantile_cont(m, 0.99) from e)),
n as (select a.voxel_id as a, b.voxel_id as b from f a join f b on abs(a.x - b.x) + abs(a.y - b.y) + abs(a.z - b.z) = 1),
r as (select voxel_id, voxel_id as root from f union select n.b, r.root from r join n on n.a = r.voxel_id), k as (select voxel_id, min(root) as component from r group by voxel_id)
select voxel_id from k where component = (select arg_max(component, (n, -component)) from (select component, count(*) as n from k group by component))""",
)
def r06(spark, sf):
    return labels.foreground_component(_curves(spark, sf), share=0.8)


@query(
    "s02_axis_meta",
    """select p_partkey as scan_id, case when p_size <= 1 then 'static' when p_size % 3 = 0 then 'ti' else 'time' end as axis_kind,
round(case when p_size <= 1 then 0 when p_size % 3 = 0 then 0.5 else (p_size - 1) * case when p_size % 2 = 0 then 2.5 else 1 end end, 6)::double as last from part""",
)
def s02(spark, sf):
    p = spark.read.parquet(f"{sf}/part.parquet")
    none = F.lit(None).cast("array<double>")
    heads = p.select(
        F.col("p_partkey").alias("scan_id"), F.col("p_size").cast("int").alias("n"), F.when(F.col("p_size") % 3 == 0, F.array(F.lit(0.1), F.lit(0.5))).alias("InversionTimes"),
        none.alias("FlipAngles"), none.alias("TimePoints"), F.when(F.col("p_size") % 2 == 0, F.lit(2.5)).alias("dt"),
    )
    return headers.axis_of(heads).select("scan_id", "axis_kind", F.round(F.element_at("axis", -1), 6).alias("last"))


@query(
    "s03_gradient_shells",
    "select l_suppkey as subject_id, count(*) filter (l_linenumber = 1) as n_b0, array_to_string(list_sort(list(distinct (l_linenumber - 1) * 500)), ',') as shells from lineitem group by l_suppkey",
)
def s03(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    g = li.select(F.col("l_suppkey").alias("subject_id"), ((F.col("l_linenumber") - 1) * 500).cast("int").alias("bval"))
    return headers.shells(g).select("subject_id", "n_b0", F.array_join(F.col("shells").cast("array<string>"), ",").alias("shells"))


@query(
    "s03_gradients_from_files",
    """with g as (select l_suppkey as subject_id, row_number() over (partition by l_suppkey order by l_orderkey, l_linenumber, l_quantity) - 1 as dir, (l_linenumber - 1) * 500 as bval, l_quantity::double as x, l_linenumber::double as y, 1.0::double as z from lineitem)
select subject_id::varchar as subject_id, dir, bval::double as bval, round(x / sqrt(x * x + y * y + z * z), 6) as gx, round(z / sqrt(x * x + y * y + z * z), 6) as gz from g where subject_id % 7 <> 3""",
)
def s03f(spark, sf):
    """Tables of suppliers' lines as text files, those of one in seven spoilt, written to the shared folder and read back."""
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    each = F.struct("l_orderkey", "l_linenumber", ((F.col("l_linenumber") - 1) * 500).alias("b"), F.col("l_quantity").cast("double").alias("x"), F.col("l_linenumber").cast("double").alias("y"), F.lit(1.0).alias("z"))
    tables = li.groupBy(F.col("l_suppkey").alias("subject")).agg(F.array_sort(F.collect_list(each)).alias("g"))
    row = lambda c: F.array_join(F.transform("g", lambda v: v[c].cast("string")), " ")
    spoilt = F.when(F.col("subject") % 7 == 3, F.lit("x")).otherwise(F.lit(""))
    texts = F.array(F.struct(F.lit("bval").alias("kind"), F.concat(spoilt, row("b")).alias("value")), F.struct(F.lit("bvec").alias("kind"), F.concat_ws("\n", *[row(c) for c in "xyz"]).alias("value")))
    path = shared_path(spark, "gradients")
    # A folder a file: folders cost as much as the files in them.
    named = tables.select("subject", F.inline(texts)).select(F.concat_ws(".", F.col("subject").cast("string"), "kind").alias("file"), "value")
    named.repartition("file").write.partitionBy("file").text(path)
    found = headers.read_gradient_files(spark, path, pattern=r"file=([^/]+)\.(bval|bvec)/")
    return found.gradients.select("subject_id", F.col("dir").cast("long").alias("dir"), "bval", *_r("gx", "gz"))


@query(
    "s10_write_maps",
    "select 's' || l_suppkey % 5 as subject_id, 'patlak' as model, 'label' as level, l_linenumber as label, round(avg(l_quantity::double) * 2, 6) as mean, count(*) as n from lineitem group by 1, 4",
)
def s10(spark, sf):
    """Maps that are written, written again with other values by a repeated job, and read back once."""
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    maps = li.groupBy(F.concat(F.lit("s"), (F.col("l_suppkey") % 5).cast("string")).alias("subject_id"), F.col("l_linenumber").alias("label")).agg(F.avg(F.col("l_quantity").cast("double")).alias("mean"), F.count(F.lit(1)).alias("n"))
    maps = maps.withColumns({"model": F.lit("patlak"), "level": F.lit("label")})
    path = shared_path(spark, "maps")
    sinks.write_maps(maps, path)
    sinks.write_maps(maps.withColumn("mean", F.col("mean") * 2), path)
    return spark.read.parquet(path).select("subject_id", "model", "level", "label", *_r("mean"), "n")


@query(
    "s11_write_run_records",
    "select o_custkey as subject_id, case o_orderstatus when 'F' then 'load' when 'O' then 'aif' else 'kinetic' end as stage, r as run_id, count(*) as n from orders, (select unnest(['first', 'second']) as r) group by all",
)
def s11(spark, sf):
    """Two runs' records, of which the first is written twice."""
    o = spark.read.parquet(f"{sf}/orders.parquet")
    stage = F.when(F.col("o_orderstatus") == "F", "load").when(F.col("o_orderstatus") == "O", "aif").otherwise("kinetic")
    runs = o.select(F.col("o_custkey").alias("subject_id"), stage.alias("stage"), F.create_map(F.lit("order"), F.col("o_orderkey")).alias("options"))
    path = shared_path(spark, "runs")
    for run in ("first", "second", "first"):
        sinks.write_run_records(runs, path, run_id=run)
    return spark.read.parquet(path).groupBy("subject_id", "stage", "run_id").agg(F.count("options").alias("n"))


@query(
    "s05_prior_maps",
    "select p_partkey as voxel_id, round(case when p_size % 2 = 0 then p_retailprice::double * 1000 else p_retailprice::double end, 4) as t1_ms from part",
)
def s05(spark, sf):
    p = spark.read.parquet(f"{sf}/part.parquet")
    unit = F.when(F.col("p_size") % 2 == 0, "s").otherwise("ms")
    return p.select(F.col("p_partkey").alias("voxel_id"), F.round(headers.prior_ms(F.col("p_retailprice").cast("double"), unit), 4).alias("t1_ms"))


@query("g10_unit_metadata", "select vec_id as voxel_id, m as map, case m when 'mean_value' then 'mM' end as unit from embeddings, (select unnest(['mean_value', 'value']) as m)")
def g10(spark, sf):
    long = aggregate.unpivot(_maps(spark, sf), ["voxel_id"], ["mean_value", "value"])
    return aggregate.unit_metadata(long, spark.createDataFrame([("mean_value", "mM")], "map string, unit string")).select("voxel_id", "map", "unit")


@query("b06_lowpass", sql_parts.LOWPASS)
def b06(spark, sf):
    return _long_out(filters.lowpass(_curves(spark, sf).select("voxel_id", "values")), "values")


@query("b11_baseline_shift", sql_parts.BASELINE_SHIFT)
def b11(spark, sf):
    shifted = filters.baseline_shift(_curves(spark, sf).select("voxel_id", "values"))
    return shifted.select("voxel_id", "onset", F.posexplode("values").alias("frame", "value")).select("voxel_id", "onset", "frame", *_r("value"))


@query("b17_shift_curve", sql_parts.SHIFT_CURVE)
def b17(spark, sf):
    return _long_out(filters.shift_curves(_curves(spark, sf).select("voxel_id", "values"), 3.0, dt=C.DT), "values")


@query("b21_upsample", sql_parts.UPSAMPLE)
def b21(spark, sf):
    return _long_out(filters.upsample(_curves(spark, sf).select("voxel_id", "values"), 3), "values")

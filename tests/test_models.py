"""Models and operators against known truths, plain versions, and each other across subjects."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from curvemill.functions.percentiles import percentiles
from curvemill.operators import aggregate, aif, cohort, deconvolution, filters, kinetics, labels, preprocess, relaxometry, tails, transit
from curvemill.operators.fitting import MODELS, fit_model
from curvemill.sources import curves as C
from curvemill.sources import headers, sinks

T = np.arange(250) * 2.463


def bolus(t0, amp, t=T):
    u = np.maximum((t - t0) / 10, 0)
    return amp * u**3 * np.exp(3 * (1 - u))


INPUT = bolus(20, 1.5) + 0.7 * bolus(180, 1.0)


def phantom(ki, vb, seed, sd=1e-4):
    area = np.concatenate([[0], np.cumsum((INPUT[1:] + INPUT[:-1]) / 2 * np.diff(T))])
    return vb / 100 * INPUT + ki / 6000 * area + np.random.default_rng(seed).normal(0, sd, len(T))


def frame(spark, values, **columns):
    rows = [(i, None if v is None else [float(x) for x in v], *[c[i] for c in columns.values()]) for i, v in enumerate(values)]
    types = ", ".join(f"{k} {'string' if isinstance(v[0], str) else 'double'}" for k, v in columns.items())
    return spark.createDataFrame(rows, "voxel_id long, values array<double>" + (f", {types}" if types else ""))


def inputs(spark, c_a=INPUT, t=T):
    return spark.createDataFrame([([float(x) for x in c_a], [float(x) for x in t])], "c_a array<double>, t_s array<double>")


def test_deconvolution_reproduces_known_values(spark):
    got = fit_model(frame(spark, [phantom(0.20, 2.0, 7)]), inputs(spark), "deconvolve", keys=["voxel_id"], preset="legacy").first()
    assert np.allclose([got.cbf, got.mtt, got.cth], [36.53212040210995, 2.2158203604973923, 1.8593031153737407], rtol=1e-6)
    smart = fit_model(frame(spark, [phantom(0.20, 2.0, 7)]), inputs(spark), "deconvolve", keys=["voxel_id"], preset="bayes", samples=50).first()
    assert abs(smart.cbf / 36.53212040210995 - 1) < 0.05 and smart.cbf_sd > 0 and smart.mtt_sd >= 0
    assert abs(smart.cbv - 100 * np.trapezoid(phantom(0.20, 2.0, 7)) / np.trapezoid(INPUT)) < 1e-9
    with pytest.raises(ValueError):
        fit_model(frame(spark, [INPUT]), inputs(spark), "deconvolve", keys=["voxel_id"], nothing=1)


def test_diagonal_form_solves_the_normal_equations():
    o = deconvolution.prepare(INPUT, T, **{**MODELS["deconvolve"].options, "weights": 9})
    d = deconvolution._design(INPUT, T, 0.0, o["basis"], o["w"])
    design, penalty, y = deconvolution.convolution_matrix(INPUT) @ o["basis"].T, np.diff(np.eye(len(o["basis"])), axis=0), phantom(0.3, 3, 1)
    beta = y @ d["u"]
    for i in (2, 5, 8):
        a = design.T @ design + o["w"][i] ** 2 * penalty.T @ penalty
        x = np.linalg.solve(a, design.T @ y)
        mine = (beta * d["c"] / d["den"][i]) @ d["back"].T
        assert np.allclose(mine, x, atol=1e-7 * np.abs(x).max())
        assert abs(d["freedom"][i] - (len(y) - np.trace(design @ np.linalg.solve(a, design.T)))) < 1e-6
        assert abs(d["log_det"][i] - np.linalg.slogdet(a)[1]) < 1e-5
    assert np.allclose(deconvolution.spline_basis(np.arange(5.0), np.linspace(0, 3.99, 20)).sum(0), 1)


def test_delays_shift_the_input(spark):
    late = filters.shift_rows(INPUT[None, :], T, 3 * 2.463)[0]
    assert np.allclose(late[3:], INPUT[:-3], atol=1e-9)
    kernel = np.exp(-T / 5) * 0.01
    curve = lambda c: np.convolve(c, kernel)[: len(T)] * 2.463
    got = fit_model(frame(spark, [curve(INPUT), curve(late)], delay=[0.0, 3 * 2.463]), inputs(spark), "deconvolve", keys=["voxel_id"], delay_step=2.463).orderBy("voxel_id").collect()
    assert abs(got[0].cbf / got[1].cbf - 1) < 0.02 and abs(got[0].cbv / got[1].cbv - 1) < 0.02


def test_patlak_known_value_and_zeros_in_the_input(spark):
    c = frame(spark, [phantom(0.5, 2, 42)])
    assert abs(fit_model(c, inputs(spark), "patlak_legacy", keys=["voxel_id"]).first().ki - 0.4079360793498615) < 1e-9
    t = np.arange(60) * 2.0
    a = np.concatenate([np.zeros(11), bolus(4, 1.5, t[:49]) + 0.2])
    area = np.concatenate([[0], np.cumsum(a[:-1] * np.diff(t))])
    for model in ("patlak", "patlak_huber", "patlak_legacy", "patlak_tail"):
        got = fit_model(frame(spark, [0.7 / 6000 * area + 0.03 * a]), inputs(spark, a, t), model, keys=["voxel_id"]).first()
        assert abs(got.ki - 0.7) < 1e-6 and abs(got.vb - 3) < 1e-6
    spiked = 0.7 / 6000 * area + 0.03 * a
    spiked[45] += 0.05
    robust, plain = (fit_model(frame(spark, [spiked]), inputs(spark, a, t), m, keys=["voxel_id"]).first().ki for m in ("patlak_huber", "patlak"))
    assert abs(robust - 0.7) < 0.1 * abs(plain - 0.7)


def test_huber_against_a_loop(spark):
    rng = np.random.default_rng(3)
    t, a = np.arange(40) * 2.0, np.concatenate([np.zeros(5), rng.uniform(0.5, 1.5, 35)])
    y = rng.normal(0.02, 0.01, (6, 40)) + 0.01 * np.arange(40) / 40
    y[2, 20] = np.nan
    got = {r.voxel_id: (r.ki, r.vb) for r in fit_model(frame(spark, y), inputs(spark, a, t), "patlak_huber", keys=["voxel_id"]).collect()}
    with np.errstate(all="ignore"):
        x = np.concatenate([[0], np.cumsum(a[:-1] * np.diff(t))]) / a
    for i, row in enumerate(y):
        with np.errstate(all="ignore"):
            v = row / a
        ok = (a != 0) & np.isfinite(v)
        ok &= np.where(ok, x, -1) >= x[ok].max() / 3
        xs, ys = x[ok], v[ok]
        k, b = np.polyfit(xs, ys, 1)
        for _ in range(20):
            r = ys - k * xs - b
            s = 1.4826 * np.median(np.abs(r - np.median(r)))
            w = np.minimum(1, 1.345 / np.maximum(np.abs(r / s), 1e-12))
            mx, my = (w * xs).sum() / w.sum(), (w * ys).sum() / w.sum()
            new = (w * (xs - mx) * (ys - my)).sum() / (w * (xs - mx) ** 2).sum()
            stop, k = abs(new - k) < 1e-7, new
            b = my - k * mx
            if stop:
                break
        assert np.allclose(got[i], (k * 6000, b * 100), rtol=1e-8)


def test_subjects_are_fitted_apart(spark):
    other = INPUT * 2 + 0.01
    both = spark.createDataFrame([(s, [float(x) for x in a], T.tolist()) for s, a in (("a", INPUT), ("b", other))], "subject_id string, c_a array<double>, t_s array<double>")
    values = [phantom(k, 2, i) for i, k in enumerate((0.2, 0.4, 0.6))]
    rows = [(s, i, [float(x) for x in v]) for s in "ab" for i, v in enumerate(values)] + [("c", 0, [1.0] * 250), ("a", 9, None), ("b", 9, [1.0, 2.0])]
    curves = spark.createDataFrame(rows, "subject_id string, voxel_id long, values array<double>")
    for model in ("patlak", "patlak_huber", "extended_tofts", "deconvolve", "transit_spectrum"):
        got = {(r[0], r[1]): r[2] for r in fit_model(curves, both, model, keys=["subject_id", "voxel_id"]).collect()}
        alone = {s: [r[1] for r in fit_model(frame(spark, values), inputs(spark, a), model, keys=["voxel_id"]).orderBy("voxel_id").collect()] for s, a in (("a", INPUT), ("b", other))}
        assert all(np.isclose(got[s, i], alone[s][i], rtol=1e-9) for s in "ab" for i in range(3)) and got["c", 0] is None and got["a", 9] is None
    from curvemill.operators import fitting

    whole = {(r[0], r[1]): r[2] for r in fit_model(curves, both, "patlak", keys=["subject_id", "voxel_id"]).collect()}
    kept, fitting.INPUT_BYTES = fitting.INPUT_BYTES, 0
    try:
        assert {(r[0], r[1]): r[2] for r in fit_model(curves, both, "patlak", keys=["subject_id", "voxel_id"]).collect()} == whole
    finally:
        fitting.INPUT_BYTES = kept
    with pytest.raises(ValueError):
        fit_model(curves.drop("subject_id"), both, "patlak", keys=["voxel_id"])


def test_voxel_sets_of_subjects_do_not_touch(spark):
    rows = [(s, i, i, 0, 0) for s, ids in (("a", (0, 1, 5)), ("b", (1, 2, 4, 5, 6))) for i in ids]
    voxels = spark.createDataFrame(rows, "subject_id string, voxel_id long, x int, y int, z int")
    got = {(r.subject_id, r.voxel_id): r.component for r in labels.connected_components(voxels).collect()}
    assert got == {("a", 0): 0, ("a", 1): 0, ("a", 5): 5, ("b", 1): 1, ("b", 2): 1, ("b", 4): 4, ("b", 5): 4, ("b", 6): 4}
    assert {(r.subject_id, r.voxel_id) for r in labels.largest_component(voxels).collect()} == {("a", 0), ("a", 1), ("b", 4), ("b", 5), ("b", 6)}


@pytest.mark.parametrize("by", [[], ["g"], ["g", "h"]])
def test_percentiles_of_large_groups(spark, by):
    rng = np.random.default_rng(1)
    rows = [(int(g), None if g == 3 else int(i % 2), float(v)) for i, (g, v) in enumerate(zip(rng.integers(0, 4, 3000), np.concatenate([rng.normal(size=1000), np.full(900, 7.0), 10.0 ** rng.uniform(-9, 9, 1100)])))]
    rows += [(0, 0, float("nan")), (1, 1, float("inf")), (9, 9, float("nan")), (8, 8, -1.5)]
    df = spark.createDataFrame(rows, "g int, h int, value double")
    at = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.981, "e": 1.0}
    large, small = (percentiles(df, by=by, at=at, group_rows=n).toPandas() for n in (100, 10_000))
    key = lambda d: d.fillna(-99).sort_values(by).reset_index(drop=True) if by else d
    a, b = key(large), key(small)
    assert len(a) == len(b) and np.allclose(a[list(at)].to_numpy(float), b[list(at)].to_numpy(float), rtol=1e-12)
    for name, q in at.items() if not by else ():
        assert np.isclose(a[name][0], np.quantile([r[2] for r in rows if np.isfinite(r[2])], q), rtol=1e-12)


def test_transit_models_recover_truth(spark):
    t = np.arange(120) * 1.2
    c_a = bolus(6, 1.5, t) + 0.05 * (t > 6)
    f = transit.Forward(c_a, t, 20)

    def curve(residue, flow=0.01):
        return flow * np.interp(t, f.fine, f.convolve(residue[None, :])[0])

    exponential = curve(np.exp(-f.fine / 5.0))
    got = fit_model(frame(spark, [exponential]), inputs(spark, c_a, t), "mittag_leffler", keys=["voxel_id"]).first()
    assert abs(got.cbf - 60) < 2 and abs(got.alpha - 1) < 0.04 and abs(got.tau - 5) < 0.3
    wald = curve(transit.wald_survival(f.fine, 6.0, 20.0))
    got = fit_model(frame(spark, [wald], flow=[60.0]), inputs(spark, c_a, t), "inverse_gaussian", keys=["voxel_id"]).first()
    assert abs(got.mtt - 6) < 0.6 and got.e_leak < 0.02
    u = f.fine / 4.0
    h = u**4 * np.exp(4 * (1 - u))
    gamma = curve(1 - f.running(h[None, :])[0] / np.trapezoid(h, dx=f.step))
    got = fit_model(frame(spark, [gamma], flow=[60.0]), inputs(spark, c_a, t), "gamma_transit", keys=["voxel_id"]).first()
    assert abs(got.mtt - 4) < 0.7 and got.extraction < 0.02
    framed = 0.01 * 1.2 * np.convolve(c_a, np.exp(-t / 5))[: len(t)]
    got = fit_model(frame(spark, [framed]), inputs(spark, c_a, t), "transit_spectrum", keys=["voxel_id"]).first()
    assert abs(got.mtt - 5) < 1.2 and abs(got.cbf - 60) < 12
    got = fit_model(frame(spark, [exponential]), inputs(spark, c_a, t), "rate_spectrum", keys=["voxel_id"]).first()
    assert abs(got.cbv - np.trapezoid(exponential) / np.trapezoid(c_a)) < 1e-6 and abs(got.mtt - 5) < 1.5
    assert np.allclose(transit.relaxation(np.array([0.0, 0.5, 2.0]), 1.0), np.exp([0, -0.5, -2.0])) and abs(transit.relaxation(np.array([1.0]), 0.5)[0] - np.e * 0.15729920705028513) < 1e-3
    w = transit.non_negative(np.array([[1.0, 0.0], [0.0, 1.0]]), np.array([[2.0, -3.0]]), 0.0)[0]
    assert np.allclose(w, [[2.0, 0.0]])


def test_pinned_flow_is_the_deconvolved_one(spark):
    curves = frame(spark, [phantom(0.2, 2, 1), phantom(0.5, 4, 2)])
    flow = {r.voxel_id: r.cbf for r in fit_model(curves, inputs(spark), "deconvolve", keys=["voxel_id"]).collect()}
    pinned = {r.voxel_id: r.cbf for r in kinetics.pin_flow(curves, inputs(spark), "mittag_leffler", keys=["voxel_id"], factor=4).collect()}
    assert all(np.isclose(flow[i], pinned[i]) for i in flow)


def test_tails():
    assert tails.tail_frames(INPUT, T, "fixed") == (83, 250) and tails.tail_frames(INPUT[:9], T[:9]) == (0, 9)
    for mode in tails.TAILS:
        start, stop = tails.tail_frames(INPUT, T, mode)
        assert 0 <= start < stop == 250
    assert 80 < tails.tail_frames(INPUT, T, "curvature")[0] <= 200
    y = np.zeros(60)
    y[[10, 12, 30, 50]] = [5, 4, 1, 3]
    assert tails.prominent_peaks(y, prominence=2, distance=5).tolist() == [10, 50]
    t = np.arange(100.0)
    drift, own = tails.drift_slope(2 * np.exp(-0.02 * t) + 0.5 + 0.003 * t, t, "rigid", 0.6)
    assert abs(drift - 0.003) < 1e-3 and not own
    assert abs(tails.drift_slope(0.5 + 0.01 * t, t, "aif")[0] - 0.01) < 1e-12 and tails.drift_slope(np.full(100, 2.0), t, "auto") == (0.0, False)


def test_alignment_and_legacy_normalisation(spark):
    t = np.arange(80) * 2.0
    artery, vein = bolus(20, 2, t) + 0.6 * bolus(90, 1, t), bolus(26, 1, t) + 0.6 * bolus(96, 0.5, t)
    pairs = spark.createDataFrame([(vein.tolist(), artery.tolist())], "vein array<double>, artery array<double>")
    got = aif.align_to_reference(pairs, dt=2.0, rescale=True).first()
    assert abs(got.shift_s + 6) < 0.3 and abs(got.scale - 2) < 0.05 and abs(int(np.argmax(got.aligned)) - int(np.argmax(artery))) <= 1
    c = np.concatenate([np.full(20, 1.0), 1 + bolus(0, 3, np.arange(60) * 2.0)])
    out = filters.norm_legacy_shift(frame(spark, [c, np.zeros(80), [np.nan] * 80])).orderBy("voxel_id").collect()
    first = np.array(out[0]["values"])
    assert (first[:15] == 0).all() and first.min() == 0 and abs(first.max() - 3) < 0.6 and not any(out[1]["values"]) and not any(out[2]["values"])


def test_ragged_and_null_curves(spark):
    ti = [0.12, 0.3, 0.6, 1, 2, 4, 10]
    good = 1000 - 2000 * np.exp(-np.array(ti) / 1.5)
    rows = frame(spark, [good, None, good[:3], [float("nan")] * 7])
    for fit in (relaxometry.fit_recovery, relaxometry.fit_recovery_turbo):
        assert [r.t1_ms is None for r in fit(rows, ti, keys=["voxel_id"]).orderBy("voxel_id").collect()] == [False, True, True, True]
    assert filters.lowpass(rows).count() == 4 and rows.count() == filters.onset_gradient(rows.where("values is not null")).count() + 1


def test_vessels_of_a_phantom(spark):
    rng = np.random.default_rng(2)
    rows = []
    for s in "ab":
        for v in range(6 * 6 * 4):
            x, y, z = v % 6, v // 6 % 6, v // 36
            vessel = x in (2, 3) and y in (2, 3)
            curve = rng.normal(0, 0.02, 60) + (bolus(16, 6, np.arange(60) * 2.0) if vessel else bolus(40, 0.4, np.arange(60) * 2.0)) + (5 if vessel else 3)
            rows.append((s, v, x, y, z, curve.tolist()))
    c = spark.createDataFrame(rows, "subject_id string, voxel_id long, x int, y int, z int, values array<double>")
    truth = {v for v in range(144) if v % 6 in (2, 3) and v // 6 % 6 in (2, 3)}
    members, curve = aif.auto_vessel(c, dt=2.0, least=8)
    found = {}
    for r in members.collect():
        found.setdefault(r.subject_id, set()).add(r.voxel_id)
    assert all(len(found[s]) >= 8 and found[s] <= truth for s in "ab") and curve.count() == 2
    members, _ = aif.pca_vessel(c, n=6, percent=0.5)
    assert {r.voxel_id for r in members.collect()} <= truth and members.groupBy("subject_id").count().count() == 2
    peaks = c.select("subject_id", "voxel_id", "x", "y", "z", F.array_max("values").alias("value"))
    grown = aif.grow_region(peaks, spark.createDataFrame([("a", 14), ("b", 14)], "subject_id string, voxel_id long"), margin=6).collect()
    assert {r.voxel_id for r in grown if r.subject_id == "a"} == truth == {r.voxel_id for r in grown if r.subject_id == "b"}
    low = aif.top_peak(c, by=[], n=4, masked=True, band=(0.0, 0.4), n_slices=4).collect()
    assert len(low) == 8 and all(r.z < 2 and r.voxel_id in truth for r in low)


def test_ranks_continue_over_partitions(spark):
    rows = [(g, int(v)) for g, n in (("a", 500), ("b", 3)) for v in np.random.default_rng(4).permutation(n)]
    got = aif.ranked(spark.createDataFrame(rows, "g string, v int").repartition(7), ["g"], [F.desc("v")]).collect()
    assert all(r.rank == (500 if r.g == "a" else 3) - r.v for r in got) and len(got) == 503


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "h").mkdir()
    for name, h in {"a": {"n": 3, "InversionTimes": [0.1, 0.2, 0.5]}, "b": {"n": 1}, "c": {"n": 3, "RepetitionTime": 2.0, "dt": 2.5}, "d": {"n": 2, "TimePoints": [1.0, 4.0], "dt": 3.0}}.items():
        (tmp_path / "h" / f"{name}.json").write_text(json.dumps(h, indent=1))
    got = {r.path.rsplit("/", 1)[1][0]: (r.axis_kind, r.axis) for r in headers.axis_of(headers.read_headers(spark, f"file://{tmp_path}/h")).collect()}
    assert got == {"a": ("ti", [0.1, 0.2, 0.5]), "b": ("static", [0.0]), "c": ("time", [0.0, 2.5, 5.0]), "d": ("time", [1.0, 4.0])}
    bvals = spark.createDataFrame([("a", [0.0, 1000.0]), ("b", [0.0, 1000.0]), ("c", [0.0])], "subject_id string, values array<double>")
    bvecs = spark.createDataFrame([("a", [[0.0, 3.0], [0.0, 0.0], [0.0, 4.0]]), ("b", [[0.0, 0.0, 0.0], [3.0, 0.0, 4.0]]), ("c", [[1.0, 0.0, 0.0]] * 2)], "subject_id string, rows array<array<double>>")
    got = headers.read_gradients(bvals, bvecs).orderBy("subject_id", "dir").collect()
    assert [(r.subject_id, r.dir, r.gx, r.gz) for r in got] == [(s, d, 0.6 * d, 0.8 * d) for s in "ab" for d in (0, 1)]
    volumes = spark.createDataFrame([("a", [[1.0, 2.0, 3.0, 4.0], [5.0, 6.0, 7.0, 8.0]])], "subject_id string, frames array<array<double>>")
    got = C.from_dense(volumes, 2, 2).orderBy("voxel_id").collect()
    assert [(r.x, r.y, r.z, r["values"]) for r in got] == [(0, 0, 0, [1.0, 5.0]), (1, 0, 0, [2.0, 6.0]), (0, 1, 0, [3.0, 7.0]), (1, 1, 0, [4.0, 8.0])]
    maps = spark.createDataFrame([("s1", "patlak", "voxel", 1, 0.5)], "subject_id string, model string, level string, voxel_id long, value double")
    sinks.write_maps(maps, f"file://{tmp_path}/maps")
    sinks.write_maps(maps, f"file://{tmp_path}/maps")
    other = maps.withColumn("subject_id", F.lit("s2")).withColumn("value", F.lit(0.7))
    sinks.write_maps(other, f"file://{tmp_path}/maps")  # a repeated job counts once, and leaves other subjects alone
    assert sorted((r.subject_id, r.model, r.level, r.value) for r in spark.read.parquet(f"file://{tmp_path}/maps").collect()) == [("s1", "patlak", "voxel", 0.5), ("s2", "patlak", "voxel", 0.7)]
    sinks.write_maps(maps, f"file://{tmp_path}/csv", fmt="csv")
    runs = spark.createDataFrame([("s1", "fit", {"a": "1"})], "subject_id string, stage string, config map<string,string>")
    for run in ("r1", "r2", "r1"):
        sinks.write_run_records(runs, f"file://{tmp_path}/runs", run_id=run)
    assert sorted((r.run_id, r.config) for r in spark.read.parquet(f"file://{tmp_path}/runs").collect()) == [("r1", '{"a":"1"}'), ("r2", '{"a":"1"}')]
    spark.createDataFrame([(1, 2.0)], "voxel_id long, values double").write.parquet(f"file://{tmp_path}/scalar")
    assert C.read_curves(spark, f"file://{tmp_path}/scalar").first()["values"] == [2.0]


def test_new_files_are_converted_once(spark, tmp_path):
    from curvemill.streaming import ingest

    source, target, checkpoint = (f"file://{tmp_path}/{n}" for n in ("in", "out", "state"))
    for k in (1, 2):
        spark.createDataFrame([(k, [1.0 * k])], "voxel_id long, values array<double>").write.mode("append").parquet(source)
        ingest.convert_new(spark, source, target, checkpoint, lambda df: df.withColumn("peak", F.array_max("values"))).awaitTermination(60)
    assert sorted((r.voxel_id, r.peak) for r in spark.read.parquet(target).collect()) == [(1, 1.0), (2, 2.0)]


def test_stages_wait_for_what_they_need(spark):
    subjects = spark.createDataFrame([("a",), ("b",), ("c",)], "subject_id string")
    done = [(s, "pass", 1) for s in cohort.STAGES]
    rows = [("a", *d) for d in done] + [("a", "aif", "fail", 2)] + [("b", *d) for d in done]
    runs = spark.createDataFrame(rows, "subject_id string, stage string, status string, finished_at int")
    left = {}
    for r in cohort.pending_work(subjects, runs, cohort.STAGES).collect():
        left.setdefault(r.subject_id, set()).add(r.stage)
    assert left == {"a": {"aif", "normalisation", "kinetic", "aggregation"}, "c": set(cohort.STAGES)}


def test_region_tables(spark):
    maps = spark.createDataFrame([("a", 1, 2.0), ("a", 1, 4.0), ("b", 0, 1.0)], "subject_id string, label int, value double")
    names = spark.createDataFrame([(1,), (2,)], "label int")
    got = {(r.subject_id, r.label): r.n for r in aggregate.by_label(maps, keys=["subject_id"], labels=names).collect()}
    assert got == {("a", 1): 2, ("a", 2): 0, ("b", 0): 1}
    region = spark.createDataFrame([("R", 1), ("E", 7)], "region string, label int")
    got = {(r.subject_id, r.region): (r.n, r.mean) for r in aggregate.by_region(maps, region).collect()}
    assert got == {("a", "R"): (2, 3.0), ("a", "E"): (0, None), ("b", "R"): (0, None), ("b", "E"): (0, None)}
    series = spark.createDataFrame([([1.0, 2.0, 3.0], [5.0] * 3), ([0.0, 1.0, 2.0], [5.0] * 3), ([9.0, 1.0, 2.0], [5.0] * 3), (None, [5.0] * 2)], "axis array<double>, values array<double>")
    assert [r.axis for r in relaxometry.resolve_axis(series, [0.1, 0.2, 0.3]).collect()] == [[1.0, 2.0, 3.0], [0.1, 0.2, 0.3], [9.0, 1.0, 2.0], None]
    c = frame(spark, [[0, 1, 5, 1, 0], [3, 3, 3, 3, 3]])
    assert [r.peak_frame for r in preprocess.peak_time_subsample(c).orderBy("voxel_id").collect()] == [2.0, 0.0]


def test_non_negative_least_squares_is_optimal():
    from itertools import combinations

    from curvemill.operators.transit import non_negative

    rng = np.random.default_rng(5)
    for m, n in ((4, 6), (9, 5), (5, 5)):
        a, b = rng.normal(size=(m, n)), rng.normal(size=(60, m))
        for ridge in (0.0 if m >= n else 1e-3, 0.1):
            w, missed = non_negative(a, b, ridge)
            assert (w >= 0).all() and missed.max() < 1e-8
            for x, y in zip(w, b):  # no other set of columns does better
                cost = lambda v: ((a @ v - y) ** 2).sum() + ridge * (v**2).sum()  # noqa: B023, E731
                best = cost(np.zeros(n))
                for k in range(1, n + 1):
                    for s in combinations(range(n), k):
                        part = a[:, s]
                        v = np.zeros(n)
                        v[list(s)] = np.linalg.lstsq(np.vstack([part, np.sqrt(ridge) * np.eye(k)]), np.concatenate([y, np.zeros(k)]), rcond=None)[0]
                        if (v >= 0).all():
                            best = min(best, cost(v))
                assert abs(cost(x) - best) < 1e-9
    # Nearly equal columns, targets of 0 and without numbers, and copies of a column.
    s, r = np.geomspace(1e-3, 5, 36), np.geomspace(1e-3, 1, 64)
    poles = 1 / np.add.outer(s, r)
    truth = np.zeros((40, 64))
    for row in truth:
        row[rng.choice(64, 3, replace=False)] = rng.random(3)
    b = truth @ poles.T * (1 + 1e-3 * rng.normal(size=(40, 36)))
    b[3], b[4] = 0.0, np.nan
    w, missed = non_negative(poles, b, 1e-9)
    assert np.isnan(w[4]).all() and (w[3] == 0).all() and np.nanmax(missed) < 1e-6
    ok = np.arange(40) > 4
    assert (((w @ poles.T - b) ** 2).sum(1) <= ((truth @ poles.T - b) ** 2).sum(1) * (1 + 1e-9) + 1e-12)[ok].all()
    double = np.hstack([poles[:, :5], poles[:, :5]])
    w, missed = non_negative(double, b[ok], 1e-9)
    assert (w >= 0).all() and missed.max() < 1e-6
    # One row alone gives what it gives among others.
    alone = np.vstack([non_negative(poles, x[None, :], 1e-9)[0] for x in b[ok]])
    assert np.allclose(alone @ poles.T, non_negative(poles, b[ok], 1e-9)[0] @ poles.T, rtol=1e-6)


def test_gradient_files(spark, tmp_path):
    texts = {
        "a.bval": "0 1000\n", "a.bvec": "0 3\n0 0\n0 4\n", "b.bvals": "0\r\n1000\r\n", "b.bvecs": "0,0,0\n\n3, 0,\t4\n", "c.bval": "0 x", "c.bvec": "0 0\n0 0\n0 1", "d.bval": "0 1", "e.bval": "0 1 2",
        "e.bvec": "1 0\n1 0\n1 0", "f.bval": "0 1", "f.bvec": "1 0\n1\n1 0", "g.bval": " \n", "g.bvec": "1\n0\n0", "h.bval": "5", "h.bvals": "5", "h.bvec": "1\n0\n0", "i.bval": "0 1", "i.bvec": "1 0\n1 0\n1 0", "j.bval": "nan", "j.bvec": "1\n0\n0", "notes.txt": "1",
    }
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    frames = spark.createDataFrame([(s, 4 if s == "i" else 2) for s in "abcdefhi"], "subject_id string, n int")
    found = headers.read_gradient_files(spark, f"file://{tmp_path}/*", frames=frames)
    got = [(r.subject_id, r.dir, r.bval, round(r.gx, 9), round(r.gz, 9)) for r in found.gradients.orderBy("subject_id", "dir").collect()]
    assert got == [("a", 0, 0.0, 0.0, 0.0), ("a", 1, 1000.0, 0.6, 0.8), ("b", 0, 0.0, 0.0, 0.0), ("b", 1, 1000.0, 0.6, 0.8)]
    rejects = {(r.path.rsplit("/", 1)[1], r.reason) for r in found.rejects.collect()}
    assert rejects == {
        ("c.bval", "not a number"), ("c.bvec", "no partner"), ("d.bval", "no partner"), ("e.bval", "lengths differ"), ("e.bvec", "lengths differ"), ("f.bval", "no partner"), ("f.bvec", "rows of unequal length"), ("g.bval", "empty"), ("g.bvec", "no partner"),
        ("h.bval", "more than one partner"), ("h.bvals", "more than one partner"), ("h.bvec", "more than one partner"), ("i.bval", "not as long as the series"), ("i.bvec", "not as long as the series"), ("j.bval", "not a number"), ("j.bvec", "no partner"), ("notes.txt", "not a gradient file's name"),
    }


def test_many_gradient_files_are_few_tasks(spark, tmp_path):
    for i in range(60):
        at = tmp_path / f"group{i % 3}" / f"s{i}"
        at.mkdir(parents=True)
        (at / f"s{i}.bval").write_text("0 1000")
        (at / f"s{i}.bvec").write_text("0 3\n0 0\n0 4")
    confs = {"spark.sql.files.maxPartitionBytes": "4m", "spark.sql.files.openCostInBytes": "4m"}
    kept = {k: spark.conf.get(k) for k in confs}
    context = spark.sparkContext
    context.setJobGroup("gradients", "gradients")
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        found = headers.read_gradient_files(spark, f"file://{tmp_path}")
        assert spark.conf.get("spark.sql.files.openCostInBytes") == "4m"
        stages = [s for j in context.statusTracker().getJobIdsForGroup("gradients") for s in context.statusTracker().getJobInfo(j).stageIds]
        assert 0 < max(context.statusTracker().getStageInfo(s).numTasks for s in stages) < 20
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
        context._jsc.clearJobGroup()
    assert found.gradients.count() == 120 and found.rejects.count() == 0

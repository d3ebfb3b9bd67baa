"""Cohorts: failures that stay with their subjects, results that don't depend on partitions, subjects kept apart."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from curvemill.operators import cohort, deconvolution, diffusion, fitting, transit  # noqa: F401  (they register their models)
from curvemill.operators.fitting import MODELS, Model, fit_model, register_model
from curvemill.plans import models, queries, series  # noqa: F401  (they register queries)
from tests.conftest import rows


def _curves(spark, subjects, voxels, frames=20):
    rng = np.random.default_rng(4)
    data = [(f"s{s}", v, [float(x) for x in rng.random(frames) + 0.2]) for s in range(subjects) for v in range(voxels)]
    return spark.createDataFrame(data, "subject_id string, voxel_id long, values array<double>")


def _inputs(spark, subjects, frames=20):
    t = np.arange(frames) * 2.0
    data = [(f"s{s}", [float(x) for x in np.exp(-t / 9) * t + 0.1 + s / 100], t.tolist()) for s in range(subjects)]
    return spark.createDataFrame(data, "subject_id string, c_a array<double>, t_s array<double>")


@pytest.fixture
def model(request):
    """A model that is registered for one test."""

    def add(prepare, kernel, **more):
        register_model("_test", Model(("mean",), prepare, kernel, **more))
        request.addfinalizer(lambda: MODELS.pop("_test"))

    return add


def test_errors_stay_with_their_curves(spark, model):
    def prepare(c_a, t):
        if c_a[0] > 0.115:
            raise KeyError("spoilt input")
        return None if c_a[0] > 0.105 else {}

    def kernel(values, c, carried):
        if (values > 5).any():
            raise np.linalg.LinAlgError("singular")
        return {"mean": values.mean(1)}

    model(prepare, kernel)
    curves = _curves(spark, 4, 30).where("subject_id <> 's3' or voxel_id < 5")
    spoilt = curves.withColumn("values", F.when(F.expr("subject_id = 's0' and voxel_id = 7"), F.array_repeat(F.lit(9.0), 20)).when(F.expr("subject_id = 's0' and voxel_id = 8"), F.lit(None)).otherwise(F.col("values")))
    inputs = _inputs(spark, 3)
    found = {(r.subject_id, r.voxel_id): r for r in fit_model(spoilt, inputs, "_test", keys=["subject_id", "voxel_id"], errors=True).collect()}
    want = {(r.subject_id, r.voxel_id): float(np.mean(r["values"])) for r in curves.collect()}
    for (s, v), r in found.items():
        said = {"s1": "the input curve allows no fit", "s2": "KeyError: 'spoilt input'", "s3": "no input curve"}.get(s) or {7: "LinAlgError: singular", 8: "no curve"}.get(v)
        assert r.error == said and ((r["mean"] is None) if said else abs(r["mean"] - want[s, v]) < 1e-12)
    assert len(found) == 95
    # Without the column, only unsolvable equations are forgiven.
    quiet = fit_model(spoilt.where("subject_id = 's0'"), inputs, "_test", keys=["subject_id", "voxel_id"]).where("mean is null")
    assert sorted(r.voxel_id for r in quiet.collect()) == [7, 8]
    with pytest.raises(Exception, match="spoilt input"):
        fit_model(curves, inputs, "_test", keys=["subject_id", "voxel_id"]).collect()


def test_subjects_are_prepared_once(spark, model, tmp_path):
    log = tmp_path / "prepared"

    def prepare(c_a, t):
        with open(log, "a") as f:
            f.write(f"{c_a[0]}\n")
        return {}

    model(prepare, lambda values, c, carried: {"mean": values.mean(1)}, dear=True, batch=16)
    n = 120
    curves = _curves(spark, n, 12, frames=4).orderBy(F.xxhash64("voxel_id", "subject_id")).repartition(6)
    hot = curves.unionByName(_curves(spark, 1, 700, frames=4).where("voxel_id >= 12"))  # one subject with a third of all
    found = fit_model(hot, _inputs(spark, n, 4), "_test", keys=["subject_id", "voxel_id"])
    assert found.count() == hot.count() and found.where("mean is not null").count() == hot.count()
    log.write_text("")
    found.write.format("noop").mode("overwrite").save()
    prepared = log.read_text().split()
    assert len(set(prepared)) == n and len(prepared) <= n + 8  # a subject at the edge of a task is in two


def test_poisoned_subject_leaves_the_others_alone(spark, sf):
    clean = models._run(spark, sf, models._cohort(spark, sf))
    report = {(r.subject_id, r.model): r for r in queries.QUERIES["j01_cohort_report"](spark, sf).collect()}
    assert {k: r.status for k, r in report.items()} == {(s, m): "failed" if s == "s1" else "ok" for s in ("s0", "s1", "s2") for m in ("patlak", "deconvolve")}
    poisoned = models._run(spark, sf, models._cohort(spark, sf), lost="s1")
    others = lambda run: rows(run.maps.where("subject_id <> 's1'").select("subject_id", "model", "map", "region", "n", F.round("mean", 6).alias("mean"), F.round("median", 6).alias("median")).toPandas())
    assert others(clean) == others(poisoned)
    assert poisoned.maps.where("subject_id = 's1' and n > 0").count() == 0
    assert clean.report.where("status <> 'ok'").count() == 0
    gone = spark.createDataFrame([("s2",)], "subject_id string")
    c = models._cohort(spark, sf).withColumn("t_s", F.transform("values", lambda v, i: i * F.lit(2.0)))
    run = cohort.run_cohort(c.select("subject_id", "voxel_id", "signal", "t_s"), c.where("subject_id <> 's0'").select("subject_id", "voxel_id", "t1_ms", "m0"), c.select("subject_id", "voxel_id", "label"), models._region_map(spark), flip_deg=15, tr_s=0.005, models=["patlak"], exclude=gone)
    assert {(r.subject_id, r.status, r.error) for r in run.report.collect()} == {("s0", "failed", "no curves left to fit"), ("s1", "ok", None)}


@pytest.mark.parametrize("name", ["k15_deconvolve_sampled", "k15_deconvolve_sd", "k04_patlak_huber", "k17_extended_tofts", "k23_transit_spectrum", "k22_rate_spectrum", "d08_connectome_cohort", "a06_select_slices_cohort"])
def test_partitions_do_not_matter(spark, sf, name, monkeypatch):
    real = models.C.embedding_curves
    found = []
    for n in (1, 4, 64):
        for module in (models, queries):
            monkeypatch.setattr(module.C, "embedding_curves", lambda *a, n=n: real(*a).repartition(n))
        found.append(rows(queries.QUERIES[name](spark, sf).toPandas()))
    assert found[0] == found[1] == found[2] and found[0]


def test_sampled_deviations(spark):
    """Draws of normal numbers are normal, apart for each seed, and the sampled deviation of a flow agrees with the closed form."""
    z = deconvolution.normals(np.arange(500), 1, 2001)
    assert z.shape == (500, 2001) and abs(z.mean()) < 0.005 and abs(z.std() - 1) < 0.005 and abs((z**4).mean() - 3) < 0.05
    assert np.abs(np.corrcoef(z[:20])[np.triu_indices(20, 1)]).max() < 0.12
    u = deconvolution.uniforms(np.array([3, 3, 4]), 0, 1000)
    assert (u[0] == u[1]).all() and (u[0] != u[2]).any() and 0 < u.min() and u.max() < 1
    t = np.arange(60) * 1.5
    c_a = (t**3 * np.exp(-t / 2.5))
    c_a = c_a / c_a.max()
    rng = np.random.default_rng(1)
    true = deconvolution.convolution_matrix(c_a) @ (0.01 * np.exp(-t / 5)) * 1.5
    values = true + rng.normal(0, true.max() / 60, (50, 60))
    curves = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(values)], "voxel_id long, values array<double>")
    inputs = spark.createDataFrame([(c_a.tolist(), t.tolist())], "c_a array<double>, t_s array<double>")
    fit = lambda **o: fit_model(curves, inputs, "deconvolve", keys=["voxel_id"], preset="bayes", **o).toPandas().set_index("voxel_id").sort_index()
    closed, drawn, more = fit(), fit(samples=400), fit(samples=4000)
    assert (drawn.cbf == closed.cbf).all() and drawn.cbf_sd.notna().all() and drawn.mtt_sd.notna().all() and drawn.cth_sd.notna().all()
    assert np.median(np.abs(drawn.cbf_sd / more.cbf_sd - 1)) < 0.08  # it settles
    assert 0.5 < np.median(drawn.cbf_sd / closed.cbf_sd) < 2.5


def test_streamlines_of_subjects_stay_apart(spark):
    p = lambda *q: [{"x": float(a), "y": 0.0, "z": 0.0} for a in q]
    kind = "array<struct<x: double, y: double, z: double>>"
    lines = spark.createDataFrame([("a", 1, p(0, 1, 2)), ("b", 1, p(0, 2)), ("b", 2, p(2, 0)), ("a", 3, p(5, 6)), ("b", 4, p(0, 0))], f"subject_id string, sid long, points {kind}")
    parcels = spark.createDataFrame([("a", 0, 0, 0, 1), ("a", 2, 0, 0, 2), ("b", 0, 0, 0, 7), ("b", 2, 0, 0, 7), ("b", 1, 0, 0, 0)], "subject_id string, x int, y int, z int, label int")
    edges = {tuple(r) for r in diffusion.connectome(lines, parcels).collect()}
    assert edges == {("a", 1, 2, 1), ("b", 7, 7, 3)}
    density = {tuple(r) for r in diffusion.track_density(lines).collect()}
    assert ("a", 0, 0, 0, 1) in density and ("b", 0, 0, 0, 3) in density and len(density) == 7
    kept = {(r.subject_id, r.sid) for r in diffusion.streamline_filter(lines, least_length=0.5, most=1).collect()}
    assert kept == {("a", 1), ("b", 1)}
    groups = spark.createDataFrame([(1, "p"), (2, "q"), (7, "p")], "label int, name string")
    found = {tuple(r) for r in diffusion.connectome_groups(diffusion.connectome(lines, parcels), groups, skip=groups.where("label = 99").select("label")).collect()}
    assert found == {("a", "p", "q", 1), ("b", "p", "p", 3)}

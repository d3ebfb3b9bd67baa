import numpy as np
import pytest

from curvemill.plans import queries as Q
from curvemill.plans import models, series  # noqa: F401
from tests.conftest import rows


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_matches_sql(name, spark, sf, duck):
    ours, theirs = Q.QUERIES[name](spark, sf).toPandas(), duck.sql(Q.SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)


@pytest.mark.parametrize("name", sorted(set(Q.QUERIES) - set(Q.SQL)))
def test_runs(name, spark, sf):
    assert Q.QUERIES[name](spark, sf).limit(5).count() > 0


def _frame(spark, values):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(values)], "voxel_id long, values array<double>")


def _input(spark, t, c_a):
    return spark.createDataFrame([([float(x) for x in c_a], [float(x) for x in t])], "c_a array<double>, t_s array<double>")


def _bolus(t, t0, amp):
    u = np.maximum((t - t0) / 10, 0)
    return amp * u**3 * np.exp(3 * (1 - u))


def test_models_recover_truth(spark):
    from curvemill.operators import kinetics

    t = np.arange(120) * 2.0
    c_a = _bolus(t, 20, 1.5) + 0.7 * _bolus(t, 80, 1.0) + 0.05
    area = np.concatenate([[0], np.cumsum(c_a[:-1] * np.diff(t))])
    truth = [(0.5, 2.0), (1.0, 5.0), (0.0, 3.0)]
    curves = _frame(spark, [ki / 6000 * area + vb / 100 * c_a for ki, vb in truth])
    ols = {r.voxel_id: (r.ki, r.vb) for r in kinetics.patlak(curves, _input(spark, t, c_a), keys=["voxel_id"]).collect()}
    huber = {r.voxel_id: (r.ki, r.vb) for r in kinetics.fit_model(curves, _input(spark, t, c_a), "patlak_huber", keys=["voxel_id"]).collect()}
    for i, want in enumerate(truth):
        assert np.allclose(ols[i], want, atol=1e-6) and np.allclose(huber[i], want, atol=1e-6)
    k_trans, vp, kep = 0.002, 0.05, 0.02
    basis = kinetics.trapezoid_exponential(c_a, t, np.array([kep]))[:, 0]
    fit = kinetics.fit_model(_frame(spark, [vp * c_a + k_trans * basis]), _input(spark, t, c_a), "extended_tofts", keys=["voxel_id"]).first()
    assert abs(fit.ktrans / 6000 - k_trans) < 2e-5 and abs(fit.vp - vp) < 2e-3 and abs(fit.kep / 60 - kep) < 5e-4
    flow, mtt = 0.01, 6.0
    lag = np.arange(len(t))[:, None] - np.arange(len(t))[None, :]
    op = np.where(lag >= 0, c_a[np.clip(lag, 0, None)], 0) * 2.0
    fit = kinetics.fit_model(_frame(spark, [op @ (flow * np.exp(-t / mtt))]), _input(spark, t, c_a), "deconvolve", keys=["voxel_id"]).first()
    assert abs(fit.cbf * 1.04 / 6000 - flow) < 0.15 * flow


def test_recovery_fit(spark):
    from curvemill.operators import relaxometry

    ti = [0.12, 0.3, 0.6, 1, 2, 4, 10]
    fit = relaxometry.fit_recovery(_frame(spark, [1000 - 2000 * np.exp(-np.array(ti) / 1.5)]), ti, keys=["voxel_id"]).first()
    assert abs(fit.t1_ms - 1500) < 5 and abs(fit.m0 - 1000) < 2


def test_tensor_of_an_isotropic_signal(spark):
    from curvemill.operators import diffusion

    g = Q._gradients(spark)
    b = np.array([r.bval for r in g.orderBy("dir").collect()])
    fit = diffusion.fit_tensor(_frame(spark, [100 * np.exp(-b * 1e-3)]), g, keys=["voxel_id"]).first()
    assert fit.fa < 1e-3 and abs(fit.md - 1e-3) < 1e-6


def test_known_cnr(spark):
    from curvemill.operators import qc

    got = [r.cnr for r in qc.cnr(_frame(spark, [[1, -1, 1, -1, 0, 10, 4, 2], [0, 0, 0, 5, 2]]), baseline=5).orderBy("voxel_id").collect()]
    assert abs(got[0] - 10 / np.std([1, -1, 1, -1, 0])) < 1e-9
    assert [r.cnr for r in qc.cnr(_frame(spark, [[0, 0, 0, 5, 2]]), baseline=3).collect()] == [0.0]


def test_onset_and_peaks_against_loops(spark):
    from pyspark.sql import functions as F

    from curvemill.operators import preprocess

    rng = np.random.default_rng(0)
    values = rng.normal(size=(20, 40)).cumsum(axis=1)
    got = _frame(spark, values).select("voxel_id", preprocess.onset_walk(F.col("values")).alias("o"), preprocess.major_peaks(F.col("values")).alias("p")).collect()
    for r in got:
        v = values[r.voxel_id]
        base = v[3:9]
        limit = base.mean() + max(4 * base.std(), 0.05 * np.ptp(v), 5e-4)
        walk = next((max(f - 1, 3) for f in range(8, 38) if (v[f : f + 3] > limit).all()), 8)
        assert r.o == walk
        kept = []
        for f in sorted((f for f in range(1, 39) if v[f] > v[f - 1] and v[f] > v[f + 1]), key=lambda f: (-v[f], f)):
            if len(kept) < 2 and all(abs(f - k) >= 10 for k in kept):
                kept.append(f)
        assert [p.frame for p in r.p] == kept


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_without_the_corpus_modules(tmp_path):
    """A copy that lacks them still registers the rest."""
    import os
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for left in ([], ["corpus_pipeline.py"]):
        copy = tmp_path / f"copy{len(left)}"
        shutil.copytree(f"{root}/curvemill", copy / "curvemill", ignore=shutil.ignore_patterns("llm", "__pycache__"))
        for name in ["__spark_entry__.py", *left]:
            if os.path.exists(f"{root}/{name}"):
                shutil.copy(f"{root}/{name}", copy)
        code = "import __spark_entry__ as e; q = e.queries(); assert 'k02_patlak_ols' in q and not [n for n in q if n.startswith(('op', 'pipeline'))]; e.oracle_sql()"
        subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, env=os.environ | {"PYTHONPATH": ""})


def test_filters(spark):
    from curvemill.operators import filters

    b, a = filters.butterworth()
    assert abs(b.sum() / a.sum() - 1) < 1e-12
    half = np.exp(1j * 2 * np.pi * 4 / 15)
    assert abs(abs(np.polyval(b[::-1], 1 / half) / np.polyval(a[::-1], 1 / half)) - np.sqrt(0.5)) < 1e-9
    m = filters.zero_phase_matrix(60)
    t = np.arange(60)
    assert np.allclose(m @ np.ones(60), 1) and np.allclose(m @ t, t, atol=2e-3)
    slow, fast = np.sin(2 * np.pi * 0.5 * t / 15), np.sin(2 * np.pi * 7 * t / 15)
    assert np.abs(m @ slow - slow).max() < 0.05 and np.abs(m @ fast)[12:-12].max() < 0.02


def test_pchip_keeps_shape(spark):
    from curvemill.operators import filters

    rng = np.random.default_rng(1)
    x = np.cumsum(rng.uniform(0.5, 2, 30))
    y = np.cumsum(rng.uniform(0, 1, (3, 30)), axis=1)
    fine = np.linspace(x[0], x[-1], 500)
    got = filters.pchip(x, y, fine)
    assert np.allclose(filters.pchip(x, y, x), y) and (np.diff(got, axis=1) >= -1e-12).all()
    assert np.allclose(filters.pchip(x, 2 * x[None, :] + 1, fine), 2 * fine + 1)
    shifted = filters.shift_curves(_frame(spark, [np.arange(10)]), 2.0, dt=1.0).first()["values"]
    assert np.allclose(shifted, [0, 0, 0, 1, 2, 3, 4, 5, 6, 7])
    assert len(filters.upsample(_frame(spark, [[0, 1, 4]]), 4).first()["values"]) == 9


def test_turbo_recovery(spark):
    from curvemill.operators import relaxometry

    ti = np.array([0.12, 0.3, 0.6, 1, 2, 4, 10])
    signal = 1000 * relaxometry.turbo_readout(ti, np.array([1.5]))[:, 0]
    fit = relaxometry.fit_recovery_turbo(_frame(spark, [signal]), ti.tolist(), keys=["voxel_id"]).first()
    assert abs(fit.t1_ms - 1500) < 5 and abs(fit.m0 - 1000) < 3

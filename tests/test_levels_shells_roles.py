"""Distance shells, summaries of all levels, the layout check and roles by protocol names against plain versions."""

import numpy as np
import pytest

from curvemill.operators import aggregate, aif, cohort, labels

MM = (0.4, 0.7, 1.3)


def plain_shell(volume, mask, limit):
    out = {}
    for p in volume:
        other = [q for q in volume if (q in mask) != (p in mask)]
        if other:
            d = np.sqrt(((np.subtract(other, p) * MM) ** 2).sum(1)).min()
            if d <= limit + 1e-12:
                out[p] = -d if p in mask else d
    return out


def test_mask_shell_by_distance(spark):
    rng = np.random.default_rng(5)
    shape = (7, 6, 5)
    places = [tuple(int(i) for i in p) for p in np.ndindex(shape)]
    # A full box, one with missing voxels and a mask of loose parts, an empty mask, a mask that fills the volume.
    volumes = {"a": set(places), "b": {p for p in places if rng.random() < 0.8}, "c": set(places[:40]), "d": set(places[:40])}
    masks = {"a": {p for p in places if 1 <= p[0] <= 5 and 1 <= p[1] <= 4 and p[2] <= 3}, "b": {p for p in volumes["b"] if rng.random() < 0.5}, "c": set(), "d": volumes["d"]}
    number = {p: i for i, p in enumerate(places)}
    volume = spark.createDataFrame([(s, number[p], *p) for s, v in volumes.items() for p in v], "subject_id string, voxel_id long, x int, y int, z int")
    mask = spark.createDataFrame([(s, number[p], None) for s, v in masks.items() for p in v] * 2, "subject_id string, voxel_id long, x int")
    for limit in (0.0, 0.7, 1.5):
        got = {(r.subject_id, r.voxel_id): r.distance for r in labels.mask_shell(volume, mask, limit=limit, mm=MM).collect()}
        want = {(s, number[p]): d for s in volumes for p, d in plain_shell(volumes[s], masks[s], limit).items()}
        assert got.keys() == want.keys() and all(abs(got[k] - d) < 1e-9 for k, d in want.items())
    assert {(r.x, r.y, r.z): r.distance for r in labels.within_distance(spark.createDataFrame([(0, 0, 0)], "x int, y int, z int"), limit=1.0).collect()} == {
        (0, 0, 0): 0.0, **{s: 1.0 for s in labels._STEPS}
    }
    assert labels.within_distance(volume.limit(0), limit=2.0).count() == 0


def test_vessels_are_looked_for_in_the_shell(spark):
    t = np.arange(40)
    bolus = np.where(t > 5, (t - 5) * np.exp(-(t - 5) / 3.0), 0)
    rng = np.random.default_rng(0)
    rows, mask = [], []
    for s in ("a", "b"):
        for i, (x, y, z) in enumerate(np.ndindex(10, 10, 6)):
            deep = 4 <= x <= 5 and 4 <= y <= 5 and 2 <= z <= 3
            rim = x == 1 and 3 <= y <= 6 and 2 <= z <= 3
            curve = 5 + (8 if deep else 5 if rim else 0.2) * bolus * (1 + 0.01 * rng.random()) + 0.01 * rng.random(40)
            rows.append((s, i, int(x), int(y), int(z), curve.tolist()))
            if s == "a" and 2 <= x <= 8 and 1 <= y <= 8 and 1 <= z <= 4:
                mask.append((s, i))
    curves = spark.createDataFrame(rows, "subject_id string, voxel_id long, x int, y int, z int, values array<double>")
    found, _ = aif.pca_vessel(curves, n=4, components=1, floor=0.0, mask=spark.createDataFrame(mask, "subject_id string, voxel_id long"), shell_mm=1.0)
    where = {s: {(r.x, r.y, r.z) for r in curves.join(found, ["subject_id", "voxel_id"]).where(f"subject_id = '{s}'").collect()} for s in "ab"}
    assert len(where["a"]) == 4 and all(p[0] == 1 for p in where["a"])  # on the surface
    assert len(where["b"]) == 4 and all(4 <= p[0] <= 5 for p in where["b"])  # without a mask, the highest


@pytest.mark.parametrize("group_rows", [None, 7])
def test_levels_are_those_of_the_single_summaries(spark, group_rows):
    rng = np.random.default_rng(3)
    rows = [(f"s{i % 2}", "m" if i % 3 else None, int(rng.integers(0, 4)), int(rng.integers(0, 5)), float(rng.normal())) for i in range(240)]
    rows += [("s9", "m", 7, 3, 1.5), ("s9", "m", None, None, float("nan")), ("s9", "m", 0, 9, None)]
    maps = spark.createDataFrame(rows, "subject_id string, map string, label int, z int, value double")
    regions = spark.createDataFrame([("r1", 1), ("r1", 2), ("r1", 2), ("r2", 2), ("none", 55)], "region string, label int")
    keys = ["subject_id", "map"]
    got = {(r.subject_id, r.map, r.level, r.unit): r for r in aggregate.by_levels(maps, regions, keys=keys, axis="z", n_slices=4, group_rows=group_rows).collect()}
    want = {}
    sets = {(r[0], r[1]) for r in rows}
    members = {"r1": {1, 2}, "r2": {2}, "none": {55}}
    for s in sets:
        mine = [r for r in rows if (r[0], r[1]) == s]
        units = {("whole", None): mine, **{("label", str(k)): [r for r in mine if r[2] == k] for k in {r[2] for r in mine if r[2]}}}
        units |= {("region", k): [r for r in mine if r[2] in v] for k, v in members.items()} | {("slice", str(k)): [r for r in mine if r[3] == k] for k in range(4)}
        want |= {(*s, *u): [r[4] for r in v if r[4] is not None and r[4] == r[4]] for u, v in units.items()}
    assert got.keys() == want.keys()
    for k, v in want.items():
        r = got[k]
        assert r.n == len(v)
        if v:
            exact = [np.mean(v), np.median(v), np.std(v, ddof=1) if len(v) > 1 else 0.0, *np.percentile(v, [5, 25, 75, 95])]
            assert np.allclose([r["mean"], r["median"], r["sd"], r["p5"], r["p25"], r["p75"], r["p95"]], exact, atol=1e-9)
        else:
            assert r["mean"] is None and r["median"] is None and r["p95"] is None
    assert aggregate.by_levels(maps.limit(0), regions, keys=keys).count() == 0


def test_layout_in_one_pass(spark):
    rows = [("a", 1, 0, 9, 0), ("a", 2, 0, 1, 0), ("a", 3, 1, 5, 4), ("a", 4, 0, 5, 1), ("b", 1, 0, 0, 3), ("b", 3, 0, 0, 1), ("c", 0, 1, 1, 1)]
    parcellation = spark.createDataFrame([(s, i, *r) for i, (s, *r) in enumerate(rows)], "subject_id string, voxel_id long, label int, x int, y int, z int")
    names = spark.createDataFrame([("Olfactory bulb", 1), ("Olfactory bulb", 1), ("Cerebellum", 2), ("Isocortex", 3), ("Hypothalamus", 4), ("other", 3)], "region string, label int")
    checks = labels.orientation_check(parcellation, names, [[1, 0, 0, 0], [0, 1, 0, 0], [0, 0, 1, 0]])
    got = {(r.subject_id, r.relation): (r.separation, r.passed) for r in checks.collect()}
    assert got == {("a", "extent"): (4.0, True), ("a", "olfactory > cerebellum"): (8.0, True), ("a", "cortex > hypothalamus"): (3.0, True), ("a", "cerebellum < cortex"): (-4.0, True)}
    status = {r.subject_id: r.status for r in labels.orientation_status(checks, parcellation).collect()}
    assert status == {"a": "ok", "b": "skipped", "c": "skipped"}


def test_roles_by_protocol_names(spark):
    scans = {
        "a": [(3, "WIP perf_dyn", 10), (1, "pCASL perf", 9), (5, "hPerf ASL", 8), (7, "WIP cs_T1W_3D_TFE", 257), (6, "ax VWIP cs_T1W_3D_TFE", 300), (8, "cs_T1W_3D_TFE Gd", 400), (9, None, 500)],
        "b": [(1, "ax T1W_3D_TFE", 20), (2, "sag 3DI", None), (3, "T1 TFE", 900)],  # reformats with a strict name before a loose one
        "c": [(2, "T1 tfe", 30), (1, "t1_3d", 30), (4, "reg - t1 3d", 90), (3, "qflow perf", 1)],
        None: [(1, "perf", 1)],
    }
    df = spark.createDataFrame([(s, *r, "x") for s, rs in scans.items() for r in rs], "subject_id string, scan_id int, protocol string, n_slices int, extra string")
    found = cohort.protocol_roles(df)
    assert found.columns == [*df.columns, "role"] and found.count() == df.count()
    roles = {(r.subject_id, r.scan_id): r.role for r in found.where("role <> 'other'").collect()}
    assert roles == {("a", 3): "dynamic", ("a", 7): "anatomical", ("b", 1): "anatomical", ("c", 1): "anatomical", (None, 1): "dynamic"}

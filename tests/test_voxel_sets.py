"""Closing and hole filling of voxel sets against plain versions, by subject."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from curvemill.functions import tables
from curvemill.operators import aif, diffusion, labels


def plain_close(v, times, steps):
    for _ in range(times):
        v = v | {tuple(np.add(p, s)) for p in v for s in steps}
    for _ in range(times):
        v = {p for p in v if all(tuple(np.add(p, s)) in v for s in steps)}
    return v


def plain_fill(v, steps):
    lo, hi = np.min([*v], axis=0) - 1, np.max([*v], axis=0) + 1
    out = set()
    for z in {p[2] for p in v} if len(steps) == 4 else [lo[2]]:
        seen, todo = {(lo[0], lo[1], z)}, [(lo[0], lo[1], z)]
        while todo:
            p = todo.pop()
            for s in steps:
                q = tuple(np.add(p, s))
                if q not in seen and q not in v and (np.array(q) >= lo).all() and (np.array(q) <= hi).all():
                    seen.add(q)
                    todo.append(q)
        out |= seen
    planes = {p[2] for p in v}
    return v | {(x, y, z) for x in range(lo[0], hi[0] + 1) for y in range(lo[1], hi[1] + 1) for z in (planes if len(steps) == 4 else range(lo[2], hi[2] + 1)) if (x, y, z) not in out}


@pytest.mark.parametrize("planar", [False, True])
def test_closing_and_filling(spark, planar):
    rng = np.random.default_rng(2)
    steps = labels._STEPS[:4] if planar else labels._STEPS
    sets = {s: {tuple(int(i) for i in p) for p in np.argwhere(rng.random(shape) < share) - 2} for s, shape, share in (("a", (7, 6, 4), 0.6), ("b", (5, 7, 5), 0.75))}
    sets["b"] |= {(20, 20, 9)}
    df = spark.createDataFrame([(s, *p) for s, v in sets.items() for p in v] * 2, "subject_id string, x int, y int, z int")
    read = lambda d: {s: {(r.x, r.y, r.z) for r in rows} for s in sets if (rows := d.where(f"subject_id = '{s}'").collect())}
    assert read(labels.fill_holes(df, planar=planar)) == {s: plain_fill(v, steps) for s, v in sets.items()}
    assert read(labels.binary_close(df, times=2, planar=planar)) == {s: plain_close(v, 2, steps) for s, v in sets.items()}
    assert labels.fill_holes(df.limit(0), planar=planar).count() == 0
    alone = df.where("subject_id = 'a'").drop("subject_id")
    assert {tuple(r) for r in labels.fill_holes(alone, planar=planar).collect()} == plain_fill(sets["a"], steps)


def test_a_grown_vessel_has_no_holes(spark):
    ring = {(x, y, z): 10.0 for x in range(3, 10) for y in range(3, 10) for z in (4, 5) if not (5 <= x <= 7 and 5 <= y <= 7)}
    rows = [("a", (z * 14 + y) * 14 + x, x, y, z, ring.get((x, y, z), 0.1)) for x in range(14) for y in range(14) for z in range(10)]
    peaks = spark.createDataFrame(rows, "subject_id string, voxel_id long, x int, y int, z int, value double")
    seed = peaks.where("x = 3 and y = 3 and z = 4").select("subject_id", "voxel_id")
    found = lambda **o: {(r.x, r.y, r.z) for r in peaks.join(aif.grow_region(peaks, seed, margin=8, **o), ["subject_id", "voxel_id"]).collect()}
    assert found(smooth=False) == set(ring)
    whole = found()
    assert set(ring) <= whole and whole == {(x, y, z) for x in range(3, 10) for y in range(3, 10) for z in (4, 5)}


def winding(n):
    """(voxel_id, x, y, z) of a row of voxels, numbered so that the least is at one end and the next least at the other."""
    return [(0 if i == 0 else n - i, i, 0, 0) for i in range(n)]


def test_components_take_few_rounds(spark, monkeypatch):
    monkeypatch.setattr(labels, "MAX_ROUNDS", 12)
    rows = [("a", *r) for r in winding(60)] + [("b", 7, 0, 0, 0), ("b", 9, 1, 0, 0), ("b", 3, 5, 0, 0), ("b", 4, 1, 1, 1)]
    found = labels.connected_components(spark.createDataFrame(rows, "subject_id string, voxel_id long, x int, y int, z int"))
    expected = {("a", i): 0 for i in range(60)} | {("b", 7): 7, ("b", 9): 7, ("b", 3): 3, ("b", 4): 4}
    assert found.count() == len(expected) and {(r.subject_id, r.voxel_id): r.component for r in found.collect()} == expected


def test_checkpoints_do_not_gather_estimates(spark):
    """Estimated bytes are multiplied by every join; a driver cannot hold what fifty rounds make of them."""
    found = tables.checkpointed(spark.range(3))
    for _ in range(8):
        found = tables.checkpointed(found.alias("a").join(found.alias("b"), "id").join(found.alias("c"), "id"))
    assert found._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < 1 << 64
    assert sorted(r.id for r in found.collect()) == [0, 1, 2]


def vessel_of_a_winding_row(spark):
    rows = [(*r, [0.0] * 5 + [4.0, 3.0, 2.0, 1.0, 1.0], 1.0) for r in winding(60)]
    curves = spark.createDataFrame(rows, "voxel_id long, x int, y int, z int, values array<double>, vesselness double")
    return curves, aif.vessel_candidates(curves, percent=0.3, least=3)


def test_a_winding_vessel_is_one_candidate(spark, monkeypatch):
    monkeypatch.setattr(labels, "MAX_ROUNDS", 12)
    _, found = vessel_of_a_winding_row(spark)
    assert [(r.component, r.n_voxels, r.x, r.voxel_id) for r in found.collect()] == [(0, 60, 29.5, 0)]


def test_a_winding_vessel_has_its_roles(spark, monkeypatch):
    monkeypatch.setattr(labels, "MAX_ROUNDS", 12)
    curves, found = vessel_of_a_winding_row(spark)
    roles = aif.label_vessels(found.withColumn("kind", F.lit("vessel")), curves.select("voxel_id", "x", "y", "z", F.col("x").cast("double").alias("projection")), n_slices=4)
    assert sorted((r.component, r.role, r.n_voxels) for r in roles.collect()) == [(0, "artery", 60), (0, "vein", 60)]


def test_a_winding_foreground_is_whole(spark, monkeypatch):
    monkeypatch.setattr(labels, "MAX_ROUNDS", 12)
    rows = [(*r, [2.0, 9.0]) for r in winding(60)] + [(100 + i, 2 * i, 5, 0, [1.0, 9.0]) for i in range(120)]
    curves = spark.createDataFrame(rows, "voxel_id long, x int, y int, z int, values array<double>")
    gradients = spark.createDataFrame([(0, 0.0), (1, 1000.0)], "dir int, bval double")
    assert {r.voxel_id for r in diffusion.diffusion_foreground(curves, gradients).collect()} == set(range(60))

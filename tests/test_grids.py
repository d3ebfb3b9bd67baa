"""Resampling between grids of any affines against NumPy."""

import numpy as np

from curvemill.operators import labels


def _affines(rng):
    m = np.eye(4)
    m[:3, :3] = rng.normal(size=(3, 3)) + 2 * np.eye(3)
    m[:3, 3] = rng.normal(size=3) * 3
    return m


def test_any_affines(spark):
    rng = np.random.default_rng(3)
    pairs = {s: (_affines(rng), _affines(rng)) for s in ("a", "b")}
    flat = np.diag([1.0, 1.0, 0.0, 1.0])
    volumes = {s: {(x, y, z): float(rng.random()) for x in range(-5, 9) for y in range(-3, 6) for z in range(-2, 7) if rng.random() < 0.8} for s in (*pairs, "c", "d")}
    targets = {s: [(int(x), int(y), int(z)) for x, y, z in rng.integers(-4, 5, (60, 3))] for s in volumes}
    rows = lambda m: [r.tolist() for r in m]
    affines = spark.createDataFrame([(s, rows(t), rows(u)[:3]) for s, (t, u) in pairs.items()] + [("c", rows(np.eye(4)), rows(flat))], "subject_id string, target array<array<double>>, source array<array<double>>")
    source = spark.createDataFrame([(s, *k, v, int(10 * v) + 1, "t") for s, d in volumes.items() for k, v in d.items()], "subject_id string, x int, y int, z int, value double, label int, m string")
    wanted = spark.createDataFrame([(s, i, *p) for s, t in targets.items() for i, p in enumerate(t)], "subject_id string, voxel_id int, x int, y int, z int")
    linear = {(r.subject_id, r.voxel_id): r.value for r in labels.resample_linear(wanted, source, affines).collect()}
    nearest = {(r.subject_id, r.voxel_id): r.label for r in labels.resample_nearest(wanted, source, affines).collect()}
    assert len(linear) == len(nearest) == 240
    for s, places in targets.items():
        for i, p in enumerate(places):
            if s in "cd":  # no inverse, and no affines
                assert linear[s, i] is None and nearest[s, i] == 0
                continue
            at = (np.linalg.inv(pairs[s][1]) @ pairs[s][0] @ [*p, 1])[:3]
            low = np.floor(at).astype(int)
            want = sum(np.prod([f if d else 1 - f for f, d in zip(at - low, c)]) * volumes[s].get(tuple(low + c), 0.0) for c in np.ndindex(2, 2, 2))
            assert abs(linear[s, i] - want) < 1e-9
            found = volumes[s].get(tuple(np.rint(at).astype(int)))
            assert nearest[s, i] == (0 if found is None else int(10 * found) + 1)


def test_one_map_for_all(spark):
    source = spark.createDataFrame([(x, y, z, float(x + 10 * y + 100 * z)) for x in range(9) for y in range(9) for z in range(9)], "x int, y int, z int, value double")
    wanted = spark.createDataFrame([(0, 1, 2, 3), (1, 6, 6, 6), (2, 20, 0, 0)], "voxel_id int, x int, y int, z int")
    scaled = {r.voxel_id: r.value for r in labels.resample_linear(wanted, source, 1.25).collect()}
    assert abs(scaled[0] - 1.25 * 321) < 1e-9 and abs(scaled[1] - 7.5 * 111) < 1e-9 and scaled[2] == 0
    moved = {r.voxel_id: r.value for r in labels.resample_linear(wanted, source, [[0, 1, 0, 0.5], [1, 0, 0, 0], [0, 0, 1, 0]]).collect()}
    assert abs(moved[0] - (2.5 + 10 + 300)) < 1e-9 and abs(moved[1] - (6.5 + 660)) < 1e-9
    assert labels.resample_linear(wanted.limit(0), source, 2).count() == 0 and {r.value for r in labels.resample_linear(wanted, source.limit(0), 2).collect()} == {0.0}


def test_rows_shift_by_their_own_seconds():
    from curvemill.operators.filters import shift_rows

    rng = np.random.default_rng(3)
    v, t = rng.normal(size=(9, 21)), np.arange(21) * 1.5
    seconds = np.array([0.0, 1.5, -1.5, 0.7, -0.7, 29.0, -29.0, 60.0, -60.0])
    together = shift_rows(v, t, seconds)
    for i, s in enumerate(seconds):
        assert np.array_equal(together[i], shift_rows(v[i : i + 1], t, float(s))[0])
    assert np.array_equal(together[0], v[0]) and np.array_equal(together[1][1:], v[1][:-1]) and together[1][0] == 0
    assert not together[7].any() and (together[8] == v[8, -1]).all()


def test_aligns_curves_of_mixed_lengths(spark):
    """A batch with several lengths, curves that do not move and empty ones: as each curve alone."""
    from curvemill.operators import aif

    rng = np.random.default_rng(4)
    bump = lambda n, at: np.exp(-0.5 * ((np.arange(n) - at) / 2.0) ** 2)
    pairs = [(i, [float(x) for x in bump(n, 12 + i % 4) + 0.01 * rng.normal(size=n)], [float(x) for x in 2 * bump(n, 10)]) for i, n in enumerate([40, 30, 40, 2, 30, 0, 40])]
    schema = "voxel_id long, vein array<double>, artery array<double>"
    together = {r.voxel_id: r for r in aif.align_to_reference(spark.createDataFrame(pairs, schema).coalesce(1), dt=1.0, rescale=True).collect()}
    for p in pairs:
        alone = aif.align_to_reference(spark.createDataFrame([p], schema), dt=1.0, rescale=True).first()
        assert together[p[0]] == alone and len(alone.aligned) == len(p[1])
    assert abs(together[2].shift_s + 4) < 0.5

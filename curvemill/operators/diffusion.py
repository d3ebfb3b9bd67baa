"""Diffusion: shell means, fixed-diffusivity fractions, tensors and streamlines."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curvemill.functions.percentiles import percentiles
from curvemill.functions.tables import checkpointed
from curvemill.operators.filters import per_curve
from curvemill.operators.labels import largest_component, with_threshold
from curvemill.sources.curves import subjects, to_long


def spherical_mean(curves: DataFrame, gradients: DataFrame, *, keys: list[str]) -> DataFrame:
    """Mean signal of each voxel and shell (b rounded to 50); gradients are (dir, bval)."""
    shells = gradients.select(F.col("dir").alias("frame"), (F.bround(F.col("bval") / 50) * 50).cast("int").alias("shell"))
    long = curves.select(*keys, F.posexplode("values").alias("frame", "value"))
    return long.join(shells, "frame").groupBy(*keys, "shell").agg(F.avg("value").alias("mean"))


def rsi_matrix(shells: list[int], diffusivities: tuple[float, ...] = (0.1e-3, 1e-3, 3e-3), ridge: float = 1e-3, weight: float = 100.0) -> np.ndarray:
    """The fixed linear map from shell ratios to the three fractions, with the fractions' sum held near 1."""
    d = np.exp(-np.outer(shells, diffusivities))
    full = np.vstack([d, weight * np.ones((1, 3)), np.sqrt(ridge) * np.eye(3)])
    return np.linalg.pinv(full)[:, : len(shells) + 1]


def rsi_fractions(means: DataFrame, shells: list[int], *, keys: list[str]) -> DataFrame:
    """f_restricted, f_hindered and f_free from the shell means over the b0 mean, clipped at 0 and summing to 1."""
    m = rsi_matrix(shells)
    wide = means.groupBy(*keys).pivot("shell", [0, *shells]).agg(F.first("mean"))
    raw = [sum((F.col(str(s)) / F.col("0") * float(m[k, i]) for i, s in enumerate(shells)), F.lit(float(m[k, len(shells)] * 100.0))) for k in range(3)]
    raw = [F.greatest(x, F.lit(0.0)) for x in raw]
    names = ["f_restricted", "f_hindered", "f_free"]
    first = wide.select(*keys, *[x.alias(n) for x, n in zip(raw, names)])
    whole = sum((F.col(n) for n in names), F.lit(0.0))
    return first.select(*keys, *[(F.col(n) / F.when(whole > 0, whole)).alias(n) for n in names])


def fit_tensor(curves: DataFrame, gradients: DataFrame, *, keys: list[str], most_b: float = 1500.0) -> DataFrame:
    """fa, md, ad, rd and the colour fa (fa_x, fa_y, fa_z) from a log-linear tensor fit weighted by the squared signal, over b up to most_b.

    Six directions or more are needed; curves with too few frames or a missing value there are null.
    """
    rows = gradients.where(F.col("bval") <= most_b).orderBy("dir").collect()  # one row a direction
    g = np.array([[r["gx"], r["gy"], r["gz"]] for r in rows]).reshape(-1, 3)
    b, at = np.array([r["bval"] for r in rows]), np.array([r["dir"] for r in rows], int)
    x, y, z = g.T
    design = np.column_stack([np.ones(len(b)), -b * x * x, -b * y * y, -b * z * z, -2 * b * x * y, -2 * b * x * z, -2 * b * y * z])
    if len({tuple(np.round(v, 6)) for v, w in zip(g, b) if w > 50}) < 6 or np.linalg.matrix_rank(design) < 7:
        raise ValueError("a tensor needs six directions or more")
    names = ("fa", "md", "ad", "rd", "fa_x", "fa_y", "fa_z")

    def kernel(v: np.ndarray) -> dict[str, np.ndarray]:
        out = np.full((len(names), len(v)), np.nan)
        ok = np.isfinite(v[:, at]).all(1) if v.shape[1] > at.max() else np.zeros(len(v), bool)
        if ok.any():
            s = np.maximum(v[ok][:, at], 1e-6)
            w = s**2
            normal = np.einsum("vi,ij,ik->vjk", w, design, design)
            beta = np.linalg.solve(normal, np.einsum("vi,ij,vi->vj", w, design, np.log(s))[:, :, None])[:, :, 0]
            d = np.stack([np.stack([beta[:, 1], beta[:, 4], beta[:, 5]], -1), np.stack([beta[:, 4], beta[:, 2], beta[:, 6]], -1), np.stack([beta[:, 5], beta[:, 6], beta[:, 3]], -1)], -2)
            e, axes = np.linalg.eigh(d)
            md = e.mean(1)
            fa = np.clip(np.nan_to_num(np.sqrt(1.5 * ((e - md[:, None]) ** 2).sum(1) / (e**2).sum(1))), 0, 1)
            out[:, ok] = [fa, md, e[:, 2], e[:, :2].mean(1), *(fa[:, None] * np.abs(axes[:, :, 2])).T]
        return dict(zip(names, out))

    return per_curve(curves.select(*keys, "values"), kernel, dict.fromkeys(names, "double")).drop("values")


def diffusion_foreground(curves: DataFrame, gradients: DataFrame, *, most_b: float = 50.0, quantile: float = 0.60) -> DataFrame:
    """The largest component of each subject's voxels whose mean signal without weighting exceeds a percentile of the positive ones."""
    by = subjects(curves)
    plain = gradients.where(F.col("bval") <= most_b).select(F.col("dir").alias("frame"))
    long = to_long(curves, *by, "voxel_id", "x", "y", "z").join(plain, "frame", "left_semi")
    means = long.groupBy(*by, "voxel_id", "x", "y", "z").agg(F.avg("value").alias("_b0"))
    limit = percentiles(means.where("_b0 > 0"), by=by, column="_b0", at={"_p": quantile})
    return largest_component(with_threshold(means, limit, by).where(F.col("_b0") > F.coalesce("_p", F.lit(0.0))))


def _voxel(p: Column, size: float) -> list[Column]:
    return [F.floor(p[a] / size).cast("int").alias(a) for a in "xyz"]


def track_density(streamlines: DataFrame, *, voxel_size: float = 1.0) -> DataFrame:
    """(x, y, z, density), by subject where there are several: streamlines that visit each voxel; one that comes back counts once."""
    by = subjects(streamlines)
    voxels = F.array_distinct(F.transform("points", lambda p: F.struct(*_voxel(p, voxel_size))))
    points = streamlines.select(*by, "sid", F.explode(voxels).alias("v")).select(*by, "sid", "v.*")
    # A streamline may be several rows: its id counts once.
    return points.groupBy(*by, "x", "y", "z", "sid").agg(F.lit(1).alias("_one")).groupBy(*by, "x", "y", "z").agg(F.count("_one").alias("density"))


def streamline_filter(streamlines: DataFrame, *, least_length: float, most: int | None = None) -> DataFrame:
    """Streamlines of a length or more; of each subject, ``most`` of them by id."""
    by = subjects(streamlines)
    n = F.size("points") - 1
    step = F.zip_with(F.slice("points", F.lit(2), n), F.slice("points", F.lit(1), n), lambda b, a: F.sqrt(sum((b[c] - a[c]) * (b[c] - a[c]) for c in "xyz")))
    long = streamlines.withColumn("length", F.when(n > 0, F.aggregate(step, F.lit(0.0), lambda s, v: s + v)).otherwise(0.0)).where(F.col("length") >= least_length)
    if not most:
        return long
    if not by:
        return long.orderBy("sid").limit(most)
    # Every task keeps ``most`` rows of a subject at most before they meet.
    return long.withColumn("_place", F.row_number().over(Window.partitionBy(*by).orderBy("sid"))).where(F.col("_place") <= most).drop("_place")


#: Copies of a voxel's label, among which the streamlines that end there are dealt.
SHARES = 8


def connectome(streamlines: DataFrame, parcellation: DataFrame, *, voxel_size: float = 1.0) -> DataFrame:
    """(src_label, dst_label, n), by subject where there are several, over the labels at the streamlines' ends, unordered; background is dropped.

    Streamlines of the same two end voxels are counted before anything is joined. Ends crowd into few voxels: pairs are
    dealt among shares by their other end, and only voxels in which some streamline ends have a label for each share.
    """
    by = subjects(streamlines, parcellation)
    ends = streamlines.select(*by, *[F.struct(*[F.floor(F.element_at("points", i)[a] / voxel_size).cast("int").alias(a) for a in "xyz"]).alias(e) for e, i in (("a", 1), ("b", -1))])
    pairs = checkpointed(ends.groupBy(*by, "a", "b").agg(F.count(F.lit(1)).alias("n")))
    used = pairs.select(*by, F.explode(F.array("a", "b")).alias("v")).distinct()
    labelled = parcellation.where("label > 0").select(*by, F.struct("x", "y", "z").alias("v"), "label")
    named = checkpointed(used.join(labelled, [*by, "v"])).withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))))
    for e, other in ("ab", "ba"):
        names = named.select(*by, F.col("v").alias(e), F.col("share"), F.col("label").alias(f"{e}l"))
        pairs = pairs.withColumn("share", F.pmod(F.xxhash64(other), F.lit(SHARES)).cast("int")).join(names, [*by, e, "share"]).drop("share")
    return pairs.groupBy(*by, F.least("al", "bl").alias("src_label"), F.greatest("al", "bl").alias("dst_label")).agg(F.sum("n").alias("n"))


def micro_scalars(df: DataFrame) -> DataFrame:
    """ufa and tortuosity from fa, kfa, d_par and d_perp."""
    fa2 = F.col("fa") * F.col("fa")
    ufa2 = fa2 + F.col("kfa") * F.col("kfa") * (1 - fa2)
    return df.withColumns({"ufa": F.sqrt(F.least(F.greatest(ufa2, F.lit(0.0)), F.lit(1.0))), "tortuosity": F.col("d_par") / F.when(F.col("d_perp") != 0, F.col("d_perp"))})


def connectome_groups(edges: DataFrame, groups: DataFrame, *, skip: DataFrame) -> DataFrame:
    """Edges between anatomical groups, by subject where there are several; labels in ``skip`` are left out. ``groups`` is (label, name)."""
    by = subjects(edges)
    kept = groups.join(skip, "label", "left_anti")
    named = edges.join(kept.select(F.col("label").alias("src_label"), F.col("name").alias("a")), "src_label").join(kept.select(F.col("label").alias("dst_label"), F.col("name").alias("b")), "dst_label")
    return named.groupBy(*by, F.least("a", "b").alias("src_group"), F.greatest("a", "b").alias("dst_group")).agg(F.sum("n").alias("n"))

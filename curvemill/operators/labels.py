"""Masks, labels and the geometry of voxel sets (subject_id or none, voxel coordinates x, y, z)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curvemill.functions import arrays as A
from curvemill.functions.percentiles import median, percentiles
from curvemill.functions.tables import checkpointed, small
from curvemill.sources.curves import subjects


def otsu_threshold(values: DataFrame, *, column: str = "value", bins: int = 256, by: list[str] | None = None, centre: bool = False) -> DataFrame:
    """by (each subject, where there are several) and the edge, or centre, of the histogram bin that splits the values with the most variance between the classes."""
    by = subjects(values) if by is None else by
    v = A.finite(F.col(column).cast("double"))
    ends = values.groupBy(*by).agg(F.min(v).alias("lo"), F.max(v).alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    points = values.select(*by, v.alias("v")).where("v is not null")
    placed = points.join(small(ends), by) if by else points.crossJoin(F.broadcast(ends))
    counts = placed.groupBy(*by, F.least(F.floor((F.col("v") - F.col("lo")) / F.when(width > 0, width)), F.lit(bins - 1)).cast("int").alias("bin"), "lo", "hi").agg(F.count(F.lit(1)).alias("n"))
    # One row a bin at most: the running sums are over bins.
    everything = Window.partitionBy(*by, "lo", "hi")
    below = everything.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    mid = F.col("lo") + (F.col("bin") + 0.5) * width
    sums = counts.withColumns({"w0": F.sum("n").over(below), "m0": F.sum(F.col("n") * mid).over(below), "w": F.sum("n").over(everything), "m": F.sum(F.col("n") * mid).over(everything)})
    w1 = F.col("w") - F.col("w0")
    gap = F.col("m0") / F.col("w0") - (F.col("m") - F.col("m0")) / F.when(w1 > 0, w1)
    between = F.coalesce(F.col("w0") * w1 * gap * gap, F.lit(0.0))
    best = sums.withColumn("b", F.round(between, 9)).groupBy(*by, "lo", "hi").agg(F.max(F.struct("b", (-F.col("bin")).alias("k"))).alias("x"))
    return best.select(*by, (F.col("lo") + (-F.col("x.k") + (0.5 if centre else 0.0)) * width).alias("threshold"))


def with_threshold(rows: DataFrame, threshold: DataFrame, by: list[str]) -> DataFrame:
    """rows with their subject's one-row columns."""
    few = small(threshold)
    return rows.join(few, by, "left") if by else rows.crossJoin(few)


def mask_otsu(maps: DataFrame) -> DataFrame:
    """label 1 above the subject's Otsu threshold, else 0."""
    found = with_threshold(maps, otsu_threshold(maps), subjects(maps))
    return found.withColumn("label", F.coalesce(F.col("value") > F.col("threshold"), F.lit(False)).cast("int")).drop("threshold")


def restrict_labels(parcellation: DataFrame, keep: list[int] | None) -> DataFrame:
    """Labels outside ``keep`` become 0; none given keeps all."""
    return parcellation.withColumn("label", F.when(F.col("label").isin(keep), F.col("label")).otherwise(0)) if keep else parcellation


def combine_masks(masks: DataFrame) -> DataFrame:
    """(voxel_id, label) of several masks, one row a voxel: the lowest label wins."""
    return masks.groupBy(*subjects(masks), "voxel_id").agg(F.min("label").alias("label"))


def assign_region(parcellation: DataFrame, region_map: DataFrame) -> DataFrame:
    return parcellation.join(region_map, "label").select(*subjects(parcellation), "voxel_id", "label", "region")


def label_names(parcellation: DataFrame, labels: DataFrame) -> DataFrame:
    joined = parcellation.join(labels, "label", "left")
    return joined.withColumn("name", F.coalesce("name", F.concat(F.lit("label_"), F.col("label").cast("string"))))


def exclude_voxels(parcellation: DataFrame, excluded: DataFrame) -> DataFrame:
    return parcellation.join(excluded, [*subjects(parcellation, excluded), "voxel_id"], "left_anti")


#: A 3 x 4 map from target to source indices, one for all, or affines by subject: (subject_id, target, source), index to world.
Affine = list[list[float]] | DataFrame


def _inverse(m: Column) -> list[list[Column]]:
    """The inverse of the 3 x 3 part of a matrix, null where it has none."""
    e = lambda i, j: m[i % 3][j % 3]
    minor = lambda i, j: e(i + 1, j + 1) * e(i + 2, j + 2) - e(i + 1, j + 2) * e(i + 2, j + 1)
    det = sum(e(0, j) * minor(0, j) for j in range(3))
    return [[minor(j, i) / F.when(det != 0, det) for j in range(3)] for i in range(3)]


def index_maps(affines: DataFrame) -> DataFrame:
    """(subject_id, m): the map from target to source indices of each pair of affines (target, source), as 3 rows of 4.

    Affines are arrays of 3 or 4 rows of 4, from indices to the world; m is null where the source's has no inverse.
    """
    t, inverse = F.col("target"), _inverse(F.col("source"))
    into = [[sum(inverse[i][k] * t[k][j] for k in range(3)) for j in range(3)] for i in range(3)]
    offset = [sum(inverse[i][k] * (t[k][3] - F.col("source")[k][3]) for k in range(3)) for i in range(3)]
    rows = F.array(*[F.array(*into[i], offset[i]) for i in range(3)])
    return affines.select(*subjects(affines), F.when(offset[0].isNotNull(), rows).alias("m"))


def _placed(targets: DataFrame, affine: Affine, by: list[str]) -> DataFrame:
    """targets' keys with their places in the source's grid, _x, _y and _z."""
    if isinstance(affine, DataFrame):
        few = small(index_maps(affine))
        targets = targets.join(few, subjects(targets, affine), "left") if subjects(targets, affine) else targets.crossJoin(few)
        row = lambda i: [F.col("m")[i][j] for j in range(4)]
    else:
        row = lambda i: affine[i]
    at = [F.col("x") * row(i)[0] + F.col("y") * row(i)[1] + F.col("z") * row(i)[2] + row(i)[3] for i in range(3)]
    return targets.select(*by, "voxel_id", *[c.alias(f"_{a}") for c, a in zip(at, "xyz")])


def resample_nearest(targets: DataFrame, source: DataFrame, matrix: Affine) -> DataFrame:
    """Labels of target voxels by the nearest source voxel, 0 where there is none."""
    by = subjects(targets, source)
    placed = _placed(targets, matrix, by).select(*by, "voxel_id", *[F.rint(f"_{a}").cast("int").alias(f"_{a}") for a in "xyz"])
    found = source.select(*by, *[F.col(a).alias(f"_{a}") for a in "xyz"], "label")
    return placed.join(found, [*by, "_x", "_y", "_z"], "left").select(*by, "voxel_id", F.coalesce("label", F.lit(0)).alias("label"))


#: Edge of the cubes of source voxels that are looked up as one row; each also holds the next layer.
TILE = 4


def _tiles(source: DataFrame, by: list[str]) -> DataFrame:
    """(by, tx, ty, tz, cube): the values of each cube and its next layer, (TILE + 1) ** 3 places, null where no voxel is.

    A voxel on a cube's first layer is also on the last of the cube before: up to eight copies, one in most places.
    """
    copies = source.select(*by, F.col("value").cast("double").alias("value"), *[F.col(a).cast("long").alias(a) for a in "xyz"])
    for a in "xyz":
        own = F.floor(F.col(a) / TILE)
        edge = F.col(a) - own * TILE == 0
        copies = copies.withColumn(f"t{a}", F.explode(F.when(edge, F.array(own, own - 1)).otherwise(F.array(own))))
    inside = [F.col(a) - F.col(f"t{a}") * TILE for a in "xyz"]
    n = TILE + 1
    place = ((inside[0] * n + inside[1]) * n + inside[2]).cast("int")
    held = copies.groupBy(*by, "tx", "ty", "tz").agg(F.collect_list(F.struct(place.alias("k"), "value")).alias("v"))  # a cube's at most
    cube = F.transform(F.sequence(F.lit(0), F.lit(n**3 - 1)), lambda k: F.element_at(F.map_from_entries("v"), k))
    return held.select(*by, "tx", "ty", "tz", cube.alias("cube"))


def resample_linear(targets: DataFrame, source: DataFrame, affine: float | Affine) -> DataFrame:
    """Values of target voxels by the eight source voxels around their places; missing corners count as 0.

    ``affine`` is one factor of the indices, a 3 x 4 map from target to source indices, or affines by subject. A subject
    without one, or whose source affine has no inverse, has null values. Source voxels (one a place) are gathered in cubes
    with a layer of their neighbours, so a target voxel is moved once and finds all its corners in one row.
    """
    by = subjects(targets, source)
    if isinstance(affine, (int, float)):
        affine = [[affine if i == j else 0.0 for j in range(4)] for i in range(3)]
    placed = _placed(targets, affine, by)
    base = {a: F.floor(f"_{a}") for a in "xyz"}
    placed = placed.withColumns({f"t{a}": F.floor(base[a] / TILE) for a in "xyz"})
    joined = placed.join(_tiles(source, by), [*by, "tx", "ty", "tz"], "left")
    n, value = TILE + 1, F.lit(0.0)
    first = {a: base[a] - F.col(f"t{a}") * TILE for a in "xyz"}
    share = {a: F.col(f"_{a}") - base[a] for a in "xyz"}
    for corner in range(8):
        bits = {a: corner >> k & 1 for k, a in enumerate("xyz")}
        weight = F.lit(1.0)
        for a in "xyz":
            weight = weight * (share[a] if bits[a] else 1 - share[a])
        place = (((first["x"] + bits["x"]) * n + first["y"] + bits["y"]) * n + first["z"] + bits["z"]).cast("int")
        value = value + weight * F.coalesce(F.get("cube", place), F.lit(0.0))
    return joined.select(*by, "voxel_id", value.alias("value"))


_STEPS = [(1, 0, 0), (-1, 0, 0), (0, 1, 0), (0, -1, 0), (0, 0, 1), (0, 0, -1)]


def _neighbours(voxels: DataFrame, planar: bool = False, *, steps: list[tuple[int, int, int]] | None = None) -> DataFrame:
    """Each voxel's places one step along an axis, or an axis of its slice, or by ``steps``, as x, y, z."""
    steps = F.array(*[F.struct(*[F.lit(d).alias(a) for a, d in zip("xyz", s)]) for s in (steps or (_STEPS[:4] if planar else _STEPS))])
    each = voxels.withColumn("_s", F.explode(steps))
    return each.withColumns({a: F.col(a) + F.col(f"_s.{a}") for a in "xyz"}).drop("_s")


#: Rounds after which something must be wrong: they grow with the logarithm of a component's size.
MAX_ROUNDS = 200


def _large_star(edges: DataFrame, by: list[str]) -> DataFrame:
    """Every node links its larger neighbours to the smallest node it knows."""
    both = edges.unionByName(edges.select(*by, F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy(*by, "u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, [*by, "u"]).select(*by, F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame, by: list[str]) -> DataFrame:
    """Every node links itself and its smaller neighbours to the smallest of them; edges are u > v."""
    least = edges.groupBy(*by, "u").agg(F.min("v").alias("m"))
    moved = edges.join(least, [*by, "u"]).where("v <> m").select(*by, F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select(*by, "u", F.col("m").alias("v"))).distinct()


def _settled(edges: DataFrame, by: list[str]) -> bool:
    """Whether no node of the edges (u > v) has two smaller neighbours, or smaller and larger ones: v is then u's component."""
    ends = F.array(*[F.struct(F.col(x).alias("node"), F.lit(x == "u").cast("long").alias("down"), F.lit(x == "v").alias("up")) for x in "uv"])
    nodes = edges.select(*by, F.inline(ends)).groupBy(*by, "node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return not nodes.agg(F.count_if((F.col("down") > 1) | ((F.col("down") > 0) & F.col("up")))).first()[0]


def connected_components(voxels: DataFrame) -> DataFrame:
    """(subject_id, voxel_id, component) of each subject's voxel set under 6-neighbourhood; component is the least voxel id.

    Rounds of large and small stars, each checkpointed, until every voxel is linked to the least of its component alone. The
    rounds grow with the logarithm of a component's size, however it winds and its voxels are numbered.
    """
    by = subjects(voxels)
    here = checkpointed(voxels.select(*by, "voxel_id", "x", "y", "z"))
    other = here.withColumnRenamed("voxel_id", "other")
    pairs = _neighbours(here, steps=_STEPS[::2]).join(other, [*by, "x", "y", "z"]).where("voxel_id <> other")  # each pair from one side
    edges = checkpointed(pairs.select(*by, F.greatest("voxel_id", "other").alias("u"), F.least("voxel_id", "other").alias("v")).distinct())
    for _ in range(MAX_ROUNDS):
        if _settled(edges, by):
            break
        edges = checkpointed(_small_star(_large_star(edges, by), by))
    else:
        raise RuntimeError("components did not settle")
    found = edges.select(*by, F.col("u").alias("voxel_id"), F.col("v").alias("component"))
    return here.select(*by, "voxel_id").join(found, [*by, "voxel_id"], "left").withColumn("component", F.coalesce("component", "voxel_id"))


def largest_component(voxels: DataFrame) -> DataFrame:
    """The voxels of each subject's largest component, the one with the least voxel id on a tie."""
    by = subjects(voxels)
    found = checkpointed(connected_components(voxels))
    sizes = found.groupBy(*by, "component").agg(F.count(F.lit(1)).alias("n"))
    best = sizes.groupBy(*by).agg(F.max(F.struct("n", (-F.col("component")).alias("k"))).alias("b")).select(*by, (-F.col("b.k")).alias("component"))
    return found.join(best, [*by, "component"], "left_semi").select(*by, "voxel_id")


def component_of(voxels: DataFrame, seeds: DataFrame) -> DataFrame:
    """The voxels in the components of the seed voxels (subject_id, voxel_id)."""
    by = subjects(voxels, seeds)
    found = checkpointed(connected_components(voxels))
    hit = found.join(seeds.select(*by, "voxel_id"), [*by, "voxel_id"], "left_semi").select(*by, "component").distinct()
    return found.join(hit, [*by, "component"], "left_semi").select(*by, "voxel_id")


def strongest_component(voxels: DataFrame, *, score: str = "score") -> DataFrame:
    """The voxels of each subject's component with the largest sum of scores."""
    by = subjects(voxels)
    found = checkpointed(connected_components(voxels)).join(voxels.select(*by, "voxel_id", score), [*by, "voxel_id"])
    sums = found.groupBy(*by, "component").agg(F.sum(score).alias("w"))
    best = sums.groupBy(*by).agg(F.max(F.struct("w", (-F.col("component")).alias("k"))).alias("b")).select(*by, (-F.col("b.k")).alias("component"))
    return found.join(best, [*by, "component"], "left_semi").select(*by, "voxel_id", score)


def _eroded(here: DataFrame, place: list[str], planar: bool = False) -> DataFrame:
    """The places of the set all whose neighbours are in it."""
    full = _neighbours(here, planar).join(here, place, "left_semi")  # each place once for every neighbour in the set
    return full.groupBy(*place).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == (4 if planar else 6)).select(*place).join(here, place, "left_semi")


def binary_open(voxels: DataFrame) -> DataFrame:
    """Erosion and then dilation of a voxel set by the 6-neighbourhood, as (subject_id, x, y, z)."""
    by = subjects(voxels)
    place = [*by, "x", "y", "z"]
    eroded = _eroded(voxels.select(*place).distinct(), place)
    return eroded.unionByName(_neighbours(eroded)).distinct()


def binary_close(voxels: DataFrame, *, times: int = 1, planar: bool = False, inside: DataFrame | None = None) -> DataFrame:
    """``times`` dilations and then as many erosions by the 6-neighbourhood, or each slice's 4-neighbourhood, as (subject_id, x, y, z).

    With ``inside`` (places), nothing grows beyond it, and what lies beyond counts as empty.
    """
    by = subjects(voxels)
    place = [*by, "x", "y", "z"]
    found = checkpointed(voxels.select(*place).distinct())
    for _ in range(times):
        found = found.unionByName(_neighbours(found, planar)).distinct()
        found = checkpointed(found.join(inside.select(*place), place, "left_semi") if inside is not None else found)
    for _ in range(times):
        found = checkpointed(_eroded(found, place, planar))
    return found


def fill_holes(voxels: DataFrame, *, planar: bool = False) -> DataFrame:
    """A voxel set with what it encloses, by the 6-neighbourhood or slice by slice, as (subject_id, x, y, z).

    Holes are the components of the rest of a subject's box, widened by one, that do not hold its corner. The box is listed, one
    row a place, over all executors.
    """
    by = subjects(voxels)
    place = [*by, "x", "y", "z"]
    here = checkpointed(voxels.select(*place).distinct())
    ends = here.groupBy(*by).agg(*[F.min(c).cast("long").alias(f"_lo{c}") for c in "xyz"], *[F.max(c).cast("long").alias(f"_hi{c}") for c in "xyz"])
    rim = {c: 0 if planar and c == "z" else 1 for c in "xyz"}
    every = ends.repartition(*by) if by else ends
    for c in "zxy":
        every = every.withColumn(c, F.explode(F.sequence(F.col(f"_lo{c}") - rim[c], F.col(f"_hi{c}") + rim[c])))
        if c == "z":  # a plane is a task's work, not a subject
            every = every.repartition(*by, "z")
    size = {c: F.col(f"_hi{c}") - F.col(f"_lo{c}") + 1 + 2 * rim[c] for c in "xy"}
    at = {c: F.col(c) - F.col(f"_lo{c}") + rim[c] for c in "xyz"}
    number = (at["z"] * size["x"] + at["x"]) * size["y"] + at["y"]  # a slice's corner has its least number
    apart = F.col("z") * 2 if planar else F.col("z")  # slices that are not neighbours
    rest = every.select(*place, number.alias("voxel_id"), (size["x"] * size["y"]).alias("_plane")).join(here, place, "left_anti")
    rest = checkpointed(rest.withColumn("_z", F.col("z")).withColumn("z", apart))
    found = connected_components(rest.select(*by, "voxel_id", "x", "y", "z"))
    named = rest.join(found, [*by, "voxel_id"])
    outside = F.col("component") % F.col("_plane") == 0 if planar else F.col("component") == 0
    holes = named.where(~outside).select(*by, *[F.col(k).cast(here.schema[c].dataType).alias(c) for k, c in (("x", "x"), ("y", "y"), ("_z", "z"))])
    return here.unionByName(holes)


def within_distance(voxels: DataFrame, *, limit: float, mm: tuple[float, float, float] = (1.0, 1.0, 1.0)) -> DataFrame:
    """(subject_id, x, y, z, distance) of every place that is at most ``limit`` from a subject's voxel set, 0 on the set itself.

    An exact Euclidean distance transform in separable passes: each pass moves along one axis, as far as the limit goes on voxels of
    ``mm`` on a side, and keeps the least sum of squares of every place. The nearest voxel of a set always has a neighbour
    that is not in it, so only such voxels set out. Sums are combined before every shuffle; none is over more than a place.
    """
    by = subjects(voxels)
    place = [*by, "x", "y", "z"]
    here = checkpointed(voxels.select(*place).distinct())
    found = here.join(_eroded(here, place), place, "left_anti").withColumn("_d", F.lit(0.0))
    most = limit * limit * (1 + 1e-12)
    for c, size in zip("xyz", mm):
        far = int(limit / size * (1 + 1e-12))
        each = found.withColumn("_s", F.explode(F.sequence(F.lit(-far), F.lit(far))))
        each = each.withColumns({c: F.col(c) + F.col("_s"), "_d": F.col("_d") + F.pow(F.col("_s") * F.lit(float(size)), F.lit(2.0))}).where(F.col("_d") <= most)
        found = each.groupBy(*place).agg(F.min("_d").alias("_d"))
    beyond = found.join(here, place, "left_anti").select(*place, F.sqrt("_d").alias("distance"))
    return here.withColumn("distance", F.lit(0.0)).unionByName(beyond)


def mask_shell(volume: DataFrame, mask: DataFrame, *, limit: float, mm: tuple[float, float, float] = (1.0, 1.0, 1.0)) -> DataFrame:
    """(subject_id, voxel_id, distance) of the voxels on both sides of a mask's surface, up to ``limit``.

    ``volume`` lists all voxels (voxel_id, x, y, z), ``mask`` the ids in the mask. Outside, distance is that to the nearest voxel
    of the mask; inside, less that to the nearest voxel of the volume outside. A subject whose mask is empty or
    fills its volume has no surface and no rows.
    """
    by = subjects(volume, mask)
    inside = mask.select(*by, "voxel_id").distinct().withColumn("_in", F.lit(True))
    marked = checkpointed(volume.select(*by, "voxel_id", "x", "y", "z").join(inside, [*by, "voxel_id"], "left").fillna(False, ["_in"]))
    near = [within_distance(marked.where(F.col("_in") == side), limit=limit, mm=mm).withColumn("_in", F.lit(not side)) for side in (True, False)]
    found = marked.join(near[0].unionByName(near[1]).where("distance > 0"), [*by, "x", "y", "z", "_in"])
    return found.select(*by, "voxel_id", F.when(F.col("_in"), -F.col("distance")).otherwise(F.col("distance")).alias("distance"))


def foreground_component(curves: DataFrame, *, values: str = "values", frames: int = 10, share: float = 0.1) -> DataFrame:
    """The largest component of the voxels whose early mean exceeds a share of the subject's 99th percentile."""
    by = subjects(curves)
    early = curves.select(*by, "voxel_id", "x", "y", "z", A.mean(A.span(F.col(values), 0, frames)).alias("_e"))
    limit = percentiles(early, by=by, column="_e", at={"_p": 0.99})
    return largest_component(with_threshold(early, limit, by).where(F.col("_e") > share * F.col("_p")))


def hyperintense_voxels(maps: DataFrame, *, low: float = 2.0, high: float = 12.0, least: int = 2000) -> DataFrame:
    """(subject_id, x, y, z) of bright spots: robust deviations between low and high from the median, opened; subjects of over ``least`` voxels."""
    by = subjects(maps)
    middle = median(maps, by=by, name="_m")
    with_middle = with_threshold(maps, middle, by).withColumn("_d", F.abs(F.col("value") - F.col("_m")))
    spread = median(with_middle, by=by, column="_d", name="_mad")
    big = maps.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > least)
    z = (F.col("value") - F.col("_m")) / (1.4826 * F.col("_mad") + 1e-6)
    bright = with_threshold(with_threshold(with_middle, spread, by), big, by).where(F.col("_n").isNotNull() & (z > low) & (z < high))
    return binary_open(bright)


def hyperintensity_region(coarse: DataFrame, fine: DataFrame, *, scale: float, least: int = 500, least_fine: int = 2000, share: float = 0.2, label: int = 9000, within: list[int] | None = None, low: float = 2.0, high: float = 12.0) -> DataFrame:
    """coarse (voxel_id, x, y, z, label) with ``label`` where enough of a voxel in ``within`` is bright in ``fine`` (x, y, z, value, of the same tissue).

    A coarse voxel (x, y, z) lies at scale times its place in the fine grid; its share is the linear interpolation of
    the opened bright spots there. Nothing changes in subjects with ``least`` such voxels or fewer, or too few fine ones.
    """
    by = subjects(coarse, fine)
    inside = coarse.where(F.col("label").isin(within)) if within else coarse.where("label > 0")
    enough = inside.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > least)
    bright = hyperintense_voxels(fine, least=least_fine, low=low, high=high).withColumn("value", F.lit(1.0))
    part = resample_linear(with_threshold(inside, enough, by).where("_n is not null"), bright, scale).where(F.col("value") > share).select(*by, "voxel_id", F.lit(True).alias("_hit"))
    return coarse.join(part, [*by, "voxel_id"], "left").withColumn("label", F.when(F.col("_hit"), F.lit(label)).otherwise(F.col("label"))).drop("_hit")


#: Structures with the parts of names by which they are known, most specific first, in the order in which they claim regions.
STRUCTURES = (
    ("olfactory", ("olfactory", "olfactory bulb", "olf")),
    ("cerebellum", ("cerebellum", "cerebellar")),
    ("cortex", ("cerebral cortex", "isocortex", "neocortex", "cortex")),
    ("hypothalamus", ("hypothalamus", "hypothalamic")),
)
#: Fixed values: (structure, axis, +1 if it lies further along the axis than the other, other structure).
LAYOUT = (("olfactory", "y", 1, "cerebellum"), ("cortex", "z", 1, "hypothalamus"), ("cerebellum", "y", -1, "cortex"))


def orientation_check(parcellation: DataFrame, region_map: DataFrame, affine: list[list[float]], *, margin: float = 0.0) -> DataFrame:
    """(subject_id, relation, separation, passed) of each layout relation that a subject's regions allow, and of its extent.

    Regions are matched to structures by name: the shortest name with the first alias that any has, each claimed once.
    The region map is a small table.
    """
    by = subjects(parcellation)
    free = {r["region"] for r in region_map.select("region").distinct().collect()}
    claimed: dict[str, str] = {}
    for structure, aliases in STRUCTURES:
        for alias in aliases:
            if hits := sorted((n for n in free if alias in n.lower()), key=lambda n: (len(n), n)):
                claimed[structure] = hits[0]
                free.discard(hits[0])
                break
    world = {f"w{a}": sum((F.col(c) * float(m) for c, m in zip("xyz", row)), F.lit(float(row[3]))) for a, row in zip("xyz", affine)}
    bridge = region_map.where(F.col("region").isin(list(claimed.values()))).select("label", "region").distinct()
    placed = parcellation.where("label > 0").join(bridge, "label", "left").withColumns(world)
    ends = [f(c).alias(f"{n}_{c}") for c in "xyz" for n, f in (("lo", F.min), ("hi", F.max))]
    centres = [F.avg(F.when(F.col("region") == r, F.col(f"w{a}"))).alias(f"_{s}_{a}") for s, r in claimed.items() for a in "yz"]
    one = placed.groupBy(*by).agg(*ends, *centres)  # a row a subject: its box and the centres of the structures it has
    size = {a: sum((F.abs(F.lit(float(m))) * (F.col(f"hi_{c}") - F.col(f"lo_{c}")) for c, m in zip("xyz", row)), F.lit(0.0)) for a, row in zip("xyz", affine)}
    checks = [("extent", F.when((size["y"] > 0) & (size["z"] > 0), size["y"] - size["z"]), 1)]
    for a, axis, sign, b in LAYOUT:
        if a in claimed and b in claimed:
            checks.append((f"{a} {'>' if sign > 0 else '<'} {b}", F.col(f"_{a}_{axis}") - F.col(f"_{b}_{axis}"), sign))
    listed = F.array(*[F.struct(F.lit(r).alias("relation"), gap.alias("separation"), (sign * gap > margin).alias("passed")) for r, gap, sign in checks])
    return one.select(*by, F.inline(listed)).where("separation is not null")


def orientation_status(checks: DataFrame, subject_rows: DataFrame) -> DataFrame:
    """status of every subject: ok if all its checks passed, warn if one did not, skipped without any."""
    by = subjects(checks, subject_rows)
    found = checks.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min("passed").alias("all"))
    every = subject_rows.select(*by).distinct().join(found, by, "left") if by else found
    return every.select(*by, F.when(F.coalesce("n", F.lit(0)) == 0, "skipped").when(F.col("all"), "ok").otherwise("warn").alias("status"))


def voxel_set_agreement(a: DataFrame, b: DataFrame) -> DataFrame:
    """Sizes, overlap, IoU and the distance of the centroids of two voxel sets."""
    by = subjects(a, b)
    joined = a.select(*by, "voxel_id", *[F.col(c).alias(f"a{c}") for c in "xyz"]).join(b.select(*by, "voxel_id", *[F.col(c).alias(f"b{c}") for c in "xyz"]), [*by, "voxel_id"], "full")
    sums = joined.groupBy(*by).agg(F.count("ax").alias("n_a"), F.count("bx").alias("n_b"), F.sum((F.col("ax").isNotNull() & F.col("bx").isNotNull()).cast("long")).alias("overlap"), F.sqrt(sum((F.avg(f"a{c}") - F.avg(f"b{c}")) ** 2 for c in "xyz")).alias("distance"))
    union = F.col("n_a") + F.col("n_b") - F.col("overlap")
    return sums.withColumn("iou", F.col("overlap") / F.when(union > 0, union))

"""SimHash near-duplicates by a generalised pigeonhole search.

A document's fingerprint has bit b set if more than half of its shingle hashes have. Fingerprints that differ
in at most ``RADIUS`` bits are linked; a document's component is the connected component of its fingerprint.

The search runs over distinct fingerprints, so copies cost nothing:

1. Bits are grouped into parts by their correlation over all fingerprints.
2. If sum(t_i + 1) = RADIUS + 1 over the parts, two fingerprints within RADIUS bits differ in at most t_i bits in
   some part i (t_i = -1 skips a part). For every fingerprint, dynamic programming over the parts picks the
   thresholds with the least estimated number of candidates and probes. The estimates come from value counts of
   16-bit blocks (a table of 4 x 65,536 numbers whatever the input), convolved where a part has two blocks.
3. Each fingerprint looks up its part values within the thresholds among all fingerprints; candidates are verified.
4. A fingerprint with more than ``MAX_CANDIDATES`` real candidates sits in a crowd; the thresholds cannot help
   there. Two crowded fingerprints within two bits have a common neighbour at distance one or less from both, so each
   crowded one emits its 65 neighbours as keys, and those that share a key (65 at most) link to the least of them.
   A pair with one end outside a crowd is found from that end. So no link is lost and work per fingerprint is bounded.

Defined results: null and blank texts have fingerprint zero and are linked like any other; rows that repeat are
rows of one fingerprint; a null id counts only where a component has no other; an empty table gives an empty
result. Extra columns are ignored by ``near_duplicates`` and kept by ``drop_near_duplicates``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curvemill.llm.graph import components
from curvemill.llm.scratch import written

RADIUS = 2
MAX_CANDIDATES = 256
#: Above so many distinct fingerprints, two parts of 32 bits take the place of four of 16.
FOUR_PARTS_UP_TO = 1 << 20
#: Estimated cost of a probe, in candidates.
PROBE_COST = 1.0
_SLICE = 1 << 15


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """Hashes of a text's shingles, repeats included; a shorter text is one shingle, a blank one has none."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    shingles = list(map(b" ".join, zip(*[words[i:] for i in range(shingle)]))) if len(words) >= shingle else [b" ".join(words)]
    return np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(42)), np.uint64, len(shingles))


def _fold(hashes: np.ndarray) -> int:
    """The fingerprint of shingle hashes."""
    n = len(hashes)
    if not n:
        return 0
    counts = np.zeros(64, np.int64)
    for at in range(0, n, _SLICE):
        part = hashes[at : at + _SLICE]
        bits = np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.int64)[0])


def simhash(text: str | None, shingle: int = 3) -> int:
    """Fingerprint of one text as a signed 64-bit number."""
    return _fold(shingle_hashes(text, shingle))


def fingerprint(text: Column, shingle: int = 3) -> Column:
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(t, shingle) for t in texts], dtype="int64")

    return of(text)


def _bits(values: np.ndarray) -> np.ndarray:
    return np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_groups(fps: DataFrame) -> list[int]:
    """All 64 bits in an order that puts correlated bits next to each other, in blocks of 16.

    Counts of common bits are summed on the executors to 64 x 64 numbers.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, n = np.zeros((64, 64)), 0
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(values), _SLICE):
                x = _bits(np.ascontiguousarray(values[at : at + _SLICE])).astype(np.float32)
                both += x.T @ x
            n += len(values)
        if n:
            yield pa.record_batch([pa.array(np.arange(4097)), pa.array(np.append(both.ravel(), n))], ["cell", "n"])

    rows = fps.select("fp").mapInArrow(partial, "cell long, n double").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    cells = np.zeros(4097)
    for r in rows:
        cells[r["cell"]] = r["n"]
    both, n = cells[:4096].reshape(64, 64), max(cells[4096], 1.0)
    mean = np.diag(both) / n
    spread = np.sqrt(np.clip(mean * (1 - mean), 1e-12, None))
    corr = np.abs((both / n - np.outer(mean, mean)) / np.outer(spread, spread))
    np.fill_diagonal(corr, 0)
    free, order = set(range(64)), []
    for _ in range(4):
        left = sorted(free)
        sub = corr[np.ix_(left, left)]
        block = [left[int(sub.max(axis=1).argmax())]]
        while len(block) < 16:
            rest = sorted(free - set(block))
            block.append(rest[int(corr[np.ix_(rest, block)].mean(axis=1).argmax())])
        free -= set(block)
        order += block
    return order


def _blocks(values: np.ndarray, order: list[int]) -> np.ndarray:
    """The four 16-bit block values of each fingerprint."""
    bits = _bits(np.ascontiguousarray(values))[:, order]
    return np.ascontiguousarray(np.packbits(np.ascontiguousarray(bits), axis=1, bitorder="little")).view(np.uint16).reshape(-1, 4)


def _flips(width: int, most: int) -> list[np.ndarray]:
    """Masks with exactly 0, 1, ... most bits of a part."""
    return [np.array([sum(1 << b for b in c) for c in combinations(range(width), k)], np.int64) for k in range(most + 1)]


def _allocate(near: np.ndarray, width: int) -> np.ndarray:
    """Thresholds of each fingerprint and part, by dynamic programming.

    near[f, i, d]: estimated fingerprints at distance d from f's value of part i. The sum of t + 1 is RADIUS + 1.
    """
    n, parts, _ = near.shape
    probes = np.cumsum([len(x) for x in _flips(width, RADIUS)])
    cost = np.concatenate([np.zeros((n, parts, 1)), np.cumsum(near, axis=2) + PROBE_COST * probes], axis=2)  # by t + 1
    units = RADIUS + 1
    best, choice = np.full((n, units + 1), np.inf), np.zeros((parts, n, units + 1), np.int8)
    best[:, 0] = 0
    for i in range(parts):
        new = np.full_like(best, np.inf)
        for u in range(units + 1):
            for take in range(u + 1):
                c = best[:, u - take] + cost[:, i, take]
                better = c < new[:, u]
                new[better, u] = c[better]
                choice[i, better, u] = take
        best = new
    left, t = np.full(n, units), np.zeros((n, parts), np.int8)
    for i in reversed(range(parts)):
        t[:, i] = choice[i, np.arange(n), left]
        left = left - t[:, i]
    return t - 1


def links(fps: DataFrame) -> DataFrame:
    """Edges (u, v) over the distinct fingerprints in column fp: enough to connect all that are within RADIUS bits."""
    n = fps.count()
    order = bit_groups(fps)
    parts = 4 if n <= FOUR_PARTS_UP_TO else 2
    width = 64 // parts

    def block_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(4 << 16, np.int64)
        for batch in batches:
            b = _blocks(batch.column(0).to_numpy(zero_copy_only=False), order).astype(np.int64)
            counts += np.bincount((b + (np.arange(4) << 16)).ravel(), minlength=4 << 16)
        at = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(at), pa.array(counts[at])], ["cell", "n"])

    # As Arrow, in one job: rows cost the driver many times the numbers that they hold, and an iterator a job for each partition.
    held = fps.select("fp").mapInArrow(block_counts, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(4 << 16)
    table[held["cell"].to_numpy()] = held["n"].to_numpy()
    table = table.reshape(4, -1)
    every = np.arange(1 << 16)
    near = np.stack([sum(table[:, every ^ m] for m in masks) for masks in _flips(16, RADIUS)], axis=2)  # block, value, distance
    shared = fps.sparkSession.sparkContext.broadcast(near.astype(np.float32))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near, masks = shared.value, _flips(width, RADIUS)

        def batch_of(fp, part, value, probe):
            return pa.record_batch([pa.array(fp), pa.array(np.full(len(fp), part, np.int32)), pa.array(value), pa.array(np.full(len(fp), probe))], ["fp", "part", "value", "probe"])

        for batch in batches:
            values = np.ascontiguousarray(batch.column(0).to_numpy(zero_copy_only=False))
            for at in range(0, len(values), 4096):
                fp = values[at : at + 4096]
                b = _blocks(fp, order)
                est = np.stack([near[i, b[:, i]] for i in range(4)], axis=1).astype(np.float64)
                if parts == 2:
                    p = est / max(n, 1)
                    est = np.stack([np.stack([sum(p[:, i, k] * p[:, i + 1, d - k] for k in range(d + 1)) for d in range(RADIUS + 1)], axis=1) for i in (0, 2)], axis=1) * n
                    part_values = np.stack([b[:, i].astype(np.int64) | b[:, i + 1].astype(np.int64) << 16 for i in (0, 2)], axis=1)
                else:
                    part_values = b.astype(np.int64)
                t = _allocate(est, width)
                for i in range(parts):
                    yield batch_of(fp, i, np.ascontiguousarray(part_values[:, i]), False)
                    for d in range(RADIUS + 1):
                        own = t[:, i] >= d
                        if own.any():
                            v = part_values[own, i][:, None] ^ masks[d][None, :]
                            yield batch_of(np.repeat(fp[own], len(masks[d])), i, v.ravel(), True)

    both = written(fps.select("fp").mapInArrow(keys, "fp long, part int, value long, probe boolean"), "simhash-keys")
    index = both.where("not probe").select("part", "value", F.col("fp").alias("v"))
    probes = both.where("probe").select("part", "value", F.col("fp").alias("u"))
    held = index.groupBy("part", "value").agg(F.count(F.lit(1)).alias("n"))
    load = probes.join(held, ["part", "value"]).groupBy("u").agg(F.sum("n").alias("n"))
    crowded = written(load.where(F.col("n") > MAX_CANDIDATES).select(F.col("u").alias("fp")), "simhash-crowded")
    # Keys with more members than the bound are probed by crowded fingerprints only.
    open_keys = held.where(F.col("n") <= MAX_CANDIDATES).select("part", "value")
    index = index.join(open_keys, ["part", "value"])
    calm = probes.join(crowded.select(F.col("fp").alias("u")), "u", "left_anti")
    found = calm.join(index, ["part", "value"]).where((F.col("u") != F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= RADIUS))
    pairs = found.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))

    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << b if b < 63 else -(1 << 63)).cast("long") for b in range(64)])
    ball = crowded.select("fp", F.explode(F.transform(flips, lambda m: F.col("fp").bitwiseXOR(m))).alias("key"))
    shared_keys = ball.groupBy("key").agg(F.min("fp").alias("v"), F.collect_list("fp").alias("us")).where("size(us) > 1")
    crowds = shared_keys.select(F.explode("us").alias("u"), "v").where("u <> v")
    return pairs.unionByName(crowds).distinct()


def near_duplicates(docs: DataFrame, *, shingle: int = 3) -> DataFrame:
    """doc_id, fp (signed) and component_id of every document. Texts are read once and not shuffled."""
    own = written(docs.select("doc_id", fingerprint(F.col("text"), shingle).alias("fp")), "simhash-docs")
    return _with_components(own)


def _with_components(own: DataFrame) -> DataFrame:
    """own (doc_id, fp, ...) with component_id.

    A document whose fingerprint is its own and has no link is its component: only the others are looked up, so that no
    join gathers the copies of one text where these are few enough to broadcast.
    """
    reps = written(own.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n")), "simhash-fps")
    groups = written(components(links(reps.select("fp", "rep"))), "simhash-groups").withColumnRenamed("node", "fp")
    linked = reps.join(groups, "fp")
    least = linked.groupBy("component").agg(F.min("rep").alias("least"))
    named = linked.join(least, "component").select("fp", "least")
    shared = reps.join(named, "fp", "left").where("n > 1 or least is not null").select("fp", F.lit(True).alias("_sh_in"), F.coalesce("least", "rep").alias("_sh_c"))
    shared = written(shared, "simhash-shared")
    found = own.join(F.broadcast(shared) if shared.count() <= BROADCAST_KEYS else shared, "fp", "left")
    return found.withColumn("component_id", F.when(F.col("_sh_in"), F.col("_sh_c")).otherwise(F.col("doc_id"))).drop("_sh_in", "_sh_c")


#: More keys than this on the small side of a join with the documents are shuffled, not broadcast (about 30 bytes each).
BROADCAST_KEYS = 500_000


#: Documents are linked whose sets of shingles have a Jaccard similarity of SIMILAR[0] / SIMILAR[1] or more.
SIMILAR = (4, 5)
#: One document in so many is looked at for frequent shingles, which come last in the order of shingles. Any order gives
#: the same links; this one keeps common passages from making candidates.
LOOK_EVERY, FREQUENT, MOST_FREQUENT = 8, 3, 200_000


def _signed(hashes: np.ndarray) -> np.ndarray:
    return hashes.view(np.int64)


def _sets_of(keyed: DataFrame, shingle: int, row: str, schema: str, of) -> DataFrame:
    """mapInArrow over keyed's texts: the columns named in row, and those of (text's hashes, their sorted set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                hashes = [shingle_hashes(t.as_py(), shingle) for t in part.column(0)]
                columns = of(hashes, [np.unique(h) for h in hashes])
                yield pa.record_batch([*part.columns[1:], *columns.values()], [*part.schema.names[1:], *columns])

    return keyed.select("text", *row.split()).mapInArrow(run, schema)


def _frequent(keyed: DataFrame, shingle: int) -> np.ndarray:
    """Shingles that occur in FREQUENT or more of the documents looked at."""
    some = keyed.where(F.pmod(F.xxhash64("text"), F.lit(LOOK_EVERY)) == 0)
    of = lambda hashes, sets: {"g": pa.array([_signed(x) for x in sets], pa.list_(pa.int64()))}
    counts = _sets_of(some, shingle, "", "g array<long>", of).select(F.explode("g").alias("g")).groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    often = counts.where(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "g").limit(MOST_FREQUENT)
    return np.sort(often.select("g").toArrow()["g"].to_numpy())


def _similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) whose sets are similar enough, counted exactly."""
    a, b = SIMILAR
    u, v = (sets.select(F.col("s").alias(x), F.col("g").alias(f"g{x}")) for x in "uv")
    common = F.size(F.array_intersect("gu", "gv"))
    return pairs.join(u, "u").join(v, "v").where((a + b) * common >= a * (F.size("gu") + F.size("gv"))).select("u", "v")


def similar_groups(keyed: DataFrame, shingle: int) -> DataFrame:
    """keyed's doc_id, _sh_id and _sh_row with c, which names the component of its set of shingles.

    Every pair of sets with a similarity of SIMILAR or more is linked. Such sets have their share of SIMILAR in common,
    so in any order of shingles their first n - ceil(SIMILAR n) + 1 ones meet: these are keys, and sets that share a key
    are candidates, besides those that the fingerprints link. Candidates are verified by their whole sets. Sets of one
    key are first held against the least of them; pairs that this leaves in different components are verified then.
    """
    a, b = SIMILAR
    last = keyed.sparkSession.sparkContext.broadcast(_frequent(keyed, shingle))

    def first_ones(x: np.ndarray) -> np.ndarray:
        x, most = _signed(x), last.value
        often = most[np.minimum(np.searchsorted(most, x), len(most) - 1)] == x if len(most) else np.zeros(len(x), bool)
        return x[np.argsort(often, kind="stable")][: len(x) - -(-a * len(x) // b) + 1] if len(x) else x

    def of(hashes, sets):
        import xxhash

        return {
            "fp": pa.array([_fold(h) for h in hashes], pa.int64()),
            "s": pa.array([int(np.uint64(xxhash.xxh64_intdigest(x.tobytes(), 42)).view(np.int64)) if len(x) else 0 for x in sets], pa.int64()),
            "n": pa.array([len(x) for x in sets], pa.int64()),
            "keys": pa.array([first_ones(x) for x in sets], pa.list_(pa.int64())),
        }

    ids = f"doc_id {keyed.schema['doc_id'].dataType.simpleString()}, _sh_id string, _sh_row long"
    own = written(_sets_of(keyed, shingle, "doc_id _sh_id _sh_row", f"{ids}, fp long, s long, n long, keys array<long>", of), "similar-docs")
    reps = own.groupBy("s").agg(F.min(F.struct(F.col("doc_id").isNull(), "_sh_id", "_sh_row")).alias("k"), F.min("n").alias("n"))
    reps = written(reps.select("s", "k._sh_id", "k._sh_row", "n"), "similar-sets")
    keyed_sets = own.select("s", F.explode("keys").alias("key"))
    met = keyed_sets.groupBy("key").agg(F.min("s").alias("v"), F.max("s").alias("u"), F.count(F.lit(1)).alias("n")).where("u <> v")
    met = written(met, "similar-keys")
    # Of a key with two rows, the least and greatest are all; the members of others are looked up.
    busy = met.where("n > 2").select("key", "v")
    members = keyed_sets.join(F.broadcast(busy) if busy.count() <= BROADCAST_KEYS else busy, "key").select("key", "v", F.col("s").alias("u")).distinct()
    members = written(members, "similar-members")
    # Sets of one fingerprint meet the least of them, and those least ones where fingerprints are linked, each with the least it is linked to.
    prints = written(own.groupBy("fp").agg(F.min("s").alias("v"), F.max("s").alias("u")), "similar-prints")
    least = links(prints.select("fp")).groupBy("u").agg(F.min("v").alias("v"))
    of = {x: prints.select(F.col("fp").alias(x), F.col("v").alias(f"s{x}")) for x in "uv"}
    linked_prints = least.join(of["u"], "u").join(of["v"], "v").select(F.col("su").alias("u"), F.col("sv").alias("v"))
    stars = own.join(prints.where("u <> v").select("fp", "v"), "fp").select(F.col("s").alias("u"), "v").unionByName(linked_prints)
    stars = stars.unionByName(met.select("u", "v")).unionByName(members.select("u", "v"))
    # Up to the end of the keys that end first, sets have only keys in common; after it, at most what one has left. So a set's
    # keys that others have as keys (c) and what it has besides its keys (r) bound what it has in common with any other.
    shared = met.where("n = 2").select(F.explode(F.array("u", "v")).alias("s")).unionByName(members.select(F.col("u").alias("s"))).groupBy("s").agg(F.count(F.lit(1)).alias("c"))
    left_over = F.when(F.col("n") > 0, F.ceil(F.col("n") * a / b) - 1).otherwise(0)
    common = written(reps.join(shared, "s", "left").select("s", "n", F.coalesce("c", F.lit(0)).alias("c"), left_over.alias("r")), "similar-sizes")

    def fit(pairs: DataFrame) -> DataFrame:
        """The distinct pairs whose sizes allow them to be similar."""
        n = [common.select(F.col("s").alias(x), *[F.col(c).alias(f"{c}{x}") for c in "ncr"]) for x in "uv"]
        sized = pairs.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct().join(n[0], "u").join(n[1], "v")
        most = F.least("cu", "cv") + F.greatest("ru", "rv")
        sized = sized.where((b * F.least("nu", "nv") >= a * F.greatest("nu", "nv")) & ((a + b) * most >= a * (F.col("nu") + F.col("nv")))).drop("cu", "cv", "ru", "rv")
        # The same bound by the keys that two sets have in common.
        sized = written(sized, "similar-sized")
        able = sized.select(F.explode(F.array("u", "v")).alias("s")).distinct()
        held = written(own.select("s", "keys").join(able, "s", "left_semi").groupBy("s").agg(F.first("keys").alias("keys")), "similar-firsts")
        keys = [held.select(F.col("s").alias(x), F.col("keys").alias(f"k{x}")) for x in "uv"]
        left = F.greatest(F.col("nu") - F.size("ku"), F.col("nv") - F.size("kv"))
        most = F.size(F.array_intersect("ku", "kv")) + left
        return sized.join(keys[0], "u").join(keys[1], "v").where((a + b) * most >= a * (F.col("nu") + F.col("nv"))).select("u", "v")

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        pairs = written(fit(pairs), f"similar-pairs-{name}")
        if pairs.isEmpty():
            return pairs
        able = pairs.select(F.explode(F.array("u", "v")).alias("s")).distinct()
        rows = reps.join(able, "s", "left_semi").select("s", "_sh_id", "_sh_row")
        rows = written(rows, "similar-rows")
        texts = keyed.join(F.broadcast(rows) if rows.count() <= BROADCAST_KEYS else rows, ["_sh_id", "_sh_row"]).select("s", "text")
        sets = _sets_of(texts, shingle, "s", "s long, g array<long>", lambda hashes, sets: {"g": pa.array([_signed(x) for x in sets], pa.list_(pa.int64()))})
        return written(_similar(pairs, written(sets.dropDuplicates(["s"]), "similar-shingles")), f"similar-links-{name}")

    linked = verified(stars, "stars")
    so_far = written(components(linked), "similar-so-far")
    placed = members.join(so_far.select(F.col("node").alias("u"), "component"), "u", "left").select("key", "u", F.coalesce("component", "u").alias("c"))
    x, y = (placed.select("key", F.col("u").alias(n), F.col("c").alias(f"c{n}")) for n in "uv")
    rest = x.join(y, "key").where("u > v and cu <> cv").select("u", "v")
    linked = verified(rest, "rest")
    groups = so_far if linked.isEmpty() else written(components(so_far.select(F.col("node").alias("u"), F.col("component").alias("v")).unionByName(linked)), "similar-groups")
    named = reps.join(groups.withColumnRenamed("node", "s"), "s", "left").select("s", F.coalesce("component", "s").alias("c"))
    return own.select("doc_id", "_sh_id", "_sh_row", "s").join(named, "s").select("c", "doc_id", "_sh_id", "_sh_row")


def drop_near_duplicates(docs: DataFrame, *, shingle: int = 5) -> DataFrame:
    """The documents without near-copies: of each component of ``similar_groups``, one row with the least doc_id stays.

    Of rows that also share that id, the one with the least hash of all columns stays. What leaves is looked up by key;
    texts move only if very many keys leave.
    """
    columns = docs.columns
    mine = {"_sh_id": F.coalesce(F.concat(F.lit("d"), F.col("doc_id").cast("string")), F.lit("n")), "_sh_row": F.xxhash64(*[F.col(c).cast("string") for c in columns])}
    keyed = docs.withColumns(mine)
    found = similar_groups(keyed, shingle)
    first = found.groupBy("c").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_sh_row", "_sh_id")).alias("k"))
    kept = first.select(F.col("k._sh_id").alias("_sh_id"), F.col("k._sh_row").alias("_sh_row"), F.lit(True).alias("stays"))
    keys = found.groupBy("_sh_id", "_sh_row").agg(F.count(F.lit(1)).alias("n")).join(kept, ["_sh_id", "_sh_row"], "left")
    odd = written(keys.where("stays is null or n > 1"), "simhash-leaving")
    few = F.broadcast if odd.count() <= BROADCAST_KEYS else lambda x: x
    alone = keyed.join(few(odd.select("_sh_id", "_sh_row")), ["_sh_id", "_sh_row"], "left_anti").select(*columns)
    one = Window.partitionBy("_sh_id", "_sh_row").orderBy("_sh_id")
    equal = keyed.join(few(odd.where("stays").select("_sh_id", "_sh_row")), ["_sh_id", "_sh_row"], "left_semi")
    return alone.unionByName(equal.withColumn("_sh_n", F.row_number().over(one)).where("_sh_n = 1").select(*columns))


def op4_simhash_pigeonhole(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return near_duplicates(docs).select("doc_id", hexed, "component_id")

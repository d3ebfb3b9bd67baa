"""Line dedup by a deletion-neighbourhood join.

Two lines are near-copies if at most one edit of a word (a word changed, added or left out) makes their words equal. A
line's neighbourhood is its words and its words with any one left out; two lines are within one edit exactly if one is
the other with a word left out, or both are equal with the word at the same place left out. So every line emits its
variants as hashed keys, equal keys are joined, the words of what meets are compared, and a line within the bound of
an earlier one is dropped. Order is by (doc_id, place in the document), null ids last.

The edit bound of two lines is one, and zero if one of them has fewer than ``LEAST_WORDS`` words: an edit there
leaves too little of it. Shorter lines so go if an equal line came before.

Only lines that can meet another emit variants. A line within one edit of another shares with it the words before or
those behind the edit; both have a beginning and an end of set lengths, cut for the shorter of the two, one of which is
the same. Lines whose beginnings and ends no other line has are left out by counting these keys. That loses no pair.

Hashes of variants are put together from those of single words at their places, in time that grows with the line's length.
Counts and least members are combined before each shuffle, so no key gathers rows: a key with two members needs no join,
and the members of others are looked up. Only lines that meet another have their words read again.

Defined results: a null text stays null; an empty text stays empty; blank lines stay where they are unless all else of
the document goes; repeated rows are one document, whose rows all stay; documents that share an id (or have none) are
told apart by their texts, in an order of their hashes; an empty table gives an empty result. ``dedup_lines``
carries all columns; working columns carry the prefix ``_ld_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curvemill.llm import text as T
from curvemill.llm.scratch import written

LEAST_WORDS = 5
#: Rows on the small side of a join with the documents or their lines up to which it is broadcast (about 100 bytes each).
BROADCAST_ROWS = 400_000


def _small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """df, a written table, for a join with the documents: broadcast only if its counted rows are few."""
    return F.broadcast(df) if (df.count() if rows is None else rows) <= BROADCAST_ROWS else df


#: A document is known by two hashes of its id and text, so that ids that are null or shared tell texts apart.
_KEYS = ("d", "e")


def _document() -> dict[str, Column]:
    return {"d": F.xxhash64("doc_id", "text"), "e": F.xxhash64(F.lit(11), F.col("text"))}


def _lines(docs: DataFrame, *also: str) -> DataFrame:
    """The document's keys, i (place of the line) and line of every line."""
    return docs.where("text is not null").withColumns(_document()).select(*also, *_KEYS, F.posexplode(F.split("text", "\n")).alias("i", "line"))


def _grid(n: Column) -> Column:
    """The largest of 1, 2, 3, 4, 6, 8, 12, 16, 24, ... up to n."""
    power = F.pow(F.lit(2.0), F.floor(F.log2(n.cast("double")))).cast("int")
    more = power + F.floor(power / 2).cast("int")
    return F.when(n >= more, more).otherwise(power)


def line_hashes(docs: DataFrame) -> DataFrame:
    """doc_id, d, e, i, h, h2 (hashes of the words) and keys (h, and for lines with a bound the beginnings and ends) of every line with a word."""
    each = _lines(docs, "doc_id").select("doc_id", *_KEYS, "i", T.spaced(F.col("line")).alias("s")).where("s <> ''")
    each = each.withColumn("n", T.count_words(F.col("s")))
    cuts = {}
    for which, short in ((0, F.col("n")), (1, F.col("n") - 1)):
        first = _grid(F.greatest(F.floor(short / 2), F.lit(1)))
        cuts |= {f"b{which}": first, f"c{which}": _grid(F.greatest(short - first, F.lit(1)))}
    each = each.withColumns({"h": F.xxhash64("s"), "h2": F.xxhash64(F.lit(7), "s"), **cuts})
    ends = [f"xxhash64(1, substring_index(s, ' ', b{k})), xxhash64(2, substring_index(s, ' ', -c{k}))" for k in (0, 1)]
    ends = F.array_distinct(F.expr(f"array(h, {', '.join(ends)})"))
    keys = F.when(F.col("n") >= LEAST_WORDS, ends).otherwise(F.array("h"))
    return written(each.select("doc_id", *_KEYS, "i", "h", "h2", keys.alias("keys")), "lines-hashes")


def meeting_lines(hashes: DataFrame) -> DataFrame:
    """The rows of hashes that may repeat another line or be near one (able)."""
    keyed = hashes.select("h", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.min("h").alias("a"), F.max("h").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = written(shared.where("a <> b or key = a"), "lines-keys")
    busy = shared.where("a <> b and n > 2").select("key")
    repeated = shared.where("a = b").select(F.col("a").alias("h"), F.lit(False).alias("able"))
    near = shared.where("a <> b and n = 2").select(F.explode(F.array("a", "b")).alias("h"))
    near = near.unionByName(keyed.join(_small(busy), "key", "left_semi").select("h")).withColumn("able", F.lit(True))
    wanted = written(near.unionByName(repeated).groupBy("h").agg(F.max("able").alias("able")), "lines-wanted")
    return written(hashes.drop("keys").join(_small(wanted), "h"), "lines-part")


def _place() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("doc"), F.col("i").alias("i"), *[F.col(k).alias(k) for k in _KEYS])


def first_lines(part: DataFrame) -> DataFrame:
    """h, h2, first (earliest place), n (how often) and able of every distinct line of part."""
    return written(part.groupBy("h", "h2").agg(F.min(_place()).alias("first"), F.count(F.lit(1)).alias("n"), F.max("able").alias("able")), "lines-first")


def variants(met: DataFrame) -> DataFrame:
    """(key, check, o, at) of the lines (o, words): without the word at ``at``, and whole (at -1).

    A sequence's key is the exclusive or of the hashes of its words with their places.
    """
    words = met.repartition("o").select("o", F.posexplode("words").alias("at", "w"))
    hashed = {f"{x}{k}": F.xxhash64(F.lit(seed), "w", F.col("at") - back) for k, seed in ((0, 3), (1, 5)) for x, back in (("f", 0), ("g", 1))}
    words = words.withColumns(hashed)
    line = Window.partitionBy("o").orderBy("at")
    upto, every = line.rowsBetween(Window.unboundedPreceding, 0), line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    run = {f"{x}_{k}": F.bit_xor(f"{x}{k}").over(upto) for k in (0, 1) for x in "fg"}
    total = {f"{x}_all{k}": F.bit_xor(f"{x}{k}").over(every) for k in (0, 1) for x in "fg"}
    words = words.withColumns({**run, **total})
    left_out = [F.col(f"f_{k}").bitwiseXOR(F.col(f"f{k}")).bitwiseXOR(F.col(f"g_all{k}")).bitwiseXOR(F.col(f"g_{k}")) for k in (0, 1)]
    both = F.array(
        F.struct(left_out[0].alias("key"), left_out[1].alias("check"), F.col("at").alias("at")),
        F.when(F.col("at") == 0, F.struct(F.col("f_all0").alias("key"), F.col("f_all1").alias("check"), F.lit(-1).alias("at"))),
    )
    return words.select("o", F.explode(F.array_compact(both)).alias("v")).select("v.key", "v.check", "o", "v.at")


def within_one_edit(a: Column, b: Column) -> Column:
    """Whether at most one word changed, added or left out makes the words of a those of b."""

    def common(x: Column, y: Column) -> Column:
        differ = F.array_position(F.zip_with(x, y, lambda p, q: ~p.eqNullSafe(q)), True).cast("int")
        return F.when(differ == 0, F.least(F.size(x), F.size(y))).otherwise(differ - 1)

    longer = F.greatest(F.size(a), F.size(b))
    return (F.abs(F.size(a) - F.size(b)) <= 1) & (common(a, b) + common(F.reverse(a), F.reverse(b)) >= longer - 1)


def near_lines(docs: DataFrame, firsts: DataFrame) -> DataFrame:
    """(h, h2) of the distinct lines that have an earlier line within one edit."""
    order = ["first.n", "first.doc", "first.i", *[f"first.{k}" for k in _KEYS]]
    able = firsts.where("able").orderBy(*order).select("h", "h2", *[F.col(f"first.{k}").alias(k) for k in (*_KEYS, "i")], F.monotonically_increasing_id().alias("o"))
    able = written(able, "lines-able")
    # Documents without such a line are left out before their lines are split.
    holders = written(able.select(*_KEYS).distinct(), "lines-holders")
    holders = docs.select("doc_id", "text").withColumns(_document()).join(_small(holders), [*_KEYS], "left_semi").select("doc_id", "text")
    met = _lines(holders).join(_small(able.select(*_KEYS, "i", "o")), [*_KEYS, "i"]).select("o", T.spaced(F.col("line")).alias("s"))
    met = written(met.dropDuplicates(["o"]).select("o", F.split("s", " ").alias("words")), "lines-met")

    keyed = written(variants(met), "lines-variants")
    shared = keyed.groupBy("key", "check").agg(F.min("o").alias("a"), F.max("o").alias("b"), F.count(F.lit(1)).alias("n")).where("a <> b")
    shared = written(shared, "lines-shared")
    two = shared.where("n = 2").select(F.col("b").alias("o"), F.col("a").alias("earlier"))
    held = keyed.join(_small(shared.where("n > 2").select("key", "check")), ["key", "check"], "left_semi")
    held = written(held, "lines-held")
    # A word changed: equal without the word at one place.
    least = held.where("at >= 0").groupBy("key", "check", "at").agg(F.min("o").alias("earlier"))
    changed = held.join(least, ["key", "check", "at"]).where("o > earlier").select("o", "earlier")
    # A word more or less: one line is another without a word. Two longer lines around one shorter are two edits apart.
    more = F.min(F.when(F.col("at") >= 0, F.col("o"))).alias("longer")
    ends = held.groupBy("key", "check").agg(more, F.min(F.when(F.col("at") < 0, F.col("o"))).alias("shorter")).where("longer is not null and shorter is not null")
    other = F.when(F.col("at") >= 0, F.col("shorter")).otherwise(F.col("longer"))
    added = held.join(ends, ["key", "check"]).where(F.col("o") > other).select("o", other.alias("earlier"))
    pairs = written(two.unionByName(changed).unionByName(added).distinct(), "lines-pairs")

    mine, its = met.select("o", F.col("words").alias("x")), met.select(F.col("o").alias("earlier"), F.col("words").alias("y"))
    verified = pairs.join(mine, "o").join(its, "earlier").where(within_one_edit(F.col("x"), F.col("y"))).select("o").distinct()
    return able.join(verified, "o", "left_semi").select("h", "h2")


def dropped_lines(docs: DataFrame) -> DataFrame:
    """(d, e, i) of every line that repeats an earlier one or is within the bound of an earlier one."""
    part = meeting_lines(line_hashes(docs))
    firsts = first_lines(part)
    near = near_lines(docs, firsts).withColumn("near", F.lit(True))
    found = firsts.join(near, ["h", "h2"], "left").where("n > 1 or near").select("h", "h2", "first", F.coalesce("near", F.lit(False)).alias("near"))
    here = part.join(found, ["h", "h2"])
    return here.where(F.col("near") | (F.col("first") != _place())).select(*_KEYS, "i").distinct()


def dedup_lines(docs: DataFrame) -> DataFrame:
    """docs without the lines that repeat, or nearly repeat, an earlier one; documents left without a word go."""
    columns = docs.columns
    names = {k: f"_ld_{k}" for k in _KEYS}
    gone = dropped_lines(docs).groupBy(*[F.col(k).alias(v) for k, v in names.items()]).agg(F.collect_list("i").alias("_ld_gone"))
    gone = written(gone, "lines-gone")
    size = gone.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.size("_ld_gone")), F.lit(0)).alias("lines")).first()
    joined = docs.withColumns({names[k]: c for k, c in _document().items()}).join(_small(gone, size["rows"] + size["lines"] // 16), [*names.values()], "left")

    def kept(lines: Column) -> Column:
        places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_ld_gone"))
        return F.array_join(F.transform(places, lambda i: lines[i]), "\n")

    text = F.when(F.col("_ld_gone").isNull(), F.col("text")).otherwise(T.let(F.split("text", "\n"), kept))
    out = joined.withColumn("text", text).where(F.col("_ld_gone").isNull() | (F.btrim("text", F.lit(T.SPACE)) != ""))
    return out.select(*columns)


def op5_deletion_neighbourhood(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    n = F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n"))).cast("long")
    return dedup_lines(docs).select("doc_id", n.alias("n_lines"), F.md5(F.col("text").cast("binary")).alias("text_md5"))


OP5_SQL = r"""
with docs as (select doc_id, text from documents),
each as (select doc_id, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as i from docs where text is not null),
split as (select doc_id, i, line, list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda w: w <> '') as words from each),
worded as (select doc_id, i, words from split where len(words) > 0),
firsts as (select words, min((doc_id, i)) as first from worded group by words),
able as (select words, first from firsts where len(words) >= 5),
variants as (
    select words, first, p, list_concat(words[1:p - 1], words[p + 1:]) as v
    from (select words, first, unnest(range(1, len(words) + 1)) as p from able)
),
changed as (select words from (select words, first, min(first) over (partition by p, v) as least from variants) where first > least),
added as (
    select case when a.first > b.first then a.words else b.words end as words from variants a join able b on a.v = b.words
),
near as (select distinct words from (select * from changed union all select * from added)),
gone as (select l.doc_id, l.i from worded l join firsts f using (words) where (l.doc_id, l.i) > f.first or l.words in (select words from near)),
kept as (select s.doc_id, s.i, s.line from split s anti join gone g on g.doc_id = s.doc_id and g.i = s.i)
select d.doc_id, case when d.text is null then 0 else coalesce(k.n_lines, 0) end::bigint as n_lines, case when d.text is not null then md5(coalesce(k.text, '')) end as text_md5
from docs d left join (select doc_id, count(*) as n_lines, string_agg(line, chr(10) order by i) as text from kept group by doc_id) k using (doc_id)
where d.doc_id not in (select doc_id from gone) or regexp_matches(coalesce(k.text, ''), '[^\x20\x09-\x0D]')
"""

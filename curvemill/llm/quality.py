"""Quality rules: a hashed n-gram log-likelihood ratio between trusted documents and the raw corpus.

Words and word pairs are hashed into ``BUCKETS``. Over all documents, the buckets' counts make a raw multinomial, and over
the documents labelled good (quality 1, not toxic) a target multinomial. A document's ``score`` is the mean log ratio
target / raw of its n-grams, both smoothed by ``PRIOR`` a bucket, so it does not depend on length. Uniform smoothing pulls
the smaller target down, the more so the smaller the input; so the verdict takes the same mean with the target smoothed
towards the raw multinomial by as many counts, where missing evidence gives ratio 0 at every size. A document is kept if
that reaches ``THRESHOLD``. Base rules reject short texts and texts that mostly repeat themselves before that.

Everything is DataFrame expressions: n-grams are exploded only into bucket counts that are combined before the
shuffle (at most BUCKETS rows a task), and the bucket weights, a list of fixed size, go to the tasks as one literal.

Defined results: a null or blank text has no words, fails the base rules and has a null score; without labelled
documents every score is 0 and the base rules decide; equal rows get equal results; an
empty table gives an empty result. ``quality_rules`` carries all columns; working columns carry the prefix ``_qr_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curvemill.llm import text as T

BUCKETS, PRIOR, THRESHOLD = 1 << 15, 10.0, -0.12
MIN_WORDS, MAX_REPEATED_PERCENT = 20, 30
#: More trusted ids than this are joined by a shuffle; fewer are broadcast (8 bytes each).
BROADCAST_IDS = 1_000_000


def _pairs(values: Column, shift: int) -> Column:
    """Hashes of the values and those ``shift`` places on; fewer by shift."""
    n = F.greatest(F.size(values) - shift, F.lit(0))
    return F.zip_with(F.slice(values, F.lit(1), n), F.slice(values, F.lit(shift + 1), n), lambda a, b: F.xxhash64(a, b))


def _hashed(docs: DataFrame) -> DataFrame:
    """docs with _qr_w (words), _qr_1 (their hashes) and _qr_2 (hashes of neighbours)."""
    words = docs.withColumn("_qr_w", T.words(F.col("text")))
    hashed = words.withColumn("_qr_1", F.transform("_qr_w", lambda w: F.xxhash64(w)))
    return hashed.withColumn("_qr_2", _pairs(F.col("_qr_1"), 1))


def _buckets() -> Column:
    return F.concat("_qr_1", "_qr_2")


def _bucket(gram: Column) -> Column:
    """The top bits of a hash."""
    return F.shiftrightunsigned(gram, 65 - BUCKETS.bit_length()).cast("int")


def bucket_counts(docs: DataFrame) -> DataFrame:
    """(bucket, n) over all n-grams of docs."""
    grams = _hashed(docs.select("text")).select(F.explode(_buckets()).alias("g"))
    return grams.groupBy(_bucket(F.col("g")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def trusted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose id is labelled good."""
    ids = labels.where("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null").select("doc_id").distinct()
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    return docs.join(ids, "doc_id", "left_semi")


def weights(docs: DataFrame, labels: DataFrame) -> tuple[list[float], list[float]]:
    """log(target / raw) of every bucket for the score and for the verdict, from two lists of BUCKETS counts whatever the input."""
    raw, target = [0] * BUCKETS, [0] * BUCKETS
    for counts, of in ((raw, docs), (target, trusted(docs.select("doc_id", "text"), labels))):
        for r in bucket_counts(of).collect():
            counts[r["bucket"]] = r["n"]
    import math

    n_raw, n_target, prior = sum(raw), sum(target), PRIOR * BUCKETS
    if not n_target:
        return [0.0] * BUCKETS, [0.0] * BUCKETS
    log_raw, log_target = math.log(n_raw + prior), math.log(n_target + prior)
    score = [math.log(t + PRIOR) - log_target - math.log(r + PRIOR) + log_raw for t, r in zip(target, raw)]
    # The prior's counts fall on the buckets by their share of raw: (t + prior r / n_raw) / (n_target + prior) / (r / n_raw).
    return score, [math.log(t * n_raw / r + prior) - log_target if r else 0.0 for t, r in zip(target, raw)]


def _score(values: list[float]) -> Column:
    table = F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")  # folded to one literal
    n = F.size("_qr_1") + F.size("_qr_2")
    total = sum((F.aggregate(c, F.lit(0.0), lambda s, g: s + F.get(table, _bucket(g))) for c in ("_qr_1", "_qr_2")), F.lit(0.0))
    return F.when(n > 0, total / n)


def _let(value: Column, use) -> Column:
    """use(value), with value evaluated once: as the argument of a lambda over a list of one."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _covered(h8: Column) -> Column:
    """Words in windows whose hash occurs again; h8 has the hash of each 8-word window."""
    placed = F.array_sort(F.zip_with(h8, F.sequence(F.lit(0), F.size(h8) - 1), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    none = F.array(F.lit(None).cast("struct<h:bigint,i:int>"))

    def repeated(sorted_places: Column) -> Column:
        n = F.size(sorted_places)
        # Each place with its neighbour on the right: equal hashes mark both.
        pairs = F.zip_with(sorted_places, F.concat(F.slice(sorted_places, F.lit(2), n), none), lambda c, a: F.struct(c["i"].alias("i"), F.when(c["h"] == a["h"], a["i"]).alias("j")))
        twice = F.filter(pairs, lambda p: p["j"].isNotNull())
        return F.array_sort(F.array_distinct(F.concat(F.transform(twice, lambda p: p["i"]), F.transform(twice, lambda p: p["j"]))))

    def words(places: Column) -> Column:
        steps = F.zip_with(places, F.concat(F.slice(places, F.lit(2), F.size(places)), F.array(F.lit(2147483647))), lambda a, b: F.least(b - a, F.lit(8)))
        return F.aggregate(steps, F.lit(0), lambda s, x: s + x)

    return _let(_let(placed, repeated), words)


def base_rules(docs: DataFrame) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, and the columns of _hashed."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(T.SPACE)) != "")
    four = _hashed(docs).withColumn("_qr_4", _pairs(F.col("_qr_2"), 2))
    counted = four.withColumn("_qr_8", _pairs(F.col("_qr_4"), 4)).withColumn("_qr_l", lines)
    again = F.size("_qr_8") > F.size(F.array_distinct("_qr_8"))
    counted = counted.withColumns(
        {
            "n_words": F.size("_qr_w").cast("long"),
            "word_chars": F.length(F.array_join("_qr_w", "")).cast("long"),
            "n_symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long"),
            "n_dup_lines": (F.size("_qr_l") - F.size(F.array_distinct("_qr_l"))).cast("long"),
            "n_repeat_words": F.when(again, _covered(F.col("_qr_8"))).otherwise(0).cast("long"),
        }
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs with the base counts, base_failed, score and kept; columns of those names are replaced."""
    mine = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept"]
    score, verdict = weights(docs, labels)
    scored = base_rules(docs.drop(*mine)).withColumn("score", _score(score))
    kept = ~F.col("base_failed") & F.coalesce(_score(verdict) >= THRESHOLD, F.lit(False))
    return scored.withColumn("kept", kept).drop("_qr_w", "_qr_1", "_qr_2", "_qr_4", "_qr_8", "_qr_l")


def keep_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the rules keep, with their own columns whatever their names."""
    packed = docs.select("doc_id", "text", F.struct("*").alias("_qr_row"))
    # Rows are unpacked from a list of one or none: a filter would be pushed below and evaluate the rules many times over.
    row = F.array("_qr_row")
    return quality_rules(packed, labels).select(F.inline(F.when(F.col("kept"), row).otherwise(F.slice(row, 1, 0))))


def op1_likelihood_ratio(spark, sf_dir: str) -> DataFrame:
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"]
    return quality_rules(docs, labels).select(*columns[:-1], F.round("score", 6).alias("score"))

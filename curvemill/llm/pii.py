"""Personal data: pattern spans, and information-theoretic sanitisation of the terms that go with them.

The patterns find e-mail addresses, IP addresses, card numbers and phone numbers. Each normalised value is a
protected entity. A term anywhere in a document that mentions an entity discloses it by

    disclosure = PMI(entity; term) / IC(entity) = log(N n_et / (n_e n_t)) / log(N / n_e)

with document counts over the whole corpus: 1 means that whoever reads the term can infer the entity, 0 that it
says nothing. Where it reaches ``GENERALISE`` the term's mentions in that entity's documents give way to the kind of word they
are (<name>, <acronym> or <word>), and where it reaches ``REMOVE`` they are cut out. Copies of one text are no evidence, so a pair that occurs in fewer than
``SUPPORT`` different texts counts once, and its P(entity | term) is shrunk by one imagined document that holds the
term and has the entity at its base rate:

    disclosure = log((1 + p) / (n_t' + 1) / p) / log(1 / p),   p = n_e' / N

with n_t' and n_e' less the pair's other copies. So values of one text are covered as well; they are alike to any term,
and stand as one entity, that of their text. Terms of documents without protected entities are left alone.

Defined results: a null or empty text has no spans; an entity that occurs in all documents has no information
to disclose; equal rows get equal spans; an empty table gives an empty result. Extra columns are carried by
``sanitise``; working columns carry the prefix ``_pii_``.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curvemill.llm.scratch import written

SUPPORT, GENERALISE, REMOVE = 2, 0.8, 0.95
KINDS = ("email", "ip", "card", "phone", "term")
#: More frequent terms than this are left out by a shuffle; fewer are broadcast.
BROADCAST_TERMS = 500_000
#: Distinct terms that a task counts before it hands them on.
FLUSH = 200_000
#: Bits of the filter that tells the tasks which terms to count; what passes it by chance is dropped by a join.
ASKED_BITS = 1 << 24

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TERM = re.compile(r"[^\W\d_]{3,}")

_FOUND = "array<struct<kind:string,start:int,end:int>>"
_NO_TERMS = "cast(array() as array<struct<start:int,end:int,disclosure:double>>)"
_HELD = "array<struct<term:string,at:array<struct<start:int,end:int>>>>"


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches found from each '@' outwards, so that a long run of letters is read once."""
    done, at = 0, text.find("@")
    while at >= 0:
        if at >= done:
            start = at
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            if start < at and (m := _DOMAIN.match(text, at + 1)):
                done = m.end()
                yield start, done
        at = text.find("@", at + 1)


def _luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def find_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, normalised value) of all pattern matches, by kind and then start."""
    found = [("email", a, b, text[a:b].lower()) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") or "0" for p in m.groups()]
        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
            found.append(("ip", m.start(), m.end(), ".".join(parts)))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and _luhn(digits):
                found.append(("card", m.start(), m.end(), digits))
    if "+" in text:
        for m in _PHONE.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if 8 <= len(digits) <= 15:
                found.append(("phone", m.start(), m.end(), digits))
    return found


def _terms(text: str, spans: list[tuple[str, int, int, str]]) -> list[dict]:
    """The distinct terms of a text and all their places, but for those inside a match."""
    taken, k = sorted((a, b) for _, a, b, _ in spans), 0
    held: dict[str, list] = {}
    end = 0  # of the matches that start before the term ends
    for m in _TERM.finditer(text):
        while k < len(taken) and taken[k][0] < m.end():
            end = max(end, taken[k][1])
            k += 1
        if end <= m.start():
            held.setdefault(m[0].lower(), []).append({"start": m.start(), "end": m.end()})
    return [{"term": t, "at": at} for t, at in held.items()]


def _joined(spans: list[tuple]) -> str:
    return ",".join(f"{s[0]}:{s[1]}:{s[2]}" for s in spans)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    held_type = pa.list_(pa.struct([("term", pa.string()), ("at", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))]))
    for batch in batches:
        spans, entities, held, sums, hashes, counts = [], [], [], [], [], {k: [] for k in KINDS[:4]}
        for value in batch.column(1):
            text = value.as_py() or ""
            found = find_spans(text)
            spans.append([{"kind": k, "start": a, "end": b} for k, a, b, _ in found])
            entities.append(sorted({f"{k}:{value}" for k, _, _, value in found}))
            held.append(_terms(text, found) if found else [])
            sums.append(hashlib.sha256(_joined(found).encode()).hexdigest())
            hashes.append(int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True) if found else 0)
            for k in counts:
                counts[k].append(sum(1 for s in found if s[0] == k))
        columns = [batch.column(0), pa.array(spans, kind_type), pa.array(entities, pa.list_(pa.string())), pa.array(held, held_type), pa.array(sums, pa.string()), pa.array(hashes, pa.int64()), *[pa.array(counts[k], pa.int64()) for k in counts]]
        yield pa.record_batch(columns, ["doc_id", "base", "entities", "held", "base_sha256", "text_hash", *[f"n_{k}" for k in counts]])


def _term_counter(asked: np.ndarray):
    """Partial document counts of the terms whose bit is set in ``asked``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        seen: Counter = Counter()
        wanted: dict[str, bool] = {}

        def rows():
            return pa.record_batch([pa.array(list(seen.keys()), pa.string()), pa.array(list(seen.values()), pa.int64())], ["term", "n"])

        for batch in batches:
            for value in batch.column(0):
                if text := value.as_py():
                    terms = set(_TERM.findall(text.lower()))
                    for t in terms.difference(wanted):
                        bit = xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass"), 42) % ASKED_BITS
                        wanted[t] = bool(asked[bit >> 3] >> (bit & 7) & 1)
                    seen.update(t for t in terms if wanted[t])
                    if len(seen) > FLUSH:
                        yield rows()
                        seen.clear()
                    if len(wanted) > FLUSH:
                        wanted.clear()
        if seen:
            yield rows()

    return run


def _asked_bits(terms: DataFrame) -> np.ndarray:
    """A bitmap of ASKED_BITS over the terms' hashes: its size doesn't depend on their number."""
    bits = terms.select(F.pmod(F.xxhash64("term"), F.lit(ASKED_BITS)).alias("b"))
    words = bits.groupBy(F.expr("b div 32").alias("at")).agg(F.expr("bit_or(shiftleft(1L, cast(pmod(b, 32) as int)))").alias("w"))
    out = np.zeros(ASKED_BITS // 32, "<u4")
    for r in words.toLocalIterator():
        out[r["at"]] = r["w"]
    return out.view(np.uint8)


def scan(docs: DataFrame) -> DataFrame:
    """A row for each document, with a row id, its pattern spans, entities and terms; written once."""
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, base {_FOUND}, entities array<string>, held {_HELD}, base_sha256 string, text_hash long, " + ", ".join(f"n_{k} long" for k in KINDS[:4])
    return written(docs.select("doc_id", "text").mapInArrow(_scan, schema).withColumn("row_id", F.monotonically_increasing_id()), "pii-spans")


def _mentions(found: DataFrame) -> DataFrame:
    """(row_id, text_hash, entity) of each entity in a document; values that only one text has are that text's entity."""
    each = found.select("row_id", "text_hash", F.explode("entities").alias("entity"))
    many = each.groupBy("entity").agg(F.min("text_hash").alias("a"), F.max("text_hash").alias("b")).where("a <> b").select("entity", F.lit(True).alias("many"))
    own = F.concat(F.lit("text:"), F.col("text_hash").cast("string"))
    return each.join(many, "entity", "left").select("row_id", "text_hash", F.when(F.col("many"), F.col("entity")).otherwise(own).alias("entity")).distinct()


def disclosures(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(entity, term, disclosure) of the pairs that reach GENERALISE, from counts over all documents."""
    n_docs = found.count()
    mentions = written(_mentions(found), "pii-mentions")
    holders = written(mentions.groupBy("entity").agg(F.count(F.lit(1)).alias("n_e")), "pii-holders")
    words = found.where("size(entities) > 0").select("row_id", F.explode("held.term").alias("term"))
    asked = words.select("term").distinct()
    counter = _term_counter(_asked_bits(asked))
    terms = written(docs.select("text").mapInArrow(counter, "term string, n long").groupBy("term").agg(F.sum("n").alias("n_t")), "pii-terms")

    def able(n_e):
        # n_et is at most n_e: a pair that reaches GENERALISE has no more documents of the term outside the entity's.
        return F.col("n_t") - n_e <= F.pow(F.lit(float(n_docs)), 1 - GENERALISE) * F.pow(n_e, GENERALISE) + 1

    most = F.lit(float(holders.agg(F.max("n_e")).first()[0] or 0))
    hot = terms.where(~able(most)).select("term")
    rare = words.join(F.broadcast(hot) if hot.count() <= BROADCAST_TERMS else hot, "term", "left_anti").join(terms, "term", "left")
    near = mentions.join(holders, "entity").join(rare, "row_id").where(F.col("n_t").isNull() | able(F.col("n_e")))
    each = near.groupBy("entity", "term", "text_hash").agg(F.count(F.lit(1)).alias("n"), F.first("n_e").alias("n_e"), F.first("n_t").alias("n_t"))
    pairs = each.groupBy("entity", "term").agg(F.sum("n").alias("n_et"), F.count(F.lit(1)).alias("texts"), F.first("n_e").alias("n_e"), F.first("n_t").alias("n_t"))
    n_t = F.greatest(F.coalesce("n_t", "n_et"), "n_et")
    ratio = F.log(n_docs * F.col("n_et") / (F.col("n_e") * n_t)) / F.log(n_docs / F.col("n_e"))
    p = (F.col("n_e") - F.col("n_et") + 1) / n_docs
    shrunk = F.log((1 + p) / (n_t - F.col("n_et") + 2) / p) / -F.log(p)
    ratio = F.when(F.col("texts") >= SUPPORT, ratio).otherwise(shrunk)
    scored = pairs.where(F.col("n_e") < n_docs).withColumn("disclosure", ratio)
    return scored.where(F.col("disclosure") >= GENERALISE).select("entity", "term", "disclosure")


def all_spans(docs: DataFrame) -> DataFrame:
    """The rows of ``scan`` with ``terms``, the disclosing terms' spans (start, end, disclosure) in order."""
    found = scan(docs)
    risky = written(disclosures(docs, found), "pii-disclosures")
    held = found.where("size(entities) > 0").select("row_id", F.explode("held").alias("x")).select("row_id", "x.term", "x.at")
    marked = _mentions(found).join(risky, "entity").groupBy("row_id", "term").agg(F.max("disclosure").alias("disclosure"))
    hit = held.join(marked, ["row_id", "term"]).select("row_id", "disclosure", F.inline("at")).groupBy("row_id", "start", "end").agg(F.max("disclosure").alias("disclosure"))
    terms = hit.groupBy("row_id").agg(F.array_sort(F.collect_list(F.struct("start", "end", "disclosure"))).alias("terms"))
    return found.join(terms, "row_id", "left")


def sanitise(docs: DataFrame) -> DataFrame:
    """The documents with their texts sanitised: values give way to <kind>, terms to the kind of word they are or nothing."""
    columns = docs.columns
    keys = F.struct(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("h"))
    texts = docs.select("doc_id", "text")
    spans = all_spans(texts.withColumn("doc_id", F.struct("doc_id", keys.alias("k"))))
    edits = F.concat(
        F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.concat(F.lit("<"), s["kind"], F.lit(">")).alias("by"))),
        F.transform(F.coalesce("terms", F.expr(_NO_TERMS)), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.when(s["disclosure"] >= REMOVE, "").alias("by"))),
    )
    edited = spans.where("size(base) > 0").select(F.col("doc_id.k").alias("_pii_k"), edits.alias("_pii_e")).dropDuplicates(["_pii_k"])

    def general(word: str) -> str:
        return "<acronym>" if word.isupper() else "<name>" if word[:1].isupper() else "<word>"

    @F.udf("string", useArrow=True)
    def apply(text, changes):
        if not changes:
            return text
        out, at = [], 0
        for c in sorted(changes, key=lambda c: (c["start"], -c["end"])):
            if c["start"] >= at:
                out += [text[at : c["start"]], general(text[c["start"] : c["end"]]) if c["by"] is None else c["by"]]
                at = c["end"]
        return "".join([*out, text[at:]])

    joined = docs.withColumn("_pii_k", keys).join(edited, "_pii_k", "left")
    return joined.withColumn("text", F.when(F.col("_pii_e").isNull(), F.col("text")).otherwise(apply("text", "_pii_e"))).select(*columns)


def op6_information_sanitiser(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    spell = lambda kind, s: F.concat_ws(":", kind, s["start"].cast("string"), s["end"].cast("string"))
    spans = F.concat(
        F.transform("base", lambda s: spell(s["kind"], s)),
        F.transform(F.coalesce("terms", F.expr(_NO_TERMS)), lambda s: spell(F.lit("term"), s)),
    )
    return all_spans(docs).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", F.array_join(spans, ",").alias("spans"))

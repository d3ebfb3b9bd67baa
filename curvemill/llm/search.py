"""Ranked lexical search, reversed: the items' inverted index goes to the documents, which stream through it.

A document's terms are counted once (``count_terms``: the number of its terms, and the counts of those that some item
holds), and the counts are written to the shared folder. Numbers of the corpus (documents, terms, documents of each term)
are sums over that table. Then every task streams the counts through the inverted index of the items' terms and keeps a heap
of the best documents of each item; the heaps of the tasks are merged, first by item and a share of the tasks, then by item.

The index is broadcast, so its size is bounded: items are dealt into blocks by their numbers of postings, and each block of at
most ``POSTINGS`` is a pass of its own over the counts. No document, term or item is left out. A heap holds ``k`` places.

Results: documents without a term, and null texts, are counted nowhere. Items that share an item_id are one item (null too) with
the terms of all its rows; items without a term have no rows. Repeated documents are documents of their own, ties go to
the least doc_id, null last. Extra columns of either table are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curvemill.llm.scratch import written

#: Characters that end a term; ASCII letters are lower-cased, all others stand as they are.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Places of each item's heap.
K = 10
#: Postings of the index that is broadcast at once: 16 bytes each in the tasks.
POSTINGS = 4_000_000
#: Shares of the tasks in which heaps are merged before they meet.
SHARES = 64

_FOLD = bytes(x if x > 127 or 48 <= x <= 57 or 97 <= x <= 122 else x + 32 if 65 <= x <= 90 else 32 for x in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text, in order, as UTF-8. Bytes of other characters than ASCII's are all over 127, so they stand."""
    return text.encode().translate(_FOLD).split() if text else []


def _asked_terms(items: DataFrame, text: str) -> DataFrame:
    """(item, term) pairs, each once; item is the struct of the item's id."""
    found = F.regexp_extract_all(F.translate(F.col(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(f"({TERM})"), 1)
    return items.select(F.struct(F.col("item_id")).alias("item"), F.explode(found).alias("term")).distinct()


def count_terms(docs: DataFrame, terms: list[bytes], text: str = "text") -> DataFrame:
    """(doc_id, n, ids, tf) of every document with a term: how many it has, and the counts of those in ``terms``, by their place there."""
    known = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {t: i for i, t in enumerate(known.value)}
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                part = whole.slice(at, 1024)
                keep, n, ids, tf, ends = [], [], [], [], [0]
                for row, value in enumerate(part.column(1)):
                    if not (found := terms_of(value.as_py())):
                        continue
                    counted = [(place[t], c) for t, c in Counter(found).items() if t in place]
                    keep.append(row)
                    n.append(len(found))
                    ids += [i for i, _ in counted]
                    tf += [c for _, c in counted]
                    ends.append(len(ids))
                ends = pa.array(ends, pa.int32())
                columns = [part.column(0).take(pa.array(keep, pa.int64())), pa.array(n, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(ids, pa.int32())), pa.ListArray.from_arrays(ends, pa.array(tf, pa.int64()))]
                yield pa.record_batch(columns, ["doc_id", "n", "ids", "tf"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col(text).alias("text")).mapInArrow(run, f"doc_id {id_type}, n long, ids array<int>, tf array<long>")


class _Heaps:
    """The best documents of each item so far: the least score on top, of equal ones the greatest doc_id; null ids come last."""

    def __init__(self, items: int, k: int) -> None:
        self.k, self.heaps, self.least = k, [[] for _ in range(items)], np.ones(items, np.int64)

    def offer(self, item: int, score: int, doc_id: int | None) -> None:
        entry = (score, doc_id is not None, -(doc_id or 0))
        heap = self.heaps[item]
        if len(heap) < self.k:
            heapq.heappush(heap, entry)
        elif entry > heap[0]:
            heapq.heapreplace(heap, entry)
        if len(heap) == self.k:
            self.least[item] = heap[0][0]

    def rows(self) -> Iterator[tuple[int, int | None, int]]:
        for item, heap in enumerate(self.heaps):
            for score, known, negative in heap:
                yield item, -negative if known else None, score


def _score_block(counts: DataFrame, index: tuple, n_items: int, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(item, doc_id, score, share) of every task's heaps over the items of one block of the index."""
    sent = counts.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, members, weights = sent.value
        heaps = _Heaps(n_items, k)
        for batch in batches:
            if not batch.num_rows:
                continue
            doc_ids, n = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            ids, tf = batch.column(2), batch.column(3)
            ends = ids.offsets.to_numpy() - ids.offsets[0].as_py()
            flat, times = ids.flatten().to_numpy(), tf.flatten().to_numpy()
            for row, doc_id in enumerate(doc_ids):
                t, f = flat[ends[row] : ends[row + 1]], times[ends[row] : ends[row + 1]]
                first, held = starts[t], starts[t + 1] - starts[t]
                total = int(held.sum())
                if not total:
                    continue
                m = 10 + 90 * n[row] * n_docs // n_terms
                # m is over any tf of 64 bits here only where the division gives 0 for all.
                gain = weights[t] * ((1_000_000_000 * f) // (1000 * f + 8 * m)) if m < 1 << 59 else np.zeros(len(t), np.int64)
                back = np.cumsum(held) - held
                where = np.arange(total) + np.repeat(first - back, held)
                score = np.zeros(n_items, np.int64)
                np.add.at(score, members[where], np.repeat(gain, held))
                for item in np.flatnonzero(score >= heaps.least).tolist():
                    heaps.offer(item, int(score[item]), doc_id)
        share = TaskContext.get().partitionId() % SHARES
        rows = [*heaps.rows()]
        yield pa.record_batch([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64()), pa.array([share] * len(rows), pa.int32())], ["item", "doc_id", "score", "share"])

    return counts.select(F.col("doc_id").cast("long"), "n", "ids", "tf").mapInArrow(run, "item int, doc_id long, score long, share int")


def _best(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, *, k: int = K, text: str = "text", item_text: str = "text", postings: int = POSTINGS) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` best documents of score above 0, best first.

    doc_id is a whole number. See the module's text for nulls, repeats and ties.
    """
    spark = docs.sparkSession
    pairs = written(_asked_terms(items, item_text), "search-items")
    id_type = items.schema["item_id"].dataType.simpleString()
    blocks = max(1, -(-pairs.count() // postings))
    out = numbers = None
    for block in range(blocks):
        of_block = pairs.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block) if blocks > 1 else pairs
        asked = of_block.groupBy("term").agg(F.collect_set("item").alias("items")).orderBy("term").collect()  # of one block: bounded
        names = sorted({r["item_id"] for row in asked for r in row["items"]}, key=lambda x: (x is None, x))
        number = {x: i for i, x in enumerate(names)}
        counts = written(count_terms(docs, [r["term"].encode() for r in asked], text), "search-counts")
        numbers = numbers or counts.agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
        df = {r["id"]: r["count"] for r in counts.select(F.explode("ids").alias("id")).groupBy("id").count().collect()}  # a row for each term of the block
        weights = [math.floor(1000 * math.log((2 * numbers["docs"] + 2) / (2 * df.get(i, 0) + 1))) for i in range(len(asked))]
        starts = np.concatenate([[0], np.cumsum([len(r["items"]) for r in asked])]).astype(np.int64)
        members = np.array([number[x["item_id"]] for r in asked for x in r["items"]], np.int32)
        heaps = _score_block(counts, (starts, members, np.array(weights, np.int64)), len(names), numbers["docs"], max(numbers["terms"], 1), k)
        merged = _best(_best(heaps, ["item", "share"], k).drop("rank", "share"), ["item"], k)
        ids = spark.createDataFrame([(i, x) for i, x in enumerate(names)], f"item int, item_id {id_type}")
        found = merged.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")
        out = found if out is None else out.unionByName(found)
    return out


def op11_reversed_search(spark, sf_dir: str) -> DataFrame:
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return search(docs, items)


_TERMS_SQL = """regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"""
OP11_SQL = f"""with d as (select doc_id, unnest({_TERMS_SQL}) as term from documents),
c as (select doc_id, term, count(*) as tf from d group by all), l as (select doc_id, count(*) as n from d group by all),
s as (select count(*) as docs, sum(n)::bigint as terms from l),
q as (select distinct item_id, unnest({_TERMS_SQL}) as term from benchmark),
w as (select term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::bigint as w from c, s where term in (select term from q) group by term, docs),
p as (select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms))))::bigint as score from q join w using (term) join c using (term) join l using (doc_id), s group by all)
select item_id, rank::int as rank, doc_id, score from (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from p where score > 0) where rank <= 10"""

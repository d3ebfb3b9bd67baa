"""Collocations by language: Toivonen mining of frequent phrases, then exact scores of their weakest cut.

A sample of documents proposes phrases: level by level, those that reach a lowered support there. One full pass then counts
the proposed phrases and their negative border: every phrase whose first and last words but one are proposed (or, of
one word, any). A border phrase that turns out frequent is a failure: phrases that hold it have not been counted. Expansion
passes count what the failures open until no frequent phrase is unknown; a phrase is at most ``longest`` words, so there
are at most as many passes. Whatever the sample, the result is that of counting everything; it only saves counting.

These passes count phrases by 64-bit hashes, so that what moves is numbers. Two phrases of one hash count together, which
can only let too many through; a last pass counts those that are left by their words, per language, and is exact.

The border is never listed: in each text, a place counts if the two phrases inside it are known. Known phrases are bits in
arrays by length, whose size has a fixed bound (``MAX_BITS``); a bit that two phrases share only makes more be counted. Tasks
count blocks of text with NumPy and sum what they count, so a phrase that fills the corpus is summed before it moves.

Null texts are empty, a null language is ``und``. Texts without words give nothing, repeated documents count each time,
an empty table has no phrases. Other columns are not read, whatever their names. Very long texts are counted in blocks
that share their last words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curvemill.llm.scratch import written

#: Occurrences of a phrase from which it is frequent, its most words, and ranks that are reported of each language.
SUPPORT, LONGEST, TOP = 100, 5, 2000
#: One document in so many is in the sample; a phrase is proposed from this part of the support that falls to it.
SAMPLE, LOWERED = 8, 0.5
#: Bits for each known phrase, and bits at most: 128 MB a length.
BITS_EACH, MAX_BITS = 32, 1 << 30
#: Bytes of text that are counted at once, and different phrases of a length that a task sums up before it sends them.
BLOCK, HELD = 4 << 20, 1 << 20

_FOLD = bytes(10 if x in b".,;:!?\n\x0b\x0c\r" else 32 if x in b" \t" else x + 32 if 65 <= x <= 90 else x for x in range(256))
#: Known phrases: arrays of bits by length.
Known = dict[int, list[np.ndarray]]

#: An odd base of word hashes, and its inverse modulo 2^64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _seed(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode()) & 0xFFFFFFFF


def _longer(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of phrases with a word more."""
    x = h * np.uint64(0x9E3779B97F4A7C15) + word
    return x ^ (x >> np.uint64(29))


def _test(arrays: list[np.ndarray], h: np.ndarray) -> np.ndarray:
    out = np.zeros(len(h), bool)
    for bits in arrays:
        at = h & np.uint64(64 * len(bits) - 1)
        out |= (bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) != 0
    return out


def _blocks(text: bytes) -> Iterator[tuple[bytes, int]]:
    """Parts of a folded text with how many words at the start were in the part before; cut between pieces, else between words."""
    at, shared, held = 0, 0, 0  # held: bytes at the start that the part before had
    while len(text) - at > max(BLOCK, held):
        if (cut := text.rfind(b"\n", at + BLOCK // 2, at + BLOCK)) >= 0:
            yield text[at:cut], shared
            at, shared, held = cut, 0, 0
            continue
        cut = text.find(b" ", at + max(BLOCK, held))
        piece_end = text.find(b"\n", at + max(BLOCK, held))
        if cut < 0 or 0 <= piece_end < cut:
            cut = piece_end if piece_end >= 0 else len(text)
            yield text[at:cut], shared
            at, shared, held = cut, 0, 0
            continue
        yield text[at:cut], shared
        tail = text[at:cut].rsplit(b"\n", 1)[-1].split()[-(LONGEST - 1) :]
        start = b" ".join(tail)
        text, at, shared, held = start + text[cut:], 0, len(tail), len(start) + 1
    yield text[at:], shared


def _powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2 and so on, modulo 2^64."""
    out = np.full(n, np.uint64(base))
    out[0] = 1
    return np.multiply.accumulate(out)


class Hasher:
    """Hashes of the words of a block by differences of one running sum of its bytes."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
        if len(data) > len(self.up):
            self.up, self.down = _powers(_BASE, len(data)), _powers(_INVERSE, len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data + np.uint64(1)) * self.up[: len(data)], out=sums[1:])
        x = (sums[ends] - sums[starts]) * self.down[starts]
        x = (x ^ (x >> np.uint64(31)) ^ np.uint64(seed)) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(32))


class _Grams:
    """The phrases of one block: hashes at every word, and where phrases of each length can begin."""

    def __init__(self, block: bytes, shared: int, lang: str, hasher: Hasher) -> None:
        self.data, self.shared = np.frombuffer(block, np.uint8), shared
        edges = np.diff(np.concatenate([[True], (self.data == 32) | (self.data == 10), [True]]).view(np.int8))
        self.starts, self.ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
        if len(self.starts):
            piece = np.cumsum(self.data == 10)[self.starts]
            self.h = {1: hasher.words(self.data, self.starts, self.ends, _seed(lang))}
        else:
            piece, self.h = np.zeros(0, np.int64), {1: np.zeros(0, np.uint64)}
        self.ok = {1: np.ones(len(piece), bool), 2: piece[1:] == piece[:-1]}

    def level(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes at every place, and whether a phrase of k words begins there that is not all in the part before."""
        for n in range(2, k + 1):
            if n not in self.h:
                self.h[n] = _longer(self.h[n - 1][:-1], self.h[1][n - 1 :])
            if n not in self.ok:
                self.ok[n] = self.ok[n - 1][:-1] & self.ok[2][n - 2 :]
        new = self.ok[k].copy()
        new[: max(0, self.shared - k + 1)] = False
        return self.h[k], new

    def opened(self, k: int, known: Known) -> np.ndarray:
        """Places where both phrases inside one of k words are known."""
        inside = _test(known.get(k - 1, []), self.h[k - 1])
        return inside[:-1] & inside[1:]

    def word(self, at: int) -> str:
        return self.data[self.starts[at] : self.ends[at]].tobytes().decode()

    def ids(self) -> np.ndarray:
        """Numbers of the words, equal for equal words alone: hashes tell them apart, and their bytes prove it."""
        _, first, back = np.unique(self.h[1], return_index=True, return_inverse=True)
        like, size = first[back], self.ends - self.starts
        if (size == size[like]).all():
            inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            if (self.data[np.repeat(self.starts, size) + inside] == self.data[np.repeat(self.starts[like], size) + inside]).all():
                return back
        seen: dict[str, int] = {}
        return np.array([seen.setdefault(self.word(i), len(seen)) for i in range(len(back))])

    def counted(self, ids: np.ndarray, places: np.ndarray, k: int) -> tuple[list[str], np.ndarray]:
        """Every different phrase of k words at the places, and its count; ``ids`` from ids()."""
        _, first, back, n = np.unique(self.h[k][places], return_index=True, return_inverse=True, return_counts=True)
        same = np.ones(len(places), bool)
        for j in range(k):
            same &= ids[places + j] == ids[places[first][back] + j]
        if not same.all():  # two phrases of one hash: told apart by their words
            _, first, n = np.unique(np.stack([ids[places + j] for j in range(k)], axis=1), axis=0, return_index=True, return_counts=True)
        return [" ".join(self.word(p + j) for j in range(k)) for p in places[first].tolist()], n


def _each_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, _Grams]]:
    """Blocks of the texts of each language; texts (column 1) of a language (column 0) are gathered up to a block's size."""
    held: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    hasher = Hasher()

    def drain(lang: str) -> Iterator[tuple[str, _Grams]]:
        whole = b"\n".join(held.pop(lang))
        sizes.pop(lang)
        for block, shared in _blocks(whole):
            yield lang, _Grams(block, shared, lang, hasher)

    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1)):
            if not (data := (text.as_py() or "").encode().translate(_FOLD)):
                continue
            name = lang.as_py()
            held.setdefault(name, []).append(data)
            sizes[name] = sizes.get(name, 0) + len(data) + 1
            if sizes[name] >= BLOCK or sum(sizes.values()) >= 4 * BLOCK:
                yield from drain(max(sizes, key=sizes.get))
    for name in [*held]:
        yield from drain(name)


class _Sums:
    """Counts by hash, summed up to ``HELD`` different ones of a length."""

    def __init__(self) -> None:
        self.parts: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

    def add(self, k: int, h: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.setdefault(k, []).append(np.unique(h, return_counts=True))
        if sum(len(x) for x, _ in self.parts[k]) > HELD:
            self.parts[k] = [self._merged(k)]
            if len(self.parts[k][0][0]) > HELD // 2:
                yield self._batch(k)

    def _merged(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        h, n = (np.concatenate([part[i] for part in self.parts[k]]) for i in (0, 1))
        order = np.argsort(h)
        h, n = h[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
        return h[first], np.add.reduceat(n, first) if len(h) else n

    def _batch(self, k: int) -> pa.RecordBatch:
        h, n = self._merged(k)
        del self.parts[k]
        return pa.record_batch([pa.array(np.full(len(h), k, np.int32)), pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], ["k", "h", "f"])

    def rest(self) -> Iterator[pa.RecordBatch]:
        for k in [*self.parts]:
            yield self._batch(k)


def _count_hashes(texts: DataFrame, lengths: list[int], known: Known, before: Known | None, support: float) -> DataFrame:
    """(k, h): hashes of the phrases of these lengths in texts (lang, text) that reach the support.

    Counted is what ``known`` opens and ``before``, if given, did not; of one word, everything.
    """
    sent = texts.sparkSession.sparkContext.broadcast((known, before))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, before = sent.value
        sums = _Sums()
        for _, grams in _each_block(batches):
            for k in lengths:
                h, places = grams.level(k)
                if k > 1:
                    places &= grams.opened(k, known)
                    if before is not None:
                        places &= ~grams.opened(k, before)
                yield from sums.add(k, h[places])
        yield from sums.rest()

    return texts.mapInArrow(run, "k int, h long, f long").groupBy("k", "h").agg(F.sum("f").alias("f")).where(F.col("f") >= support).select("k", "h")


def _bits(hashes: DataFrame) -> np.ndarray | None:
    """The hashes (h) as an array of bits, a power of two of them and MAX_BITS at most; None if there are none.

    Bits meet by position before they are collected, so the driver gets a word for each 64 bits at most.
    """
    n = hashes.count()
    if not n:
        return None
    size = min(MAX_BITS, max(1 << 16, 1 << (n * BITS_EACH - 1).bit_length()))
    at = F.col("h").bitwiseAND(F.lit(size - 1))
    table = hashes.select(F.shiftright(at, 6).alias("at"), F.expr("shiftleft(1L, cast(h & 63 as int))").alias("bit")).groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(size // 64, np.int64)
    out[table.column("at").to_numpy()] = table.column("bits").to_numpy()
    return out.view(np.uint64)


def propose(sample: DataFrame, support: float, longest: int = LONGEST) -> Known:
    """Phrases of up to ``longest`` - 1 words that reach the support in the sample (lang, text), level by level."""
    known: Known = {}
    for k in range(1, longest):
        if (bits := _bits(written(_count_hashes(sample, [k], known, None, support), f"phrases-sample-{k}"))) is None:
            break
        known[k] = [bits]
    return known


def _unknown(frequent: DataFrame, known: Known) -> DataFrame:
    """The rows (k, h) that are not known."""
    sent = frequent.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k, h = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            new = np.zeros(len(k), bool)
            for n in np.unique(k).tolist():
                of_n = np.flatnonzero(k == n)
                new[of_n] = ~_test(sent.value.get(n, []), h[of_n])
            yield batch.filter(pa.array(new))

    return frequent.select("k", "h").mapInArrow(run, "k int, h long")


def _by_length(hashes: DataFrame, longest: int) -> dict[int, np.ndarray]:
    return {k: bits for k in range(1, longest + 1) if (bits := _bits(hashes.where(F.col("k") == k))) is not None}


def _count_words(texts: DataFrame, wanted: Known, longest: int, support: int) -> DataFrame:
    """(lang, k, phrase, f): the phrases among ``wanted`` that reach the support, by their words; as k = 0 the number of words."""
    sent = texts.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, grams in _each_block(batches):
            ids, names, lengths, counts = None, [""], [0], [int(grams.level(1)[1].sum())]
            for k in range(1, longest + 1):
                h, places = grams.level(k)
                if len(at := np.flatnonzero(places & _test(sent.value.get(k, []), h))):
                    ids = grams.ids() if ids is None else ids
                    found, n = grams.counted(ids, at, k)
                    names += found
                    lengths += [k] * len(found)
                    counts += n.tolist()
            yield pa.record_batch([pa.array([lang] * len(names)), pa.array(lengths, pa.int32()), pa.array(names), pa.array(counts, pa.int64())], ["lang", "k", "phrase", "f"])

    counted = texts.mapInArrow(run, "lang string, k int, phrase string, f long").where("f > 0")
    return counted.groupBy("lang", "k", "phrase").agg(F.sum("f").alias("f")).where((F.col("f") >= support) | (F.col("k") == 0))


def frequent_phrases(docs: DataFrame, *, support: int = SUPPORT, longest: int = LONGEST, sample: int = SAMPLE, lowered: float = LOWERED, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, k, phrase, f) of every phrase of up to ``longest`` words that occurs ``support`` times; k = 0 has a language's words in all."""
    if not 1 <= longest <= LONGEST:
        raise ValueError(f"longest is 1 to {LONGEST}")
    texts = docs.select(F.coalesce(docs[lang], F.lit("und")).alias("lang"), docs[text].alias("text"))
    drawn = texts.where(F.pmod(F.xxhash64(docs["doc_id"], docs[text]), F.lit(sample)) == 0)
    known = propose(written(drawn, "phrases-sample"), max(1, support / sample * lowered), longest)
    found = written(_count_hashes(texts, [*range(1, longest + 1)], known, None, support), "phrases-counted")
    wanted = {k: [bits] for k, bits in _by_length(found, longest).items()}
    for _ in range(longest):
        failures = written(_unknown(found.where(F.col("k") < longest), known), "phrases-failures")
        if not (new := _by_length(failures, longest - 1)):
            return written(_count_words(texts, wanted, longest, support), "phrases-frequent")
        more = {k: [*known.get(k, []), *([new[k]] if k in new else [])] for k in {*known, *new}}
        # What a failure opens is longer than the shortest of them.
        found = written(_count_hashes(texts, [*range(min(new) + 1, longest + 1)], more, known, support), "phrases-expanded")
        for k, bits in _by_length(found, longest).items():
            wanted.setdefault(k, []).append(bits)
        known = more
    raise RuntimeError("expansion did not close")


def collocations(frequent: DataFrame, *, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) from ``frequent_phrases``: by language the first ``top`` by score, a and phrase.

    A phrase's score is that of its weakest cut, the first of equal ones. Phrases that a longer one holds each time they occur are left out.
    """
    words = F.split("phrase", " ")
    several = frequent.where("k > 1").select("lang", "k", "phrase", F.col("f").alias("a"))
    cuts = several.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    cuts = cuts.withColumns({"left": F.array_join(F.slice(words, F.lit(1), F.col("cut")), " "), "right": F.array_join(F.slice(words, F.col("cut") + 1, F.col("k")), " ")})
    part = lambda side, n: frequent.where("k > 0").select("lang", F.col("phrase").alias(side), F.col("f").alias(n))
    scored = cuts.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"])
    scored = scored.join(F.broadcast(frequent.where("k = 0").select("lang", F.col("f").alias("n"))), "lang")  # a row for each language
    exact = lambda c: F.col(c).cast("decimal(20,0)")
    score = F.call_function("div", exact("a") * exact("n") * F.lit(1000).cast("decimal(4,0)"), exact("l") * exact("r"))
    weakest = scored.groupBy("lang", "k", "phrase", "a", "n").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("w")).select("lang", "phrase", "a", "n", "w.*")
    inner = F.explode(F.array(F.array_join(F.slice(words, F.lit(1), F.col("k") - 1), " "), F.array_join(F.slice(words, F.lit(2), F.col("k") - 1), " ")))
    held = several.where("k > 2").select("lang", "a", inner.alias("phrase")).distinct()
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = weakest.join(held, ["lang", "a", "phrase"], "left_anti").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_toivonen_phrases(spark, sf_dir: str) -> DataFrame:
    return collocations(frequent_phrases(spark.read.parquet(f"{sf_dir}/documents.parquet")))


OP13_SQL = f"""with pieces as (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) as piece from documents),
w as (select lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') as w from pieces),
starts as (select lang, w, unnest(range(1, len(w) + 1)) as i from w),
grams as (select lang, k, array_to_string(w[i : i + k - 1], ' ') as phrase from starts, range(1, {LONGEST + 1}) g(k) where i + k - 1 <= len(w)),
f as (select lang, k, phrase, count(*) as f from grams group by all having count(*) >= {SUPPORT}), n as (select lang, sum(len(w))::bigint as n from w group by lang),
cut as (select c.lang, c.phrase, c.k, c.f as a, j, l.f as l, r.f as r, n, ((1000::hugeint * c.f * n) // (l.f::hugeint * r.f))::bigint as score
    from f c join range(1, {LONGEST}) g(j) on j < c.k join f l on l.lang = c.lang and l.phrase = array_to_string(string_split(c.phrase, ' ')[:j], ' ')
    join f r on r.lang = c.lang and r.phrase = array_to_string(string_split(c.phrase, ' ')[j + 1 :], ' ') join n on n.lang = c.lang),
weak as (select * from (select *, row_number() over (partition by lang, phrase order by score, j) as o from cut) where o = 1),
held as (select distinct lang, f as a, array_to_string(string_split(phrase, ' ')[x : x + k - 2], ' ') as phrase from f, range(1, 3) g(x) where k > 2)
select lang, rank, phrase, a, l, r, n, score from (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from weak anti join held using (lang, a, phrase)) where rank <= {TOP}"""

"""Byte-level BPE by recursive DuckDB queries in every partition.

A text is cut by the tokenizer's pattern; each match is a word. Words that a worker has not met lately become
token-position rows, one a byte, and a recursive query contracts them: every step joins neighbouring tokens to the merge
table and, in each word, contracts the leftmost pair of the least rank, until no pair is left. A text's ids are those
of its words. Decoding joins token positions to the tokens' bytes and aggregates them in order.

A word of over ``WINDOW`` bytes is contracted in windows that overlap by half, and these are joined where two of them
have a token in common. The result is that of the whole word: no step in one part of a word depends on another part
unless a pair across their border is contracted, and whether that happens depends on the two tokens at the border alone.
So a sequence of tokens is right if every two neighbours are what their own bytes give, and within a window they are.
Windows without a common token are made longer, up to the whole word.

Memory is bounded: a partition passes ``BATCH_CHARS`` characters at a time and remembers ``REMEMBER`` pieces, or twice as many.

Defined results: null texts are encoded as empty ones, to no ids; equal texts get equal ids; an empty table gives
an empty result. Extra columns are carried.
"""

from __future__ import annotations

import base64
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from curvemill.llm import pieces

BATCH_CHARS, REMEMBER = 1_500_000, 200_000
MEMORY = "200MB"
#: Bytes of words in one query, and the lengths of the windows of long words in bytes; their halves suit runs of like tokens.
BYTES_A_QUERY, WINDOW, LONGER = 250_000, 96, (840, 10_080)

#: Rows of words, whose tokens are unnested to token-position rows in every step. Of long ones only the last step is kept.
_CONTRACT = """
with recursive state(w, ids) {key} as (
    select w, ids from fresh
    union all
    (with best as (
        select w, min((rank::bigint << 32) | pos) as x
        from (select w, unnest(range(1, len(ids))) as pos, unnest(ids[:-2]) as tok, unnest(ids[2:]) as right_tok from state)
        join merges on pair = (tok::bigint << 32) | right_tok
        group by w
    )
    select w, ids[:(x & 4294967295) - 1] || [(x >> 32)::int] || ids[(x & 4294967295) + 2:] from state join best using (w))
)
select w, arg_min(ids, len(ids)) as ids from state group by w order by w
"""
_DECODE = "select doc, string_agg(letters, '') as spelt from (select doc, seq, letters from given join spelling using (tok) order by seq) group by doc"


class Engine:
    """A DuckDB in memory with the merge table of one ranks file."""

    def __init__(self, ranks_file: str, pattern: str) -> None:
        import duckdb
        import regex

        with open(ranks_file, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.pattern, plain = regex.compile(pattern), pattern == pieces.PATTERN
        self.cut = pieces.cut if plain else lambda text: None
        self.single = pieces.WORD.fullmatch if plain else lambda piece: None
        self.spill = tempfile.TemporaryDirectory(prefix="duckdb-")  # this engine's own
        # In one thread that keeps the order of rows, an aggregate over sorted rows meets them in that order.
        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": MEMORY, "temp_directory": self.spill.name, "preserve_insertion_order": True})
        self.ranks, self.tables = ranks, set()
        self.byte_tokens = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        self.sizes[list(ranks.values())] = [len(t) for t in ranks]
        self.memory = pieces.Memory(REMEMBER)

    def _need(self, name: str) -> None:
        """Make a table at its first use: ``merges`` (pair, rank), or ``spelling`` (tok, letters)."""
        if name in self.tables:
            return
        if name == "merges":
            parts = ((self.ranks.get(t[:i]), self.ranks.get(t[i:]), k) for t, k in self.ranks.items() for i in range(1, len(t)))
            left, right, rank = np.array([x for x in parts if x[0] is not None and x[1] is not None], np.int64).T
            table = pa.table({"pair": left << 32 | right, "rank": rank.astype(np.int32)})
        else:
            # A byte is spelt by the character of its number, zero by 256: strings of DuckDB are not to end there.
            table = pa.table({"tok": np.array(list(self.ranks.values()), np.int32), "letters": [t.decode("latin-1").replace("\0", "\u0100") for t in self.ranks]})
        self.db.register("given", table)
        self.db.execute(f"create table {name} as select * from given")
        self.db.unregister("given")
        self.tables.add(name)

    @classmethod
    def of_worker(cls, ranks_file: str, pattern: str) -> Engine:
        """The worker's engine: on the library's module, so that it outlives the task in a worker that is used again."""
        import duckdb

        kept = duckdb.__dict__.setdefault("_curvemill_engines", {})
        if (ranks_file, pattern) not in kept:
            kept[ranks_file, pattern] = cls(ranks_file, pattern)
        return kept[ranks_file, pattern]

    def _contract(self, words: list[bytes]) -> list[np.ndarray]:
        """The tokens of each word."""
        self._need("merges")
        out: list[np.ndarray] = []
        at = 0
        while at < len(words):
            upto, held = at, 0
            while upto < len(words) and (upto == at or held + len(words[upto]) <= BYTES_A_QUERY):
                held += len(words[upto])
                upto += 1
            part = words[at:upto]
            ends = np.cumsum([0, *map(len, part)])
            tokens = self.byte_tokens[np.frombuffer(b"".join(part), np.uint8)]
            fresh = pa.table({"w": np.arange(len(part), dtype=np.int32), "ids": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(tokens))})
            self.db.register("fresh", fresh)
            found = self.db.sql(_CONTRACT.format(key="using key (w)" if max(map(len, part)) > WINDOW else "")).to_arrow_table().column("ids").combine_chunks()
            self.db.unregister("fresh")
            ids, cuts = found.flatten().to_numpy(), found.offsets.to_numpy()
            out += [ids[a - cuts[0] : b - cuts[0]] for a, b in zip(cuts[:-1], cuts[1:])]
            at = upto
        return out

    def _join(self, windows: list[np.ndarray], step: int) -> np.ndarray | None:
        """The tokens of a word from those of its windows, which begin every ``step`` bytes; None if two have none in common."""
        out, before, begin = [], None, 0
        for k, ids in enumerate(windows):
            ends = k * step + np.cumsum(self.sizes[ids])
            spans = (ends - self.sizes[ids]) << 32 | ends
            if before is not None:
                _, mine, its = np.intersect1d(before[1], spans, assume_unique=True, return_indices=True)
                if not len(mine):
                    return None
                middle = len(mine) // 2
                out.append(before[0][begin : mine[middle]])
                begin = its[middle]
            before = ids, spans
        return np.concatenate([*out, before[0][begin:]])

    def _words(self, words: list[str]) -> list[bytes]:
        """The ids of each word, as bytes."""
        spelt = [w.encode("utf-8", "surrogatepass") for w in words]
        out: list[np.ndarray | None] = [None] * len(spelt)
        short = [i for i, x in enumerate(spelt) if len(x) <= WINDOW]
        for i, ids in zip(short, self._contract([spelt[i] for i in short])):
            out[i] = ids
        left = [i for i, x in enumerate(spelt) if len(x) > WINDOW]
        for size in (WINDOW, *LONGER, None):
            for i in left:
                x, step = spelt[i], (size or 2 * len(spelt[i])) // 2
                starts = range(0, max(1, len(x) - step), step)
                out[i] = self._join(self._contract([x[s : s + 2 * step] for s in starts]), step)
            left = [i for i in left if out[i] is None]
        return [ids.tobytes() for ids in out]

    def _learn(self, new: list[str]) -> dict[str, bytes]:
        """The ids of pieces and of the words in them."""
        now, before, fresh, marked, mixed = self.memory.now, self.memory.now.before, {}, [], []
        for p in new:
            m = self.single(p)
            if m is None:
                mixed.append((p, self.pattern.findall(p)))
            elif not m[2]:
                fresh[p] = None
            else:
                stem, mark = m.groups()
                if now.get(stem) is None and stem not in before:
                    fresh[stem] = None
                marked.append((p, stem, mark))
        fresh.update([(w, None) for _, words in mixed for w in words if self.memory.get(w) is None])
        fresh.update([(x, None) for x in {mark for _, _, mark in marked} if self.memory.get(x) is None])
        ids = dict(zip(fresh, self._words(list(fresh))))
        of = lambda w: ids[w] if w in ids else self.memory.get(w)
        marks = {x: of(x) for x in {mark for _, _, mark in marked}}
        ids.update([(p, (ids.get(stem) or now.get(stem) or before[stem]) + marks[mark]) for p, stem, mark in marked])
        ids.update([(p, b"".join(map(of, words))) for p, words in mixed])
        return ids

    def encode(self, texts: list[str]) -> pa.ListArray:
        cuts = [self.pattern.findall(t) if (c := self.cut(t)) is None else c for t in texts]
        found = self.memory.encode(cuts, self._learn)
        ends = np.cumsum([0, *[len(x) // 4 for x in found]])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(found), np.int32)))

    def decode(self, ids: pa.ListArray) -> list[bytes]:
        self._need("spelling")
        flat, cuts = ids.flatten().cast(pa.int32()), ids.offsets.to_numpy()
        sizes = np.where(ids.is_valid().to_numpy(zero_copy_only=False), np.diff(cuts), 0)
        rows = pa.table({"doc": np.repeat(np.arange(len(ids), dtype=np.int32), sizes), "seq": np.arange(sizes.sum(), dtype=np.int32), "tok": flat})
        self.db.register("given", rows)
        found = self.db.sql(_DECODE).to_arrow_table()
        self.db.unregister("given")
        out = [b""] * len(ids)
        for doc, spelt in zip(found.column("doc").to_pylist(), found.column("spelt").to_pylist()):
            out[doc] = spelt.replace("\u0100", "\0").encode("latin-1")
        return out


def _by_size(batch: pa.RecordBatch, sizes: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    at, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > most:
            yield batch.slice(at, i - at)
            at, held = i, 0
        held += n
    if at < batch.num_rows:
        yield batch.slice(at)


def encode(docs: DataFrame, ranks_file: str, pattern: str, *, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """The rows of docs with ``ids``, the token ids of ``text``, in place of a column of that name.

    With ``decoded``, also with the bytes that the ids decode to, found in the same task.
    """
    fields = [f for f in docs.schema if f.name not in (ids, decoded)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        engine = None
        for batch in batches:
            engine = engine or Engine.of_worker(ranks_file, pattern)
            column = batch.schema.get_field_index("_bpe_text")
            lengths = np.array([len(x) if x else 1 for x in batch.column(column).to_pylist()])
            for part in _by_size(batch, lengths, BATCH_CHARS):
                found = [engine.encode([x or "" for x in part.column(column).to_pylist()])]
                if decoded:
                    found.append(pa.array(engine.decode(found[0]), pa.binary()))
                yield pa.record_batch([*[part.column(i) for i in range(column)], *found], [*[f.name for f in fields], *made])

    made = [ids, decoded] if decoded else [ids]
    kinds = [StructField(ids, ArrayType(IntegerType())), StructField(decoded or "", BinaryType())]
    schema = StructType([*[StructField(f.name, f.dataType, True) for f in fields], *kinds[: len(made)]])
    return docs.select(*[f.name for f in fields], F.col(text).alias("_bpe_text")).mapInArrow(run, schema)


def decode(tokens: DataFrame, ranks_file: str, pattern: str, *, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """The rows of tokens with ``decoded``, the bytes of their ids, in place of a column of that name; null ids: none."""
    fields = [f for f in tokens.schema if f.name != decoded]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        engine = None
        for batch in batches:
            engine = engine or Engine.of_worker(ranks_file, pattern)
            column = batch.schema.get_field_index("_bpe_ids")
            lengths = np.diff(batch.column(column).offsets.to_numpy()) * 3 + 1
            for part in _by_size(batch, lengths, BATCH_CHARS):
                found = engine.decode(part.column(column))
                yield pa.record_batch([*[part.column(i) for i in range(column)], pa.array(found, pa.binary())], [*[f.name for f in fields], decoded])

    schema = StructType([*[StructField(f.name, f.dataType, True) for f in fields], StructField(decoded, BinaryType())])
    return tokens.select(*[f.name for f in fields], F.col(ids).alias("_bpe_ids")).mapInArrow(run, schema)


def round_trip(docs: DataFrame, ranks_file: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, n_tokens and the hashes of the ids and of the decoded bytes."""
    import public_tokenizers

    ranks_file, pattern = ranks_file or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), pattern or public_tokenizers.PATTERN
    back = encode(docs.select("doc_id", "text"), ranks_file, pattern, decoded="decoded")
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return back.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed.cast("binary"), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_recursive_bpe(spark, sf_dir: str) -> DataFrame:
    return round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet"))

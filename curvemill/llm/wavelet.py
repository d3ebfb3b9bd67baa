"""Token ids in wavelet-matrix files.

Documents are range-sorted by id, encoded whole with a byte-level BPE tokenizer, ended by ``END`` and written as
shards of at most about ``SHARD_TOKENS`` tokens. A shard is one file: a wavelet matrix of the tokens (one bit-plane
for each bit of an id, most significant first; every plane is dealt stably into zeros and ones for the next) in
zstd blocks with a rank sample each, the documents' ids and lengths, and a directory. ``WaveletFile`` answers token
access, prefix counts (rank), occurrence lookup (select) and document slices from the file, unpacking only the blocks
that it touches; ``read_shards`` decodes whole shards.

Defined results: a null text is encoded as the empty one, so its document holds the end id alone; null ids sort
first; repeated rows are repeated documents; an empty table writes no file. Ids of any atomic type come back as they
were. Texts that spell a special token are encoded as the library does by default. Extra columns are ignored.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from curvemill.llm.pieces import LETTERS, OTHER_SPACE, Memory, cut_all
from curvemill.llm.scratch import shared_dir, written

END = 2
SHARD_TOKENS = 6_000_000
#: Bits in a compressed block of a plane.
BLOCK_BITS = 1 << 18
MAGIC = b"WVLT0001"
#: Pieces of text whose tokens a worker remembers, at least.
REMEMBER = 250_000
#: Bytes of text that are cut at once.
BLOCK_BYTES = 8_000_000


def _byte_letters() -> str:
    """The character that stands for each byte in a byte-level vocabulary: itself if it can be seen, else one from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return "".join(chr(b if b in seen else next(rest)) for b in range(256))


class Encoder:
    """Encodes texts with the tokenizers library; a piece that was met lately does not go through it again.

    Texts are cut into pieces many at once and every distinct piece of them is looked up once. Single words go to the
    library's model, which does without the rest of its chain.
    """

    def __init__(self, tokenizer_file: str) -> None:
        import tokenizers

        # On the library's module, so that it outlives the task in a worker that is used again.
        kept = tokenizers.__dict__.setdefault("_curvemill_pieces", {})
        if tokenizer_file not in kept:
            tokenizer = tokenizers.Tokenizer.from_file(tokenizer_file)
            tokenizer.model._resize_cache(0)  # the memory has what was met before
            kept[tokenizer_file] = (tokenizer, Memory(REMEMBER))
        self.tokenizer, self.memory = kept[tokenizer_file]
        #: Texts that hold one of these go to the library whole: special tokens, and white space that cutting leaves to it.
        self.special = "|".join(map(re.escape, [*OTHER_SPACE, *(t.content for t in self.tokenizer.get_added_tokens_decoder().values())]))
        self.code = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.dtype = np.dtype("<u2" if self.code == "H" else "<u4")
        chain = self.tokenizer.pre_tokenizer
        plain = isinstance(chain, tokenizers.pre_tokenizers.ByteLevel) and chain.use_regex and not chain.add_prefix_space
        #: None if what goes before the model is not what texts are cut for.
        self.model = self.tokenizer.model if plain and self.tokenizer.normalizer is None else None
        self.letters = _byte_letters()

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [array(self.code, e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _word(self, word: str) -> bytes:
        spelt = word.replace(" ", self.letters[32]) if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
        return array(self.code, [t.id for t in self.model.tokenize(spelt)]).tobytes()

    def _learn(self, new: list[str]) -> Iterator[tuple[str, bytes]]:
        rest = []
        for p in new:
            if LETTERS.fullmatch(p):
                yield p, self._word(p)
            else:
                rest.append(p)
        for at in range(0, len(rest), 2048):
            yield from zip(rest[at : at + 2048], self._ids(rest[at : at + 2048]), strict=True)

    def _cut_and_encode(self, texts: pa.LargeStringArray) -> list[np.ndarray]:
        pieces, before = cut_all(texts)
        if not len(pieces):
            return [np.zeros(0, self.dtype)] * len(texts)
        pieces = pieces.dictionary_encode()
        known = self.memory.each([pieces.dictionary.to_numpy(zero_copy_only=False).tolist()], self._learn)[0]
        _, places, held = pa.array(known, pa.large_binary()).take(pieces.indices).buffers()
        places = np.frombuffer(places, np.int64)[before] // self.dtype.itemsize
        tokens = np.frombuffer(held, self.dtype, count=int(places[-1]))
        return [tokens[a:b] for a, b in zip(places[:-1].tolist(), places[1:].tolist())]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return list(self.encode_all(pa.array(texts, pa.large_string())))

    def encode_all(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The tokens of each text, none of them null; about ``BLOCK_BYTES`` of them are cut and looked up at once."""
        texts = texts.cast(pa.large_string())
        block = pc.binary_length(texts).to_numpy(zero_copy_only=False).cumsum() // BLOCK_BYTES
        ends = [*(np.flatnonzero(np.diff(block)) + 1).tolist(), len(texts)] if len(texts) else []
        for start, end in zip([0, *ends], ends):
            part = texts.slice(start, end - start)
            if self.model is None:
                whole = np.ones(len(part), bool)
            else:
                whole = pc.match_substring_regex(part, self.special).to_numpy(zero_copy_only=False)
            cut = iter(self._cut_and_encode(part.filter(pa.array(~whole)) if whole.any() else part))
            for i, apart in enumerate(whole.tolist()):
                yield np.frombuffer(self._ids([part[i].as_py()])[0], self.dtype) if apart else next(cut)


def _pack_plane(bits: np.ndarray) -> tuple[bytes, list[int], list[int]]:
    """Compressed blocks, their sizes, and the ones before each block."""
    import zstandard

    c = zstandard.ZstdCompressor(level=1)
    out, sizes, ranks, ones = [], [], [], 0
    for at in range(0, len(bits), BLOCK_BITS):
        part = bits[at : at + BLOCK_BITS]
        out.append(c.compress(np.packbits(part, bitorder="little").tobytes()))
        sizes.append(len(out[-1]))
        ranks.append(ones)
        ones += int(np.count_nonzero(part))
    return b"".join(out), sizes, ranks


def build(tokens: np.ndarray, doc_ids: list, lengths: np.ndarray, levels: int) -> bytes:
    """A shard file: magic, directory length, directory (JSON), ids and lengths, planes."""
    planes, zeros, seq = [], [], tokens
    for level in range(levels):
        ones = (seq & seq.dtype.type(1 << (levels - 1 - level))) != 0
        planes.append(_pack_plane(ones))
        # Taking by place is several times faster than by mask.
        at_zero = np.flatnonzero(~ones)
        zeros.append(len(at_zero))
        seq = np.concatenate([seq.take(at_zero), seq.take(np.flatnonzero(ones))])
    docs = zlib.compress(json.dumps(doc_ids).encode(), 1)
    lens = zlib.compress(lengths.astype("<i8").tobytes(), 1)
    head = {"n": len(tokens), "levels": levels, "zeros": zeros, "docs": len(docs), "lengths": len(lens), "planes": [{"sizes": p[1], "ranks": p[2]} for p in planes]}
    directory = zlib.compress(json.dumps(head).encode())
    return b"".join([MAGIC, struct.pack("<I", len(directory)), directory, docs, lens, *[p[0] for p in planes]])


class WaveletFile:
    """Reads one shard from its bytes."""

    def __init__(self, data: bytes) -> None:
        if data[:8] != MAGIC:
            raise ValueError("not a wavelet shard")
        (size,) = struct.unpack("<I", data[8:12])
        head = json.loads(zlib.decompress(data[12 : 12 + size]))
        at = 12 + size
        self.doc_ids = json.loads(zlib.decompress(data[at : at + head["docs"]]))
        at += head["docs"]
        self.lengths = np.frombuffer(zlib.decompress(data[at : at + head["lengths"]]), "<i8")
        at += head["lengths"]
        self.n, self.levels, self.zeros, self.data = head["n"], head["levels"], head["zeros"], data
        self.places, self.ranks, self.open = [], [], {}
        for p in head["planes"]:
            ends = at + np.cumsum([0, *p["sizes"]])
            self.places.append(ends)
            self.ranks.append(p["ranks"])
            at = int(ends[-1])

    def _block(self, level: int, k: int) -> np.ndarray:
        if (level, k) not in self.open:
            import zstandard

            raw = zstandard.ZstdDecompressor().decompress(self.data[self.places[level][k] : self.places[level][k + 1]])
            bits = np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little")
            self.open[level, k] = bits[: min(BLOCK_BITS, self.n - k * BLOCK_BITS)]
            if len(self.open) > 64:
                self.open.pop(next(iter(self.open)))
        return self.open[level, k]

    def _rank1(self, level: int, i: int) -> int:
        """Ones among the first i bits of a plane."""
        if i >= self.n:
            return self.n - self.zeros[level]
        k, rest = divmod(i, BLOCK_BITS)
        return self.ranks[level][k] + int(np.count_nonzero(self._block(level, k)[:rest]))

    def access(self, i: int) -> int:
        """The token at position i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        token = 0
        for level in range(self.levels):
            bit = int(self._block(level, i // BLOCK_BITS)[i % BLOCK_BITS])
            ones = self._rank1(level, i)
            i = self.zeros[level] + ones if bit else i - ones
            token = token << 1 | bit
        return token

    def _range(self, token: int, upto: int) -> tuple[int, int]:
        a, b = 0, upto
        for level in range(self.levels):
            ra, rb = self._rank1(level, a), self._rank1(level, b)
            a, b = (self.zeros[level] + ra, self.zeros[level] + rb) if token >> (self.levels - 1 - level) & 1 else (a - ra, b - rb)
        return a, b

    def rank(self, token: int, upto: int) -> int:
        """How often the token occurs among the first ``upto`` positions."""
        a, b = self._range(token, min(upto, self.n))
        return b - a

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, k: int) -> int:
        """The position of the token's k-th occurrence, from 0; -1 if it has fewer."""
        a, b = self._range(token, self.n)
        if not 0 <= k < b - a:
            return -1
        i = a + k
        for level in reversed(range(self.levels)):
            i = self._select_bit(level, i - self.zeros[level], 1) if i >= self.zeros[level] else self._select_bit(level, i, 0)
        return i

    def _select_bit(self, level: int, k: int, bit: int) -> int:
        """The place of the k-th one (or zero) of a plane, by its rank samples and then within a block."""
        ranks = np.asarray(self.ranks[level])
        before = ranks if bit else np.arange(len(ranks)) * BLOCK_BITS - ranks
        block = int(np.searchsorted(before, k, side="right")) - 1
        return block * BLOCK_BITS + int(np.flatnonzero(self._block(level, block) == bit)[k - int(before[block])])

    def tokens(self) -> np.ndarray:
        """All tokens: planes are undone from the last to the first."""
        out = np.zeros(self.n, np.uint16 if self.levels <= 16 else np.uint32)
        for level in reversed(range(self.levels)):
            blocks = [self._block(level, k) for k in range(len(self.ranks[level]))]
            ones = np.concatenate(blocks).astype(bool) if blocks else np.zeros(0, bool)
            self.open.clear()
            new = np.empty_like(out)
            new[np.flatnonzero(~ones)] = out[: self.zeros[level]]
            new[np.flatnonzero(ones)] = out[self.zeros[level] :] | out.dtype.type(1 << (self.levels - 1 - level))
            out = new
        return out

    def document(self, k: int) -> np.ndarray:
        """The tokens of the k-th document of the shard, by access."""
        start = int(self.lengths[:k].sum())
        return np.array([self.access(i) for i in range(start, start + int(self.lengths[k]))], np.uint32)


def _save(folder: str, name: str, data: bytes) -> None:
    """Written beside its place and moved there, so that a repeated task leaves one whole file."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(folder)
    own = f"{path}/.{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(own) as out:
        out.write(data)
    store.move(own, f"{path}/{name}")


def _held(id_type: str) -> str:
    """The type that ids of a type have in a file: whole numbers or text (binary ids in base 64)."""
    return "long" if id_type in ("tinyint", "smallint", "int", "bigint", "long") else "string"


def write_shards(docs: DataFrame, folder: str, tokenizer_file: str, end: int = END) -> DataFrame:
    """Write the wavelet files of docs (doc_id, text) to ``folder``, a URI all executors share; returns (file, n_docs, n_tokens).

    The result must be run once for the files to be written. File names sort in the order of the documents.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, part = Encoder(tokenizer_file), TaskContext.get().partitionId()
        levels = max(1, (encoder.tokenizer.get_vocab_size() - 1).bit_length())
        ids, seqs, held, files = [], [], 0, 0

        def flush():
            nonlocal ids, seqs, held, files
            lengths = np.array([len(s) for s in seqs], np.int64)
            name = f"{part:07d}-{files:05d}.wvlt"
            data = build(np.concatenate(seqs), ids, lengths, levels)
            _save(folder, name, data)
            row = pa.record_batch([pa.array([name]), pa.array([len(ids)], pa.int64()), pa.array([held], pa.int64())], ["file", "n_docs", "n_tokens"])
            ids, seqs, held, files = [], [], 0, files + 1
            return row

        for batch in batches:
            for doc, seq in zip(batch.column(0).to_pylist(), encoder.encode_all(batch.column(1).fill_null(""))):
                ids.append(doc)
                seqs.append(np.append(seq, encoder.dtype.type(end)))
                held += len(seq) + 1
                if held >= SHARD_TOKENS:
                    yield flush()
        if ids:
            yield flush()

    ordered = docs.select("doc_id", "text").repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first())
    held_type = _held(docs.schema["doc_id"].dataType.simpleString())
    held_id = F.base64("doc_id") if docs.schema["doc_id"].dataType == BinaryType() else F.col("doc_id").cast(held_type)
    return ordered.select(held_id, "text").mapInArrow(run, "file string, n_docs long, n_tokens long")


def read_shards(spark, folder: str, id_type: str = "long", *, sums: bool = False) -> DataFrame:
    """(file, doc_id, place, before, n_tokens, tokens) of every document in the files.

    before counts the file's tokens ahead of the document; tokens are its ids as little-endian 32-bit integers. With
    ``sums``, tokens gives way to ids_crc32, the CRC-32 of those bytes, so that the ids need not leave the task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                shard = WaveletFile(content.as_buffer().to_pybytes())
                all_tokens = shard.tokens()
                ends = np.cumsum(shard.lengths)
                for at in range(0, len(ends), 512):
                    e = ends[at : at + 512]
                    s = e - shard.lengths[at : at + 512]
                    seqs = [all_tokens[a:b].astype("<u4").tobytes() for a, b in zip(s, e)]
                    last = pa.array([zlib.crc32(x) for x in seqs], pa.int64()) if sums else pa.array(seqs, pa.binary())
                    yield pa.record_batch(
                        [pa.array([path.rsplit("/", 1)[-1]] * len(e)), pa.array(shard.doc_ids[at : at + 512], field_type), pa.array(np.arange(at, at + len(e))), pa.array(s), pa.array(e - s), last],
                        ["file", "doc_id", "place", "before", "n_tokens", "ids_crc32" if sums else "tokens"],
                    )

    held_type = _held(id_type)
    field_type = pa.int64() if held_type == "long" else pa.string()
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.wvlt").load(folder).select("path", "content")
    found = files.mapInArrow(run, f"file string, doc_id {held_type}, place long, before long, n_tokens long, {'ids_crc32 long' if sums else 'tokens binary'}")
    return found.withColumn("doc_id", F.unbase64("doc_id") if id_type == "binary" else F.col("doc_id").cast(id_type))


def op9_wavelet_shards(spark, sf_dir: str, tokenizer_file: str | None = None) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_dir(spark)}/wavelet-{uuid.uuid4().hex}"
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(path)
    store.deleteOnExit(path)
    uri = path.makeQualified(store.getUri(), store.getWorkingDirectory()).toUri().toString()
    uri = uri.replace("file:/", "file:///", 1) if re.match("file:/[^/]", uri) else uri
    totals = write_shards(docs, uri, tokenizer_file or public_tokenizers.path("byte_bpe_50k.json")).agg(F.count(F.lit(1)).alias("n")).first()
    id_type = docs.schema["doc_id"].dataType.simpleString()
    empty = spark.createDataFrame([], f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long")
    if not totals["n"]:
        return empty
    read = read_shards(spark, folder, id_type, sums=True)
    read = written(read, "wavelet-read")
    # One row a file: the running total is over files, not documents.
    sizes = read.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    starts = sizes.select("file", F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first"))
    return read.join(starts, "file").select("doc_id", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")

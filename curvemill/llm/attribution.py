"""Token counts of fields and sections by offset-mapped attribution.

A document's fields are written one after the other, with a separator between, and encoded whole, once. Tokens have
character spans; so have the fields and, in the text field, its sections (lines, each with the line ends after it).
Both lists are in order, so each token finds the sections it meets by an interval join on sorted bounds. A token that
meets one section counts there. A token that crosses a boundary counts for the section that holds most of its
characters, the earlier one on a tie ("most"), or for the section of its first character ("first"), or is shared by
characters ("share", a fraction). A character that several byte tokens make up belongs to the first of them; the
others have an empty span at its end and count where that is. Every token is counted exactly once.

Defined results: null fields are empty; an empty document has one empty section without tokens; repeated rows give
repeated rows; an empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RULES = ("most", "first", "share")
SEPARATOR = "\n\n"
_LINE_END = re.compile(r"\n+")


def sections(text: str) -> list[tuple[int, int]]:
    """Spans of the lines; together they cover the text."""
    bounds = [0, *[m.end() for m in _LINE_END.finditer(text)], len(text)]
    spans = [(a, b) for a, b in zip(bounds, bounds[1:]) if b > a]
    return spans or [(0, 0)]


def token_spans(text: str, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Character spans of tokens with the given byte lengths.

    A token covers the characters whose first byte it holds.
    """
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    first = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    ends = np.cumsum(lengths)
    return first[ends - lengths], first[ends]


def attribute(starts: np.ndarray, ends: np.ndarray, spans: Sequence[tuple[int, int]], rule: str = "most") -> np.ndarray:
    """Tokens of each span; spans are in order and touch each other."""
    a = np.array([s[0] for s in spans])
    b = np.array([s[1] for s in spans])
    counts = np.zeros(len(spans))
    if not len(starts):
        return counts
    lo = np.clip(np.searchsorted(b, starts, side="right"), 0, len(spans) - 1)
    hi = np.maximum(lo, np.clip(np.searchsorted(a, ends, side="left") - 1, 0, len(spans) - 1))
    inside = lo == hi
    if rule == "first":
        inside[:] = True
    counts += np.bincount(lo[inside], minlength=len(spans))
    for s, e, i, j in zip(starts[~inside], ends[~inside], lo[~inside], hi[~inside]):
        held = np.minimum(e, b[i : j + 1]) - np.maximum(s, a[i : j + 1])
        if rule == "most":
            counts[i + int(held.argmax())] += 1
        else:
            counts[i : j + 1] += held / held.sum()
    return counts


def attributed(docs: DataFrame, ranks_file: str, pattern: str, *, fields: Sequence[str] = ("source", "text"), rule: str = "most") -> DataFrame:
    """(doc_id, field, section, start, end, n_tokens) for every field and every section of the last field.

    The separators between fields count for the field before them. start and end are characters of the field.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    fields = list(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        with open(ranks_file, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        codec = tiktoken.Encoding("fields", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        length = np.zeros(max(ranks.values()) + 1, np.int64)
        for t, k in ranks.items():
            length[k] = len(t)
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                out: dict[str, list] = {k: [] for k in ("row", "field", "section", "start", "end", "n")}
                columns = [part.column(1 + i).to_pylist() for i in range(len(fields))]
                for row, values in enumerate(zip(*columns)):
                    values = [v or "" for v in values]
                    whole = SEPARATOR.join(values)
                    starts, ends = token_spans(whole, length[codec.encode_ordinary(whole)])
                    spans, names, at_char = [], [], 0
                    for k, v in enumerate(values[:-1]):
                        spans.append((at_char, at_char + len(v) + len(SEPARATOR)))
                        names.append((fields[k], 0, 0, len(v)))
                        at_char = spans[-1][1]
                    for k, (x, y) in enumerate(sections(values[-1])):
                        spans.append((at_char + x, at_char + y))
                        names.append((fields[-1], k, x, y))
                    for (name, k, x, y), n in zip(names, attribute(starts, ends, spans, rule).tolist()):
                        for key, v in zip(out, (row, name, k, x, y, n)):
                            out[key].append(v)
                yield pa.record_batch(
                    [part.column(0).take(pa.array(out["row"], pa.int64())), pa.array(out["field"], pa.string()), pa.array(out["section"], pa.int32()), pa.array(out["start"], pa.int32()), pa.array(out["end"], pa.int32()), pa.array(out["n"], pa.float64())],
                    ["doc_id", "field", "section", "start", "end", "n_tokens"],
                )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    named = docs.select("doc_id", *[F.col(f).cast("string") for f in fields])
    return named.mapInArrow(run, f"doc_id {id_type}, field string, section int, start int, end int, n_tokens double")


def op8_offset_attribution(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = attributed(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return found.select("doc_id", "field", "section", "start", "end", F.col("n_tokens").cast("long").alias("n_tokens"))

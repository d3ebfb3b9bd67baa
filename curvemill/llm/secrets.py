"""Secrets in texts: values by their form, and candidates that are reported only if their structure holds.

Base kinds are patterns: ``assign`` (a value given to a password, secret, token or key), ``access`` (access key ids) and ``hex``.
The structural kinds come from candidates that are decoded and parsed before anything is reported:

* runs of base64 (over line ends too), the bodies of PEM blocks and runs of hex are decoded, and the bytes must be the
  nested type-length-value encoding of a private key (``rsa``, ``ec``, ``dsa``, ``pkcs8``, ``encrypted_key``) to the last
  length, or the length-prefixed strings of an OpenSSH key (``openssh``);
* base64 that decodes to text is searched again, once, for PEM blocks and signed tokens;
* dotted runs of base64url must have a header that is a JSON object with a known ``alg``, and parts of the sizes
  which that algorithm gives (``jws``: a signature; ``jwe``: with ``enc``, its vector and tag).

Public keys, certificates, plain hashes and text that merely looks like base64 are not reported. Every pattern runs over
the whole text in linear time. Null and empty texts have no spans; equal spans of one kind are one; a run that
lies in a reported PEM block is not reported again. Rows keep their places: one result for each, repeats included.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType, _parse_datatype_string

Span = tuple[str, int, int]

#: Kinds in the order in which spans of one start are listed.
BASE = ("assign", "access", "hex")
STRUCTURAL = ("rsa", "ec", "dsa", "pkcs8", "encrypted_key", "openssh", "jws", "jwe")
_ORDER = {k: i for i, k in enumerate(BASE + STRUCTURAL)}

# The base kinds' patterns and least lengths.
_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")
_LEAST_VALUE = 8

# Signature bytes of each algorithm (0: RSA, whose signatures are as long as the key), and the bytes of
# vector and tag of each content encryption.
_SIGNATURE = {"HS256": 32, "HS384": 48, "HS512": 64, "ES256": 64, "ES256K": 64, "ES384": 96, "ES512": 132, "EdDSA": 64, "RS256": 0, "RS384": 0, "RS512": 0, "PS256": 0, "PS384": 0, "PS512": 0}
_CONTENT = {"A128GCM": (12, 16), "A192GCM": (12, 16), "A256GCM": (12, 16), "A128CBC-HS256": (16, 16), "A192CBC-HS384": (16, 24), "A256CBC-HS512": (16, 32)}

# Object identifiers as encoded.
_OID_RSA, _OID_DSA, _OID_EC, _OID_PBES2 = (bytes.fromhex(x) for x in ("2a864886f70d010101", "2a8648ce380401", "2a8648ce3d0201", "2a864886f70d01050d"))
_OID_CURVES = tuple(bytes.fromhex(x) for x in ("2b656e", "2b656f", "2b6570", "2b6571"))  # X25519, X448, Ed25519, Ed448
_EC_BYTES = (20, 24, 28, 32, 48, 64, 66)

#: Base64 characters with line ends inside; starts where no base64 character stands before it.
_RUN = re.compile(r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{32,}+(?:\r?\n[A-Za-z0-9+/]++)*+={0,2}")
_URL_RUN = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{32,}+={0,2}")
_HEX_RUN = re.compile(r"(?<![0-9A-Za-z])[0-9A-Fa-f]{64,}+(?![0-9A-Za-z])")
_DOTTED = re.compile(r"(?<![A-Za-z0-9_.-])[A-Za-z0-9_-]{8,}+(?:\.[A-Za-z0-9_-]*+){2,4}(?![A-Za-z0-9_.-])")
_DOTTED_START = re.compile(r"(?<![A-Za-z0-9_-])e[wy][A-Za-z0-9_-]{6,}+\.")
_BEGIN = re.compile(r"-----BEGIN ([A-Z0-9 ]*)PRIVATE KEY-----")
_BREAKS = re.compile(r"\\[rn]|\s+")
_HEADER = re.compile(r"(?:^|\n)[A-Za-z-]+: [^\n]*")
_MAGIC = b"openssh-key-v1\0"


def _element(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """(tag, start, end) of the element at ``at``; None unless its length is well formed and ends by ``end``."""
    if at + 2 > end:
        return None
    tag, n = data[at], data[at + 1]
    at += 2
    if n & 0x80:
        width = n & 0x7F
        if not 1 <= width <= 4 or at + width > end or data[at] == 0:
            return None
        n = int.from_bytes(data[at : at + width], "big")
        at += width
        if n < 0x80:
            return None  # it must be written short
    return (tag, at, at + n) if at + n <= end else None


def _children(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """The elements that fill data[at:end] to its end; None if they don't."""
    found = []
    while at < end:
        if (e := _element(data, at, end)) is None or len(found) > 32:
            return None
        found.append(e)
        at = e[2]
    return found


def _whole(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """The members of the one sequence that fills data[at:end]."""
    e = _element(data, at, end)
    return _children(data, e[1], e[2]) if e and e[0] == 0x30 and e[2] == end else None


def _integers(data: bytes, parts: list) -> list[int] | None:
    return [int.from_bytes(data[a:b], "big", signed=True) for _, a, b in parts] if all(t == 2 and b > a for t, a, b in parts) else None


def _plain_key(data: bytes, at: int, end: int) -> str | None:
    """rsa, dsa or ec, if data[at:end] is such a key in its traditional form."""
    parts = _whole(data, at, end)
    if not parts or parts[0][0] != 2:
        return None
    if len(parts) in (9, 10) and (v := _integers(data, parts[:9])):
        # Each prime is about half as long as the modulus, and the exponent that undoes e is there.
        return "rsa" if v[0] in (0, 1) and v[1].bit_length() >= 256 and min(v[2:]) > 0 and abs(v[4].bit_length() + v[5].bit_length() - v[1].bit_length()) <= 2 else None
    if len(parts) == 6 and (v := _integers(data, parts)):
        return "dsa" if v[0] == 0 and v[1].bit_length() >= 512 and 128 <= v[2].bit_length() <= 512 and 0 < v[5] < v[2] else None
    if 2 <= len(parts) <= 4 and parts[1][0] == 4 and data[parts[0][1] : parts[0][2]] == b"\x01" and parts[1][2] - parts[1][1] in _EC_BYTES:
        return "ec" if [t for t, _, _ in parts[2:]] in ([], [0xA0], [0xA1], [0xA0, 0xA1]) and all(_children(data, a, b) for _, a, b in parts[2:]) else None
    return None


def key_kind(data: bytes) -> str | None:
    """The kind of private key that ``data`` encodes, all lengths nested and used to the last byte; else None."""
    if data.startswith(_MAGIC):
        return "openssh" if _openssh(data) else None
    if not data.startswith(b"\x30") or not (parts := _whole(data, 0, len(data))):
        return None
    if kind := _plain_key(data, 0, len(data)):
        return kind
    tags = [t for t, _, _ in parts]
    if tags[:3] == [2, 0x30, 4] and set(tags[3:]) <= {0xA0, 0x81, 0xA1} and data[parts[0][1] : parts[0][2]] in (b"\0", b"\x01"):
        oid = _children(data, *parts[1][1:])
        _, a, b = parts[2]
        if not oid or oid[0][0] != 6:
            return None
        name = data[oid[0][1] : oid[0][2]]
        if name in _OID_CURVES:
            inner = _element(data, a, b)
            return "pkcs8" if inner and inner[0] == 4 and inner[2] == b and inner[2] - inner[1] in (32, 56, 57) else None
        if name == _OID_DSA:
            inner = _element(data, a, b)
            return "pkcs8" if inner and inner[0] == 2 and inner[2] == b else None
        return "pkcs8" if name in (_OID_RSA, _OID_EC) and _plain_key(data, a, b) in ("rsa", "ec") else None
    if tags == [0x30, 4] and parts[1][2] - parts[1][1] >= 16 and (oid := _children(data, *parts[0][1:])) and len(oid) == 2 and oid[0][0] == 6:
        return "encrypted_key" if data[oid[0][1] : oid[0][2]] == _OID_PBES2 and oid[1][0] == 0x30 and _children(data, *oid[1][1:]) else None
    return None


def _openssh(data: bytes) -> bool:
    """Whether the length-prefixed strings behind the magic nest to the end, and an open key's check numbers agree."""
    at = len(_MAGIC)

    def take(at: int, end: int) -> tuple[int, int] | None:
        if at + 4 > end:
            return None
        n = int.from_bytes(data[at : at + 4], "big")
        return (at + 4, at + 4 + n) if at + 4 + n <= end else None

    heads = []
    for _ in range(3):  # cipher, key derivation, its options
        if (s := take(at, len(data))) is None:
            return False
        heads.append(data[s[0] : s[1]])
        at = s[1]
    keys = int.from_bytes(data[at : at + 4], "big")
    at += 4
    if not 1 <= keys <= 16:
        return False
    for _ in range(keys):
        if (s := take(at, len(data))) is None or (kind := take(s[0], s[1])) is None or not data[kind[0] : kind[1]].isascii():
            return False
        at = s[1]
    s = take(at, len(data))
    if s is None or s[1] != len(data) or s[1] - s[0] < 8:
        return False
    return heads[0] != b"none" or data[s[0] : s[0] + 4] == data[s[0] + 4 : s[0] + 8]


def _decoded(run: str, url: bool = False) -> bytes | None:
    """A base64 run's bytes; None if it has a length that no bytes give."""
    run = run.rstrip("=")
    if len(run) % 4 == 1:
        return None
    try:
        return (base64.urlsafe_b64decode if url else base64.b64decode)(run + "=" * (-len(run) % 4))
    except (binascii.Error, ValueError):
        return None


def _object(part: str) -> dict | None:
    """The JSON object that a base64url part holds, else None."""
    data = _decoded(part, url=True)
    if not data or not data.lstrip().startswith(b"{"):
        return None
    try:
        found = json.loads(data)
    except (ValueError, RecursionError):
        return None
    return found if isinstance(found, dict) else None


def token_kind(token: str) -> str | None:
    """jws or jwe, if the dotted token's header, payload and sizes hold; else None."""
    parts = token.split(".")
    header = _object(parts[0]) if len(parts) in (3, 5) else None
    if header is None or not isinstance(header.get("alg"), str):
        return None
    if len(parts) == 3:
        signature, wanted = _decoded(parts[2], url=True), _SIGNATURE.get(header["alg"])
        if wanted is None or signature is None or not parts[1]:
            return None
        if not (len(signature) == wanted if wanted else 128 <= len(signature) <= 1024):
            return None
        # Claims are an object; other payloads say what they are in the header.
        return "jws" if _object(parts[1]) is not None or "cty" in header or header.get("b64") is False else None
    sizes = _CONTENT.get(header.get("enc")) if isinstance(header.get("enc"), str) else None
    found = [_decoded(p, url=True) for p in parts[2:]]
    return "jwe" if sizes and None not in found and (len(found[0]), len(found[2])) == sizes and found[1] else None


def _pem_blocks(text: str) -> list[Span]:
    out = []
    begins = [*_BEGIN.finditer(text)]
    for m, following in zip(begins, [*[x.start() for x in begins[1:]], len(text)]):
        close = f"-----END {m[1]}PRIVATE KEY-----"
        if (end := text.find(close, m.end(), following)) < 0:
            continue
        body = text[m.end() : end].replace("\\n", "\n").replace("\\r", "")
        encrypted = "ENCRYPTED" in body
        data = _decoded(_BREAKS.sub("", _HEADER.sub("", body)))
        kind = key_kind(data) if data else None
        if not kind and encrypted and data and len(data) % 8 == 0 and len(data) >= 64:
            kind = "encrypted_key"  # the traditional form, in whole blocks of its cipher
        if kind:
            out.append((kind, m.start(), end + len(close)))
    return out


def _tokens(text: str) -> list[Span]:
    if not _DOTTED_START.search(text):
        return []
    return [(kind, m.start(), m.end()) for m in _DOTTED.finditer(text) if (kind := token_kind(m[0]))]


def _holds(data: bytes) -> str | None:
    """The kind of key or token that decoded bytes hold: a key's encoding, or a text with a key or token inside."""
    if kind := key_kind(data):
        return kind
    if b"PRIVATE KEY-----" in data or b"." in data:
        try:
            inner = data.decode()
        except UnicodeDecodeError:
            return None
        found = _pem_blocks(inner) or _tokens(inner)
        return found[0][0] if found else None
    return None


def structural_spans(text: str) -> list[Span]:
    """(kind, start, end) of what is confirmed by its structure, in code points, by start."""
    found = _pem_blocks(text) if "PRIVATE KEY-----" in text else []
    starts, ends = [a for _, a, _ in found], [0, *[b for _, _, b in found]]
    free = lambda m: m.end() > ends[bisect_right(starts, m.start())]  # noqa: E731  blocks follow each other
    if "." in text:
        found += _tokens(text)
    for m in _RUN.finditer(text):
        if free(m) and (data := _decoded(_BREAKS.sub("", m[0]))) and (kind := _holds(data)):
            found.append((kind, m.start(), m.end()))
    if "-" in text or "_" in text:
        taken = {(a, b) for _, a, b in found}
        for m in _URL_RUN.finditer(text):
            if ("-" in m[0] or "_" in m[0]) and m.span() not in taken and free(m) and (data := _decoded(m[0], url=True)) and (kind := _holds(data)):
                found.append((kind, m.start(), m.end()))
    for m in _HEX_RUN.finditer(text):
        if len(m[0]) % 2 == 0 and free(m) and (kind := _holds(bytes.fromhex(m[0]))):
            found.append((kind, m.start(), m.end()))
    return sorted(set(found), key=lambda s: (s[1], _ORDER[s[0]], s[2]))


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) of the base kinds: leftmost and non-overlapping by kind, too short ones dropped; by start, then kind."""
    found = []
    low = text.lower()
    if any(name in low for name in _NAMES):
        found += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= _LEAST_VALUE]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], _ORDER[s[0]]))


def find_secrets(docs: DataFrame, text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry`` with base and confirmed: arrays of (kind, start, end) in code points, by start, then kind."""
    span = "array<struct<kind: string, start: long, end: long>>"
    schema = StructType([*[docs.schema[c] for c in carry], StructField("base", _parse_datatype_string(span)), StructField("confirmed", _parse_datatype_string(span))])
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                part = whole.slice(at, 1024)
                texts = [v.as_py() or "" for v in part.column(part.num_columns - 1)]
                as_rows = lambda spans: [dict(zip(("kind", "start", "end"), s)) for s in spans]
                base = pa.array([as_rows(base_spans(t)) for t in texts], arrow)
                confirmed = pa.array([as_rows(structural_spans(t)) for t in texts], arrow)
                yield pa.record_batch([*part.columns[:-1], base, confirmed], schema.names)

    return docs.select(*carry, docs[text].alias("_secrets_text")).mapInArrow(run, schema)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What op12 returns of each document's spans."""
    spell = lambda spans: ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in spans)
    for batch in batches:
        base, confirmed = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        counts = [pa.array([sum(s["kind"] == k for s in b) for b in base], pa.int64()) for k in BASE]
        every = [sorted(b + c, key=lambda s: (s["start"], _ORDER[s["kind"]], s["end"])) for b, c in zip(base, confirmed)]
        digests = pa.array([hashlib.sha256(spell(b).encode()).hexdigest() for b in base], pa.string())
        yield pa.record_batch([batch.column(0), *counts, digests, pa.array([spell(e) for e in every], pa.string())], ["doc_id", *[f"n_{k}" for k in BASE], "base_sha256", "spans"])


def op12_structural_secrets(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    schema = StructType([docs.schema["doc_id"], *[StructField(f"n_{k}", LongType()) for k in BASE], StructField("base_sha256", StringType()), StructField("spans", StringType())])
    return find_secrets(docs).mapInArrow(_digest, schema)

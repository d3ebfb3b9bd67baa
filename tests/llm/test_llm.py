"""Every operator against a plain version, and on nulls, empty and long texts, ties, repeats, empty tables and clashing names."""

import hashlib
import random
import re
import zlib
from datetime import date
from decimal import Decimal

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from curvemill.llm import attribution, audio, bpe, graph, lines, mixing, pieces, pii, quality, registry, simhash, url_filter, wavelet
from tests.conftest import rows

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LONG = "lorem ipsum dolor sit amet " * 4000


@pytest.fixture(scope="module")
def docs(spark):
    data = [
        (1, "one two three four five six seven\nshort", "a", "x"),
        (2, None, "a", "y"),
        (3, "", None, None),
        (4, "  \n\t", "b", "x"),
        (5, LONG, "b", "x"),
        (6, "one two three four five six seven", "c", "x"),
        (7, "one two three FOUR five six seven mail a.b@c.de or +1 (555) 123-4567 and 10.0.0.1", "c", "x"),
        (7, "one two three FOUR five six seven mail a.b@c.de or +1 (555) 123-4567 and 10.0.0.1", "c", "x"),
        (None, "lone text without an id, é漢🙂", None, "x"),
        (None, "lone text without an id, é漢🙂", None, "x"),
    ]
    return spark.createDataFrame(data, "doc_id long, text string, source string, score string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (6, 1, 0), (4, 0, 0), (None, 1, None)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def real(spark, sf):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


def test_quality_base_rules(spark, sf, real, docs, labels):
    got = registry.queries()["op1_likelihood_ratio"](spark, sf).collect()
    assert len(got) == len(real)
    for r in got:
        text = real[r.doc_id]
        w = WORDS.findall(text)
        places = {}
        for i in range(len(w) - 7):
            places.setdefault(tuple(w[i : i + 8]), []).append(i)
        repeated = {k for v in places.values() if len(v) > 1 for i in v for k in range(i, i + 8)}
        held = [x for x in text.split("\n") if WORDS.search(x)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(held) - len(set(held)), len(repeated))
        assert r.base_failed == (len(w) < 20 or 100 * len(repeated) > 30 * len(w))
        assert not (r.kept and r.base_failed)
    kept = quality.keep_quality(docs, labels)
    assert kept.columns == docs.columns and quality.keep_quality(docs.limit(0), labels.limit(0)).count() == 0
    assert quality.quality_rules(docs, labels).count() == docs.count()


def test_quality_scores(spark, docs, labels, monkeypatch):
    import math

    def h(n):
        return n % (1 << 64) >> (65 - quality.BUCKETS.bit_length())

    found = quality.quality_rules(docs.select("doc_id", "text").where("doc_id in (1, 6, 7)"), labels).collect()
    grams = {}
    for r in docs.where("doc_id in (1, 6, 7)").select("doc_id", F.expr("split(text, '[ \\n]')").alias("w")).select("doc_id", F.transform("w", lambda w: F.xxhash64(w)).alias("h"), F.expr("transform(sequence(0, size(w) - 2), i -> xxhash64(xxhash64(w[i]), xxhash64(w[i + 1])))").alias("p")).collect():
        grams.setdefault(r.doc_id, []).append([h(x) for x in [*r.h, *r.p]])
    raw, target = np.zeros(quality.BUCKETS), np.zeros(quality.BUCKETS)
    for k, texts in grams.items():
        for g in texts:
            np.add.at(raw, g, 1)
            if k in (1, 6):
                np.add.at(target, g, 1)
    weight = np.log((target + quality.PRIOR) / (target.sum() + quality.PRIOR * quality.BUCKETS)) - np.log((raw + quality.PRIOR) / (raw.sum() + quality.PRIOR * quality.BUCKETS))
    for r in found:
        assert math.isclose(r.score, weight[grams[r.doc_id][0]].mean(), rel_tol=1e-9, abs_tol=1e-12)


def test_quality_does_not_depend_on_size(spark):
    rng = random.Random(9)
    data = [(i, " ".join(f"w{int(rng.expovariate(0.01))}" for _ in range(60))) for i in range(120)]
    small = spark.createDataFrame(data, "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    few = spark.createDataFrame([(i, 1, 0) for i in range(3)], none.schema)
    assert {(r.kept, r.score) for r in quality.quality_rules(small, none).collect()} == {(True, 0.0)}
    assert all(r.kept for r in quality.quality_rules(small, few).collect())
    good, bad = ([" ".join(f"{k}{rng.randrange(300)}" for _ in range(20000)) for _ in range(40)] for k in "gb")
    large = spark.createDataFrame(list(enumerate([*good, *bad])), "doc_id long, text string")
    half = spark.createDataFrame([(i, 1, 0) for i in range(20)], none.schema)
    assert {r.doc_id for r in quality.quality_rules(large, half).where("kept").collect()} == set(range(40))


def test_audio_round_trip(spark, sf, real, docs):
    for r in registry.queries()["op2_audio_features"](spark, sf).limit(40).collect():
        raw = real[r.doc_id].encode()
        payload = raw + b"\xff" * (-len(raw) % 576 if raw else 576)
        media = audio.to_wav(payload)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest())
        assert (r.tail_crc32, r.media_bytes, r.media_sha256) == (zlib.crc32(payload[-32:]), len(media), hashlib.sha256(media).hexdigest())
    clips = audio.encode_texts(docs, carry=("doc_id", "score"))
    assert audio.audio_features(clips).count() == docs.count()
    none = audio.audio_features(clips.withColumn("media", F.lit(None).cast("binary"))).first()
    assert none.n_blocks == 0 and none.segments == [] and audio.audio_features(clips.limit(0)).count() == 0


def test_log_mel_against_a_plain_transform():
    """Frame by frame: windowed, its spectrum by the sum that defines it, the filters' sums, their logarithm."""
    k, x = audio.Kernels(), np.random.default_rng(5).normal(0, 0.3, 1000).astype(np.float32)
    got = audio.log_mel(x, k)[0]
    n = np.arange(audio.WINDOW)
    spectrum = np.exp(-2j * np.pi * np.outer(np.arange(audio.FFT // 2 + 1), n) / audio.FFT)
    for f in (0, 3, (len(x) - audio.WINDOW) // audio.HOP):
        part = x[f * audio.HOP : f * audio.HOP + audio.WINDOW].astype(float) * k.hann
        power = np.abs(spectrum @ part) ** 2
        assert np.allclose(got[f], np.log(power @ k.mels + audio.FLOOR), atol=2e-3)
    tops = k.mels.argmax(0)
    assert (np.diff(tops) >= 0).all() and (k.mels >= 0).all() and k.mels.shape == (audio.FFT // 2 + 1, audio.MELS)


def test_audio_chunks_do_not_show():
    k, rng = audio.Kernels(), np.random.default_rng(0)
    step = audio.FRAMES * audio.HOP * audio.DOWN // audio.UP * 64
    for n in (1, 576, step - 1, step, step + 1, step + 300, 2 * step + 7):
        x = rng.integers(0, 256, n, dtype=np.uint8)
        whole = audio.log_mel(audio.resample((x.astype(np.float32) - 128) / 128, k.taps), k)[0]
        import pyarrow as pa

        found = audio.clip_features(audio.to_wav(x.tobytes()), k)
        table = pa.ipc.open_stream(found["tensors"]).read_all()
        got = np.concatenate([c.to_numpy_ndarray() for c in table["log_mel"].chunks]).reshape(-1, audio.MELS)[: len(whole)]
        assert np.array_equal(got, whole.astype(np.float16)) and table["log_mel"].type.shape == [audio.FRAMES, audio.MELS]


def test_resampling_keeps_a_tone():
    x = np.sin(2 * np.pi * 1000 * np.arange(12000) / 12000).astype(np.float32)
    y = audio.resample(x, audio.polyphase_taps())
    assert len(y) == 8000 and np.abs(y[1000:2000] - np.sin(2 * np.pi * 1000 * np.arange(1000, 2000) / 8000)).max() < 1e-3
    assert audio.hysteresis(np.array([1, 1, 1, 1.1, 2, 1.1, 1, 1])) == [(3, 6)]


def test_mix_targets_and_limits(spark, sf, docs):
    got = registry.queries()["op3_weighted_fair_mix"](spark, sf).toPandas()
    per = got.groupby("target").agg(taken=("taken", "sum"), size=("size", "sum"), most=("size", "max"), n=("source_size", "nunique"))
    assert (got.taken <= 3 * got["size"]).all() and got.taken.sum() <= got["size"].sum()
    by_source = got.groupby("source_size").agg(taken=("taken", "sum"), target=("target", "first"), most=("size", "max"))
    assert ((by_source.taken - by_source.target).abs() <= 2 * by_source.most + 1).all() and len(per)
    assert abs(by_source.target.sum() - got["size"].sum()) < 1e-6 * got["size"].sum() and rows(got) == rows(registry.queries()["op3_weighted_fair_mix"](spark, sf).toPandas())
    plan, mixed = mixing.mix_plan(docs), mixing.mix(docs)
    assert plan.count() == docs.count() and mixed.columns == docs.columns and mixed.count() == plan.agg(F.sum("repeats")).first()[0]
    assert mixing.mix_plan(docs.limit(0)).count() == 0 and mixing.mix(docs.limit(0)).count() == 0


def _plain_mix(rows, weights=(5, 2, 1), repeats=3):
    """rows: (position, source, words, shuffle key, doc_id) -> copies taken of each, by a plain queue of finish times."""
    names = sorted({r[1] for r in rows}, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    finish, sizes = [], {}
    for s in names:
        queue = sorted((r for r in rows if r[1] == s), key=lambda r: (r[3], r[4] is not None, r[4] or 0))
        sizes[s], served = sum(r[2] for r in queue), 0
        for r in queue:
            served += r[2]
            if r[2]:
                finish += [((e * sizes[s] + served) / weight[s], r[2], r[0]) for e in range(repeats)]
    taken, total = dict.fromkeys((r[0] for r in rows), 0), 0
    finish.sort()
    at = 0
    while at < len(finish):
        tied = [f for f in finish[at:] if f[0] == finish[at][0]]
        if total + sum(f[1] for f in tied) > sum(sizes.values()):
            break
        total += sum(f[1] for f in tied)
        for f in tied:
            taken[f[2]] += 1
        at += len(tied)
    return taken


def test_mix_against_a_plain_queue(spark, sf, monkeypatch):
    data = [(i, " ".join("ab"[j % 2] for j in range(i % 9)), ("x", "y", None, "z")[i * i % 7 % 4]) for i in range(90)] + [(5, "a b", "x"), (5, "a b", "x"), (None, "a", None), (7, None, "q")]
    mine = spark.createDataFrame(data, "doc_id long, text string, source string")
    for given in (mine, spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "source")):
        rows_ = given.select("doc_id", "source", "text", mixing._shuffle_key(42).alias("r")).collect()
        plain = _plain_mix([(i, r.source, len(WORDS.findall(r.text or "")), r.r, r.doc_id) for i, r in enumerate(rows_)])
        want = sorted(((r.doc_id is None, r.doc_id or 0), plain[i] * len(WORDS.findall(r.text or ""))) for i, r in enumerate(rows_))
        monkeypatch.setattr(mixing, "RANGES", 8)
        assert sorted(((r.doc_id is None, r.doc_id or 0), r.taken) for r in mixing.mix_plan(given).collect()) == want


def test_targets_fill_in_proportion(spark):
    rng = random.Random(1)
    for _ in range(5):
        sizes = [rng.randrange(1, 1000) for _ in range(7)]
        given = spark.createDataFrame([(f"t{i}", n) for i, n in enumerate(sizes)], "_wfq_key string, source_size long")
        got = [r.target for r in mixing.source_targets(given, (5, 2, 1), 3, 1.0).orderBy("_wfq_key").collect()]
        weights, want, free = [(5, 2, 1)[i % 3] for i in range(7)], [0.0] * 7, set(range(7))
        while True:
            level = (sum(sizes) - sum(3 * sizes[i] for i in range(7) if i not in free)) / sum(weights[i] for i in free)
            full = {i for i in free if weights[i] * level > 3 * sizes[i]}
            if not full:
                break
            free -= full
        want = [weights[i] * level if i in free else 3.0 * sizes[i] for i in range(7)]
        assert np.allclose(got, want)


def _components(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_simhash_fingerprints():
    import xxhash

    rng = random.Random(2)
    for n in (0, 1, 2, 3, 30):
        text = " \n".join(rng.choice(["Ab", "cd", "éf", "G"]) for _ in range(n))
        w = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
        shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0
        assert simhash.simhash(text) % (1 << 64) == want
    assert simhash.simhash(None) == 0


@pytest.mark.parametrize("four_parts", [1 << 20, 10])
def test_simhash_links_are_complete(spark, monkeypatch, four_parts):
    monkeypatch.setattr(simhash, "FOUR_PARTS_UP_TO", four_parts)
    monkeypatch.setattr(simhash, "MAX_CANDIDATES", 40)
    rng = np.random.default_rng(3)
    centres = rng.integers(-(1 << 63), (1 << 63) - 1, 20)
    points = set()
    for k in range(900):
        x = int(centres[k % 2 if k < 700 else k % 20]) % (1 << 64)
        for b in rng.integers(0, 64, rng.integers(0, 5)):
            x ^= 1 << int(b)
        points.add(x - (1 << 64) if x >> 63 else x)
    points = sorted(points)
    v = np.array(points).view(np.uint64)
    near = [(points[i], points[i + 1 + j]) for i in range(len(v)) for j in np.flatnonzero(np.bitwise_count(v[i + 1 :] ^ v[i]) <= 2)]
    found = [(r.u, r.v) for r in simhash.links(spark.createDataFrame([(p,) for p in points], "fp long")).collect()]
    assert all(bin((a ^ b) % (1 << 64)).count("1") <= 2 for a, b in found)
    assert _components(found, points) == _components(near, points)


def test_simhash_on_odd_rows(spark, docs):
    got = simhash.near_duplicates(docs)
    assert got.count() == docs.count()
    zero = {r.component_id for r in got.where("fp = 0").collect()}
    assert zero == {2}
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and kept.where("doc_id = 7").count() == 1 and kept.where("doc_id is null").count() == 1
    assert simhash.near_duplicates(docs.limit(0)).count() == 0 and simhash.drop_near_duplicates(docs.limit(0)).count() == 0


def test_near_copies_are_similar_sets(spark, monkeypatch):
    monkeypatch.setattr(simhash, "LOOK_EVERY", 1)
    rng = random.Random(8)
    common = " ".join(f"c{i}" for i in range(30))
    texts = []
    for k in range(60):
        w = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([6, 40, 100, 200]))]
        base = " ".join(w) + " " + common * (k % 3 == 0)
        texts.append(base)
        for _ in range(rng.randrange(1, 4)):
            v = base.split()
            for _ in range(rng.randrange(1, 5)):
                v[rng.randrange(len(v))] = f"x{rng.randrange(5000)}"
            texts.append(" ".join(v))
    rng.shuffle(texts)
    sets = [set(zip(*[t.split()[i:] for i in range(5)])) for t in texts]
    n = range(len(texts))
    near = [(i, j) for i in n for j in range(i) if 9 * len(sets[i] & sets[j]) >= 4 * (len(sets[i]) + len(sets[j]))]
    assert sum(bin((simhash.simhash(texts[i], 5) ^ simhash.simhash(texts[j], 5)) % (1 << 64)).count("1") > 2 for i, j in near) > 20
    given = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {r.doc_id for r in simhash.drop_near_duplicates(given).collect()}
    assert kept == set(_components(near, list(n)).values())


def test_a_text_and_its_longest_fitting_extension_are_similar(spark):
    """A set that another one holds: most of its keys may lie behind the other one's keys."""
    texts = []
    for k in range(30):
        w = [f"w{k}.{i}" for i in range(104)]
        texts += [" ".join(w), " ".join(w[:84] if k % 2 else w[20:])]  # 80 of 100 shingles
    given = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id for r in simhash.drop_near_duplicates(given).collect()} == set(range(0, 60, 2))


def test_lines_against_sql(spark, sf, duck):
    ours = registry.queries()["op5_deletion_neighbourhood"](spark, sf).toPandas()
    assert rows(ours) == rows(duck.sql(registry.oracle_sql()["op5_deletion_neighbourhood"]).df())


def test_lines_against_loops(spark, docs, monkeypatch):
    rng = random.Random(4)
    data = [(i, "\n".join(" ".join(rng.choice("abc") for _ in range(rng.choice((2, 4, 5, 6, 7, 12)))) for _ in range(4))) for i in range(60)]
    long = [rng.choice("abcdefgh") for _ in range(300)]
    data += [(100 + k, " ".join([*long[: 70 * k], "x", *long[70 * k + k % 2 :]])) for k in range(5)] + [(110, " \t".join([*long[:9], "y", *long[9:]]) + "  ")]
    got = {r.doc_id: r.text for r in lines.dedup_lines(spark.createDataFrame(data, "doc_id long, text string")).collect()}

    def near(a, b):
        if len(a) < len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) <= 1
        return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))

    seen, want = [], {}
    for i, text in data:
        kept = []
        for line in text.split("\n"):
            w = line.split()
            if not any(w == s or (min(len(w), len(s)) >= lines.LEAST_WORDS and near(w, s)) for s in seen):
                kept.append(line)
            seen.append(w)
        if kept:
            want[i] = "\n".join(kept)
    assert got == want
    monkeypatch.setattr(lines, "BROADCAST_ROWS", 0)
    assert {r.doc_id: r.text for r in lines.dedup_lines(spark.createDataFrame(data, "doc_id long, text string")).collect()} == want
    odd = lines.dedup_lines(docs)
    assert odd.columns == docs.columns and odd.where("doc_id = 7").count() == 2 and odd.where("text is null").count() == 1
    assert odd.where("doc_id = 6").count() == 0 and lines.dedup_lines(docs.limit(0)).count() == 0
    short = spark.createDataFrame([(1, "same short line"), (2, "same short line\nmore"), (3, "same short lines"), (3, "other"), (3, "more")], "doc_id int, text string")
    assert sorted(r.text for r in lines.dedup_lines(short).collect()) == ["more", "other", "same short line", "same short lines"]


PATTERNS = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))


def _plain_spans(text):
    def luhn(d):
        return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0

    out = []
    for kind, pattern in PATTERNS:
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else True, "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def test_pii_patterns(spark, sf, real):
    rng = random.Random(5)
    for _ in range(5000):
        text = "".join(rng.choice("a1@.-+ (4)5%é\n") for _ in range(rng.randrange(60)))
        assert [s[:3] for s in pii.find_spans(text)] == _plain_spans(text)
    assert [s[0] for s in pii.find_spans("card 4111 1111 1111 1111")] == ["card"]
    for r in registry.queries()["op6_information_sanitiser"](spark, sf).collect():
        want = _plain_spans(real[r.doc_id])
        spelt = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(spelt.encode()).hexdigest() and r.spans.startswith(spelt)


def test_pii_disclosure(spark, docs):
    import math

    data = [(i, f"Plain words number {chr(97 + i % 26) * 4} and more prose near the house", 0) for i in range(60)]
    data += [(100 + i, f"Note {chr(97 + i) * 5}: patient Zanthor lives near jane@x.org and likes tea", 1) for i in range(4)]
    given = spark.createDataFrame(data, "doc_id long, text string, near int")
    got = {r.term: r.disclosure for r in pii.disclosures(given, pii.scan(given)).collect()}
    n_t = {t: sum(t in x[1].lower().split() for x in data) for t in ("zanthor", "near", "and")}
    for t, n in n_t.items():
        d = math.log(64 * 4 / (4 * n)) / math.log(64 / 4)
        assert (t in got) == (d >= pii.GENERALISE) and (t not in got or math.isclose(got[t], d))
    clean = {r.doc_id: r.text for r in pii.sanitise(given).collect()}
    assert "Zanthor" not in clean[100] and "jane" not in clean[100] and "<email>" in clean[100] and clean[3] == data[3][1]
    odd = pii.sanitise(docs)
    assert odd.columns == docs.columns and odd.count() == docs.count() and pii.sanitise(docs.limit(0)).count() == 0


def test_pii_values_of_one_text(spark):
    import math

    data = [(i, f"Plain words number {chr(97 + i % 26) * 4} and more prose near the house") for i in range(200)]
    data += [(300, "Note: patient Zanthor lives near the house, jane@x.org or 10.0.0.1")]
    given = spark.createDataFrame(data, "doc_id long, text string")
    got = {r.term: r.disclosure for r in pii.disclosures(given, pii.scan(given)).collect()}
    p = 1 / 201
    assert math.isclose(got["zanthor"], math.log((1 + p) / 2 / p) / math.log(1 / p)) and not {"near", "the", "house"} & set(got)
    clean = {r.doc_id: r.text for r in pii.sanitise(given).collect()}
    assert clean[300] == "<name>: <word> <name> <word> near the house, <email> or <ip>" and clean[5] == data[5][1]


def test_pii_terms_of_the_whole_document(spark):
    filler = "plain words and more prose near the house " * 10
    data = [(i, filler) for i in range(200)] + [(300 + i, f"Zanthor {filler} at jane@x.org {filler * (i + 1)} for ZANTHOR.") for i in range(3)]
    given = spark.createDataFrame(data, "doc_id long, text string")
    clean = {r.doc_id: r.text for r in pii.sanitise(given).collect()}
    assert all("zanthor" not in clean[300 + i].lower() and "<email>" in clean[300 + i] for i in range(3)) and clean[5] == filler


def test_components_against_loops(spark):
    rng = random.Random(6)
    pairs = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(500 + i, 501 + i) for i in range(40)] + [(999, 999), (None, 3)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    real_pairs = [p for p in pairs if None not in p and p[0] != p[1]]
    assert got == _components(real_pairs, {n for p in real_pairs for n in p})
    assert graph.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_new_words_are_looked_up_once():
    class Counted(dict):
        asked = 0

        def get(self, key, default=None):
            Counted.asked += 1
            return super().get(key, default)

    e = wavelet.Encoder(P.path("byte_bpe_50k.json"))
    text = "Qwyzzle qwyzzles, qwyzzlet qwyzzled qwyzzled. qwyzzles"
    e.memory._begin(Counted())
    found = e.encode([text])[0]
    assert found.tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids
    # Six pieces are new, and of the two with a mark the stem of one is known by then.
    assert Counted.asked <= 7
    e.memory._begin({})


def test_words_are_looked_up_once_a_block(monkeypatch):
    class Counted(pieces._Now):
        asked = 0

        def __getitem__(self, piece):
            Counted.asked += 1
            return super().__getitem__(piece)

    e = wavelet.Encoder(P.path("byte_bpe_50k.json"))
    e.memory._begin({})
    now = Counted(e.memory.now)
    now.before, now.missing, e.memory.now = {}, [], now
    text = "Qwyzzle qwyzzles, qwyzzles. Qwyzzle\nqwyzzles"
    assert [x.tolist() for x in e.encode([text] * 100)] == [e.tokenizer.encode(text, add_special_tokens=False).ids] * 100
    # Seven distinct pieces, each asked for once and, as it is new, once more for what was learnt.
    assert Counted.asked <= 14
    e.memory._begin({})


def test_blocks_of_texts_equal_the_library(monkeypatch):
    import pyarrow as pa

    e, rng = wavelet.Encoder(P.path("byte_bpe_50k.json")), random.Random(12)
    parts = [*" \n\ta.,é's1!?-Zß×÷\x85\0\x1c²漢<|>", " ", "\n", "  ", "\n\n", " The", "word.", "don't", "École,", "<|endoftext|>"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(24))) if rng.random() < 0.8 else "" for _ in range(3000)]
    plain = [e.tokenizer.encode(x, add_special_tokens=False).ids for x in texts]
    for size in (1, 100, 10**6):
        monkeypatch.setattr(wavelet, "BLOCK_BYTES", size)
        assert [x.tolist() for x in e.encode(texts)] == plain
    assert [x.tolist() for x in e.encode_all(pa.array(texts).slice(1000, 500))] == plain[1000:1500]
    assert e.encode([]) == [] and [x.tolist() for x in e.encode(["", ""])] == [[], []]


def test_pieces_of_many_texts_end_where_matches_end():
    import pyarrow as pa
    import regex

    pattern, rng = regex.compile(P.PATTERN), random.Random(13)
    texts = ["".join(rng.choice(" \n\n  a.,é's1!?-Zß×\0漢") for _ in range(rng.randrange(14))) for _ in range(20_000)]
    found, before = pieces.cut_all(pa.array(texts, pa.large_string()))
    found = found.to_pylist()
    assert "" not in found and before[-1] == len(found)
    for x, a, b in zip(texts, before[:-1], before[1:]):
        assert "".join(found[a:b]) == x and [m for p in found[a:b] for m in pattern.findall(p)] == pattern.findall(x)


def test_other_chains_get_whole_texts(tmp_path):
    from tokenizers import Tokenizer, pre_tokenizers

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=True)
    t.save(str(tmp_path / "other.json"))
    text = "one\ntwo three"
    assert wavelet.Encoder(str(tmp_path / "other.json")).encode([text])[0].tolist() == t.encode(text, add_special_tokens=False).ids


def test_components_of_stars_take_no_round(spark, monkeypatch):
    from curvemill.llm import graph

    names, write = [], graph.written
    monkeypatch.setattr(graph, "written", lambda df, name: names.append(name) or write(df, name))
    stars = [(1, 5), (7, 1), (2, 9), (2, 2), (None, 3)]
    found = {tuple(r) for r in graph.components(spark.createDataFrame(stars, "u long, v long")).collect()}
    assert found == {(1, 1), (5, 1), (7, 1), (2, 2), (9, 2)} and "cc-round" not in names
    path = [(i, i + 1) for i in range(20)]
    found = {tuple(r) for r in graph.components(spark.createDataFrame(path, "u long, v long")).collect()}
    assert found == {(i, 0) for i in range(21)} and "cc-round" in names


def test_links_run_few_jobs(spark):
    """What goes to the driver comes in one job, however many partitions it has."""
    from curvemill.llm import simhash

    fps = spark.range(300).select((F.col("id") * 7919).alias("fp"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", 60)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.sparkContext.setJobGroup("links", "links")
    try:
        simhash.links(fps)
        assert 0 < len(spark.sparkContext.statusTracker().getJobIdsForGroup("links")) < 60
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
        spark.sparkContext._jsc.clearJobGroup()


def test_near_dedup_runs_few_jobs(spark):
    """Fingerprints only give candidates there, for which no components of theirs are needed."""
    texts = [" ".join(f"w{k * 40 + i}" for i in range(40)) + (" z" if again else "") for k in range(30) for again in (0, 1)]
    given = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").localCheckpoint()
    spark.sparkContext.setJobGroup("near", "near")
    try:
        kept = simhash.drop_near_duplicates(given)
        assert 0 < len(spark.sparkContext.statusTracker().getJobIdsForGroup("near")) < 92
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert {r.doc_id for r in kept.collect()} == set(range(0, 60, 2))


def test_scoped_tables_collect_the_drivers_garbage(spark, monkeypatch):
    from curvemill.llm import scratch

    calls = []
    monkeypatch.setattr(scratch, "tidy", calls.append)
    for _ in range(scratch.TIDY_EVERY):
        scratch.written(spark.range(1), "alone")
    assert not calls
    with scratch.scope("collects"):
        for _ in range(2 * scratch.TIDY_EVERY):
            scratch.written(spark.range(1), "scoped")
    assert len(calls) == 2


def test_urls(spark, sf):
    def plain(url):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        fits = [(len(h + p), h + p, v) for h, p, v in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return (host, path, *max(fits)[1:]) if fits else (host, path, None, None)

    pages = {r.page_id: r.url for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in registry.queries()["op7_redirect_equivalence"](spark, sf).collect():
        host, path, rule, verdict = plain(pages[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule) and (verdict is None or r.verdict == verdict)
    data = [
        (1, "http://A.x.com/p#f", '<link rel="canonical" href="http://example.org/es/q">', "h"),
        (2, "https://a.x.com/p", None, "h"),
        (3, "http://b.net/z", '<meta http-equiv="refresh" content="0; url=/w?a=1">', "h"),
        (4, "http://b.net/w?a=1", "<link href='http://foo.org/1' rel=canonical>", None),
        (5, None, "<p>", None),
        (6, "nourl", "x", None),
        (7, "http://x.example.org/es/aa?y", "", None),
        (7, "http://x.example.org/es/aa?y", "", None),
        (8, "http://c.net/1", '<link rel="canonical" href="2">', None),
        (9, "http://c.net/2", '<link rel="canonical" href="http://k.com/de/1">', None),
    ]
    given = spark.createDataFrame(data, "page_id long, url string, html string, host string")
    got = {r.page_id: r for r in url_filter.judge(given, url_filter.rules_frame(spark)).collect()}
    assert {k: r.verdict for k, r in got.items()} == {1: "block", 2: "block", 3: "allow", 4: "allow", 5: "allow", 6: "allow", 7: "block", 8: "block", 9: "block"}
    import duckdb

    con = duckdb.connect()
    con.register("pages", given.toPandas())
    assert rows(url_filter.judge(given, url_filter.rules_frame(spark)).toPandas()) == rows(con.sql(url_filter.OP7_SQL).df())
    assert got[8].rule is None and url_filter.judge(given.limit(0), url_filter.rules_frame(spark)).count() == 0


def test_attribution(spark, docs):
    import base64

    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    codec = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    size = {k: len(t) for t, k in ranks.items()}
    rng = random.Random(7)
    for _ in range(300):
        text = "".join(rng.choice("ab \n漢é🙂.the") for _ in range(rng.randrange(1, 50)))
        cuts = sorted(rng.sample(range(1, len(text)), min(len(text) - 1, 3)))
        spans = list(zip([0, *cuts], [*cuts, len(text)]))
        ids = codec.encode_ordinary(text)
        starts, ends = attribution.token_spans(text, np.array([size[i] for i in ids]))
        firsts, at, want = [len(text[:i].encode()) for i in range(len(text))], 0, [0] * len(spans)
        for i in ids:
            chars = [k for k, f in enumerate(firsts) if at <= f < at + size[i]]
            at += size[i]
            if chars:
                held = [sum(a <= c < b for c in chars) for a, b in spans]
                want[held.index(max(held))] += 1
            else:
                done = sum(f < at for f in firsts)
                want[next((k for k, (a, b) in enumerate(spans) if done < b), len(spans) - 1)] += 1
        assert attribution.attribute(starts, ends, spans, "most").tolist() == want
        for rule in attribution.RULES:
            assert abs(attribution.attribute(starts, ends, spans, rule).sum() - len(ids)) < 1e-9
    got = attribution.attributed(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).groupBy("doc_id").agg(F.sum("n_tokens").alias("n")).collect()
    whole = {r.doc_id: len(codec.encode_ordinary(f"{r.source or ''}\n\n{r.text or ''}")) for r in docs.collect()}
    assert all(r.n in (whole[r.doc_id], 2 * whole[r.doc_id]) for r in got)
    assert attribution.attributed(docs.limit(0), P.path("byte_bpe_50k.tiktoken"), P.PATTERN).count() == 0


def test_wavelet_structure(monkeypatch):
    monkeypatch.setattr(wavelet, "BLOCK_BITS", 1 << 7)
    tokens = np.random.default_rng(0).integers(0, 300, 1000).astype(np.uint16)
    f = wavelet.WaveletFile(wavelet.build(tokens, [1, None], np.array([400, 600]), 16))
    assert [f.access(i) for i in range(1000)] == tokens.tolist() and np.array_equal(f.tokens(), tokens) and f.doc_ids == [1, None]
    for v in range(0, 310, 5):
        assert [f.select(v, k) for k in range(f.count(v))] == np.flatnonzero(tokens == v).tolist() and f.select(v, 1000) == -1
        assert [f.rank(v, u) for u in (0, 1, 500, 1000)] == [int((tokens[:u] == v).sum()) for u in (0, 1, 500, 1000)]
    assert f.document(1).tolist() == tokens[400:].tolist()


def test_wavelet_files_hold_the_tokens(spark, sf, real):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    got = {r.doc_id: r for r in registry.queries()["op9_wavelet_shards"](spark, sf).collect()}
    start = 0
    for k in sorted(real):
        ids = np.array([*t.encode(real[k], add_special_tokens=False).ids, 2], "<u4")
        assert (got[k].start, got[k].n_tokens, got[k].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    e, rng = wavelet.Encoder(P.path("byte_bpe_50k.json")), random.Random(8)
    parts = [*" \n\ta.,é's1!?-Zß\x85\0\x1c²漢<|>", "the", " The", "word.", "endoftext", "<|endoftext|>"]
    for _ in range(4000):
        x = "".join(rng.choice(parts) for _ in range(rng.randrange(24)))
        assert e.encode([x])[0].tolist() == t.encode(x, add_special_tokens=False).ids


def test_wavelet_on_odd_rows(spark, docs, tmp_path):
    folder = f"file://{tmp_path}/shards"
    (tmp_path / "shards").mkdir()
    assert wavelet.write_shards(docs, folder, P.path("byte_bpe_50k.json")).agg(F.sum("n_docs")).first()[0] == docs.count()
    back = wavelet.read_shards(spark, folder)
    assert back.count() == docs.count() and back.where("doc_id = 2").first().n_tokens == 1
    assert wavelet.write_shards(docs.limit(0), folder, P.path("byte_bpe_50k.json")).count() == 0
    for kind, ids in {"binary": [b"\xff\x00", b"a"], "decimal(5,2)": [Decimal("1.50"), Decimal("-2.25")], "date": [date(2024, 1, 2), None], "smallint": [3, 1]}.items():
        (tmp_path / kind).mkdir()
        given = spark.createDataFrame([(i, "a b") for i in ids], f"doc_id {kind}, text string")
        wavelet.write_shards(given, f"file://{tmp_path}/{kind}", P.path("byte_bpe_50k.json")).count()
        assert {r.doc_id for r in wavelet.read_shards(spark, f"file://{tmp_path}/{kind}", kind).collect()} == set(ids)


def test_pieces_end_where_matches_end():
    import regex

    pattern, rng = regex.compile(P.PATTERN), random.Random(10)
    assert pieces.PATTERN == P.PATTERN
    for _ in range(20_000):
        x = "".join(rng.choice(" \n\n  a.,é's1!?-Zß\0漢\t") for _ in range(rng.randrange(14)))
        cut = pieces.cut(x)
        assert ("\t" in x) == (cut is None) and (cut is None or [m for p in cut for m in pattern.findall(p)] == pattern.findall(x))


def test_bpe_long_words(spark):
    import base64

    import tiktoken

    path, rng = P.path("byte_bpe_multi_50k.tiktoken"), random.Random(11)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    codec = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    tokens = [t.decode() for t in ranks if t.isascii() and t.decode().isalpha()]
    texts = ["".join(rng.choice(a) for _ in range(rng.randrange(60, 900))) for a in ("ab", "acgt", "etaoinshr", "é漢ठtheß", tokens) for _ in range(8)]
    texts += ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(60_000)), "!" * 60_000, "0" * 777, "abcdefg" * 500, "xyzzy" * 999]
    engine = bpe.Engine(path, P.PATTERN)
    ids = engine.encode(texts)
    assert ids.to_pylist() == [codec.encode_ordinary(x) for x in texts] and engine.decode(ids) == [x.encode() for x in texts]
    # Windows with nothing in common: the whole word is contracted.
    engine._join = lambda windows, step: windows[0] if len(windows) == 1 else None
    assert [np.frombuffer(x, np.int32).tolist() for x in engine._words(["ab" * 80])] == [codec.encode_ordinary("ab" * 80)]


def test_bpe_equals_the_library(spark, docs):
    import base64

    import tiktoken

    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    codec = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(9)
    texts = ["".join(rng.choice(" \n\ta.,é's1!?-Zß\x85 \x1c²漢ठiaabnthe") for _ in range(rng.randrange(40))) for _ in range(400)] + ["a" * 3000, "banana" * 50, "", "!" * 99]
    engine = bpe.Engine(path, P.PATTERN)
    ids = engine.encode(texts)
    assert ids.to_pylist() == [codec.encode_ordinary(x) for x in texts] and engine.decode(ids) == [x.encode() for x in texts]
    got = bpe.decode(bpe.encode(docs, path, P.PATTERN, ids="score"), path, P.PATTERN, ids="score", decoded="source").collect()
    assert all((r.source or b"").decode() == (r.text or "") and r.score == codec.encode_ordinary(r.text or "") for r in got)
    for r in bpe.round_trip(docs).where("doc_id is not null").collect():
        text = docs.where(F.col("doc_id") == r.doc_id).first().text or ""
        ids = codec.encode_ordinary(text)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    assert bpe.round_trip(docs.limit(0)).count() == 0


def test_pipeline(spark, sf, docs):
    import corpus_pipeline as C

    assert [n for n, _ in C.STAGES] == ["quality_rules", "line_dedup", "simhash_near_dedup", "source_mix", "byte_bpe"]
    found = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in C.STAGES[:-1]:
        after = stage(spark, found, sf)
        assert after.columns == found.columns
        found = after
    assert C.STAGES[-1][1](spark, found.limit(0), sf).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_pipeline_against_plain_code(spark, sf):
    """Every stage of run() by a plain version, each on what the plain one before it kept."""
    import base64

    import corpus_pipeline as C
    import tiktoken

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {r.doc_id for r in quality.quality_rules(docs, spark.read.parquet(f"{sf}/labels.parquet")).where("kept").collect()}
    texts = {r.doc_id: (r.text, r.source) for r in docs.collect() if r.doc_id in kept}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) <= 1
        a, b = (a, b) if len(a) > len(b) else (b, a)
        return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))

    seen, by_ends, lined = set(), {}, {}
    for d in sorted(texts):
        if texts[d][0] is None:
            lined[d] = None
            continue
        out = []
        for line in texts[d][0].split("\n"):
            w = tuple(WORDS.findall(line))
            if not w:
                out.append(line)
                continue
            keys = [(k, w[:h] if k == 0 else w[len(w) - h :]) for h in {len(w) // 2, (len(w) - 1) // 2} for k in (0, 1)] if len(w) >= lines.LEAST_WORDS else []
            if w not in seen and not any(near(w, o) for k in keys for o in by_ends.get(k, ())):
                out.append(line)
            if w not in seen:
                for k in keys:
                    by_ends.setdefault(k, []).append(w)
            seen.add(w)
        if WORDS.search("\n".join(out)):
            lined[d] = "\n".join(out)
    sets = {d: frozenset(simhash.shingle_hashes(t, 5).tolist()) for d, t in lined.items()}
    ids = sorted(sets)
    similar = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if (not sets[a] and not sets[b]) or len(sets[a] & sets[b]) * 5 >= 4 * len(sets[a] | sets[b])]
    component = _components(similar, ids)
    alone = [d for d in ids if component[d] == d]
    given = spark.createDataFrame([(d, lined[d]) for d in alone], docs.select("doc_id", "text").schema).select("doc_id", "text", mixing._shuffle_key(42).alias("r")).collect()
    copies = _plain_mix([(r.doc_id, texts[r.doc_id][1], len(WORDS.findall(r.text or "")), r.r, r.doc_id) for r in given])
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    codec = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for d in alone:
        tokens = codec.encode_ordinary(lined[d] or "")
        row = (d, len(tokens), hashlib.sha256(",".join(map(str, tokens)).encode()).hexdigest(), hashlib.sha256((lined[d] or "").encode()).hexdigest())
        want += [row] * copies[d]
    assert sorted(tuple(r) for r in C.run(spark, sf).collect()) == sorted(want)

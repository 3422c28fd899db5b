"""Order min-hash, importance resampling and whitening against brute force, and on odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rasterspark.llm import ordermin, queries, resample, whitening

from .conftest import BASE


def text_rows(spark, *rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


# --- order min-hash -----------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("k", [1, 3, 8, 11])
def test_elements_are_numbered_kmers(k):
    rng = random.Random(1)
    texts = ["", "a", "abab", "a" * 50, "abc" * 40, *["".join(rng.choice("abç\U0001f600 ") for _ in range(n)) for n in (5, 30, 3000)]]
    hashed = {}
    for t in texts:
        kk, seen, want = min(k, len(t)), Counter(), []
        for i in range(len(t) - kk + 1 if t else 0):
            m = t[i : i + kk]
            want.append((m, seen[m]))
            seen[m] += 1
        got = ordermin.elements(t, k).tolist()
        assert len(got) == len(want) == len(set(got))
        for key, h in zip(want, got):  # one hash an element, in whatever text and place it stands
            assert hashed.setdefault(key, h) == h
    assert len(set(hashed.values())) == len(hashed)


@pytest.mark.parametrize("width", [1, 2, 3])
def test_signature_against_sorting(width, monkeypatch):
    items = ordermin.elements(" ".join(str(i * i % 997) for i in range(900)))
    flip, mult = ordermin._orders(16, 5)
    short = (items >> np.uint64(32)).astype(np.uint32)
    want = []
    for f, m in zip(flip, mult):
        value = (short ^ f) * m
        chosen = items[np.sort(np.argsort(value, kind="stable")[:width])]
        h = np.full(1, np.uint64(len(chosen)))
        for x in chosen:
            h = ordermin.mix64(h * ordermin._TUPLE + x)
        want.append(int((h[0] >> np.uint64(40)) % np.uint64(65535)) + 1)
    for block in (64, 1 << 20):
        monkeypatch.setattr(ordermin, "_BLOCK", block)
        assert ordermin.signature(items, 16, width, 5).tolist() == want


def test_likeness_falls_with_edit_distance():
    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyz "
    text = "".join(rng.choice(letters) for _ in range(4000))

    def edited(n):
        t = list(text)
        for i in rng.sample(range(len(t)), n):
            t[i] = rng.choice(letters)
        return "".join(t)

    fp = ordermin.fingerprint(text, slots=256)
    near = [ordermin.likeness(fp, ordermin.fingerprint(edited(n), slots=256)) for n in (0, 10, 40, 160, 640)]
    assert near[0] == 1 and all(a > b for a, b in zip(near, near[1:])) and near[-1] < 0.1
    # the same content in another order: shared k-mers, far in edit distance
    pieces = [text[i : i + 40] for i in range(0, 4000, 40)]
    rng.shuffle(pieces)
    plain = ordermin.likeness(ordermin.fingerprint(text, slots=256, width=1), ordermin.fingerprint("".join(pieces), slots=256, width=1))
    ordered = ordermin.likeness(fp, ordermin.fingerprint("".join(pieces), slots=256))
    assert plain > 0.6 and ordered < plain * plain * 0.75  # about half of the pairs keep their order


def brute_edited(rows):
    """Over (doc_id, text) rows of different ids: the contract, row by row."""
    rows = sorted(rows, key=lambda r: -r[0])
    out = []
    for i, (doc_id, text) in enumerate(rows):
        text, follower = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + follower[:half]
        fp, e, n = (ordermin.fingerprint(t) for t in (text, edited, follower))
        show = lambda x: x.astype(">u2").tobytes().hex()
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), show(fp), show(e), ordermin.likeness(fp, e), ordermin.likeness(fp, n)))
    return sorted(out)


def test_op11_against_brute_force(spark, docs):
    got = sorted(map(tuple, queries.op11_order_minhash(spark, BASE).collect()))
    assert got == brute_edited([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    alike = [(g[5], g[6]) for g in got if g[1] > 200]
    assert sum(a > b for a, b in alike) > 0.9 * len(alike)


def test_op11_small_tables(spark):
    for rows in ([], [(5, "one two three")], [(1, None), (2, "abc"), (3, "")], [(i, "x" * i) for i in range(1, 40)]):
        assert sorted(map(tuple, ordermin.compare_edited(text_rows(spark, *rows)).collect())) == brute_edited(rows)


def test_op11_odd_rows(spark, odd):
    got = ordermin.compare_edited(odd).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.n_chars) for r in got if r.doc_id) == sorted((r.doc_id is None, r.doc_id, len(r.text or "")) for r in odd.collect() if r.doc_id)
    assert sum(r.doc_id is None for r in got) == 2 and all(0 <= r.near_edited <= 1 for r in got)
    assert {r.fingerprint for r in got if r.n_chars == 0} == {"0" * 256}
    plain = {(r.doc_id, r.fingerprint) for r in ordermin.fingerprints(odd).collect()}
    assert plain == {(r.doc_id, r.fingerprint) for r in got}
    hot = text_rows(spark, *[(7, "same text here")] * 300, (1, "other"))
    rows = ordermin.compare_edited(hot.repartition(5)).collect()
    assert len(rows) == 301 and sum(r.near_next == 1 for r in rows) == 299


# --- resampling ---------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("reach", [1, 7, 64])
def test_crc_of_spans(reach):
    rng = np.random.default_rng(reach)
    data = rng.integers(0, 256, 6000, dtype=np.uint8)
    start = rng.integers(0, 4000, 400)
    end = start + np.concatenate([np.arange(200), rng.integers(0, 2000, 200)])
    assert resample.crc32(data, start, end, reach).tolist() == [zlib.crc32(data[a:b].tobytes()) for a, b in zip(start, end)]
    assert resample.crc32(data, [], []).tolist() == []


WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def split(text):
    return WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_features(text, most, buckets):
    w = split(text)
    return [zlib.crc32(" ".join(w[i : i + k]).encode()) % buckets for k in range(1, most + 1) for i in range(len(w) - k + 1)]


@pytest.mark.parametrize("most", [1, 2, 3])
def test_features(most):
    texts = [None, "", "Ab", "a b", "É x-y Ünï 123 " * 3, "end", "start again", "w" * 500 + " " + "v" * 64, "...", "a\x00b\x7fc"]
    for arr in (pa.array(texts), pa.array(["cut", *texts, "cut"])[1:-1]):
        bucket, row, n_words = resample.features(arr, most, 997)
        got = [sorted(bucket[row == i].tolist()) for i in range(len(texts))]
        assert got == [sorted(brute_features(t, most, 997)) for t in texts] and n_words.tolist() == [len(split(t)) for t in texts]


def brute_draw(docs, target, buckets=10_000, least=20, percent=10, seed=2024):
    s, t = Counter(), Counter()
    for rows, c in ((docs, s), ([(0, x) for x in target], t)):
        for _, text in rows:
            c.update(brute_features(text, 1, buckets))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets)))) for b in range(buckets)]
    out = []
    for doc_id, text in docs:
        f = brute_features(text, 1, buckets)
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append([doc_id, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    may = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for i, r in enumerate(may[: percent * len(may) // 100]):
        r[4] = i + 1
    return out


def keyed(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((v is None, v or 0) for v in r))


def test_op12_against_brute_force(spark, docs, benchmark):
    got = keyed(queries.op12_resampling(spark, BASE).collect())
    want = brute_draw([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], [r.text for r in benchmark.select("text").collect()])
    assert got == keyed(want) and sum(r[4] is not None for r in got) > 10


def test_op12_odd_rows(spark, odd, benchmark):
    target = [r.text for r in benchmark.select("text").limit(20).collect()]
    few = spark.createDataFrame([(t,) for t in target], "text string")
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    for percent in (10, 50, 100):
        got = resample.draw(odd, few, percent=percent).select("doc_id", "n_features", "weight", "score", "rank")
        assert keyed(got.collect()) == keyed(brute_draw(rows, target, percent=percent))
    assert resample.draw(odd.limit(0), few).collect() == []
    assert all(r.rank is None for r in resample.draw(odd.where("text is null or text = ''"), few).collect())
    assert len(resample.draw(odd, few.limit(0)).collect()) == len(rows)


def test_places_over_many_partitions(spark):
    rows = spark.range(5000).select((F.col("id") % 3).alias("k"), F.xxhash64("id").alias("h"), "id").repartition(13)
    got = resample.ranked(rows, [F.desc("k"), F.asc("h"), F.asc("id")]).collect()
    want = sorted(((r.k, r.h, r.id) for r in got), key=lambda r: (-r[0], r[1], r[2]))
    assert [(r.k, r.h, r.id) for r in sorted(got, key=lambda r: r.place)] == want and sorted(r.place for r in got) == list(range(1, 5001))


# --- whitening ----------------------------------------------------------------------------------------------------------


def matrix(values, seed=0):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    a = (q * np.array(values, float)) @ q.T
    return (a + a.T) / 2


@pytest.mark.parametrize("values", [[3.0], [1.0, 1.0, 1.0], np.logspace(0, -9, 50), np.repeat([5.0, 3.0, 3.0, 1.0], 8), np.linspace(1, 2, 64), [4.0, 1e-3, 0.0, 0.0], 1 + np.arange(20) * 1e-9])
def test_spectrum_against_lapack(values):
    a = matrix(values)
    got, vectors = whitening.spectrum(a, 32)
    want, k = np.sort(values)[::-1][:32], min(32, len(values))
    assert len(got) == k and np.allclose(got, want, rtol=1e-9, atol=1e-14 * want[0])
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-13
    assert np.abs(a @ vectors - vectors * got).max() < 1e-13 * want[0] * len(values)


def test_polar_factor_is_the_sign():
    values = np.concatenate([np.logspace(0, -12, 12), -np.logspace(-1, -10, 9)])
    a = matrix(values, 4)
    u = whitening.polar(a, 0.5e-12)
    w, v = np.linalg.eigh(a)
    assert np.abs(u @ u - np.eye(21)).max() < 1e-13 and np.abs(u - (v * np.sign(w)) @ v.T).max() < 1e-4 and round(np.trace(u)) == 3


def check_whitening(rows, vectors, most=32):
    """Rows of the result against numpy over the same whole numbers."""
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors], object)
    n, s = len(x), x.sum(0)
    centred = ((n * x - s) / n).astype(float)
    cov = centred.T @ centred / n
    values, directions = np.linalg.eigh(cov)
    values, directions = values[::-1][:most], directions[:, ::-1][:, :most]
    k = int((values > 1e-12 * values[0]).sum())
    assert len(rows) == n * k and {r.component for r in rows} == set(range(1, k + 1))
    want = Counter(((n * x - s) ** 2).sum(1).tolist())
    assert Counter(int(r.deviation) for r in rows if r.component == 1) == want
    for r in rows:
        assert r.n == n and abs(r.explained / (values[r.component - 1] / np.trace(cov)) - 1) < 1e-9 and r.identity_error < 1e-7
    return centred, values, directions


def test_op13_against_numpy(spark):
    rows = queries.op13_whitening(spark, BASE).collect()
    kept = {r.vec_id: r.embedding for r in spark.read.parquet(f"{BASE}/embeddings.parquet").collect() if r.embedding is not None and all(c is not None and math.isfinite(c) for c in r.embedding)}
    ids = sorted(kept)
    centred, values, directions = check_whitening(rows, [kept[i] for i in ids])
    got = np.zeros((len(ids), len(values)))
    at = {v: i for i, v in enumerate(ids)}
    for r in rows:
        got[at[r.vec_id], r.component - 1] = r.whitened
    want = centred @ directions / np.sqrt(values)
    want *= np.sign((want * got).sum(0))  # either sign, the same for all rows
    assert np.abs(got - want).max() < 1e-6


def test_op13_odd_rows(spark):
    rng = np.random.default_rng(2)
    good = [[float(v) for v in rng.standard_normal(3)] for _ in range(40)]
    rows = [(i, v, 1) for i, v in enumerate(good)] + [(0, good[0], 1), (None, good[1], None), (50, None, 1), (51, [1.0, None, 2.0], 1), (52, [float("nan"), 0.0, 0.0], 1), (53, [float("inf"), 0.0, 0.0], 1), (54, [1.0], 1), (55, [], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, n int").withColumn("component", F.lit("x"))
    check_whitening(whitening.whiten(df.repartition(7)).collect(), [np.float32(v) for v in [*good, good[0], good[1]]])
    assert whitening.whiten(df.limit(0)).collect() == [] and whitening.whiten(df.where("embedding is null")).collect() == []
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], "vec_id long, embedding array<float>")
    assert whitening.whiten(same).collect() == []
    flat = spark.createDataFrame([(i, [float(i), 2.0, float(-i)]) for i in range(9)], "vec_id long, embedding array<double>")
    assert {r.component for r in whitening.whiten(flat).collect()} == {1}


def test_op13_large_entries(spark):
    rng = np.random.default_rng(5)
    far = [[float(v) for v in rng.standard_normal(3) * 1e9] for _ in range(60)]
    rows = whitening.whiten(spark.createDataFrame(list(enumerate(far)), "vec_id long, embedding array<double>")).collect()
    check_whitening(rows, far)
    assert whitening.whiten(spark.createDataFrame([(1, [1e30, 0.0]), (2, [0.0, 1.0]), (3, [-1e30, 5.0])], "vec_id long, embedding array<double>")).count() in (3, 6)

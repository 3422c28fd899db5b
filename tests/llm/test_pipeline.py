"""The rows that each stage of the pipeline gives, against brute force."""

import collections
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from rasterspark.llm import decontaminate, mixing, simhash, tokens

from .conftest import BASE
from .test_operators import WORD, slow_counts

STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def rows(docs):
    return docs.collect()


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_quality_rules(spark, docs, rows):
    out = STAGES["quality_rules"](spark, docs, BASE)
    assert out.columns == docs.columns
    # two hundred documents certify no level, so the base rules rule
    assert ids(out) == sorted(r.doc_id for r in rows if not slow_counts(r.text)[5])


def slow_sets(text):
    w = [x.lower() for x in WORD.findall(text or "")]
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def test_near_duplicates(spark, docs, rows):
    sets, root = {r.doc_id: slow_sets(r.text) for r in rows}, {r.doc_id: r.doc_id for r in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    order = sorted(sets)
    for n, i in enumerate(order):
        for j in order[:n]:
            both = len(sets[i] & sets[j])
            if sets[i] == sets[j] or both and both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    out = STAGES["near_duplicates"](spark, docs, BASE)
    assert out.columns == docs.columns and ids(out) == sorted({find(i) for i in order}) and len({find(i) for i in order}) < len(order)


def test_near_duplicates_by_fingerprint(spark):
    """Near copies that op1's fingerprints link and shared shingles do not, alone and as a bridge between groups of the other kind."""
    share = lambda x, y: len(slow_sets(x) & slow_sets(y)) / len(slow_sets(x) | slow_sets(y))
    found = []
    for seed in range(5000):
        rng = np.random.default_rng(seed)
        words = [f"w{i}" for i in rng.integers(0, 5000, 300)]
        edited = list(words)
        for at in np.arange(10, 300, 22) + int(rng.integers(0, 10)):
            edited[at % 300] = f"n{at}"
        a, b = " ".join(words), " ".join(edited)
        if share(a, b) < 0.8 and (simhash.fingerprint(a) ^ simhash.fingerprint(b)).bit_count() <= simhash.BITS:
            found.append((a, b))
        if len(found) == 2:
            break
    (a, b), (c, d) = found
    copy = " ".join(d.split()[:-1] + ["end"])  # shares most shingles with d
    assert share(copy, d) >= 0.8 > share(copy, c)
    df = spark.createDataFrame([(1, a), (2, b), (3, copy), (4, c), (5, d), (6, "another text of its own")], "doc_id long, text string")
    assert ids(STAGES["near_duplicates"](spark, df, "")) == [1, 3, 6]


def test_decontamination(spark, docs, rows, benchmark):
    norm = lambda t: " ".join(WORD.findall(t or ""))
    items = [norm(r.text) for r in benchmark.collect()]
    planted = {r.doc_id for r in rows if any(i in norm(r.text) for i in items)}
    gone = {r.doc_id for r in decontaminate.contamination(docs, benchmark).collect() if r.contaminated}
    kept = set(ids(STAGES["decontamination"](spark, docs, BASE)))
    assert planted and planted <= gone and kept == {r.doc_id for r in rows} - gone


def test_decontamination_by_row(spark, tmp_path):
    item = "What mass of 5 kg does the strong Bob carry to the river when 5 kg are lost"
    spark.createDataFrame([(9, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    table = [(1, item, 0, "a"), (1, "clean words", 0, "b"), (None, item, 0, "c"), (None, "clean", 0, "d"), (2, item, 0, "e"), (2, item, 0, "e"), (3, None, 0, "f")]
    df = spark.createDataFrame(table, "doc_id long, text string, _id int, k0 string")
    assert sorted(r.k0 for r in STAGES["decontamination"](spark, df, str(tmp_path)).collect()) == ["b", "d", "f"]


def test_source_mixing(spark, docs, rows):
    size = {r.doc_id: len(WORD.findall(r.text or "")) for r in rows}
    source = {r.doc_id: r.source for r in rows}
    per = collections.Counter()
    for i, n in size.items():
        per[source[i]] += n
    out = STAGES["source_mixing"](spark, docs, BASE)
    took = collections.Counter(r.doc_id for r in out.collect())
    assert out.columns == docs.columns and max(took.values()) <= 2 and all(size[i] for i in took)
    for s, want in mixing.targets(per).items():
        assert abs(sum(n * size[i] for i, n in took.items() if source[i] == s) - want) <= max(size[i] for i in size if source[i] == s)


def test_token_files(spark, docs, rows):
    from tokenizers import Tokenizer

    tk, at = Tokenizer.from_file(tokens.default_vocabulary()), 0
    got = {r.doc_id: tuple(r)[1:] for r in STAGES["token_files"](spark, docs, BASE).collect()}
    for r in sorted(rows, key=lambda r: r.doc_id):
        seq = tk.encode(r.text or "", add_special_tokens=False).ids + [tokens.END]
        assert got[r.doc_id] == (at, len(seq), zlib.crc32(np.array(seq, "<u4").tobytes()))
        at += len(seq)


def test_stages_follow_each_other(spark):
    """run() is the stages in turn."""
    d = spark.read.parquet(f"{BASE}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        d = spark.createDataFrame(stage(spark, d, BASE).collect(), None if name == "token_files" else d.schema)
    want = sorted(tuple(r) for r in d.collect())
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, BASE).collect()) == want


def test_names_are_the_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "decontamination", "source_mixing", "token_files"]
    assert all(re.search("null|Null", f.__doc__) for _, f in corpus_pipeline.STAGES)

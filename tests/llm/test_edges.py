"""Nulls, empty tables, repeated rows, very long texts and clashing columns, for every operator and stage."""

import hashlib

import pytest

import corpus_pipeline
from rasterspark.llm import decontaminate, mixing, quality_model, rules, secrets, simhash, substrings, tokens, urlfilter, warc


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, stratum int")


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, h long, at int")


RUNS = {
    "simhash": lambda s, d: simhash.near_duplicates(d),
    "mixing": lambda s, d: mixing.mix(d),
    "decontaminate": lambda s, d: decontaminate.contamination(d, items_of(s, [(1, None, 1, 1), (2, "", 1, 1), (None, "a b c d e f g h i j", 1, 1)])),
    "substrings": lambda s, d: substrings.cut_repeats(d),
    "classifier": lambda s, d: quality_model.score(d, labels_of(s, [(1, 1, 0, 0), (2, 0, 0, 0), (None, None, None, None), (8, 1, 0, 0)])),
    "secrets": lambda s, d: secrets.scan(d),
    "tokens": lambda s, d: tokens.read(tokens.write(d)),
    "rules": lambda s, d: rules.assess(d, labels_of(s, [(1, 1, 0, 0), (None, 1, None, None)])),
}


@pytest.mark.parametrize("name", RUNS)
def test_odd_rows(spark, odd, name):
    rows = RUNS[name](spark, odd).collect()
    assert len(rows) == odd.count()
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in rows) == sorted((r.doc_id is not None, r.doc_id or 0) for r in odd.collect())


@pytest.mark.parametrize("name", RUNS)
def test_empty_table(spark, odd, name):
    assert RUNS[name](spark, odd.limit(0)).collect() == []


def test_defined_results(spark, odd):
    cut = [r for r in substrings.cut_repeats(odd).collect()]
    assert sorted(r.n_removed for r in cut if r.doc_id == 1) == [0, 0]
    assert [r.n_removed for r in cut if r.doc_id in (2, 8)] == [80, 80]
    assert all(r.n_removed == 0 for r in cut if r.doc_id is None)
    none = hashlib.sha256(b"").hexdigest()
    assert all(r.kept_sha256 == none for r in cut if r.doc_id in (3, 4, 5))
    groups = {r.doc_id: r.component_id for r in simhash.near_duplicates(odd).collect() if r.doc_id is not None}
    assert groups[3] == groups[4] == groups[5] == 3 and groups[8] == 1
    assert [r.doc_id for r in simhash.keep_one(odd).collect() if r.doc_id == 1] == [1]


def test_keep_one_by_row(spark):
    texts = [" ".join(f"{w}{i}" for i in range(60)) for w in "abcdef"]
    rows = [(None, texts[0]), (None, texts[1]), (1, texts[2]), (1, texts[3]), (2, texts[4]), (2, texts[4]), (3, texts[4]), (1, texts[5]), (0, texts[5])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted((r.text[0], r.doc_id) for r in simhash.keep_one(df).collect())
    assert kept == [("a", None), ("b", None), ("c", 1), ("d", 1), ("e", 2), ("f", 0)]


def test_pages(spark):
    schema = "page_id long, url string, html string, sha string, first long, canon string, h long, nr long"
    rows = [(1, "http://A.com/x", "p"), (1, "http://A.com/x", "p"), (None, None, "p"), (2, "no scheme", None), (3, "http://spam.org:80/index.html?utm_source=a#f", ""), (4, "x://", "é" * 100_000)]
    df = spark.createDataFrame([(*r, None, None, None, None, None) for r in rows], schema)
    out = urlfilter.judge(df).collect()
    assert len(out) == 6 and {(r.host, r.path) for r in out if r.page_id in (None, 2)} == {("", "")}
    assert [r.verdict for r in out if r.page_id == 3] == ["block"]
    back = warc.read(warc.normalise(warc.write(df))).collect()
    assert sorted(r.record_type for r in back) == ["response"] * 4 + ["revisit"] * 2
    assert urlfilter.judge(df.limit(0)).collect() == [] and warc.read(warc.normalise(warc.write(df.limit(0)))).collect() == []


def test_pipeline_stages(spark, odd, tmp_path):
    sf = str(tmp_path)
    labels_of(spark, [(1, 1, 0, 0)]).write.parquet(f"{sf}/labels.parquet")
    items_of(spark, [(1, "word1 word2 word3 word4 word5 word6 word7 word8 word9", 1, 1)]).write.parquet(f"{sf}/benchmark.parquet")
    for table in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, table, sf)
            if name != "token_files":
                assert out.columns == odd.columns
            assert out.count() >= 0


def test_pipeline(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert rows and sum(r.n_tokens for r in rows) == max(r.start + r.n_tokens for r in rows)

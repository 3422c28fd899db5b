import pytest

BASE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{BASE}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{BASE}/labels.parquet")


@pytest.fixture(scope="session")
def pages(spark):
    return spark.read.parquet(f"{BASE}/pages.parquet")


@pytest.fixture(scope="session")
def benchmark(spark):
    return spark.read.parquet(f"{BASE}/benchmark.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and blank texts, a very long one, ties, repeated rows, extra columns of clashing names."""
    passage = " ".join(f"word{i}" for i in range(80))
    rows = [
        (1, passage, "a", 1), (1, passage, "a", 1), (2, passage + " tail", None, 2), (3, None, "a", None), (4, "", "b", 4), (5, " \t\n ", "b", 5),
        (6, "x " * 200_000, "c", 6), (None, passage, "a", 7), (None, None, None, None), (7, "Ünïcödé ſecret token = \"ABCDEFGHIJ123456\" ça\u2003va", "c", 7), (8, passage, "c", 8),
    ]
    schema = "doc_id long, text string, source string, fp long, nr long, size long, key string, bin int, pattern string, h long, held_out boolean, x double, part int, _row string"
    return spark.createDataFrame([(*r, None, None, None, None, None, None, None, None, None, None) for r in rows], schema)

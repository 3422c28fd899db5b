"""Every query of the core against DuckDB on the smallest tables."""

import datetime
import decimal
import math

import duckdb
import pytest

from rasterspark.plans import audit, runs, sinks, tile
from rasterspark.sources.fixtures import BASE_DIR

CORE = tile.QUERIES | audit.QUERIES | runs.QUERIES | sinks.QUERIES
SF = f"{BASE_DIR}/sf0.001"


def canon(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)):
        return "nan" if math.isnan(v) else repr(round(float(v), 5) + 0.0)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events".split():
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", CORE)
def test_query(spark, duck, name):
    query, sql = CORE[name]
    df = query(spark, SF)
    rows, cols = df.collect(), sorted(df.columns)
    if sql is None:
        assert rows
        return
    cur = duck.execute(sql)
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    want = sorted(tuple(canon(r[names.index(c)]) for c in cols) for r in cur.fetchall())
    assert sorted(tuple(canon(r[c]) for c in cols) for r in rows) == want

"""Tables derived from the given ones by SQL that Spark and DuckDB both run (FIXTURES.md)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BASE_DIR = "/root/testdata"

_BIAS = "case (year(s) * 12 + month(s)) % 11 when 0 then 9000 when 1 then 1200 when 2 then -900 else 0 end"
_SEASON = "case when month(s) in (6, 7, 8) then 3000 when month(s) in (12, 1, 2) then 0 else 1500 end"

TABLES = {
    "obs": f"""select case when o1 % 2 = 0 then 'N05E000' else 'N10E000' end as tile, s as scene_ts, y, x, o1 * 8 + nr as "rank", case when nr = 7 then 0 else 38000 + price % 6000 + 40 * y + {_SEASON} + {_BIAS} end as lwir11,
        case q % 10 when 0 then 8 when 1 then 2 when 2 then 16 else 64 end as qa_pixel, o1, nr, o3, o4, o5, o6
        from (select date_trunc('month', l_shipdate) as s, l_partkey % 24 as y, l_suppkey % 24 as x, l_linenumber as nr,
        cast(round(l_extendedprice * 100) as bigint) as price, cast(floor(l_quantity) as int) as q,
        l_orderkey as o1, l_partkey as o3, l_suppkey as o4, l_extendedprice as o5, l_quantity as o6 from {{lineitem}}) raw""",
    "scenes": """select o_orderkey as item_id, o_orderdate as datetime, cast(floor(o_totalprice) as bigint) % 101 as cloud,
        case o_custkey % 3 when 0 then 'landsat-8' when 1 then 'landsat-9' else 'landsat-7' end as platform,
        (o_custkey * 7) % 340 - 170 as west, (o_custkey * 11) % 110 - 55 as south from {orders}""",
    "land": """select case when o = 0 then 'N05E000' else 'N10E000' end as tile, y, x
        from (select distinct l_partkey % 24 as y
        from {lineitem}) a
        join (select distinct l_orderkey % 24 as x
        from {lineitem}) b on true
        join (select distinct l_orderkey % 2 as o
        from {lineitem}) c on true
        where (y * 7 + x * 3 + o) % 5 <> 0""",
    "cells": "select cast(floor(k / 5) as int) as \"row\", k % 5 as col, k * 7 % 6 - 1 as numobs from (select distinct p_partkey % 25 as k from {part}) t",
    "classes": "select p_partkey % 1152 as pixel, max(p_size % 4) as class from {part} group by p_partkey % 1152",
    "prices": "select s_suppkey % 3 as region, s_nationkey as type, max(abs(s_acctbal) / 10000) as hourly from {supplier} group by s_suppkey % 3, s_nationkey",
    "beats": """select user_id as tile, ts as updated_at, case event_type when 'error' then 'failed' when 'signup' then 'done' when 'purchase' then 'skipped' else event_type end as phase, value as rss, event_id % 3 as attempt, event_id, cast(floor(event_id / 700) as bigint) as seq, event_id * 3 % 2900 as done, 3000 as total
        from {events}""",
    "tasks": """select event_id as task, ts as started, value as seconds, case event_id % 11 when 0 then 'open_qa' when 1 then 'keixel' when 2 then 'where-x' when 3 then 'sub' when 4 then 'getitem_sum-a' when 5 then 'Rechunk-merge' when 6 then 'shuffle_p2p' when 7 then 'transpose' when 8 then 'getitem' when 9 then 'store-map' else 'finalize' end as prefix, user_id as worker
        from {events}""",
    "places": """select s_suppkey as id, s_name as name, s_suppkey % 12 * 5 * (case when s_suppkey % 2 = 0 then 1 else -1 end) as lat, cast(floor(s_suppkey / 12) as bigint) % 36 * 5 * (case when s_suppkey % 3 = 0 then 1 else -1 end) as lon
        from {supplier}""",
}
_BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived table, or a given one."""
    if name in _BASE:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    text = TABLES[name].replace('"row"', "row").replace('"rank"', "rank")
    df = spark.sql(text.format(**{t: f"parquet.`{sf_dir}/{t}.parquet`" for t in _BASE}))
    return df.withColumns({c: F.col(c).cast("timestamp") for c, kind in df.dtypes if kind == "timestamp_ntz"})


def with_tables(names: str, query: str) -> str:
    """``query`` for DuckDB with the derived tables named in ``names`` ahead of it."""
    ctes = [f"{n} as ({TABLES[n].format(**{t: t for t in _BASE})})" for n in names.split()]
    query = query.strip()
    if ctes and query.startswith("with recursive "):
        return f"with recursive {', '.join(ctes)}, {query[15:]}"
    if re.match(r"with\s", query, re.IGNORECASE) and ctes:
        return f"with {', '.join(ctes)}, {query[4:]}"
    return f"with {', '.join(ctes)} {query}" if ctes else query

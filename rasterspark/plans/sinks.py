"""Queries that write, look up, merge and align tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import catalog as k
from ..operators import composite as c
from ..operators import normalize as n
from ..operators import runs as r
from ..operators import sweeps as s
from ..sources.fixtures import load, with_tables
from ..sources.storage import shared_dir
from .runs import _TILE, _items
from .tile import _COMP, _OFF, _R6, P, _comp, _round, _table

_SCENES = "sc as (select distinct tile, scene_ts from tab)"


def composite_sink(spark: SparkSession, sf: str) -> DataFrame:
    """A10: written twice, read back."""
    path, comp = shared_dir(spark, "composite"), _comp(spark, sf).withColumn("lst", F.round("lst", 6))
    for _ in range(2):
        c.write_composite(comp, path, "1995-2001")
    return spark.read.parquet(path).select("window", "tile", "y", "x", "n", "lst_dn")


def offset_store(spark: SparkSession, sf: str) -> DataFrame:
    """Stored under two digests, the one looked up."""
    path, table = shared_dir(spark, "offset-store"), _table(spark, sf)
    n.store_offsets(table, path, "1995-2001", "k1")
    n.store_offsets(table.limit(1), path, "1995-2001", "k2")
    scenes = table.select("tile", "scene_ts")
    if n.lookup_offsets(scenes, path, "1995-2001", "k2") is not None:
        raise ValueError("another digest's table was taken")
    return _round(n.lookup_offsets(scenes, path, "1995-2001", "k1").select("tile", "scene_ts", "n_valid", "offset4", "offset_c", "keep"), "offset_c")


def item_sink(spark: SparkSession, sf: str) -> DataFrame:
    """A12."""
    path = shared_dir(spark, "items")
    k.write_items(_items(spark, sf), path)
    return spark.read.parquet(path).select("id", "tile", "start", "end")


def summary_files(spark: SparkSession, sf: str) -> DataFrame:
    """A summary as CSV and as JSON, both read back."""
    out = r.attempts(load(spark, sf, "beats"))
    schema, rows = ", ".join(f"{f} long" for f in out.columns), None
    for kind in ("csv", "json"):
        path = shared_dir(spark, kind)
        s.write_table(out, path, kind)
        back = (spark.read.schema(schema).option("header", True).csv(path) if kind == "csv" else spark.read.schema(schema).json(path)).withColumn("kind", F.lit(kind))
        rows = back if rows is None else rows.unionByName(back)
    return rows


def merged_partials(spark: SparkSession, sf: str) -> DataFrame:
    """Four partial tables by month, merged."""
    table = _table(spark, sf)
    parts = [table.where(F.month("scene_ts") % 4 == i) for i in range(4)]
    return n.merge_partials(parts, table.select("tile", "scene_ts")).select("tile", "scene_ts", "n_valid", "keep")


def matched_times(spark: SparkSession, sf: str) -> DataFrame:
    """A table stored to whole seconds against a run whose times have fractions."""
    table = _table(spark, sf).select("tile", "scene_ts", "offset4")
    run = table.select("tile", (F.col("scene_ts") + F.expr("interval 250 milliseconds")).alias("scene_ts"))
    return n.match_times(table, run)


def aligned_cover(spark: SparkSession, sf: str) -> DataFrame:
    """Cover of the solar-day scenes over a tile, on the axis of the first item of each of its days."""
    items = load(spark, sf, "scenes")
    axis = items.groupBy(F.to_date(F.col("datetime") + F.expr("interval 10 hours"))).agg(F.min("datetime").alias("scene_ts"))
    return _round(s.align_cover(s.scene_cover(items, 150.0), axis.select("scene_ts")), "cover")


def coarse_offsets(spark: SparkSession, sf: str) -> DataFrame:
    """D5, D12 on the coarse grid, with its own floor."""
    return _round(s.coarse_table(load(spark, sf, "obs"), P), "offset_c").select("tile", "scene_ts", "n_valid", "offset_c", "keep")


def merged_bands(spark: SparkSession, sf: str) -> DataFrame:
    """Three row bands of the composites, merged."""
    comp = _comp(spark, sf).select("tile", "y", "x", "n")
    return c.merge_bands([comp.where("y < 9"), comp.where("y between 9 and 15"), comp.where("y > 15")], 24)


def _listing(spark: SparkSession, sf: str) -> DataFrame:
    """Keys of run artifacts of all shapes, with and without attempts, and others."""
    o = F.col("o_orderkey")
    tile = F.format_string("N%02dW%03d", o % 12 * 5, F.col("o_custkey") % 36 * 5)
    tried = F.when(o % 4 == 0, "").otherwise(F.format_string(".%d", o % 11))
    shapes = ((0, ".json"), (1, ".log"), (2, ".offsets.profile.json"), (3, ".merge.profile.json"), (4, ".json"))
    name = F.lit("readme.txt")
    for k, suffix in shapes:
        name = F.when(o % 7 == k, F.concat(tile, tried, F.lit(suffix))).otherwise(name)
    return load(spark, sf, "orders").select(F.concat(F.lit("runs/a/"), F.when(o % 7 == 5, F.concat(tile, F.lit(".progress.json"))).otherwise(name)).alias("key"))


_LISTING = """k as (select o_orderkey as o, 'N' || lpad(cast(o_orderkey % 12 * 5 as varchar), 2, '0') || 'W' || lpad(cast(o_custkey % 36 * 5 as varchar), 3, '0') as tile, case when o_orderkey % 4 = 0 then 0 else o_orderkey % 11 end as attempt, case when o_orderkey % 4 = 0 then '' else '.' || o_orderkey % 11 end as tried, o_orderkey % 7 as s
        from orders),
        e as (select tile, case when s = 5 then 0 else attempt end as attempt, case when s in (0, 4) then 'state' when s = 1 then 'log' when s in (2, 3) then 'profile' else 'progress' end as kind, case s when 2 then 'offsets' when 3 then 'merge' end as label, 'runs/a/' || tile || case when s = 5 then '.progress.json' else tried || case s when 1 then '.log' when 2 then '.offsets.profile.json' when 3 then '.merge.profile.json' else '.json' end end as key
        from k
        where s < 6)"""


def artifact_keys(spark: SparkSession, sf: str) -> DataFrame:
    """What keys say."""
    key = _listing(spark, sf)
    return key.select(*[v.alias(name) for name, v in zip(("tile", "attempt", "kind", "label"), r.key_parts(F.col("key")))]).groupBy("tile", "attempt", "kind", "label").agg(F.count("*").alias("n"))


def tile_artifacts(spark: SparkSession, sf: str) -> DataFrame:
    """A row per tile."""
    pairs = lambda m: F.concat_ws(" ", F.array_sort(F.transform(F.map_entries(m), lambda e: F.concat_ws("=", e["key"].cast("string"), e["value"]))))
    return r.artifacts(_listing(spark, sf)).select("tile", pairs("states").alias("states"), pairs("logs").alias("logs"), F.coalesce(pairs("profile_keys"), F.lit("")).alias("profile_keys"), "legacy_progress", "attempt", "state_key", "log_key", "body_key", "settled", F.concat_ws(" ", F.col("attempts").cast("array<string>")).alias("attempts"), "highest_attempt")


_COARSE = """cs as (select tile, scene_ts, cast(floor(y / 2) as bigint) as y, cast(floor(x / 2) as bigint) as x, round(avg(nullif(lwir11, 0))) as dn, min(case when y % 2 = 1 and x % 2 = 1 then qa_pixel end) as qa from obs group by 1, 2, 3, 4),
 cd as (select *, month(scene_ts) as month from cs where dn between {low} and {high} and (qa & 62) = 0), cc as (select tile, y, x, month, median(dn) as ref from cd group by tile, y, x, month),
 co as (select cd.tile, scene_ts, count(*) as n_valid, median(dn - ref) * 0.00341802e0 as o from cd join cc on cd.tile = cc.tile and cd.y = cc.y and cd.x = cc.x and cd.month = cc.month group by cd.tile, scene_ts)"""


def _coarse_sql() -> str:
    from ..params import DN_HIGH, DN_LOW

    return f"""with {_COARSE.format(low=DN_LOW, high=DN_HIGH)} select tile, scene_ts, n_valid, round(o, 4) as offset_c, n_valid >= 4 and abs(o) <= 15 as keep
        from co"""


QUERIES = {
    "composite_sink": (composite_sink, with_tables("obs", f"with {_COMP} select '1995-2001' as \"window\", tile, y, x, n, {_R6} as lst_dn from comp")),
    "offset_store": (offset_store, with_tables("obs", f"with {_OFF} select tile, scene_ts, n_valid, offset4, round(offset_c, 4) as offset_c, keep from tab")),
    "item_sink": (item_sink, with_tables("places", f"with {_TILE} select tile || '_2021-2025' as id, tile, 2021 as start, 2025 as \"end\" from tl")),
    "summary_files": (summary_files, with_tables("beats", """with p as (select tile, count(distinct attempt) as n
        from beats
        group by tile) select kind, count(*) as tiles, cast(sum(n) as bigint) as attempts, max(n) as most, count(*) filter (n > 1) as retried
        from p, (values ('csv'), ('json')) k(kind)
        group by kind""")),
    "merged_partials": (merged_partials, with_tables("obs", f"with {_OFF} select tile, scene_ts, n_valid, keep from tab")),
    "matched_times": (matched_times, with_tables("obs", f"with {_OFF} select tile, scene_ts + interval 250 milliseconds as scene_ts, offset4 from tab")),
    "aligned_cover": (aligned_cover, with_tables("scenes", "select min(datetime) as scene_ts, round(avg(cloud), 4) as cover from scenes group by cast(datetime + interval 10 hours as date)")),
    "coarse_offsets": (coarse_offsets, with_tables("obs", _coarse_sql())),
    "merged_bands": (merged_bands, with_tables("obs", f"with {_COMP} select tile, y, x, n from comp")),
    "artifact_keys": (artifact_keys, f"""with {_LISTING} select tile, attempt, kind, label, count(*) as n
        from e
        group by all
        union all select null, null, null, null, count(*)
        from k
        where s = 6
        having count(*) > 0"""),
    "tile_artifacts": (tile_artifacts, f"""with {_LISTING}, u as (select distinct * from e),
        t as (select tile, coalesce(string_agg(attempt || '=' || key, ' ' order by attempt || '=' || key) filter (kind = 'state'), '') as states, coalesce(string_agg(attempt || '=' || key, ' ' order by attempt || '=' || key) filter (kind = 'log'), '') as logs, max(key) filter (kind = 'progress') as legacy_progress,
        coalesce(max(attempt) filter (kind = 'state'), 0) as attempt, count(*) filter (kind = 'state' and attempt = 0) > 0 as settled, coalesce(string_agg(cast(attempt as varchar), ' ' order by attempt) filter (kind = 'state' and attempt > 0), '') as attempts, coalesce(max(attempt) filter (kind <> 'progress'), 0) as highest_attempt
        from u
        group by tile),
        of as (select t.tile, kind, label, u.attempt, key
        from t
        join u on u.tile = t.tile and (u.attempt = t.attempt or u.attempt = 0)),
        best as (select *
        from of
        qualify attempt = max(attempt) over (partition by tile, kind)),
        pick as (select tile, max(key) filter (kind = 'state') as state_key, max(key) filter (kind = 'log') as log_key, coalesce(string_agg(label || '=' || key, ' ' order by label || '=' || key) filter (kind = 'profile'), '') as profile_keys
        from best
        group by tile) select t.tile, states, logs, coalesce(profile_keys, '') as profile_keys, legacy_progress, attempt, state_key, log_key, coalesce(legacy_progress, state_key) as body_key, settled, attempts, highest_attempt
        from t
        left
        join pick on pick.tile = t.tile"""),
}

"""Queries of the tile pipeline: from observations to composites, their sweeps and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import grid as g
from ..functions import quality as q
from ..operators import composite as c
from ..operators import normalize as n
from ..operators import series
from ..operators import sweeps as s
from ..operators import tile as t
from ..params import CLEAR_BITS, DN_HIGH, DN_LOW, Params
from ..sources.fixtures import load, with_tables
from ..sources.storage import bucketed, shared_dir, written

_C = "* 0.00341802e0 + 149.0e0 - 273.15e0"
_DN = f"""dn as (select tile, scene_ts, y, x, lwir11 as dn, month(scene_ts) as month from (select *, row_number() over (partition by tile, scene_ts, y, x order by "rank", lwir11) as rn
  from obs where lwir11 between {DN_LOW} and {DN_HIGH} and (qa_pixel & {CLEAR_BITS}) = 0) t where rn = 1)"""
_OFF = f"""{_DN}, clim as (select tile, y, x, month, cast(2 * median(dn) as bigint) as ref2 from dn group by tile, y, x, month),
 anom as (select dn.tile, scene_ts, dn.y, dn.x, dn, 2 * dn - ref2 as anom2 from dn join clim on dn.tile = clim.tile and dn.y = clim.y and dn.x = clim.x and dn.month = clim.month),
 offs as (select tile, scene_ts, count(*) as n_valid, cast(2 * median(anom2) as bigint) as offset4, median(anom2) / 2 * 0.00341802e0 as offset_c from anom group by tile, scene_ts),
 tab as (select *, n_valid >= 10 and abs(offset_c) <= 15 as keep from offs)"""
_V = f"""{_OFF}, v as (select dn.tile, dn.scene_ts, y, x, 4 * dn - offset4 as v4
        from dn
        join tab on dn.tile = tab.tile and dn.scene_ts = tab.scene_ts
        where keep)"""
_MONTHS = ", ".join(f"count(*) filter (month(scene_ts) = {m}) as m{m}" for m in c.MONTHS)
_COMP = f"""{_V}, comp0 as (select tile, y, x, quantile_cont(v4, 0.95) / 4 {_C} as p, count(*) as n, {_MONTHS}
        from v
        group by tile, y, x),
        comp as (select * exclude (p), case when p < -49.98 then null else p end as lst
        from comp0)"""
_PACK = f"""{_COMP}, pack as (select *, case when lst is null then 0 when (lst + 50) / 0.01e0 >= 1 and floor((lst + 50) / 0.01e0) <= 65535 then cast(floor((lst + 50) / 0.01e0) as int) else 0 end as lst_dn
        from comp)"""
_R6 = """case when lst is null then 0 when (round(lst, 6) + 50) / 0.01e0 >= 1 and floor((round(lst, 6) + 50) / 0.01e0) <= 65535 then cast(floor((round(lst, 6) + 50) / 0.01e0) as int) else 0 end"""
_LEVELS = f"""lv as (select tile, f as factor, cast(floor(y / f) as bigint) as y, cast(floor(x / f) as bigint) as x, coalesce(avg(nullif({_R6}, 0)), 0) as lst_dn, {', '.join(f'avg(m{m}) as m{m}' for m in c.MONTHS)}
        from comp, (values (2), (4), (8), (16)) k(f)
        group by 1, 2, 3, 4)"""
P = Params(floor=10, coarse_floor=4)  # a scene of the fixtures has some hundreds of pixels


def _dn(spark: SparkSession, sf: str) -> DataFrame:
    return n.stack(load(spark, sf, "obs"))


def _stack(spark: SparkSession, sf: str) -> DataFrame:
    """The stack in buckets by pixel and month."""
    return n.stack_by_pixel(_dn(spark, sf))


def _table(spark: SparkSession, sf: str) -> DataFrame:
    return t.tile_offsets(_stack(spark, sf), P)


def _values(spark: SparkSession, sf: str) -> DataFrame:
    dn = _stack(spark, sf)
    return n.debias(dn, t.tile_offsets(dn, P))


def _lenient(spark: SparkSession, sf: str, dn: DataFrame, table: DataFrame) -> DataFrame:
    return n.debias(dn, n.lenient_offsets(table, 150))


def destripe_comparison(spark: SparkSession, sf: str) -> DataFrame:
    """The composite against that of the lenient variant; stack and offsets are computed once."""
    dn = _stack(spark, sf)
    table = t.tile_offsets(dn, P)
    a, b = c.composite(n.debias(dn, table)), c.composite(_lenient(spark, sf, dn, table))
    return _round(s.compare_composites(a, b), "mean_delta", "median_abs", "p99_abs", "max_abs", "share_over", "corr", "coverage_delta_mean")


def lenient_ablation(spark: SparkSession, sf: str) -> DataFrame:
    """D24."""
    dn = _stack(spark, sf)
    return _round(c.percentiles(_lenient(spark, sf, dn, t.tile_offsets(dn, P)), (0.95,)), "p95")


def annual_ablation(spark: SparkSession, sf: str) -> DataFrame:
    """D23; the observations are read once: stack, in buckets by pixel, and offsets are written."""
    dn = bucketed(_dn(spark, sf), "stack", n.PIXEL)
    return _round(c.percentiles(n.debias(dn, written(n.annual_offsets(dn, 150), "offsets")), (0.95,)), "p95")


def month_cover(items: DataFrame) -> DataFrame:
    """Cover on the fixtures' scenes, which are months."""
    return items.groupBy(F.date_trunc("month", "datetime").alias("scene_ts")).agg(F.avg("cloud").alias("cover"))


def class_counts(spark: SparkSession, sf: str) -> DataFrame:
    """All scenes count, those without a valid pixel included."""
    return _round(c.class_counts(_dn(spark, sf), _classes(spark, sf), load(spark, sf, "obs").select("tile", "scene_ts")), "mean_pixels")


LEVELS = (2, 4, 8, 16)


def pyramid_levels(spark: SparkSession, sf: str) -> DataFrame:
    """D43."""
    return _round(c.pyramid(packed(spark, sf), LEVELS), "lst_dn", *c.COUNTS)


def pyramid_report(spark: SparkSession, sf: str) -> DataFrame:
    """D44, of a pyramid whose level 8 has lost its first month and whose level 16 is not there for half of the tiles."""
    native = written(packed(spark, sf), "native")
    levels = c.pyramid(native, LEVELS).withColumn("m1", F.when(F.col("factor") == 8, 0.0).otherwise(F.col("m1")))
    return _round(c.pyramid_report(native, levels.where("factor <> 16 or tile <> 'N05E000'"), LEVELS), "native", "mean", "nonzero")


def count_band_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Of the counts, which have no nodata, and of the values, which have."""
    return _round(c.band_table(packed(spark, sf), {"lst_dn": 0} | dict.fromkeys(c.COUNTS)), "mean", "stddev", "valid_percent")


def pruned_scan(spark: SparkSession, sf: str) -> DataFrame:
    """From a table of a folder per tile and year the observations of the first window's jobs of one tile."""
    path = shared_dir(spark, "observations")
    t.store_observations(load(spark, sf, "obs"), path)
    some = jobs(spark, sf).where("window = '1995-1998' and tile = 'N10E000'")
    return t.of_jobs(spark.read.parquet(path), some).groupBy("tile", "scene_ts").agg(F.count("*").alias("n"), F.sum("lwir11").alias("total"))


def _comp(spark: SparkSession, sf: str) -> DataFrame:
    """The composite by pixel series: one shuffle of the observations."""
    rows = series.series(load(spark, sf, "obs"))
    return series.composite(rows, series.offsets(rows, P))


def _packed(spark: SparkSession, sf: str) -> DataFrame:
    return _comp(spark, sf).withColumn("lst_dn", q.encode(F.col("lst")))


def _classes(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "classes").select(F.when(F.col("pixel") < 576, "N05E000").otherwise("N10E000").alias("tile"), F.floor(F.col("pixel") % 576 / 24).cast("long").alias("y"), (F.col("pixel") % 24).alias("x"), "class")


_CLS = """cls as (select case when pixel < 576 then 'N05E000' else 'N10E000' end as tile, cast(floor(pixel % 576 / 24) as bigint) as y, pixel % 24 as x, class
        from classes)"""


def _round(df: DataFrame, *cols: str, digits: int = 4) -> DataFrame:
    return df.withColumns({k: F.round(k, digits) for k in cols})


HOT = 35.0  # the fixtures are cooler than 70 C


def jobs(spark: SparkSession, sf: str) -> DataFrame:
    """A5: four-year windows of the tiles that have observations."""
    return g.jobs(load(spark, sf, "obs").select(F.col("tile").alias("name")).distinct(), 1995, 2001, 4).withColumnRenamed("name", "tile")


def tile_composite(spark: SparkSession, sf: str) -> DataFrame:
    """D11, the flagship: A6, B1-B6, C3, E1, D1, C1, D2-D4, C2, D6, D7-D10, C4, B8, B10, B11, over all tiles and windows at once."""
    gaps = load(spark, sf, "cells").where("numobs = 0")
    return _round(t.process(load(spark, sf, "obs"), jobs(spark, sf), load(spark, sf, "land"), gaps, P, cell=5, hot=HOT), "lst")


_WINDOW = "case when year(scene_ts) <= 1998 then '1995-1998' else '1999-2001' end"
_JOBS = f"""jobbed as (select * replace (tile || '/' || {_WINDOW} as tile) from obs), ground as (select tile || '/' || w as tile, y, x from land, (values ('1995-1998'), ('1999-2001')) k(w))"""
_FULL = _COMP.replace("from obs where", "from jobbed where").replace("t where rn = 1)", "t semi join ground on t.tile = ground.tile and t.y = ground.y and t.x = ground.x where rn = 1)", 1)
_D11 = f"""with {_JOBS}, {_FULL}, sc as (select tile, count(*) as scene_count from tab group by tile), m as (select ground.tile, ground.y, ground.x, coalesce(n, 0) as n, {', '.join(f'coalesce(m{m}, 0) as m{m}' for m in c.MONTHS)}, coalesce(scene_count, 0) as scene_count,
  case when lst >= {HOT} and (cast(floor(ground.y / 5) as bigint), cast(floor(ground.x / 5) as bigint)) in (select ("row", col) from cells where numobs = 0) then null else lst end as lst from ground left join comp on ground.tile = comp.tile and ground.y = comp.y and ground.x = comp.x left join sc on sc.tile = ground.tile)
 select split_part(tile, '/', 1) as tile, split_part(tile, '/', 2) as "window", y, x, round(lst, 4) as lst, n, {', '.join(f'm{m}' for m in c.MONTHS)}, scene_count"""


def packed(spark: SparkSession, sf: str) -> DataFrame:
    """B8 on D10: a tile's composite without masks."""
    return _round(_packed(spark, sf).withColumn("lst_dn", q.encode(F.round("lst", 6))), "lst")




def pixel_scalars(spark: SparkSession, sf: str) -> DataFrame:
    """B1, B3, B4, B9, B15, B16."""
    o = load(spark, sf, "obs")
    dn, m = F.col("lwir11"), F.month("scene_ts")
    cel = q.celsius(dn)
    return o.select("o1", "nr", "o3", "o4", "o5", "o6", q.clear(F.col("qa_pixel")).alias("clear"), F.round(cel, 4).alias("c"), q.plausible(dn).alias("plausible"), F.round(q.decode(dn), 4).alias("decoded"), q.pixel_state(cel, 40.0).alias("state"), q.season(m).alias("season"), q.summer(m).alias("summer"))


def scene_search(spark: SparkSession, sf: str) -> DataFrame:
    """A1, A2."""
    return n.resolve(n.search(boxes(spark, sf), -60, -30, 20, 25, "1996-01-01", "1998-12-31")).select("item_id", "platform", "cloud")


def scene_search_over(spark: SparkSession, sf: str) -> DataFrame:
    """A1 with a box over the antimeridian."""
    return n.search(boxes(spark, sf), 165, -30, -172, 25, "1996-01-01", "1998-12-31").select("item_id", "west", "east")


def boxes(spark: SparkSession, sf: str) -> DataFrame:
    """Scenes with their own boxes, of several sizes; some run over the antimeridian."""
    east = F.col("west") + 8 + F.col("item_id") % 7
    return load(spark, sf, "scenes").withColumns({"east": F.when(east > 180, east - 360).otherwise(east), "north": F.col("south") + 5 + F.col("item_id") % 3})


def scene_sample(spark: SparkSession, sf: str) -> DataFrame:
    """E5, F6."""
    return n.sample_scenes(load(spark, sf, "scenes"), 40).select("item_id", "datetime")


def coarse_scan(spark: SparkSession, sf: str) -> DataFrame:
    """A7."""
    return _round(n.coarsen(load(spark, sf, "obs"), 2), "lwir11")


def input_digest(spark: SparkSession, sf: str) -> DataFrame:
    """B32."""
    return n.digest(n.search(boxes(spark, sf), -60, -30, 20, 25, "1996-01-01", "1996-06-30"), "factor=2")


QUERIES = {
    "tile_composite": (tile_composite, with_tables("obs land cells", f"{_D11}, {_R6} as lst_dn from m")),
    "packed_composite": (packed, with_tables("obs", f"with {_COMP} select tile, y, x, round(lst, 4) as lst, n, {', '.join(f'm{m}' for m in c.MONTHS)}, {_R6} as lst_dn from comp")),
    "pixel_scalars": (pixel_scalars, with_tables("obs", f"""select o1, nr, o3, o4, o5, o6, (qa_pixel & 62) = 0 as clear, round(c, 4) as c, lwir11 between {DN_LOW} and {DN_HIGH} as plausible, round(case when lwir11 <> 0 then lwir11 * 0.01e0 - 50 end, 4) as decoded, case when c is null then 'missing' when c >= 40 then 'hot' else 'cool' end as state, case when m in (12, 1, 2) then 'DJF' when m in (3, 4, 5) then 'MAM' when m in (6, 7, 8) then 'JJA' else 'SON' end as season, m in (12, 1, 2) as summer
        from (select *, month(scene_ts) as m, case when lwir11 <> 0 then lwir11 {_C} end as c
        from obs) t""")),
    "scene_search": (scene_search, with_tables("scenes", """select item_id, platform, cloud
        from scenes
        where west <= 20 and (west + 8 + item_id % 7 >= -60 or west + 8 + item_id % 7 > 180) and south <= 25 and south + 5 + item_id % 3 >= -30 and cast(datetime as date) between date '1996-01-01' and date '1998-12-31' and cloud < 100 and platform in ('landsat-8', 'landsat-9')""")),
    "scene_search_over": (scene_search_over, with_tables("scenes", """with s as (select *, west + 8 + item_id % 7 as e
        from scenes) select item_id, west, case when e > 180 then e - 360 else e end as east
        from s
        where (e >= 165 or west <= -172) and south <= 25 and south + 5 + item_id % 3 >= -30 and cast(datetime as date) between date '1996-01-01' and date '1998-12-31' and cloud < 100 and platform in ('landsat-8', 'landsat-9')""")),
    "pruned_scan": (pruned_scan, with_tables("obs", """select tile || '/1995-1998' as tile, scene_ts, count(*) as n, cast(sum(lwir11) as bigint) as total
        from obs
        where tile = 'N10E000' and year(scene_ts) <= 1998
        group by tile, scene_ts""")),
    "scene_sample": (scene_sample, with_tables("scenes", """with o as (select item_id, datetime, row_number() over (order by datetime, item_id) - 1 as pos, count(*) over () as total
        from scenes) select item_id, datetime
        from o
        where pos in (select cast(floor(i * total / 40) as bigint)
        from range(40) r(i)) """)),
    "coarse_scan": (coarse_scan, with_tables("obs", """select tile, scene_ts, y, x, round(lwir11, 4) as lwir11, qa_pixel
        from (select tile, scene_ts, cast(floor(y / 2) as bigint) as y, cast(floor(x / 2) as bigint) as x, avg(nullif(lwir11, 0)) as lwir11, min(case when y % 2 = 1 and x % 2 = 1 then qa_pixel end) as qa_pixel
        from obs
        group by tile, scene_ts, cast(floor(y / 2) as bigint), cast(floor(x / 2) as bigint)) t
        where lwir11 is not null and qa_pixel is not null""")),
    "input_digest": (input_digest, with_tables("scenes", """select substr(sha256(string_agg(cast(item_id as varchar), chr(10)
        order by cast(item_id as varchar)) || chr(10) || 'factor=2'), 1, 16) as digest
        from scenes
        where west <= 20 and west + 8 + item_id % 7 >= -60 and south <= 25 and south + 5 + item_id % 3 >= -30 and cast(datetime as date) between date '1996-01-01' and date '1996-06-30' and cloud < 100 and platform in ('landsat-8', 'landsat-9')""")),
    "climatology": (
        lambda spark, sf: n.climatology(_dn(spark, sf)),
        with_tables("obs", f"with {_OFF} select tile, y, x, month, ref2 from clim")),
    "scene_offsets": (
        lambda spark, sf: _round(_table(spark, sf), "offset_c"),
        with_tables("obs", f"with {_OFF} select tile, scene_ts, n_valid, offset4, round(offset_c, 4) as offset_c, keep from tab")),
    "offset_diagnostics": (
        lambda spark, sf: _round(n.diagnostics(_table(spark, sf)), "rejected", "std", "min", "max", "p01", "p50", "p99"),
        with_tables("obs", f"""with {_OFF} select count(*) as n_scenes, count(*) filter (keep) as n_kept, round(avg(case when keep then 0 else 1 end), 4) as rejected, round(stddev_pop(offset_c), 4) as std, round(min(offset_c), 4) as min, round(max(offset_c), 4) as max, round(quantile_cont(offset_c, 0.01), 4) as p01, round(quantile_cont(offset_c, 0.5), 4) as p50, round(quantile_cont(offset_c, 0.99), 4) as p99
        from tab""")),
    "multi_percentiles": (
        lambda spark, sf: _round(c.percentiles(_values(spark, sf)), "p50", "p75", "p90", "p95"),
        with_tables("obs", f"""with {_V} select tile, y, x, {', '.join(f'round(quantile_cont(v4, {p / 100}) / 4 {_C}, 4) as p{p}' for p in (50, 75, 90, 95))}
        from v
        group by tile, y, x""")),
    "coverage_summary": (
        lambda spark, sf: _round(c.coverage(_comp(spark, sf)), "zero_fraction"),
        with_tables("obs", f"""with {_COMP} select min(n) as min_n, median(n) as median_n, max(n) as max_n, round(count(*) filter (n = 0) / count(*), 4) as zero_fraction
        from comp""")),
    "band_stats": (
        lambda spark, sf: _round(c.reader_stats(c.band_stats(packed(spark, sf))), "mean", "min", "max", "stddev", "valid_percent", digits=3),
        with_tables("obs", f"""with {_COMP}, pk as (select nullif({_R6}, 0) as d
        from comp) select round(avg(d) * 0.01e0 - 50, 3) as mean, round(min(d) * 0.01e0 - 50, 3) as min, round(max(d) * 0.01e0 - 50, 3) as max, round(stddev_pop(d) * 0.01e0, 3) as stddev, round(100.0 * count(d) / count(*), 3) as valid_percent
        from pk""")),
    "composite_summary": (
        lambda spark, sf: _round(c.summary(_comp(spark, sf)), "min_c", "max_c", "mean_c"),
        with_tables("obs", f"""with {_COMP} select count(*) as pixels, count(lst) as valid, round(min(lst), 4) as min_c, round(max(lst), 4) as max_c, round(avg(lst), 4) as mean_c, cast(sum(n) as bigint) as observations
        from comp""")),
    "median_plausibility": (
        lambda spark, sf: _round(c.plausibility(_values(spark, sf)), "min", "max", "mean", "std"),
        with_tables("obs", f"""with {_V}, p as (select tile, nullif(quantile_cont(v4, 0.5) / 4 {_C}, 0) as p50
        from v
        group by tile, y, x),
        a as (select tile, count(p50) as k, min(p50) as lo, max(p50) as hi, avg(p50) as mu, stddev_pop(p50) as sd
        from p
        group by tile) select tile, coalesce(sd >= 0.1 and lo >= -20 and hi <= 80 and mu >= 10 and mu <= 50, false) as valid, case when k = 0 then 'no valid pixels' when sd < 0.1 then 'uniform values' end as reason, round(lo, 4) as min, round(hi, 4) as max, round(case when sd >= 0.1 then mu end, 4) as mean, round(sd, 4) as std, case when sd >= 0.1 then lo >= -20 and hi <= 80 end as physically_plausible, case when sd >= 0.1 then mu >= 10 and mu <= 50 end as mean_reasonable
        from a""")),
    "overview_level": (
        lambda spark, sf: _round(c.overview(packed(spark, sf)), "lst_dn", "n"),
        with_tables("obs", f"""with {_COMP} select tile, cast(floor(y / 2) as bigint) as y, cast(floor(x / 2) as bigint) as x, round(coalesce(avg(nullif({_R6}, 0)), 0), 4) as lst_dn, round(avg(n), 4) as n
        from comp
        group by tile, cast(floor(y / 2) as bigint), cast(floor(x / 2) as bigint)""")),
    "pyramid_health": (
        lambda spark, sf: _round(c.pyramid_health(p := packed(spark, sf), c.overview(p)), "native", "level"),
        with_tables("obs", f"""with {_COMP}, lv as (select avg(n) as n
        from comp
        group by tile, floor(y / 2), floor(x / 2)),
        a as (select avg(n) as native
        from comp),
        b as (select avg(n) as level, max(n) as most
        from lv) select round(native, 4) as native, round(level, 4) as level, abs(level - native) <= greatest(1.0, 0.2 * native) and most > 0 as healthy
        from a, b""")),
    "pyramid_levels": (pyramid_levels, with_tables("obs", f"""with {_COMP}, {_LEVELS} select tile, factor, y, x, round(lst_dn, 4) as lst_dn, {', '.join(f'round(m{m}, 4) as m{m}' for m in c.MONTHS)}
        from lv""")),
    "pyramid_report": (pyramid_report, with_tables("obs", f"""with {_COMP}, {_LEVELS}, nat as ({' union all '.join(f"select tile, 'm{m}' as band, avg(m{m}) as native from comp group by tile" for m in c.MONTHS)}),
        seen as ({' union all '.join(f"select tile, factor, 'm{m}' as band, {'case when factor = 8 then 0 else m1 end' if m == 1 else f'm{m}'} as v from lv where not (factor = 16 and tile = 'N05E000')" for m in c.MONTHS)}),
        agg as (select tile, factor, band, avg(v) as mean, avg(case when v <> 0 then 1 else 0 end) as nonzero
        from seen
        group by 1, 2, 3) select nat.tile, nat.band, cast(f as int) as factor, round(native, 4) as native, round(mean, 4) as mean, round(nonzero, 4) as nonzero, case when mean is null then 'missing' when nonzero = 0 then 'collapsed' when abs(mean - native) > greatest(1.0, 0.2 * native) then 'drifted' end as problem
        from nat
        join (values (2), (4), (8), (16)) k(f) on true
        left
        join agg on agg.tile = nat.tile and agg.band = nat.band and agg.factor = f""")),
    "count_band_stats": (count_band_stats, with_tables("obs", f"""with {_COMP}, b as (select tile, 'lst_dn' as band, cast(nullif({_R6}, 0) as double) as v
        from comp
        union all {' union all '.join(f"select tile, 'm{m}', m{m} from comp" for m in c.MONTHS)}) select tile, band, coalesce(min(v), 0) as min, coalesce(max(v), 0) as max, round(coalesce(avg(v), 0), 4) as mean, round(coalesce(stddev_pop(v), 0), 4) as stddev, round(100.0 * count(v) / count(*), 4) as valid_percent
        from b
        group by tile, band""")),
    "preview": (
        lambda spark, sf: _round(c.preview(packed(spark, sf)), "lst"),
        with_tables("obs", f"""with {_COMP} select tile, cast(floor(y / 4) as bigint) as y, cast(floor(x / 4) as bigint) as x, round(nullif({_R6}, 0) * 0.01e0 - 50, 4) as lst
        from comp
        where y % 4 = 2 and x % 4 = 2""")),
    "scene_days": (
        lambda spark, sf: c.scene_days(_dn(spark, sf)),
        with_tables("obs", f"""with {_DN}, d as (select month, count(distinct scene_ts) as days
        from dn
        group by month) select cast(m as int) as month, case when m in (12, 1, 2) then 'DJF' when m in (3, 4, 5) then 'MAM' when m in (6, 7, 8) then 'JJA' else 'SON' end as season, coalesce(days, 0) as days
        from range(1, 13) r(m)
        left
        join d on d.month = m""")),
    "class_counts": (class_counts, with_tables("obs classes", f"""with {_DN}, {_CLS}, every as (select o.tile, scene_ts, class, case when month(scene_ts) in (12, 1, 2) then 'summer' else 'non_summer' end as part
        from (select distinct tile, scene_ts
        from obs) o
        join (select distinct tile, class
        from cls) k on k.tile = o.tile),
        p as (select dn.tile, scene_ts, class, count(*) as k
        from dn
        join cls on dn.tile = cls.tile and dn.y = cls.y and dn.x = cls.x
        group by 1, 2, 3),
        f as (select every.*, coalesce(k, 0) as k
        from every
        left
        join p on p.tile = every.tile and p.scene_ts = every.scene_ts and p.class = every.class) select tile, class, cast(month(scene_ts) as varchar) as period, round(avg(k), 4) as mean_pixels
        from f
        group by 1, 2, 3
        union all select tile, class, part, round(avg(k), 4)
        from f
        group by 1, 2, 3""")),
    "summer_delta": (
        lambda spark, sf: _round(c.summer_delta(_values(spark, sf), _classes(spark, sf)), "annual", "summer", "delta"),
        with_tables("obs classes", f"""with {_V}, {_CLS}, p as (select tile, y, x, quantile_cont(v4, 0.95) / 4 {_C} as a, quantile_cont(v4, 0.95) filter (month(scene_ts) in (12, 1, 2)) / 4 {_C} as s
        from v
        group by tile, y, x) select class, count(*) as pixels, round(median(a), 4) as annual, round(median(s), 4) as summer, round(median(s) - median(a), 4) as delta
        from p
        join cls on p.tile = cls.tile and p.y = cls.y and p.x = cls.x
        group by class""")),
    "window_metrics": (
        lambda spark, sf: _round(c.window_metrics(_comp(spark, sf), load(spark, sf, "land")), "gap_fraction", *[f"zero_m{m}" for m in c.MONTHS]),
        with_tables("obs land", f"""with {_COMP}, j as (select land.y, lst, {', '.join(f'coalesce(m{m}, 0) as m{m}' for m in c.MONTHS)}
        from land
        left
        join comp on land.tile = comp.tile and land.y = comp.y and land.x = comp.x) select count(*) as land, count(*) filter (lst is null) as gaps, round(avg(case when lst is null then 1 else 0 end), 4) as gap_fraction, {', '.join(f'median(m{m}) as median_m{m}, round(100 * avg(case when m{m} = 0 then 1 else 0 end), 4) as zero_m{m}' for m in c.MONTHS)}
        from j""")),
    "striping": (
        lambda spark, sf: _round(c.striping(_comp(spark, sf), load(spark, sf, "land")), "striping", digits=6),
        with_tables("obs land", f"""with {_COMP}, k as (select land.tile, avg(coalesce(n, 0)) as k
        from land
        left
        join comp on land.tile = comp.tile and land.y = comp.y and land.x = comp.x
        group by land.tile, land.x) select tile, round(coalesce(stddev_pop(k) / nullif(avg(k), 0), 0), 6) as striping
        from k
        group by tile""")),
    "cap_sweep": (
        lambda spark, sf: s.cap_sweep(_table(spark, sf), (1.0, 3.0, 5.0, 10.0, 15.0, 30.0), P.floor),
        with_tables("obs", f"""with {_OFF} select cap, count(*) filter (n_valid >= 10 and abs(offset_c) <= cap) as kept, count(*) filter (not (n_valid >= 10 and abs(offset_c) <= cap)) as rejected
        from tab, (values (1.0e0), (3.0e0), (5.0e0), (10.0e0), (15.0e0), (30.0e0)) c(cap)
        group by cap""")),
    "annual_ablation": (
        annual_ablation,
        with_tables("obs", f"""with {_DN}, r as (select tile, y, x, cast(2 * median(dn) as bigint) as ref2
        from dn
        group by tile, y, x),
        o as (select dn.tile, scene_ts, count(*) as n_valid, cast(2 * median(2 * dn - ref2) as bigint) as offset4
        from dn
        join r on dn.tile = r.tile and dn.y = r.y and dn.x = r.x
        group by dn.tile, scene_ts) select dn.tile, y, x, round(quantile_cont(4 * dn - case when n_valid > 150 then offset4 else 0 end, 0.95) / 4 {_C}, 4) as p95
        from dn
        join o on dn.tile = o.tile and dn.scene_ts = o.scene_ts
        group by dn.tile, y, x""")),
    "lenient_ablation": (
        lenient_ablation,
        with_tables("obs", f"""with {_OFF} select dn.tile, y, x, round(quantile_cont(4 * dn - case when n_valid > 150 then offset4 else 0 end, 0.95) / 4 {_C}, 4) as p95
        from dn
        join tab on dn.tile = tab.tile and dn.scene_ts = tab.scene_ts
        group by dn.tile, y, x""")),
    "destripe_comparison": (destripe_comparison, with_tables("obs", f"""with {_V}, a as (select tile, y, x, quantile_cont(v4, 0.95) / 4 {_C} as a, count(*) as na
        from v
        group by tile, y, x),
        b as (select dn.tile, y, x, quantile_cont(4 * dn - case when n_valid > 150 then offset4 else 0 end, 0.95) / 4 {_C} as b, count(*) as nb
        from dn
        join tab on dn.tile = tab.tile and dn.scene_ts = tab.scene_ts
        group by dn.tile, y, x),
        j as (select coalesce(a.tile, b.tile) as tile, a, b, b - a as d, coalesce(nb, 0) - coalesce(na, 0) as dn
        from a
        full
        join b on a.tile = b.tile and a.y = b.y and a.x = b.x) select tile, count(d) as pixels, round(avg(d), 4) as mean_delta, round(median(abs(d)), 4) as median_abs, round(quantile_cont(abs(d), 0.99), 4) as p99_abs, round(max(abs(d)), 4) as max_abs, round(avg(case when abs(d) > 0.1 then 1.0e0 when d is not null then 0 end), 4) as share_over, round(corr(a, b), 4) as corr, round(avg(dn), 4) as coverage_delta_mean
        from j
        group by tile""")),
    "thinned_offsets": (
        lambda spark, sf: _round(s.thinned(written(_dn(spark, sf), "stack"), month_cover(load(spark, sf, "scenes")), (48, 50, 52), P), "rejected_frac", "median_abs_delta", "p99_abs_delta", "max_abs_delta", "decision_flip_frac"),
        with_tables("obs scenes", f"""with {_OFF}, cov as (select date_trunc('month', datetime) as scene_ts, avg(cloud) as cover
        from scenes
        group by 1),
        k as (select dn.*, f
        from dn
        join cov on dn.scene_ts = cov.scene_ts
        join (values (48), (50), (52)) t(f) on cover < f),
        c2 as (select f, tile, y, x, month, cast(2 * median(dn) as bigint) as ref2
        from k
        group by f, tile, y, x, month),
        o2 as (select k.f, k.tile, scene_ts, count(*) as n_valid, median(2 * dn - ref2) / 2 * 0.00341802e0 as o
        from k
        join c2 on k.f = c2.f and k.tile = c2.tile and k.y = c2.y and k.x = c2.x and k.month = c2.month
        group by k.f, k.tile, scene_ts),
        j as (select f, o2.tile, abs(o - offset_c) as d, o2.n_valid >= 10 and abs(o) <= 15 as k2, keep
        from o2
        join tab on o2.tile = tab.tile and o2.scene_ts = tab.scene_ts) select tile, cast(f as int) as threshold, count(*) as scenes, round(avg(case when k2 then 0 else 1 end), 4) as rejected_frac, round(median(d), 4) as median_abs_delta, round(quantile_cont(d, 0.99), 4) as p99_abs_delta, round(max(d), 4) as max_abs_delta, count(*) filter (keep <> k2) as decision_flips, round(count(*) filter (keep <> k2) / count(*), 4) as decision_flip_frac
        from j
        group by tile, f""")),
    "subsampling_verdict": (
        lambda spark, sf: _round(s.compare_offsets(_table(spark, sf), s.coarse_table(load(spark, sf, "obs"), P), P.floor, P.coarse_floor, P.cap), "median_abs", "p99_abs", "max_abs", "bias", "corr", "slope", "flip_margin", "flip_frac"),
        with_tables("obs", f"""with {_OFF}, cs as (select tile, scene_ts, cast(floor(y / 2) as bigint) as y, cast(floor(x / 2) as bigint) as x, round(avg(nullif(lwir11, 0))) as dn, min(case when y % 2 = 1 and x % 2 = 1 then qa_pixel end) as qa from obs group by tile, scene_ts, cast(floor(y / 2) as bigint), cast(floor(x / 2) as bigint)),
 cd as (select *, month(scene_ts) as month from cs where dn between {DN_LOW} and {DN_HIGH} and (qa & 62) = 0), cc as (select tile, y, x, month, median(dn) as ref from cd group by tile, y, x, month),
 co as (select cd.tile, scene_ts, count(*) as nb, median(dn - ref) * 0.00341802e0 as b from cd join cc on cd.tile = cc.tile and cd.y = cc.y and cd.x = cc.x and cd.month = cc.month group by cd.tile, scene_ts),
 j as (select offset_c as a, b, n_valid >= 10 as oa, nb >= 4 as ob, abs(offset_c) <= 15 as ka, abs(b) <= 15 as kb from offs join co on offs.tile = co.tile and offs.scene_ts = co.scene_ts), k as (select *, oa and ob as fit, oa and ob and ka and kb as scored, oa and ob and ka <> kb as flip from j),
 r as (select count(*) filter (scored) as scored, coalesce(median(abs(b - a)) filter (scored), 0) as median_abs, coalesce(quantile_cont(abs(b - a), 0.99) filter (scored), 0) as p99_abs, coalesce(max(abs(b - a)) filter (scored), 0) as max_abs, coalesce(median(b - a) filter (scored), 0) as bias, case when count(*) filter (scored) > 2 then corr(a, b) filter (scored) else 0 end as corr, case when count(*) filter (scored) > 2 then regr_slope(b, a) filter (scored) else 0 end as slope, count(*) filter (fit) as admissible, count(*) filter (flip) as flips, coalesce(max(abs(abs(a) - 15)) filter (flip), 0) as flip_margin, count(*) filter (oa <> ob) as sparse_flips, count(*) filter (flip) / greatest(count(*) filter (fit), 1) as flip_frac from k)
 select scored, round(median_abs, 4) as median_abs, round(p99_abs, 4) as p99_abs, round(max_abs, 4) as max_abs, round(bias, 4) as bias, round(corr, 4) as corr, round(slope, 4) as slope, admissible, flips, round(flip_margin, 4) as flip_margin, sparse_flips, round(flip_frac, 4) as flip_frac, median_abs <= 0.05 and p99_abs <= 0.25 and max_abs <= 0.5 and abs(bias) <= 0.05 and flip_frac <= 0.01 and flip_margin <= 1 as accepted from r""")),
    "cloud_tradeoff": (
        lambda spark, sf: _round(s.cloud_tradeoff(_table(spark, sf), month_cover(load(spark, sf, "scenes")), (48, 50, 52, 60)), "dropped_frac", "already_rejected_frac", "observations_lost_frac"),
        with_tables("obs scenes", f"""with {_OFF}, cov as (select date_trunc('month', datetime) as scene_ts, avg(cloud) as cover
        from scenes
        group by 1),
        j as (select tab.*, cover
        from tab
        join cov on tab.scene_ts = cov.scene_ts),
        a as (select tile, t, count(*) as k, count(*) filter (cover >= t) as d, count(*) filter (cover >= t and not keep) as w, cast(coalesce(sum(n_valid) filter (cover >= t and keep), 0) as bigint) as lost, coalesce(sum(n_valid) filter (keep), 0) as total
        from j, (values (48), (50), (52), (60)) c(t)
        group by tile, t) select tile, cast(t as int) as threshold, d as dropped, round(d / k, 4) as dropped_frac, w as already_rejected, round(w / greatest(d, 1), 4) as already_rejected_frac, lost as observations_lost, round(coalesce(lost / nullif(total, 0), 0), 4) as observations_lost_frac
        from a""")),
    "cloud_correlation": (
        lambda spark, sf: _round(s.cloud_correlation(_table(spark, sf), month_cover(load(spark, sf, "scenes")).withColumn("cover", F.col("cover") * 1.6)), "corr"),
        with_tables("obs scenes", f"""with {_OFF}, cov as (select date_trunc('month', datetime) as scene_ts, avg(cloud) * 1.6e0 as cover
        from scenes
        group by 1),
        j as (select tab.tile, cover, keep, n_valid / max(n_valid) over (partition by tab.tile) as share
        from tab
        join cov on tab.scene_ts = cov.scene_ts) select tile, round(corr(cover, share), 4) as corr, count(*) filter (cover >= 70 and keep and share > 0.5) as cloudy_but_clear_70, count(*) filter (cover >= 90 and keep and share > 0.5) as cloudy_but_clear_90
        from j
        group by tile""")),
    "window_comparison": (
        lambda spark, sf: _round(s.window_comparison(_values(spark, sf), load(spark, sf, "land"), 2001, (1, 3, 5)), "gap_fraction", "striping", *[f"zero_m{m}" for m in c.MONTHS]),
        with_tables("obs land", f"""with {_V}, w as (select k, tile, y, x, count(*) as n, {_MONTHS}
        from v, (values (1), (3), (5)) t(k)
        where year(scene_ts) between 2001 - k + 1 and 2001
        group by k, tile, y, x),
        g as (select k, l.tile, l.y, l.x
        from land l, (values (1), (3), (5)) t(k)),
        j as (select g.k as years, g.tile, g.y, g.x, w.n, {', '.join(f'coalesce(m{m}, 0) as m{m}' for m in c.MONTHS)}
        from g
        left
        join w on g.k = w.k and g.tile = w.tile and g.y = w.y and g.x = w.x),
        sx as (select years, stddev_pop(c) / avg(c) as striping
        from (select years, tile, x, avg(coalesce(n, 0)) as c
        from j
        group by years, tile, x) q
        group by years) select cast(j.years as int) as years, count(*) as land, count(*) filter (n is null) as gaps, round(avg(case when n is null then 1 else 0 end), 4) as gap_fraction, cast(coalesce(sum(n), 0) as bigint) as observations, round(max(striping), 4) as striping, {', '.join(f'median(m{m}) as median_m{m}, round(100 * avg(case when m{m} = 0 then 1 else 0 end), 4) as zero_m{m}' for m in c.MONTHS)}
        from j
        join sx on sx.years = j.years
        group by j.years""")),
}

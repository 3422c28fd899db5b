"""Queries on masks, audits and the grid."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import grid as g
from ..functions import quality as q
from ..operators import audit as a
from ..operators import composite as c
from ..operators import masks as m
from ..operators import normalize as n
from ..sources.fixtures import load, with_tables
from .tile import _COMP, _V, HOT, _comp, _dn, _round, _values

_HOT = HOT
_PIX = f"""{_COMP}, pix as (select comp.*, cast(floor(y / 5) as bigint) as r, cast(floor(x / 5) as bigint) as k, case when lst is null then 'missing' when lst >= {_HOT} then 'hot' else 'cool' end as state
        from comp),
        gaps as (select \"row\" as r, col as k
        from cells
        where numobs = 0)"""


def _pixels(spark: SparkSession, sf: str) -> DataFrame:
    return m.with_cell(_comp(spark, sf), 5).withColumn("state", q.pixel_state(F.col("lst"), _HOT))


def _gaps(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "cells").where("numobs = 0")


def gap_composite(spark: SparkSession, sf: str) -> DataFrame:
    """C3, C4, C5, B11 at a lower threshold: land mask, gap flags grown by one cell, counts kept."""
    comp = m.mask_counts(_comp(spark, sf), load(spark, sf, "land"), ["n"])
    flagged = m.flag_gap(m.with_cell(comp, 5), m.dilate(_gaps(spark, sf), 1))
    return m.mask_gaps(flagged, _HOT).select("tile", "y", "x", "in_gap", "n", F.round("lst", 4).alias("lst"))


def tier_cross_tab(spark: SparkSession, sf: str) -> DataFrame:
    """B13, B15, C4, D26."""
    out = a.cross_tab(_tiered(spark, sf))
    return _round(out, *[k for k, kind in out.dtypes if kind == "double"])


def _tiered(spark: SparkSession, sf: str) -> DataFrame:
    cells = load(spark, sf, "cells").select("row", "col", q.observation_tier(F.col("numobs")).alias("tier"))
    return _pixels(spark, sf).join(cells, ["row", "col"])


def tile_totals(spark: SparkSession, sf: str) -> DataFrame:
    """The tiles' totals."""
    return _round(a.tile_totals(_tiered(spark, sf)), "valid_pct", "missing_pct", "hot_pct_of_valid")


def mask_tradeoffs(spark: SparkSession, sf: str) -> DataFrame:
    """D27."""
    out = a.tradeoffs(_pixels(spark, sf), _gaps(spark, sf), (0, 1))
    return _round(out, *[k for k, kind in out.dtypes if kind == "double"])


def coverage_tiers(spark: SparkSession, sf: str) -> DataFrame:
    """B14."""
    t = q.coverage_tier(F.col("numobs"), F.col("col") == 4)
    return load(spark, sf, "cells").groupBy(t.alias("tier")).agg(F.count("*").alias("n"))


def _classes(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("pixel")
    return load(spark, sf, "classes").select("class", ((k % 24 - 12) * 700000.0).alias("x"), ((F.floor(k % 576 / 24) - 12) * 600000.0).alias("y"))


_MOLL = """moll as (select class, lat, lon from (select class, degrees(asin((2 * th + sin(2 * th)) / pi())) as lat, degrees(pi() * px / (2 * 6378137.0e0 * sqrt(2.0e0) * cos(th))) as lon from
 (select class, px, asin(py / (6378137.0e0 * sqrt(2.0e0))) as th from (select class, (pixel % 24 - 12) * 700000.0e0 as px, (floor(pixel % 576 / 24) - 12) * 600000.0e0 as py from classes) a) b) c where abs(lon) <= 180)"""


def class_areas(spark: SparkSession, sf: str) -> DataFrame:
    """Points of settlement classes against a 30-degree tier grid."""
    lat, lon = a.mollweide(F.col("x"), F.col("y"))
    p = _classes(spark, sf).withColumns({"lat": lat, "lon": lon}).where("lat is not null and lon is not null")
    p = p.withColumns({"row": F.floor((90 - F.col("lat")) / 36).cast("long"), "col": F.floor((F.col("lon") + 180) / 72).cast("long")})
    t = load(spark, sf, "cells").select("row", "col", q.coverage_tier(F.col("numobs"), F.lit(False)).alias("tier"))
    return _round(a.gap_shares(a.tier_area(p.join(t, ["row", "col"]), 0.25), (2, 3)), "land_km2", "gap_km2", "low_confidence_km2", "gap_pct", "low_confidence_pct")


def _edges(spark: SparkSession, sf: str, scale: float = 1.0) -> DataFrame:
    """Diamonds around parts of the grid, one polygon per place."""
    k = F.col("id")
    cx, cy, r = (k * 7 % 20 + 2.25).alias("cx"), (k * 11 % 20 + 2.35).alias("cy"), ((k % 3 + 1.5) * scale).alias("r")
    d = load(spark, sf, "places").select(k.alias("poly_id"), (k % 4).alias("class"), cx, cy, r)
    px, py = lambda dx: F.col("cx") + F.col("r") * dx, lambda dy: F.col("cy") + F.col("r") * dy
    ring = ((1, 0), (0, 1), (-1, 0), (0, -1))
    sides = [F.struct(px(p[0]).alias("x0"), py(p[1]).alias("y0"), px(s[0]).alias("x1"), py(s[1]).alias("y1")) for p, s in zip(ring, ring[1:] + ring[:1])]
    return d.select("poly_id", "class", F.inline(F.array(*sides)))


def _grid(spark: SparkSession, side: int, size: int) -> DataFrame:
    """side x side tiles of the local grid, named by row and column."""
    t = spark.range(side * side).select(F.floor(F.col("id") / side).alias("row"), (F.col("id") % side).alias("col"))
    return t.select(F.concat_ws("_", "row", "col").alias("tile"), "row", "col")


_DIAMOND = """dia as (select id % 4 as class, id * 7 % 20 + 2.25e0 as cx, id * 11 % 20 + 2.35e0 as cy, id % 3 + 1.5e0 as r
        from places),
        pxl as (select y, x
        from range(24) a(y), range(24) b(x))"""


def _holed(spark: SparkSession, sf: str) -> DataFrame:
    """The diamonds with a hole of half their size."""
    return _edges(spark, sf).union(_edges(spark, sf, 0.5))


def _blocks(spark: SparkSession, sf: str) -> DataFrame:
    i = F.col("id") % 25
    return load(spark, sf, "places").select(F.col("id").alias("block"), (i * 12 - 150.0).alias("west"), (i * 3 - 40.0).alias("south"), (i * 12 - 138.0).alias("east"), (i * 3 - 33.0).alias("north"), (F.col("id") % 4 != 0).alias("land"))


def _footprints(spark: SparkSession, sf: str) -> DataFrame:
    """Rotated rectangles with sides along (-1, 2) and (2, 1); a tenth of the scenes has none, another tenth an empty one."""
    point = lambda dx, dy: F.struct((F.col("west") + 0.5 + dx).alias("x"), (F.col("south") + 0.5 + dy).alias("y"))
    ring = F.array(point(0, 0), point(4, 2), point(3, 4), point(-1, 2))
    i = F.col("item_id") % 10
    return load(spark, sf, "scenes").select(F.when(i == 0, None).when(i == 1, F.slice(F.array(ring), 1, 0)).otherwise(F.array(ring)).alias("rings"))


_QUADS = """b as (select id as block, id % 25 * 12 - 150.0e0 as w, id % 25 * 3 - 40.0e0 as s, id % 25 * 12 - 138.0e0 as e, id % 25 * 3 - 33.0e0 as n, id % 4 <> 0 as land
        from places),
        q as (select item_id as id, west + 0.5e0 as x0, south + 0.5e0 as y0, west + 4.5e0 as x1, south + 2.5e0 as y1, west + 3.5e0 as x2, south + 4.5e0 as y2, west - 0.5e0 as x3, south + 2.5e0 as y3
        from scenes
        where item_id % 10 > 1)"""


def _coast(spark: SparkSession, sf: str) -> DataFrame:
    """Islands: diamonds of different reach in longitude and latitude off the north-west corner of the grid."""
    k = F.col("id")
    d = load(spark, sf, "places").where("id <= 12").select(k.alias("poly_id"), (k % 4).alias("class"), (k * 7 % 20 * 0.25 - 179.55).alias("cx"), (59.55 - k * 11 % 20 * 0.25).alias("cy"), (k % 3 * 0.3 + 0.2).alias("rx"), (k % 4 * 0.2 + 0.15).alias("ry"))
    px, py = lambda dx: F.col("cx") + F.col("rx") * dx, lambda dy: F.col("cy") + F.col("ry") * dy
    ring = ((1, 0), (0, 1), (-1, 0), (0, -1))
    sides = [F.struct(px(p[0]).alias("lon0"), py(p[1]).alias("lat0"), px(s[0]).alias("lon1"), py(s[1]).alias("lat1")) for p, s in zip(ring, ring[1:] + ring[:1])]
    return d.select("poly_id", "class", F.inline(F.array(*sides)))


_COAST = """dia as (select id * 7 % 20 * 0.25e0 - 179.55e0 as cx, 59.55e0 - id * 11 % 20 * 0.25e0 as cy, id % 3 * 0.3e0 + 0.2e0 as rx, id % 4 * 0.2e0 + 0.15e0 as ry
        from places
        where id <= 12),
        side as (select cx + rx * ax as lon0, cy + ry * ay as lat0, cx + rx * bx as lon1, cy + ry * by_ as lat1
        from dia, (values (1, 0, 0, 1), (0, 1, -1, 0), (-1, 0, 0, -1), (0, -1, 1, 0)) v(ax, ay, bx, by_))"""


def granule_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Granules that tiles need against those present and listed."""
    tiles = load(spark, sf, "places").select(F.col("name").alias("tile"), (F.col("id") * 130).alias("row0"), (F.col("id") * 90).alias("col0"))
    w = g.granules_of_window(tiles.withColumns({"row1": F.col("row0") + 150, "col1": F.col("col0") + 120}))
    name = F.concat_ws("_", "gr", "gc")
    need = w.select("tile", name.alias("granule"), (F.col("gr") == F.floor(F.col("row0") / 100)).alias("core"))
    have = load(spark, sf, "supplier").select(F.concat_ws("_", F.col("s_suppkey") % 34, F.col("s_suppkey") % 23).alias("granule"))
    listed = load(spark, sf, "customer").select(F.concat_ws("_", F.col("c_custkey") % 30, F.col("c_custkey") % 20).alias("granule")).union(need.where("granule like '%7'").select("granule"))
    domain = need.select("granule").where(F.split("granule", "_")[0].cast("int") % 2 == 0)
    return a.coverage_report(need, have, listed, domain)


def gap_validation(spark: SparkSession, sf: str) -> DataFrame:
    """C20."""
    pixels = _comp(spark, sf)
    predicted = m.flag_gap(m.with_cell(pixels, 5), _gaps(spark, sf)).where("in_gap")
    return _round(a.validate(predicted, pixels.where("n < 30"), load(spark, sf, "land")), "observed_gap_pct", "predicted_gap_pct", "agreement_iou")


_GRAN = """w as (select name as tile, id * 130 as row0, id * 90 as col0 from places), need as (select tile, gr || '_' || (gc % 360) as granule, gr = floor(row0 / 100) as core from (select *, unnest(range(cast(floor(row0 / 100) as bigint), cast(floor((row0 + 149) / 100) as bigint) + 1)) as gr from w) a, lateral (select unnest(range(cast(floor(a.col0 / 100) as bigint), cast(floor((a.col0 + 119) / 100) as bigint) + 1)) as gc) b),
 have as (select distinct (s_suppkey % 34) || '_' || (s_suppkey % 23) as granule from supplier), listed as (select distinct (c_custkey % 30) || '_' || (c_custkey % 20) as granule from customer union select granule from need where granule like '%7'), g as (select granule, bool_or(core) as core from need group by granule), mis as (select * from g where granule not in (select granule from have))"""

def _class_points(spark: SparkSession, sf: str) -> DataFrame:
    lat, lon = a.mollweide(F.col("x"), F.col("y"))
    p = _classes(spark, sf).withColumns({"lat": lat, "lon": lon}).where("lat is not null and lon is not null")
    p = p.withColumns({"row": F.floor((90 - F.col("lat")) / 36).cast("long"), "col": F.floor((F.col("lon") + 180) / 72).cast("long")})
    t = load(spark, sf, "cells").select("row", "col", q.coverage_tier(F.col("numobs"), F.lit(False)).alias("tier"))
    return p.join(t, ["row", "col"])


def _fine_tiers(spark: SparkSession, sf: str) -> DataFrame:
    """A tier for two thirds of the cells that hold a settlement point, twice: the first granule's holds."""
    lat, lon = a.mollweide(F.col("x"), F.col("y"))
    p = _classes(spark, sf).select(F.floor((90 - lat) * 100).cast("long").alias("row"), F.floor((lon + 180) * 100).cast("long").alias("col")).where("row % 3 <> 0").distinct()
    tier = F.when((F.col("row") + F.col("col")) % 5 == 0, "gap").otherwise("normal")
    return p.select("row", "col", F.lit("g1").alias("granule"), tier.alias("tier")).union(p.select("row", "col", F.lit("g2"), F.lit("low")))


def _ring():
    """A footprint as nested metadata; of two points where item_id % 7 is 0, of none where it is 1."""
    point = lambda dy, dx: F.struct((F.col("south") + dy).alias("lat"), (F.col("west") + dx).alias("lon"))
    ring = [point(0.25, 0.5), point(0.25, 1.5), point(1.25, 1.5), point(1.25, 0.5)]
    return F.when(F.col("item_id") % 7 == 0, F.array(*ring[:2])).when(F.col("item_id") % 7 == 1, F.slice(F.array(*ring), 1, 0)).otherwise(F.array(*ring))


def _granule_cells(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "orders").select(F.concat_ws("_", F.col("o_orderkey") % 40, F.col("o_custkey") % 30).alias("granule"), ((F.col("o_orderkey") + 5) % 6).alias("numobs"))


def _absent(spark: SparkSession, sf: str) -> DataFrame:
    """C22, with and without a fetch domain."""
    some = lambda w: load(spark, sf, "supplier").where(w).select(F.col("s_suppkey").cast("string").alias("granule"))
    missing, listed, domain = some("s_suppkey % 2 = 0"), some("s_suppkey % 3 <> 0"), some("s_suppkey % 5 <> 0")
    return a.classify_absent(missing, listed, domain).join(a.classify_absent(missing, listed).withColumnRenamed("label", "without_domain"), "granule")


_TIERED = f"""{_PIX}, p2 as (select pix.tile, pix.state, case when numobs < 0 then 'absent' when numobs >= 4 then '>=4' else cast(numobs as varchar) end as tier
        from pix
        join cells on pix.r = cells.\"row\" and pix.k = cells.col),
        al as (select tile, count(*) as t, count(*) filter (state = 'missing') as m, count(*) filter (state = 'hot') as h
        from p2
        group by tile)"""


QUERIES = {
    "gap_composite": (gap_composite, with_tables("obs land cells", f"""with {_COMP}, big as (select distinct \"row\" + dr as r, (((col + dc) % 36000) + 36000) % 36000 as k
        from cells, (values (-1), (0), (1)) a(dr), (values (-1), (0), (1)) b(dc)
        where numobs = 0),
        l as (select tile, y, x, true as land
        from land),
        j as (select comp.tile, comp.y, comp.x, case when land then n else 0 end as n, case when land then lst end as lst, (floor(comp.y / 5), floor(comp.x / 5)) in (select (r, k)
        from big) as in_gap
        from comp
        left
        join l on comp.tile = l.tile and comp.y = l.y and comp.x = l.x) select tile, y, x, in_gap, n, round(case when in_gap and lst >= {_HOT} then null else lst end, 4) as lst
        from j""")),
    "land_observations": (
        lambda spark, sf: m.mask_land(_dn(spark, sf), load(spark, sf, "land")).groupBy("scene_ts").agg(F.count("*").alias("n")),
        with_tables("obs land", f"with {_V} select scene_ts, count(*) as n from dn join land on dn.tile = land.tile and dn.y = land.y and dn.x = land.x group by scene_ts")),
    "tier_cross_tab": (tier_cross_tab, with_tables("obs cells", f"""with {_TIERED}, g as (select al.tile, lab.tier, count(state) as t, count(*) filter (state = 'missing') as m, count(*) filter (state = 'hot') as h, any_value(al.t) as all_t, any_value(al.m) as all_m, any_value(al.h) as all_h
        from al
        join (values ('0'), ('1'), ('2'), ('3'), ('>=4'), ('absent')) lab(tier) on true
        left
        join p2 on p2.tile = al.tile and p2.tier = lab.tier
        group by al.tile, lab.tier)
        select tile, tier, t as total_pixels, t - m as valid_pixels, m as missing_pixels, h as hot_pixels, round(100.0 * t / nullif(all_t, 0), 4) as share_of_tile_pct, round(100.0 * (t - m) / nullif(t, 0), 4) as valid_pct_of_tier, round(100.0 * m / nullif(t, 0), 4) as missing_pct_of_tier, round(100.0 * h / nullif(t - m, 0), 4) as hot_pct_of_tier_valid,
        round(100.0 * h / nullif(all_h, 0), 4) as share_of_tile_hot_pct, round(100.0 * m / nullif(all_m, 0), 4) as share_of_tile_missing_pct, round(h / nullif(t - m, 0) / nullif(all_h / nullif(all_t - all_m, 0), 0), 4) as hot_enrichment_vs_tile, round(m / nullif(t, 0) / nullif(all_m / nullif(all_t, 0), 0), 4) as missing_enrichment_vs_tile
        from g""")),
    "tile_totals": (tile_totals, with_tables("obs cells", f"""with {_TIERED} select tile, t as total_pixels, t - m as valid_pixels, m as missing_pixels, h as hot_pixels, round(100.0 * (t - m) / t, 4) as valid_pct, round(100.0 * m / t, 4) as missing_pct, round(100.0 * h / nullif(t - m, 0), 4) as hot_pct_of_valid
        from al""")),
    "coverage_tiers": (coverage_tiers, with_tables("cells", """select case when col = 4 then null when numobs >= 3 then 'normal' when numobs >= 1 then 'low_confidence' else 'gap' end as tier, count(*) as n
        from cells
        group by 1""")),
    "mask_tradeoffs": (mask_tradeoffs, with_tables("obs cells", f"""with {_PIX}, big as (select distinct r + dr as r, k + dc as k
        from gaps, (values (-1), (0), (1)) a(dr), (values (-1), (0), (1)) b(dc)),
        h as (select tile, state, rule, gated, case when rule like 'grow0%' then (r, k) in (select (r, k)
        from gaps) else (r, k) in (select (r, k)
        from big) end and (not gated or state = 'hot') as hit
        from pix, (values ('grow0', false), ('grow1', false), ('grow0_hot', true), ('grow1_hot', true)) u(rule, gated)),
        g as (select tile, rule, gated, count(*) filter (hit and state = 'cool') as c, count(*) filter (hit and state = 'hot') as h, count(*) filter (hit and state = 'missing') as m, count(*) filter (state = 'hot') as ah, count(*) filter (state = 'missing') as am, count(*) as n
        from h
        group by 1, 2, 3)
        select tile, rule, gated as value_gated, c + h as valid_pixels_removed, round(100.0 * (c + h) / nullif(n - am, 0), 4) as valid_pixels_removed_pct, h as hot_pixels_removed, round(100.0 * h / nullif(ah, 0), 4) as hot_pixels_removed_pct, ah - h as hot_pixels_remaining, c as cool_valid_pixels_removed, m as missing_pixels_annotated, round(100.0 * m / nullif(am, 0), 4) as missing_pixels_annotated_pct, round(c / nullif(h, 0), 4) as cool_pixels_lost_per_hot_pixel_removed
        from g""")),
    "registration_scan": (
        lambda spark, sf: a.registration(_pixels(spark, sf), _gaps(spark, sf)),
        with_tables("obs cells", f"""with {_PIX}, s as (select dr, dc
        from range(-2, 3) a(dr), range(-2, 3) b(dc)) select cast(dr as int) as dr, cast(dc as int) as dc, count(gaps.r) as hits
        from s
        join pix on state = 'hot'
        left
        join gaps on pix.r + dr = gaps.r and pix.k + dc = gaps.k
        group by dr, dc""")),
    "registration_best": (
        lambda spark, sf: a.best_shift(a.registration(_pixels(spark, sf), _gaps(spark, sf))),
        with_tables("obs cells", f"""with {_PIX}, s as (select dr, dc
        from range(-2, 3) a(dr), range(-2, 3) b(dc)),
        h as (select cast(dr as int) as dr, cast(dc as int) as dc, count(gaps.r) as hits
        from s
        join pix on state = 'hot'
        left
        join gaps on pix.r + dr = gaps.r and pix.k + dc = gaps.k
        group by dr, dc) select dr, dc, hits
        from h
        order by hits desc, abs(dr) + abs(dc), dr, dc limit 1""")),
    "class_gap_shares": (class_areas, with_tables("classes cells", f"""with {_MOLL}, t as (select class, case when numobs >= 3 then 'normal' when numobs >= 1 then 'low_confidence' else 'gap' end as tier
        from moll
        join cells on floor((90 - lat) / 36) = \"row\" and floor((lon + 180) / 72) = col),
        u as (select cast(class as varchar) as c, tier
        from t
        union all select 'all', tier
        from t
        union all select 'urban', tier
        from t
        where class in (2, 3)) select c as class, count(*) * 0.25e0 as land_km2, count(*) filter (tier = 'gap') * 0.25e0 as gap_km2, count(*) filter (tier = 'low_confidence') * 0.25e0 as low_confidence_km2, round(100.0 * count(*) filter (tier = 'gap') / count(*), 4) as gap_pct, round(100.0 * count(*) filter (tier = 'low_confidence') / count(*), 4) as low_confidence_pct
        from u
        group by c""")),
    "class_cells": (
        lambda spark, sf: a.cells_of_class(_classes(spark, sf), (2, 3)),
        with_tables("classes", f"with {_MOLL} select distinct cast(floor(lat) as int) as lat, cast(floor(lon) as int) as lon from moll where class in (2, 3)")),
    "polygon_raster": (
        lambda spark, sf: m.rasterise(_edges(spark, sf), _grid(spark, 1, 24), 24, 24).drop("tile"),
        with_tables("places", f"with {_DIAMOND} select y, x, max(class) as class from pxl, dia where abs(x + 0.5e0 - cx) + abs(y + 0.5e0 - cy) < r group by y, x")),
    "polygon_buffer": (
        lambda spark, sf: m.rasterise(e := _edges(spark, sf), _grid(spark, 1, 24), 24, 24).select("y", "x").union(m.near_edges(e, 24, 24, 0.8)).distinct(),
        with_tables("places", f"""with {_DIAMOND}, sd as (select cx + r * ax as x0, cy + r * ay as y0, cx + r * bx as x1, cy + r * by_ as y1
        from dia, (values (1, 0, 0, 1), (0, 1, -1, 0), (-1, 0, 0, -1), (0, -1, 1, 0)) v(ax, ay, bx, by_)),
        nr as (select y, x, x0, y0, x1 - x0 as dx, y1 - y0 as dy, greatest(0.0e0, least(1.0e0, ((x + 0.5e0 - x0) * (x1 - x0) + (y + 0.5e0 - y0) * (y1 - y0)) / ((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)))) as t
        from pxl, sd) select y, x
        from pxl, dia
        where abs(x + 0.5e0 - cx) + abs(y + 0.5e0 - cy) < r union select y, x
        from nr
        where pow(x + 0.5e0 - x0 - t * dx, 2) + pow(y + 0.5e0 - y0 - t * dy, 2) <= 0.64e0""")),
    "gap_validation": (
        gap_validation,
        with_tables("obs land cells", f"""with {_PIX}, j as (select land.tile, coalesce((r, k) in (select (r, k)
        from gaps), false) as p, coalesce(n < 30, false) as o
        from land
        left
        join pix on pix.tile = land.tile and pix.y = land.y and pix.x = land.x) select tile, count(*) as land_pixels, round(100.0 * count(*) filter (o) / count(*), 4) as observed_gap_pct, round(100.0 * count(*) filter (p) / count(*), 4) as predicted_gap_pct, round(coalesce(count(*) filter (p and o) / nullif(count(*) filter (p or o), 0), 1), 4) as agreement_iou, count(*) filter (o and not p) as observed_only_pixels, count(*) filter (p and not o) as predicted_only_pixels
        from j
        group by tile""")),
    "granule_coverage": (granule_coverage, with_tables("places", f"""with {_GRAN}, lab as (select granule, core, granule not in (select granule
        from listed) as gone, cast(split_part(granule, '_', 1) as int) % 2 = 0 as near
        from mis),
        ok as (select * from lab where not gone) select
        coalesce((select array_to_string(list_slice(list_sort(list(granule)), 1, 25), ',') from ok where core), '') as fetchable_core_sample,
        coalesce((select array_to_string(list_slice(list_sort(list(granule)), 1, 25), ',') from lab where gone and core), '') as absent_upstream_core_sample,
        (select count(*) from g) as expected, (select count(*) from g where granule in (select granule from have)) as consumed_of_expected,
        (select count(*) from have where granule not in (select granule from g)) as extra_not_expected,
        (select count(*) from lab) as missing, (select count(*) from lab where core) as missing_core,
        (select count(*) from lab where gone) as absent_upstream, (select count(*) from lab where gone and core) as absent_upstream_core,
        (select count(*) from ok) as fetchable, (select count(*) from ok where core) as fetchable_core,
        (select count(*) from ok where not near) as class_absent_outside_fetch_domain, 0 as class_absent_unverified_upstream,
        (select count(*) from lab where gone) as class_absent_upstream, (select count(*) from ok where near) as class_absent_within_fetch_domain,
        (select count(distinct tile) from need) as tiles, (select count(distinct tile) from need where core and granule in (select granule from ok)) as tiles_missing_core,
        (select count(distinct tile) from need where granule in (select granule from ok)) as tiles_missing_any, (select count(*) from ok) = 0 as complete""")),
    "absent_granules": (_absent, """select cast(s_suppkey as varchar) as granule, case when s_suppkey % 3 = 0 then 'absent-upstream' when s_suppkey % 5 = 0 then 'absent-outside-fetch-domain' else 'absent-within-fetch-domain' end as label, case when s_suppkey % 3 = 0 then 'absent-upstream' else 'absent-unverified-upstream' end as without_domain
        from supplier
        where s_suppkey % 2 = 0"""),
    "inventory_check": (
        lambda spark, sf: a.check_inventory(i := load(spark, sf, "supplier").select(F.lit("p").alias("product"), F.lit("3").alias("version"), F.col("s_name").alias("granule")), "p", "3", i.count()),
        """with b as (select substr(sha256(s_name), 1, 3) as block, count(*) as n, sha256(string_agg(s_name, chr(10)
        order by s_name)) as sha
        from supplier
        group by 1) select cast(sum(n) as bigint) as n, sha256(string_agg(sha, chr(10)
        order by block)) as names_sha256
        from b"""),
    "gap_manifest": (
        lambda spark, sf: a.gap_table(_granule_cells(spark, sf).where("granule not like '%9'"), _granule_cells(spark, sf))[1],
        """with c as (select distinct o_orderkey % 40 || '_' || o_custkey % 30 as granule
        from orders) select granule, case when granule like '%9' then 'absent' else 'consumed' end as status
        from c"""),
    "gap_table": (
        lambda spark, sf: a.gap_table(_granule_cells(spark, sf), _granule_cells(spark, sf))[0].groupBy("granule").agg(F.count("*").alias("gaps")),
        "select o_orderkey % 40 || '_' || o_custkey % 30 as granule, count(*) as gaps from orders where o_orderkey % 6 = 1 group by 1"),
    "content_hash": (
        lambda spark, sf: a.content_hash(load(spark, sf, "orders").select((F.col("o_orderkey") * 37 % 18000).alias("row"), (F.col("o_custkey") * 91 % 36000).alias("col")).distinct(), load(spark, sf, "supplier").select(F.col("s_name").alias("granule"), F.sha2("s_name", 256).alias("sha256")), load(spark, sf, "customer").where("c_custkey % 9 = 0").select(F.col("c_name").alias("granule")), "AG1km", {"short_name": "AG1km", "version": "003", "granule_count": 12}),
        """with g as (select distinct o_orderkey * 37 % 18000 as r, o_custkey * 91 % 36000 as c
        from orders),
        l as (select 'gaps ' || (r // 100) || ' ' || (c // 100) || ' ' || sha256(string_agg(r || ' ' || c, chr(10)
        order by r, c)) as line
        from g
        group by r // 100, c // 100
        union all select 'consumed ' || s_name || ' ' || sha256(s_name)
        from supplier
        union all select 'absent-upstream ' || c_name
        from customer
        where c_custkey % 9 = 0) select sha256('product AG1km' || chr(10) || 'inventory short_name=AG1km' || chr(10) || 'inventory version=003' || chr(10) || 'inventory queried_at=' || chr(10) || 'inventory granule_count=12' || chr(10) || string_agg(line, chr(10)
        order by line)) as hash
        from l"""),
    "block_weights": (
        lambda spark, sf: m.block_weights(_blocks(spark, sf), _footprints(spark, sf)),
        with_tables("scenes places", f"""with {_QUADS}, far as (select block, id
        from b
        join q on true
        where not land or exists (select 1
        from (values (1.0e0, 0.0e0), (0.0e0, 1.0e0), (2.0e0, 1.0e0), (-1.0e0, 2.0e0)) axis(nx, ny)
        where greatest(w * nx, e * nx) + greatest(s * ny, n * ny) < least(x0 * nx + y0 * ny, x1 * nx + y1 * ny, x2 * nx + y2 * ny, x3 * nx + y3 * ny)
          or least(w * nx, e * nx) + least(s * ny, n * ny) > greatest(x0 * nx + y0 * ny, x1 * nx + y1 * ny, x2 * nx + y2 * ny, x3 * nx + y3 * ny)))
        select block, (select count(*) from q) - (select count(*) from far where far.block = b.block) as scenes
        from b""")),
    "coastal_buffer": (
        lambda spark, sf: m.buffered_mask(_coast(spark, sf), _grid(spark, 2, 30), 30, 30, 25000.0, 60, -180.0, 10.0),
        with_tables("places", f"""with {_COAST}, px as (select r, c, -180 + (c + 0.5e0) / 10 as lon, 60 - (r + 0.5e0) / 10 as lat
        from range(60) a(r), range(60) b(c)),
        m as (select r, c, lon, lat, 6378137.0e0 * radians(lon) as x, 6378137.0e0 * ln(tan(pi() / 4 + radians(lat) / 2)) as y
        from px),
        e as (select 6378137.0e0 * radians(lon0) as x0, 6378137.0e0 * ln(tan(pi() / 4 + radians(lat0) / 2)) as y0, 6378137.0e0 * radians(lon1) as x1, 6378137.0e0 * ln(tan(pi() / 4 + radians(lat1) / 2)) as y1
        from side),
        t as (select r, c, x - x0 as px, y - y0 as py, x1 - x0 as dx, y1 - y0 as dy, greatest(0.0e0, least(1.0e0, ((x - x0) * (x1 - x0) + (y - y0) * (y1 - y0)) / ((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)))) as k
        from m, e),
        hit as (select r, c
        from t
        where sqrt(pow(px - k * dx, 2) + pow(py - k * dy, 2)) <= 25000 union select r, c
        from px, dia
        where abs(lon - cx) / rx + abs(lat - cy) / ry < 1)
        select (r // 30) || '_' || (c // 30) as tile, r % 30 as y, c % 30 as x
        from hit""")),
    "polygon_tiles": (
        lambda spark, sf: m.rasterise(_holed(spark, sf), _grid(spark, 3, 8).where("tile <> '1_1'"), 8, 8),
        with_tables("places", f"""with {_DIAMOND} select (y // 8) || '_' || (x // 8) as tile, y % 8 as y, x % 8 as x, max(class) as class
        from pxl, dia
        where abs(x + 0.5e0 - cx) + abs(y + 0.5e0 - cy) < r and abs(x + 0.5e0 - cx) + abs(y + 0.5e0 - cy) >= r / 2 and not (y // 8 = 1 and x // 8 = 1)
        group by y, x""")),
    "land_shares": (
        lambda spark, sf: _round(m.land_shares(m.rasterise(_holed(spark, sf), t := _grid(spark, 3, 8), 8, 8), t, 64), "fraction"),
        with_tables("places", f"""with {_DIAMOND}, hit as (select distinct y // 8 as r, x // 8 as c, y, x
        from pxl, dia
        where abs(x + 0.5e0 - cx) + abs(y + 0.5e0 - cy) < r and abs(x + 0.5e0 - cx) + abs(y + 0.5e0 - cy) >= r / 2)
        select a.r || '_' || b.c as tile, round(count(hit.y) / 64, 4) as fraction
        from range(3) a(r)
        join range(3) b(c) on true
        left
        join hit on hit.r = a.r and hit.c = b.c
        group by a.r, b.c""")),
    "tile_dimension": (
        lambda spark, sf: g.tiles(spark).join(load(spark, sf, "places").select(((F.col("id") % 25) * 10 - 120).cast("int").alias("lon")).distinct(), "lon").select("name", F.col("lat"), "lon", *[v.alias(k) for k, v in zip(("plat", "plon"), g.parse_tile(F.col("name")))]),
        with_tables("places", """select case when lat >= 0 then 'N' else 'S' end || lpad(cast(abs(lat) as varchar), 2, '0') || case when lon >= 0 then 'E' else 'W' end || lpad(cast(abs(lon) as varchar), 3, '0') as name, cast(lat as int) as lat, cast(lon as int) as lon, cast(lat as int) as plat, cast(lon as int) as plon
        from (select unnest(range(-55, 61, 5)) as lat) a, (select distinct id % 25 * 10 - 120 as lon
        from places) b""")),
    "land_tiles": (
        lambda spark, sf: g.land_tiles(g.tiles(spark), load(spark, sf, "places").select(g.tile_name(F.col("lat"), F.col("lon")).alias("name"))),
        with_tables("places", """select distinct case when lat >= 0 then 'N' else 'S' end || lpad(cast(abs(lat) as varchar), 2, '0') || case when lon >= 0 then 'E' else 'W' end || lpad(cast(abs(lon) as varchar), 3, '0') as name, cast(lat as int) as lat, cast(lon as int) as lon
        from places
        where lat between -55 and 60""")),
    "bounds_check": (
        lambda spark, sf: load(spark, sf, "scenes").groupBy(g.in_bounds(F.col("south") - 10, F.col("south") + 10).alias("inside")).agg(F.count("*").alias("n")),
        with_tables("scenes", "select south - 10 >= -60 and south + 10 <= 60 as inside, count(*) as n from scenes group by 1")),
    "land_fractions": (
        lambda spark, sf: _round(m.land_fraction(load(spark, sf, "obs").select("tile", "y", "x").distinct(), load(spark, sf, "land")), "fraction"),
        with_tables("obs land", """select o.tile, round(avg(case when l.y is null then 0.0e0 else 1.0e0 end), 4) as fraction
        from (select distinct tile, y, x
        from obs) o
        left
        join land l on o.tile = l.tile and o.y = l.y and o.x = l.x
        group by o.tile""")),
    "partial_classes": (
        lambda spark, sf: _round(a.tier_area(_class_points(spark, sf), 0.25, load(spark, sf, "classes").where("class = 1").select("class").distinct()), "km2"),
        with_tables("classes cells", f"""with {_MOLL} select class, case when numobs >= 3 then 'normal' when numobs >= 1 then 'low_confidence' else 'gap' end as tier, round(count(*) * 0.25e0, 4) as km2
        from moll
        join cells on floor((90 - lat) / 36) = \"row\" and floor((lon + 180) / 72) = col
        where class <> 1
        group by 1, 2""")),
    "settlement_tiers": (
        lambda spark, sf: a.class_tiers(_classes(spark, sf), _fine_tiers(spark, sf)).groupBy("class", "tier").agg(F.count("*").alias("n")),
        with_tables("classes", f"""with {_MOLL}, r as (select distinct cast(floor((90 - lat) * 100) as bigint) as r, cast(floor((lon + 180) * 100) as bigint) as k
        from moll
        where floor((90 - lat) * 100) % 3 <> 0) select class, case when r is null then null when (r + k) % 5 = 0 then 'gap' else 'normal' end as tier, count(*) as n
        from moll
        left
        join r on floor((90 - lat) * 100) = r.r and floor((lon + 180) * 100) = r.k
        group by 1, 2""")),
    "oriented_cells": (
        lambda spark, sf: a.orient(load(spark, sf, "orders").select((F.col("o_orderkey") % 100).alias("r"), (F.col("o_custkey") % 100).alias("c"), (F.col("o_orderkey") % 3 == 0).alias("lat_ascends"), (F.col("o_custkey") % 2 == 0).alias("lon_descends"))).groupBy("r", "c").agg(F.count("*").alias("n")),
        """select case when o_orderkey % 3 = 0 then 99 - o_orderkey % 100 else o_orderkey % 100 end as r, case when o_custkey % 2 = 0 then 99 - o_custkey % 100 else o_custkey % 100 end as c, count(*) as n
        from orders
        group by 1, 2"""),
    "granule_cells": (
        lambda spark, sf: load(spark, sf, "scenes").select("item_id", *[v.alias(k) for k, v in zip(("lat", "lon"), a.granule_cell(_ring()))]),
        with_tables("scenes", """select item_id, case when item_id % 7 <> 1 then cast(floor(south + 0.25) as int) end as lat, case when item_id % 7 <> 1 then cast(floor(west + 0.5) as int) end as lon
        from scenes""")),
    "mask_cells": (
        lambda spark, sf: a.mask_cells(load(spark, sf, "orders").select((F.col("o_orderkey") % 180).alias("r"), (F.col("o_custkey") % 360).alias("c"), (F.col("o_totalprice") > 100000).alias("v"))).distinct(),
        "select distinct 89 - o_orderkey % 180 as lat, o_custkey % 360 - 180 as lon from orders where o_totalprice > 100000"),
    "tile_jobs": (
        lambda spark, sf: g.jobs(load(spark, sf, "places").select(F.col("name").alias("name")), 2018, 2024, 3),
        with_tables("places", """select name as name, cast(s as int) as start, cast(least(s + 2, 2024) as int) as \"end\", case when s = 2024 then '2024' else s || '-' || least(s + 2, 2024) end as \"window\"
        from places, (values (2018), (2021), (2024)) t(s)""")),
    "point_tiles": (
        lambda spark, sf: load(spark, sf, "customer").select("c_custkey", *[v.alias(k) for k, v in zip(("lat", "lon"), g.tile_of(F.col("c_acctbal") / 200, F.col("c_acctbal") / 60))], *[v.alias(k) for k, v in zip(("row", "col"), g.pixel(F.col("c_acctbal") / 200, F.col("c_acctbal") / 60))]),
        """select c_custkey, cast(ceil(c_acctbal / 200 / 5) * 5 as int) as lat, cast(floor(c_acctbal / 60 / 5) * 5 as int) as lon, cast(round_even((60 - c_acctbal / 200) * 3600, 0) as bigint) as \"row\", cast(round_even((c_acctbal / 60 + 180) * 3600, 0) as bigint) as col
        from customer"""),
    "pixel_cells": (
        lambda spark, sf: load(spark, sf, "orders").select("o_orderkey", *[v.alias(k) for k, v in zip(("row", "col"), g.cell_of_pixel(F.col("o_orderkey") * 29 % 432000, F.col("o_orderkey") * 977 % 1400000))]).withColumn("granule", g.granule(F.col("row"), F.col("col"))),
        """with c as (select o_orderkey, cast(floor(o_orderkey * 29 % 432000 / 36) as bigint) + 3000 as r, cast(floor(o_orderkey * 977 % 1400000 / 36) as bigint) % 36000 as k
        from orders) select o_orderkey, r as \"row\", k as col, case when 90 - floor(r / 100) >= 0 then 'N' else 'S' end || lpad(cast(cast(abs(90 - floor(r / 100)) as bigint) as varchar), 2, '0') || case when floor(k / 100) - 180 >= 0 then 'E' else 'W' end || lpad(cast(cast(abs(floor(k / 100) - 180) as bigint) as varchar), 3, '0') as granule
        from c"""),
    "scene_tiles": (
        lambda spark, sf: g.tiles_of_box(load(spark, sf, "scenes").select("item_id", "west", "south", (F.col("west") + 7).alias("east"), (F.col("south") + 4).alias("north"))).groupBy("lat", "lon").agg(F.count("*").alias("scenes")),
        with_tables("scenes", """select cast(a as int) as lat, cast(o as int) as lon, count(*) as scenes
        from scenes, lateral (select unnest(range(cast(floor(south / 5) * 5 + 5 as bigint), cast(ceil((south + 4) / 5) * 5 as bigint) + 1, 5)) as a) x, lateral (select unnest(range(cast(floor(west / 5) * 5 as bigint), cast(ceil((west + 7) / 5) * 5 as bigint), 5)) as o) y
        group by a, o""")),
    "solar_days": (
        lambda spark, sf: load(spark, sf, "scenes").groupBy(g.solar_day(F.col("datetime"), F.col("west") + 5).alias("day")).agg(F.count("*").alias("n"), F.round(F.avg("cloud"), 4).alias("cover")),
        with_tables("scenes", """select cast(datetime + to_seconds(cast(floor((west + 5) * 240) as bigint)) as date) as day, count(*) as n, round(avg(cloud), 4) as cover
        from scenes
        group by 1""")),
    "packing": (
        lambda spark, sf: load(spark, sf, "customer").select("c_custkey", q.encode(F.col("c_acctbal") / 16).alias("dn"), F.round(q.decode(q.encode(F.col("c_acctbal") / 16)), 4).alias("back"), (F.col("c_acctbal") / 16 * 100 >= q.threshold_dn(30.0) - 5000).alias("over")),
        """with p as (select c_custkey, c_acctbal / 16 as v, (c_acctbal / 16 + 50) / 0.01e0 as d
        from customer),
        e as (select *, case when d >= 1 and floor(d) <= 65535 then cast(floor(d) as int) else 0 end as dn
        from p) select c_custkey, dn, round(case when dn <> 0 then dn * 0.01e0 - 50 end, 4) as back, v * 100 >= 3000 as over
        from e"""),
}

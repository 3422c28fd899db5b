"""Audits of the gap mask and its coverage."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .masks import dilate, flag_gap
from .normalize import PIXEL, require_empty


# Observation tiers in the order of a report.
TIERS = ("0", "1", "2", "3", ">=4", "absent")


def _pct(part: Column, whole: Column) -> Column:
    """Per cent; null where there is nothing to divide by."""
    return 100.0 * part / F.nullif(whole, F.lit(0))


def tile_totals(pixels: DataFrame) -> DataFrame:
    """A row per tile of ``pixels(tile, tier, state)``: pixels, valid, missing and hot ones, with their shares."""
    t = _tallies(pixels).where("_all").drop("_all", "tier")
    return t.withColumns({"valid_pct": _pct(F.col("valid_pixels"), F.col("total_pixels")), "missing_pct": _pct(F.col("missing_pixels"), F.col("total_pixels")), "hot_pct_of_valid": _pct(F.col("hot_pixels"), F.col("valid_pixels"))})


def _tallies(pixels: DataFrame) -> DataFrame:
    """Pixels by state of each tier of a tile and, marked _all, of the tile; both from one grouping."""
    of = lambda s: F.count_if(F.col("state") == s)
    g = pixels.groupingSets([["tile", "tier"], ["tile"]], "tile", "tier")
    return g.agg(F.count("*").alias("total_pixels"), (F.count("*") - of("missing")).alias("valid_pixels"), of("missing").alias("missing_pixels"), of("hot").alias("hot_pixels"), (F.grouping("tier") == 1).alias("_all"))


def cross_tab(pixels: DataFrame) -> DataFrame:
    """A row per tile and tier, tiers without pixels included, of ``pixels(tile, tier, state)``.

    Shares of the tile and of its hot and missing pixels, the tier's own rates (hot ones of its valid pixels), and both rates over
    the tile's; in per cent, null where there is nothing to divide by.
    """
    t = _tallies(pixels)
    counts = ["total_pixels", "valid_pixels", "missing_pixels", "hot_pixels"]
    whole = t.where("_all").select("tile", F.explode(F.array(*map(F.lit, TIERS))).alias("tier"), *[F.col(c).alias(f"_{c}") for c in counts])
    j = whole.join(t.where("not _all").drop("_all"), ["tile", "tier"], "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in counts})
    total, valid, missing, hot = (F.col(c) for c in counts)
    all_total, all_valid, all_missing, all_hot = (F.col(f"_{c}") for c in counts)
    over = lambda part, whole, all_part, all_whole: _pct(part, whole) / F.nullif(_pct(all_part, all_whole), F.lit(0.0))
    return j.select(
        "tile", "tier", *counts,
        _pct(total, all_total).alias("share_of_tile_pct"), _pct(valid, total).alias("valid_pct_of_tier"), _pct(missing, total).alias("missing_pct_of_tier"), _pct(hot, valid).alias("hot_pct_of_tier_valid"),
        _pct(hot, all_hot).alias("share_of_tile_hot_pct"), _pct(missing, all_missing).alias("share_of_tile_missing_pct"),
        over(hot, valid, all_hot, all_valid).alias("hot_enrichment_vs_tile"), over(missing, total, all_missing, all_total).alias("missing_enrichment_vs_tile"),
    )


def tradeoffs(pixels: DataFrame, gaps: DataFrame, radii: tuple = (0, 1), columns: int = 36000) -> DataFrame:
    """A row per tile and candidate rule: gaps grown by each radius, and the hot pixels of these only (value-gated), with what it takes and what that is of the tile.

    ``pixels(tile, row, col, state)``. Gap cells are grown once, each with its distance; a pixel is then tried on all rules at once.
    """
    step = F.sequence(F.lit(-max(radii)), F.lit(max(radii)))
    grown = gaps.withColumn("_dr", F.explode(step)).withColumn("_dc", F.explode(step))
    near = grown.groupBy((F.col("row") + F.col("_dr")).alias("row"), F.pmod(F.col("col") + F.col("_dc"), F.lit(columns)).alias("col")).agg(F.min(F.greatest(F.abs("_dr"), F.abs("_dc"))).alias("_far"))
    rules = F.explode(F.array(*[F.struct(F.lit(f"grow{r}" + "_hot" * g).alias("rule"), F.lit(bool(g)).alias("value_gated"), F.lit(r).alias("_r")) for r in radii for g in (0, 1)]))
    tried = pixels.select("tile", "row", "col", "state").join(near, ["row", "col"], "left").select("tile", "state", "_far", rules.alias("_rule")).select("tile", "state", "_far", "_rule.*")
    hit = F.coalesce(F.col("_far") <= F.col("_r"), F.lit(False)) & (~F.col("value_gated") | (F.col("state") == "hot"))
    of = lambda s: F.count_if(hit & (F.col("state") == s))
    at = lambda s: F.count_if(F.col("state") == s)
    t = tried.groupBy("tile", "rule", "value_gated").agg(of("cool").alias("cool"), of("hot").alias("hot"), of("missing").alias("missing"), at("hot").alias("_hot"), at("missing").alias("_missing"), F.count("*").alias("_all"))
    removed = F.col("cool") + F.col("hot")
    return t.select(
        "tile", "rule", "value_gated", removed.alias("valid_pixels_removed"), _pct(removed, F.col("_all") - F.col("_missing")).alias("valid_pixels_removed_pct"),
        F.col("hot").alias("hot_pixels_removed"), _pct(F.col("hot"), F.col("_hot")).alias("hot_pixels_removed_pct"), (F.col("_hot") - F.col("hot")).alias("hot_pixels_remaining"),
        F.col("cool").alias("cool_valid_pixels_removed"), F.col("missing").alias("missing_pixels_annotated"), _pct(F.col("missing"), F.col("_missing")).alias("missing_pixels_annotated_pct"),
        (F.col("cool") / F.nullif("hot", F.lit(0))).alias("cool_pixels_lost_per_hot_pixel_removed"),
    )


def registration(pixels: DataFrame, gaps: DataFrame, reach: int = 2) -> DataFrame:
    """(dr, dc, hits): hot pixels on gap cells for each shift of the mask."""
    step = F.sequence(F.lit(-reach), F.lit(reach))
    hot = pixels.where("state = 'hot'").groupBy("row", "col").agg(F.count("*").alias("n"))  # cells, not pixels, are shifted
    moved = hot.withColumn("dr", F.explode(step)).withColumn("dc", F.explode(step)).withColumns({"row": F.col("row") + F.col("dr"), "col": F.col("col") + F.col("dc")})
    return flag_gap(moved, gaps).groupBy("dr", "dc").agg(F.coalesce(F.sum(F.when(F.col("in_gap"), F.col("n"))), F.lit(0)).alias("hits"))


def best_shift(scan: DataFrame) -> DataFrame:
    """most hits, ties to the least Manhattan distance, then the least dr, dc."""
    return scan.orderBy(F.desc("hits"), F.abs("dr") + F.abs("dc"), "dr", "dc").limit(1)


def orient(cells: DataFrame, size: int = 100) -> DataFrame:
    """Granule rows north-up and west-left, whatever way they were stored."""
    row = F.when(F.col("lat_ascends"), size - 1 - F.col("r")).otherwise(F.col("r"))
    col = F.when(F.col("lon_descends"), size - 1 - F.col("c")).otherwise(F.col("c"))
    return cells.withColumns({"r": row, "c": col}).drop("lat_ascends", "lon_descends")


def gap_table(cells: DataFrame, expected: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(gaps, manifest): cells of no observation, and each expected granule as consumed or absent."""
    there = cells.select("granule").distinct().withColumn("_there", F.lit(True))
    manifest = expected.select("granule").distinct().join(there, "granule", "left").select("granule", F.when(F.col("_there"), "consumed").otherwise("absent").alias("status"))
    return cells.where("numobs = 0"), manifest


def content_hash(gaps: DataFrame, consumed: DataFrame, absent: DataFrame, product: str, inventory: dict | None = None) -> DataFrame:
    """(hash): sha256 of a gap table's content, whatever the order of rows and files.

    ``gaps(row, col)`` are hashed per 1-degree granule, at most 10,000 cells each, then the granules' hashes, at most one per
    1-degree cell of the globe, with product, ``consumed(granule, sha256)``, ``absent(granule)`` and the inventory's identity.
    Not byte-equal to a hash of one sorted list of cells, which one task would have to hold.
    """
    cells = gaps.groupBy(F.floor(F.col("row") / 100).alias("gr"), F.floor(F.col("col") / 100).alias("gc")).agg(F.array_sort(F.collect_list(F.struct("row", "col"))).alias("cells"))
    text = F.array_join(F.transform("cells", lambda c: F.concat_ws(" ", c["row"], c["col"])), "\n")
    lines = cells.select(F.concat_ws(" ", F.lit("gaps"), "gr", "gc", F.sha2(text, 256)).alias("line"))
    lines = lines.union(consumed.select(F.concat_ws(" ", F.lit("consumed"), "granule", "sha256"))).union(absent.select(F.concat_ws(" ", F.lit("absent-upstream"), "granule")))
    known = {k: (inventory or {}).get(k, "") for k in ("short_name", "version", "queried_at", "granule_count")}
    known["granule_count"] = known["granule_count"] or 0
    head = "\n".join([f"product {product}", *[f"inventory {k}={v}" for k, v in known.items()]])
    body = F.array_join(F.array_sort(F.collect_list("line")), "\n")
    return lines.agg(F.sha2(F.concat_ws("\n", F.lit(head), body), 256).alias("hash"))


def granule_cell(points: Column) -> tuple[Column, Column]:
    """South-west corner, in whole degrees, of a nested metadata polygon array<struct<lat, lon>>; null when unusable."""
    low = lambda f: F.floor(F.array_min(F.transform(points, lambda p: p[f]))).cast("int")
    ok = F.size(points) > 0
    return F.when(ok, low("lat")), F.when(ok, low("lon"))


def mask_cells(mask: DataFrame) -> DataFrame:
    """True cells of a 1-degree mask raster (r, c, v) to (lat, lon)."""
    return mask.where("v").select((89 - F.col("r")).alias("lat"), (F.col("c") - 180).alias("lon"))


def mollweide(x: Column, y: Column, radius: float = 6378137.0) -> tuple[Column, Column]:
    """(lat, lon) of an equal-area grid point; null outside the globe."""
    theta = F.asin(y / (radius * math.sqrt(2)))
    lat = F.degrees(F.asin((2 * theta + F.sin(2 * theta)) / math.pi))
    lon = F.degrees(math.pi * x / (2 * radius * math.sqrt(2) * F.cos(theta)))
    ok = (F.abs(y) < radius * math.sqrt(2)) & (F.abs(lon) <= 180)
    return F.when(ok, lat), F.when(ok, lon)


def class_tiers(classes: DataFrame, tiers: DataFrame) -> DataFrame:
    """(class, tier): settlement points (x, y, class) with the tier of their 0.01-degree cell; of several the first granule's."""
    lat, lon = mollweide(F.col("x"), F.col("y"))
    p = classes.withColumns({"row": F.floor((90 - lat) * 100).cast("long"), "col": F.floor((lon + 180) * 100).cast("long")})
    first = tiers.groupBy("row", "col").agg(F.min_by("tier", "granule").alias("tier"))
    return p.join(first, ["row", "col"], "left").select("class", "tier")


def tier_area(rows: DataFrame, km2: float, partial: DataFrame | None = None) -> DataFrame:
    """(class, tier, km2); classes named in ``partial`` are left out."""
    if partial is not None:
        rows = rows.join(partial, "class", "left_anti")
    return rows.groupBy("class", "tier").agg((F.count("*") * km2).alias("km2"))


def gap_shares(area: DataFrame, urban: tuple) -> DataFrame:
    """(class, land_km2, gap_km2, low_confidence_km2, gap_pct, low_confidence_pct) of ``area(class, tier, km2)``: for each class, for all and for the urban ones, in one grouping; zeros where there is no area."""
    km2 = lambda t: F.sum(F.when(F.col("tier") == t, F.col("km2")))
    a = area.select("tier", "km2", F.col("class").cast("string").alias("class"), F.when(F.col("class").isin(*urban), "urban").alias("town"))
    g = a.groupingSets([["class"], ["town"], []], "class", "town").agg(F.sum("km2").alias("land_km2"), km2("gap").alias("gap_km2"), km2("low_confidence").alias("low_confidence_km2"), F.grouping_id("class", "town").alias("_set"))
    name = F.when(F.col("_set") == 1, F.col("class")).when(F.col("_set") == 2, F.col("town")).otherwise("all")
    found = g.select(name.alias("class"), "land_km2", "gap_km2", "low_confidence_km2").where("class is not null")
    always = area.sparkSession.createDataFrame([("all",), ("urban",)], "class string")
    out = found.select("class").union(always).distinct().join(found, "class", "left").na.fill(0.0)
    share = lambda c: F.coalesce(_pct(F.col(c), F.nullif("land_km2", F.lit(0.0))), F.lit(0.0))
    return out.select("class", "land_km2", "gap_km2", "low_confidence_km2", share("gap_km2").alias("gap_pct"), share("low_confidence_km2").alias("low_confidence_pct"))


def cells_of_class(points: DataFrame, classes: tuple) -> DataFrame:
    """1-degree cells (lat, lon) that hold any pixel of the classes."""
    lat, lon = mollweide(F.col("x"), F.col("y"))
    return points.where(F.col("class").isin(*classes)).select(F.floor(lat).cast("int").alias("lat"), F.floor(lon).cast("int").alias("lon")).where("lat is not null and lon is not null").distinct()


def validate(predicted: DataFrame, observed: DataFrame, land: DataFrame) -> DataFrame:
    """C20: a row per tile of ``land``: its pixels, predicted and observed gaps on them in per cent, their agreement (intersection over union, 1 without any), and what only one side has."""
    flag = lambda d, c: d.select(*PIXEL).distinct().withColumn(c, F.lit(True))
    j = land.join(flag(predicted, "p"), PIXEL, "left").join(flag(observed, "o"), PIXEL, "left")
    p, o = F.coalesce("p", F.lit(False)), F.coalesce("o", F.lit(False))
    either = F.count_if(p | o)
    return j.groupBy("tile").agg(
        F.count("*").alias("land_pixels"), (100.0 * F.count_if(o) / F.count("*")).alias("observed_gap_pct"), (100.0 * F.count_if(p) / F.count("*")).alias("predicted_gap_pct"),
        F.coalesce(F.count_if(p & o) / F.nullif(either, F.lit(0)), F.lit(1.0)).alias("agreement_iou"), F.count_if(o & ~p).alias("observed_only_pixels"), F.count_if(p & ~o).alias("predicted_only_pixels"),
    )


# What is known of a granule that isn't there.
ABSENT_UPSTREAM, ABSENT_UNVERIFIED = "absent-upstream", "absent-unverified-upstream"
ABSENT_OUTSIDE, ABSENT_WITHIN = "absent-outside-fetch-domain", "absent-within-fetch-domain"


def classify_absent(missing: DataFrame, inventory: DataFrame | None = None, domain: DataFrame | None = None) -> DataFrame:
    """(granule, label): not in the upstream inventory; else unverified without a fetch domain; else within or outside it."""
    flag = lambda d, c: d.select("granule").distinct().withColumn(c, F.lit(True))
    j, label = missing, F.lit(ABSENT_UNVERIFIED)
    if domain is not None:
        j, label = j.join(flag(domain, "_d"), "granule", "left"), F.when(F.col("_d"), ABSENT_WITHIN).otherwise(ABSENT_OUTSIDE)
    if inventory is not None:
        j, label = j.join(flag(inventory, "_i"), "granule", "left"), F.when(F.col("_i").isNull(), ABSENT_UPSTREAM).otherwise(label)
    return j.select("granule", label.alias("label"))


SAMPLE = 25


def coverage_report(expected: DataFrame, present: DataFrame, inventory: DataFrame | None = None, domain: DataFrame | None = None) -> DataFrame:
    """One row on the granules that tiles need, of ``expected(tile, granule, core)``, ``present(granule)`` and what upstream lists.

    A missing granule that upstream lacks cannot be fetched; without an inventory none is known to lack. Tiles count as
    missing core (or any) if a fetchable core (or any) granule of theirs is. Counts by label, and the first 25 names
    of fetchable and of upstream-absent core granules, in order.
    """
    flag = lambda d, c: d.select("granule").distinct().withColumn(c, F.lit(True))
    need = expected.groupBy("granule").agg(F.bool_or("core").alias("core"))
    all_of = need.withColumn("_need", F.lit(True)).join(flag(present, "_have"), "granule", "full")
    missing = all_of.where("_need and _have is null").select("granule", "core")
    labels = missing.join(classify_absent(missing.select("granule"), inventory, domain), "granule")
    gone = F.col("label") == ABSENT_UPSTREAM
    count = lambda c: F.count_if(c)
    held = all_of.agg(F.count("_need").alias("expected"), count(F.col("_need") & F.col("_have")).alias("consumed_of_expected"), count(F.col("_need").isNull()).alias("extra_not_expected"))
    lost = labels.agg(
        F.count("*").alias("missing"), count("core").alias("missing_core"), count(gone).alias("absent_upstream"), count(gone & F.col("core")).alias("absent_upstream_core"),
        count(~gone).alias("fetchable"), count(~gone & F.col("core")).alias("fetchable_core"),
        *[count(F.col("label") == name).alias("class_" + name.replace("-", "_")) for name in (ABSENT_OUTSIDE, ABSENT_UNVERIFIED, ABSENT_UPSTREAM, ABSENT_WITHIN)],
    )
    fetchable = labels.where(~gone)
    touched = expected.join(flag(fetchable, "_f"), "granule", "left").groupBy("tile").agg(F.bool_or(F.col("_f")).alias("any"), F.bool_or(F.col("_f") & F.col("core")).alias("core"))
    tiles = touched.agg(F.count("*").alias("tiles"), count(F.coalesce("core", F.lit(False))).alias("tiles_missing_core"), count(F.coalesce("any", F.lit(False))).alias("tiles_missing_any"))
    out = held.withColumn("k", F.lit(1))
    first = lambda d, name: d.where("core").select("granule").orderBy("granule").limit(SAMPLE).agg(F.array_join(F.array_sort(F.collect_list("granule")), ",").alias(name))
    for part in (lost, tiles, first(fetchable, "fetchable_core_sample"), first(labels.where(gone), "absent_upstream_core_sample")):
        out = out.join(part.withColumn("k", F.lit(1)), "k")  # one row each
    return out.drop("k").withColumn("complete", F.col("fetchable") == 0)


def check_inventory(inventory: DataFrame, product: str, version: str, hits: int) -> DataFrame:
    """(n, names_sha256) of an upstream listing; another product or version, doubled names and another count are errors.

    Names are hashed in blocks, 4,096 of them by the first digits of each name's sha256, and the blocks' hashes in order after that, so that
    no task holds all names; not byte-equal to a hash of one sorted list.
    """
    require_empty(inventory.where((F.col("product") != product) | (F.col("version") != version)), "another product or version")
    require_empty(inventory.groupBy("granule").count().where("count > 1"), "a name is doubled")
    block = inventory.groupBy(F.substring(F.sha2("granule", 256), 1, 3).alias("block")).agg(F.count("*").alias("n"), F.sha2(F.array_join(F.array_sort(F.collect_list("granule")), "\n"), 256).alias("sha"))
    out = block.agg(F.sum("n").alias("n"), F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "sha"))), lambda b: b["sha"]), "\n"), 256).alias("names_sha256"))
    require_empty(out.where(F.col("n") != hits), f"upstream reports {hits}")
    return out

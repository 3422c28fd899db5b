"""Masks on pixel keys and polygons."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.quality import gap_drop
from ..params import HOT_C, MERCATOR_RADIUS, NORTH, PX_PER_DEG
from .normalize import PIXEL


def mask_land(values: DataFrame, land: DataFrame) -> DataFrame:
    """Observations over land only."""
    return values.join(land, PIXEL, "left_semi")


def mask_counts(comp: DataFrame, land: DataFrame, counts: list[str]) -> DataFrame:
    """Counts are 0 and values missing off land; no row goes."""
    j = comp.join(land.withColumn("_land", F.lit(True)), PIXEL, "left")
    out = {c: F.when(F.col("_land"), F.col(c)).otherwise(0) for c in counts}
    return j.withColumns(out | {"lst": F.when(F.col("_land"), F.col("lst"))}).drop("_land")


def dilate(cells: DataFrame, radius: int, columns: int = 36000) -> DataFrame:
    """All cells within a square radius, columns wrapped."""
    step = F.sequence(F.lit(-radius), F.lit(radius))
    grown = cells.withColumn("_dr", F.explode(step)).withColumn("_dc", F.explode(step))
    return grown.select((F.col("row") + F.col("_dr")).alias("row"), F.pmod(F.col("col") + F.col("_dc"), F.lit(columns)).alias("col")).distinct()


def with_cell(pixels: DataFrame, size: int) -> DataFrame:
    """B23 on a local grid: the cell (row, col) of each pixel."""
    return pixels.withColumns({"row": F.floor(F.col("y") / size).cast("long"), "col": F.floor(F.col("x") / size).cast("long")})


def flag_gap(pixels: DataFrame, gap_cells: DataFrame) -> DataFrame:
    """C4: whether a pixel's cell is a gap; the cells are far fewer than the pixels, so Spark may broadcast them by size."""
    return pixels.join(gap_cells.select("row", "col").distinct().withColumn("in_gap", F.lit(True)), ["row", "col"], "left").withColumn("in_gap", F.coalesce("in_gap", F.lit(False)))


def mask_gaps(comp: DataFrame, hot: float = HOT_C) -> DataFrame:
    """Values of ``hot`` degrees or more in gaps go; counts stay."""
    return comp.withColumn("lst", gap_drop(F.col("lst"), F.col("in_gap"), hot))


def sides(rings: Column) -> Column:
    """The sides of ``rings array<array<struct<x, y>>>``, closed or not, as array<struct<x0, y0, x1, y1>>; holes are rings like others."""
    def of(ring):
        after = lambda i: F.element_at(ring, (i + 1) % F.size(ring) + 1)
        return F.transform(ring, lambda p, i: F.struct(p["x"].alias("x0"), p["y"].alias("y0"), after(i)["x"].alias("x1"), after(i)["y"].alias("y1")))

    return F.flatten(F.transform(F.filter(rings, lambda r: F.size(r) > 0), of))


def side_meets_box(s: Column, west: Column, south: Column, east: Column, north: Column) -> Column:
    """Whether a side and a box share a point, touching included: no axis of x, y and the side's normal has them apart."""
    cx, cy, hx, hy = (west + east) / 2, (south + north) / 2, (east - west) / 2, (north - south) / 2
    mx, my, dx, dy = (s["x0"] + s["x1"]) / 2 - cx, (s["y0"] + s["y1"]) / 2 - cy, (s["x1"] - s["x0"]) / 2, (s["y1"] - s["y0"]) / 2
    return (F.abs(mx) <= hx + F.abs(dx)) & (F.abs(my) <= hy + F.abs(dy)) & (F.abs(mx * dy - my * dx) <= hx * F.abs(dy) + hy * F.abs(dx))


def holds_point(edges: Column, x: Column, y: Column) -> Column:
    """Whether a point is inside the rings that ``edges`` are of: an odd number of sides lies to its right."""
    def right(s):
        across = (s["y0"] <= y) != (s["y1"] <= y)
        return across & (s["x0"] + (y - s["y0"]) * (s["x1"] - s["x0"]) / F.when(across, s["y1"] - s["y0"]) > x)

    return F.size(F.filter(edges, right)) % 2 == 1


def polygon_meets_box(edges: Column, west: Column, south: Column, east: Column, north: Column) -> Column:
    """Whether a polygon and a box share a point: a side meets the box, or the box lies wholly inside."""
    return F.exists(edges, lambda s: side_meets_box(s, west, south, east, north)) | holds_point(edges, west, south)


def block_weights(blocks: DataFrame, footprints: DataFrame, bucket: float = 10.0) -> DataFrame:
    """(block, scenes): footprint polygons that meet each block, touching included; 0 on blocks off land; missing and empty footprints are skipped.

    ``blocks(block, west, south, east, north, land)``, ``footprints(rings)``. Equal boxes and equal footprints are compared
    once and counted as often as they are there. Both sides are dealt to the grid buckets that their
    boxes touch, so only near ones are compared; a pair that shares several buckets is looked at in the one
    that holds the lower corner of what their boxes share, so nothing has to be told apart afterwards.
    """
    at = lambda c: F.floor(c / bucket).cast("int")
    box = ["west", "south", "east", "north"]

    def dealt(df, west, south, east, north):
        return df.withColumn("_bx", F.explode(F.sequence(at(F.col(west)), at(F.col(east))))).withColumn("_by", F.explode(F.sequence(at(F.col(south)), at(F.col(north)))))

    f = footprints.groupBy("rings").agg(F.count("*").alias("_n")).select(sides(F.col("rings")).alias("_edges"), "_n").where("size(_edges) > 0")
    ends = {"_west": F.array_min("_edges.x0"), "_south": F.array_min("_edges.y0"), "_east": F.array_max("_edges.x0"), "_north": F.array_max("_edges.y0")}
    f = f.withColumns(ends)
    b = dealt(blocks.where("land").select(*box).distinct(), *box)
    j = b.join(dealt(f, *ends), ["_bx", "_by"]).where((F.col("_bx") == at(F.greatest("west", "_west"))) & (F.col("_by") == at(F.greatest("south", "_south"))))
    met = j.where("west <= _east and _west <= east and south <= _north and _south <= north").where(polygon_meets_box(F.col("_edges"), *[F.col(k) for k in box]))
    n = met.groupBy(*box).agg(F.sum("_n").alias("scenes"))
    return blocks.join(n, box, "left").select("block", F.when(F.col("land"), F.coalesce("scenes", F.lit(0))).otherwise(0).alias("scenes"))


def _rows_of_tiles(df: DataFrame, tiles: DataFrame, height: int) -> DataFrame:
    """A row of ``df(_a, _b)`` per global pixel row ``y`` from _a to _b that lies in a wanted row of tiles: dealt to tile rows first, so nothing else is exploded."""
    tile_row = F.explode(F.sequence(F.floor(F.col("_a") / height), F.floor(F.col("_b") / height)))
    wanted = df.where("_a <= _b").withColumn("_row", tile_row).join(tiles.select(F.col("row").cast("long").alias("_row")).distinct(), "_row", "left_semi")
    first, last = F.greatest("_a", F.col("_row") * height), F.least("_b", F.col("_row") * height + height - 1)
    return wanted.withColumn("y", F.explode(F.sequence(first, last))).drop("_a", "_b", "_row")


def _pixels_of_runs(runs: DataFrame, tiles: DataFrame, height: int, width: int) -> DataFrame:
    """(tile, y, x, ...) of ``runs(y, _a, _b, ...)``: runs of columns cut at tiles, exploded in the wanted tiles only; y and x count within the tile."""
    cut = runs.where("_a <= _b").withColumns({"_row": F.floor(F.col("y") / height), "_col": F.explode(F.sequence(F.floor(F.col("_a") / width), F.floor(F.col("_b") / width)))})
    j = cut.join(tiles.select("tile", F.col("row").cast("long").alias("_row"), F.col("col").cast("long").alias("_col")), ["_row", "_col"])
    x = F.explode(F.sequence(F.greatest(F.col("_a") - F.col("_col") * width, F.lit(0)), F.least(F.col("_b") - F.col("_col") * width, F.lit(width - 1))).cast("array<bigint>"))
    return j.withColumn("x", x).withColumn("y", (F.col("y") - F.col("_row") * height).cast("long")).drop("_row", "_col", "_a", "_b")


def polygon_runs(edges: DataFrame, tiles: DataFrame, height: int) -> DataFrame:
    """(poly_id, class, y, _a, _b): runs of pixels whose centre lies in a polygon, by rows and even-odd crossings.

    ``edges(poly_id, class, x0, y0, x1, y1)``: one row per side, in global pixel units; the sides of holes and of further parts have their
    polygon's id. A side holds its lower end, not its upper one, so a shared corner counts once.
    """
    low, high = F.least("y0", "y1"), F.greatest("y0", "y1")
    e = edges.where("y0 <> y1").withColumns({"_a": F.ceil(low - 0.5).cast("long"), "_b": (F.ceil(high - 0.5) - 1).cast("long")})
    e = _rows_of_tiles(e, tiles, height)
    at = F.col("x0") + (F.col("y") + 0.5 - F.col("y0")) * (F.col("x1") - F.col("x0")) / (F.col("y1") - F.col("y0"))
    w = Window.partitionBy("poly_id", "y").orderBy("cx")  # the sides that one row of one polygon crosses
    runs = e.withColumn("cx", at).withColumn("_k", F.row_number().over(w)).withColumn("_to", F.lead("cx").over(w)).where("_k % 2 = 1 and _to is not null")
    return runs.select("poly_id", "class", "y", F.ceil(F.col("cx") - 0.5).cast("long").alias("_a"), (F.ceil(F.col("_to") - 0.5) - 1).cast("long").alias("_b"))


def rasterise(edges: DataFrame, tiles: DataFrame, height: int, width: int) -> DataFrame:
    """(tile, y, x, class) over ``tiles(tile, row, col)``: pixels whose centre lies in a polygon; the higher class wins.

    A tile is ``height`` rows and ``width`` columns of the global pixel grid, at its row and column among tiles.
    """
    return _pixels_of_runs(polygon_runs(edges, tiles, height), tiles, height, width).groupBy("tile", "y", "x").agg(F.max("class").alias("class"))


def mercator(lat: Column, radius: float = MERCATOR_RADIUS) -> Column:
    """Northing of a latitude in EPSG:3857."""
    return radius * F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2))


def latitude(northing: Column, radius: float = MERCATOR_RADIUS) -> Column:
    return F.degrees(2 * F.atan(F.exp(northing / radius)) - math.pi / 2)


def _strip(radius: float, at: Column) -> tuple[Column, Column]:
    """Least and greatest x on the line y = ``at`` of what is within ``radius`` of the side (x0, y0, x1, y1): a strip with round ends; null where there is nothing."""
    x0, y0, x1, y1 = (F.col(k) for k in ("x0", "y0", "x1", "y1"))
    length = F.nullif(F.sqrt((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)), F.lit(0.0))
    point = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    aside = F.struct((-(y1 - y0) / length * radius).alias("x"), ((x1 - x0) / length * radius).alias("y"))
    corners = F.transform(F.array(aside), lambda n: F.array(point(x0 + n["x"], y0 + n["y"]), point(x1 + n["x"], y1 + n["y"]), point(x1 - n["x"], y1 - n["y"]), point(x0 - n["x"], y0 - n["y"])))

    def crossing(s):
        return F.when((s["y0"] != s["y1"]) & at.between(F.least(s["y0"], s["y1"]), F.greatest(s["y0"], s["y1"])), s["x0"] + (at - s["y0"]) * (s["x1"] - s["x0"]) / F.nullif(s["y1"] - s["y0"], F.lit(0.0)))

    def disc(sign):
        return lambda p: F.when(F.abs(at - p["y"]) <= radius, p["x"] + sign * F.sqrt(radius * radius - (at - p["y"]) * (at - p["y"])))

    cuts, ends = F.transform(sides(corners), crossing), F.array(point(x0, y0), point(x1, y1))
    return F.array_min(F.concat(cuts, F.transform(ends, disc(-1)))), F.array_max(F.concat(cuts, F.transform(ends, disc(1))))


def _columns(low: Column, high: Column) -> list[Column]:
    """First and last pixel between two x in pixels, by their centres; what is on the edge counts."""
    return [F.ceil(low - 0.5 - 1e-9).cast("long").alias("_a"), F.floor(high - 0.5 + 1e-9).cast("long").alias("_b")]


def buffer_runs(edges: DataFrame, tiles: DataFrame, height: int, metres: float, north: float = NORTH, west: float = -180.0, per_degree: float = PX_PER_DEG) -> DataFrame:
    """C11: (y, _a, _b): runs of pixels whose centre is within ``metres`` of a side, in EPSG:3857.

    ``edges(lon0, lat0, lon1, lat1)``; pixel (0, 0) has its corner at ``north`` and ``west``. A row cuts one run out of what is near a
    side, so rows are exploded, never boxes, however long a side is; runs of a row that overlap are joined before any
    pixel is.
    """
    step = MERCATOR_RADIUS * math.pi / 180
    e = edges.select(*[(F.col(f"lon{i}") * step).alias(f"x{i}") for i in (0, 1)], *[mercator(F.col(f"lat{i}")).alias(f"y{i}") for i in (0, 1)])
    row = lambda northing: (F.lit(float(north)) - latitude(northing)) * per_degree - 0.5
    e = e.withColumns({"_a": F.floor(row(F.greatest("y0", "y1") + metres)).cast("long"), "_b": F.ceil(row(F.least("y0", "y1") - metres)).cast("long")})
    e = _rows_of_tiles(e, tiles, height).withColumn("_at", mercator(F.lit(float(north)) - (F.col("y") + 0.5) / per_degree))
    low, high = _strip(metres, F.col("_at"))
    return join_runs(e.select("y", *_columns((low / step - west) * per_degree, (high / step - west) * per_degree)).where("_a <= _b"))


def near_edges(edges: DataFrame, height: int, width: int, radius: float) -> DataFrame:
    """C11 on one local grid, in pixels: (y, x): pixels whose centre is within ``radius`` of a side; a side's rows are exploded, not its box."""
    first, last = F.greatest(F.floor(F.least("y0", "y1") - radius - 0.5), F.lit(0)), F.least(F.ceil(F.greatest("y0", "y1") + radius), F.lit(height - 1))
    e = edges.withColumns({"_a": first.cast("long"), "_b": last.cast("long")}).where("_a <= _b").withColumn("y", F.explode(F.sequence("_a", "_b")))
    low, high = _strip(radius, F.col("y") + 0.5)
    runs = join_runs(e.select("y", *_columns(low, high)).where("_a <= _b"))
    return runs.withColumns({"_a": F.greatest("_a", F.lit(0)), "_b": F.least("_b", F.lit(width - 1))}).where("_a <= _b").select("y", F.explode(F.sequence("_a", "_b")).alias("x"))


def join_runs(runs: DataFrame) -> DataFrame:
    """(y, _a, _b): runs of each row that overlap or touch as one."""
    w = Window.partitionBy("y").orderBy("_a", "_b")
    before = F.max("_b").over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = runs.distinct().withColumn("_new", F.when(F.col("_a") <= before + 1, 0).otherwise(1))
    grouped = marked.withColumn("_group", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return grouped.groupBy("y", "_group").agg(F.min("_a").alias("_a"), F.max("_b").alias("_b")).drop("_group")


def buffered_mask(polygons: DataFrame, tiles: DataFrame, height: int, width: int, metres: float, north: float = NORTH, west: float = -180.0, per_degree: float = PX_PER_DEG) -> DataFrame:
    """(tile, y, x): pixels in the polygons or within ``metres`` of their sides, of ``polygons(poly_id, class, lon0, lat0, lon1, lat1)``."""
    x, y = lambda c: (F.col(c) - west) * per_degree, lambda c: (F.lit(float(north)) - F.col(c)) * per_degree
    edges = polygons.select("poly_id", "class", x("lon0").alias("x0"), y("lat0").alias("y0"), x("lon1").alias("x1"), y("lat1").alias("y1"))
    runs = polygon_runs(edges, tiles, height).select("y", "_a", "_b").union(buffer_runs(polygons, tiles, height, metres, north, west, per_degree))
    return _pixels_of_runs(join_runs(runs), tiles, height, width).select("tile", "y", "x")


def land_shares(mask: DataFrame, tiles: DataFrame, pixels: int) -> DataFrame:
    """(tile, fraction) of a mask of whole tiles, 0 for tiles without land."""
    n = mask.groupBy("tile").agg(F.count("*").alias("_n"))
    return tiles.select("tile").join(n, "tile", "left").select("tile", (F.coalesce("_n", F.lit(0)) / pixels).alias("fraction"))


def land_fraction(tiles: DataFrame, land: DataFrame) -> DataFrame:
    """(tile, fraction) of ``tiles(tile, y, x)``."""
    j = tiles.join(land.withColumn("_land", F.lit(1.0)), PIXEL, "left")
    return j.groupBy("tile").agg(F.avg(F.coalesce("_land", F.lit(0.0))).alias("fraction"))

"""Tiles, cells, labels and keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..params import NORTH, PX_PER_CELL, PX_PER_DEG, SOUTH, TILE_DEG


def tile_name(lat: Column, lon: Column) -> Column:
    """N05W060 for north edge 5, west edge -60."""
    ns, ew = F.when(lat >= 0, "N").otherwise("S"), F.when(lon >= 0, "E").otherwise("W")
    return F.concat(ns, F.lpad(F.abs(lat).cast("int").cast("string"), 2, "0"), ew, F.lpad(F.abs(lon).cast("int").cast("string"), 3, "0"))


def parse_tile(name: Column) -> tuple[Column, Column]:
    """(lat, lon); null where the name is none."""
    def part(i, minus):
        digits = F.regexp_extract(name, r"^([NS])(\d{2})([EW])(\d{3})$", i + 1)
        sign = F.when(F.regexp_extract(name, r"^([NS])(\d{2})([EW])(\d{3})$", i) == minus, -1).otherwise(1)
        return F.when(digits == "", None).otherwise(digits).cast("int") * sign

    return part(1, "S"), part(3, "W")


def tile_of(lat: Column, lon: Column) -> tuple[Column, Column]:
    """North and west edge of the tile of a point; a tile holds its north edge, not its south one."""
    return (F.ceil(lat / TILE_DEG) * TILE_DEG).cast("int"), (F.floor(lon / TILE_DEG) * TILE_DEG).cast("int")


def bbox(lat: Column, lon: Column) -> Column:
    """B19."""
    return F.struct(lon.alias("west"), (lat - TILE_DEG).alias("south"), (lon + TILE_DEG).alias("east"), lat.alias("north"))


def pixel(lat: Column, lon: Column) -> tuple[Column, Column]:
    """Global row (0 is north) and column; halves go to even."""
    return F.bround((F.lit(NORTH) - lat) * PX_PER_DEG).cast("long"), F.bround((lon + 180) * PX_PER_DEG).cast("long")


def in_bounds(south: Column, north: Column) -> Column:
    """B22."""
    return (south >= SOUTH) & (north <= NORTH)


def cell_of_pixel(row: Column, col: Column) -> tuple[Column, Column]:
    """0.01-degree cell of a global pixel, columns wrapped at the antimeridian."""
    return F.floor(row / PX_PER_CELL).cast("long") + (90 - NORTH) * 100, F.pmod(F.floor(col / PX_PER_CELL).cast("long"), F.lit(36000).cast("long"))


def granule(row: Column, col: Column) -> Column:
    """Name of the 1-degree granule of a cell."""
    lat, lon = 90 - F.floor(row / 100), F.floor(col / 100) - 180
    return F.format_string("%s%02d%s%03d", F.when(lat >= 0, "N").otherwise("S"), F.abs(lat), F.when(lon >= 0, "E").otherwise("W"), F.abs(lon))


def solar_day(ts: Column, centre_lon: Column) -> Column:
    """Local date by 240 seconds a degree."""
    return F.to_date(F.timestamp_seconds(F.unix_timestamp(ts) + F.floor(centre_lon * 240)))


def hilbert(lon: Column, lat: Column, level: int = 16) -> Column:
    """Distance along the Hilbert curve of the globe cut into 2**level rows and columns."""
    n = 1 << level
    at = lambda v, low, width: F.least(F.greatest(F.floor((v - low) / width * n), F.lit(0)), F.lit(n - 1)).cast("long")
    start = F.struct(at(lon, -180, 360).alias("x"), at(lat, -90, 180).alias("y"), F.lit(0).cast("long").alias("d"))

    def step(s: Column, k: Column) -> Column:
        # k is the half-side of this level's square
        rx = F.when(s["x"].bitwiseAND(k) > 0, 1).otherwise(0)
        ry = F.when(s["y"].bitwiseAND(k) > 0, 1).otherwise(0)
        turned = ry == 0
        flip = turned & (rx == 1)
        x, y = F.when(flip, n - 1 - s["x"]).otherwise(s["x"]), F.when(flip, n - 1 - s["y"]).otherwise(s["y"])
        d = s["d"] + k * k * (3 * rx).bitwiseXOR(ry).cast("long")
        return F.struct(F.when(turned, y).otherwise(x).alias("x"), F.when(turned, x).otherwise(y).alias("y"), d.alias("d"))

    halves = F.array(*[F.lit(1 << i).cast("long") for i in range(level - 1, -1, -1)])
    return F.aggregate(halves, start, step, lambda s: s["d"])


def window_label(start: Column, end: Column) -> Column:
    """2021, or 2021-2025."""
    return F.when(start == end, start.cast("string")).otherwise(F.concat_ws("-", start, end))


def tiles(spark: SparkSession, low: int = SOUTH + TILE_DEG, high: int = NORTH) -> DataFrame:
    """A3: all tiles between two latitudes, north edge first."""
    lats = spark.range(low, high + 1, TILE_DEG, 1).withColumnRenamed("id", "lat")
    t = lats.select("lat", F.explode(F.sequence(F.lit(-180), F.lit(180 - TILE_DEG), F.lit(TILE_DEG))).alias("lon"))
    return t.select(tile_name(F.col("lat"), F.col("lon")).alias("name"), F.col("lat").cast("int").alias("lat"), "lon")


def land_tiles(all_tiles: DataFrame, names: DataFrame) -> DataFrame:
    """A4."""
    return all_tiles.join(names.select("name").distinct(), "name", "left_semi")


def jobs(all_tiles: DataFrame, first: int, last: int, window: int) -> DataFrame:
    """A5: a job per tile and window of years; the last window may be cut short by ``last``."""
    starts = F.explode(F.sequence(F.lit(first), F.lit(last), F.lit(window)))
    out = all_tiles.select("name", starts.alias("start"))
    return out.withColumn("end", F.least(F.col("start") + window - 1, F.lit(last))).withColumn("window", window_label(F.col("start"), F.col("end")))


def tiles_of_box(boxes: DataFrame) -> DataFrame:
    """A row per tile that a box (west, south, east, north) meets; edges alone don't count."""
    lat = F.explode(F.sequence((F.floor(F.col("south") / TILE_DEG) * TILE_DEG + TILE_DEG).cast("int"), (F.ceil(F.col("north") / TILE_DEG) * TILE_DEG).cast("int"), F.lit(TILE_DEG)))
    lon = F.explode(F.sequence((F.floor(F.col("west") / TILE_DEG) * TILE_DEG).cast("int"), (F.ceil(F.col("east") / TILE_DEG) * TILE_DEG - TILE_DEG).cast("int"), F.lit(TILE_DEG)))
    return boxes.withColumn("lat", lat).withColumn("lon", lon)


def granules_of_window(windows: DataFrame) -> DataFrame:
    """A row per granule (gr, gc) that a cell window [row0, row1) x [col0, col1) meets, columns wrapped."""
    rows = F.explode(F.sequence(F.floor(F.col("row0") / 100), F.floor((F.col("row1") - 1) / 100)))
    cols = F.explode(F.sequence(F.floor(F.col("col0") / 100), F.floor((F.col("col1") - 1) / 100)))
    return windows.withColumn("gr", rows).withColumn("gc", cols).withColumn("gc", F.pmod("gc", F.lit(360)))

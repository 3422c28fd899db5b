"""Catalog items and collections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.grid import bbox, hilbert, parse_tile
from .normalize import require_empty


def asset_of(name: Column) -> tuple[Column, Column, Column]:
    """(product, window, tile) of lst_p95_2021-2025_N05W060.tif."""
    part = lambda i: F.regexp_extract(name, r"^(lst_p95|qa_count)_(\d{4}(?:-\d{4})?)_([NS]\d{2}[EW]\d{3})\.tif$", i)
    return tuple(F.nullif(part(i), F.lit("")) for i in (1, 2, 3))


def pair_products(files: DataFrame) -> DataFrame:
    """(window, tile, lst, qa); a tile with one product only is an error that names it."""
    p, w, t = asset_of(F.col("name"))
    a = files.select(p.alias("product"), w.alias("window"), t.alias("tile"), "name").where("product is not null")
    lst, qa = (a.where(F.col("product") == k).select("window", "tile", F.col("name").alias(n)) for k, n in (("lst_p95", "lst"), ("qa_count", "qa")))
    both = lst.join(qa, ["window", "tile"], "full")
    require_empty(both.where("lst is null or qa is null"), "a tile lacks a product")
    return both


def build_items(pairs: DataFrame, headers: DataFrame) -> DataFrame:
    """(id, tile, bbox, start, end, assets): headers' bounds must be the tile's within 1e-9 degrees."""
    lat, lon = parse_tile(F.col("tile"))
    box = bbox(lat, lon)
    j = pairs.join(headers, "tile").withColumn("bbox", box)
    off = [F.abs(F.col(f"bbox.{k}") - F.col(k)) > 1e-9 for k in ("west", "south", "east", "north")]
    require_empty(j.where(off[0] | off[1] | off[2] | off[3]).select("tile"), "a file is off its tile's grid")
    years = F.split("window", "-")
    assets = F.create_map(F.lit("lst_p95"), F.struct(F.col("lst").alias("href")), F.lit("qa_count"), F.struct(F.col("qa").alias("href")))
    return j.select(F.concat_ws("_", "tile", "window").alias("id"), "tile", "bbox", years[0].cast("int").alias("start"), F.element_at(years, -1).cast("int").alias("end"), assets.alias("assets"))


def extent(items: DataFrame) -> DataFrame:
    """The items' union box and years; the globe where there is none."""
    a = items.agg(*[f(f"bbox.{k}").alias(k) for f, k in ((F.min, "west"), (F.min, "south"), (F.max, "east"), (F.max, "north"))], F.min("start").alias("start"), F.max("end").alias("end"))
    return a.select(*[F.coalesce(k, F.lit(v)).alias(k) for k, v in (("west", -180), ("south", -90), ("east", 180), ("north", 90))], "start", "end")


def hilbert_sorted(items: DataFrame, partitions: int | None = None) -> DataFrame:
    """Items along the Hilbert curve of their boxes' midpoints, ties by id."""
    d = hilbert((F.col("bbox.west") + F.col("bbox.east")) / 2, (F.col("bbox.south") + F.col("bbox.north")) / 2)
    out = items.withColumn("hilbert", d)
    out = out.repartitionByRange(partitions, "hilbert", "id") if partitions else out.repartitionByRange("hilbert", "id")
    return out.sortWithinPartitions("hilbert", "id")


def write_items(items: DataFrame, path: str) -> None:
    """The item table in that order, at most 50,000 rows a file."""
    hilbert_sorted(items).drop("hilbert").write.mode("overwrite").option("maxRecordsPerFile", 50_000).parquet(path)

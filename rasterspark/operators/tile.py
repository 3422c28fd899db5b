"""Whole tiles: from observations and jobs to masked, packed composites."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.quality import encode
from ..params import HOT_C, Params
from ..sources.storage import written
from . import composite as c
from . import masks as m
from . import normalize as n
from . import series


def store_observations(obs: DataFrame, path: str) -> None:
    """Observations by tile and year, a folder each, so that a scan for some jobs opens only theirs."""
    obs.withColumn("year", F.year("scene_ts")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("tile", "year").parquet(path)


def of_jobs(obs: DataFrame, jobs: DataFrame) -> DataFrame:
    """Observations of the jobs ``(tile, window, start, end)``; tile becomes <tile>/<window>, so a job is a group of its own.

    An observation belongs to every job of its tile whose years hold it. Jobs meet it by tile and year, so of a table that
    ``store_observations`` wrote, Spark's dynamic pruning opens the jobs' folders only.
    """
    j = jobs.select(F.col("tile").alias("_tile"), "window", F.explode(F.sequence("start", "end")).alias("_year"))
    year = F.col("year") if "year" in obs.columns else F.year("scene_ts")
    met = obs.join(j, (F.col("tile") == F.col("_tile")) & (year == F.col("_year")))
    return met.withColumn("tile", F.concat_ws("/", "tile", "window")).drop("_tile", "window", "_year", "year")


def land_of_jobs(land: DataFrame, jobs: DataFrame) -> DataFrame:
    """Land pixels of each job."""
    return land.join(jobs.select("tile", "window"), "tile").select(F.concat_ws("/", "tile", "window").alias("tile"), "y", "x")


def tile_offsets(dn: DataFrame, params: Params = Params()) -> DataFrame:
    """The offset table of all scenes of ``dn``, written: a row per scene."""
    return written(n.offsets(n.anomalies(dn, n.climatology(dn)), params), "offsets")


def process(obs: DataFrame, jobs: DataFrame, land: DataFrame, gap_cells: DataFrame, params: Params = Params(), factor: int = 1, cell: int = 36, hot: float = HOT_C, max_scenes: int = series.MAX_SCENES) -> DataFrame:
    """(tile, window, y, x, lst, lst_dn, n, m1 ... m12, scene_count): a row per land pixel of each job.

    Offsets are estimated over land, on the native grid or one ``factor`` times coarser, before any gap mask. Values that
    are hot in a gap go; counts stay. The valid observations are shuffled once, to a row per pixel that is written and read
    by estimate and composite; beyond ``max_scenes`` scenes, whose offsets tasks could not all hold, they stay rows.
    """
    ours, ground = of_jobs(obs, jobs), land_of_jobs(land, jobs)
    rows = series.series(ours, ground)
    if factor > 1:
        centre = (F.col("y") % factor == factor // 2) & (F.col("x") % factor == factor // 2)
        coarse_land = ground.where(centre).select("tile", *[F.floor(F.col(k) / factor).cast("long").alias(k) for k in ("y", "x")])
        coarse = n.stack(n.coarsen(ours, factor).withColumns({"lwir11": F.round("lwir11").cast("long"), "rank": F.lit(0).cast("long")}))
        estimate = m.mask_land(coarse, coarse_land)
        table = tile_offsets(estimate, params.on_grid(factor))
    else:
        table = series.offsets(rows, params)
    # a scene of which nothing is left to estimate from is dropped like one that is too sparse
    if table.count() <= max_scenes:
        comp = series.composite(rows, table, strict=factor == 1)
    else:
        dn = written(m.mask_land(n.stack(ours), ground).join(table.select(*n.SCENE), n.SCENE, "left_semi"), "stack")
        comp = c.composite(n.debias(dn, table))
    comp = ground.join(comp, n.PIXEL, "left")
    counts = ["n", *[f"m{k}" for k in c.MONTHS]]
    comp = comp.withColumns({k: F.coalesce(k, F.lit(0).cast("long")) for k in counts})
    comp = m.mask_gaps(m.flag_gap(m.with_cell(comp, cell), gap_cells), hot).drop("row", "col", "in_gap")
    scenes = table.groupBy("tile").agg(F.count("*").alias("scene_count"))
    key = F.split("tile", "/")
    return comp.join(scenes, "tile", "left").select(key[0].alias("tile"), key[1].alias("window"), "y", "x", "lst", encode(F.round("lst", 6)).alias("lst_dn"), *counts, F.coalesce("scene_count", F.lit(0).cast("long")).alias("scene_count"))

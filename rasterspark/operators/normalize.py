"""Scene normalisation.

Counts stay integers to the end: temperature is affine in them, and medians and interpolated percentiles
commute with that. A reference is twice a median (half counts), an offset a sum of two middle anomalies
(quarter counts); Celsius comes last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.quality import clear, plausible
from ..params import DN_SCALE, PLATFORMS, Params
from ..sources.storage import bucketed

#: What a pixel and a scene are known by. ``tile`` may also name a tile and window, as of a job.
PIXEL, SCENE = ["tile", "y", "x"], ["tile", "scene_ts"]


def require_empty(df: DataFrame, what: str) -> None:
    """Raise with the first row of ``df``, if there is one."""
    row = df.limit(1).collect()
    if row:
        raise ValueError(f"{what}: {row[0].asDict()}")


def meets_box(west: float, south: float, east: float, north: float) -> Column:
    """Whether a row's box (west, south, east, north) and a given one share a point; a box whose west is above its east runs over the antimeridian."""
    over = F.col("west") > F.col("east")
    if west > east:
        lon = over | (F.col("east") >= west) | (F.col("west") <= east)
    else:
        lon = F.when(over, (F.col("west") <= east) | (F.col("east") >= west)).otherwise((F.col("west") <= east) & (F.col("east") >= west))
    return lon & (F.col("south") <= north) & (F.col("north") >= south)


def search(scenes: DataFrame, west: float, south: float, east: float, north: float, first: str, last: str, params: Params = Params()) -> DataFrame:
    """A1: scenes whose box meets a given one, of the days ``first`` to ``last`` (both whole), below the cloud limit (strictly), of the wanted platforms."""
    days = (F.col("datetime") >= F.lit(first).cast("timestamp")) & (F.col("datetime") < F.date_add(F.lit(last).cast("date"), 1).cast("timestamp"))
    return scenes.where(meets_box(west, south, east, north) & days & (F.col("cloud") < params.max_cloud) & F.col("platform").isin(*PLATFORMS))


def sample_scenes(scenes: DataFrame, n: int) -> DataFrame:
    """E5: n scenes evenly over time, those at int(i * N / n); all where there are no more than n."""
    days = scenes.groupBy(F.to_date("datetime").alias("_day")).agg(F.count("*").alias("_k"))
    before = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)  # a row per day
    first = days.select("_day", F.coalesce(F.sum("_k").over(before), F.lit(0)).alias("_first"))
    total = scenes.count()
    if total <= n:
        return scenes
    in_day = F.row_number().over(Window.partitionBy("_day").orderBy("datetime", "item_id")) - 1
    numbered = scenes.withColumn("_day", F.to_date("datetime")).withColumn("_at", in_day).join(first, "_day").withColumn("_at", F.col("_at") + F.col("_first"))
    wanted = scenes.sparkSession.range(n).select(F.floor(F.col("id") * total / n).cast("long").alias("_at"))
    return numbered.join(F.broadcast(wanted), "_at", "left_semi").drop("_at", "_day", "_first")  # n rows, a parameter


def resolve(scenes: DataFrame, n: int | None = None) -> DataFrame:
    """A2: the scene set of a run, not empty."""
    if scenes.isEmpty():
        raise ValueError("no scenes for this box and these dates")
    return scenes if n is None else sample_scenes(scenes, n)


def stack(obs: DataFrame) -> DataFrame:
    """(tile, scene_ts, y, x, dn), of several observations of a scene and pixel the first valid one by ``rank``, the least count where ranks tie.

    ``rank`` is the item's place in its scene, a whole number below 2**46; with the count in its low bits one long is kept
    per pixel, so the grouping combines before the shuffle and never sorts.
    """
    valid = obs.where(plausible(F.col("lwir11")) & clear(F.col("qa_pixel")))
    first = F.min(F.shiftleft(F.col("rank").cast("long"), 16).bitwiseOR(F.col("lwir11").cast("long")))
    return valid.groupBy(*SCENE, "y", "x").agg(first.bitwiseAND(F.lit(65535)).cast("int").alias("dn"))


def coarsen(obs: DataFrame, factor: int) -> DataFrame:
    """Blocks of factor x factor pixels: the mean of their non-zero counts, the quality of the centre one."""
    centre = (F.col("y") % factor == factor // 2) & (F.col("x") % factor == factor // 2)
    block = [F.floor(F.col(c) / factor).cast("long").alias(c) for c in ("y", "x")]
    agg = obs.groupBy(*SCENE, *block).agg(F.avg(F.nullif("lwir11", F.lit(0))).alias("lwir11"), F.min(F.when(centre, F.col("qa_pixel"))).alias("qa_pixel"))
    return agg.where("lwir11 is not null and qa_pixel is not null")


#: What a climatology is grouped and joined by.
PIXEL_MONTH = [*PIXEL, "month"]


def _with_month(dn: DataFrame) -> DataFrame:
    return dn if "month" in dn.columns else dn.withColumn("month", F.month("scene_ts"))


def stack_by_pixel(dn: DataFrame, buckets: int | None = None) -> DataFrame:
    """``stack`` with the month, written in buckets by pixel and month: climatology and anomalies then read it where it is, without a shuffle."""
    return bucketed(_with_month(dn), "stack", PIXEL_MONTH, buckets)


def climatology(dn: DataFrame) -> DataFrame:
    """(tile, y, x, month, ref2): twice the median count of a pixel and month over all years."""
    return _with_month(dn).groupBy(*PIXEL_MONTH).agg((2 * F.median("dn")).cast("long").alias("ref2"))


def anomalies(dn: DataFrame, clim: DataFrame) -> DataFrame:
    """(tile, scene_ts, y, x, dn, anom2): twice the count less its pixel-month reference."""
    return _with_month(dn).join(clim, PIXEL_MONTH).select("scene_ts", *PIXEL, "dn", (2 * F.col("dn") - F.col("ref2")).alias("anom2"))


def offsets(anom: DataFrame, params: Params = Params()) -> DataFrame:
    """(tile, scene_ts, n_valid, offset4, offset_c, keep): the median anomaly of each scene, in quarter counts.

    Exact by histogram: anomalies are integers, so a scene has a bounded number of different ones; they are counted
    before the shuffle and the two middle ones are read off the running count.
    """
    return offsets_of_histogram(anom.groupBy(*SCENE, "anom2").agg(F.count("*").alias("n")), params)


def offsets_of_histogram(hist: DataFrame, params: Params = Params()) -> DataFrame:
    """D2-D4 from ``hist(tile, scene_ts, anom2, n)``."""
    run = Window.partitionBy(*SCENE).orderBy("anom2")
    every = Window.partitionBy(*SCENE)
    at = hist.select(*SCENE, "anom2", "n", F.sum("n").over(run).alias("upto"), F.sum("n").over(every).alias("total"))
    low, high = F.floor((F.col("total") + 1) / 2), F.floor(F.col("total") / 2) + 1
    holds = lambda k: F.max(F.when((F.col("upto") >= k) & (F.col("upto") - F.col("n") < k), F.col("anom2")))
    out = at.groupBy(*SCENE).agg(F.max("total").alias("n_valid"), (holds(low) + holds(high)).alias("offset4"))
    c = F.col("offset4") / 4 * F.lit(DN_SCALE)
    return out.withColumn("offset_c", c).withColumn("keep", keep(c, F.col("n_valid"), params))


def keep(offset_c: Column, n_valid: Column, params: Params = Params()) -> Column:
    """Enough pixels behind the offset and a believable size of it, both inclusive."""
    return F.coalesce(offset_c.isNotNull() & (n_valid >= params.floor) & (F.abs(offset_c) <= params.cap), F.lit(False))


def debias(dn: DataFrame, table: DataFrame) -> DataFrame:
    """(tile, scene_ts, y, x, v4): quarter counts less the scene's offset, of kept scenes; joined by tile and time, never by place.

    An empty table and one that keeps nothing are errors at once. A scene without a row in ``table`` is an error when the
    result is computed, so the observations are read for it no extra time. ``table``: a row per scene, already written.
    """
    rows, kept = table.agg(F.count("*"), F.count_if("keep")).first()
    if not rows:
        raise ValueError("a scene has no offset: the table is empty")
    if not kept:
        raise ValueError("every scene is rejected")
    j = dn.join(table.select(*SCENE, "offset4", F.coalesce("keep", F.lit(False)).alias("_keep")), SCENE, "left")
    checked = F.when(F.col("_keep").isNull(), F.raise_error(F.concat(F.lit("a scene has no offset: "), F.col("scene_ts").cast("string"))).cast("boolean")).otherwise(F.col("_keep"))
    return j.where(checked).select("scene_ts", *PIXEL, (4 * F.col("dn") - F.col("offset4")).alias("v4"))


def diagnostics(table: DataFrame) -> DataFrame:
    """Of the offsets of all scenes."""
    o = F.col("offset_c")
    p = F.percentile(o, F.array(F.lit(0.01), F.lit(0.5), F.lit(0.99)))
    a = table.agg(F.count("*").alias("n_scenes"), F.count_if("keep").alias("n_kept"), F.avg((~F.col("keep")).cast("double")).alias("rejected"), F.stddev_pop(o).alias("std"), F.min(o).alias("min"), F.max(o).alias("max"), p.alias("p"))
    return a.select("n_scenes", "n_kept", "rejected", "std", "min", "max", F.col("p")[0].alias("p01"), F.col("p")[1].alias("p50"), F.col("p")[2].alias("p99"))


def digest(items: DataFrame, settings: str) -> DataFrame:
    """(digest): the first 16 hex digits over the sorted ids and the settings; of one job's scenes, some thousands."""
    ids = F.array_join(F.array_sort(F.collect_list(F.col("item_id").cast("string"))), "\n")
    return items.agg(F.substring(F.sha2(F.concat_ws("\n", ids, F.lit(settings)), 256), 1, 16).alias("digest"))


def store_offsets(table: DataFrame, path: str, window: str, key: str) -> None:
    """A partition per window, digest and tile; writing again replaces these partitions only."""
    rows = table.withColumns({"window": F.lit(window), "digest": F.lit(key)})
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("window", "digest", "tile").parquet(path)


def lookup_offsets(scenes: DataFrame, path: str, window: str, key: str) -> DataFrame | None:
    """The stored table, if it has exactly the scenes of ``scenes(tile, scene_ts)``."""
    stored = scenes.sparkSession.read.parquet(path).where((F.col("window") == window) & (F.col("digest") == key)).drop("window", "digest")
    both = stored.select(*SCENE).withColumn("a", F.lit(1)).join(scenes.select(*SCENE).distinct().withColumn("b", F.lit(1)), SCENE, "full")
    return stored if both.where("a is null or b is null").isEmpty() else None


def merge_partials(partials: list[DataFrame], scenes: DataFrame) -> DataFrame:
    """The union of partial tables over exactly the scenes of ``scenes(tile, scene_ts)``; missing, doubled and foreign scenes are errors."""
    out = partials[0]
    for p in partials[1:]:
        if set(p.columns) != set(out.columns):
            raise ValueError("partial tables differ in their columns")
        out = out.unionByName(p)
    require_empty(out.groupBy(*SCENE).count().where("count > 1"), "a scene is in several partial tables")
    require_empty(out.join(scenes, SCENE, "left_anti").select(*SCENE), "a scene is not of this run")
    require_empty(scenes.join(out, SCENE, "left_anti").select(*SCENE), "a scene is missing")
    return out


def match_times(stored: DataFrame, scenes: DataFrame) -> DataFrame:
    """Stored rows with the run's times: exact ones, else cut to seconds where that is one to one."""
    if scenes.join(stored, SCENE, "left_anti").isEmpty():
        return stored.join(scenes, SCENE, "left_semi")
    cut = scenes.select("tile", F.col("scene_ts").alias("_exact"), F.date_trunc("second", "scene_ts").alias("scene_ts"))
    require_empty(cut.groupBy(*SCENE).count().where("count > 1"), "two scenes share a second")
    return stored.join(cut, SCENE).withColumn("scene_ts", F.col("_exact")).drop("_exact")


def annual_offsets(dn: DataFrame, least: int = 500) -> DataFrame:
    """An earlier variant: anomalies against one median per pixel, offset 0 unless more than ``least`` pixels are behind it."""
    ref = dn.groupBy(*PIXEL).agg((2 * F.median("dn")).cast("long").alias("ref2"))
    table = offsets(dn.join(ref, PIXEL).select("scene_ts", *PIXEL, "dn", (2 * F.col("dn") - F.col("ref2")).alias("anom2")))
    return table.withColumn("offset4", F.when(F.col("n_valid") > least, F.col("offset4")).otherwise(0)).withColumn("keep", F.lit(True))


def lenient_offsets(table: DataFrame, least: int = 500) -> DataFrame:
    """An earlier variant: sparse scenes stay, unshifted."""
    return table.withColumn("offset4", F.when(F.col("n_valid") > least, F.col("offset4")).otherwise(0)).withColumn("keep", F.lit(True))

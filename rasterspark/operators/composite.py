"""Percentile composites and their summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.quality import decode, encode, floor_guard, season, summer
from ..params import DN_OFFSET, DN_SCALE, KELVIN, PACK_OFFSET, PACK_SCALE
from .normalize import PIXEL, require_empty

MONTHS = range(1, 13)


def from_quarters(v4: Column) -> Column:
    """Quarter counts to Celsius."""
    return v4 / 4 * F.lit(DN_SCALE) + F.lit(DN_OFFSET) - F.lit(KELVIN)


def composite(values: DataFrame, q: float = 0.95) -> DataFrame:
    """(tile, y, x, lst, n, m1 ... m12): one grouping; months without observations count 0."""
    month = F.month("scene_ts")
    aggs = [F.percentile("v4", F.lit(q)).alias("v"), F.count("*").alias("n"), *[F.count_if(month == m).alias(f"m{m}") for m in MONTHS]]
    out = values.groupBy(*PIXEL).agg(*aggs)
    return out.select(*PIXEL, floor_guard(from_quarters(F.col("v")), F.col("n")).alias("lst"), "n", *[f"m{m}" for m in MONTHS])


def percentiles(values: DataFrame, qs: tuple = (0.5, 0.75, 0.9, 0.95)) -> DataFrame:
    """Several percentiles of each pixel in one pass."""
    p = values.groupBy(*PIXEL).agg(F.percentile("v4", F.array(*[F.lit(q) for q in qs])).alias("p"))
    return p.select(*PIXEL, *[from_quarters(F.col("p")[i]).alias(f"p{round(q * 100):02d}") for i, q in enumerate(qs)])


def write_composite(comp: DataFrame, path: str, window: str) -> None:
    """A10: packed values and counts, a partition per window and tile; writing again replaces the tiles that ``comp`` has."""
    rows = comp.withColumn("lst_dn", encode(F.col("lst"))).drop("lst").withColumn("window", F.lit(window))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("window", "tile").parquet(path)


def coverage(comp: DataFrame) -> DataFrame:
    """(min, median, max, zero_fraction) of the pixels' numbers of observations, exact from their histogram."""
    hist = comp.groupBy("n").agg(F.count("*").alias("k"))
    return hist.agg(F.min("n").alias("min_n"), F.percentile("n", F.lit(0.5), F.col("k")).alias("median_n"), F.max("n").alias("max_n"), (F.coalesce(F.sum(F.when(F.col("n") == 0, F.col("k"))), F.lit(0)) / F.sum("k")).alias("zero_fraction"))


def _zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0)).cast("double")


def band_stats(comp: DataFrame, col: str = "lst_dn", nodata: int | None = 0) -> DataFrame:
    """Of the band's values but ``nodata``; a band without nodata keeps its zeros; zeros where there is none."""
    v = F.col(col) if nodata is None else F.nullif(F.col(col), F.lit(nodata))
    return comp.agg(_zero(F.min(v)).alias("min"), _zero(F.max(v)).alias("max"), _zero(F.avg(v)).alias("mean"), _zero(F.stddev_pop(v)).alias("stddev"), _zero(100 * F.count(v) / F.nullif(F.count("*"), F.lit(0))).alias("valid_percent"))


def band_table(comp: DataFrame, bands: dict[str, int | None]) -> DataFrame:
    """(tile, band, min, max, mean, stddev, valid_percent): the same for several bands of each tile in one pass; ``bands``: their nodata or None."""
    value = lambda c, none: F.col(c).cast("double") if none is None else F.nullif(F.col(c).cast("double"), F.lit(float(none)))
    rows = comp.select("tile", F.explode(F.array(*[F.struct(F.lit(c).alias("band"), value(c, none).alias("v")) for c, none in bands.items()])).alias("b")).select("tile", "b.*")
    return rows.groupBy("tile", "band").agg(_zero(F.min("v")).alias("min"), _zero(F.max("v")).alias("max"), _zero(F.avg("v")).alias("mean"), _zero(F.stddev_pop("v")).alias("stddev"), (100 * F.count("v") / F.count("*")).alias("valid_percent"))


def reader_stats(stats: DataFrame) -> DataFrame:
    """The same in degrees: mean and extremes scaled and shifted, the spread scaled only."""
    shift = lambda c: (F.col(c) * PACK_SCALE + PACK_OFFSET).alias(c)
    return stats.select(shift("mean"), shift("min"), shift("max"), (F.col("stddev") * PACK_SCALE).alias("stddev"), "valid_percent")


def summary(comp: DataFrame) -> DataFrame:
    """D62."""
    return comp.agg(F.count("*").alias("pixels"), F.count("lst").alias("valid"), F.min("lst").alias("min_c"), F.max("lst").alias("max_c"), F.avg("lst").alias("mean_c"), F.sum("n").alias("observations"))


# What medians of a believable composite keep to (C).
UNIFORM_STD, PLAUSIBLE, MEAN_PLAUSIBLE = 0.1, (-20.0, 80.0), (10.0, 50.0)


def plausibility(values: DataFrame) -> DataFrame:
    """(tile, valid, reason, min, max, mean, std, physically_plausible, mean_reasonable) of the pixels' medians; a value of 0 is none.

    Medians that hardly differ are an error by themselves: they are judged no further.
    """
    v = F.nullif(F.col("p50"), F.lit(0.0))
    a = percentiles(values, (0.5,)).groupBy("tile").agg(F.count(v).alias("n"), F.min(v).alias("min"), F.max(v).alias("max"), F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"))
    judged = F.col("std") >= UNIFORM_STD
    physical = F.when(judged, (F.col("min") >= PLAUSIBLE[0]) & (F.col("max") <= PLAUSIBLE[1]))
    mean = F.when(judged, F.col("mean").between(*MEAN_PLAUSIBLE))
    reason = F.when(F.col("n") == 0, "no valid pixels").when(~judged, "uniform values")
    return a.select("tile", F.coalesce(physical & mean, F.lit(False)).alias("valid"), reason.alias("reason"), "min", "max", F.when(judged, F.col("mean")).alias("mean"), "std", physical.alias("physically_plausible"), mean.alias("mean_reasonable"))


def overview(level: DataFrame, value: str = "lst_dn", count: str = "n") -> DataFrame:
    """The next pyramid level on the global grid: mean of valid values, mean of counts with zeros."""
    block = [F.floor(F.col(c) / 2).cast("long").alias(c) for c in ("y", "x")]
    return level.groupBy("tile", *block).agg(F.coalesce(F.avg(F.nullif(F.col(value), F.lit(0))), F.lit(0.0)).alias(value), F.avg(count).alias(count))


def pyramid_health(native: DataFrame, level: DataFrame, count: str = "n") -> DataFrame:
    """Whether a level's mean is within max(1, 20 %) of the native one and not all zero."""
    a, b = native.agg(F.avg(count).alias("native")), level.agg(F.avg(count).alias("level"), F.max(count).alias("most"))
    both = a.withColumn("k", F.lit(1)).join(b.withColumn("k", F.lit(1)), "k").drop("k")
    return both.select("native", "level", ((F.abs(F.col("level") - F.col("native")) <= F.greatest(F.lit(1.0), 0.2 * F.col("native"))) & (F.col("most") > 0)).alias("healthy"))


FACTORS = (2, 4, 8, 16, 32, 64)
COUNTS = tuple(f"m{m}" for m in MONTHS)


def pyramid(native: DataFrame, factors: tuple = FACTORS, value: str = "lst_dn", counts: tuple = COUNTS) -> DataFrame:
    """(tile, factor, y, x, value, counts): all levels of the pyramid at once, each from the native pixels: mean of valid values, means of counts with zeros.

    A pixel is expanded to its block of each level and the blocks are grouping sets of one aggregation, which combines
    before its only shuffle. Blocks are cut on the global grid.
    """
    at = {f"{c}{f}": F.floor(F.col(c) / f).cast("long") for f in factors for c in ("y", "x")}
    sets = [["tile", f"y{f}", f"x{f}"] for f in factors]
    means = [F.coalesce(F.avg(F.nullif(F.col(value), F.lit(0))), F.lit(0.0)).alias(value), *[F.avg(c).alias(c) for c in counts]]
    level = F.coalesce(*[F.when(F.grouping(f"y{f}") == 0, f) for f in factors])
    g = native.select("tile", value, *counts, *[v.alias(k) for k, v in at.items()]).groupingSets(sets, "tile", *at).agg(*means, level.alias("factor"))
    return g.select("tile", "factor", F.coalesce(*[f"y{f}" for f in factors]).alias("y"), F.coalesce(*[f"x{f}" for f in factors]).alias("x"), value, *counts)


def pyramid_report(native: DataFrame, levels: DataFrame, factors: tuple = FACTORS, counts: tuple = COUNTS) -> DataFrame:
    """(tile, band, factor, native, mean, nonzero, problem) of each count band at each level.

    A level is missing, has collapsed to zeros, or has drifted: its mean is more than max(1, 20 %) off the band's native one; else
    problem is null.
    """
    base = band_table(native, dict.fromkeys(counts)).select("tile", "band", F.col("mean").alias("native"), F.explode(F.array(*map(F.lit, factors))).alias("factor"))
    rows = levels.select("tile", "factor", F.explode(F.array(*[F.struct(F.lit(c).alias("band"), F.col(c).alias("v")) for c in counts])).alias("b")).select("tile", "factor", "b.*")
    seen = rows.groupBy("tile", "band", "factor").agg(F.avg("v").alias("mean"), F.avg((F.col("v") != 0).cast("double")).alias("nonzero"))
    off = F.abs(F.col("mean") - F.col("native")) > F.greatest(F.lit(1.0), 0.2 * F.col("native"))
    problem = F.when(F.col("mean").isNull(), "missing").when(F.col("nonzero") == 0, "collapsed").when(off, "drifted")
    return base.join(seen, ["tile", "band", "factor"], "left").select("tile", "band", "factor", "native", "mean", "nonzero", problem.alias("problem"))


def preview(comp: DataFrame, step: int = 4) -> DataFrame:
    """The centre pixel of each block, decoded."""
    at = comp.where((F.col("y") % step == step // 2) & (F.col("x") % step == step // 2))
    return at.select("tile", *[F.floor(F.col(c) / step).cast("long").alias(c) for c in ("y", "x")], decode(F.col("lst_dn")).alias("lst"))


def merge_bands(bands: list[DataFrame], height: int) -> DataFrame:
    """Row bands to one tile: equal columns, rows without gap or overlap, the claimed height."""
    out = bands[0].withColumn("_band", F.lit(0))
    for i, b in enumerate(bands[1:], 1):
        if b.dtypes != bands[0].dtypes:
            raise ValueError("bands differ in columns or types")
        out = out.unionByName(b.withColumn("_band", F.lit(i)))
    ends = out.groupBy("_band").agg(F.min("y").alias("lo"), F.max("y").alias("hi"))
    run = ends.withColumn("before", F.lag("hi").over(Window.orderBy("lo")))  # a row per band
    require_empty(run.where("before is not null and lo <> before + 1"), "bands leave a gap or overlap")
    require_empty(ends.agg((F.max("hi") - F.min("lo") + 1).alias("height")).where(F.col("height") != height), "bands have another height")
    return out.drop("_band")


def scene_days(dn: DataFrame) -> DataFrame:
    """(month, season, days): scene days of all twelve months, 0 where there are none."""
    got = dn.select("scene_ts").distinct().groupBy(F.month("scene_ts").alias("month")).agg(F.count("*").alias("days"))
    every = dn.sparkSession.range(1, 13).select(F.col("id").cast("int").alias("month"))
    return every.join(got, "month", "left").select("month", season(F.col("month")).alias("season"), F.coalesce("days", F.lit(0)).alias("days"))


def class_counts(dn: DataFrame, classes: DataFrame, scenes: DataFrame) -> DataFrame:
    """(tile, class, period, mean_pixels): valid pixels of a scene by class, averaged over the scenes of each month and of summer and the rest.

    ``scenes(tile, scene_ts)``: all scenes; one without a pixel of a class counts 0. ``period``: 1 to 12, summer or non_summer.
    """
    per = dn.join(classes, PIXEL).groupBy("tile", "scene_ts", "class").agg(F.count("*").alias("pixels"))
    every = scenes.select("tile", "scene_ts").distinct().join(classes.select("tile", "class").distinct(), "tile")
    month = F.month("scene_ts")
    filled = every.join(per, ["tile", "scene_ts", "class"], "left").select("tile", "class", F.coalesce("pixels", F.lit(0)).alias("pixels"), month.cast("string").alias("month"), F.when(summer(month), "summer").otherwise("non_summer").alias("part"))
    g = filled.groupingSets([["tile", "class", "month"], ["tile", "class", "part"]], "tile", "class", "month", "part").agg(F.avg("pixels").alias("mean_pixels"))
    return g.select("tile", "class", F.coalesce("month", "part").alias("period"), "mean_pixels")


def summer_delta(values: DataFrame, classes: DataFrame) -> DataFrame:
    """(class, pixels, annual, summer, delta): class medians of annual and summer-only 95th percentiles."""
    hot = F.when(summer(F.month("scene_ts")), F.col("v4"))
    per = values.groupBy(*PIXEL).agg(F.percentile("v4", F.lit(0.95)).alias("a"), F.percentile(hot, F.lit(0.95)).alias("s"))
    by = per.join(classes, PIXEL).groupBy("class").agg(F.count("*").alias("pixels"), F.median(from_quarters(F.col("a"))).alias("annual"), F.median(from_quarters(F.col("s"))).alias("summer"))
    return by.withColumn("delta", F.col("summer") - F.col("annual"))


def window_metrics(comp: DataFrame, land: DataFrame) -> DataFrame:
    """Land pixels, of these without value, and for each month the median count and percent of zeros."""
    c = land.join(comp, PIXEL, "left")
    aggs = []
    for m in MONTHS:
        n = F.coalesce(F.col(f"m{m}"), F.lit(0))
        aggs += [F.median(n).alias(f"median_m{m}"), (100 * F.avg((n == 0).cast("double"))).alias(f"zero_m{m}")]
    return c.agg(F.count("*").alias("land"), F.count_if(F.col("lst").isNull()).alias("gaps"), F.avg(F.col("lst").isNull().cast("double")).alias("gap_fraction"), *aggs)


def striping(comp: DataFrame, land: DataFrame) -> DataFrame:
    """(tile, striping): spread of the columns' mean counts over their mean, over land; land without observations counts 0; 0 where all is 0."""
    c = land.join(comp.select(*PIXEL, "n"), PIXEL, "left").groupBy("tile", "x").agg(F.avg(F.coalesce("n", F.lit(0))).alias("c"))
    return c.groupBy("tile").agg(F.coalesce(F.stddev_pop("c") / F.nullif(F.avg("c"), F.lit(0.0)), F.lit(0.0)).alias("striping"))

"""Validation sweeps and comparisons.

Parameter values are exploded onto the rows they are tried on; no rows are joined with one another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.grid import solar_day
from ..params import Params
from . import normalize as n

PIXEL = n.PIXEL


def each(values: tuple) -> Column:
    """A row per parameter value."""
    return F.explode(F.array(*[F.lit(v) for v in values]))


def correlation(x: Column, y: Column) -> Column:
    """Pearson's over the pairs that have both: NaN where either is constant, null where there is no pair.

    Constant is what has one value, since sums of squares merged from several tasks may miss zero by rounding. ``F.corr`` divides by zero there.
    """
    at = lambda c: F.when(x.isNotNull() & y.isNotNull(), c)
    flat = (F.min(at(x)) == F.max(at(x))) | (F.min(at(y)) == F.max(at(y)))
    spread = F.nullif(F.sqrt(F.regr_sxx(y, x)) * F.sqrt(F.regr_syy(y, x)), F.lit(0.0))
    return F.when(flat, F.lit(float("nan"))).otherwise(F.regr_sxy(y, x) / spread)


def cap_sweep(table: DataFrame, caps: tuple, floor: int) -> DataFrame:
    """(cap, kept, rejected) scenes."""
    ok = (F.col("n_valid") >= floor) & (F.abs("offset_c") <= F.col("cap"))
    return table.withColumn("cap", each(caps)).groupBy("cap").agg(F.count_if(ok).alias("kept"), F.count_if(~ok).alias("rejected"))


def solar_day_cover(items: DataFrame, centre_lon: float) -> DataFrame:
    """(day, n, cover, first_ts): items of one solar day are one step, stamped by its first item."""
    return items.groupBy(solar_day(F.col("datetime"), F.lit(centre_lon)).alias("day")).agg(F.count("*").alias("n"), F.avg("cloud").alias("cover"), F.min("datetime").alias("first_ts"))


def scene_cover(items: DataFrame, centre_lon: float) -> DataFrame:
    """(scene_ts, cover): mean cloud cover of the items behind each solar-day scene."""
    return solar_day_cover(items, centre_lon).select(F.col("first_ts").alias("scene_ts"), "cover")


def align_cover(cover: DataFrame, times: DataFrame) -> DataFrame:
    """C14: cover on exactly the given times, else an error."""
    n.require_empty(times.join(cover, "scene_ts", "left_anti"), "a time has no cover")
    n.require_empty(cover.join(times, "scene_ts", "left_anti"), "a cover has no time")
    return cover


def cloud_tradeoff(table: DataFrame, cover: DataFrame, thresholds: tuple) -> DataFrame:
    """A row per tile and threshold: scenes a cloud threshold drops, those of them that normalisation rejects already, and the observations lost; each also as a share."""
    out = table.join(cover, "scene_ts").withColumn("threshold", each(thresholds))
    gone = F.col("cover") >= F.col("threshold")
    lost = lambda c: F.coalesce(F.sum(F.when(c & F.col("keep"), F.col("n_valid"))), F.lit(0))
    a = out.groupBy("tile", "threshold").agg(F.count("*").alias("_all"), F.count_if(gone).alias("dropped"), F.count_if(gone & ~F.col("keep")).alias("already_rejected"), lost(gone).alias("observations_lost"), lost(F.lit(True)).alias("_total"))
    return a.select(
        "tile", "threshold", "dropped", (F.col("dropped") / F.col("_all")).alias("dropped_frac"), "already_rejected", (F.col("already_rejected") / F.greatest("dropped", F.lit(1))).alias("already_rejected_frac"),
        "observations_lost", F.coalesce(F.col("observations_lost") / F.nullif("_total", F.lit(0)), F.lit(0.0)).alias("observations_lost_frac"),
    )


# Covers from which a scene counts as cloudy, share of the best scene's pixels above which it is clear all the same.
CLOUDY, CLEAR_SHARE = (70, 90), 0.5


def cloud_correlation(table: DataFrame, cover: DataFrame) -> DataFrame:
    """(tile, corr, cloudy_but_clear_70, cloudy_but_clear_90): cover against the share of the tile's best scene that is valid, and kept scenes that are cloudy by cover but not here."""
    best = table.groupBy("tile").agg(F.max("n_valid").alias("_best"))
    share = F.col("n_valid") / F.col("_best")
    clear = F.col("keep") & (share > CLEAR_SHARE)
    return table.join(cover, "scene_ts").join(best, "tile").groupBy("tile").agg(correlation(F.col("cover"), share).alias("corr"), *[F.count_if((F.col("cover") >= t) & clear).alias(f"cloudy_but_clear_{t}") for t in CLOUDY])


def thinned(dn: DataFrame, cover: DataFrame, thresholds: tuple, params: Params = Params()) -> DataFrame:
    """A row per tile and cover threshold: offsets from the scenes below it only, against those from all.

    Each scene is dealt to the subsets it belongs to, so references, anomalies and offsets of all subsets come from one plan, keyed by
    subset and tile. Scenes that both sets have are compared: deltas of offsets and changed decisions. ``thresholds`` are whole per
    cents; a scene without a cover is below none.
    """
    below = F.filter(F.array(*[F.lit(float(t)) for t in thresholds]), lambda t: F.col("cover") < t)
    subsets = F.concat(F.array(F.lit("all")), F.transform(F.coalesce(below, F.array().cast("array<double>")), lambda t: t.cast("int").cast("string")))
    dealt = dn.join(cover, "scene_ts", "left").withColumn("_subset", F.explode(subsets)).withColumn("tile", F.concat_ws("/", "_subset", "tile")).drop("_subset", "cover")
    key = F.split("tile", "/", 2)
    t = n.offsets(n.anomalies(dealt, n.climatology(dealt)), params).withColumns({"threshold": key[0], "tile": key[1]})
    full = t.where("threshold = 'all'").select(*n.SCENE, F.col("offset_c").alias("_o"), F.col("keep").alias("_k"))
    j = t.where("threshold <> 'all'").join(full, n.SCENE)
    d = F.abs(F.col("offset_c") - F.col("_o"))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    flips = F.count_if(F.col("keep") != F.col("_k"))
    return j.groupBy("tile", F.col("threshold").cast("int").alias("threshold")).agg(
        F.count("*").alias("scenes"), F.avg((~F.col("keep")).cast("double")).alias("rejected_frac"), zero(F.median(d)).alias("median_abs_delta"), zero(F.percentile(d, F.lit(0.99))).alias("p99_abs_delta"), zero(F.max(d)).alias("max_abs_delta"),
        flips.alias("decision_flips"), (flips / F.count("*")).alias("decision_flip_frac"),
    )


def coarse_table(obs: DataFrame, params: Params = Params()) -> DataFrame:
    """A7, then B1-B6 and D1-D4 on the coarse grid, mean counts rounded to integers."""
    coarse = n.coarsen(obs, params.factor).withColumn("lwir11", F.round("lwir11").cast("long"))
    dn = n.stack(coarse.withColumn("rank", F.lit(0).cast("long")))
    return n.offsets(n.anomalies(dn, n.climatology(dn)), params.on_grid(params.factor))


# How far a coarse estimate of the offsets may be off.
ACCEPT = {"median_abs": 0.05, "p99_abs": 0.25, "max_abs": 0.5, "bias": 0.05, "flip_frac": 0.01, "flip_margin": 1.0}
# Scenes of a production tile, least spread of peaks that says anything, memory of a machine (GiB), growth of a leak.
PRODUCTION_SCENES, PEAK_SPREAD, VM_GIB, LEAK_GROWTH = 2930, 1.2, 64.0, 1.5


def compare_offsets(native: DataFrame, coarse: DataFrame, floor: int, coarse_floor: int, cap: float = 15.0) -> DataFrame:
    """Coarse offsets against native ones, with a verdict.

    Scenes either side would call too sparse count as sparse_flips where the sides differ and for nothing else; of the
    others those that one side keeps and the other doesn't are flips, with the largest distance of a native offset from the cap;
    the rest are compared. Zeros where there is nothing to compare.
    """
    j = native.select(*n.SCENE, F.col("offset_c").alias("a"), F.col("n_valid").alias("na")).join(coarse.select(*n.SCENE, F.col("offset_c").alias("b"), F.col("n_valid").alias("nb")), n.SCENE)
    ok_a, ok_b = F.col("na") >= floor, F.col("nb") >= coarse_floor
    keep_a, keep_b = F.abs("a") <= cap, F.abs("b") <= cap
    j = j.withColumns({"fit": ok_a & ok_b & F.col("a").isNotNull() & F.col("b").isNotNull(), "sparse": ok_a != ok_b})
    j = j.withColumns({"flip": F.col("fit") & (keep_a != keep_b), "scored": F.col("fit") & keep_a & keep_b})
    at = lambda c: F.when(F.col("scored"), c)
    d, zero = at(F.col("b") - F.col("a")), F.lit(0.0)
    scored = F.count_if("scored")
    slope = F.when(F.min(at(F.col("a"))) == F.max(at(F.col("a"))), F.lit(float("nan"))).otherwise(F.regr_slope(at(F.col("b")), at(F.col("a"))))
    out = j.agg(
        scored.alias("scored"), F.coalesce(F.median(F.abs(d)), zero).alias("median_abs"), F.coalesce(F.percentile(F.abs(d), F.lit(0.99)), zero).alias("p99_abs"), F.coalesce(F.max(F.abs(d)), zero).alias("max_abs"), F.coalesce(F.median(d), zero).alias("bias"),
        F.when(scored > 2, correlation(at(F.col("a")), at(F.col("b")))).otherwise(zero).alias("corr"), F.when(scored > 2, slope).otherwise(zero).alias("slope"),
        F.count_if("fit").alias("admissible"), F.count_if("flip").alias("flips"), F.coalesce(F.max(F.when(F.col("flip"), F.abs(F.abs("a") - cap))), zero).alias("flip_margin"), F.count_if("sparse").alias("sparse_flips"),
    ).withColumn("flip_frac", F.col("flips") / F.greatest("admissible", F.lit(1)))
    accepted = F.lit(True)
    for name, most in ACCEPT.items():
        accepted &= F.abs(name) <= most
    return out.withColumn("accepted", accepted)


# Fixed value: what of a difference is seen on a map (C).
MATERIAL_C = 0.1


def compare_composites(a: DataFrame, b: DataFrame, value: str = "lst", count: str = "n") -> DataFrame:
    """A row per tile: differences b - a where both have a value, and of the counts over all pixels that either has."""
    take = lambda d, k: d.select(*PIXEL, F.col(value).alias(k), F.col(count).alias(f"n{k}"))
    j = take(a, "a").join(take(b, "b"), PIXEL, "full")
    both = F.col("a").isNotNull() & F.col("b").isNotNull()
    d = F.when(both, F.col("b") - F.col("a"))
    at = lambda c: F.when(both, F.col(c))
    delta = F.coalesce("nb", F.lit(0)) - F.coalesce("na", F.lit(0))
    return j.groupBy("tile").agg(
        F.count(d).alias("pixels"), F.avg(d).alias("mean_delta"), F.median(F.abs(d)).alias("median_abs"), F.percentile(F.abs(d), F.lit(0.99)).alias("p99_abs"), F.max(F.abs(d)).alias("max_abs"),
        F.avg((F.abs(d) > MATERIAL_C).cast("double")).alias("share_over"), correlation(at("a"), at("b")).alias("corr"), F.avg(delta).alias("coverage_delta_mean"),
    )


def window_comparison(values: DataFrame, land: DataFrame, last: int, years: tuple) -> DataFrame:
    """D40 and D41 for windows of several lengths up to ``last``: a row per length.

    (years, land, gaps, gap_fraction, observations, striping, median_m1, zero_m1 ... median_m12, zero_m12).
    """
    y = F.year("scene_ts")
    per = values.withColumn("years", each(years)).where((y > last - F.col("years")) & (y <= last)).groupBy("years", *PIXEL).agg(F.count("*").alias("n"), *[F.count_if(F.month("scene_ts") == m).alias(f"m{m}") for m in range(1, 13)])
    g = land.withColumn("years", each(years)).join(per, ["years", *PIXEL], "left")
    months = []
    for m in range(1, 13):
        k = F.coalesce(F.col(f"m{m}"), F.lit(0))
        months += [F.median(k).alias(f"median_m{m}"), (100 * F.avg((k == 0).cast("double"))).alias(f"zero_m{m}")]
    out = g.groupBy("years").agg(F.count("*").alias("land"), F.count_if(F.col("n").isNull()).alias("gaps"), F.avg(F.col("n").isNull().cast("double")).alias("gap_fraction"), F.coalesce(F.sum("n"), F.lit(0)).alias("observations"), *months)
    column = g.groupBy("years", *PIXEL[:-2], "x").agg(F.avg(F.coalesce("n", F.lit(0))).alias("c")).groupBy("years").agg((F.stddev_pop("c") / F.nullif(F.avg("c"), F.lit(0.0))).alias("striping"))
    return out.join(column, "years")


def peak_verdict(runs: DataFrame, target: int = PRODUCTION_SCENES) -> DataFrame:
    """What runs of several scene counts say about memory: ``runs(scenes, peak_mb, floor_mb, tasks, ok)``, one row.

    Tasks are fitted always; peaks only if they rise with the scenes and spread enough, else the runs did not stream. A ratio
    of peak to floor that grows by more than half is a leak. Fewer than two good runs are insufficient.
    """
    ratio = F.col("peak_mb") / F.nullif(F.col("floor_mb"), F.lit(0.0))
    fit = lambda y, k: [F.coalesce(f(y, "scenes"), F.lit(0.0)).alias(f"{k}_{n}") for f, n in ((F.regr_slope, "slope"), (F.regr_intercept, "intercept"))]
    a = runs.where("ok").agg(F.count("*").alias("measured"), *fit("peak_mb", "mem"), *fit("tasks", "task"), F.coalesce(F.max("peak_mb") / F.nullif(F.min("peak_mb"), F.lit(0.0)), F.lit(0.0)).alias("peak_spread"), F.coalesce(F.max(ratio) / F.nullif(F.min(ratio), F.lit(0.0)), F.lit(0.0)).alias("ratio_growth"), F.avg(ratio).alias("mean_ratio"))
    streams = (F.col("mem_slope") > 0) & (F.col("peak_spread") >= PEAK_SPREAD)
    verdict = F.when(F.col("measured") < 2, "insufficient").when(~streams, "not_streaming").when(F.col("ratio_growth") > LEAK_GROWTH, "growing_ratio").otherwise("constant_ratio")
    peak = F.when(streams, F.col("mem_slope") * target + F.col("mem_intercept"))
    return a.select("measured", (F.col("task_slope") * target + F.col("task_intercept")).alias("projected_tasks"), "peak_spread", peak.alias("projected_peak_mb"), (peak / 1024 <= VM_GIB).alias("fits"), F.when(streams, F.col("ratio_growth")).alias("ratio_growth"), F.when(streams, F.col("mean_ratio")).alias("mean_ratio"), verdict.alias("verdict"))


def linear_fit(df: DataFrame, x: str, y: str) -> DataFrame:
    """N, slope, intercept, r and residual spread (n - 2) of y on x."""
    a = df.agg(F.count("*").alias("n"), F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), correlation(F.col(x), F.col(y)).alias("r"), F.regr_syy(y, x).alias("_syy"), F.regr_sxy(y, x).alias("_sxy"))
    return a.select("n", "slope", "intercept", "r", F.sqrt((F.col("_syy") - F.col("slope") * F.col("_sxy")) / (F.col("n") - 2)).alias("residual_sd"))


def repeat_stats(df: DataFrame, by: list[str], ok: Column, value: str) -> DataFrame:
    """Runs, successes and failures, success rate, and mean, sample spread (0 of one run) and extremes of the successful ones."""
    v = F.when(ok, F.col(value))
    good = F.count_if(ok)
    sd = F.when(F.count(v) > 1, F.stddev_samp(v)).when(F.count(v) == 1, 0.0)
    return df.groupBy(*by).agg(F.count("*").alias("total_runs"), good.alias("successful"), (F.count("*") - good).alias("failed"), (good / F.count("*")).alias("success"), F.avg(v).alias("mean"), sd.alias("sd"), F.min(v).alias("min"), F.max(v).alias("max"))


def relative_effect(df: DataFrame, arm: str, value: str, method: str = "median", order: str | None = None, lower_is_better: bool = True) -> DataFrame:
    """One number of each of two arms ('a' and 'b'), their first by ``order`` (single), mean or median, and b's relative gain over a."""
    one = {"single": lambda c: F.min_by(c, F.when(c.isNotNull(), F.col(order or value))), "mean": F.avg, "median": F.median}[method]
    m = df.agg(*[one(F.when(F.col(arm) == k, F.col(value))).alias(k) for k in ("a", "b")])
    gain = (F.col("a") - F.col("b")) if lower_is_better else (F.col("b") - F.col("a"))
    return m.withColumn("effect", gain / F.nullif(F.col("a"), F.lit(0.0)))


def equivalent(a: DataFrame, b: DataFrame, keys: list[str], col: str, tolerance: float) -> DataFrame:
    """Largest difference and whether both have values at the same keys within a tolerance."""
    j = a.select(*keys, F.col(col).alias("a"), F.lit(1).alias("ia")).join(b.select(*keys, F.col(col).alias("b"), F.lit(1).alias("ib")), keys, "full")
    odd = F.count_if(F.col("a").isNull() != F.col("b").isNull())
    out = j.agg(F.coalesce(F.max(F.abs(F.col("a") - F.col("b"))), F.lit(0.0)).alias("max_abs"), odd.alias("null_mismatches"))
    return out.withColumn("equivalent", (F.col("max_abs") <= tolerance) & (F.col("null_mismatches") == 0))


def synthetic_cube(spark: SparkSession, height: int, width: int, scenes: int, seed: int = 0, tile: str = "N00E000") -> DataFrame:
    """For scale tests: counts 36322 to 50952, three in ten cloudy, times even over five years; drawn by row number, so whatever the partitions."""
    i = F.col("id")
    step = F.floor(i / (height * width))
    ts = F.timestamp_seconds(1609459200 + F.floor(step * (5 * 365.25 * 86400 / scenes)))
    draw = lambda k, n: F.pmod(F.xxhash64(i, F.lit(seed), F.lit(k)), F.lit(n))
    return spark.range(height * width * scenes).select(F.lit(tile).alias("tile"), ts.alias("scene_ts"), (F.floor(i / width) % height).alias("y"), (i % width).alias("x"), (36322 + draw(0, 14631)).cast("int").alias("lwir11"), F.when(draw(1, 10) < 3, 8).otherwise(64).alias("qa_pixel"), F.lit(0).cast("long").alias("rank"))


def write_table(df: DataFrame, path: str, kind: str = "csv") -> None:
    """A summary as CSV with header or as JSON lines."""
    w = df.write.mode("overwrite")
    w.option("header", True).csv(path) if kind == "csv" else w.json(path)

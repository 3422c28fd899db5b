"""Run records, costs and telemetry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUN_STATE = T.StructType([T.StructField("phase", T.StringType()), T.StructField("updated_at", T.TimestampType()), T.StructField("phase_seconds", T.MapType(T.StringType(), T.DoubleType())), T.StructField("rss_series", T.ArrayType(T.ArrayType(T.DoubleType())))])
# Price bands relative to the on-demand rate; classes of task keys, in lower case with dashes, whole or by how they begin.
SPOT_BAND, UNKNOWN_BAND = (0.30, 0.75), (0.30, 1.0)
READ_KEYS, READ_STARTS = ("keixel", "lwir11", "qa-pixel", "open", "cfg", "grid"), ("open-", "cfg-", "grid-")
COMPUTE_KEYS, COMPUTE_STARTS = ("sub",), ("getitem-stack-", "where", "astype", "invert", "custom-nanquantile", "nanquantile-last", "getitem-sum-", "stack", "sum")
RECHUNK_KEYS, RECHUNK_STARTS = ("transpose", "getitem"), ("rechunk", "shuffle-")
STORE_KEYS, STORE_STARTS = (), ("store",)
# Scenes of a five-year window by latitude; terminal phases; a tile's byte model: MB/s, minutes, USD an hour.
SCENES_BY_LATITUDE = ((2.5, 3899), (37.5, 2758), (57.5, 3802))
TERMINAL = {"done": "done", "failed": "failed", "skipped": "done"}
OFFSET_RATE, COMPOSITE_RATE, OFFSET_MINUTES, COMPOSITE_MINUTES, VM_HOUR = 140.0, 45.5, 15.0, 38.0, 0.504
OUTPUT_GB_PER_TILE, USD_PER_GB_MONTH = 1.5, 0.023
STALE_S, RATE_WINDOW = 120.0, 5
# Endings of a run's artifacts, the most specific first; minutes of a worker's boot and of a unit's compute by stage.
KINDS = (("profile", ".profile.json"), ("progress", ".progress.json"), ("log", ".log"), ("state", ".json"))
BOOT_MIN, OFFSETS_MIN, COMPOSITE_MIN = 5.0, 6.0, 15.0
# Classes of tasks, provenances from the strongest to the weakest, the approval ceiling (USD).
CLASSES = ("read", "compute", "rechunk", "store", "other")
PROVENANCES = ("measured", "published", "derived", "assumed")
CEILING_USD = 3000.0


def read_states(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object per tile attempt; tile and attempt come from the path. Profiles and other files that lie there are left out."""
    df = spark.read.schema(RUN_STATE).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(path)
    parts = dict(zip(("tile", "attempt", "kind", "label"), key_parts(F.col("_metadata.file_path"))))
    return df.withColumns(parts).where(F.col("kind").isin("state", "progress")).drop("label")


def key_parts(key: Column) -> tuple[Column, Column, Column, Column]:
    """(tile, attempt, kind, label) of a run's artifact, by the last part of its key; nulls for others.

    <tile>[.<attempt>].<label>.profile.json, <tile>.progress.json (an older heartbeat), <tile>[.<attempt>].log and
    <tile>[.<attempt>].json (a state), the most specific first; without an attempt it is 0, what a settled tile leaves.
    """
    def kind_of(name):
        kind = F.lit(None)
        for k, suffix in reversed(KINDS):
            kind = F.when(name.endswith(suffix), k).otherwise(kind)
        return F.struct(kind.alias("kind"), F.regexp_replace(name, r"\.(profile\.json|progress\.json|log|json)$", "").alias("stem"))

    def body_of(p):
        return F.struct(p["kind"].alias("kind"), p["stem"].alias("stem"), F.when(p["kind"] == "profile", F.regexp_extract(p["stem"], r"^(.*)\.[^.]*$", 1)).otherwise(p["stem"]).alias("body"))

    def parts_of(p):
        tried = F.when(p["kind"] != "progress", F.nullif(F.regexp_extract(p["body"], r"^.+\.(\d+)$", 1), F.lit("")))
        label = F.when(p["kind"] == "profile", F.regexp_extract(p["stem"], r"([^.]*)$", 1))
        whole = F.struct(F.when(tried.isNotNull(), F.regexp_extract(p["body"], r"^(.+)\.\d+$", 1)).otherwise(p["body"]).alias("tile"), F.coalesce(tried.cast("int"), F.lit(0)).alias("attempt"), p["kind"].alias("kind"), label.alias("label"))
        return F.when(p["kind"].isNotNull() & ((p["kind"] != "profile") | (p["body"] != "")), whole)

    steps = F.array(F.regexp_extract(key, r"([^/]*)$", 1))
    for step in (kind_of, body_of, parts_of):
        steps = F.transform(steps, step)
    return tuple(steps[0][k] for k in ("tile", "attempt", "kind", "label"))


def artifacts(listing: DataFrame) -> DataFrame:
    """A row per tile of ``listing(key)``: maps from attempt to key of states and logs, from attempt and label of profiles, and what follows from them.

    (tile, states, logs, profiles, legacy_progress, attempt, state_key, log_key, profile_keys, body_key, settled, attempts,
    highest_attempt): attempt is the newest that left a state, highest_attempt the newest that left anything. Of several keys of one
    meaning the greatest counts.
    """
    parts = listing.select("key", *[v.alias(k) for k, v in zip(("tile", "attempt", "kind", "label"), key_parts(F.col("key")))]).where("kind is not null")
    one = parts.groupBy("tile", "kind", "attempt", "label").agg(F.max("key").alias("key"))
    entry = F.struct("attempt", "key")
    of = lambda k: F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("kind") == k, entry))))
    labelled = F.array_sort(F.collect_list(F.when(F.col("kind") == "profile", F.struct("attempt", "label", "key"))))
    t = one.groupBy("tile").agg(of("state").alias("states"), of("log").alias("logs"), labelled.alias("_p"), F.max(F.when(F.col("kind") == "progress", F.col("key"))).alias("legacy_progress"), F.max(F.when(F.col("kind") != "progress", F.col("attempt"))).alias("_highest"))
    dumps = lambda k: F.map_from_entries(F.transform(F.filter("_p", lambda p: p["attempt"] == k), lambda p: F.struct(p["label"], p["key"])))
    tries = F.array_sort(F.filter(F.map_keys("states"), lambda k: k > 0))
    t = t.withColumn("profiles", F.map_from_entries(F.transform(F.array_distinct(F.transform("_p", lambda p: p["attempt"])), lambda k: F.struct(k, dumps(k)))))
    t = t.withColumns({"attempts": tries, "attempt": F.coalesce(F.array_max(tries), F.lit(0)), "settled": F.map_contains_key("states", 0), "highest_attempt": F.coalesce("_highest", F.lit(0))})
    newest = lambda m: F.coalesce(F.try_element_at(m, F.col("attempt")), F.try_element_at(m, F.lit(0)))
    t = t.withColumns({"state_key": newest(F.col("states")), "log_key": newest(F.col("logs")), "profile_keys": newest(F.col("profiles"))})
    return t.withColumn("body_key", F.coalesce("legacy_progress", "state_key")).drop("_p", "_highest")


def billed_seconds(s: Column) -> Column:
    """A minute at least."""
    return F.greatest(s, F.lit(60.0))


def rate_band(rate: Column, lifecycle: Column) -> Column:
    """struct(low, high)."""
    low = F.when(lifecycle == "on-demand", 1.0).when(lifecycle == "spot", SPOT_BAND[0]).otherwise(UNKNOWN_BAND[0])
    high = F.when(lifecycle == "on-demand", 1.0).when(lifecycle == "spot", SPOT_BAND[1]).otherwise(UNKNOWN_BAND[1])
    return F.struct((rate * low).alias("low"), (rate * high).alias("high"))


def prefix_class(prefix: Column) -> Column:
    """Read, compute, rechunk or store, the first that fits; else other."""
    key = F.regexp_replace(F.lower(prefix), "_", "-")
    out = F.lit("other")
    for name, keys, starts in (("store", STORE_KEYS, STORE_STARTS), ("rechunk", RECHUNK_KEYS, RECHUNK_STARTS), ("compute", COMPUTE_KEYS, COMPUTE_STARTS), ("read", READ_KEYS, READ_STARTS)):
        out = F.when(key.isin(*keys) | key.rlike("^(" + "|".join(starts) + ")"), name).otherwise(out)
    return out


def scenes_for(lat: Column) -> Column:
    """Scenes by latitude: linear between measured latitudes, halves to even, constant outside them."""
    at = F.abs(lat).cast("double")
    out = F.lit(SCENES_BY_LATITUDE[-1][1])
    for (a, low), (b, high) in reversed(list(zip(SCENES_BY_LATITUDE, SCENES_BY_LATITUDE[1:]))):
        out = F.when(at <= b, F.bround(low + (at - a) / (b - a) * (high - low)).cast("int")).otherwise(out)
    return F.when(at <= SCENES_BY_LATITUDE[0][0], SCENES_BY_LATITUDE[0][1]).otherwise(out)


def tile_bytes(tiles: DataFrame, side: int = 18000, factor: int = 2, offset_rate: float = OFFSET_RATE, composite_rate: float = COMPOSITE_RATE) -> DataFrame:
    """The byte model of ``tiles(name, scenes, land)``: passes in GB, hours on one machine, machines within the budgets, cost.

    Both bands of two bytes; land saves the first of two coarse passes, the native pass reads all.
    """
    coarse = F.col("scenes") * float((side // factor) ** 2 * 4)
    native = F.col("scenes") * float(side * side * 4)
    hours = {"offset_hours": coarse * (F.col("land") + 1) / (offset_rate * 1e6) / 3600, "composite_hours": native / (composite_rate * 1e6) / 3600}
    both, cost = F.col("offset_hours") + F.col("composite_hours"), (F.col("offset_hours") + F.col("composite_hours")) * VM_HOUR
    return tiles.withColumns(hours).select(
        "name", (coarse / 1e9).alias("coarse_gb"), (native / 1e9).alias("native_gb"), "offset_hours", "composite_hours", both.alias("vm_hours"),
        (F.col("offset_hours") * 60 / OFFSET_MINUTES).alias("offset_vms"), (F.col("composite_hours") * 60 / COMPOSITE_MINUTES).alias("composite_vms"), (both <= 1).alias("within_hour"),
        cost.alias("cost"), (cost * SPOT_BAND[0]).alias("spot_low"), (cost * SPOT_BAND[1]).alias("spot_high"),
    )


def category(phase: Column, settled: Column, age_s: Column, stale_s: float = STALE_S) -> Column:
    """Terminal phases first, then what the listing settled, then silence; an unknown age is stale."""
    out = F.when(settled, "done").when(age_s.isNull() | (age_s > stale_s), "stale").otherwise("running")
    for name, shown in TERMINAL.items():
        out = F.when(phase == name, shown).otherwise(out)
    return out


def skip_done(jobs: DataFrame, done: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(to do, done) of ``jobs`` by window and tile."""
    return jobs.join(done, ["window", "tile"], "left_anti"), jobs.join(done, ["window", "tile"], "left_semi")


def with_price(machines: DataFrame, prices: DataFrame, default_type) -> DataFrame:
    """C17: hourly price of ``machines(region, type)``: the published one, else the region's for the default type (assumed), else none."""
    fallback = prices.where(F.col("type") == default_type).select("region", F.col("hourly").alias("_default"))
    j = machines.join(prices, ["region", "type"], "left").join(fallback, "region", "left")
    origin = F.when(F.col("hourly").isNotNull(), "published").when(F.col("_default").isNotNull(), "assumed").otherwise("none")
    return j.withColumn("provenance", origin).withColumn("hourly", F.coalesce("hourly", "_default")).drop("_default")


BUCKET = "hour"  # of telemetry: what one task orders is one unit's bucket, what is carried over is a row per bucket


def running(df: DataFrame, unit: str, ts: str, order: list[str], sums: list[str]) -> DataFrame:
    """``df`` with the running sums of columns by unit, each under the column's own name with an underscore.

    Sums run within a unit's time buckets; what the buckets before add is carried, so a unit with very many rows is no single task.
    """
    b = df.withColumn("_bucket", F.date_trunc(BUCKET, ts))
    totals = b.groupBy(unit, "_bucket").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    before = Window.partitionBy(unit).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(unit, "_bucket", *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_c_{c}") for c in sums])
    within = Window.partitionBy(unit, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = b.join(carried, [unit, "_bucket"]).withColumns({f"{c}_": F.sum(c).over(within) + F.col(f"_c_{c}") for c in sums})
    return out.drop("_bucket", *[f"_c_{c}" for c in sums])


def previous(df: DataFrame, unit: str, ts: str, order: list[str], cols: list[str]) -> DataFrame:
    """``df`` with the unit's row before each row, as the struct _prev of ``cols``; null for the first. Rows are ordered within time buckets."""
    b = df.withColumn("_bucket", F.date_trunc(BUCKET, ts))
    last = b.groupBy(unit, "_bucket").agg(F.max_by(F.struct(*cols), F.struct(*order)).alias("_last"))
    carried = last.select(unit, "_bucket", F.lag("_last").over(Window.partitionBy(unit).orderBy("_bucket")).alias("_carried"))
    within = Window.partitionBy(unit, "_bucket").orderBy(*order)
    j = b.join(carried, [unit, "_bucket"])
    return j.withColumn("_prev", F.coalesce(F.lag(F.struct(*cols)).over(within), F.col("_carried"))).drop("_bucket", "_carried")


def timeline(samples: DataFrame, tasks: DataFrame, reads: DataFrame) -> DataFrame:
    """(worker, ts, active_<class>_tasks ..., sources_started, sources_finished) as of each of ``samples(worker, ts)``; a start or end at that moment counts.

    ``tasks(worker, class, started, seconds)``: one without seconds has not ended. ``reads(worker, started, finished)``.
    """
    end = F.timestamp_micros(F.unix_micros("started") + (F.col("seconds") * 1_000_000).cast("long"))
    names = [f"active_{c}_tasks" for c in CLASSES] + ["sources_started", "sources_finished"]

    def events(df, ts, kind, **one):
        return df.where(ts.isNotNull()).select("worker", ts.alias("ts"), F.lit(kind).alias("kind"), *[F.coalesce(one.get(c, F.lit(0)), F.lit(0)).cast("int").alias(c) for c in names])

    by_class = lambda sign: {f"active_{c}_tasks": F.when(F.col("class") == c, sign) for c in CLASSES}
    ev = events(tasks, F.col("started"), 0, **by_class(1)).unionAll(events(tasks, end, 0, **by_class(-1)))
    ev = ev.unionAll(events(reads, F.col("started"), 0, sources_started=F.lit(1))).unionAll(events(reads, F.col("finished"), 0, sources_finished=F.lit(1)))
    run = running(ev.unionAll(events(samples, F.col("ts"), 1)), "worker", "ts", ["ts", "kind"], names)
    return run.where("kind = 1").select("worker", "ts", *[F.col(f"{c}_").alias(c) for c in names])


def plan_comparison(plan: DataFrame, results: DataFrame) -> DataFrame:
    """A row per run: the largest planned floor of its phases against the worst peak, and planned against observed scenes.

    ``plan(run, scenes, floors map<string, double>)`` in GiB, floors of 0 are none; ``results(run, peak_mb, scene_count)``.
    """
    entry = F.array_max(F.transform(F.filter(F.map_entries("floors"), lambda e: e["value"] > 0), lambda e: F.struct(e["value"].alias("gib"), e["key"].alias("phase"))))
    seen = results.groupBy("run").agg(F.round(F.max("peak_mb") / 1024, 2).alias("observed_peak_gib"), F.count("peak_mb").alias("observed_tiles"), F.min("scene_count").alias("scenes_min"), F.max("scene_count").alias("scenes_max"), F.count("scene_count").alias("scenes_tiles"))
    j = plan.withColumn("_f", entry).join(seen, "run", "left")
    ratio = F.round(F.nullif("observed_peak_gib", F.lit(0.0)) / F.col("_f.gib"), 2)
    tiles = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return j.select("run", F.col("_f.gib").alias("floor_gib"), F.col("_f.phase").alias("floor_phase"), "observed_peak_gib", tiles("observed_tiles"), ratio.alias("ratio"), F.col("scenes").alias("scenes_planned"), "scenes_min", "scenes_max", tiles("scenes_tiles"))


def attempts(beats: DataFrame) -> DataFrame:
    """Tiles, attempts in all, most of a tile, tiles tried again."""
    per = beats.groupBy("tile").agg(F.countDistinct("attempt").alias("n"))
    return per.agg(F.count("*").alias("tiles"), F.sum("n").alias("attempts"), F.max("n").alias("most"), F.count_if(F.col("n") > 1).alias("retried"))


def newest(beats: DataFrame) -> DataFrame:
    """The newest beat of the highest attempt of each tile."""
    order = F.struct("attempt", "updated_at", "event_id")
    return beats.groupBy("tile").agg(F.max_by(F.struct("attempt", "updated_at", "phase", "rss"), order).alias("s")).select("tile", "s.*")


def outcome(tiles: DataFrame, listing: DataFrame, states: DataFrame) -> DataFrame:
    """(tile, status, phase): completed if the listing of finished tiles has it, else failed, whatever its newest record says; the record's phase beside it."""
    j = tiles.join(listing.select("tile").distinct().withColumn("_done", F.lit("completed")), "tile", "left").join(states.select("tile", "phase"), "tile", "left")
    return j.select("tile", F.coalesce("_done", F.lit("failed")).alias("status"), "phase")


def tile_cost(rows: DataFrame) -> DataFrame:
    """(tile, low, high, provenance) of ``rows(tile, seconds, hourly, provenance, lifecycle)``, one row a tile.

    A tile without duration or price is left out, not priced at nothing. The cost is derived where a published price of an on-demand
    machine makes it a point; every band and every substituted price is assumed.
    """
    band, hours = rate_band(F.col("hourly"), F.col("lifecycle")), billed_seconds(F.col("seconds")) / 3600
    exact = (F.col("provenance") == "published") & (F.col("lifecycle") == "on-demand")
    priced = rows.where("seconds is not null and hourly is not null")
    return priced.select("tile", (band["low"] * hours).alias("low"), (band["high"] * hours).alias("high"), F.when(exact, "derived").otherwise("assumed").alias("provenance"))


def fleet_cost(estimates: DataFrame, tiles: int) -> DataFrame:
    """One row on ``tile_cost``: observed tiles, the mean interval of one and that of all ``tiles``; no row without estimates.

    The weakest provenance counts; where fewer tiles were observed than are priced it is assumed.
    """
    strength = F.array_position(F.array(*map(F.lit, PROVENANCES)), F.col("provenance"))
    a = estimates.agg(F.count("*").alias("observed_tiles"), F.avg("low").alias("mean_low"), F.avg("high").alias("mean_high"), F.max(strength).alias("_weak")).where("observed_tiles > 0")
    weakest = F.when(F.col("observed_tiles") < tiles, PROVENANCES[-1]).otherwise(F.element_at(F.array(*map(F.lit, PROVENANCES)), F.col("_weak").cast("int")))
    return a.select("observed_tiles", F.lit(tiles).alias("tiles"), "mean_low", "mean_high", (F.col("mean_low") * tiles).alias("low"), (F.col("mean_high") * tiles).alias("high"), weakest.alias("provenance"))


def task_summary(tasks: DataFrame) -> DataFrame:
    """Time by prefix and its class, and the share of all."""
    g = tasks.groupBy("prefix", prefix_class(F.col("prefix")).alias("class")).agg(F.count("*").alias("n"), F.sum("seconds").alias("seconds"))
    total = g.agg(F.sum("seconds").alias("t")).withColumn("k", F.lit(1))
    return g.withColumn("k", F.lit(1)).join(total, "k").select("prefix", "class", "n", "seconds", (F.col("seconds") / F.nullif(F.col("t"), F.lit(0.0))).alias("share"))


def top(df: DataFrame, by: str, n: int = 25) -> DataFrame:
    """the n largest, ties by all other columns."""
    return df.orderBy(F.desc(by), *[c for c in df.columns if c != by]).limit(n)


def quantiles(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """D53."""
    p = F.percentile(value, F.array(F.lit(0.5), F.lit(0.95), F.lit(0.99)))
    g = df.groupBy(*by).agg(F.count(value).alias("n"), p.alias("p"), F.avg(value).alias("mean"), F.max(value).alias("max"))
    return g.select(*by, "n", *[F.col("p")[i].alias(k) for i, k in enumerate(("p50", "p95", "p99"))], "mean", "max")


def phase_stats(states: DataFrame, by: list[str]) -> DataFrame:
    """Number, least, median and greatest seconds of each phase of ``states(phase_seconds map)``."""
    rows = states.select(*by, F.explode("phase_seconds").alias("phase", "seconds"))
    return rows.groupBy(*by, "phase").agg(F.count("*").alias("n"), F.min("seconds").alias("min"), F.median("seconds").alias("median"), F.max("seconds").alias("max"))


def phase_comparison(states: DataFrame, arm: str, one: str, other: str) -> DataFrame:
    """The statistics of two arms of ``states`` side by side, a row per phase that either has."""
    s = phase_stats(states, [arm])
    side = lambda k: s.where(F.col(arm) == k).select("phase", *[F.col(c).alias(f"{k}_{c}") for c in ("n", "min", "median", "max")])
    return side(one).join(side(other), "phase", "full")


def wave_envelope(records: DataFrame, boot_s: float = 60 * BOOT_MIN) -> DataFrame:
    """What a wave's three stamps say, of ``records(stage, wave, units, max_workers, submitted_at, first_completion_at, last_completion_at)``, in seconds.

    Workers start together and stop with the last unit, so the time billed is an observation; without timings of units idle time is
    bounded only. Records without a stamp or workers, or that end before they begin, say nothing and go.
    """
    stamps = [F.col(c) for c in ("submitted_at", "first_completion_at", "last_completion_at")]
    submitted, first, last = stamps
    r = records.where(submitted.isNotNull() & first.isNotNull() & last.isNotNull() & (F.col("max_workers") > 0) & (last >= submitted))
    workers = F.col("max_workers").cast("double")
    billed, boot, units = workers * (last - submitted), workers * boot_s, F.coalesce("units", F.lit(0))
    return r.select(
        "stage", "wave", units.alias("units"), workers.alias("workers"), F.greatest(F.ceil(units / F.floor(workers)), F.lit(1)).alias("queue_depth"),
        F.round(billed, 1).alias("billed_vm_s"), F.round(boot, 1).alias("boot_vm_s"), F.round(first - submitted, 1).alias("time_to_first_completion_s"),
        F.round(last - first, 1).alias("drain_tail_s"), F.round(F.greatest(billed - boot, F.lit(0.0)), 1).alias("idle_upper_bound_vm_s"),
    )


def split_cluster(clusters: DataFrame) -> DataFrame:
    """``clusters(stage, usd_per_min, lifetimes array<double>)`` with the workers' minutes and dollars of boot, useful work and idle time.

    Worker by worker: boot is at most the worker's life, work at most what is left of it, idle the rest, so the three make up its life.
    """
    unit = F.when(F.col("stage").startswith("composite"), COMPOSITE_MIN).otherwise(OFFSETS_MIN)
    total = lambda f: F.aggregate("lifetimes", F.lit(0.0), lambda acc, life: acc + f(life))
    boot = lambda life: F.least(life, F.lit(BOOT_MIN))
    useful = lambda life: F.least(unit, F.greatest(life - BOOT_MIN, F.lit(0.0)))
    idle = lambda life: F.greatest(life - boot(life) - useful(life), F.lit(0.0))
    out = clusters.withColumns({"workers": F.size("lifetimes"), "boot_min": total(boot), "useful_min": total(useful), "idle_min": total(idle)})
    return out.withColumns({f"{k}_usd": F.col(f"{k}_min") * F.col("usd_per_min") for k in ("boot", "useful", "idle")})


def cost_layers(split: DataFrame, offsets_equivalents: float, composite_equivalents: float) -> DataFrame:
    """One row on ``split_cluster``: compute and provisioning (boot and idle) of all tiles, each stage by its own number of tile equivalents."""
    composite = F.col("stage").startswith("composite")
    of = lambda c, which, e: F.coalesce(F.sum(F.when(which, c)), F.lit(0.0)) * e
    work, rest = F.col("useful_usd"), F.col("boot_usd") + F.col("idle_usd")
    a = split.agg(
        of(work, ~composite, offsets_equivalents).alias("compute_offsets_usd"), of(work, composite, composite_equivalents).alias("compute_composite_usd"),
        of(rest, ~composite, offsets_equivalents).alias("provisioning_offsets_usd"), of(rest, composite, composite_equivalents).alias("provisioning_composite_usd"),
    )
    compute = F.col("compute_offsets_usd") + F.col("compute_composite_usd")
    return a.withColumns({"compute_usd": compute, "provisioning_usd": F.col("provisioning_offsets_usd") + F.col("provisioning_composite_usd"), "compute_composite_share": F.col("compute_composite_usd") / F.nullif(compute, F.lit(0.0))})


def tile_equivalents(tiles: DataFrame, reference: str) -> DataFrame:
    """All tiles as multiples of one, by scenes x (land + 1) and by scenes."""
    w = F.col("scenes") * (F.col("land") + 1)
    is_ref = F.col("name") == reference
    a = tiles.agg(F.sum(w).alias("w"), F.sum("scenes").alias("s"), F.max(F.when(is_ref, w)).alias("rw"), F.max(F.when(is_ref, F.col("scenes"))).alias("rs"))
    return a.select((F.col("w") / F.col("rw")).alias("by_work"), (F.col("s") / F.col("rs")).alias("by_scenes"))


def project(compute: float, provisioning: float, tiles: int, scenarios: DataFrame, vcpu_hours: float = 0.0, credits: tuple = (0.0, 0.0), ceiling: float = CEILING_USD) -> DataFrame:
    """On-demand, spot and credit intervals of ``scenarios(name, capture_low, capture_high, retry, contingency)``, and where the spot interval lies to the ceiling.

    Capture is the share of the provisioning that consolidation removes: the highest cost has the least of it. Credits follow
    ``vcpu_hours``, of which the same share is provisioning, at ``credits`` an hour; nothing prices them.
    """
    up = (1 + F.col("retry")) * (1 + F.col("contingency"))
    storage = OUTPUT_GB_PER_TILE * tiles * USD_PER_GB_MONTH
    share = provisioning / (provisioning + compute) if provisioning + compute else 0.0
    j = scenarios.withColumns({
        "low": (compute + provisioning * (1 - F.col("capture_high"))) * up, "high": (compute + provisioning * (1 - F.col("capture_low"))) * up,
        "credits_low": vcpu_hours * (1 - share * F.col("capture_high")) * up * credits[0], "credits_high": vcpu_hours * (1 - share * F.col("capture_low")) * up * credits[1],
    }).withColumns({"spot_low": F.col("low") * SPOT_BAND[0] + storage, "spot_high": F.col("high") * SPOT_BAND[1] + storage})
    where = F.when(F.col("spot_low") > ceiling, "above").when(F.col("spot_high") < ceiling, "below").otherwise("straddles")
    return j.select("name", "low", "high", "spot_low", "spot_high", "credits_low", "credits_high", F.lit(storage).alias("storage_month"), where.alias("ceiling"))


def scenes_per_tile(scenes: DataFrame) -> DataFrame:
    """Of ``scenes(lat, lon, ...)``: least, most, mean and all scenes over the tiles that have any."""
    per = scenes.groupBy("lat", "lon").agg(F.count("*").alias("n"))
    return per.agg(F.count("*").alias("tiles"), F.min("n").alias("min"), F.max("n").alias("max"), F.avg("n").alias("mean"), F.sum("n").alias("total"))


def rates(samples: DataFrame, counter: str, unit: str = "tile") -> DataFrame:
    """A counter's rate since the sample before; negative ones and the first are 0."""
    j = previous(samples, unit, "updated_at", ["updated_at", "event_id"], ["updated_at", counter])
    seconds = (F.unix_micros("updated_at") - F.unix_micros("_prev.updated_at")) / 1e6
    rate = (F.col(counter) - F.col(f"_prev.{counter}")) / F.nullif(seconds, F.lit(0.0))
    return j.withColumn("rate", F.coalesce(F.greatest(rate, F.lit(0.0)), F.lit(0.0))).drop("_prev")


def peak_resident(events: DataFrame) -> DataFrame:
    """Most bytes held at once, of ``events(worker, ts, delta, event_id)``."""
    return running(events, "worker", "ts", ["ts", "event_id"], ["delta"]).groupBy("worker").agg(F.max("delta_").alias("peak"))


def epochs(beats: DataFrame) -> DataFrame:
    """The epoch a tile is in, by its beats ``(tile, updated_at, event_id, seq, done, total)``: the newest beats of one graph whose tasks done never fell.

    (tile, beats, rate, rate5, eta_s): tasks a second over the last step and over up to five beats, and the seconds left by the
    latter; null where time stood still or nothing was done.
    """
    order = ["updated_at", "event_id"]
    e = previous(beats, "tile", "updated_at", order, ["seq", "done"])
    same = (F.col("seq") == F.col("_prev.seq")) & (F.col("done") >= F.col("_prev.done"))
    e = e.withColumn("_at", F.struct(*order)).withColumn("_new", ~F.coalesce(same, F.lit(False)))
    begun = e.groupBy("tile").agg(F.max(F.when(F.col("_new"), F.col("_at"))).alias("_begun"))  # the epoch it is in began last
    e = e.join(begun, "tile").where("_at >= _begun")
    n = e.groupBy("tile").agg(F.count("*").alias("beats"))
    recent = e.withColumn("_bucket", F.date_trunc(BUCKET, "updated_at"))
    for by in (["tile", "_bucket"], ["tile"]):  # the newest of each bucket, then of these
        newest_first = Window.partitionBy(*by).orderBy(F.desc("_at"))
        recent = recent.withColumn("_k", F.row_number().over(newest_first)).where(F.col("_k") <= RATE_WINDOW)
    row = F.struct("updated_at", "done", "total")
    got = recent.groupBy("tile").agg(F.max(F.when(F.col("_k") == 1, row)).alias("b"), F.max(F.when(F.col("_k") == 2, row)).alias("p"), F.max_by(row, "_k").alias("f")).join(n, "tile")
    flat = got.select("tile", "beats", F.col("b.updated_at").alias("updated_at"), F.col("b.done").alias("done"), F.col("b.total").alias("total"), "p", "f")
    flat = flat.withColumns({"rate": per_second(F.col("p.done"), F.col("p.updated_at")), "rate5": per_second(F.col("f.done"), F.col("f.updated_at"))})
    return flat.select("tile", "beats", "rate", "rate5", eta(F.col("total"), F.col("done"), F.col("rate5")).alias("eta_s"))


def per_second(done: Column, at: Column) -> Column:
    """Tasks a second since an older beat; a count that fell is 0, no time between is null."""
    seconds = (F.unix_micros("updated_at") - F.unix_micros(at)) / 1e6
    return F.when(seconds > 0, F.greatest(F.col("done") - done, F.lit(0)) / seconds)


def eta(total: Column, done: Column, rate: Column) -> Column:
    """Seconds left; null without progress."""
    return F.when(rate > 0, F.greatest(total - done, F.lit(0)) / rate)


def sample_gaps(beats: DataFrame, limit_s: float = 2.0) -> DataFrame:
    """Mean and largest gap between beats and the number of those of a limit and more."""
    j = previous(beats, "tile", "updated_at", ["updated_at", "event_id"], ["updated_at"])
    gap = (F.unix_micros("updated_at") - F.unix_micros("_prev.updated_at")) / 1e6
    return j.select(gap.alias("g")).where("g is not null").agg(F.avg("g").alias("mean"), F.max("g").alias("max"), F.count_if(F.col("g") >= limit_s).alias("over"))


def late_attach(beats: DataFrame, interval_s: float) -> DataFrame:
    """(tile, late): whether the first kept beat came when its tile had been at work (elapsed_s) for more than two intervals; unknown is not late."""
    first = beats.groupBy("tile").agg(F.min_by("elapsed_s", F.struct("updated_at", "event_id")).alias("elapsed_s"))
    return first.select("tile", F.coalesce(F.col("elapsed_s") > 2 * interval_s, F.lit(False)).alias("late"))

"""Queries on catalogs, runs and telemetry, batch and streaming."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.grid import hilbert, tiles_of_box
from ..operators import catalog as k
from ..operators import runs as r
from ..operators import sweeps as s
from ..sources.fixtures import TABLES, load, with_tables
from ..sources.storage import shared_dir
from ..streaming import beats as st
from ..streaming import live
from .tile import _round


def _files(spark: SparkSession, sf: str) -> DataFrame:
    """Two product files per place's tile."""
    from ..functions.grid import tile_name

    base = load(spark, sf, "places").select(tile_name(F.col("lat"), F.col("lon")).alias("tile")).distinct()
    return base.select("tile", F.explode(F.array(F.concat(F.lit("lst_p95_2021-2025_"), "tile", F.lit(".tif")), F.concat(F.lit("qa_count_2021-2025_"), "tile", F.lit(".tif")), F.lit("readme.txt"))).alias("name"))


_TILE = """tl as (select distinct case when lat >= 0 then 'N' else 'S' end || lpad(cast(abs(lat) as varchar), 2, '0') || case when lon >= 0 then 'E' else 'W' end || lpad(cast(abs(lon) as varchar), 3, '0') as tile, lat, lon
        from places)"""


def _items(spark: SparkSession, sf: str) -> DataFrame:
    from ..functions.grid import bbox, parse_tile

    f = _files(spark, sf)
    lat, lon = parse_tile(F.col("tile"))
    headers = f.select("tile").distinct().withColumn("b", bbox(lat, lon)).select("tile", "b.*")
    return k.build_items(k.pair_products(f), headers)


def _tasks(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "tasks")


def _costs(spark: SparkSession, sf: str) -> DataFrame:
    t = _tasks(spark, sf).select(F.col("worker").alias("tile"), "seconds", (F.col("worker") % 30).cast("int").alias("type"), (F.col("worker") % 4).alias("region"))
    return r.with_price(t, load(spark, sf, "prices"), 3)


_COST = """cst as (select t.worker as tile, seconds, coalesce(p.hourly, d.hourly) as hourly, case when p.hourly is not null then 'published' when d.hourly is not null then 'assumed' else 'none' end as provenance
        from tasks t
        left
        join prices p on t.worker % 30 = p.type and t.worker % 4 = p.region
        left
        join prices d on d.type = 3 and d.region = t.worker % 4)"""


def _tile_costs(spark: SparkSession, sf: str) -> DataFrame:
    """A duration, machine and lifecycle a tile; some durations are not known."""
    tile = F.col("tile")
    t = _tasks(spark, sf).groupBy(F.col("worker").alias("tile")).agg(F.sum("seconds").alias("seconds"))
    t = t.select("tile", F.when(tile % 11 != 0, F.col("seconds")).alias("seconds"), (tile % 30).cast("int").alias("type"), (tile % 4).alias("region"), F.when(tile % 3 == 0, "on-demand").when(tile % 3 == 1, "spot").alias("lifecycle"))
    return r.with_price(t, load(spark, sf, "prices"), 3)


_TCOST = """dur as (select worker as tile, sum(seconds) as seconds
        from tasks
        group by worker),
        cst as (select dur.tile, seconds, coalesce(p.hourly, d.hourly) as hourly, p.hourly is not null as published, dur.tile % 3 as l
        from dur
        left
        join prices p on dur.tile % 30 = p.type and dur.tile % 4 = p.region
        left
        join prices d on d.type = 3 and d.region = dur.tile % 4
        where dur.tile % 11 <> 0),
        est as (select tile, greatest(seconds, 60) / 3600 * hourly * case l when 0 then 1.0e0 else 0.3e0 end as low, greatest(seconds, 60) / 3600 * hourly * case l when 1 then 0.75e0 else 1.0e0 end as high, case when published and l = 0 then 'derived' else 'assumed' end as provenance
        from cst
        where hourly is not null)"""


def _clusters(spark: SparkSession, sf: str) -> DataFrame:
    """Clusters of two stages with their workers' lifetimes in minutes."""
    life = load(spark, sf, "orders").select((F.col("o_orderkey") % 40).alias("cluster"), (F.col("o_custkey") % 40 / 2).alias("life"))
    return life.groupBy("cluster").agg(F.collect_list("life").alias("lifetimes")).select("cluster", F.when(F.col("cluster") % 3 == 0, "composite_bands").otherwise("offsets").alias("stage"), (F.col("cluster") % 5 / 100 + 0.01).alias("usd_per_min"), "lifetimes")


_CLUSTERS = """w as (select o_orderkey % 40 as cluster, o_custkey % 40 / 2 as life
        from orders),
        part as (select cluster, life, least(life, 5) as boot, least(case when cluster % 3 = 0 then 15 else 6 end, greatest(life - 5, 0)) as useful
        from w),
        sp as (select cluster, case when cluster % 3 = 0 then 'composite_bands' else 'offsets' end as stage, cluster % 5 / 100 + 0.01e0 as rate, count(*) as workers, sum(boot) as boot, sum(useful) as useful, sum(greatest(life - boot - useful, 0)) as idle
        from part
        group by cluster)"""


def _waves(spark: SparkSession, sf: str) -> DataFrame:
    """Wave records; some lack a stamp, have no workers or end before they begin."""
    k = F.col("o_orderkey")
    at = lambda c, m: F.when(c, (k * 10 + m).cast("double"))
    return load(spark, sf, "orders").select(F.when(k % 2 == 0, "offsets").otherwise("composite").alias("stage"), k.alias("wave"), F.when(k % 6 != 0, F.col("o_custkey") % 50).alias("units"), (F.col("o_custkey") % 8).alias("max_workers"), at(k % 5 != 0, 0).alias("submitted_at"), at(F.lit(True), F.col("o_custkey") % 300).alias("first_completion_at"), at(F.lit(True), F.col("o_custkey") % 900 - 20).alias("last_completion_at"))


def _reads(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "events").where("event_id % 3 = 0").select(F.col("user_id").alias("worker"), F.col("ts").cast("timestamp").alias("started"), F.when(F.col("event_id") % 4 != 0, F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + 90_000_000)).alias("finished"))


def active_tasks(spark: SparkSession, sf: str) -> DataFrame:
    """Tasks by class, a sixth of which have not ended, and reads, a quarter of which have not."""
    t = _tasks(spark, sf).select("worker", r.prefix_class(F.col("prefix")).alias("class"), "started", F.when(F.col("task") % 6 != 0, F.col("seconds")).alias("seconds"))
    return r.timeline(load(spark, sf, "beats").select(F.col("tile").alias("worker"), F.col("updated_at").alias("ts")), t, _reads(spark, sf))


def plan_memory(spark: SparkSession, sf: str) -> DataFrame:
    """A run per customer, its orders are the tiles."""
    c = F.col("c_custkey")
    plan = load(spark, sf, "customer").select(c.alias("run"), (c * 10).alias("scenes"), F.create_map(F.lit("offsets"), (c % 7 * 1.3711), F.lit("composite"), (c % 5 * 1.313)).alias("floors"))
    o = load(spark, sf, "orders").select(F.col("o_custkey").alias("run"), F.when(F.col("o_orderkey") % 4 != 0, F.col("o_totalprice") / 10).alias("peak_mb"), F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderkey")).alias("scene_count"))
    return r.plan_comparison(plan, o)


def phase_table(spark: SparkSession, sf: str) -> DataFrame:
    """Staged runs against a baseline."""
    per = load(spark, sf, "beats").groupBy("tile", "phase").agg(F.sum("rss").alias("s")).where("phase <> 'view' or tile % 2 = 0")
    states = per.groupBy("tile").agg(F.map_from_entries(F.collect_list(F.struct("phase", "s"))).alias("phase_seconds")).withColumn("arm", F.when(F.col("tile") % 2 == 0, "staged").otherwise("baseline"))
    return _round(r.phase_comparison(states, "arm", "staged", "baseline"), *[f"{a}_{c}" for a in ("staged", "baseline") for c in ("min", "median", "max")])


def _source(spark: SparkSession, sf: str) -> DataFrame:
    """The events table as a stream of beats."""
    source = spark.readStream.schema(spark.read.parquet(f"{sf}/events.parquet").schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    source.withColumn("ts", F.col("ts").cast("timestamp")).createOrReplaceTempView("rasterspark_events")
    return spark.sql(TABLES["beats"].format(events="rasterspark_events"))


def _stream(spark: SparkSession, sf: str, make, mode: str) -> DataFrame:
    """Run a stream over the events table to its end; the rows it gave."""
    folder = shared_dir(spark, "stream")

    def keep(df, epoch):
        df.write.mode("overwrite").parquet(f"{folder}/out/epoch={epoch}")

    q = make(_source(spark, sf)).writeStream.outputMode(mode).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).foreachBatch(keep).start()
    q.awaitTermination()
    return spark.read.parquet(f"{folder}/out").drop("epoch")


def silent_fleet(spark: SparkSession, sf: str, stale_s: float = 3.0, limit_s: float = 300.0) -> DataFrame:
    """H2: the whole fleet beats once and falls silent; the stream goes on until each tile has settled or turned stale."""
    folder, store = shared_dir(spark, "watch"), "spark.sql.streaming.stateStore.providerClass"
    keys, before = load(spark, sf, "beats").select("tile", "attempt").distinct().count(), spark.conf.get(store)
    over = set()

    def keep(df, epoch):
        df.write.mode("overwrite").parquet(f"{folder}/out/epoch={epoch}")
        quiet = spark.read.parquet(f"{folder}/out").where("category <> 'running'").select("tile", "attempt").distinct().count()
        if quiet == keys:
            over.add(epoch)

    live.use_timers(spark)
    q = live.watch(_source(spark, sf), stale_s).writeStream.outputMode("update").option("checkpointLocation", f"{folder}/state").trigger(processingTime="1 second").foreachBatch(keep).start()
    try:
        end = time.time() + limit_s
        while not over and time.time() < end and q.isActive:
            time.sleep(0.2)
    finally:
        q.stop()
        spark.conf.set(store, before)
    if not over:
        raise TimeoutError(f"some tiles are running after {limit_s} s of silence")
    last = spark.read.parquet(f"{folder}/out").groupBy("tile", "attempt").agg(F.max_by(F.struct("phase", "beats", "category"), F.struct("beats", F.col("category") == "stale")).alias("s"))
    return last.select("tile", "attempt", "s.*")


def beat_latest(spark: SparkSession, sf: str) -> DataFrame:
    """H1-H3: the last row that the stream gave of each tile and attempt."""
    rows = _stream(spark, sf, st.latest, "update")
    last = rows.groupBy("tile", "attempt").agg(F.max_by(F.struct("updated_at", "phase", "beats", "rate", "eta_s", "category"), F.struct("beats", F.col("category") == "stale")).alias("s"))
    return _round(last.select("tile", "attempt", "s.*"), "rate", "eta_s")


def _linear(spark: SparkSession, sf: str) -> DataFrame:
    t = load(spark, sf, "orders").select((F.col("o_totalprice") / 1000).alias("y"), (F.col("o_custkey") % 97).cast("double").alias("x"))
    return _round(s.linear_fit(t, "x", "y"), "slope", "intercept", "r", "residual_sd")


def _budget(spark: SparkSession, sf: str) -> DataFrame:
    """Tiles at 0 to 72 degrees with a share of land; the first place is the reference."""
    i = F.col("id")
    return load(spark, sf, "places").select(F.when(i == 1, "ref").otherwise(F.col("name")).alias("name"), r.scenes_for((i % 25) * 3).alias("scenes"), ((i % 25) / 25).alias("land"))


_BUDGET = """t as (select case when id = 1 then 'ref' else name end as name, case when lat <= 2.5 then 3899 when lat <= 37.5 then round_even(3899 + (lat - 2.5e0) / 35.0e0 * (2758 - 3899), 0) when lat <= 57.5 then round_even(2758 + (lat - 37.5e0) / 20.0e0 * (3802 - 2758), 0) else 3802 end as s, land
        from (select id, name, cast(id % 25 * 3 as double) as lat, id % 25 / 25 as land
        from places) b)"""
def _arms(spark: SparkSession, sf: str) -> DataFrame:
    """D60 with each way to make one number of an arm."""
    t = _tasks(spark, sf).withColumn("arm", F.when(F.col("task") % 2 == 0, "a").otherwise("b"))
    parts = [s.relative_effect(t, "arm", "seconds", m, "task").withColumn("method", F.lit(m)) for m in ("single", "mean", "median")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _runs(spark: SparkSession, sf: str) -> DataFrame:
    """Benchmark runs: memory grows with scenes, a ninth of them failed."""
    n = F.col("o_custkey") % 40 + 10
    return load(spark, sf, "orders").select(n.alias("scenes"), (n * 100 + F.col("o_orderkey") % 50).alias("peak_mb"), (n * 60 + 200.0).alias("floor_mb"), (n * 7 + F.col("o_orderkey") % 3).alias("tasks"), (F.col("o_orderkey") % 9 != 0).alias("ok"))


_US = "epoch_us(updated_at)"

QUERIES = {
    "product_pairs": (
        lambda spark, sf: k.pair_products(_files(spark, sf)),
        with_tables("places", f"""with {_TILE} select '2021-2025' as \"window\", tile, 'lst_p95_2021-2025_' || tile || '.tif' as lst, 'qa_count_2021-2025_' || tile || '.tif' as qa
        from tl""")),
    "item_table": (
        lambda spark, sf: _items(spark, sf).select("id", "tile", "bbox.*", "start", "end", F.col("assets")["qa_count"]["href"].alias("qa")),
        with_tables("places", f"""with {_TILE} select tile || '_2021-2025' as id, tile, cast(lon as int) as west, cast(lat - 5 as int) as south, cast(lon + 5 as int) as east, cast(lat as int) as north, 2021 as start, 2025 as \"end\", 'qa_count_2021-2025_' || tile || '.tif' as qa
        from tl""")),
    "collection_extent": (
        lambda spark, sf: k.extent(_items(spark, sf)),
        with_tables("places", f"""with {_TILE} select cast(min(lon) as int) as west, cast(min(lat - 5) as int) as south, cast(max(lon + 5) as int) as east, cast(max(lat) as int) as north, 2021 as start, 2025 as \"end\"
        from tl""")),
    "hilbert_order": (
        lambda spark, sf: k.hilbert_sorted(_items(spark, sf)).select("id", "hilbert"),
        with_tables("places", f"""with recursive {_TILE}, h(id, x, y, d, k) as (select tile || '_2021-2025', cast(floor((lon + 2.5 + 180) / 360 * 65536) as bigint), cast(floor((lat - 2.5 + 90) / 180 * 65536) as bigint), cast(0 as bigint), cast(32768 as bigint) from tl
 union all select id, case when ry then x when rx then 65535 - y else y end, case when ry then y when rx then 65535 - x else x end, d + k * k * (case when rx and ry then 2 when rx then 3 when ry then 1 else 0 end), k // 2 from (select *, (x & k) > 0 as rx, (y & k) > 0 as ry from h where k > 0) t) select id, d as hilbert from h where k = 0""")),
    "hilbert_distance": (
        lambda spark, sf: load(spark, sf, "customer").select("c_custkey", hilbert(F.col("c_acctbal") / 60, F.col("c_acctbal") / 120, 2).alias("d")),
        """with p as (select c_custkey, cast(least(greatest(floor((c_acctbal / 60 + 180) / 360 * 4), 0), 3) as int) as x, cast(least(greatest(floor((c_acctbal / 120 + 90) / 180 * 4), 0), 3) as int) as y
        from customer) select c_custkey, [0, 3, 4, 5, 1, 2, 7, 6, 14, 13, 8, 9, 15, 12, 11, 10][x * 4 + y + 1] as d
        from p"""),
    "scenes_per_tile": (
        lambda spark, sf: _round(r.scenes_per_tile(tiles_of_box(load(spark, sf, "scenes").select("item_id", "west", "south", (F.col("west") + 7).alias("east"), (F.col("south") + 4).alias("north")))), "mean"),
        with_tables("scenes", """with t as (select a, o, count(*) as n
        from scenes, lateral (select unnest(range(cast(floor(south / 5) * 5 + 5 as bigint), cast(ceil((south + 4) / 5) * 5 as bigint) + 1, 5)) as a) x, lateral (select unnest(range(cast(floor(west / 5) * 5 as bigint), cast(ceil((west + 7) / 5) * 5 as bigint), 5)) as o) y
        group by a, o) select count(*) as tiles, min(n) as min, max(n) as max, round(avg(n), 4) as mean, cast(sum(n) as bigint) as total
        from t""")),
    "task_summary": (
        lambda spark, sf: _round(r.task_summary(_tasks(spark, sf)), "seconds", "share"),
        with_tables("tasks", """select prefix, case when prefix in ('open_qa', 'keixel') then 'read' when prefix in ('where-x', 'sub', 'getitem_sum-a') then 'compute' when prefix in ('Rechunk-merge', 'shuffle_p2p', 'transpose', 'getitem') then 'rechunk' when prefix = 'store-map' then 'store' else 'other' end as class, count(*) as n, round(sum(seconds), 4) as seconds, round(sum(seconds) / (select sum(seconds)
        from tasks), 4) as share
        from tasks
        group by prefix""")),
    "task_quantiles": (
        lambda spark, sf: _round(r.quantiles(_tasks(spark, sf), "seconds", ["prefix"]), "p50", "p95", "p99", "mean", "max"),
        with_tables("tasks", """select prefix, count(*) as n, round(quantile_cont(seconds, 0.5), 4) as p50, round(quantile_cont(seconds, 0.95), 4) as p95, round(quantile_cont(seconds, 0.99), 4) as p99, round(avg(seconds), 4) as mean, round(max(seconds), 4) as max
        from tasks
        group by prefix""")),
    "top_workers": (
        lambda spark, sf: r.top(_tasks(spark, sf).groupBy("worker").agg(F.round(F.sum("seconds"), 3).alias("seconds")), "seconds", 25),
        with_tables("tasks", "select worker, round(sum(seconds), 3) as seconds from tasks group by worker order by seconds desc, worker limit 25")),
    "active_tasks": (active_tasks, with_tables("beats tasks", """with e as (select worker, started as s, case when task % 6 <> 0 then started + to_microseconds(cast(trunc(seconds * 1000000) as bigint)) end as f, case when prefix in ('open_qa', 'keixel') then 'read' when prefix in ('where-x', 'sub', 'getitem_sum-a') then 'compute' when prefix in ('Rechunk-merge', 'shuffle_p2p', 'transpose', 'getitem') then 'rechunk' when prefix = 'store-map' then 'store' else 'other' end as class
        from tasks),
        d as (select user_id as worker, ts as s, case when event_id % 4 <> 0 then ts + interval 90 seconds end as f
        from events
        where event_id % 3 = 0),
        b as (select row_number() over () as i, tile, updated_at as u
        from beats),
        t as (select i, """ + ", ".join(f"count(*) filter (class = '{k}' and s <= u) - count(*) filter (class = '{k}' and f <= u) as active_{k}_tasks" for k in r.CLASSES) + """
        from b
        join e on e.worker = b.tile
        group by i),
        x as (select i, count(*) filter (s <= u) as sources_started, count(*) filter (f <= u) as sources_finished
        from b
        join d on d.worker = b.tile
        group by i) select b.tile as worker, u as ts, """ + ", ".join(f"coalesce(active_{k}_tasks, 0) as active_{k}_tasks" for k in r.CLASSES) + """, coalesce(sources_started, 0) as sources_started, coalesce(sources_finished, 0) as sources_finished
        from b
        left
        join t on t.i = b.i
        left
        join x on x.i = b.i""")),
    "newest_beats": (
        lambda spark, sf: r.newest(load(spark, sf, "beats")),
        with_tables("beats", """select tile, attempt, updated_at, phase, rss
        from (select *, row_number() over (partition by tile
        order by attempt desc, updated_at desc, event_id desc) as rn
        from beats) t
        where rn = 1""")),
    "attempt_counts": (
        lambda spark, sf: r.attempts(load(spark, sf, "beats")),
        with_tables("beats", """with p as (select tile, count(distinct attempt) as n
        from beats
        group by tile) select count(*) as tiles, cast(sum(n) as bigint) as attempts, max(n) as most, count(*) filter (n > 1) as retried
        from p""")),
    "beat_rates": (
        lambda spark, sf: _round(r.rates(load(spark, sf, "beats"), "rss"), "rate").select("event_id", "rate"),
        with_tables("beats", f"""with d as (select event_id, rss - lag(rss) over w as dv, ({_US} - lag({_US}) over w) / 1e6 as dt
        from beats
        window w as (partition by tile
        order by updated_at, event_id)) select event_id, round(coalesce(greatest(dv / nullif(dt, 0), 0), 0), 4) as rate
        from d""")),
    "beat_epochs": (
        lambda spark, sf: _round(r.epochs(load(spark, sf, "beats")), "rate", "rate5", "eta_s"),
        with_tables("beats", f"""with a as (select *, case when seq = lag(seq) over w and done >= lag(done) over w then 0 else 1 end as c
        from beats
        window w as (partition by tile
        order by updated_at, event_id)),
        b as (select *, sum(c) over (partition by tile
        order by updated_at, event_id rows unbounded preceding) as epoch
        from a),
        d as (select tile, epoch, done, total, row_number() over w as beats, {_US} as t, lag(done) over w as d1, lag({_US}) over w as t1, first_value(done) over v as d5, first_value({_US}) over v as t5
        from b
        window w as (partition by tile, epoch
        order by updated_at, event_id),
        v as (partition by tile, epoch
        order by updated_at, event_id rows between 4 preceding and current row)),
        e as (select *, case when t > t1 then greatest(done - d1, 0) / ((t - t1) / 1e6) end as rate, case when t > t5 then greatest(done - d5, 0) / ((t - t5) / 1e6) end as rate5
        from d
        qualify row_number() over (partition by tile
        order by epoch desc, beats desc) = 1) select tile, beats, round(rate, 4) as rate, round(rate5, 4) as rate5, round(case when rate5 > 0 then greatest(total - done, 0) / rate5 end, 4) as eta_s
        from e""")),
    "beat_gaps": (
        lambda spark, sf: _round(r.sample_gaps(load(spark, sf, "beats"), 600.0), "mean", "max", digits=3),
        with_tables("beats", f"""with d as (select ({_US} - lag({_US}) over (partition by tile
        order by updated_at, event_id)) / 1e6 as g
        from beats) select round(avg(g), 3) as mean, round(max(g), 3) as max, count(*) filter (g >= 600) as "over"
        from d
        where g is not null""")),
    "late_attach": (
        lambda spark, sf: r.late_attach(load(spark, sf, "beats").withColumn("elapsed_s", F.when(F.col("event_id") % 5 != 0, F.col("event_id") % 200)), 30.0),
        with_tables("beats", """select tile, coalesce(arg_min_null(case when event_id % 5 <> 0 then event_id % 200 end, (updated_at, event_id)) > 60, false) as late
        from beats
        group by tile""")),
    "beat_categories": (
        lambda spark, sf: load(spark, sf, "beats").groupBy(r.category(F.col("phase"), F.col("attempt") == 0, F.when(F.col("event_id") % 7 != 0, F.col("rss") * 60)).alias("category")).agg(F.count("*").alias("n")),
        with_tables("beats", """select case when phase in ('done', 'skipped') then 'done' when phase = 'failed' then 'failed' when attempt = 0 then 'done' when event_id % 7 = 0 or rss * 60 > 120 then 'stale' else 'running' end as category, count(*) as n
        from beats
        group by 1""")),
    "peak_resident": (
        lambda spark, sf: _round(r.peak_resident(load(spark, sf, "beats").select(F.col("tile").alias("worker"), F.col("updated_at").alias("ts"), F.when(F.col("event_id") % 2 == 0, F.col("rss")).otherwise(-F.col("rss")).alias("delta"), "event_id")), "peak"),
        with_tables("beats", """with h as (select tile, sum(case when event_id % 2 = 0 then rss else -rss end) over (partition by tile
        order by updated_at, event_id rows unbounded preceding) as held
        from beats) select tile as worker, round(max(held), 4) as peak
        from h
        group by tile""")),
    "price_lookup": (
        lambda spark, sf: _costs(spark, sf).groupBy("provenance").agg(F.count("*").alias("n"), F.round(F.avg("hourly"), 4).alias("hourly")),
        with_tables("tasks prices", f"with {_COST} select provenance, count(*) as n, round(avg(hourly), 4) as hourly from cst group by provenance")),
    "tile_costs": (
        lambda spark, sf: _round(r.tile_cost(_tile_costs(spark, sf)), "low", "high"),
        with_tables("tasks prices", f"with {_TCOST} select tile, round(low, 4) as low, round(high, 4) as high, provenance from est")),
    "fleet_cost": (
        lambda spark, sf: _round(r.fleet_cost(r.tile_cost(_tile_costs(spark, sf)), 700), "mean_low", "mean_high", "low", "high"),
        with_tables("tasks prices", f"""with {_TCOST} select count(*) as observed_tiles, 700 as tiles, round(avg(low), 4) as mean_low, round(avg(high), 4) as mean_high, round(avg(low) * 700, 4) as low, round(avg(high) * 700, 4) as high, case when count(*) < 700 or count(*) filter (provenance = 'assumed') > 0 then 'assumed' else 'derived' end as provenance
        from est""")),
    "dearest_tiles": (
        lambda spark, sf: r.top(_costs(spark, sf).groupBy("tile").agg(F.round(F.sum(r.billed_seconds(F.col("seconds")) / 3600 * F.col("hourly")), 4).alias("cost")), "cost", 10),
        with_tables("tasks prices", f"with {_COST} select tile, round(sum(greatest(seconds, 60) / 3600 * hourly), 4) as cost from cst group by tile order by cost desc, tile limit 10")),
    "rate_bands": (
        lambda spark, sf: _round(load(spark, sf, "prices").withColumn("b", r.rate_band(F.col("hourly"), F.when(F.col("type") % 3 == 0, "on-demand").when(F.col("type") % 3 == 1, "spot"))).select("region", "type", "b.low", "b.high"), "low", "high"),
        with_tables("prices", """select region, type, round(hourly * case type % 3 when 0 then 1.0e0 else 0.3e0 end, 4) as low, round(hourly * case type % 3 when 0 then 1.0e0 when 1 then 0.75e0 else 1.0e0 end, 4) as high
        from prices""")),
    "tile_outcomes": (
        lambda spark, sf: r.outcome(load(spark, sf, "customer").select(F.col("c_custkey").alias("tile")), load(spark, sf, "supplier").select(F.col("s_suppkey").alias("tile")), r.newest(load(spark, sf, "beats"))).groupBy("status", "phase").agg(F.count("*").alias("n")),
        with_tables("beats", """with n as (select tile, phase
        from (select *, row_number() over (partition by tile
        order by attempt desc, updated_at desc, event_id desc) as rn
        from beats) t
        where rn = 1) select case when c_custkey in (select s_suppkey
        from supplier) then 'completed' else 'failed' end as status, phase, count(*) as n
        from customer
        left
        join n on c_custkey = n.tile
        group by 1, 2""")),
    "pending_jobs": (
        lambda spark, sf: r.skip_done(load(spark, sf, "scenes").select(F.col("platform").alias("window"), (F.col("item_id") % 500).alias("tile")).distinct(), load(spark, sf, "scenes").where("cloud > 50").select(F.col("platform").alias("window"), (F.col("item_id") % 500).alias("tile")).distinct())[0],
        with_tables("scenes", "select distinct platform as \"window\", item_id % 500 as tile from scenes except select platform, item_id % 500 from scenes where cloud > 50")),
    "plan_memory": (plan_memory, """with o as (select o_custkey as run, case when o_orderkey % 4 <> 0 then o_totalprice / 10 end as p, case when o_orderkey % 3 <> 0 then o_orderkey end as s
        from orders),
        g as (select run, round(max(p) / 1024, 2) as peak, count(p) as np, min(s) as lo, max(s) as hi, count(s) as ns
        from o
        group by run),
        f as (select c_custkey as run, c_custkey % 7 * 1.3711e0 as a, c_custkey % 5 * 1.313e0 as b
        from customer),
        h as (select run, nullif(greatest(a, b), 0) as gib, case when a = 0 and b = 0 then null when a > b then 'offsets' when a < b then 'composite' else 'offsets' end as phase
        from f) select h.run, gib as floor_gib, phase as floor_phase, peak as observed_peak_gib, coalesce(np, 0) as observed_tiles, round(peak / gib, 2) as ratio, h.run * 10 as scenes_planned, lo as scenes_min, hi as scenes_max, coalesce(ns, 0) as scenes_tiles
        from h
        left
        join g on g.run = h.run"""),
    "phase_stats": (
        lambda spark, sf: _round(r.phase_stats(load(spark, sf, "beats").groupBy("tile", "phase").agg(F.sum("rss").alias("s")).groupBy("tile").agg(F.map_from_entries(F.collect_list(F.struct("phase", "s"))).alias("phase_seconds")), []), "min", "median", "max"),
        with_tables("beats", """with s as (select tile, phase, sum(rss) as s
        from beats
        group by tile, phase) select phase, count(*) as n, round(min(s), 4) as min, round(median(s), 4) as median, round(max(s), 4) as max
        from s
        group by phase""")),
    "phase_table": (phase_table, with_tables("beats", """with s as (select tile % 2 as k, phase, sum(rss) as s
        from beats
        where phase <> 'view' or tile % 2 = 0
        group by tile, phase) select phase, """ + ", ".join(f"nullif(count(*) filter (k = {i}), 0) as {a}_n, " + ", ".join(f"round({f}(s) filter (k = {i}), 4) as {a}_{f}" for f in ("min", "median", "max")) for i, a in ((0, "staged"), (1, "baseline"))) + """
        from s
        group by phase""")),
    "wave_envelope": (
        lambda spark, sf: r.wave_envelope(_waves(spark, sf)),
        """with w as (select case when o_orderkey % 2 = 0 then 'offsets' else 'composite' end as stage, o_orderkey as wave, case when o_orderkey % 6 <> 0 then o_custkey % 50 else 0 end as units, cast(o_custkey % 8 as double) as k, o_custkey % 300 as f, o_custkey % 900 - 20 as l
        from orders
        where o_orderkey % 5 <> 0) select stage, wave, units, k as workers, cast(greatest(ceil(units / k), 1) as bigint) as queue_depth, k * l as billed_vm_s, k * 300 as boot_vm_s, cast(f as double) as time_to_first_completion_s, cast(l - f as double) as drain_tail_s, greatest(k * l - k * 300, 0) as idle_upper_bound_vm_s
        from w
        where k > 0 and l >= 0"""),
    "worker_split": (
        lambda spark, sf: _round(r.split_cluster(_clusters(spark, sf)).drop("lifetimes", "usd_per_min"), *[f"{k}_{u}" for k in ("boot", "useful", "idle") for u in ("min", "usd")]),
        f"""with {_CLUSTERS} select cluster, stage, workers, {", ".join(f"round({k}, 4) as {k}_min, round({k} * rate, 4) as {k}_usd" for k in ("boot", "useful", "idle"))}
        from sp"""),
    "cost_layers": (
        lambda spark, sf: _round(r.cost_layers(r.split_cluster(_clusters(spark, sf)), 550.5, 620.25), "compute_offsets_usd", "compute_composite_usd", "provisioning_offsets_usd", "provisioning_composite_usd", "compute_usd", "provisioning_usd", "compute_composite_share", digits=1),
        f"""with {_CLUSTERS}, a as (select sum(useful * rate) filter (stage = 'offsets') * 550.5 as co, sum(useful * rate) filter (stage <> 'offsets') * 620.25 as cc, sum((boot + idle) * rate) filter (stage = 'offsets') * 550.5 as po, sum((boot + idle) * rate) filter (stage <> 'offsets') * 620.25 as pc
        from sp) select round(co, 1) as compute_offsets_usd, round(cc, 1) as compute_composite_usd, round(po, 1) as provisioning_offsets_usd, round(pc, 1) as provisioning_composite_usd, round(co + cc, 1) as compute_usd, round(po + pc, 1) as provisioning_usd, round(cc / (co + cc), 1) as compute_composite_share
        from a"""),
    "tile_equivalents": (
        lambda spark, sf: _round(r.tile_equivalents(_budget(spark, sf), "ref"), "by_work", "by_scenes"),
        with_tables("places", f"""with {_BUDGET} select round(sum(s * (land + 1)) / max(s * (land + 1)) filter (name = 'ref'), 4) as by_work, round(sum(s) / max(s) filter (name = 'ref'), 4) as by_scenes
        from t""")),
    "tile_bytes": (
        lambda spark, sf: _round(r.tile_bytes(_budget(spark, sf)), "coarse_gb", "native_gb", "offset_hours", "composite_hours", "vm_hours", "offset_vms", "composite_vms", "cost", "spot_low", "spot_high"),
        with_tables("places", f"""with {_BUDGET}, b as (select name, land, s * 9000.0e0 * 9000 * 4 as coarse, s * 18000.0e0 * 18000 * 4 as native
        from t),
        h as (select *, coarse * (land + 1) / 140e6 / 3600 as off, native / 45.5e6 / 3600 as comp
        from b) select name, round(coarse / 1e9, 4) as coarse_gb, round(native / 1e9, 4) as native_gb, round(off, 4) as offset_hours, round(comp, 4) as composite_hours, round(off + comp, 4) as vm_hours, round(off * 60 / 15, 4) as offset_vms, round(comp * 60 / 38, 4) as composite_vms, off + comp <= 1 as within_hour, round((off + comp) * 0.504e0, 4) as cost, round((off + comp) * 0.504e0 * 0.3e0, 4) as spot_low, round((off + comp) * 0.504e0 * 0.75e0, 4) as spot_high
        from h""")),
    "scenario_costs": (
        lambda spark, sf: _round(r.project(9000.0, 4000.0, 700, load(spark, sf, "places").select("name", (F.col("id") % 5 / 10).alias("capture_low"), (F.col("id") % 5 / 10 + 0.3).alias("capture_high"), (F.col("id") % 4 / 20).alias("retry"), (F.col("id") % 3 / 10).alias("contingency")), 60000.0, (0.9, 1.1), 9000.0), "low", "high", "spot_low", "spot_high", "credits_low", "credits_high", "storage_month", digits=2),
        with_tables("places", """with u as (select name, id % 5 / 10 as lo, id % 5 / 10 + 0.3e0 as hi, (1 + id % 4 / 20) * (1 + id % 3 / 10) as up
        from places),
        p as (select name, (9000.0e0 + 4000.0e0 * (1 - hi)) * up as low, (9000.0e0 + 4000.0e0 * (1 - lo)) * up as high, 60000 * (1 - 4.0e0 / 13 * hi) * up * 0.9e0 as cl, 60000 * (1 - 4.0e0 / 13 * lo) * up * 1.1e0 as ch
        from u),
        q as (select *, low * 0.3e0 + 24.15e0 as sl, high * 0.75e0 + 24.15e0 as sh
        from p) select name, round(low, 2) as low, round(high, 2) as high, round(sl, 2) as spot_low, round(sh, 2) as spot_high, round(cl, 2) as credits_low, round(ch, 2) as credits_high, 24.15e0 as storage_month, case when sl > 9000 then 'above' when sh < 9000 then 'below' else 'straddles' end as ceiling
        from q""")),
    "linear_fit": (_linear, """with t as (select o_totalprice / 1000 as y, cast(o_custkey % 97 as double) as x
        from orders) select count(*) as n, round(regr_slope(y, x), 4) as slope, round(regr_intercept(y, x), 4) as intercept, round(corr(x, y), 4) as r, round(sqrt((regr_syy(y, x) - regr_slope(y, x) * regr_sxy(y, x)) / (count(*) - 2)), 4) as residual_sd
        from t"""),
    "benchmark_stats": (
        lambda spark, sf: _round(s.repeat_stats(_tasks(spark, sf).withColumn("run", F.concat_ws("/", "prefix", F.col("worker") % 5)), ["run"], F.col("worker") % 7 != 0, "seconds"), "success", "mean", "sd", "min", "max"),
        with_tables("tasks", """with t as (select prefix || '/' || worker % 5 as run, case when worker % 7 <> 0 then seconds end as v
        from tasks) select run, count(*) as total_runs, count(v) as successful, count(*) - count(v) as failed, round(count(v) / count(*), 4) as success, round(avg(v), 4) as mean, round(case when count(v) = 1 then 0 else stddev_samp(v) end, 4) as sd, round(min(v), 4) as min, round(max(v), 4) as max
        from t
        group by run""")),
    "arm_effect": (
        lambda spark, sf: _round(_arms(spark, sf), "a", "b", "effect"),
        with_tables("tasks", """with m as (select 'median' as method, median(seconds) filter (task % 2 = 0) as a, median(seconds) filter (task % 2 <> 0) as b
        from tasks
        union all select 'mean', avg(seconds) filter (task % 2 = 0), avg(seconds) filter (task % 2 <> 0)
        from tasks
        union all select 'single', arg_min(seconds, task) filter (task % 2 = 0), arg_min(seconds, task) filter (task % 2 <> 0)
        from tasks) select method, round(a, 4) as a, round(b, 4) as b, round((a - b) / nullif(a, 0), 4) as effect
        from m""")),
    "peak_verdict": (
        lambda spark, sf: _round(s.peak_verdict(_runs(spark, sf)), "projected_tasks", "peak_spread", "projected_peak_mb", "ratio_growth", "mean_ratio"),
        """with t as (select o_custkey % 40 + 10 as scenes, (o_custkey % 40 + 10) * 100 + o_orderkey % 50 as peak, (o_custkey % 40 + 10) * 60 + 200.0e0 as fl, (o_custkey % 40 + 10) * 7 + o_orderkey % 3 as tasks
        from orders
        where o_orderkey % 9 <> 0) select count(*) as measured, round(regr_slope(tasks, scenes) * 2930 + regr_intercept(tasks, scenes), 4) as projected_tasks, round(max(peak) / min(peak), 4) as peak_spread, round(regr_slope(peak, scenes) * 2930 + regr_intercept(peak, scenes), 4) as projected_peak_mb, (regr_slope(peak, scenes) * 2930 + regr_intercept(peak, scenes)) / 1024 <= 64 as fits, round(max(peak / fl) / min(peak / fl), 4) as ratio_growth, round(avg(peak / fl), 4) as mean_ratio, case when max(peak / fl) / min(peak / fl) > 1.5 then 'growing_ratio' else 'constant_ratio' end as verdict
        from t"""),
    "output_equivalence": (
        lambda spark, sf: _round(s.equivalent(load(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").alias("v")), load(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 50 != 0, F.col("o_totalprice") + 0.001).alias("v")), ["o_orderkey"], "v", 0.01), "max_abs"),
        """select round(0.001, 4) as max_abs, count(*) filter (o_orderkey % 50 = 0) as null_mismatches, count(*) filter (o_orderkey % 50 = 0) = 0 as equivalent
        from orders"""),
    "beat_latest_stream": (beat_latest, with_tables("beats", f"""with a as (select *, {_US} as t, row_number() over (partition by tile, attempt order by updated_at desc, event_id desc) as rn, count(*) over (partition by tile, attempt) as beats, lag(done) over w as newer, first_value(seq) over w as last_seq, max({_US}) over () as most from beats window w as (partition by tile, attempt order by updated_at desc, event_id desc)),
 b as (select *, sum(case when rn > 1 and not (seq = last_seq and done <= newer) then 1 else 0 end) over (partition by tile, attempt order by rn) as broken from a where rn <= 5),
 c as (select tile, attempt, max(case when rn = 1 then updated_at end) as updated_at, max(case when rn = 1 then phase end) as phase, max(beats) as beats, max(case when rn = 1 then done end) as done, max(case when rn = 1 then t end) as t, max(case when rn = 1 then total end) as total, max(most) as most, arg_max(done, rn) filter (broken = 0) as d0, arg_max(t, rn) filter (broken = 0) as t0 from b group by tile, attempt),
 d as (select *, case when t > t0 then greatest(done - d0, 0) / ((t - t0) / 1e6) end as rate from c)
 select tile, attempt, updated_at, phase, beats, round(rate, 4) as rate, round(case when rate > 0 then greatest(total - done, 0) / rate end, 4) as eta_s, case when phase in ('done', 'skipped') then 'done' when phase = 'failed' then 'failed' when t // 1000 + 120000 < most // 1000 - 600000 then 'stale' else 'running' end as category from d""")),
    "silent_fleet_stream": (silent_fleet, with_tables("beats", """select tile, attempt, phase, beats, case when phase in ('done', 'skipped') then 'done' when phase = 'failed' then 'failed' else 'stale' end as category
        from (select *, row_number() over (partition by tile, attempt
        order by updated_at desc, event_id desc) as rn, count(*) over (partition by tile, attempt) as beats
        from beats) t
        where rn = 1""")),
    "beat_counts_stream": (
        lambda spark, sf: _stream(spark, sf, st.counts_by_category, "update"),
        """select case event_type when 'error' then 'failed' when 'signup' then 'done' when 'purchase' then 'done' else 'running' end as category, count(*) as n
        from events
        group by 1"""),
    "phase_time_stream": (
        lambda spark, sf: _round(_stream(spark, sf, lambda b: st.phase_time(b, "1 day"), "append"), "total"),
        with_tables("beats", """select date_trunc('day', updated_at) as start, phase, round(sum(rss), 4) as total, count(*) as n
        from beats
        group by 1, 2
        having date_trunc('day', updated_at) + interval 1 day <= (select max(updated_at)
        from beats) - interval 10 minutes""")),
}

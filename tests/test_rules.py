"""Rules by the values they must give, and plans by what they must not do."""

import datetime as dt
import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from rasterspark.operators import audit, composite, masks, normalize, runs, sweeps
from rasterspark.operators import tile as whole
from rasterspark.params import DN_SCALE, Params
from rasterspark.plans import tile
from rasterspark.sources import storage
from rasterspark.sources.fixtures import BASE_DIR, load
from rasterspark.streaming import beats as stream

SF = f"{BASE_DIR}/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


# --- scenes and scans ---------------------------------------------------------------------------------------------------


def scene(spark, *boxes, cloud=10.0, at=dt.datetime(2021, 6, 1), platform="landsat-8"):
    return spark.createDataFrame([(i, *map(float, b), cloud, at, platform) for i, b in enumerate(boxes)], "item_id long, west double, south double, east double, north double, cloud double, datetime timestamp, platform string")


def test_search_meets_boxes_and_the_antimeridian(spark):
    some = scene(spark, (0, 0, 1, 1), (5, 5, 9, 9), (-3, -3, 3, 3), (2, 2, 3, 3), (170, 0, -170, 5), (175, 0, 179, 5), (-179, 0, -175, 5))
    ids = lambda *box: {r.item_id for r in normalize.search(some, *box, "2021-01-01", "2021-12-31").collect()}
    assert ids(0.5, 0.5, 2, 2) == {0, 2, 3}  # touching counts
    assert ids(178, 1, -178, 2) == {4, 5, 6}  # a box over the antimeridian
    assert ids(171, 1, 172, 2) == {4} and ids(-172, 1, -171, 2) == {4} and ids(-100, 1, -90, 2) == set()


def test_search_takes_whole_days_and_is_strict_about_clouds(spark):
    find = lambda **k: normalize.search(scene(spark, (0, 0, 1, 1), **k), 0, 0, 1, 1, "2021-06-01", "2021-06-30", Params(max_cloud=50)).count()
    assert find(at=dt.datetime(2021, 6, 30, 23, 59)) == 1 and find(at=dt.datetime(2021, 7, 1)) == 0 and find(at=dt.datetime(2021, 5, 31, 23)) == 0
    assert find(cloud=50.0) == 0 and find(cloud=49.9) == 1 and find(platform="landsat-7") == 0


def test_scans_of_jobs_open_their_folders_only(spark, tmp_path):
    path = str(tmp_path / "obs")
    obs = load(spark, SF, "obs")
    whole.store_observations(obs, path)
    jobs = tile.jobs(spark, SF).where("tile = 'N10E000' and window = '1999-2001'")
    got = whole.of_jobs(spark.read.parquet(path), jobs)
    want = obs.where("tile = 'N10E000' and year(scene_ts) >= 1999")
    assert got.count() == want.count() > 0
    got.collect()
    assert "dynamicpruning" in plan(got)
    named = whole.of_jobs(spark.read.parquet(path).withColumn("f", F.col("_metadata.file_path")), jobs)
    opened = {r.f.split("/tile=")[1].rsplit("/", 1)[0] for r in named.select("f").distinct().collect()}
    assert opened == {f"N10E000/year={y}" for y in (1999, 2000, 2001)}
    # files that pruning leaves out are never listed for the scan
    scans = [n for n in _nodes(got._jdf.queryExecution().executedPlan()) if "Scan parquet" in n.nodeName()]
    files = [n.metrics().apply("numFiles").value() for n in scans if n.metrics().contains("numFiles")]
    assert 0 < min(files) <= 3 * 8


def _nodes(node):
    name = node.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return _nodes(node.executedPlan())
    if name.endswith("QueryStageExec"):
        return _nodes(node.plan())
    below = node.children()
    return [node, *[n for i in range(below.size()) for n in _nodes(below.apply(i))]]


def test_climatology_and_anomalies_read_buckets_without_a_shuffle(spark):
    dn = normalize.stack(load(spark, SF, "obs"))
    stack = normalize.stack_by_pixel(dn, 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        anom = normalize.anomalies(stack, normalize.climatology(stack))
        assert "Exchange" not in plan(anom) and "SortMergeJoin" in plan(anom)
        want = normalize.anomalies(dn, normalize.climatology(dn))
        cols = ("tile", "scene_ts", "y", "x", "dn", "anom2")
        assert rows(anom, *cols) == rows(want, *cols)
        assert plan(normalize.offsets(anom)).count("Exchange hashpartitioning") == 2  # the histogram, counted and by scene; no pixels
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_what_was_written_can_be_released(spark):
    path = storage.shared_dir(spark, "kept")
    spark.range(3).write.parquet(path)
    before = len(storage._folders)
    table = storage.bucketed(spark.range(10), "some", ["id"], 2)
    assert table.count() == 10 and len(storage._folders) == before + 1
    kept, storage._folders[:] = storage._folders[:], [path]
    assert storage.release(spark) == 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(path)
    storage._folders[:] = [f for f in kept if f != path]


# --- polygons -----------------------------------------------------------------------------------------------------------


def blocks(spark, land=(True,) * 4):
    """A 2 x 2 degree grid in quarters: north-west, north-east, south-west, south-east."""
    boxes = [(0, 0.0, 1.0, 1.0, 2.0), (1, 1.0, 1.0, 2.0, 2.0), (2, 0.0, 0.0, 1.0, 1.0), (3, 1.0, 0.0, 2.0, 1.0)]
    return spark.createDataFrame([(*b, x) for b, x in zip(boxes, land)], "block int, west double, south double, east double, north double, land boolean")


def ring(*points):
    return [(float(x), float(y)) for x, y in points]


def box(w, s, e, n):
    return [ring((w, s), (e, s), (e, n), (w, n), (w, s))]


@pytest.mark.parametrize(
    "footprints,land,want",
    [
        ([box(0, 0, 2, 2)], (True,) * 4, [1, 1, 1, 1]),
        ([box(1.2, 0.2, 1.8, 0.8)], (True,) * 4, [0, 0, 0, 1]),
        ([box(0.5, 1.5, 1.5, 1.9)], (True,) * 4, [1, 1, 0, 0]),
        ([box(0, 0, 2, 2)] * 3, (True, False, True, False), [3, 0, 3, 0]),
        ([None, box(0, 0, 2, 2), None, []], (True,) * 4, [1, 1, 1, 1]),
        ([box(-1, 1, 0, 2)], (True,) * 4, [1, 0, 1, 0]),  # an edge and a corner touch
        ([[ring((2, 3), (3, 2), (3, 3))]], (True,) * 4, [0, 0, 0, 0]),  # its box meets the block, the triangle doesn't
        ([[ring((1.5, 2.5), (2.5, 1.5), (3, 3))]], (True,) * 4, [0, 1, 0, 0]),  # a side touches the corner (2, 2)
        ([[ring((-5, -5), (9, -5), (9, 9), (-5, 9)), ring((-1, -1), (3, -1), (3, 3), (-1, 3))]], (True,) * 4, [0, 0, 0, 0]),  # all in the hole
        ([[ring((-5, -5), (9, -5), (9, 9), (-5, 9)), ring((-1, 1.5), (3, 1.5), (3, 3), (-1, 3))]], (True,) * 4, [1, 1, 1, 1]),
        ([[ring((-30, -30), (30, -30), (30, 30), (-30, 30))]], (True,) * 4, [1, 1, 1, 1]),  # over many buckets, once
    ],
)
def test_footprints_meet_blocks(spark, footprints, land, want):
    f = spark.createDataFrame([(x,) for x in footprints], "rings array<array<struct<x:double,y:double>>>")
    for bucket in (10.0, 0.7):
        assert [r.scenes for r in masks.block_weights(blocks(spark, land), f, bucket).orderBy("block").collect()] == want


def test_equal_footprints_and_boxes_are_compared_once(spark, monkeypatch):
    seen, meets = spark.sparkContext.accumulator(0), masks.polygon_meets_box

    def count(met):
        seen.add(1)
        return met

    counted = F.udf(count, "boolean").asNondeterministic()
    monkeypatch.setattr(masks, "polygon_meets_box", lambda *a: counted(meets(*a)))
    f = spark.createDataFrame([(box(0.5, 0.5, 1.5, 1.5),), (box(5, 5, 6, 6),)] * 300, "rings array<array<struct<x:double,y:double>>>")
    b = spark.range(200).select(F.col("id").alias("block"), *[F.lit(v).alias(k) for k, v in (("west", 0.0), ("south", 0.0), ("east", 1.0), ("north", 1.0))], (F.col("id") % 2 == 0).alias("land"))
    got = {r.block: r.scenes for r in masks.block_weights(b, f).collect()}
    assert got == {i: 300 if i % 2 == 0 else 0 for i in range(200)} and 0 < seen.value < 10


def edges_of(poly_id, cls, *rings):
    return [(poly_id, cls, float(p[0]), float(p[1]), float(q[0]), float(q[1])) for r in rings for p, q in zip(r, r[1:] + r[:1])]


EDGES = "poly_id int, class int, x0 double, y0 double, x1 double, y1 double"


def inside(rings, x, y):
    n = 0
    for r in rings:
        for (x0, y0), (x1, y1) in zip(r, r[1:] + r[:1]):
            if (y0 <= y) != (y1 <= y) and x0 + (y - y0) * (x1 - x0) / (y1 - y0) > x:
                n += 1
    return n % 2 == 1


def test_rasters_by_tile(spark):
    rng = random.Random(4)
    star = lambda cx, cy, r, k: [(cx + r * rng.uniform(0.4, 1) * math.cos(2 * math.pi * i / k), cy + r * rng.uniform(0.4, 1) * math.sin(2 * math.pi * i / k)) for i in range(k)]
    hole = lambda r, cx, cy: [(cx + (x - cx) * 0.35, cy + (y - cy) * 0.35) for x, y in r]
    polys = []
    for i, (cx, cy, r) in enumerate([(20.3, 17.1, 16), (45.2, 40.7, 20), (5.1, 50.3, 9)]):
        outer = star(cx, cy, r, 11)
        polys.append((i, i % 2 + 1, [outer, hole(outer, cx, cy)]))
    df = spark.createDataFrame([e for i, c, rings in polys for e in edges_of(i, c, *rings)], EDGES)
    names = [(f"t{r}{c}", r, c) for r in range(4) for c in range(4) if (r, c) != (1, 1)]
    tiles = spark.createDataFrame(names, "tile string, row int, col int")
    got = {(r.tile, r.y, r.x): r["class"] for r in masks.rasterise(df, tiles, 16, 16).collect()}
    want = {}
    for y in range(64):
        for x in range(64):
            c = max((c for _, c, rings in polys if inside(rings, x + 0.5, y + 0.5)), default=None)
            if c is not None and (y // 16, x // 16) != (1, 1):
                want[f"t{y // 16}{x // 16}", y % 16, x % 16] = c
    assert got == want and len(want) > 500


def test_coast_in_mercator_metres(spark):
    side = [(1, 1, -179.7, 59.8, -176.9, 57.3), (1, 1, -179.0, 56.0, -179.0, 56.0)]  # one long diagonal side and a point
    df = spark.createDataFrame(side, "poly_id int, class int, lon0 double, lat0 double, lon1 double, lat1 double")
    tiles = spark.createDataFrame([(f"t{r}{c}", r, c) for r in range(2) for c in range(2)], "tile string, row int, col int")
    got = {(r.tile, r.y, r.x) for r in masks.buffered_mask(df, tiles, 25, 25, 30000.0, 60, -180.0, 10.0).collect()}
    radius = 6378137.0
    m = lambda lon, lat: (radius * math.radians(lon), radius * math.log(math.tan(math.pi / 4 + math.radians(lat) / 2)))
    want = set()
    for y in range(50):
        for x in range(50):
            px, py = m(-180 + (x + 0.5) / 10, 60 - (y + 0.5) / 10)
            for _, _, *ends in side:
                (ax, ay), (bx, by) = m(*ends[:2]), m(*ends[2:])
                d2 = (bx - ax) ** 2 + (by - ay) ** 2
                t = max(0.0, min(1.0, ((px - ax) * (bx - ax) + (py - ay) * (by - ay)) / d2)) if d2 else 0.0
                if math.hypot(px - ax - t * (bx - ax), py - ay - t * (by - ay)) <= 30000:
                    want.add((f"t{y // 25}{x // 25}", y % 25, x % 25))
    assert got == want and len(want) > 50


# --- composites ---------------------------------------------------------------------------------------------------------


def test_scenes_without_a_class_count_zero(spark):
    """100, 200 and 150 urban pixels in summer, 30 in June; one more June scene has none at all."""
    counts = [(dt.datetime(2021, 1, 5), 100), (dt.datetime(2021, 1, 20), 200), (dt.datetime(2021, 2, 1), 150), (dt.datetime(2021, 6, 1), 30)]
    dn = spark.createDataFrame([("t", ts, 0, x, 40000) for ts, n in counts for x in range(n)], "tile string, scene_ts timestamp, y int, x int, dn int")
    classes = spark.range(300).select(F.lit("t").alias("tile"), F.lit(0).alias("y"), F.col("id").cast("int").alias("x"), F.lit("urban").alias("class"))
    scenes = spark.createDataFrame([("t", ts) for ts, _ in counts] + [("t", dt.datetime(2021, 6, 9))], "tile string, scene_ts timestamp")
    got = dict(rows(composite.class_counts(dn, classes, scenes), "period", "mean_pixels"))
    assert got == {"1": 150.0, "2": 150.0, "6": 15.0, "summer": 150.0, "non_summer": 15.0}


def counts_of(c):
    """Quarter counts of a temperature."""
    return round((c + 273.15 - 149.0) / DN_SCALE * 4)


@pytest.mark.parametrize("temps,valid,reason", [((20, 21, 25), True, None), ((20, 20, 20), False, "uniform values"), ((-25, 30, 40), False, None), ((20, 30, 81), False, None), ((2, 3, 4), False, None)])
def test_believable_medians(spark, temps, valid, reason):
    v = spark.createDataFrame([("t", 0, x, counts_of(c)) for x, c in enumerate(temps)], "tile string, y int, x int, v4 long")
    r = composite.plausibility(v).first()
    assert (r.valid, r.reason) == (valid, reason)


def test_counts_keep_their_zeros(spark):
    df = spark.createDataFrame([("t", 0), ("t", 4)], "tile string, m1 int")
    assert composite.band_stats(df, "m1", None).first().mean == 2 and composite.band_stats(df, "m1").first().mean == 4
    assert rows(composite.band_table(df.select("tile", "m1", F.col("m1").alias("lst_dn")), {"m1": None, "lst_dn": 0}), "band", "mean", "valid_percent") == [("lst_dn", 4.0, 50.0), ("m1", 2.0, 100.0)]


def test_striping_is_over_land(spark):
    land = spark.createDataFrame([("t", 0, 0), ("t", 0, 1)], "tile string, y int, x int")
    comp = spark.createDataFrame([("t", 0, 0, 4), ("t", 0, 5, 999)], "tile string, y int, x int, n int")
    assert composite.striping(comp, land).first().striping == 1.0  # columns of 4 and 0


def test_a_broken_level_is_found(spark):
    native = spark.range(128 * 128).select(F.lit("t").alias("tile"), F.floor(F.col("id") / 128).alias("y"), (F.col("id") % 128).alias("x"), F.lit(3000).alias("lst_dn"), *[(F.col("id") % (3 + m)).cast("int").alias(f"m{m}") for m in composite.MONTHS])
    levels = composite.pyramid(native)
    assert dict(rows(levels.groupBy("factor").count(), "factor", "count")) == {f: (128 // f) ** 2 for f in (2, 4, 8, 16, 32, 64)}
    assert plan(levels).count("Exchange hashpartitioning") == 1
    assert composite.pyramid_report(native, levels).where("problem is not null").count() == 0
    bad = levels.withColumns({"m7": F.when(F.col("factor") == 16, 0.0).otherwise(F.col("m7")), "m9": F.when(F.col("factor") == 4, F.col("m9") + 3).otherwise(F.col("m9"))}).where("factor <> 64")
    found = rows(composite.pyramid_report(native, bad).where("problem is not null"), "band", "factor", "problem")
    assert found == sorted([("m7", 16, "collapsed"), ("m9", 4, "drifted"), *[(f"m{m}", 64, "missing") for m in composite.MONTHS]])


# --- audits -------------------------------------------------------------------------------------------------------------


def test_hot_rates_are_of_valid_pixels(spark):
    px = spark.createDataFrame([("t", "0", "hot"), *[("t", "0", "missing")] * 3, *[("t", "3", "cool")] * 4], "tile string, tier string, state string")
    r = {x.tier: x for x in audit.cross_tab(px).collect()}
    assert set(r) == set(audit.TIERS)
    assert r["0"].hot_pct_of_tier_valid == 100 and r["0"].share_of_tile_pct == 50 and r["0"].missing_pct_of_tier == 75
    assert r["0"].hot_enrichment_vs_tile == 5.0 and r["0"].missing_enrichment_vs_tile == 2.0 and r["0"].share_of_tile_missing_pct == 100
    assert r["3"].hot_enrichment_vs_tile == 0 and r["absent"].total_pixels == 0 and r["absent"].hot_pct_of_tier_valid is None
    t = audit.tile_totals(px).first()
    assert (t.total_pixels, t.valid_pixels, t.hot_pct_of_valid) == (8, 5, 20.0)


def test_tradeoffs_of_rules(spark):
    px = spark.createDataFrame([("t", 5, 5, "hot"), ("t", 5, 6, "cool"), ("t", 5, 7, "hot"), ("t", 6, 6, "missing"), ("t", 9, 9, "cool")], "tile string, row long, col long, state string")
    gaps = spark.createDataFrame([(5, 5)], "row long, col long")
    r = {x.rule: x for x in audit.tradeoffs(px, gaps).collect()}
    assert [r[k].valid_pixels_removed for k in ("grow0", "grow0_hot", "grow1", "grow1_hot")] == [1, 1, 2, 1]
    assert r["grow1"].cool_pixels_lost_per_hot_pixel_removed == 1.0 and r["grow1"].missing_pixels_annotated_pct == 100 and r["grow1_hot"].missing_pixels_annotated == 0
    assert r["grow0"].hot_pixels_remaining == 1 and r["grow0"].valid_pixels_removed_pct == 25.0


def test_shares_by_rollup(spark):
    area = spark.createDataFrame([(11, "gap", 1.0), (11, "normal", 3.0), (30, "low_confidence", 2.0), (30, "gap", 2.0)], "class int, tier string, km2 double")
    got = {r["class"]: (r.land_km2, r.gap_pct, r.low_confidence_pct) for r in audit.gap_shares(area, (30,)).collect()}
    assert got == {"11": (4.0, 25.0, 0.0), "30": (4.0, 50.0, 50.0), "all": (8.0, 37.5, 25.0), "urban": (4.0, 50.0, 50.0)}
    assert {r["class"]: r.gap_pct for r in audit.gap_shares(area.limit(0), (30,)).collect()} == {"all": 0.0, "urban": 0.0}


def test_gap_validation(spark):
    at = lambda *xs: spark.createDataFrame([("t", 0, x) for x in xs], "tile string, y int, x int")
    r = audit.validate(at(0, 1, 8), at(1, 2, 3, 9), at(0, 1, 2, 3)).first()
    assert (r.land_pixels, r.observed_gap_pct, r.predicted_gap_pct, r.agreement_iou, r.observed_only_pixels, r.predicted_only_pixels) == (4, 75.0, 50.0, 0.25, 2, 1)
    assert audit.validate(at(9), at(9), at(0)).first().agreement_iou == 1.0


def test_core_columns_of_the_coverage_report(spark):
    need = spark.createDataFrame([("A", "g1", True), ("A", "g2", False), ("B", "g2", True), ("B", "g3", True), ("C", "g4", True)], "tile string, granule string, core boolean")
    names = lambda *g: spark.createDataFrame([(x,) for x in g], "granule string")
    r = audit.coverage_report(need, names("g1", "x"), names("g1", "g2", "g4"), names("g2")).first()
    assert (r.tiles, r.expected, r.consumed_of_expected, r.missing, r.missing_core, r.extra_not_expected) == (3, 4, 1, 3, 3, 1)
    assert (r.absent_upstream, r.absent_upstream_core, r.fetchable, r.fetchable_core, r.tiles_missing_core, r.tiles_missing_any) == (1, 1, 2, 2, 2, 3)
    assert (r.fetchable_core_sample, r.absent_upstream_core_sample, r.complete) == ("g2,g4", "g3", False)
    assert (r.class_absent_upstream, r.class_absent_within_fetch_domain, r.class_absent_outside_fetch_domain, r.class_absent_unverified_upstream) == (1, 1, 1, 0)
    r = audit.coverage_report(need, names("g1"), None).first()  # without an inventory nothing is excused
    assert (r.absent_upstream, r.fetchable, r.class_absent_unverified_upstream) == (0, 3, 3)


# --- runs and costs -----------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "key,want",
    [
        ("_runs/r/N40W075.1.destripe_offsets.profile.json", ("N40W075", 1, "profile", "destripe_offsets")),
        ("_runs/r/N40W075.destripe_offsets.profile.json", ("N40W075", 0, "profile", "destripe_offsets")),
        ("_runs/r/N40W075.2.json", ("N40W075", 2, "state", None)),
        ("N40W075.json", ("N40W075", 0, "state", None)),
        ("_runs/r/N40W075.progress.json", ("N40W075", 0, "progress", None)),
        ("_runs/r/N40W075.11.log", ("N40W075", 11, "log", None)),
        ("_runs/r/readme.txt", (None, None, None, None)),
        ("_runs/r/bare.profile.json", (None, None, None, None)),
        (None, (None, None, None, None)),
    ],
)
def test_artifact_keys(spark, key, want):
    df = spark.createDataFrame([(key,)], "key string")
    assert tuple(df.select(*runs.key_parts(F.col("key"))).first()) == want


def test_artifacts_of_a_tile(spark):
    keys = ["T.json", "T.1.json", "T.2.json", "T.1.log", "T.3.log", "T.2.a.profile.json", "T.2.b.profile.json", "U.progress.json", "U.log", "x.txt"]
    r = {x.tile: x for x in runs.artifacts(spark.createDataFrame([(f"r/{k}",) for k in keys], "key string")).collect()}
    t, u = r["T"], r["U"]
    assert t.states == {0: "r/T.json", 1: "r/T.1.json", 2: "r/T.2.json"} and t.logs == {1: "r/T.1.log", 3: "r/T.3.log"} and t.profiles == {2: {"a": "r/T.2.a.profile.json", "b": "r/T.2.b.profile.json"}}
    assert (t.attempt, t.state_key, t.log_key, t.body_key, t.settled, t.attempts, t.highest_attempt) == (2, "r/T.2.json", None, "r/T.2.json", True, [1, 2], 3)
    assert t.profile_keys == t.profiles[2] and set(r) == {"T", "U"}
    assert (u.attempt, u.state_key, u.log_key, u.body_key, u.settled, u.attempts, u.highest_attempt) == (0, None, "r/U.log", "r/U.progress.json", False, [], 0)


def test_outcomes_come_from_the_listing(spark):
    names = lambda *t: spark.createDataFrame([(x,) for x in t], "tile string")
    states = spark.createDataFrame([("a", "failed"), ("b", "done")], "tile string, phase string")
    assert rows(runs.outcome(names("a", "b", "c"), names("a"), states).na.fill("-"), "tile", "status", "phase") == [("a", "completed", "failed"), ("b", "failed", "done"), ("c", "failed", "-")]


def estimates(spark, *rows_):
    return spark.createDataFrame([(i, float(lo), float(hi), p) for i, (lo, hi, p) in enumerate(rows_)], "tile int, low double, high double, provenance string")


def test_fleet_costs(spark):
    fleet = lambda tiles, *e: runs.fleet_cost(estimates(spark, *e), tiles).first()
    r = fleet(700, (1, 1, "derived"), (3, 3, "derived"))
    assert (r.mean_low, r.low, r.observed_tiles, r.provenance) == (2.0, 1400.0, 2, "assumed")
    r = fleet(10, (1, 4, "assumed"))
    assert (r.low, r.high) == (10.0, 40.0)
    assert fleet(2, (1, 1, "derived"), (3, 3, "derived")).provenance == "derived" and fleet(2, (1, 1, "derived"), (3, 3, "assumed")).provenance == "assumed"
    assert fleet(700) is None


def test_tile_costs(spark):
    rows_ = [("a", 3600.0, 0.504, "published", "on-demand"), ("b", 3600.0, 0.504, "published", "spot"), ("c", 1.0, 3.6, "published", None), ("d", None, 1.0, "published", "spot"), ("e", 9.0, None, "none", "spot"), ("f", 3600.0, 1.0, "assumed", "on-demand")]
    got = {r.tile: (round(r.low, 6), round(r.high, 6), r.provenance) for r in runs.tile_cost(spark.createDataFrame(rows_, "tile string, seconds double, hourly double, provenance string, lifecycle string")).collect()}
    assert got == {"a": (0.504, 0.504, "derived"), "b": (0.1512, 0.378, "assumed"), "c": (0.018, 0.06, "assumed"), "f": (1.0, 1.0, "assumed")}


def test_waves_and_workers(spark):
    w = spark.createDataFrame([("o", 1, 10, 4, 0.0, 400.0, 1000.0), ("o", 2, 10, 4, None, 1.0, 2.0), ("o", 3, 1, 0, 0.0, 1.0, 2.0), ("o", 4, 0, 2, 5.0, 4.0, 3.0)], "stage string, wave int, units int, max_workers int, submitted_at double, first_completion_at double, last_completion_at double")
    r = runs.wave_envelope(w).collect()
    assert [tuple(x) for x in r] == [("o", 1, 10, 4.0, 3, 4000.0, 1200.0, 400.0, 600.0, 2800.0)]
    c = spark.createDataFrame([("offsets_round_1", 0.5, [1.89, 20.0]), ("composite_round_1", 0.1, [32.0])], "stage string, usd_per_min double, lifetimes array<double>")
    split = runs.split_cluster(c)
    r = {x.stage: x for x in split.collect()}
    o, k = r["offsets_round_1"], r["composite_round_1"]
    assert (round(o.boot_min, 9), o.useful_min, o.idle_min) == (6.89, 6.0, 9.0) and (k.boot_min, k.useful_min, k.idle_min) == (5.0, 15.0, 12.0)
    a = runs.cost_layers(split, 10.0, 2.0).first()
    assert (a.compute_offsets_usd, a.compute_composite_usd) == (30.0, 3.0) and abs(a.provisioning_usd - (15.89 * 5 + 17 * 0.2)) < 1e-9 and abs(a.compute_composite_share - 3 / 33) < 1e-9


@pytest.mark.parametrize("elapsed,late", [(600.0, True), (30.0, False), (60.0, False), (None, False)])
def test_a_late_watcher_is_marked(spark, elapsed, late):
    beats = spark.createDataFrame([("t", dt.datetime(2024, 1, 1), 1, elapsed), ("t", dt.datetime(2024, 1, 2), 2, 9999.0)], "tile string, updated_at timestamp, event_id long, elapsed_s double")
    assert runs.late_attach(beats, 30.0).first().late == late


def test_gaps_of_the_limit_count(spark):
    at = [0.0, 1.0, 3.0, 6.0]
    beats = spark.createDataFrame([("t", dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s), i) for i, s in enumerate(at)], "tile string, updated_at timestamp, event_id long")
    r = runs.sample_gaps(beats).first()
    assert (r.mean, r.max, r["over"]) == (2.0, 3.0, 2)


def test_timeline_by_class(spark):
    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    samples = spark.createDataFrame([("w", at(s)) for s in (0, 5, 10, 20)], "worker string, ts timestamp")
    tasks = spark.createDataFrame([("w", "read", at(0), 5.0), ("w", "compute", at(4), None), ("w", "read", at(6), 4.0)], "worker string, class string, started timestamp, seconds double")
    reads = spark.createDataFrame([("w", at(5), at(10)), ("w", at(11), None)], "worker string, started timestamp, finished timestamp")
    got = rows(runs.timeline(samples, tasks, reads), "ts", "active_read_tasks", "active_compute_tasks", "sources_started", "sources_finished")
    assert [g[1:] for g in got] == [(1, 0, 0, 0), (0, 1, 1, 0), (0, 1, 1, 1), (0, 1, 2, 1)]


def test_plans_against_runs(spark):
    plans = spark.createDataFrame([("r", 300, {"offsets": 4.0, "composite": 2.0, "none": 0.0}), ("empty", 1, {})], "run string, scenes int, floors map<string,double>")
    seen = spark.createDataFrame([("r", 1024.0 * 20, 250), ("r", 1024.0 * 78.6, None), ("r", None, 310)], "run string, peak_mb double, scene_count int")
    r = {x.run: x for x in runs.plan_comparison(plans, seen).collect()}
    assert tuple(r["r"])[1:] == (4.0, "offsets", 78.6, 2, 19.65, 300, 250, 310, 2)
    assert tuple(r["empty"])[1:] == (None, None, None, 0, None, 1, None, None, 0)


def test_one_run_has_no_spread(spark):
    df = spark.createDataFrame([("a", True, 2.0), ("a", False, None), ("b", False, None), ("c", True, 1.0), ("c", True, 3.0)], "k string, ok boolean, s double")
    r = {x.k: x for x in sweeps.repeat_stats(df, ["k"], F.col("ok"), "s").collect()}
    assert (r["a"].total_runs, r["a"].successful, r["a"].failed, r["a"].success, r["a"].mean, r["a"].sd) == (2, 1, 1, 0.5, 2.0, 0.0)
    assert (r["b"].success, r["b"].mean, r["b"].sd) == (0.0, None, None) and round(r["c"].sd, 6) == 1.414214


def test_scenario_costs_have_credits(spark):
    s = spark.createDataFrame([("m", 0.2, 0.5, 0.1, 0.2)], "name string, capture_low double, capture_high double, retry double, contingency double")
    r = runs.project(3000.0, 1000.0, 700, s, 1000.0, (0.5, 1.0)).first()
    up = 1.1 * 1.2
    assert abs(r.low - 3500 * up) < 1e-9 and abs(r.high - 3800 * up) < 1e-9 and abs(r.spot_low - (r.low * 0.3 + 24.15)) < 1e-9
    assert abs(r.credits_low - 1000 * (1 - 0.25 * 0.5) * up * 0.5) < 1e-9 and abs(r.credits_high - 1000 * (1 - 0.25 * 0.2) * up) < 1e-9
    assert r.ceiling == "straddles" and runs.project(3000.0, 1000.0, 700, s, ceiling=9e9).first().ceiling == "below"


def test_tiles_of_one_group_turn_stale_on_their_own():
    class State:
        exists = hasTimedOut = False
        now, get, due = 0, None, None

        def getCurrentWatermarkMs(self):
            return self.now

        def update(self, value):
            self.exists, self.get = True, value

        def setTimeoutTimestamp(self, at):
            self.due = at

        def remove(self):
            self.exists = False

    def call(frames, **what):
        vars(state).update(what)
        return {(r.tile, r.attempt): (r.beats, r.category, r.updated_at) for f in run((0,), iter(frames), state) for r in f.itertuples()}

    at = lambda *seconds: [dt.datetime(1970, 1, 1, 0, 0, s) for s in seconds]
    beats = lambda tiles, seconds: pd.DataFrame({"tile": tiles, "attempt": 1, "updated_at": at(*seconds), "event_id": range(len(tiles)), "seq": 1, "done": range(len(tiles)), "total": 9, "phase": "view"})
    state, run = State(), stream._advance(10_000)
    assert call([beats([1, 2, 1], [1, 2, 5]), beats([2], [3])]) == {(1, 1): (2, "running", at(5)[0]), (2, 1): (2, "running", at(3)[0])} and state.due == 13_000
    assert call([beats([1], [4])], now=13_001) == {(1, 1): (3, "running", at(5)[0]), (2, 1): (2, "stale", at(3)[0])} and state.due == 15_000
    assert call([], hasTimedOut=True, now=15_001) == {(1, 1): (3, "stale", at(5)[0])} and not state.exists


# --- sweeps -------------------------------------------------------------------------------------------------------------


def test_cloudy_but_clear(spark):
    at = lambda d: dt.datetime(2021, 1, d)
    table = spark.createDataFrame([("t", at(1), 100, True), ("t", at(2), 60, True), ("t", at(3), 60, False), ("t", at(4), 40, True)], "tile string, scene_ts timestamp, n_valid long, keep boolean")
    cover = spark.createDataFrame([(at(1), 95.0), (at(2), 70.0), (at(3), 99.0), (at(4), 99.0)], "scene_ts timestamp, cover double")
    r = sweeps.cloud_correlation(table, cover).first()
    assert (r.cloudy_but_clear_70, r.cloudy_but_clear_90) == (2, 1)
    t = {x.threshold: x for x in sweeps.cloud_tradeoff(table, cover, (80, 100)).collect()}
    assert (t[80].dropped, t[80].dropped_frac, t[80].already_rejected, round(t[80].already_rejected_frac, 4), t[80].observations_lost, t[80].observations_lost_frac) == (3, 0.75, 1, 0.3333, 140, 0.7)
    assert (t[100].dropped, t[100].already_rejected_frac, t[100].observations_lost_frac) == (0, 0.0, 0.0)


def test_correlation_of_what_is_constant(spark):
    at = lambda d: dt.datetime(2021, 1, d)
    rows = [(t, at(d), n, True) for t, counts in (("flat", (7, 7, 7)), ("one", (5,)), ("two", (4, 8, 6))) for d, n in enumerate(counts, 1)]
    table = spark.createDataFrame(rows, "tile string, scene_ts timestamp, n_valid long, keep boolean")
    cover = spark.createDataFrame([(at(1), 10.0), (at(2), 30.0), (at(3), 20.0)], "scene_ts timestamp, cover double")
    got = {r.tile: r["corr"] for r in sweeps.cloud_correlation(table, cover).collect()}
    assert math.isnan(got["flat"]) and math.isnan(got["one"]) and abs(got["two"] - 1) < 1e-12
    make = lambda *r: spark.createDataFrame([("t", 0, i, v, 1) for i, v in enumerate(r)], "tile string, y int, x int, lst double, n int")
    assert math.isnan(sweeps.compare_composites(make(0.1, 0.1, 0.1), make(1.0, 2.0, 3.0)).first()["corr"])
    assert sweeps.compare_composites(make(None, 0.1), make(1.0, None)).first()["corr"] is None
    flat = spark.createDataFrame([(float(i), 0.1) for i in range(49)], "x double, y double").repartition(7)
    r = sweeps.linear_fit(flat, "x", "y").first()
    assert r.n == 49 and math.isnan(r.r) and abs(r.slope) < 1e-12


def test_offsets_compared_where_they_are_constant(spark):
    make = lambda *r: spark.createDataFrame([("t", dt.datetime(2021, 1, i + 1), v, 100) for i, v in enumerate(r)], "tile string, scene_ts timestamp, offset_c double, n_valid long")
    flat, bent = make(0.1, 0.1, 0.1), make(0.1, 0.2, 0.3)
    r = sweeps.compare_offsets(bent, flat, 10, 4).first()
    assert r.scored == 3 and math.isnan(r["corr"]) and r.slope == 0
    r = sweeps.compare_offsets(flat, bent, 10, 4).first()
    assert math.isnan(r["corr"]) and math.isnan(r.slope)
    assert sweeps.compare_offsets(make(0.1, 0.1), make(0.1, 0.1), 10, 4).first()["corr"] == 0  # two are too few


@pytest.mark.parametrize("name", ["annual_ablation", "thinned_offsets"])
def test_observations_are_read_once(spark, name):
    assert "l_shipdate" not in plan(tile.QUERIES[name][0](spark, SF))  # the stack is written by then


def test_thinning_by_cover_in_one_plan(spark):
    dn = normalize.stack(load(spark, SF, "obs"))
    cover = dn.select("scene_ts").distinct().withColumn("cover", (F.month("scene_ts") * 37 + F.year("scene_ts") * 11) % 100 * F.lit(1.0))
    got = {(r.tile, r.threshold): r for r in sweeps.thinned(dn, cover, (40, 101), tile.P).collect()}
    full = normalize.offsets(normalize.anomalies(dn, normalize.climatology(dn)), tile.P)
    for t in ("N05E000", "N10E000"):
        r = got[t, 101]  # the whole set against itself
        assert r.scenes == full.where(F.col("tile") == t).count() and r.max_abs_delta == 0 and r.decision_flips == 0
        part = dn.join(cover.where("cover < 40"), "scene_ts", "left_semi").where(F.col("tile") == t)
        alone = normalize.offsets(normalize.anomalies(part, normalize.climatology(part)), tile.P)
        j = alone.join(full.select("tile", "scene_ts", F.col("offset_c").alias("o"), F.col("keep").alias("k")), ["tile", "scene_ts"])
        want = j.agg(F.count("*"), F.max(F.abs(F.col("offset_c") - F.col("o"))), F.count_if(F.col("keep") != F.col("k"))).first()
        assert (got[t, 40].scenes, got[t, 40].max_abs_delta, got[t, 40].decision_flips) == tuple(want)


def test_differences_of_composites(spark):
    make = lambda *r: spark.createDataFrame([("t", 0, i, v, n) for i, (v, n) in enumerate(r)], "tile string, y int, x int, lst double, n int")
    r = sweeps.compare_composites(make((1.0, 5), (2.0, 5), (None, 0)), make((1.05, 4), (2.5, 5), (3.0, 2))).first()
    assert (r.pixels, round(r.mean_delta, 4), round(r.max_abs, 4), r.share_over, round(r.coverage_delta_mean, 4)) == (2, 0.275, 0.5, 0.5, 0.3333)

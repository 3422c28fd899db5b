"""Sinks, lookups and checks that raise, and invariants of normalisation."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from rasterspark.functions import grid, quality
from rasterspark.operators import audit, catalog, composite, masks, normalize, runs, sweeps
from rasterspark.operators import series
from rasterspark.operators import tile as whole
from rasterspark.params import DN_HIGH, DN_LOW, Params
from rasterspark.plans import tile
from rasterspark.sources.fixtures import BASE_DIR, load

SF = f"{BASE_DIR}/sf0.001"


def times(spark, *days):
    return spark.createDataFrame([("N00E000", dt.datetime(2021, 1, d)) for d in days], "tile string, scene_ts timestamp")


def offsets_of(spark, *days):
    return times(spark, *days).withColumn("offset4", F.lit(4).cast("long"))


def test_clamp_is_the_integer_range(spark):
    df = spark.range(1, 65536).select(F.col("id").alias("dn"), quality.celsius(F.col("id")).alias("c"))
    assert df.where((F.col("c").between(-50, 80)) != F.col("dn").between(DN_LOW, DN_HIGH)).count() == 0


@pytest.mark.parametrize("c,dn", [(-50.0, 0), (-49.99, 1), (0.0, 5000), (605.35, 65535), (606.0, 0), (None, 0)])
def test_packing(spark, c, dn):
    row = spark.createDataFrame([(c,)], "c double").select(quality.encode(F.col("c") + 1e-9).alias("dn")).first()
    assert row.dn == dn


def test_bias_is_recovered(spark):
    cube = sweeps.synthetic_cube(spark, 12, 12, 60, 1).withColumn("qa_pixel", F.lit(64))
    steady = cube.withColumn("lwir11", F.lit(44000) + F.when(F.dayofyear("scene_ts") % 3 == 0, 600).otherwise(0))
    dn = normalize.stack(steady)
    table = normalize.offsets(normalize.anomalies(dn, normalize.climatology(dn)), Params(floor=1))
    values = normalize.debias(dn, table)
    spread = values.groupBy("y", "x", F.month("scene_ts")).agg((F.max("v4") - F.min("v4")).alias("d"))
    assert spread.where("d <> 0").count() == 0


def test_partitions_change_nothing(spark):
    obs = load(spark, SF, "obs")
    a, b = (sorted(map(tuple, normalize.climatology(normalize.stack(o)).collect())) for o in (obs, obs.repartition(13)))
    assert a == b


def test_all_rejected_raises(spark):
    dn = normalize.stack(load(spark, SF, "obs"))
    table = normalize.offsets(normalize.anomalies(dn, normalize.climatology(dn)), Params(floor=10**9))
    with pytest.raises(ValueError, match="rejected"):
        normalize.debias(dn, table)
    with pytest.raises(ValueError, match="no offset"):
        normalize.debias(dn, table.limit(0))
    some = table.withColumn("keep", F.lit(True)).limit(3)
    with pytest.raises(Exception, match="a scene has no offset"):
        normalize.debias(dn, some).collect()


def test_offset_store(spark, tmp_path):
    table, path = offsets_of(spark, 1, 2), str(tmp_path / "o")
    normalize.store_offsets(table, path, "2021", "k1")
    normalize.store_offsets(offsets_of(spark, 5), path, "2021", "k2")
    normalize.store_offsets(table, path, "2021", "k1")
    assert normalize.lookup_offsets(times(spark, 1, 2), path, "2021", "k1").count() == 2
    assert normalize.lookup_offsets(times(spark, 1, 2, 3), path, "2021", "k1") is None


def test_partials(spark):
    want = times(spark, 1, 2, 3)
    assert normalize.merge_partials([offsets_of(spark, 1, 3), offsets_of(spark, 2)], want).count() == 3
    for bad, what in (((1, 2), "missing"), ((1, 2, 3, 3), "several"), ((1, 2, 3, 4), "not of this run")):
        with pytest.raises(ValueError, match=what):
            normalize.merge_partials([offsets_of(spark, *bad)], want)


def test_times_cut_to_seconds(spark):
    exact = spark.createDataFrame([("N00E000", dt.datetime(2021, 1, 1, 0, 0, 0, 500)), ("N00E000", dt.datetime(2021, 1, 2))], "tile string, scene_ts timestamp")
    assert normalize.match_times(offsets_of(spark, 1, 2), exact).join(exact, "scene_ts").count() == 2
    with pytest.raises(ValueError, match="share a second"):
        normalize.match_times(offsets_of(spark, 1), exact.union(exact.select("tile", exact.scene_ts + F.expr("interval 1 microsecond"))))


def test_cover_must_align(spark):
    cover = times(spark, 1, 2).withColumn("cover", F.lit(1.0))
    assert sweeps.align_cover(cover, times(spark, 1, 2)).count() == 2
    with pytest.raises(ValueError, match="no cover"):
        sweeps.align_cover(cover, times(spark, 1, 2, 3))


def test_composite_sink(spark, tmp_path):
    comp, path = tile._comp(spark, SF), str(tmp_path / "c")
    composite.write_composite(comp, path, "2021")
    composite.write_composite(comp.where("tile = 'N05E000'"), path, "2021")
    back = spark.read.parquet(path).where("window = '2021'")
    assert back.count() == comp.count() and "lst_dn" in back.columns


def test_bands(spark):
    rows = spark.range(6).select(F.col("id").alias("y"), F.lit(1).alias("v"))
    low, high = rows.where("y < 3"), rows.where("y >= 3")
    assert composite.merge_bands([low, high], 6).count() == 6
    for bands, height, what in (([low, high.where("y > 3")], 6, "gap"), ([low, rows], 6, "gap"), ([low, high], 7, "height"), ([low, high.drop("v")], 6, "differ")):
        with pytest.raises(ValueError, match=what):
            composite.merge_bands(bands, height)


def test_catalog(spark, tmp_path):
    names = ["lst_p95_2021_N05W060.tif", "qa_count_2021_N05W060.tif", "lst_p95_2021_S10E100.tif"]
    files = spark.createDataFrame([(n,) for n in names], "name string")
    with pytest.raises(ValueError, match="lacks"):
        catalog.pair_products(files)
    pairs = catalog.pair_products(files.limit(2))
    head = spark.createDataFrame([("N05W060", -60.0, 0.0, -55.0, 5.0)], "tile string, west double, south double, east double, north double")
    items = catalog.build_items(pairs, head)
    catalog.write_items(items, str(tmp_path / "items"))
    assert spark.read.parquet(str(tmp_path / "items")).first().id == "N05W060_2021"
    with pytest.raises(ValueError, match="off its tile"):
        catalog.build_items(pairs, head.withColumn("east", F.lit(-55.1)))
    assert catalog.extent(items.limit(0)).first().west == -180


def test_hilbert_is_a_curve(spark):
    df = spark.range(256).select((F.col("id") % 16).alias("i"), F.floor(F.col("id") / 16).alias("j"))
    at = df.select("i", "j", grid.hilbert((F.col("i") + 0.5) / 16 * 360 - 180, (F.col("j") + 0.5) / 16 * 180 - 90, 4).alias("d")).collect()
    order = {r.d: (r.i, r.j) for r in at}
    assert sorted(order) == list(range(256))
    assert all(abs(order[k][0] - order[k + 1][0]) + abs(order[k][1] - order[k + 1][1]) == 1 for k in range(255))


def test_run_states(spark, tmp_path):
    for name in ("N05W060.2.json", "N05W060.json", "N10W060.progress.json", "N05W060.2.offsets.profile.json", "N05W060.2.log"):
        (tmp_path / name).write_text(json.dumps({"phase": "read", "updated_at": "2024-01-01T00:00:00Z", "phase_seconds": {"read": 2.0}, "rss_series": [[0.0, 1.0]]}))
    got = {(r.tile, r.attempt, r.kind, r.phase_seconds["read"]) for r in runs.read_states(spark, str(tmp_path)).collect()}
    assert got == {("N05W060", 2, "state", 2.0), ("N05W060", 0, "state", 2.0), ("N10W060", 0, "progress", 2.0)}


def test_tables_as_files(spark, tmp_path):
    df = spark.range(3)
    for kind, read in (("csv", lambda p: spark.read.option("header", True).csv(p)), ("json", spark.read.json)):
        sweeps.write_table(df, str(tmp_path / kind), kind)
        assert read(str(tmp_path / kind)).count() == 3


def test_dilation_wraps(spark):
    cells = spark.createDataFrame([(5, 0)], "row long, col long")
    got = {(r.row, r.col) for r in masks.dilate(cells, 1, 10).collect()}
    assert got == {(r, c) for r in (4, 5, 6) for c in (9, 0, 1)}


def test_buffer(spark):
    e = spark.createDataFrame([(1, 1, 2.0, 2.0, 6.0, 2.0)], "poly_id int, class int, x0 double, y0 double, x1 double, y1 double")
    got = {(r.y, r.x) for r in masks.near_edges(e, 10, 10, 1.0).collect()}
    near = lambda y, x: (x + 0.5 - min(max(x + 0.5, 2), 6)) ** 2 + (y + 0.5 - 2) ** 2 <= 1
    assert got == {(y, x) for y in range(10) for x in range(10) if near(y, x)}


def test_inventory_and_hash(spark):
    inv = spark.createDataFrame([("p", "1", "a"), ("p", "1", "b")], "product string, version string, granule string")
    assert audit.check_inventory(inv, "p", "1", 2).first().n == 2
    for args, df in ((("p", "2", 2), inv), (("p", "1", 3), inv), (("p", "1", 4), inv.union(inv))):
        with pytest.raises(ValueError):
            audit.check_inventory(df, *args)
    gaps = spark.range(300).select((F.col("id") * 7).alias("row"), (F.col("id") * 31).alias("col"))
    held = inv.select("granule", F.col("product").alias("sha256"))
    one = lambda g, h, p="p", i=None: audit.content_hash(g, h, inv.select("granule").limit(1), p, i).first().hash
    same = one(gaps, held)
    assert one(gaps.repartition(5).orderBy(F.desc("row")), held.orderBy(F.desc("granule"))) == same
    others = [one(gaps.where("row > 0"), held), one(gaps, held.limit(1)), one(gaps, held, "q"), one(gaps, held, "p", {"version": "2"}), one(gaps.withColumn("col", F.col("col") + 1), held)]
    assert len({same, *others}) == 6


def test_orientation_and_cells(spark):
    c = spark.createDataFrame([(0, 0, True, False), (0, 0, False, True)], "r int, c int, lat_ascends boolean, lon_descends boolean")
    assert {(x.r, x.c) for x in audit.orient(c).collect()} == {(99, 0), (0, 99)}
    m = spark.createDataFrame([(0, 0, True), (1, 1, False)], "r int, c int, v boolean")
    assert [tuple(x) for x in audit.mask_cells(m).collect()] == [(89, -180)]
    p = spark.createDataFrame([([(1.5, 2.5), (1.2, 3.0), (2.0, 2.1), (1.5, 2.5)],), ([(1.0, 2.0)],)], "p array<struct<lat:double,lon:double>>")
    none = spark.createDataFrame([([],), (None,)], p.schema)
    assert [tuple(x) for x in p.union(none).select(*audit.granule_cell(F.col("p"))).collect()] == [(1, 2), (1, 2), (None, None), (None, None)]


def test_clamp_reaches_the_scan(spark, tmp_path):
    sweeps.synthetic_cube(spark, 4, 4, 4).write.parquet(str(tmp_path / "o"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    df = normalize.stack(spark.read.parquet(str(tmp_path / "o")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert f"LessThanOrEqual(lwir11,{DN_HIGH})" in plan and "HashAggregate" in plan and "Sort" not in plan


def test_task_classes(spark):
    keys = {"read": "open open-x KEIXEL lwir11 qa_pixel cfg-1 grid", "compute": "where-1 astype sub getitem-stack-a getitem_sum-b custom_nanquantile stack", "rechunk": "rechunk-merge shuffle-p2p transpose getitem", "store": "store-map", "other": "subtract finalize openx"}
    rows = [(k, name) for name, line in keys.items() for k in line.split()]
    df = spark.createDataFrame(rows, "k string, want string")
    assert df.where(runs.prefix_class(F.col("k")) != F.col("want")).count() == 0


@pytest.mark.parametrize("lat,n", [(0, 3899), (-2.5, 3899), (20.0, 3328), (37.5, 2758), (-47.5, 3280), (57.5, 3802), (80, 3802)])
def test_scenes_by_latitude(spark, lat, n):
    assert spark.range(1).select(runs.scenes_for(F.lit(float(lat)))).first()[0] == n


def test_byte_model(spark):
    t = spark.createDataFrame([("a", 1000, 0.5)], "name string, scenes int, land double")
    r = runs.tile_bytes(t).first()
    assert (r.coarse_gb, r.native_gb) == (324.0, 1296.0)
    assert abs(r.offset_hours - 324e9 * 1.5 / 140e6 / 3600) < 1e-9 and abs(r.composite_hours - 1296e9 / 45.5e6 / 3600) < 1e-9
    assert abs(r.cost - r.vm_hours * 0.504) < 1e-9 and not r.within_hour


def test_categories(spark):
    rows = [("failed", True, 1.0, "failed"), ("skipped", False, 1.0, "done"), ("read", True, None, "done"), ("read", False, None, "stale"), ("read", False, 121.0, "stale"), ("read", False, 120.0, "running")]
    df = spark.createDataFrame(rows, "phase string, settled boolean, age double, want string")
    assert df.where(runs.category(F.col("phase"), F.col("settled"), F.col("age")) != F.col("want")).count() == 0


def test_cube_is_the_same_whatever_the_partitions(spark):
    a = sweeps.synthetic_cube(spark, 6, 5, 4, 7)
    rows = sorted(map(tuple, a.collect()))
    assert rows == sorted(map(tuple, a.repartition(7).collect())) and len(rows) == 120
    assert all(36322 <= r.lwir11 <= 50952 for r in a.collect()) and 0 < a.where("qa_pixel = 8").count() < 60


def test_full_tile_on_a_coarser_estimate(spark):
    obs, jobs = load(spark, SF, "obs"), tile.jobs(spark, SF)
    gaps = load(spark, SF, "cells").where("numobs = 0")
    got = whole.process(obs, jobs, load(spark, SF, "land"), gaps, tile.P, factor=2, cell=5, hot=tile.HOT).collect()
    land = load(spark, SF, "land").count()
    assert len(got) == 2 * land and any(r.lst is not None for r in got) and all((r.lst_dn == 0) == (r.lst is None) for r in got)


def test_series_and_rows_agree(spark):
    obs = load(spark, SF, "obs")
    dn = normalize.stack(obs)
    table = whole.tile_offsets(dn, tile.P)
    rows = series.series(obs)
    assert sorted(map(tuple, series.offsets(rows, tile.P).collect())) == sorted(map(tuple, table.collect()))
    a, b = (sorted((r.tile, r.y, r.x, round(r.lst, 6), r.n, *[r[f"m{k}"] for k in range(1, 13)]) for r in df.collect()) for df in (composite.composite(normalize.debias(dn, table)), series.composite(rows, table)))
    assert a == b and len(a) > 100
    with pytest.raises(ValueError, match="rejected"):
        series.composite(rows, table.withColumn("keep", F.lit(False)))
    with pytest.raises(Exception, match="no offset"):
        series.composite(rows, table.where("keep").limit(3)).collect()
    assert series.series(obs.limit(0)).count() == 0


def test_full_tile_beyond_the_scene_limit(spark):
    parts = load(spark, SF, "obs"), tile.jobs(spark, SF), load(spark, SF, "land"), load(spark, SF, "cells").where("numobs = 0")
    one, other = (sorted((tuple(round(v, 6) if isinstance(v, float) else v is None or v for v in r)) for r in whole.process(*parts, tile.P, cell=5, hot=tile.HOT, max_scenes=k).collect()) for k in (10**6, 0))
    assert one == other

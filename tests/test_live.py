"""Silence in wall-clock time, on a stream that stops."""

import datetime as dt
import shutil
import time

from rasterspark.streaming import live

SCHEMA = "tile long, attempt long, updated_at timestamp, event_id long, seq long, done long, total long, phase string"


def put(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}-new", mode="overwrite")
    folder.mkdir(exist_ok=True)
    for f in (folder.parent / f"{folder.name}-new").glob("*.parquet"):
        shutil.move(str(f), str(folder / f"{time.time_ns()}.parquet"))


def test_a_silent_fleet_turns_stale(spark, tmp_path):
    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    inbox, seen = tmp_path / "in", []
    put(spark, inbox, [(1, 1, at(0), 1, 0, 10, 100, "read"), (1, 1, at(10), 2, 0, 30, 100, "read"), (2, 1, at(5), 3, 0, 5, 100, "done"), (3, 1, at(5), 4, 0, 5, 100, "read")])
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    live.use_timers(spark)
    q = live.watch(spark.readStream.schema(SCHEMA).parquet(str(inbox)), stale_s=6.0).writeStream.outputMode("update").option("checkpointLocation", f"file://{tmp_path}/state").trigger(processingTime="1 second").foreachBatch(lambda df, _: seen.extend(map(tuple, df.collect()))).start()

    def wait(done, limit=90):
        end = time.time() + limit
        while not done():
            assert q.exception() is None, q.exception()
            assert time.time() < end, seen
            time.sleep(0.3)

    try:
        wait(lambda: {r[0] for r in seen} == {1, 2, 3})
        assert {(r[0], r[7]) for r in seen} == {(1, "running"), (2, "done"), (3, "running")}
        assert [(r[4], r[5], r[6]) for r in seen if r[0] == 1] == [(2, 2.0, 35.0)]
        put(spark, inbox, [(1, 1, at(20), 5, 0, 40, 100, "read")])  # one tile goes on, then nothing comes any more
        wait(lambda: {(r[0], r[7]) for r in seen} >= {(1, "stale"), (3, "stale")})
        last = {r[0]: r for r in seen}
        assert last[1][4:6] == (3, 1.5) and last[1][7] == "stale" and last[3][7] == "stale" and last[2][7] == "done"
        put(spark, inbox, [(3, 1, at(90), 6, 0, 9, 100, "read")])
        wait(lambda: [r for r in seen if r[0] == 3][-1][4] == 2)
        assert [r for r in seen if r[0] == 3][-1][7] == "running"
    finally:
        q.stop()
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)

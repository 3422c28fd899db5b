"""Heartbeats in wall-clock time: a tile that falls silent turns stale though no other beat comes (H2)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.runs import RATE_WINDOW, STALE_S
from .beats import LATEST, status

_EPOCH = dt.datetime(1970, 1, 1)
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_timers(spark: SparkSession) -> None:
    """The state store that timers need; to be set before a query starts."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)


class Watch(StatefulProcessor):
    """The newest beats of a tile's attempt and a timer that a new beat puts off.

    State is a bounded list of beats and a summary, both of which expire ``keep_s`` after they were last written, so tiles that never
    come back leave nothing. A tile that beats again after it was stale is running again, its beats counted on.
    """

    def __init__(self, stale_s: float, keep_s: float):
        self.stale_ms, self.keep_ms = int(stale_s * 1000), int(keep_s * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.recent = handle.getListState("recent", "at long, event_id long, seq long, done long", self.keep_ms)
        self.summary = handle.getValueState("summary", "total long, phase string, beats long, due long", self.keep_ms)

    def _shown(self, key: Any, silent: bool) -> Row:
        recent, (total, phase, beats, _) = list(self.recent.get()), self.summary.get()
        row = status(tuple(key), *([b[i] for b in recent] for i in (0, 2, 3)), total, phase, beats, silent)
        return Row(**dict(zip(("tile", "attempt", "updated_at", "phase", "beats", "rate", "eta_s", "category"), (*row[:2], _EPOCH + dt.timedelta(microseconds=row[2]), *row[3:]))))

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        old = self.summary.get() if self.summary.exists() else (0, "", 0, 0)
        kept = [tuple(b) for b in self.recent.get()] if self.recent.exists() else []
        last, n = (kept[-1][:2], old[0], old[1]) if kept else ((-1, -1), 0, ""), 0
        for r in rows:  # one at a time: what is held is the newest few
            beat = (r["at"], r["event_id"], r["seq"], r["done"])
            kept = sorted([*kept, beat])[-RATE_WINDOW:]
            last, n = max(last, (beat[:2], r["total"], r["phase"])), n + 1
        due = timerValues.getCurrentProcessingTimeInMs() + self.stale_ms
        self.recent.put(kept)
        self.summary.update((last[1], last[2], old[2] + n, due))
        self.handle.registerTimer(due)
        yield self._shown(key, False)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        # beats that came since have put the time off; theirs is the timer that counts
        if self.summary.exists() and self.recent.exists() and self.summary.get()[3] <= expiredTimerInfo.getExpiryTimeInMs():
            yield self._shown(key, True)

    def close(self) -> None:
        pass


def watch(beats: DataFrame, stale_s: float = STALE_S, keep_s: float = 7 * 86400) -> DataFrame:
    """H1-H3 of ``beats(tile, attempt, updated_at, event_id, seq, done, total, phase)``, for update mode: a row per tile and attempt with new beats, and one more when none has come for ``stale_s`` seconds of wall-clock time.

    The second one is stale unless the phase is terminal. It comes though the whole fleet is silent: timers fire in batches without
    data, so the query needs a trigger that goes on. Call ``use_timers`` first.
    """
    rows = beats.selectExpr("tile", "attempt", "unix_micros(updated_at) as at", "event_id", "seq", "cast(done as long) as done", "cast(total as long) as total", "phase")
    return rows.groupBy("tile", "attempt").transformWithState(statefulProcessor=Watch(stale_s, keep_s), outputStructType=LATEST, outputMode="Update", timeMode="ProcessingTime")

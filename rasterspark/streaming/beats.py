"""Heartbeats as a stream (H1-H4)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.runs import RATE_WINDOW, STALE_S, TERMINAL

LATEST = "tile long, attempt long, updated_at timestamp, phase string, beats long, rate double, eta_s double, category string"
#: Of each of a group's tiles: its newest beats, oldest first, a summary, and when it is due to be stale (milliseconds).
_STATE = "tile array<long>, attempt array<long>, at array<array<long>>, seq array<array<long>>, done array<array<long>>, total array<long>, phase array<string>, beats array<long>, due array<long>"
#: Groups that tiles are dealt to by hash.
GROUPS = 1024


def _rate(done: list, at: list, k: int) -> float | None:
    """Tasks a second over the last k steps."""
    seconds = (at[-1] - at[-1 - k]) / 1e6 if k else 0
    return max(done[-1] - done[-1 - k], 0) / seconds if seconds > 0 else None


def status(key: tuple, at: list, seq: list, done: list, total: int, phase: str, beats: int, silent: bool) -> tuple:
    """A row of LATEST from a tile's newest beats, oldest first, times in microseconds: the rate is over those of the newest one's graph whose count never fell."""
    k = 0
    while k + 1 < len(at) and seq[-2 - k] == seq[-1] and done[-2 - k] <= done[-1 - k]:
        k += 1
    rate = _rate(done, at, k)
    left = max(total - done[-1], 0) / rate if rate else None
    return (*key, at[-1], phase, beats, rate, left, TERMINAL.get(phase, "stale" if silent else "running"))


def _rows(rows: list) -> pd.DataFrame:
    """Rows of LATEST as a frame."""
    tile, attempt, at, phase, beats, rate, left, category = zip(*rows)
    whole, real = (lambda c: pd.array(c, "Int64")), (lambda c: np.array(c, np.float64))
    return pd.DataFrame({"tile": whole(tile), "attempt": whole(attempt), "updated_at": np.array(at, "datetime64[us]"), "phase": list(phase), "beats": whole(beats), "rate": real(rate), "eta_s": real(left), "category": list(category)})


def _take(tiles: dict, f: pd.DataFrame) -> set:
    """Put a frame's beats to their tiles, whose newest few stay; the tiles that beat."""
    f = f.assign(at=f["updated_at"].astype("datetime64[us]").astype("int64")).sort_values(["at", "event_id"], kind="stable")
    new: dict = {}
    none = lambda c: [None if v != v else int(v) for v in c.tolist()]
    for tile, attempt, *beat in zip(none(f["tile"]), none(f["attempt"]), *(f[k].tolist() for k in ("at", "event_id", "seq", "done", "total", "phase"))):
        new.setdefault((tile, attempt), []).append(beat)
    for key, more in new.items():
        kept, beats, _ = tiles.get(key, ([], 0, 0))
        tiles[key] = (sorted([*kept, *more], key=lambda b: (b[0], b[1]))[-RATE_WINDOW:], beats + len(more), 0)
    return set(new)


def _advance(stale_ms: int):
    def run(_, frames, state: GroupState):
        now, tiles, beaten = state.getCurrentWatermarkMs(), {}, set()
        if state.exists:
            for tile, attempt, at, seq, done, total, phase, beats, due in zip(*state.get):
                tiles[tile, attempt] = ([(*b, total, phase) for b in zip(at, [-1] * len(at), seq, done)], beats, due)
        for f in () if state.hasTimedOut else frames:
            beaten |= _take(tiles, f)
        rows = []
        for key, (kept, beats, due) in list(tiles.items()):
            if key in beaten:
                tiles[key] = (kept, beats, max(kept[-1][0] // 1000 + stale_ms, now + 1))
            elif due < now:
                del tiles[key]
            else:
                continue
            at, _, seq, done, _, _ = zip(*kept)
            rows.append(status(key, at, seq, done, kept[-1][4], kept[-1][5], beats, key not in beaten))
        if tiles:
            parts = [(*key, *([b[i] for b in kept] for i in (0, 2, 3)), int(kept[-1][4]), kept[-1][5], beats, due) for key, (kept, beats, due) in tiles.items()]
            state.update(tuple(map(list, zip(*parts))))
            state.setTimeoutTimestamp(max(min(due for _, _, due in tiles.values()), now + 1))
        else:
            state.remove()
        if rows:
            yield _rows(rows)

    return run


def latest(beats: DataFrame, stale_s: float = STALE_S, delay: str = "10 minutes", groups: int = GROUPS) -> DataFrame:
    """H1-H3: a row per tile and attempt whenever it has new beats: the newest one, tasks a second over the last five of its graph, seconds left, beats so far.

    Once the watermark is ``stale_s`` past a tile's newest beat, it gives a last row, stale unless its phase is terminal, and
    what is known of it goes, so state is bounded by what is live. Time is that of the beats, so runs on stored beats end and agree.
    Tiles share ``groups`` groups by hash, since a call per group costs far more than a tile in it; a group wakes at the first
    time that one of its tiles is due.
    """
    marked = beats.withWatermark("updated_at", delay).withColumn("_group", F.pmod(F.xxhash64("tile", "attempt"), F.lit(groups)))
    return marked.groupBy("_group").applyInPandasWithState(_advance(int(stale_s * 1000)), LATEST, _STATE, "update", GroupStateTimeout.EventTimeTimeout)


def counts_by_category(beats: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """H3: beats by category of their phase, for update mode. Beats that come again (by event_id) within the watermark count once."""
    category = F.lit("running")
    for phase, shown in TERMINAL.items():
        category = F.when(F.col("phase") == phase, shown).otherwise(category)
    return beats.withWatermark("updated_at", delay).dropDuplicatesWithinWatermark(["event_id"]).groupBy(category.alias("category")).agg(F.count("*").alias("n"))


def phase_time(beats: DataFrame, window: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """H4: the beats' summed value by tumbling window and phase, for append mode: windows that the watermark has passed."""
    return beats.withWatermark("updated_at", delay).groupBy(F.window("updated_at", window).alias("w"), "phase").agg(F.sum("rss").alias("total"), F.count("*").alias("n")).select(F.col("w.start").alias("start"), "phase", "total", "n")

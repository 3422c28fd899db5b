"""Pixel series: all valid observations of a pixel in one row, and D1-D10 on them in Arrow batches.

Medians and percentiles of many small groups are what Spark's aggregates are slowest at: on 26 million observations of 811,801
pixels the rows' way (normalize, composite) took 58 s and this one 34 s on eight cores: percentile buffers fall back to
sorting. A series is bounded by the number of scenes, so a row is small; numpy works on a batch of pixels at once.
Both ways give the same tables, and the tests hold them against each other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.quality import clear, floor_guard, plausible
from ..params import Params
from ..sources.storage import written
from .composite import MONTHS, from_quarters
from .normalize import PIXEL, SCENE, offsets_of_histogram

#: Scenes (of all tiles) whose offsets are sent to all tasks, 20 bytes each; above that the rows' way is taken.
MAX_SCENES = 1_000_000
_NO_SCENE = (np.zeros(1, np.int64) - 1, np.zeros(1, np.int64), np.zeros(1, bool))
_COMPOSITE = "tile string, y long, x long, v double, n long, " + ", ".join(f"m{m} long" for m in MONTHS)


def series(obs: DataFrame, ground: DataFrame | None = None) -> DataFrame:
    """(tile, y, x, ts, r), written: times and counts of a pixel's valid observations, over ``ground(tile, y, x)`` if given.

    ``ts`` in microseconds; ``r`` has the item's rank above the count's 16 bits, so the first of a scene is its least.
    """
    valid = obs.where(plausible(F.col("lwir11")) & clear(F.col("qa_pixel")))
    r = F.shiftleft(F.col("rank").cast("long"), 16).bitwiseOR(F.col("lwir11").cast("long"))
    rows = valid.select("tile", F.col("y").cast("long").alias("y"), F.col("x").cast("long").alias("x"), F.unix_micros("scene_ts").alias("t"), r.alias("r"))
    if ground is not None:
        rows = rows.join(ground, PIXEL, "left_semi")
    return written(rows.groupBy(*PIXEL).agg(F.collect_list("t").alias("ts"), F.collect_list("r").alias("r")), "series")


def _flat(ts, r) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pixel, time, count) of a batch, sorted by pixel and time: of several observations of a scene the first one."""
    offsets = np.asarray(ts.offsets)
    pix = np.repeat(np.arange(len(ts)), np.diff(offsets))
    t, r = np.asarray(ts.flatten()), np.asarray(r.flatten())
    order = np.lexsort((r, t, pix))
    pix, t, r = pix[order], t[order], r[order]
    first = np.ones(len(t), bool)
    first[1:] = (pix[1:] != pix[:-1]) | (t[1:] != t[:-1])
    return pix[first], t[first], r[first] & 0xFFFF


def _month(t: np.ndarray) -> np.ndarray:
    return t.astype("datetime64[us]").astype("datetime64[M]").astype(np.int64) % 12


def _middle(key: np.ndarray, value: np.ndarray) -> np.ndarray:
    """For each element twice the median of its key's values."""
    order = np.lexsort((value, key))
    start = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]])) if len(key) else np.zeros(0, np.int64)
    n = np.diff(np.concatenate([start, [len(key)]]))
    v = value[order]
    twice = v[start + (n - 1) // 2] + v[start + n // 2]
    out = np.empty(len(key), np.int64)
    out[order] = np.repeat(twice, n)
    return out


def _histograms(batches):
    """C1 and D1 in a batch, counted: (tile, scene_ts, anom2, n)."""
    for b in batches:
        pix, t, dn = _flat(b.column(3), b.column(4))
        if not len(t):
            continue
        anom = 2 * dn - _middle(pix * 12 + _month(t), dn)
        names = b.column(0).dictionary_encode()
        tile = np.asarray(names.indices)[pix]
        times, scene = np.unique(t, return_inverse=True)
        low = int(anom.min())
        width = int(anom.max()) - low + 1
        cell, n = np.unique((tile.astype(np.int64) * len(times) + scene) * width + (anom - low), return_counts=True)
        group, anom = cell // width, cell % width + low
        yield pa.RecordBatch.from_arrays([names.dictionary.take(pa.array(group // len(times))), pa.array(times[group % len(times)]).cast(pa.timestamp("us", "UTC")), pa.array(anom), pa.array(n)], ["tile", "scene_ts", "anom2", "n"])


def offsets(rows: DataFrame, params: Params = Params()) -> DataFrame:
    """D1-D4 of ``series``: the offset table, written."""
    hist = rows.mapInArrow(_histograms, "tile string, scene_ts timestamp, anom2 long, n long").groupBy(*SCENE, "anom2").agg(F.sum("n").alias("n"))
    return written(offsets_of_histogram(hist, params), "offsets")


def _composites(table: dict, q: float, strict: bool):
    def run(batches):
        for b in batches:
            pix, t, dn = _flat(b.column(3), b.column(4))
            keep, v = np.zeros(len(t), bool), np.zeros(len(t), np.int64)
            names = b.column(0).dictionary_encode()
            tile = np.asarray(names.indices)[pix]
            for i, name in enumerate(names.dictionary.to_pylist()):
                mine = np.flatnonzero(tile == i)
                times, shift, kept = table.get(name, _NO_SCENE)
                at = np.minimum(np.searchsorted(times, t[mine]), len(times) - 1)
                known = times[at] == t[mine]
                if strict and not known.all():
                    raise ValueError(f"a scene has no offset: of {name}")
                keep[mine], v[mine] = kept[at] & known, 4 * dn[mine] - shift[at]
            pix, t, v = pix[keep], t[keep], v[keep]
            order = np.lexsort((v, pix))
            v, n = v[order], np.bincount(pix, minlength=b.num_rows)
            have = np.flatnonzero(n)
            start = (np.cumsum(n) - n)[have]
            at = q * (n[have] - 1)
            low = np.floor(at).astype(np.int64)
            a, c = v[start + low], v[start + np.ceil(at).astype(np.int64)]
            counts = np.bincount(pix * 12 + _month(t), minlength=12 * b.num_rows).reshape(-1, 12)[have]
            where = pa.array(have)
            yield pa.RecordBatch.from_arrays([*(b.column(i).take(where) for i in range(3)), pa.array(a + (c - a) * (at - low)), pa.array(n[have]), *map(pa.array, counts.T.copy())], ["tile", "y", "x", "v", "n", *[f"m{m}" for m in MONTHS]])

    return run


def composite(rows: DataFrame, table: DataFrame, q: float = 0.95, strict: bool = True) -> DataFrame:
    """C2, D6, B10, D7-D10 of ``series``: (tile, y, x, lst, n, m1 ... m12).

    A scene without an offset fails the job if ``strict``, else it is dropped; a table that keeps nothing is an error. The
    table, at most MAX_SCENES rows, goes to all tasks.
    """
    got = table.select("tile", F.unix_micros("scene_ts").alias("t"), "offset4", "keep").toArrow()
    if not got.num_rows:
        raise ValueError("a scene has no offset: the table is empty")
    name, t, shift, keep = (np.asarray(got.column(i).combine_chunks().to_numpy(zero_copy_only=False)) for i in range(4))
    if not keep.any():
        raise ValueError("every scene is rejected")
    known = {}
    for tile in np.unique(name):
        mine = np.flatnonzero(name == tile)
        mine = mine[np.argsort(t[mine])]
        known[str(tile)] = (t[mine], shift[mine], keep[mine].astype(bool))
    out = rows.mapInArrow(_composites(known, q, strict), _COMPOSITE)
    return out.select(*PIXEL, floor_guard(from_quarters(F.col("v")), F.col("n")).alias("lst"), "n", *[f"m{m}" for m in MONTHS])

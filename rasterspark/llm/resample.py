"""Importance resampling towards a target distribution, by hashed features (Xie, Santurkar, Ma and Liang 2023).

Runs of consecutive words fall into buckets by the CRC-32 of their bytes. A bucket's gain is the log-ratio of its
smoothed shares among the target's and the documents' features; a document weighs the sum of its features' gains, and
the highest weights with Gumbel noise from the id's hash are drawn, which samples without replacement in proportion to
the weights.

The CRC of many spans at once: it is linear over XOR once its constants are taken out, so a byte's contribution depends
only on its value and its distance from the span's end. Contributions are looked up in a table of positions, spans are
folded by one ``bitwise_xor.reduceat``, and a constant per length puts the rest back. Spans longer than the table go in
blocks from their end: a block's fold is moved on by the block's width and joined with the next.
"""

from __future__ import annotations

import functools
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, small_batches

MAX_WORDS, BUCKETS, LEAST_WORDS, PERCENT, SEED = 1, 10_000, 20, 10, 2024
#: Distances from a span's end that the table holds, and bytes of spans that are folded at once.
REACH, _CHUNK = 64, 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes of words: digits, small letters and whatever isn't ASCII.
_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[97:123] = _IN_WORD[128:] = True


@functools.cache
def _byte_table() -> np.ndarray:
    """What a byte leaves in an empty register: the reflected polynomial 0xEDB88320, bit by bit."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = (t >> np.uint32(1)) ^ np.where(t & np.uint32(1), np.uint32(0xEDB88320), np.uint32(0))
    return t


def _zero_byte(x: np.ndarray) -> np.ndarray:
    """Registers after one more zero byte."""
    return _byte_table()[x & np.uint32(255)] ^ (x >> np.uint32(8))


@functools.cache
def position_table(reach: int = REACH) -> np.ndarray:
    """(reach, 256): the contribution of a byte that ``distance`` bytes follow in its span."""
    rows = [_byte_table()]
    for _ in range(reach - 1):
        rows.append(_zero_byte(rows[-1]))
    return np.stack(rows)


@functools.cache
def length_constants(reach: int = REACH) -> np.ndarray:
    """(reach + 1): CRC-32 of as many zero bytes: what the initial value and the last inversion add, whatever the bytes are."""
    return np.array([zlib.crc32(bytes(n)) for n in range(reach + 1)], np.uint32)


@functools.cache
def _moved(reach: int = REACH) -> np.ndarray:
    """(4, 256): a register moved on by ``reach`` zero bytes, by each of its bytes."""
    x = (np.arange(256, dtype=np.uint32)[None, :] << (np.arange(4, dtype=np.uint32) * 8)[:, None]).astype(np.uint32)
    for _ in range(reach):
        x = _zero_byte(x)
    return x


def _move(x: np.ndarray, reach: int) -> np.ndarray:
    t = _moved(reach)
    return t[0][x & 255] ^ t[1][x >> 8 & 255] ^ t[2][x >> 16 & 255] ^ t[3][x >> 24]


def _fold(data: np.ndarray, start: np.ndarray, end: np.ndarray, reach: int) -> np.ndarray:
    """XOR of the contributions of data[start:end], none longer than ``reach``, none empty."""
    length = end - start
    first = np.cumsum(length) - length
    back = np.repeat(first + length - 1, length) - np.arange(int(length.sum()))  # distance from the span's end
    at = np.repeat(end - 1, length) - back
    return np.bitwise_xor.reduceat(position_table(reach).ravel()[back * 256 + data[at]], first)


def crc32(data: np.ndarray, start: np.ndarray, end: np.ndarray, reach: int = REACH) -> np.ndarray:
    """Unsigned CRC-32 of each span data[start:end] of bytes; spans may overlap, be empty or of any length."""
    start, end = np.asarray(start, np.int64), np.asarray(end, np.int64)
    length, out = end - start, np.zeros(len(start), np.uint32)
    some = np.flatnonzero((length > 0) & (length <= reach))
    for part in _chunks(some, length):
        out[part] = _fold(data, start[part], end[part], reach) ^ length_constants(reach)[length[part]]
    long = np.flatnonzero(length > reach)
    if len(long):
        # the first block takes what is no multiple of the width, and the initial value
        head = (length[long] - 1) % reach + 1
        state = _fold(data, start[long], start[long] + head, reach) ^ length_constants(reach)[head] ^ np.uint32(0xFFFFFFFF)
        at = start[long] + head
        live = np.arange(len(long))
        while len(live):
            state[live] = _move(state[live], reach) ^ _fold(data, at[live], at[live] + reach, reach)
            at[live] += reach
            live = live[at[live] < end[long][live]]
        out[long] = state ^ np.uint32(0xFFFFFFFF)
    return out


def _chunks(which: np.ndarray, length: np.ndarray):
    """``which`` in stretches of about _CHUNK bytes of spans."""
    total = np.cumsum(length[which])
    cut = np.flatnonzero(np.diff(total // _CHUNK)) + 1
    return [p for p in np.split(which, cut) if len(p)]


def _flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column, lower-cased; nulls are empty."""
    texts = texts.fill_null("") if texts.null_count else texts
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]] if len(texts) else np.zeros(0, np.uint8)
    return _LOWER[data], offsets - offsets[0]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every word; words end with their text."""
    inside = _IN_WORD[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[False], inside])[:-1] if len(data) else inside
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.concatenate([inside[1:], [False]]) if len(data) else inside
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def features(texts: pa.Array, max_words: int = MAX_WORDS, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, row) of every feature of a batch of texts and the number of words of each text."""
    data, offsets = _flat(texts)
    start, end, row = words(data, offsets)
    if max_words > 1:  # words joined by one space, so that a run is a stretch of bytes
        length = end - start
        at = np.cumsum(length + 1) - (length + 1)
        joined = np.full(int(length.sum()) + len(length), 32, np.uint8)
        joined[np.repeat(at - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))] = data[np.repeat(start - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))]
        data, start, end = joined, at, at + length
    found, rows = [], []
    for k in range(1, max_words + 1):
        n = max(0, len(start) - k + 1)
        i = np.flatnonzero(row[:n] == row[k - 1 :]) if n else np.zeros(0, np.int64)
        found.append(crc32(data, start[i], end[i + k - 1]) % np.uint32(buckets))
        rows.append(row[i])
    return np.concatenate(found).astype(np.int64), np.concatenate(rows), np.bincount(row, minlength=len(texts))


def _counted(max_words: int, buckets: int):
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for b in batches:
            total += np.bincount(features(b.column(0), max_words, buckets)[0], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, text_col: str = "text", max_words: int = MAX_WORDS, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): features of all texts by bucket; each task counts for itself before the shuffle."""
    return small_batches(texts).select(F.col(text_col).alias("text")).mapInArrow(_counted(max_words, buckets), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def _counts(texts: DataFrame, *args) -> np.ndarray:
    """The same on the driver: ``buckets`` numbers, a parameter."""
    out = np.zeros(args[-1], np.int64)
    for r in bucket_counts(texts, *args).collect():
        out[r.bucket] = r.n
    return out


def gains(docs: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(((t + 1)(S + B)) / ((s + 1)(T + B)))) for each of B buckets."""
    big_s, big_t, b = float(docs.sum()), float(target.sum()), len(docs)
    return np.array([math.floor(1000 * math.log((t + 1) * (big_s + b) / ((s + 1) * (big_t + b)))) for s, t in zip(docs.tolist(), target.tolist())], np.int64)


def _weighed(gain: np.ndarray, max_words: int):
    def run(batches):
        for b in batches:
            bucket, row, n_words = features(b.column(1), max_words, len(gain))
            n = np.bincount(row, minlength=b.num_rows)
            # sums of whole numbers: exact as long as they stay below 2**53
            weight = np.bincount(row, weights=gain[bucket].astype(np.float64), minlength=b.num_rows).astype(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n_words), pa.array(n), pa.array(weight)], ["doc_id", "n_words", "n_features", "weight"])

    return run


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """floor(-1000 ln(-ln((h + 0.5) / 2**32))), h from sha256 of ``<seed>:<doc_id>``; a null id reads as nothing."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def ranked(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` with their place (from 1) in the whole order: sorted range partitions, and the rows of those before each.

    What reaches the driver is a number per partition. ``order`` should end in something that tells all rows apart, so
    that ranges can be cut anywhere.
    """
    # the partition is in the upper bits, the place within it in the lower 33
    at = materialise(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "ranked")
    sizes = sorted(at.groupBy(F.shiftright("_at", 33).alias("part")).count().collect())
    before, seen = [], 0
    for part, n in sizes:
        before.append((part, seen))
        seen += n
    offset = rows.sparkSession.createDataFrame(before, "_part long, _before long")
    numbered = at.withColumn("_part", F.shiftright("_at", 33)).join(F.broadcast(offset), "_part")  # a row per partition
    return numbered.withColumn("place", F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("_at", "_part", "_before")


def draw(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", max_words: int = MAX_WORDS, buckets: int = BUCKETS, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank): one row per row of ``docs``; rank is null where a document isn't drawn.

    Of the N documents of ``least_words`` words and more the floor(percent N / 100) highest scores are drawn, ties to the
    smaller id, null ids last. Null and empty texts have no words, weight 0 and are never drawn; very long texts are read
    whole; repeated rows are rows of their own, equal in score; with no target every count of it is 0; an empty table
    gives an empty result; extra columns are ignored.
    """
    size = max_words, buckets
    gain = gains(_counts(docs, text_col, *size), _counts(target, target_col, *size))
    chosen = small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = chosen.mapInArrow(_weighed(gain, max_words), "doc_id long, n_words long, n_features long, weight long")
    may = F.col("n_words") >= least_words
    rows = materialise(rows.withColumns({"score": F.col("weight") + noise(F.col("doc_id"), seed), "may": may, "nr": F.monotonically_increasing_id()}), "resample")
    n_drawn = rows.where("may").count() * percent // 100
    placed = ranked(rows, [F.desc("may"), F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("nr")])
    return placed.select("doc_id", "n_words", "n_features", "weight", "score", F.when(F.col("place") <= n_drawn, F.col("place")).alias("rank"))

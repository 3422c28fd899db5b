"""Document fingerprints by order min-hash (Marçais, DeBlasio, Pandey and Kingsford 2019).

A text is the sequence of its k-mers of code points, each numbered by how often it came before, so that repeats are
different elements. Each of ``SLOTS`` random orders selects the ``WIDTH`` least elements; they are put back into text
order and hashed as a tuple, so a slot of two texts agrees only where they share k-mers in the same order. The share of
agreeing slots grows with closeness in edit distance, not merely with shared content.

The query's edited texts need each document's successor. Documents are range-partitioned by descending id and sorted
within partitions, so a text travels once; the last row of a partition meets the first one of the next in a
join of one row per partition.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, mix64, small_batches, text_keys

K, SLOTS, WIDTH, SEED = 8, 64, 2, 2019
#: Positions whose orders are held at once, for each slot.
_BLOCK = 1 << 11
_STEP, _TUPLE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def elements(text: str | None, k: int = K) -> np.ndarray:
    """64-bit hashes of the occurrence-numbered k-mers of one whole text, in text order; a shorter text is one k-mer."""
    if not text:
        return np.zeros(0, np.uint64)
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    k = min(k, len(code))
    with np.errstate(over="ignore"):
        # runs of 1, 2, 4 ... code points, joined to one of k from the right
        run, size, h, have = mix64(code), 1, None, 0
        while True:
            if k & size:
                h = run if h is None else _join(run[: len(run) - have], h[size:])
                have += size
            if have == k:
                break
            run, size = _join(run[:-size], run[size:]), 2 * size
        # the place in the lowest bits: one sort brings equal k-mers together in text order
        h, bits = mix64(h + np.uint64(k)), np.uint64(max(1, (len(h) - 1).bit_length()))
        ordered = np.sort(h >> bits << bits | np.arange(len(h), dtype=np.uint64))
        again = np.flatnonzero(ordered[1:] >> bits == ordered[:-1] >> bits) + 1
        if len(again):
            start = again[np.concatenate([[True], np.diff(again) > 1])]  # the first repeat of each
            count = again - np.repeat(start, np.diff(np.concatenate([np.searchsorted(again, start), [len(again)]]))) + 1
            at = (ordered[again] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
            h[at] = mix64(h[at] + count.astype(np.uint64) * _TUPLE)
    return h


def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of a run and the run after it, from theirs."""
    h = (a ^ b >> np.uint64(31)) * _STEP + b
    return (h ^ h >> np.uint64(32)) * _TUPLE


@functools.cache
def _orders(slots: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    flip, mult = rng.integers(0, 1 << 32, (2, slots, 1), np.uint32)
    return flip, mult | np.uint32(1)


def signature(items: np.ndarray, slots: int = SLOTS, width: int = WIDTH, seed: int = SEED) -> np.ndarray:
    """``slots`` 16-bit hashes of ordered tuples; zeros without elements, never zero else."""
    if not len(items):
        return np.zeros(slots, np.uint16)
    flip, mult = _orders(slots, seed)
    short, lines = (items >> np.uint64(32)).astype(np.uint32), np.arange(slots)
    keys, places = [], []
    for i in range(0, len(short), _BLOCK):
        x = (short[None, i : i + _BLOCK] ^ flip) * mult  # a random order of 32-bit values per slot
        for _ in range(min(width, x.shape[1])):
            j = x.argmin(1)
            keys.append(x[lines, j].astype(np.int64))
            places.append(j + i)
            x[lines, j] = 0xFFFFFFFF
    keys, places = np.stack(keys, 1), np.stack(places, 1)
    if keys.shape[1] > width:  # blocks come in text order, so ties go to the earlier place
        least = np.argsort(keys, axis=1, kind="stable")[:, :width]
        places = np.take_along_axis(places, least, 1)
    chosen = items[np.sort(places, 1)]
    out = np.full(slots, np.uint64(chosen.shape[1]))
    with np.errstate(over="ignore"):
        for j in range(chosen.shape[1]):
            out = mix64(out * _TUPLE + chosen[:, j])
    return ((out >> np.uint64(40)) % np.uint64(65535) + np.uint64(1)).astype(np.uint16)


def fingerprint(text: str | None, k: int = K, slots: int = SLOTS, width: int = WIDTH) -> np.ndarray:
    return signature(elements(text, k), slots, width)


def _bytes(fp: np.ndarray) -> bytes:
    return fp.astype(">u2").tobytes()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of slots that agree, 0 to 1; 1 for two empty texts, 0 for an empty and another one."""
    return float(np.count_nonzero(a == b)) / len(a)


def edit(text: str, follower: str) -> str:
    """``text`` with its last floor(n / 2) code points replaced by the first as many of ``follower``, or all it has."""
    half = len(text) // 2
    return text[: len(text) - half] + follower[:half]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, slots: int = SLOTS, width: int = WIDTH) -> DataFrame:
    """(doc_id, fingerprint): the operator by itself, one row per row of ``docs``, in the docs' own partitions.

    ``fingerprint`` is a string of four hex digits a slot. Null and empty texts have zeros only; very long texts are read
    whole, in blocks of positions; equal texts have equal fingerprints, whatever their ids; repeated rows stay repeated;
    extra columns are ignored; an empty table gives an empty result.
    """

    def run(batches):
        for b in batches:
            fp = [_bytes(fingerprint(t, k, slots, width)).hex() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp, pa.string())], ["doc_id", "fingerprint"])

    chosen = small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return chosen.mapInArrow(run, "doc_id long, fingerprint string")


_RESULT = "doc_id long, n_chars long, edited_sha256 string, fp binary, edited_fp binary, near_edited double, near_next double"
_DONE, _FIRST, _LAST = 0, 1, 2


def _compare(text: str, fp: np.ndarray, follower: str, next_fp: np.ndarray, k: int, slots: int, width: int) -> tuple:
    """The result's columns but the id."""
    edited = edit(text, follower)
    edited_fp = fp if edited == text else fingerprint(edited, k, slots, width)
    return len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), _bytes(fp), _bytes(edited_fp), likeness(fp, edited_fp), likeness(fp, next_fp)


def _columns(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


_FIELDS = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fp", pa.binary()), ("edited_fp", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
_PASSED = pa.schema([*_FIELDS, ("kind", pa.int32()), ("part", pa.int32()), ("text", pa.string())])


def _along(k: int, slots: int, width: int):
    """Over a sorted partition: a row per document that has its successor here; the first and the last text as rows of their own."""

    def run(batches):
        part, held = TaskContext.get().partitionId(), None
        none = (None,) * 6
        for b in batches:
            out = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                text = text or ""
                fp = held[2] if held is not None and held[1] == text else fingerprint(text, k, slots, width)
                if held is None:
                    out.append((None, *none, _FIRST, part, text))
                else:
                    out.append((held[0], *_compare(held[1], held[2], text, fp, k, slots, width), _DONE, part, None))
                held = doc_id, text, fp
            if out:
                yield _columns(out, _PASSED)
        if held is not None:
            yield _columns([(held[0], *none, _LAST, part, held[1])], _PASSED)

    return run


def _meet(k: int, slots: int, width: int):
    """The last document of each partition with the first of the next one."""

    def run(batches):
        for b in batches:
            rows = []
            for doc_id, text, follower in zip(*(b.column(i).to_pylist() for i in range(3))):
                rows.append((doc_id, *_compare(text, fingerprint(text, k, slots, width), follower, fingerprint(follower, k, slots, width), k, slots, width)))
            if rows:
                yield _columns(rows, pa.schema(_FIELDS))

    return run


def compare_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, slots: int = SLOTS, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next): one row per row of ``docs``.

    The next document is that of the next smaller id, after the last the first; the only row of a table is its own next.
    Rows of one id follow each other by a hash of their texts; null ids come last. A null text is empty: it has no
    code points, stays empty when edited, and has zeros as fingerprint. Very long texts are edited and read whole.
    Repeated rows stay repeated and are each other's next; extra columns are ignored; an empty table gives an empty result.
    """
    chosen = small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), text_keys(F.col(text_col))[0].alias("key"), F.monotonically_increasing_id().alias("nr"))
    order = [F.desc_nulls_last("doc_id"), F.asc("key"), F.asc("nr")]  # nr also spreads equal rows over partitions
    dealt = chosen.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    passed = materialise(dealt.mapInArrow(_along(k, slots, width), f"{_RESULT}, kind int, part int, text string"), "ordermin")
    parts = sorted(r.part for r in passed.where(F.col("kind") == _FIRST).select("part").collect())  # a number per partition
    after = passed.sparkSession.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part int, follows int")
    last = passed.where(F.col("kind") == _LAST).select("part", "doc_id", "text").join(after, "part")
    first = passed.where(F.col("kind") == _FIRST).select(F.col("part").alias("follows"), F.col("text").alias("follower"))
    met = last.join(first, "follows").select("doc_id", "text", "follower").mapInArrow(_meet(k, slots, width), _RESULT)
    rows = passed.where(F.col("kind") == _DONE).select(*met.columns).unionByName(met)
    shown = lambda c: F.lower(F.hex(c))
    return rows.select("doc_id", "n_chars", "edited_sha256", shown("fp").alias("fingerprint"), shown("edited_fp").alias("edited_fingerprint"), "near_edited", "near_next")

"""Shared helpers: the cluster's shared folder, salted joins, connected components, hashing."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

import numpy as np
import pyarrow.fs as pafs
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words everywhere in this subpackage: maximal runs of anything but these six ASCII characters.
WORD = r"[^\x20\x09-\x0D]+"
SALTS = 8

_own_dir: list[str] = []
_scope: list[str] = []
_scratch: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``. Where that is unset, a temporary one on a local master; on a cluster that is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        if not _own_dir:
            _own_dir.append(tempfile.mkdtemp(prefix="rasterspark-"))
        base = "file://" + _own_dir[0]
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if _scope:
        _scratch.setdefault(_scope[-1], []).append(path)
    return path


@contextlib.contextmanager
def scratch(name: str):
    """What is written to the shared folder meanwhile belongs to ``name``, until ``release`` deletes it."""
    _scope.append(name)
    try:
        yield
    finally:
        _scope.pop()


def release(spark: SparkSession, name: str) -> None:
    """Delete what belongs to ``name``: to be called once nothing reads it any more."""
    for path in _scratch.pop(name, []):
        fs, at = pafs.FileSystem.from_uri(path)
        if fs.get_file_info(at).type == pafs.FileType.Directory:
            fs.delete_dir(at)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts the lineage and fixes the rows."""
    spark, path = df.sparkSession, shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(df: DataFrame) -> DataFrame:
    """Make Spark send rows with whole texts to Python in batches of a few MB; returns ``df``."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    return df


def salted_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", salts: int = SALTS, hash_right: bool = False) -> DataFrame:
    """Join with the hot keys of ``left`` dealt over ``salts`` tasks; ``right`` should be unique on ``on``.

    ``how``: inner, left or left_semi. Every row of ``right`` is repeated ``salts`` times, so it should be the smaller side.
    ``hash_right``: hash a partition of ``right`` instead of sorting the rows of ``left``, where these are wide.
    """
    a = left.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
    b = right.withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(salts)])))
    return a.join(b.hint("shuffle_hash") if hash_right else b, [*on, "_salt"], how).drop("_salt")


def text_keys(text: Column) -> list[Column]:
    """Two hashes (k0, k1) that together with the id tell rows of different texts apart."""
    return [F.xxhash64(F.lit(i), text).alias(f"k{i}") for i in range(2)]


def rows_of(docs: DataFrame, keys: DataFrame, how: str, broadcast_limit: int = 0) -> DataFrame:
    """Rows of ``docs`` whose id and text are (left_semi) or are not (left_anti) among ``keys(doc_id, k0, k1)``, null ids included.

    Up to ``broadcast_limit`` keys, counted, are sent to all tasks; beyond that both sides are shuffled and the keys of a
    partition are hashed, never the texts.
    """
    small = keys.select(F.col("doc_id").alias("_id"), F.col("k0").alias("_k0"), F.col("k1").alias("_k1"))
    few = broadcast_limit > 0 and keys.count() <= broadcast_limit
    small = F.broadcast(small) if few else small.hint("shuffle_hash")
    k0, k1 = text_keys(docs["text"])
    same = docs["doc_id"].cast("long").eqNullSafe(small["_id"]) & (k0 == small["_k0"]) & (k1 == small["_k1"])
    return docs.join(small, same, how)


def n_words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for the nodes of ``edges(a, b)``: root is the least node that is reachable.

    Alternating large-star and small-star rounds; each is a grouped minimum and a salted join, so a
    node with very many neighbours is no single task. Rounds end when the edges no longer change.
    """
    e = materialise(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "cc")
    state = None
    for _ in range(max_rounds):
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003), F.sum(F.xxhash64("b", "a") % 999_983)).first()
        if now == state or now[0] == 0:
            break
        state = now
        both = e.union(e.select(F.col("b"), F.col("a")).toDF("a", "b"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = salted_join(both, least, ["a"]).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = salted_join(large, least, ["a"])
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        e = materialise(small.where("a <> b").distinct(), "cc")
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(e.select("b", "b")).distinct()


_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser (public domain, Vigna 2015), element by element."""
    with np.errstate(over="ignore"):
        x = x + _M1
        x = (x ^ (x >> np.uint64(30))) * _M2
        x = (x ^ (x >> np.uint64(27))) * _M3
        return x ^ (x >> np.uint64(31))


class Rolling:
    """Polynomial hashes modulo 2**64 of any stretch of an array, from one running sum.

    The base is odd and so has an inverse: hash(s, e) = (P[e] - P[s]) * base**-s, whatever s is.
    """

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up), 1 << 16)
            with np.errstate(over="ignore"):
                self.up, self.down = (np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n - 1, b, np.uint64))]) for b in (self.base, self.inverse))

    def sums(self, x: np.ndarray) -> np.ndarray:
        self._powers(len(x) + 1)
        with np.errstate(over="ignore"):
            return np.concatenate([np.zeros(1, np.uint64), np.cumsum(x * self.up[: len(x)])])

    def hashes(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (sums[end] - sums[start]) * self.down[start]


#: Words of more bytes are hashed one by one: a polynomial modulo 2**64 can take long words for each other, whatever its base.
LONG_WORD = 64


def word_hashes(data: bytes, rolling: Rolling) -> np.ndarray:
    """A 64-bit hash of each word of ``data`` (words joined by single spaces)."""
    if not data:
        return np.zeros(0, np.uint64)
    a = np.frombuffer(data, np.uint8)
    gaps = np.flatnonzero(a == 32)
    start, end = np.concatenate([[0], gaps + 1]), np.concatenate([gaps, [len(a)]])
    out = rolling.hashes(rolling.sums(a.astype(np.uint64) + np.uint64(1)), start, end)
    with np.errstate(over="ignore"):
        out = mix64(out ^ (end - start).astype(np.uint64) * _M1)
    for i in np.flatnonzero(end - start > LONG_WORD).tolist():
        out[i] = xxhash.xxh64_intdigest(data[start[i] : end[i]], rolling.base & 0xFFFF)
    return out

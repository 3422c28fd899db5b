"""Tables that a job writes for itself, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

_own_dir: list[str] = []
_folders: list[str] = []
_tables: list[str] = []


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``. Where that is unset, a temporary one on a local master; on a cluster that is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        if not _own_dir:
            _own_dir.append(tempfile.mkdtemp(prefix="spark-"))
        base = "file://" + _own_dir[0]
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _folders.append(path)
    return path


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as Parquet, read back: what several steps read is computed once and survives lost executors."""
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, label: str, keys: list[str], buckets: int | None = None) -> DataFrame:
    """The same, dealt to buckets by ``keys``, a sorted file each: groupings and joins by these keys read it without a shuffle."""
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"rasterspark_{label}_{uuid.uuid4().hex}"
    out = df.repartition(n, *keys).write.format("parquet").bucketBy(n, *keys).sortBy(*keys).option("path", shared_dir(spark, label))
    out.saveAsTable(name)
    _tables.append(name)
    return spark.table(name)


def release(spark: SparkSession) -> int:
    """Delete all that was written here so far, to be called once no result that reads it is needed; the number of folders."""
    while _tables:
        spark.sql(f"drop table if exists {_tables.pop()}")
    n = len(_folders)
    while _folders:
        fs, path = pafs.FileSystem.from_uri(_folders.pop())
        if fs.get_file_info(path).type == pafs.FileType.Directory:
            fs.delete_dir(path)
    return n

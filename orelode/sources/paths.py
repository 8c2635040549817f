"""Shared-storage paths, through the file system Spark itself is configured for."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql.streaming import DataStreamReader

# Spark's file streams skip files a week older than the newest; a layer that fell behind would
# lose them without a word.
MAX_FILE_AGE = "36500d"


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the cluster's shared checkpoint folder, or else under the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    return f"{base.rstrip('/')}/orelode-{name}-{uuid.uuid4().hex}"


def compact_write(df: DataFrame) -> DataFrameWriter:
    """A writer that replaces; entropy coding halves what hashes and numbers take."""
    return df.write.mode("overwrite").option("compression", "zstd")


def materialise(df, name: str, compact: bool = False):
    """Write ``df`` to shared storage and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    (compact_write(df) if compact else df.write.mode("overwrite")).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def complete_batches(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers n of the sub-folders ``prefix=n`` of ``path`` whose write was committed.

    Batches are written one after the other, so only the last can be unfinished: one listing and
    one look, however many there are.
    """
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(root)]
    found = sorted(int(n.split("=", 1)[1]) for n in names if n.startswith(f"{prefix}="))
    if found and not exists(spark, f"{path}/{prefix}={found[-1]}/_SUCCESS"):
        found.pop()
    return found


def numbered(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers n of the sub-folders ``prefix=n`` of ``path``, in order."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [status.getPath().getName() for status in fs.listStatus(root)] if fs.exists(root) else []
    return sorted(int(n.split("=", 1)[1]) for n in names if n.startswith(f"{prefix}="))


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def length(spark: SparkSession, path: str | list[str]) -> int:
    """Bytes of the files at or under ``path``, or several such."""
    conf, hadoop = spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs.Path
    targets = [hadoop(p) for p in ([path] if isinstance(path, str) else path)]
    return sum(t.getFileSystem(conf).getContentSummary(t).getLength() for t in targets)


def remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def file_stream(spark: SparkSession) -> DataStreamReader:
    """A file stream that takes every file once, however old."""
    return spark.readStream.option("maxFileAge", MAX_FILE_AGE)

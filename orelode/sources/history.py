"""Which files were loaded, by what they held: a file replaced under its name is new again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A file as it was when loaded.
FILE = ("path", "modified", "length")
HISTORY_SCHEMA = "path string, modified timestamp, length bigint"


def present_files(spark: SparkSession, path: str) -> DataFrame:
    """The files under ``path`` with time and length, from their listing: no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.col("modificationTime").alias("modified"), "length")


def unloaded_files(spark: SparkSession, path: str, history: DataFrame, max_files: int) -> DataFrame:
    """The oldest ``max_files`` files under ``path`` that the history does not hold as they are now.

    Files of one time go by name. Call again after each load until no file is left.
    """
    new = present_files(spark, path).join(history.select(*FILE).distinct(), list(FILE), "left_anti")
    return new.orderBy("modified", "path").limit(max_files)

"""Sides of joins that Spark may send to every executor, by the number of their rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Bytes in memory that such a side may have, and what a row and a value take there at most, bar long texts.
MOST_BYTES, ROW_BYTES, VALUE_BYTES = 32 * 1024 * 1024, 48, 40


def weighed(side: DataFrame, rows: int) -> DataFrame:
    """``side`` of at most so many rows, merged where those would be too much for the driver.

    Spark weighs a stored table by its files, which hold repeated values in a hundredth of the room that rows
    take. Where the rows are few it decides as ever.
    """
    return side.hint("merge") if rows * (ROW_BYTES + VALUE_BYTES * len(side.columns)) > MOST_BYTES else side

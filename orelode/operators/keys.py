"""Surrogate keys without a global sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Every load numbers its rows inside its own block, so keys grow from load to load and no load
# has to look up the largest key already given out.
KEY_BLOCK = 1 << 40
AMBIGUOUS = "ambiguous merge source"

# Multiplying by a generator modulo a prime and keeping the high end spreads consecutive and strided
# keys alike; both factors stay below 2^31, so the product fits a bigint.
_MODULUS = 2147483647
_MULTIPLIER = 1583458089


def key_bucket(key: Column, buckets: int) -> Column:
    """Spread whole-number keys evenly over ``buckets``, by arithmetic any SQL engine can repeat."""
    mixed = F.pmod(F.pmod(key, F.lit(_MODULUS)) * F.lit(_MULTIPLIER), F.lit(_MODULUS))
    bucket = F.call_function("div", mixed * F.lit(buckets), F.lit(_MODULUS))
    return F.coalesce(bucket, F.lit(0)).cast("bigint")


def assign_keys(
    df: DataFrame, surrogate: str, key: str, load_no: int, buckets: int, order_by: tuple[str, ...] = (),
    unique: bool = False,
) -> DataFrame:
    """Number the rows: unique, above all keys of earlier loads, with gaps.

    Rows are numbered inside buckets of the key and the numbers interleaved, so the work spreads
    over ``buckets`` tasks with no second pass for offsets. ``key`` must be all but unique in ``df``
    (one row per key, or few versions of it), which makes the buckets even. The numbering is a
    function of the rows alone, so a recomputed task gives out the same keys. A load with more rows than
    its block has numbers fails. ``unique`` fails the write where a key occurs twice: such a merge
    source is ambiguous.
    """
    w = Window.partitionBy("_bucket").orderBy(
        F.col(key).asc_nulls_first(), *(F.col(c).asc_nulls_first() for c in order_by)
    )
    place = (F.row_number().over(w).cast("bigint") - 1) * F.lit(buckets) + F.col("_bucket") + 1
    number = F.when(place <= KEY_BLOCK, F.lit(load_no * KEY_BLOCK) + place).otherwise(
        F.raise_error(F.lit(f"{surrogate}: load {load_no} has more rows than its block has numbers")).cast("bigint")
    )
    if unique:
        twice = F.concat(
            F.lit(f"{AMBIGUOUS}: {key} "), F.col(key).cast("string"), F.lit(" occurs more than once in the source")
        )
        # NULL keys match nothing, so they may repeat.
        number = F.when(F.lag(key).over(w) == F.col(key), F.raise_error(twice).cast("bigint")).otherwise(number)
    return (
        df.withColumn("_bucket", key_bucket(F.col(key), buckets)).withColumn(surrogate, number).drop("_bucket")
    )

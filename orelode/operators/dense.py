"""Surrogate keys without gaps, in the order of the business key."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orelode.sources.paths import materialise

_RANGE, _PLACE, _BEFORE = "_range", "_place", "_before"
# The lower bits of Spark's growing ids: the row's place in its partition.
_PLACE_BITS = (1 << 33) - 1


def dense_keys(df: DataFrame, surrogate: str, key: str, after: int = 0) -> DataFrame:
    """``df`` with ``surrogate`` set to ``after`` + 1, + 2, ... in the order of ``key``, NULL keys first.

    Rows are dealt out by ranges of the key, sorted inside them and written with their place, so no window
    runs over them and a lost task cannot number anew what others have read. What a range begins with is the
    sum of the sizes before it: one number a range reaches the driver. Equal keys follow the hash of their
    row's plain columns, which also splits them over ranges; where that is equal too, any order is right. No row gives no row.
    """
    plain = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("variant", "map") and f.name != surrogate]
    order = [F.col(key).asc_nulls_first(), F.xxhash64(*plain).asc()]
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "*", F.spark_partition_id().alias(_RANGE),
        F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACE_BITS)).alias(_PLACE),
    )
    stored = materialise(placed, "dense-keys")
    sizes = sorted(stored.groupBy(_RANGE).agg(F.count(F.lit(1))).collect())
    begins = accumulate((n for _, n in sizes), initial=after)
    offsets = df.sparkSession.createDataFrame(
        [(r, begin) for (r, _), begin in zip(sizes, begins)], f"{_RANGE} int, {_BEFORE} bigint"
    )
    number = F.col(_BEFORE) + F.col(_PLACE) + 1
    return stored.join(offsets, _RANGE).withColumn(surrogate, number).select(*dict.fromkeys([*df.columns, surrogate]))

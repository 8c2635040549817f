"""Keeping one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orelode.specs import EntitySpec

_RANK = "_rank"


def latest_per_key(df: DataFrame, spec: EntitySpec, columns: tuple[str, ...] | None = None) -> DataFrame:
    """The newest image of every business key, NULL keys counting as one key.

    A NULL timestamp sorts as newest. Equal images are told apart by the lineage and then by the
    data itself, so the result does not depend on partitioning. Filtering the rank to 1 makes
    Spark drop all but one row per key and task *before* the shuffle (WindowGroupLimit), so a key
    holding a large share of the rows does not become a large task.

    ``columns`` limits the result to the columns that are read. Rows that are equal in all columns of the
    order up to the last such one are the same row to the reader, so the rest neither orders nor moves.
    """
    order = [*spec.newest_by, "ingestion_ts", *spec.tiebreak]
    if columns is not None:
        while len(order) > 1 and order[-1] not in columns:
            order.pop()
    w = Window.partitionBy(spec.key).orderBy(*(F.col(c).desc_nulls_first() for c in order))
    newest = df.withColumn(_RANK, F.row_number().over(w)).where(F.col(_RANK) == 1).drop(_RANK)
    return newest if columns is None else newest.select(*columns)

"""Change feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BATCH = "_batch_id"


def net_changes(feed: DataFrame, key: str) -> DataFrame:
    """The last image per key over several batches of a change feed.

    NULL keys are rows of their own: a merge inserts one per batch and never matches it again.
    """
    own = F.when(F.col(key).isNull(), F.col(BATCH))
    w = Window.partitionBy(F.col(key), own).orderBy(F.col(BATCH).desc())
    return feed.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") == 1).drop("_rank")

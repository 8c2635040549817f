"""Full change images: what a row was before a batch and what it is after, deletions included."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orelode.operators.changes import BATCH
from orelode.operators.merge import ACTION, INSERT, UPDATE

DELETE = "delete"
BEFORE, AFTER = "before", "after"


def _row(columns: list[str], prefix: str = "") -> Column:
    return F.struct(*(F.col(f"{prefix}{c}").alias(c) for c in columns))


def merge_images(
    target: DataFrame, changes: DataFrame, key: str, deleted: DataFrame | None = None
) -> DataFrame:
    """``(key, before, after)`` of a batch: its after-images, and ``deleted`` (a column of keys).

    ``target`` need only hold the rows of the batch's keys. A key that is both changed and deleted is
    deleted; deleting a key that the table does not hold leaves no image. Keys are unique on all sides; a
    NULL key meets nothing, so it is inserted and never deleted.
    """
    columns = list(target.columns)
    old = target.select(F.col(key).alias("_k"), _row(columns).alias(BEFORE))
    new = changes.select(F.col(key), _row(columns).alias(AFTER))
    if deleted is not None:
        new = new.join(deleted.select(F.col(deleted.columns[0]).alias(key)).distinct(), key, "left_anti")
    out = new.join(old, F.col(key) == F.col("_k"), "left").select(key, BEFORE, AFTER)
    if deleted is None:
        return out
    gone = deleted.select(F.col(deleted.columns[0]).alias(key)).distinct()
    kind = out.schema[AFTER].dataType
    gone = gone.join(old, F.col(key) == F.col("_k")).select(key, BEFORE, F.lit(None).cast(kind).alias(AFTER))
    return out.unionByName(gone)


def apply_images(target: DataFrame, images: DataFrame, key: str) -> DataFrame:
    """The table after a batch, from its images alone."""
    kept = target.join(images.where(F.col(BEFORE).isNotNull()).select(key), key, "left_anti")
    return kept.unionByName(images.where(F.col(AFTER).isNotNull()).select(f"{AFTER}.*").select(*target.columns))


def net_images(feed: DataFrame, key: str, compared: tuple[str, ...]) -> DataFrame:
    """What several batches of a feed come to, per key: its first before- and last after-image.

    A key that ends as it began (changed and changed back, inserted and deleted) has no row; ``compared``
    names the columns that tell. One aggregation, combined before the shuffle: a key that changes in every
    batch sends one row a task. NULL keys are rows of their own and stay as they are.
    """
    own = F.when(F.col(key).isNull(), F.struct(BATCH, F.monotonically_increasing_id().alias("row")))
    first = F.min_by(F.struct(BEFORE), BATCH)[BEFORE].alias(BEFORE)
    last = F.max_by(F.struct(AFTER), BATCH)[AFTER].alias(AFTER)
    net = feed.withColumn("_own", own).groupBy(key, "_own").agg(first, last).drop("_own")
    same = F.lit(True)
    for c in compared:
        same = same & F.col(f"{BEFORE}.{c}").eqNullSafe(F.col(f"{AFTER}.{c}"))
    had, has = F.col(BEFORE).isNotNull(), F.col(AFTER).isNotNull()
    action = F.when(had & has & ~same, UPDATE).when(had & ~has, DELETE).when(~had & has, INSERT)
    return net.withColumn(ACTION, action).where(F.col(ACTION).isNotNull())

"""Point-in-time dimension lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orelode.specs import UNKNOWN_KEY, DimSpec


def pit_lookup(
    facts: DataFrame, dim: DataFrame, spec: DimSpec, key: str, at: str, out: str | None = None
) -> DataFrame:
    """Add the surrogate key of the version valid at ``at``, or -1.

    An equi-join on the natural key with the validity range as residual: a hash or sort-merge
    join, never a nested loop. Spark broadcasts the dimension if it measures small; otherwise a
    key that dominates the facts is split by adaptive skew handling (the facts are the outer
    side). Versions per key are bounded by the number of dimension loads, not by the data.
    """
    out = out or spec.surrogate
    versions = dim.select(
        F.col(spec.natural_key).alias("_d_id"),
        F.col(spec.surrogate).alias("_d_key"),
        F.col("valid_from").alias("_d_from"),
        F.col("valid_to").alias("_d_to"),
    )
    hit = (
        (F.col(key) == F.col("_d_id"))
        & (F.col(at) >= F.col("_d_from"))
        & (F.col(at) < F.col("_d_to"))
    )
    return (
        facts.join(versions, hit, "left")
        .withColumn(out, F.coalesce(F.col("_d_key"), F.lit(UNKNOWN_KEY).cast("bigint")))
        .drop("_d_id", "_d_key", "_d_from", "_d_to")
    )


def history_lookup(
    facts: DataFrame, versions: DataFrame, key: str, at: str, since: str, values: tuple[str, ...],
    width: str = "MONTH",
) -> DataFrame:
    """Add the ``values`` of the version of ``key`` that was valid at ``at``; NULL where there was none.

    For keys with long histories, where a join on the key alone would meet all versions of it.
    ``versions`` has the key, ``since`` (from when on it holds, until the next one's) and the values.
    Facts and versions are sorted together in stretches of time (``width``, as ``date_trunc`` has it) and
    the last version is carried on, so each row is met once and a key is dealt out by time. What a
    stretch begins with comes from one row per key and stretch.

    Of versions that begin at the same time the one with the largest values holds. Facts and
    versions without key or time find nothing; all facts stay, repeated ones too.
    """
    names = [f"_v_{i}" for i in range(len(values))]
    value = F.struct(*(F.col(v).alias(n) for v, n in zip(values, names)))
    history = versions.where(F.col(key).isNotNull() & F.col(since).isNotNull()).select(
        F.col(key).alias("_key"), F.col(since).cast("timestamp_ntz").alias("_at"), value.alias("_value")
    )
    # One version a time; also the newest of each stretch, of which the next stretches begin.
    history = history.groupBy("_key", "_at").agg(F.max("_value").alias("_value"))
    stretch = F.date_trunc(width, F.col("_at")).alias("_stretch")
    history = history.select("_key", "_at", stretch, "_value")
    wanted = facts.where(F.col(key).isNotNull() & F.col(at).isNotNull()).select(
        F.col(key).alias("_key"), F.date_trunc(width, F.col(at).cast("timestamp_ntz")).alias("_stretch")
    )
    last = history.groupBy("_key", "_stretch").agg(F.max_by("_value", "_at").alias("_value"))
    marks = last.unionByName(
        wanted.distinct().withColumn("_value", F.lit(None).cast(history.schema["_value"].dataType))
    ).groupBy("_key", "_stretch").agg(F.max("_value").alias("_value"))
    before = Window.partitionBy("_key").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    start = marks.select("_key", "_stretch", F.last("_value", ignorenulls=True).over(before).alias("_value"))
    start = start.where("_value is not null").select(
        "_key", F.col("_stretch").alias("_at"), "_stretch", "_value", F.lit(0).alias("_kind")
    )
    fact = F.struct(*(F.col(c) for c in facts.columns))
    rows = facts.select(
        F.col(key).alias("_key"), F.col(at).cast("timestamp_ntz").alias("_at"), fact.alias("_fact"), F.lit(2).alias("_kind")
    ).withColumn("_stretch", F.date_trunc(width, F.col("_at")))
    known = F.col("_key").isNotNull() & F.col("_at").isNotNull()
    both = (
        start.unionByName(history.withColumn("_kind", F.lit(1)))
        .unionByName(rows.where(known), allowMissingColumns=True)
    )
    # What a stretch begins with comes before its own versions, a version before the facts of its time.
    inside = Window.partitionBy("_key", "_stretch").orderBy("_at", "_kind")
    carried = F.last("_value", ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    found = both.withColumn("_found", carried).where("_kind = 2").select("_fact", "_found")
    unknown = rows.where(~F.coalesce(known, F.lit(False))).select(
        "_fact", F.lit(None).cast(history.schema["_value"].dataType).alias("_found")
    )
    return found.unionByName(unknown).select(
        "_fact.*", *(F.col(f"_found.{n}").alias(v) for v, n in zip(values, names))
    )

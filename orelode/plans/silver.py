"""Bronze batch to silver source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orelode.functions.hashing import packed, unpacked
from orelode.operators.dedup import latest_per_key
from orelode.operators.merge import MergeRule, merge_apply
from orelode.operators.quality import accepted, dq_tag, parse
from orelode.specs import EntitySpec


def tag(bronze: DataFrame, spec: EntitySpec, strict: bool = False) -> DataFrame:
    return dq_tag(parse(bronze, spec), spec, strict)


def silver_source(tagged: DataFrame, spec: EntitySpec, columns: tuple[str, ...] | None = None) -> DataFrame:
    """Accepted rows, newest per key. Rejection comes first: an older valid image may win.

    The change hash moves as bytes. ``columns``: see :func:`latest_per_key`.
    """
    rows = accepted(tagged, spec)
    if not spec.hash_parts:
        return latest_per_key(rows, spec, columns)
    newest = latest_per_key(rows.withColumn("hash_value", packed(F.col("hash_value"))), spec, columns)
    if "hash_value" not in newest.columns:
        return newest
    return newest.withColumn("hash_value", unpacked(F.col("hash_value")))


def merge_silver(
    target: DataFrame, source: DataFrame, spec: EntitySpec, load_ts: Column
) -> DataFrame:
    return merge_apply(target, source, MergeRule.for_entity(spec), load_ts)

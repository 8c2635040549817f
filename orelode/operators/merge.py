"""Merging a batch into a table, as joins.

Two lowerings of the same merge: ``merge_apply`` returns the whole next state from one full outer
join; ``merge_changes`` returns only the rows the batch writes, for tables kept as a snapshot plus
a change feed, where the cost should follow the batch and not the table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orelode.operators.sizes import weighed
from orelode.specs import EntitySpec, FactSpec

ACTION = "_action"
INSERT, UPDATE, KEEP = "insert", "update", "keep"

_HIT_S, _HIT_T = "_in_source", "_in_target"


@dataclass(frozen=True)
class MergeRule:
    key: str
    columns: tuple[str, ...]
    update: tuple[str, ...]
    gate: str  # "hash": update if hash_value differs; "always"; "never" (insert only)
    stamp: str | None = "ingestion_ts"  # set to the load time on every written row
    newer: str | None = None  # update only if this column grew

    @staticmethod
    def for_entity(spec: EntitySpec) -> MergeRule:
        if spec.insert_only:
            return MergeRule(spec.key, spec.columns, (), "never")
        return MergeRule(
            spec.key,
            spec.columns,
            (*spec.update, "hash_value", "source_file"),
            "hash",
            newer=spec.newest_by[0] if spec.guard_newer and spec.newest_by else None,
        )

    @staticmethod
    def for_fact(spec: FactSpec) -> MergeRule:
        return MergeRule(spec.key, spec.columns, spec.update, "never" if spec.insert_only else "always")


def _target_side(target: DataFrame, rule: MergeRule) -> DataFrame:
    return target.select(*(F.col(c).alias(f"_t_{c}") for c in rule.columns), F.lit(True).alias(_HIT_T))


def _gate(rule: MergeRule) -> Column:
    if rule.gate == "never":
        return F.lit(False)
    gate = F.lit(True)
    if rule.gate == "hash":
        gate = F.col("hash_value") != F.col("_t_hash_value")
    if rule.newer:
        gate = gate & (F.col(rule.newer) > F.col(f"_t_{rule.newer}"))
    return gate


def _next_image(joined: DataFrame, rule: MergeRule, load_ts: Column) -> DataFrame:
    action = (
        F.when(F.col(_HIT_T).isNull(), INSERT)
        .when(F.col(_HIT_S).isNotNull() & _gate(rule), UPDATE)
        .otherwise(KEEP)
    )
    joined = joined.withColumn(ACTION, action)
    inserted = F.col(ACTION) == INSERT
    written = F.col(ACTION) != KEEP
    out = []
    for c in rule.columns:
        if c == rule.stamp:
            value = F.when(written, load_ts).otherwise(F.col(f"_t_{c}"))
        elif c in rule.update:
            value = F.when(written, F.col(c)).otherwise(F.col(f"_t_{c}"))
        else:
            value = F.when(inserted, F.col(c)).otherwise(F.col(f"_t_{c}"))
        out.append(value.alias(c))
    return joined.select(*out, ACTION)


def merge_apply(target: DataFrame, source: DataFrame, rule: MergeRule, load_ts: Column) -> DataFrame:
    """The next state of ``target``, every row marked keep, update or insert.

    Keys are unique on both sides (a NULL key matches nothing), so no key can make the join skew.
    """
    s = source.withColumn(_HIT_S, F.lit(True))
    joined = s.join(_target_side(target, rule), F.col(rule.key) == F.col(f"_t_{rule.key}"), "full_outer")
    return _next_image(joined, rule, load_ts)


def insert_all(source: DataFrame, rule: MergeRule, load_ts: Column) -> DataFrame:
    """What merging into an empty table writes, without a join."""
    return source.select(
        *(load_ts.alias(c) if c == rule.stamp else F.col(c) for c in rule.columns),
        F.lit(INSERT).alias(ACTION),
    )


def merge_changes(
    target: DataFrame,
    source: DataFrame,
    rule: MergeRule,
    load_ts: Column,
) -> DataFrame:
    """Only the rows the merge inserts or updates, as after-images.

    ``target`` need only hold the rows the source's keys can match.
    """
    if rule.gate == "never":
        keys = target.select(rule.key)
        return insert_all(source.join(keys, rule.key, "left_anti"), rule, load_ts)
    s = source.withColumn(_HIT_S, F.lit(True))
    joined = s.join(_target_side(target, rule), F.col(rule.key) == F.col(f"_t_{rule.key}"), "left")
    return _next_image(joined, rule, load_ts).where(F.col(ACTION) != KEEP)


def apply_changes(target: DataFrame, changes: DataFrame, key: str, rows: int = 0) -> DataFrame:
    """Replace or add the changed rows, ``rows`` at most if known. Small change sets are broadcast, the table
    stays in place."""
    kept = target.join(weighed(changes.select(key), rows), key, "left_anti")
    return kept.unionByName(changes.select(*target.columns))


def duplicate_keys(source: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once in a merge source, which would make the merge ambiguous."""
    return source.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)

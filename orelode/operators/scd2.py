"""Type-2 slowly changing dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orelode.functions.dates import ntz
from orelode.operators.keys import assign_keys
from orelode.operators.merge import ACTION, INSERT, UPDATE
from orelode.specs import BEGIN_OF_TIME, END_OF_TIME, UNKNOWN_KEY, DimSpec

NEW, CHANGED, SAME = "new", "changed", "same"
STATE = "_state"


def unknown_member(spark, spec: DimSpec) -> DataFrame:
    """The row facts point at when nothing matches."""
    values = {
        spec.surrogate: UNKNOWN_KEY, spec.natural_key: UNKNOWN_KEY, **spec.unknown,
        "hash_value": "0", "is_current": True,
    }
    types = dict(spec.attributes)
    cols: list[Column] = []
    for c in spec.columns:
        if c == "valid_from":
            value = ntz(BEGIN_OF_TIME)
        elif c == "valid_to":
            value = ntz(END_OF_TIME)
        elif c in (spec.surrogate, spec.natural_key):
            value = F.lit(values[c]).cast("bigint")
        else:
            value = F.lit(values[c]).cast(types.get(c, "boolean" if c == "is_current" else "string"))
        cols.append(value.alias(c))
    return spark.range(1).select(*cols)


def classify(dim: DataFrame, source: DataFrame, spec: DimSpec) -> DataFrame:
    """Source rows marked new, changed or same against the current versions, read once.

    Carries the whole current version along (prefixed ``_t_``) for closing it.
    """
    current = dim.where(F.col("is_current")).select(*(F.col(c).alias(f"_t_{c}") for c in spec.columns))
    joined = source.join(
        current, F.col(spec.natural_key) == F.col(f"_t_{spec.natural_key}"), "left"
    )
    state = (
        F.when(F.col(f"_t_{spec.surrogate}").isNull(), NEW)
        .when(F.col("hash_value") != F.col("_t_hash_value"), CHANGED)
        .otherwise(SAME)
    )
    return joined.withColumn(STATE, state)


def _opened(spec: DimSpec, c: str) -> Column:
    """A column of the version a source row opens."""
    if c == spec.surrogate:
        return F.col("_new_key")
    if c == "valid_to":
        return ntz(END_OF_TIME)
    if c == "is_current":
        return F.lit(True)
    return F.col(c)


def scd2_changes(
    dim: DataFrame,
    source: DataFrame,
    spec: DimSpec,
    load_no: int,
    buckets: int,
    mode: str = "versioned",
) -> DataFrame:
    """The dimension rows this load writes: closed versions (update) and opened ones (insert).

    ``source`` has one row per natural key, with attributes, ``hash_value`` and ``valid_from``.
    ``versioned`` closes a changed version and opens the next in the same load. ``close_only``
    closes it and leaves the key without a current version until it next appears in a source.
    ``versioned`` leaves out a source row older than the current version, so a key's intervals never
    overlap; ``close_only`` takes it as it comes.
    A load adds at most one version per key, so a key's history is bounded by the number of loads.
    """
    if mode not in ("versioned", "close_only"):
        raise ValueError(f"unknown mode {mode!r}")
    opening = F.col(STATE) == NEW
    late = F.lit(False)
    if mode == "versioned":
        opening = F.col(STATE) != SAME
        late = F.coalesce(F.col("valid_from") < F.col("_t_valid_from"), F.lit(False))
    # Numbered before the join result is split, so that one pass yields both kinds of row.
    numbered = assign_keys(source, "_new_key", spec.natural_key, load_no, buckets, ("hash_value",))
    marked = classify(dim, numbered, spec).where((F.col(STATE) != SAME) & ~late)

    def closed(c: str) -> Column:
        if c == "valid_to":
            return F.col("valid_from")
        if c == "is_current":
            return F.lit(False)
        return F.col(f"_t_{c}")

    close_row = F.struct(*(closed(c).alias(c) for c in spec.columns), F.lit(UPDATE).alias(ACTION))
    open_row = F.struct(*(_opened(spec, c).alias(c) for c in spec.columns), F.lit(INSERT).alias(ACTION))
    rows = F.filter(
        F.array(F.when(F.col(STATE) == CHANGED, close_row), F.when(opening, open_row)),
        lambda r: r.isNotNull(),
    )
    return marked.select(F.inline(rows))


def scd2_apply(
    dim: DataFrame,
    source: DataFrame,
    spec: DimSpec,
    load_no: int,
    buckets: int,
    mode: str = "versioned",
) -> DataFrame:
    """The next state of the dimension from one read of it and one of the source.

    History rows pass by; current versions meet the source in one full outer join and come out as
    one row (kept, closed, or new) or two (closed and reopened).
    """
    if mode not in ("versioned", "close_only"):
        raise ValueError(f"unknown mode {mode!r}")
    current = dim.where(F.col("is_current")).select(*(F.col(c).alias(f"_t_{c}") for c in spec.columns))
    numbered = assign_keys(source, "_new_key", spec.natural_key, load_no, buckets, ("hash_value",))
    joined = numbered.join(
        current, F.col(spec.natural_key) == F.col(f"_t_{spec.natural_key}"), "full_outer"
    )
    has_old = F.col(f"_t_{spec.surrogate}").isNotNull()
    has_new = F.col("_new_key").isNotNull()
    changed = has_old & has_new & (F.col("hash_value") != F.col("_t_hash_value"))
    if mode == "versioned":
        changed &= ~F.coalesce(F.col("valid_from") < F.col("_t_valid_from"), F.lit(False))
    opening = ~has_old | changed if mode == "versioned" else ~has_old

    def old(c: str) -> Column:
        if c == "valid_to":
            return F.when(changed, F.col("valid_from")).otherwise(F.col("_t_valid_to"))
        if c == "is_current":
            return ~F.coalesce(changed, F.lit(False))
        return F.col(f"_t_{c}")

    rows = F.filter(
        F.array(
            F.when(has_old, F.struct(*(old(c).alias(c) for c in spec.columns))),
            F.when(opening, F.struct(*(_opened(spec, c).alias(c) for c in spec.columns))),
        ),
        lambda r: r.isNotNull(),
    )
    history = dim.where(~F.col("is_current")).select(*spec.columns)
    return joined.select(F.inline(rows)).unionByName(history)

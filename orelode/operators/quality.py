"""Parsing raw records and splitting them by data-quality verdict."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orelode.functions.hashing import change_hash
from orelode.functions.variant import field_absent, field_text, field_typed
from orelode.specs import EntitySpec, Rule

REJECTED = "_rejected"
ERROR_TYPE = "_error_type"

DQ_SCHEMA = (
    "run_id string, batch_timestamp timestamp_ntz, layer string, source_object string, "
    "target_table string, record_key string, raw_record variant, error_type string, "
    "error_message string"
)


def parse(bronze: DataFrame, spec: EntitySpec) -> DataFrame:
    """Typed columns of a bronze batch, each field read from the payload once.

    The payload and the text of the key ride along for the quarantine; consumers that do not ask
    for them have them pruned. A stored string is its own text, so the hash reuses it.
    """
    kinds = dict(spec.fields)
    typed = {n: field_typed("payload", n, k, spec.lenient_casts) for n, k in spec.fields}
    base = bronze.select(
        *(c.alias(n) for n, c in typed.items()),
        *(
            field_text("payload", p.column).alias(f"_text_{p.column}")
            for p in spec.hash_parts
            if not p.typed and kinds[p.column] != "string"
        ),
        *(
            field_absent("payload", c).alias(f"_absent_{c}")
            for c in sorted({r.column for r in spec.rules if r.check in ("absent", "blank")})
        ),
        "payload",
        "source_file",
        "ingestion_ts",
    )
    derived: dict[str, Column] = {d: F.col(ts).cast("date") for d, ts in spec.dates}
    if spec.hash_parts:
        derived["hash_value"] = change_hash(*(_hash_part(p, kinds[p.column]) for p in spec.hash_parts))
    return base.withColumns(derived) if derived else base


def _hash_part(part, kind: str) -> Column:
    if part.typed:
        text = F.col(part.column).cast("string")
    elif kind == "string":
        text = F.col(part.column)
    else:
        text = F.col(f"_text_{part.column}")
    return F.coalesce(text, F.lit(part.default))


def rule_predicate(rule: Rule) -> Column:
    """The rule as a nullable boolean: comparisons with NULL stay NULL."""
    c = F.col(rule.column)
    if rule.check == "negative":
        return c < 0
    if rule.check == "absent":
        return F.col(f"_absent_{rule.column}")
    if rule.check == "null":
        return c.isNull()
    if rule.check == "blank":
        return (F.trim(c) == "") | F.col(f"_absent_{rule.column}")
    if rule.check == "not_email":
        return ~c.like("%@%")
    raise ValueError(f"unknown check {rule.check!r}")


def dq_tag(parsed: DataFrame, spec: EntitySpec, strict: bool = False) -> DataFrame:
    """Add the verdict: rejected is true, false, or NULL where no rule decides.

    NULL arises when a comparison meets a NULL value and no other rule fires. Such rows are
    neither quarantined nor accepted, as SQL's ``P`` / ``NOT P`` would have it; ``strict``
    quarantines them as UNKNOWN instead.
    """
    rules = list(spec.rules)
    preds = [rule_predicate(r) for r in rules]
    names = [r.error_type for r in rules]
    if spec.require_key:
        preds.insert(0, F.col(spec.key).isNull())
        names.insert(0, "NULL_KEY")
    rejected = reduce(or_, preds)
    error = F.when(preds[0], names[0])
    for pred, name in zip(preds[1:], names[1:], strict=True):
        error = error.when(pred, name)
    if strict:
        rejected = F.coalesce(rejected, F.lit(True))
        error = error.when(rejected, "UNKNOWN")
    return parsed.withColumns({REJECTED: rejected, ERROR_TYPE: error})


def accepted(tagged: DataFrame, spec: EntitySpec) -> DataFrame:
    return tagged.where(~F.col(REJECTED)).select(*spec.columns)


def undecided(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col(REJECTED).isNull())


def quarantined(tagged: DataFrame, spec: EntitySpec, run_id: str, load_ts: Column) -> DataFrame:
    """Rejected records in the shape of the error table, the raw record whole."""
    return tagged.where(F.col(REJECTED)).select(
        F.lit(run_id).alias("run_id"),
        load_ts.alias("batch_timestamp"),
        F.lit("SILVER").alias("layer"),
        F.lit(f"{spec.name}_stream").alias("source_object"),
        F.lit(spec.name).alias("target_table"),
        field_text("payload", spec.key).alias("record_key"),
        F.col("payload").alias("raw_record"),
        F.col(ERROR_TYPE).alias("error_type"),
        F.lit("Validation Failed").alias("error_message"),
    )


def verdict(tagged: DataFrame) -> Column:
    """One label per row: the error type, ``accepted`` or ``undecided``."""
    return (
        F.when(F.col(REJECTED), F.col(ERROR_TYPE))
        .when(F.col(REJECTED).isNull(), "undecided")
        .otherwise("accepted")
    )


def orphans(
    child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, error_type: str
) -> DataFrame:
    """Child rows whose parent does not exist. A NULL reference is not an orphan."""
    keys = parent.select(F.col(parent_key).alias(child_key))
    return (
        child.where(F.col(child_key).isNotNull())
        .join(keys, child_key, "left_anti")
        .withColumn("error_type", F.lit(error_type))
    )

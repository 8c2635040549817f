"""Reading fields of a VARIANT record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orelode.specs import KINDS


def field_absent(payload: str, name: str) -> Column:
    """True only if the record lacks the field; an explicit JSON null counts as present."""
    return F.expr(f"variant_get({payload}, '$.{name}') IS NULL")


def field_text(payload: str, name: str) -> Column:
    """The field as text, NULL for both a missing field and a JSON null."""
    return F.expr(f"variant_get({payload}, '$.{name}', 'string')")


def field_typed(payload: str, name: str, kind: str, lenient: bool = False) -> Column:
    """The field as its stored type. Malformed values raise, or become NULL if ``lenient``."""
    read, stored = KINDS[kind]
    get = "try_variant_get" if lenient else "variant_get"
    value = F.expr(f"{get}({payload}, '$.{name}', '{read}')")
    return value if read == stored else value.cast(stored)

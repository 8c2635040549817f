"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orelode.specs import UNKNOWN_KEY


def date_key(d: Column) -> Column:
    """YYYYMMDD as a number, NULL for NULL. Arithmetic, so no text is built per row."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("bigint")


def date_key_or_unknown(d: Column) -> Column:
    return F.coalesce(date_key(d), F.lit(UNKNOWN_KEY).cast("bigint"))


def days_between(start: Column, end: Column) -> Column:
    """Midnights crossed from ``start`` to ``end``; negative if ``end`` comes first."""
    return F.datediff(end, start).cast("bigint")


def ntz(text: str) -> Column:
    """A timestamp without time zone, whatever the session's time zone is."""
    return F.lit(text).cast("timestamp_ntz")

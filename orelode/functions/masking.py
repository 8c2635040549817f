"""Role-dependent column masking."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orelode.specs import MASKED_TEXT, PII_COLUMNS, UNMASKED_ROLES


def mask_columns(
    df: DataFrame,
    role: str,
    columns: Iterable[str] = PII_COLUMNS,
    allowed: Iterable[str] = UNMASKED_ROLES,
) -> DataFrame:
    """Show ``columns`` to the allowed roles only; others see a fixed text, for NULLs too.

    Meant for published views. Loads must read the unmasked table, or hashes would never change.
    """
    if role in set(allowed):
        return df
    return df.withColumns({c: F.lit(MASKED_TEXT) for c in columns if c in df.columns})

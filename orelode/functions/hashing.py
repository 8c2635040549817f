"""Change-detection hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def packed(digest: Column) -> Column:
    """A hex digest as its bytes: half the size, and in the same order."""
    return F.unhex(digest)


def unpacked(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def change_hash(*parts: Column) -> Column:
    """SHA-256 hex of the parts joined with ``|``. Parts must not be NULL: give each a default."""
    return F.sha2(F.concat_ws("|", *parts), 256)

"""Session settings the loads are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Split hot keys and size shuffles at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    """On a cluster the shuffle width should be set from the data: about 128 MB per partition."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**SETTINGS, **extra}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()

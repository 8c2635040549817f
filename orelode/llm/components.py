"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orelode.sources.paths import materialise


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def components(links: DataFrame) -> DataFrame:
    """``(id, component_id)`` for each end of ``links(u, v)`` that is not itself the smallest.

    Ids missing from the result are their own component; so an empty table gives an empty one. NULL
    ends, loops and repeated links say nothing. Each round is written to shared storage; the state
    is the link table alone, whose number of rows never grows.
    """
    ends = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    edges = materialise(
        links.filter("u is not null and v is not null and u != v").select(*ends).distinct(), "links"
    )
    before = None
    while True:
        # Large star: every larger neighbour of u is linked to u's smallest neighbour (or u).
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _least(both).withColumn("m", F.least("m", "u"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        # Small star: u and its smaller neighbours are linked to the smallest of them.
        least = _least(large)
        small = large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialise(
            small.unionByName(least.withColumnRenamed("m", "v")).distinct(), "stars"
        )
        now = edges.agg(
            F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))
        ).first()
        if now == before:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component_id"))
        before = now

"""Marts kept up from change images: what a row was is taken off its group, what it is is added."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orelode.operators.images import AFTER, BEFORE


@dataclass(frozen=True)
class Mart:
    """Rows and sums per group. ``rows`` counts; ``sum_c`` and ``n_c`` are c's sum and its values not NULL."""

    groups: tuple[str, ...]
    sums: tuple[str, ...]

    @property
    def measures(self) -> list[str]:
        return ["rows", *(f"{p}_{c}" for c in self.sums for p in ("sum", "n"))]

    def _totals(self, rows: DataFrame) -> DataFrame:
        """Per group the measures of rows that count ``_sign`` times."""
        sign = F.col("_sign")
        aggs = [F.sum(sign).alias("rows")]
        for c in self.sums:
            aggs += [
                F.coalesce(F.sum(sign * F.col(c)), F.lit(0)).cast("decimal(38,2)").alias(f"sum_{c}"),
                F.coalesce(F.sum(F.when(F.col(c).isNotNull(), sign)), F.lit(0)).alias(f"n_{c}"),
            ]
        return rows.groupBy(*self.groups).agg(*aggs)

    def build(self, rows: DataFrame) -> DataFrame:
        """The mart over whole rows."""
        return self._totals(rows.withColumn("_sign", F.lit(1).cast("long")))

    def delta(self, images: DataFrame) -> DataFrame:
        """What a batch's images add to each group; groups that come to nothing are left out."""
        sides = F.array(
            F.struct(F.lit(-1).cast("long").alias("_sign"), F.col(BEFORE).alias("row")),
            F.struct(F.lit(1).cast("long").alias("_sign"), F.col(AFTER).alias("row")),
        )
        rows = images.select(F.explode(sides).alias("s")).where("s.row is not null")
        rows = rows.select("s._sign", *(F.col(f"s.row.{c}").alias(c) for c in (*self.groups, *self.sums)))
        changed = F.lit(False)
        for m in self.measures:
            changed = changed | (F.col(m) != 0)
        return self._totals(rows).where(changed)

    def apply(self, mart: DataFrame, delta: DataFrame) -> DataFrame:
        """The next mart. Groups of the batch are added up; the others pass by unread but for their key.

        A group whose last row went has no row. NULL is a group of its own, as in ``GROUP BY``.
        """
        same = F.lit(True)
        for g in self.groups:
            same = same & F.col(f"m.{g}").eqNullSafe(F.col(f"d.{g}"))
        m, d = mart.alias("m"), delta.alias("d")
        untouched = m.join(d, same, "left_anti")
        touched = m.join(d, same, "left_semi").unionByName(delta)
        added = [F.sum(c).cast(mart.schema[c].dataType).alias(c) for c in self.measures]
        return untouched.unionByName(touched.groupBy(*self.groups).agg(*added).where("rows > 0"))

    def values(self, mart: DataFrame) -> DataFrame:
        """The mart as a query over the rows would give it: a sum over no value is NULL."""
        sums = [F.when(F.col(f"n_{c}") > 0, F.col(f"sum_{c}")).alias(c) for c in self.sums]
        return mart.select(*self.groups, "rows", *sums)


#: Orders and their amount per status and currency.
ORDER_STATUS = Mart(("order_status", "currency"), ("order_total_amount",))

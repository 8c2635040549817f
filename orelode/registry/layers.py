"""The layers over the test feeds, as lazy DataFrames shared by the queries."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orelode.functions.dates import ntz
from orelode.operators.keys import assign_keys
from orelode.operators.merge import ACTION, KEEP, MergeRule, insert_all, merge_apply, merge_changes
from orelode.operators.scd2 import scd2_apply, unknown_member
from orelode.plans.gold import changed_customer_ids, customer_source, fact_source, product_source
from orelode.plans.silver import silver_source, tag
from orelode.sources.feeds import FEEDS, LOAD_TS, bronze_feed
from orelode.sources.paths import materialise
from orelode.specs import DIM_CUSTOMERS, DIM_PRODUCTS, ENTITIES, FACTS, DimSpec

BUCKETS = 64


def ts(batch: int) -> Column:
    return ntz(LOAD_TS[batch])


class Layers:
    """One query's view of the layers.

    Lazy by default. With ``store`` the silver tables and dimensions are written to shared scratch
    storage as they are first needed and read from there, as gold loads read them in a real run:
    each is computed once, and Spark plans the gold joins on measured sizes. ``columns`` names per
    entity what the query reads of its silver table: of other columns only what the merge needs is
    moved and written.
    """

    def __init__(
        self, spark: SparkSession, sf_dir: str, store: bool = False,
        columns: dict[str, tuple[str, ...]] | None = None,
    ):
        self.spark, self.sf_dir, self.store, self.columns = spark, sf_dir, store, columns or {}
        self._stored: dict[tuple, DataFrame] = {}

    def _keep(self, name: tuple, build: Callable[[], DataFrame]) -> DataFrame:
        if not self.store:
            return build()
        if name not in self._stored:
            self._stored[name] = materialise(build(), "-".join(map(str, name)), compact=True)
        return self._stored[name]

    def warm(self, entities: tuple[str, ...], dims: tuple[DimSpec, ...] = ()) -> Layers:
        """Write independent silver tables at the same time, then independent dimensions."""
        with ThreadPoolExecutor(len(entities)) as pool:
            list(pool.map(self.silver, entities))
            list(pool.map(self.dim, dims))
        return self

    def tagged(self, entity: str, *batches: int, strict: bool = False) -> DataFrame:
        return tag(bronze_feed(self.spark, self.sf_dir, entity, *batches), ENTITIES[entity], strict)

    def rule(self, entity: str) -> MergeRule:
        """The entity's merge, of the columns that are read and the hash that decides updates."""
        rule = MergeRule.for_entity(ENTITIES[entity])
        if entity not in self.columns:
            return rule
        gate = ("hash_value",) if rule.gate == "hash" and self.has_second(entity) else ()
        kept = {*self.columns[entity], rule.key, *gate}
        return replace(rule, columns=tuple(c for c in rule.columns if c in kept))

    def source(self, entity: str, *batches: int) -> DataFrame:
        columns = self.rule(entity).columns if entity in self.columns else None
        return silver_source(self.tagged(entity, *batches), ENTITIES[entity], columns)

    def has_second(self, entity: str) -> bool:
        return any(i.batch == 2 for i in FEEDS[entity].images)

    def silver(self, entity: str, through: int = 2) -> DataFrame:
        """The silver table after one or both batches, with the last merge's actions."""
        first = self._keep(
            ("silver", entity, 1), lambda: insert_all(self.source(entity, 1), self.rule(entity), ts(1))
        )
        if through == 1 or not self.has_second(entity):
            return first
        return self._keep(
            ("silver", entity, 2),
            lambda: merge_apply(first.drop(ACTION), self.source(entity, 2), self.rule(entity), ts(2)),
        )

    def changes(self, entity: str, batch: int) -> DataFrame:
        """The after-images batch 1 or 2 leaves in the change feed."""
        if batch == 1:
            return self.silver(entity, 1)
        if self.store:
            return self.silver(entity).where(F.col(ACTION) != KEEP)
        return merge_changes(
            self.silver(entity, 1).drop(ACTION),
            self.source(entity, 2),
            self.rule(entity),
            ts(2),
        )

    def dim_source(self, name: str, load: int) -> DataFrame:
        if name == DIM_PRODUCTS.name:
            return product_source(self.changes("products", load))
        ids = changed_customer_ids(self.changes("customers", load), self.changes("addresses", load))
        return customer_source(
            self.silver("customers", load), self.silver("addresses", load), ids, ts(load)
        )

    def dim(self, spec: DimSpec, through: int = 2, mode: str = "versioned") -> DataFrame:
        """The dimension after its loads, the unknown member included."""

        if through == 0:
            return unknown_member(self.spark, spec)

        def build() -> DataFrame:
            before = self.dim(spec, through - 1, mode)
            source = self.dim_source(spec.name, through)
            return scd2_apply(before, source, spec, through - 1, BUCKETS, mode)

        return self._keep((spec.name, through, mode), build)

    def fact_rows(self, name: str, changes: DataFrame, load: int) -> DataFrame:
        """Merge source of one load, with the dimensions as that load leaves them."""
        spec = FACTS[name]
        products = self.dim(DIM_PRODUCTS, load) if name == "fact_sales" else None
        customers = self.dim(DIM_CUSTOMERS, load) if name != "fact_order_status_history" else None
        orders = None
        if name in ("fact_sales", "fact_shipments", "fact_payments"):
            orders = self.silver("orders", load)
        rows = fact_source(name, changes, orders, products, customers)
        return assign_keys(rows, spec.surrogate, spec.key, load - 1, BUCKETS)

    def fact(self, name: str) -> DataFrame:
        """The fact after one load per batch."""
        spec = FACTS[name]
        first = insert_all(
            self.fact_rows(name, self.changes(spec.entity, 1), 1), MergeRule.for_fact(spec), ts(1)
        )
        if not self.has_second(spec.entity):
            return first
        second = self.fact_rows(name, self.changes(spec.entity, 2), 2)
        return merge_apply(first.drop(ACTION), second, MergeRule.for_fact(spec), ts(2))


def present(df: DataFrame) -> DataFrame:
    """Decimals as doubles and dates as text, which every client compares alike."""
    casts = {}
    for f in df.schema.fields:
        kind = f.dataType.simpleString()
        if kind.startswith("decimal"):
            casts[f.name] = F.col(f.name).cast("double")
        elif kind == "date":
            casts[f.name] = F.col(f.name).cast("string")
    return df.withColumns(casts) if casts else df

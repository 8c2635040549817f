"""Every registered query: a function of the session and the folder of the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orelode.functions.dates import date_key
from orelode.functions.masking import mask_columns
from orelode.operators.keys import KEY_BLOCK
from orelode.operators.lookup import pit_lookup
from orelode.operators.merge import duplicate_keys
from orelode.operators.quality import dq_tag, orphans, parse, verdict
from orelode.operators.scd2 import CHANGED, NEW, SAME, STATE, classify
from orelode.plans.gold import FACT_READS, changed_customer_ids, dim_date
from orelode.plans.silver import tag
from orelode.plans.views import (
    orders_by_status, publish_views, revenue_by_month, shipping_by_carrier,
)
from orelode.registry import histories, loads, reloads
from orelode.registry.layers import Layers, present
from orelode.sources.bronze import file_manifest
from orelode.sources.feeds import bronze_feed, json_feed, typed_feed
from orelode.specs import (
    DIM_CUSTOMERS, DIM_PRODUCTS, ENTITIES, FACTS, INGESTION, PAYMENTS, EntitySpec, Rule,
)

Query = Callable[[SparkSession, str], DataFrame]

# Silver tables each gold table is loaded from.
_CUSTOMER = ("customers", "addresses")
READS = {
    "dim_products": ("products",),
    "dim_customers": _CUSTOMER,
    "fact_orders": ("orders", *_CUSTOMER),
    "fact_sales": ("order_items", "orders", "products", *_CUSTOMER),
    "fact_shipments": ("shipments", "orders", *_CUSTOMER),
    "fact_payments": ("payments", "orders", *_CUSTOMER),
    "fact_order_status_history": ("order_status_history",),
}


def _read(tables: tuple[str, ...]) -> dict[str, tuple[str, ...]]:
    """The columns of silver tables that facts read; dimensions read theirs whole."""
    whole = {e for t in tables if t not in FACTS for e in READS[t]}
    out: dict[str, tuple[str, ...]] = {}
    for t in tables:
        for entity, columns in FACT_READS.get(t, {}).items():
            out[entity] = tuple(dict.fromkeys((*out.get(entity, ()), *columns)))
    return {e: c for e, c in out.items() if e not in whole}


def stored_for(spark: SparkSession, d: str, *tables: str) -> Layers:
    """Stored silver tables, and where facts are wanted the dimensions they look up."""
    entities = tuple(dict.fromkeys(e for t in tables for e in READS[t]))
    dims = [s for s in (DIM_PRODUCTS, DIM_CUSTOMERS) if set(READS[s.name]) <= set(entities)]
    facts = any(t in FACTS for t in tables)
    return Layers(spark, d, store=True, columns=_read(tables)).warm(entities, tuple(dims) if facts else ())


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# Silver -----------------------------------------------------------------------------------------

def silver_typed(entity: str) -> Query:
    return lambda spark, d: Layers(spark, d).tagged(entity).select(*ENTITIES[entity].columns)


def dq(entity: str) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        tagged = Layers(spark, d).tagged(entity)
        return tagged.groupBy(verdict(tagged).alias("verdict")).agg(F.count(F.lit(1)).alias("n"))

    return run


def dedup(entity: str) -> Query:
    return lambda spark, d: Layers(spark, d).source(entity)


def silver_merge(entity: str) -> Query:
    return lambda spark, d: Layers(spark, d).silver(entity)


def dq_undecided(spark: SparkSession, d: str) -> DataFrame:
    """Rows no rule decides, and what strict mode makes of them."""

    def one(entity: str) -> DataFrame:
        spec = ENTITIES[entity]
        literal = dq_tag(parse(bronze_feed(spark, d, entity), spec), spec)
        both = dq_tag(literal.withColumn("_open", F.col("_rejected").isNull()), spec, strict=True)
        return both.agg(
            F.count(F.when(F.col("_open"), 1)).alias("undecided"),
            F.count(F.when(F.col("_error_type") == "UNKNOWN", 1)).alias("strict_unknown"),
        ).withColumn("entity", F.lit(entity))

    return _union([one(e) for e in ENTITIES])


def dq_json_null_vs_missing(spark: SparkSession, d: str) -> DataFrame:
    """Even orders spell their NULLs out as JSON null, odd ones leave the field out."""
    typed = typed_feed(spark, d, "orders")
    record = F.struct(*(
        F.col(n).cast("string").alias(n) if k in ("money", "timestamp") else F.col(n)
        for n, k in ENTITIES["orders"].fields
    ))
    even = F.col("order_id") % 2 == 0
    value = F.when(even, F.to_json(record, {"ignoreNullFields": "false"})).otherwise(
        F.to_json(record, {"ignoreNullFields": "true"})
    )
    bronze = typed.select(
        F.explode(F.array(F.parse_json(value))).alias("payload"),
        F.current_timestamp().cast("timestamp_ntz").alias("ingestion_ts"),
        "source_file",
    )
    tagged = tag(bronze, ENTITIES["orders"])
    form = F.when(F.col("order_id") % 2 == 0, "json null").otherwise("missing")
    return tagged.groupBy(form.alias("form"), verdict(tagged).alias("verdict")).agg(
        F.count(F.lit(1)).alias("n")
    )


def dq_payments_negative(spark: SparkSession, d: str) -> DataFrame:
    """Payments read from account balances, with the documented rule on negative amounts."""
    customer = spark.read.parquet(f"{d}/customer.parquet")
    record = F.struct(
        F.col("c_custkey").alias("payment_id"),
        F.when(F.col("c_custkey") % 3 == 0, "VISA").otherwise("PAYPAL").alias("provider"),
        F.when(F.col("c_custkey") % 13 != 0, "SUCCESS").alias("payment_status"),
        F.col("c_acctbal").cast("decimal(18,2)").cast("string").alias("amount"),
        F.lit("1995-01-01 00:00:00").alias("created_at"),
    )
    bronze = customer.select(
        F.explode(F.array(F.parse_json(F.to_json(record)))).alias("payload"),
        F.lit("1995-01-01 00:00:00").cast("timestamp_ntz").alias("ingestion_ts"),
        F.lit("b1/a.json").alias("source_file"),
    )
    spec = EntitySpec(
        name=PAYMENTS.name, key=PAYMENTS.key, fields=PAYMENTS.fields, dates=PAYMENTS.dates,
        hash_parts=PAYMENTS.hash_parts,
        rules=(Rule("NEGATIVE_PAYMENT", "negative", "amount"), *PAYMENTS.rules),
    )
    tagged = tag(bronze, spec)
    return tagged.groupBy(verdict(tagged).alias("verdict")).agg(F.count(F.lit(1)).alias("n"))


def dq_orphans(spark: SparkSession, d: str) -> DataFrame:
    """Silver rows whose parent was rejected or never came, per reference."""
    checks = (
        ("order_items", "orders", "order_id", "order_id", "ORPHAN_ORDER"),
        ("order_items", "products", "product_id", "product_id", "ORPHAN_PRODUCT"),
        ("orders", "customers", "customer_id", "customer_id", "ORPHAN_CUSTOMER"),
        ("payments", "orders", "order_id", "order_id", "ORPHAN_ORDER"),
        ("shipments", "orders", "order_id", "order_id", "ORPHAN_ORDER"),
        ("addresses", "customers", "customer_id", "customer_id", "ORPHAN_CUSTOMER"),
    )
    # Keys and references are all that is read of the tables.
    columns: dict[str, tuple[str, ...]] = {}
    for child, parent, child_key, parent_key, _ in checks:
        for entity, column in ((parent, parent_key), (child, child_key)):
            columns[entity] = tuple(dict.fromkeys((*columns.get(entity, ()), column)))
    layers = Layers(spark, d, store=True, columns=columns).warm(tuple(columns))

    def one(child: str, parent: str, child_key: str, parent_key: str, error: str) -> DataFrame:
        found = orphans(layers.silver(child), layers.silver(parent), child_key, parent_key, error)
        return (
            found.groupBy("error_type")
            .agg(F.count(F.lit(1)).alias("n"))
            .withColumn("entity", F.lit(child))
        )

    return _union([one(*c) for c in checks])


# Bronze -----------------------------------------------------------------------------------------

def bronze_config_active(spark: SparkSession, d: str) -> DataFrame:
    """What each active line of the ingestion configuration lands."""
    return _union([
        json_feed(spark, d, entry.entity)
        .agg(F.count("value").alias("rows_landed"))
        .select(F.lit(entry.entity).alias("entity"), F.lit(entry.path).alias("path"), "rows_landed")
        for entry in INGESTION
        if entry.is_active
    ])


def bronze_file_manifest(spark: SparkSession, d: str) -> DataFrame:
    return _union([
        file_manifest(json_feed(spark, d, e)).withColumn("entity", F.lit(e)) for e in ENTITIES
    ])


# Gold -------------------------------------------------------------------------------------------

def dim_date_days(spark: SparkSession, d: str) -> DataFrame:
    """The whole calendar with the orders of each day; order days outside it stay without attributes."""
    orders = typed_feed(spark, d, "orders")
    per_day = orders.groupBy(date_key(F.col("created_at").cast("date")).alias("order_date_key")).agg(
        F.count(F.lit(1)).alias("orders")
    )
    days = dim_date(spark)
    return per_day.join(days, per_day.order_date_key == days.date_key, "full_outer")


def unknown_members(spark: SparkSession, d: str) -> DataFrame:
    """Sales that resolve to the unknown product, by its attributes."""
    layers = stored_for(spark, d, "fact_sales")
    sales = layers.fact("fact_sales").groupBy("product_key").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("total_line_amount").alias("amount")
    )
    dim = layers.dim(DIM_PRODUCTS).where(F.col("product_key") == -1)
    return dim.join(sales, "product_key", "left").select(
        *DIM_PRODUCTS.columns, "lines", F.col("amount").cast("decimal(38,2)").alias("amount")
    )


def dim_state(spec, state: str) -> Query:
    """The second load's source rows that are new to the dimension, or changed in it."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        layers = stored_for(spark, d, spec.name)
        marked = classify(layers.dim(spec, 1), layers.dim_source(spec.name, 2), spec)
        kept = [c for c in spec.columns if c not in (spec.surrogate, "valid_to", "is_current")]
        return marked.where(F.col(STATE) == state).select(*kept)

    return run


def scd2_source_literal(spark: SparkSession, d: str) -> DataFrame:
    """Both branches of the merge source: new keys match nothing, changed keys their own version."""
    layers = Layers(spark, d)
    marked = classify(layers.dim(DIM_PRODUCTS, 1), layers.dim_source(DIM_PRODUCTS.name, 2), DIM_PRODUCTS)
    return marked.where(F.col(STATE) != SAME).select(
        "product_id", "hash_value", "valid_from",
        F.when(F.col(STATE) == CHANGED, F.col("product_id")).alias("join_key"),
    )


def changed_ids(spark: SparkSession, d: str) -> DataFrame:
    layers = Layers(spark, d)
    return changed_customer_ids(layers.changes("customers", 2), layers.changes("addresses", 2))


def dim_customers_source(spark: SparkSession, d: str) -> DataFrame:
    return stored_for(spark, d, DIM_CUSTOMERS.name).dim_source(DIM_CUSTOMERS.name, 2)


def scd2(spec, mode: str) -> Query:
    return lambda spark, d: stored_for(spark, d, spec.name).dim(spec, mode=mode)


def pit(spark: SparkSession, d: str) -> DataFrame:
    """Every item of the feed against the product version valid when it was sold."""
    dim = stored_for(spark, d, DIM_PRODUCTS.name).dim(DIM_PRODUCTS)
    found = pit_lookup(typed_feed(spark, d, "order_items"), dim, DIM_PRODUCTS, "product_id", "created_at")
    return found.groupBy("product_key").agg(
        F.count(F.lit(1)).alias("items"), F.sum("quantity").alias("units")
    )


def fact(name: str) -> Query:
    return lambda spark, d: stored_for(spark, d, name).fact(name)


def surrogate_keys(spark: SparkSession, d: str) -> DataFrame:
    """Per table and load: how many keys, how many of them repeat, and that none leaves its block."""
    layers = stored_for(spark, d, "fact_orders", "dim_products")
    tables = {
        "dim_products": (layers.dim(DIM_PRODUCTS), "product_key"),
        "dim_customers": (layers.dim(DIM_CUSTOMERS), "customer_key"),
        "fact_orders": (layers.fact("fact_orders"), "fact_order_key"),
    }

    def one(name: str, df: DataFrame, key: str) -> DataFrame:
        per_key = df.groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias("n"))
        load_no = F.floor((F.col("k") - 1) / F.lit(KEY_BLOCK)).cast("bigint")
        return per_key.groupBy(load_no.alias("load_no")).agg(
            F.sum("n").alias("row_count"),
            F.count(F.lit(1)).alias("distinct_keys"),
            F.min("k").alias("min_key"),
            F.max("k").alias("max_key"),
        ).withColumn("table_name", F.lit(name))

    return _union([one(n, df, k) for n, (df, k) in tables.items()])


def merge_source_duplicates(spark: SparkSession, d: str) -> DataFrame:
    """Keys a merge would meet twice if the items were not reduced to their newest image."""
    return duplicate_keys(Layers(spark, d).tagged("order_items").select("order_item_id"), "order_item_id")


def gold_views(spark: SparkSession, d: str) -> DataFrame:
    """Row counts read through the published views."""
    layers = stored_for(spark, d, *READS)
    tables = {s.name: layers.dim(s) for s in (DIM_CUSTOMERS, DIM_PRODUCTS)}
    tables |= {name: layers.fact(name) for name in FACTS}
    views = publish_views(tables, role="ANALYST")
    return _union([
        df.agg(F.count(F.lit(1)).alias("n")).withColumn("view_name", F.lit(v)) for v, df in views.items()
    ])


def masked_customers(spark: SparkSession, d: str) -> DataFrame:
    """Silver customers as an analyst and as the loading role see them."""
    customers = Layers(spark, d).silver("customers").select("customer_id", "email", "phone", "last_name")
    return _union([
        mask_columns(customers, role).withColumn("role_name", F.lit(role))
        for role in ("ANALYST", "ETL_ROLE")
    ])


def kpi_revenue_by_month(spark: SparkSession, d: str) -> DataFrame:
    layers = stored_for(spark, d, "fact_sales")
    return revenue_by_month(layers.fact("fact_sales"), layers.dim(DIM_PRODUCTS))


def kpi_shipping(spark: SparkSession, d: str) -> DataFrame:
    return shipping_by_carrier(stored_for(spark, d, "fact_shipments").fact("fact_shipments"))


def kpi_orders_by_status(spark: SparkSession, d: str) -> DataFrame:
    return orders_by_status(stored_for(spark, d, "fact_orders").fact("fact_orders"))


def all_queries() -> dict[str, Query]:
    found: dict[str, Query] = {
        "bronze_scan": loads.bronze_scan,
        "bronze_scan_array": loads.bronze_scan_array,
        "bronze_bad_records": loads.bronze_bad_records,
        "bronze_incremental": loads.bronze_incremental,
        "bronze_config_active": bronze_config_active,
        "bronze_file_manifest": bronze_file_manifest,
    }
    for e in ENTITIES:
        found[f"silver_{e}_typed"] = silver_typed(e)
        found[f"dq_{e}"] = dq(e)
        found[f"dedup_{e}"] = dedup(e)
        found[f"silver_merge_{e}"] = silver_merge(e)
    found |= {
        "dq_undecided": dq_undecided,
        "dq_json_null_vs_missing": dq_json_null_vs_missing,
        "dq_orphans": dq_orphans,
        "dq_payments_negative": dq_payments_negative,
        "dim_date": dim_date_days,
        "unknown_members": unknown_members,
        "dim_products_new": dim_state(DIM_PRODUCTS, NEW),
        "dim_products_changed": dim_state(DIM_PRODUCTS, CHANGED),
        "dim_customers_new": dim_state(DIM_CUSTOMERS, NEW),
        "dim_customers_changed": dim_state(DIM_CUSTOMERS, CHANGED),
        "dim_customers_source": dim_customers_source,
        "changed_customer_ids": changed_ids,
        "scd2_source_literal": scd2_source_literal,
        "scd2_products": scd2(DIM_PRODUCTS, "versioned"),
        "scd2_products_close_only": scd2(DIM_PRODUCTS, "close_only"),
        "scd2_customers": scd2(DIM_CUSTOMERS, "versioned"),
        "scd2_customers_close_only": scd2(DIM_CUSTOMERS, "close_only"),
        "pit_lookup": pit,
        **{name: fact(name) for name in FACTS},
        "surrogate_keys": surrogate_keys,
        "merge_source_duplicates": merge_source_duplicates,
        "gold_views": gold_views,
        "masked_customers": masked_customers,
        "kpi_revenue_by_month": kpi_revenue_by_month,
        "kpi_shipping": kpi_shipping,
        "kpi_orders_by_status": kpi_orders_by_status,
        "audit_counts": loads.audit_counts,
        "incremental_moved_addresses": loads.moved_addresses,
        "scd2_products_late": loads.late_products,
        "change_feed_net": loads.change_feed_net,
        "stream_silver_orders": loads.stream_silver_orders,
        "stream_retry_idempotent": loads.stream_retry_idempotent,
        "medallion_end_to_end": loads.medallion_end_to_end,
        **histories.QUERIES,
        **reloads.QUERIES,
    }
    return {name: _presented(q) for name, q in found.items()}


def _presented(query: Query) -> Query:
    return lambda spark, d: present(query(spark, d))

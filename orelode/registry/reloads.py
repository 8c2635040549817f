"""Queries over files loaded by their content, keys without gaps and views that look at the session's role."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orelode.plans.policies import policy_view, set_role
from orelode.registry.layers import Layers
from orelode.registry.loads import BATCHES, _bronze_batch, _land
from orelode.sources.feeds import LOAD_TS
from orelode.sources.paths import scratch_dir
from orelode.specs import FACTS, ORDERS
from orelode.streaming.medallion import Medallion, Options


def _replace(spark: SparkSession, folder: str, by: str) -> None:
    """The files of ``by`` take the places and names of those of ``folder``; what is over keeps its name."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(of: str) -> list[str]:
        return sorted(n for n in (s.getPath().getName() for s in fs.listStatus(path(of))) if n.startswith("part-"))

    old = names(folder)
    for i, name in enumerate(names(by)):
        target = path(f"{folder}/{old[i] if i < len(old) else name}")
        fs.delete(target, False)
        fs.rename(path(f"{by}/{name}"), target)


def bronze_reload_changed(spark: SparkSession, d: str) -> DataFrame:
    """Files replaced under their names load again, as they are then; the third load finds nothing."""
    m = Medallion(spark, scratch_dir(spark, "reload"), options=Options(load_history=True, max_files=3))
    _land(spark, d, "orders", 1, m.landing)
    m.load_bronze("run-1", LOAD_TS[1])
    aside = scratch_dir(spark, "reload-second")
    _land(spark, d, "orders", 2, aside)
    _replace(spark, f"{m.landing}/{ORDERS.path}", f"{aside}/{ORDERS.path}")
    m.load_bronze("run-2", LOAD_TS[2])
    m.load_bronze("run-3", "2001-01-01 00:00:00")
    order = F.expr("variant_get(payload, '$.order_id', 'bigint')")
    return m.bronze("orders").groupBy("ingestion_ts").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(order).alias("orders")
    )


def surrogate_keys_dense(spark: SparkSession, d: str) -> DataFrame:
    """The order fact after two loads that number new orders only, without gaps."""
    m = Medallion(spark, scratch_dir(spark, "dense"), options=Options(dense_keys=True))
    spec = FACTS["fact_orders"]
    for batch in BATCHES:
        _bronze_batch(spark, d, m, spec.entity, batch)
        m.load_entity(spec.entity, f"run-{batch}", LOAD_TS[batch])
        m.load_fact(spec.name, f"run-{batch}", LOAD_TS[batch])
    return m.gold(spec.name).state().select(spec.surrogate, spec.key, "order_status")


def masked_by_session_role(spark: SparkSession, d: str) -> DataFrame:
    """One view of silver customers, read by the session in one role and then in another."""
    customers = Layers(spark, d).silver("customers").select("customer_id", "email", "phone", "last_name")
    view, parts = policy_view(customers, "customers_by_role"), []
    try:
        for role in ("ANALYST", "ETL_ROLE"):
            set_role(spark, role)
            parts.append(spark.table(view).withColumn("role_name", F.lit(role)))
    finally:
        set_role(spark, None)
    return reduce(DataFrame.unionByName, parts)


QUERIES = {f.__name__: f for f in (bronze_reload_changed, surrogate_keys_dense, masked_by_session_role)}

"""Queries over tables laid out by buckets, change images, waiting rows and long histories."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orelode.operators.changes import BATCH
from orelode.operators.images import AFTER, BEFORE, apply_images, merge_images, net_images
from orelode.operators.lookup import history_lookup
from orelode.operators.merge import ACTION
from orelode.plans.marts import ORDER_STATUS
from orelode.registry.layers import Layers
from orelode.registry.loads import BATCHES, FILE_KEYS, _bronze_batch, _silver_batches
from orelode.sources.bronze import read_raw
from orelode.sources.feeds import LOAD_TS, json_feed
from orelode.sources.paths import compact_write, materialise, scratch_dir
from orelode.specs import ORDERS
from orelode.streaming.medallion import Medallion, Options


def merge_pruned_buckets(spark: SparkSession, d: str) -> DataFrame:
    """Silver orders after two batches, the table laid out by key buckets, with a snapshot per batch."""
    return _silver_batches(spark, d, "buckets", retry=False, options=Options(buckets=16, snapshot_every=1))


def bronze_scan_split_array(spark: SparkSession, d: str) -> DataFrame:
    """Orders as arrays on one line, read in splits smaller than the files; one record in fifty is broken.

    Texts hold quotes, braces and brackets, and each record an object of its own.
    """
    landing = scratch_dir(spark, "split")
    key = F.get_json_object("value", "$.order_id").cast("bigint")
    note = F.lit(r', "note": "a \"quoted\" } brace { \\", "inner": {"list": [{"x": 1}, {}]}}')
    record = json_feed(spark, d, "orders").select(key.alias("order_id"), "value")
    record = record.select(
        F.floor(F.col("order_id") / FILE_KEYS).alias("part"),
        F.when(F.col("order_id") % 50 == 0, F.regexp_replace("value", ":", ";"))
        .otherwise(F.concat(F.expr("substring(value, 1, length(value) - 1)"), note)).alias("value"),
    )
    one = record.groupBy("part").agg(F.array_join(F.collect_list("value"), ",").alias("value"))
    one = one.select(F.concat(F.lit("["), "value", F.lit("]")).alias("value"))
    one.write.option("maxRecordsPerFile", 1).option("lineSep", "\n").text(landing)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(64 * 1024))
    try:
        raw = materialise(read_raw(spark, landing).select("payload"), "split-records")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    return raw.select(
        F.expr("variant_get(payload, '$.order_id', 'bigint')").alias("order_id"),
        F.expr("variant_get(payload, '$.order_status', 'string')").alias("order_status"),
        F.expr("variant_get(payload, '$.order_total_amount', 'string')").alias("order_total_amount"),
        F.expr("variant_get(payload, '$.note', 'string')").alias("note"),
    )


def _three_batches(spark: SparkSession, d: str) -> list[DataFrame]:
    """The images of three batches of orders; the third takes some back as they were and deletes some."""
    layers = Layers(spark, d, store=True)
    first, key = layers.silver("orders", 1).drop(ACTION), ORDERS.key
    none = materialise(merge_images(first.limit(0), first, key), "images-1")
    second = materialise(merge_images(first, layers.changes("orders", 2).drop(ACTION), key), "images-2")
    state = materialise(apply_images(first, second, key), "state-2")
    back = first.where(F.col(key) % 14 == 0)
    gone = state.where((F.col(key) % 15 == 0) | (F.col(key) % 97 == 0)).select(key)
    third = materialise(merge_images(state, back, key, gone), "images-3")
    return [images.withColumn(BATCH, F.lit(n)) for n, images in enumerate((none, second, third), 1)]


def change_feed_images(spark: SparkSession, d: str) -> DataFrame:
    """What the second and third batch come to together: what went back or came and went has no row."""
    _, second, third = _three_batches(spark, d)
    net = net_images(second.unionByName(third), ORDERS.key, ("order_status", "order_total_amount", "currency"))
    shown = [
        F.col(f"{side}.{c}").alias(f"{side}_{c}") for side in (BEFORE, AFTER) for c in ("order_status", "order_total_amount")
    ]
    return net.select("order_id", ACTION, *shown)


def kpi_incremental(spark: SparkSession, d: str) -> DataFrame:
    """Orders by status after each of three batches, kept up from the images of each."""
    mart, out = None, []
    for n, images in enumerate(_three_batches(spark, d), 1):
        delta = materialise(ORDER_STATUS.delta(images), f"delta-{n}")
        mart = delta if mart is None else materialise(ORDER_STATUS.apply(mart, delta), f"mart-{n}")
        out.append(ORDER_STATUS.values(mart).withColumn("batch", F.lit(n)))
    return reduce(DataFrame.unionByName, out)


def dq_orphans_redrive(spark: SparkSession, d: str) -> DataFrame:
    """Order items and their first load after which they are in silver; NULL: they still wait.

    Items come at once; of the orders, those with an even key come a load later.
    """
    m = Medallion(spark, scratch_dir(spark, "orphans"), options=Options(hold_orphans=True, buckets=16))
    feed = scratch_dir(spark, "orphans-feed")
    staged = Medallion(spark, feed)
    for batch in BATCHES:
        _bronze_batch(spark, d, staged, "orders", batch)
    orders = staged.bronze("orders").where("ingestion_ts = timestamp_ntz '%s'" % LOAD_TS[1])
    even = F.expr("variant_get(payload, '$.order_id', 'bigint')") % 2 == 0
    for n, part in enumerate((orders.where(~even), orders.where(even))):
        compact_write(part).parquet(f"{m.bronze_path('orders')}/{BATCH}={n}")
        if n == 0:
            _bronze_batch(spark, d, m, "order_items", 1)
        for entity in ("orders", "order_items"):
            m.load_entity(entity, f"run-{n}", LOAD_TS[n + 1])
    items = m.silver("order_items").state().select(
        "order_item_id", "order_id", (F.when(F.col("ingestion_ts") == F.lit(LOAD_TS[1]).cast("timestamp_ntz"), 1).otherwise(2)).alias("load")
    )
    held = m.waiting("order_items").select("order_item_id", "order_id", F.lit(None).cast("int").alias("load"))
    return items.unionByName(held)


def pit_lookup_long_history(spark: SparkSession, d: str) -> DataFrame:
    """Each delivery against its supplier's last price before, where a supplier has hundreds of prices."""
    lines = spark.read.parquet(f"{d}/lineitem.parquet")
    prices = lines.select(
        F.col("l_suppkey").alias("supplier"), F.col("l_shipdate").alias("since"),
        F.col("l_extendedprice").alias("price"), F.col("l_orderkey").alias("price_order"),
    )
    facts = lines.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"),
        F.when(F.col("l_linenumber") != 7, F.col("l_suppkey")).alias("supplier"), F.expr("timestampadd(DAY, l_linenumber - 4, l_shipdate)").alias("at"),
    )
    return history_lookup(facts, prices, "supplier", "at", "since", ("price", "price_order"))


QUERIES = {
    f.__name__: f
    for f in (
        merge_pruned_buckets, bronze_scan_split_array, change_feed_images, kpi_incremental, dq_orphans_redrive,
        pit_lookup_long_history,
    )
}

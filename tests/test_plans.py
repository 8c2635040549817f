"""Plans that must hold at scale: no nested loops, no single-partition steps, pruned scans."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from orelode.operators.changes import BATCH, net_changes
from orelode.operators.keys import KEY_BLOCK, assign_keys
from orelode.operators.lookup import pit_lookup
from orelode.operators.merge import ACTION, MergeRule, merge_apply, merge_changes
from orelode.operators.scd2 import scd2_apply, scd2_changes
from orelode.plans.gold import fact_source, product_source
from orelode.plans.silver import silver_source, tag
from orelode.registry.layers import Layers, ts
from orelode.sources.feeds import typed_feed
from orelode.sources.tables import ChangeTable
from orelode.specs import DIM_CUSTOMERS, DIM_PRODUCTS, ENTITIES, FACTS


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def check(text: str) -> None:
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "Exchange SinglePartition"):
        assert bad not in text, f"{bad} in plan"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Stored tables of every schema, so that plans show plain scans."""
    root = tmp_path_factory.mktemp("tables")
    out = {}
    for spec in (*ENTITIES.values(), DIM_PRODUCTS, DIM_CUSTOMERS, *FACTS.values()):
        path = str(root / spec.name)
        spark.createDataFrame([], spec.schema).write.parquet(path)
        out[spec.name] = spark.read.schema(spec.schema).parquet(path)
    return out


@pytest.mark.parametrize("entity", ENTITIES)
def test_dedup_trims_keys_before_the_shuffle(spark, sf_dir, entity):
    text = plan(Layers(spark, sf_dir).source(entity, 1))
    check(text)
    final, partial = text.index("WindowGroupLimit"), text.rindex("WindowGroupLimit")
    assert final < text.index("Exchange hashpartitioning", final) < partial


@pytest.mark.parametrize("entity", ENTITIES)
def test_merges_shuffle_each_side_once(spark, tables, entity):
    spec, rule = ENTITIES[entity], MergeRule.for_entity(ENTITIES[entity])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (
            merge_apply(tables[entity], tables[entity], rule, ts(1)),
            merge_changes(tables[entity], tables[entity], rule, ts(1)),
        ):
            text = plan(df)
            check(text)
            assert text.count("Exchange hashpartitioning") <= 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", [f for f in FACTS if f != "fact_order_status_history"])
@pytest.mark.parametrize("broadcast", [True, False])
def test_facts_join_on_keys(spark, tables, name, broadcast):
    spec = FACTS[name]
    if not broadcast:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = fact_source(
            name, tables[spec.entity], tables["orders"], tables["dim_products"], tables["dim_customers"]
        )
        keyed = assign_keys(rows, spec.surrogate, spec.key, 1, 8)
        text = plan(merge_changes(tables[name], keyed, MergeRule.for_fact(spec), ts(1)))
        check(text)
        assert ("BroadcastHashJoin" in text) == broadcast
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_dimension_loads(spark, tables):
    source = product_source(tables["products"])
    for mode in ("versioned", "close_only"):
        check(plan(scd2_apply(tables["dim_products"], source, DIM_PRODUCTS, 1, 8, mode)))
        check(plan(scd2_changes(tables["dim_products"], source, DIM_PRODUCTS, 1, 8, mode)))


def test_many_keys_are_not_broadcast_for_the_size_of_their_files(spark, tmp_path):
    """Files of few values weigh a hundredth of their rows: then the rows decide what may go to the driver."""
    table = ChangeTable(spark, str(tmp_path), "k bigint, v string", "k")
    rows = spark.range(400_000).select(F.col("id").alias("k"), F.lit("v").alias("v"), F.lit("insert").alias(ACTION))
    for n in (0, 1):
        table.write_changes(rows, n)
    keys = table.feed([1]).select("k")
    assert "Broadcast" not in plan(table.state(1, keys)) and "Broadcast" not in plan(table.state())
    assert "BroadcastHashJoin" in plan(table.state(1, keys.where("k < 5")))
    assert table.state(1, keys).count() == table.state().count() == 400_000


def test_lookup_reads_four_dimension_columns(spark, tables):
    text = plan(pit_lookup(tables["orders"], tables["dim_customers"], DIM_CUSTOMERS, "customer_id", "created_at"))
    schema = next(p for p in text.split("ReadSchema: ")[1:] if "valid_from" in p)
    assert "email" not in schema.split(">")[0] and "hash_value" not in schema.split(">")[0]


def test_net_changes_trims_before_the_shuffle(spark, tables):
    text = plan(net_changes(tables["orders"].withColumn(BATCH, F.col("customer_id")), "order_id"))
    check(text)
    assert text.count("WindowGroupLimit") == 2


def test_feeds_scan_each_table_once(spark, sf_dir):
    text = plan(typed_feed(spark, sf_dir, "orders"))
    assert text.count("FileScan") == 1
    assert "o_orderpriority" not in text


def test_hot_key_reaches_the_shuffle_once_per_task(spark, bronze):
    """A key holding nearly all rows leaves each task as one row."""
    record = {"order_id": 1, "customer_id": 1, "order_status": "A", "created_at": "2020-01-01 00:00:00",
              "order_total_amount": "1"}
    rows = bronze([record | {"updated_at": f"2020-01-01 00:{i // 60:02d}:{i % 60:02d}"} for i in range(600)])
    source = silver_source(tag(rows.repartition(6), ENTITIES["orders"]), ENTITIES["orders"])
    assert source.count() == 1
    assert source.first().updated_at.minute == 9


@pytest.mark.parametrize("stride", [1, 10, 64, 4096])
def test_surrogate_keys_are_unique_and_grow(spark, stride):
    """Strided keys spread over the buckets; a recomputation gives the same keys."""
    df = spark.range(5000).select((F.col("id") * stride).alias("k"))
    keyed = assign_keys(df, "sk", "k", 2, 16)
    assert keyed.select("sk").distinct().count() == 5000
    low, high = keyed.agg(F.min("sk"), F.max("sk")).first()
    assert 2 * KEY_BLOCK < low and high < 2 * KEY_BLOCK + 16 * 5000
    sizes = [r[1] for r in keyed.groupBy(F.col("sk") % 16).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * min(sizes)
    again = assign_keys(df.repartition(3), "sk", "k", 2, 16)
    assert keyed.exceptAll(again).isEmpty()


def test_hot_lookup_key_is_split(spark, tmp_path):
    """A third of the facts on one key: the join splits its partition, and loses or adds nothing."""
    confs = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50000",
    }
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 997).cast("bigint")
    facts = spark.range(0, 300000, 1, 8).select(
        key.alias("product_id"), F.col("id").alias("line"),
        F.lit("2020-06-01 00:00:00").cast("timestamp_ntz").alias("ts"),
    )
    dim = spark.range(997).select(
        (F.col("id") + 1).alias("product_key"), F.col("id").alias("product_id"),
        F.lit("2020-01-01 00:00:00").cast("timestamp_ntz").alias("valid_from"),
        F.lit("9999-12-31 00:00:00").cast("timestamp_ntz").alias("valid_to"),
    )
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        found = pit_lookup(facts, dim, DIM_PRODUCTS, "product_id", "ts")
        out = str(tmp_path / "out")
        found.write.parquet(out)
        found.collect()
        assert "skew=true" in plan(found)
        wrong = spark.read.parquet(out).where("product_key <> product_id + 1")
        assert wrong.isEmpty() and spark.read.parquet(out).count() == 300000
    finally:
        for k in confs:
            spark.conf.unset(k)


def test_dedup_moves_only_what_is_read(spark, sf_dir):
    """What orders equal rows after the last column read neither sorts nor is shuffled; the result is the same."""
    layers = Layers(spark, sf_dir, columns={"order_items": ("order_item_id", "order_id", "product_id")})
    narrow = layers.source("order_items", 1)
    exchanged = plan(narrow).split("Exchange hashpartitioning")[1]
    assert "sha2" not in exchanged and "unit_price#" not in plan(narrow).split("Exchange hashpartitioning")[0]
    whole = Layers(spark, sf_dir).source("order_items", 1).select(*narrow.columns)
    assert narrow.exceptAll(whole).isEmpty() and whole.exceptAll(narrow).isEmpty()


def test_dedup_shuffles_hashes_as_bytes(spark, sf_dir):
    source = Layers(spark, sf_dir).source("orders", 1)
    assert "unhex" in plan(source).split("Exchange hashpartitioning")[1]
    assert source.where("hash_value rlike '^[0-9a-f]{64}$'").count() == source.count()

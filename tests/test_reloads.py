"""Files loaded by content, keys without gaps, masking by the session's role."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from orelode.operators.changes import BATCH
from orelode.operators.dense import dense_keys
from orelode.plans.policies import policy_view, set_role
from orelode.sources.history import HISTORY_SCHEMA, present_files, unloaded_files
from orelode.sources.paths import remove
from orelode.specs import FACTS, INGESTION, MASKED_TEXT
from orelode.streaming.medallion import AmbiguousSource, Medallion, Options

T = "2020-01-01 00:00:00"
ORDERS_IN = tuple(i for i in INGESTION if i.entity == "orders")


def test_dense_keys_have_no_gaps_and_follow_the_key(spark):
    keys = [(k, f"v{k}") for k in range(500, 0, -1)] + [(None, "n")] * 3 + [(7, "again")]
    df = spark.createDataFrame(keys, "k long, v string").repartition(7)
    out = dense_keys(df, "sk", "k", after=10)
    assert out.columns == ["k", "v", "sk"]
    found = sorted(out.collect(), key=lambda r: r.sk)
    assert [r.sk for r in found] == list(range(11, 11 + len(keys)))
    assert [r.k for r in found] == [None] * 3 + sorted(k for k, _ in keys if k is not None)
    assert sorted(r.v for r in found) == sorted(v for _, v in keys)
    assert dense_keys(df.limit(0), "sk", "k").count() == 0


def test_dense_keys_replace_a_column_and_spread_one_hot_key(spark):
    df = spark.range(2000).select(F.lit(1).alias("k"), F.col("id").alias("v"), F.lit(-1).cast("long").alias("sk"))
    out = dense_keys(df.repartition(4), "sk", "k")
    assert out.columns == ["k", "v", "sk"]
    assert sorted(r.sk for r in out.collect()) == list(range(1, 2001))


def test_dense_keys_use_no_window(spark):
    plan = dense_keys(spark.range(10), "sk", "id")._jdf.queryExecution().toString()
    assert "Window" not in plan


def _orders(spark, m, batch, ids):
    text = [
        f'{{"order_id": {i}, "customer_id": 1, "order_status": "S{batch}", "order_total_amount": "1.00", "currency": "EUR", '
        f'"created_at": "2020-01-0{batch} 00:00:00", "updated_at": "2020-01-0{batch} 00:00:00"}}'
        for i in ids
    ]
    df = spark.createDataFrame([(t,) for t in text], "value string")
    df.select(
        F.parse_json("value").alias("payload"), F.lit(T).cast("timestamp_ntz").alias("ingestion_ts"),
        F.lit("f").alias("source_file"),
    ).write.parquet(f"{m.bronze_path('orders')}/{BATCH}={batch - 1}")


def test_facts_number_new_orders_only(spark, tmp_path):
    m = Medallion(spark, str(tmp_path / "m"), options=Options(dense_keys=True))
    for batch, ids in ((1, [30, 10, 20]), (2, [20, 5, 40])):
        _orders(spark, m, batch, ids)
        m.load_entity("orders", f"run-{batch}", T)
        m.load_fact("fact_orders", f"run-{batch}", T)
    rows = m.gold("fact_orders").state().select("order_id", "fact_order_key", "order_status").collect()
    assert {r[0]: (r[1], r[2]) for r in rows} == {
        10: (1, "S1"), 20: (2, "S2"), 30: (3, "S1"), 5: (4, "S2"), 40: (5, "S2"),
    }


def test_a_key_twice_in_a_fact_source_stops_dense_numbering(spark, tmp_path):
    m = Medallion(spark, str(tmp_path / "m"), options=Options(dense_keys=True))
    spec = FACTS["fact_orders"]
    changes = spark.createDataFrame([(1, "insert"), (1, "insert")], f"{spec.key} long, _action string")
    with pytest.raises(AmbiguousSource, match="order_id 1"):
        m._numbered(changes.withColumn(spec.surrogate, F.lit(None).cast("long")), spec, 0)


def _write(path, *lines, at):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(f"{line}\n" for line in lines))
    os.utime(path, (at, at))


def test_a_file_replaced_under_its_name_loads_again(spark, tmp_path):
    m = Medallion(spark, str(tmp_path / "m"), ingestion=ORDERS_IN, options=Options(load_history=True, max_files=1))
    folder = tmp_path / "m" / "landing" / ORDERS_IN[0].path
    _write(folder / "a.json", '{"order_id": 1}', at=1_600_000_000)
    _write(folder / "b.json", '{"order_id": 2}', at=1_600_000_000)

    def loaded(run):
        m.load_bronze(run, T)
        return sorted(r[0] for r in m.bronze("orders").selectExpr("variant_get(payload, '$.order_id', 'bigint')").collect())

    assert loaded("run-1") == [1, 2]
    assert loaded("run-2") == [1, 2]
    # Of the same length, and then of the same time: either tells.
    _write(folder / "a.json", '{"order_id": 3}', at=1_600_000_001)
    assert loaded("run-3") == [1, 2, 3]
    _write(folder / "b.json", '{"order_id": 44}', at=1_600_000_000)
    assert loaded("run-4") == [1, 2, 3, 44]
    assert m.loaded_files("orders").count() == 4


def test_a_load_that_died_before_its_history_is_done_again_once(spark, tmp_path):
    m = Medallion(spark, str(tmp_path / "m"), ingestion=ORDERS_IN, options=Options(load_history=True))
    _write(tmp_path / "m" / "landing" / ORDERS_IN[0].path / "a.json", '{"order_id": 1}', at=1_600_000_000)
    m.load_bronze("run-1", T)
    remove(spark, f"{m.root}/common/load_history/orders/{BATCH}=0")
    m.load_bronze("run-2", T)
    assert m.bronze("orders").count() == 1
    assert m.loaded_files("orders").count() == 1


def test_listing_opens_no_file_and_takes_the_oldest(spark, tmp_path):
    for n, name in enumerate("cab"):
        _write(tmp_path / f"{name}.json", "x", at=1_600_000_000 + n)
    none = spark.createDataFrame([], HISTORY_SCHEMA)
    files = unloaded_files(spark, str(tmp_path), none, 2)
    assert [r.path[-6:] for r in files.collect()] == ["c.json", "a.json"]
    plan = present_files(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_one_view_shows_what_the_role_of_the_session_may_see(spark):
    df = spark.createDataFrame([(1, "a@example.com"), (2, None)], "id long, email string")
    view = policy_view(df, "people by role")

    def seen():
        return {r.id: r.email for r in spark.table(f"`{view}`").collect()}

    masked = {1: MASKED_TEXT, 2: MASKED_TEXT}
    try:
        assert seen() == masked
        set_role(spark, "ETL_ROLE")
        assert seen() == {1: "a@example.com", 2: None}
        set_role(spark, "it's")
        assert seen() == masked
        # Published again, the role stays.
        set_role(spark, "ETL_ROLE")
        policy_view(df, view)
        assert seen()[1] == "a@example.com"
        policy_view(df, view, allowed=())
        assert seen() == masked
    finally:
        set_role(spark, None)

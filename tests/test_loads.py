"""Incremental loads over files: idempotence, bad input, layouts, failures, compaction."""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from orelode.operators.changes import BATCH
from orelode.plans.audit import Step
from orelode.sources.bronze import bad_records, bronze_rows, read_raw
from orelode.sources.tables import ChangeTable
from orelode.specs import (
    ADDRESSES, CUSTOMERS, DIM_CUSTOMERS, DIM_PRODUCTS, INGESTION, ORDERS, PRODUCTS, IngestEntry,
)
from orelode.streaming.medallion import Medallion, Options

T = "2020-01-01 00:00:00"
ONLY_ORDERS = tuple(i for i in INGESTION if i.entity == "orders")


def order(i, **kw):
    return {
        "order_id": i, "customer_id": 7, "order_status": "PAID", "order_total_amount": "10.00",
        "currency": "EUR", "created_at": T, "updated_at": T,
    } | kw


def land(root, entity, name, records, array=False):
    folder = root / "landing" / f"{entity}_raw"
    folder.mkdir(parents=True, exist_ok=True)
    lines = [r if isinstance(r, str) else json.dumps(r) for r in records]
    text = f"[{','.join(lines)}]" if array else "\n".join(lines)
    (folder / name).write_text(text)


def test_bad_lines_are_counted_and_skipped(spark, tmp_path, at):
    land(tmp_path, "orders", "a.json", [order(1), '{"order_id": 2', "", order(3)])
    raw = read_raw(spark, str(tmp_path / "landing" / "orders_raw"))
    assert bronze_rows(raw, at(T)).count() == 2
    assert [r.bad_records for r in bad_records(raw).collect()] == [1]


def test_array_files_lose_their_outer_array(spark, tmp_path, at):
    land(tmp_path, "orders", "a.json", [order(1), order(2)], array=True)
    land(tmp_path, "orders", "b.json", [order(3)])
    land(tmp_path, "orders", "c.json", ["oops"], array=True)
    raw = read_raw(spark, str(tmp_path / "landing" / "orders_raw"), layout="array")
    good = bronze_rows(raw, at(T))
    ids = good.select(F.expr("variant_get(payload, '$.order_id', 'int')").alias("i")).collect()
    assert sorted(r.i for r in ids) == [1, 2, 3]
    assert bad_records(raw).count() == 1


def test_bronze_sees_each_file_once(spark, tmp_path):
    m = Medallion(spark, str(tmp_path), ingestion=ONLY_ORDERS)
    land(tmp_path, "orders", "a.json", [order(1), "broken", order(2)])
    m.load_bronze("r1", T)
    m.load_bronze("r2", T)
    assert m.bronze("orders").count() == 2
    land(tmp_path, "orders", "b.json", [order(3)])
    m.load_bronze("r3", T)
    assert m.bronze("orders").count() == 3
    files = {r.source_file.rsplit("/", 1)[1]: r.rows_loaded for r in m.manifest("orders").collect()}
    assert files == {"a.json": 2, "b.json": 1}
    log = m.audit().where("process_name = 'LOAD_BRONZE' AND status = 'SUCCESS'").orderBy("created_at").collect()
    assert [r.rows_affected for r in log] == [2, 0, 1]
    info = json.loads(log[0].additional_info)
    assert info["load_strategy"] == "INGEST_COPY" and info["bad_records"] == 1
    assert info["processed_files"] == 1 and info["manifest"].endswith("manifest/orders")


def test_inactive_entries_are_left_alone(spark, tmp_path):
    m = Medallion(spark, str(tmp_path), ingestion=(IngestEntry("orders", "orders_raw/", is_active=False),))
    land(tmp_path, "orders", "a.json", [order(1)])
    m.load_bronze("r1", T)
    assert m.bronze("orders").count() == 0


def snapshot_of(df):
    return sorted(map(str, df.collect()))


def test_running_a_silver_batch_again_changes_nothing(spark, tmp_path):
    m = Medallion(spark, str(tmp_path), ingestion=ONLY_ORDERS, options=Options(snapshot_every=2))
    write = m.silver_batch(ORDERS, Step(), "r", T)
    rows = [
        [order(1), order(2, order_total_amount="-1"), order(None)],
        [order(1, order_status="SHIPPED"), order(3), order(None)],
        [order(3, order_status="LOST"), order(4)],
        [order(1, order_status="DONE")],
    ]

    def batch(n):
        lines = spark.createDataFrame([(json.dumps(r),) for r in rows[n]], "value string")
        return lines.select(
            F.parse_json("value").alias("payload"), F.lit(T).cast("timestamp_ntz").alias("ingestion_ts"),
            F.lit("f").alias("source_file"),
        )

    table = m.silver("orders")
    for n in range(len(rows)):
        write(batch(n), n)
        once, feed = snapshot_of(table.state()), snapshot_of(table.feed([n]))
        write(batch(n), n)
        assert snapshot_of(table.state()) == once
        assert snapshot_of(table.feed([n])) == feed
    got = {(r.order_id, r.order_status) for r in table.state().collect() if r.order_id}
    assert got == {(1, "DONE"), (3, "LOST"), (4, "PAID")}
    # a NULL key never matches, so every batch that holds one adds one
    assert table.state().where("order_id IS NULL").count() == 2
    assert table._snapshots() == [1]
    assert m.dq_errors("orders").count() == 1


def test_micro_batches_reach_the_state_of_one_batch(spark, tmp_path):
    images = [
        order(i, order_status=s, updated_at=f"2020-01-0{d} 00:00:00")
        for i in range(20) for d, s in ((1, "CREATED"), (2, "PAID"), (3, "SHIPPED"))
    ]
    states = []
    for k, name in ((1, "one"), (3, "many")):
        root = tmp_path / name
        m = Medallion(spark, str(root), ingestion=ONLY_ORDERS)
        size = len(images) // k
        by_day = sorted(images, key=lambda r: r["updated_at"])
        for n in range(k):
            land(root, "orders", f"{n}.json", by_day[n * size:(n + 1) * size])
            m.load_bronze(f"r{n}", T)
            m.load_silver(f"r{n}", T)
        cols = [c for c in ORDERS.columns if c != "source_file"]
        states.append(snapshot_of(m.silver("orders").state().select(*cols)))
    assert states[0] == states[1] and len(states[0]) == 20


def test_failure_is_logged_and_raised(spark, tmp_path):
    m = Medallion(spark, str(tmp_path), ingestion=ONLY_ORDERS)
    land(tmp_path, "orders", "a.json", [order(1, order_total_amount="abc")])
    m.load_bronze("r1", T)
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
        m.load_silver("r1", T)
    fails = m.audit().where("status = 'FAIL'").orderBy("created_at").collect()
    assert [r.process_name for r in fails] == ["ORDERS", "MASTER"]
    assert m.silver("orders").state().count() == 0


def test_star_schema_from_files(spark, tmp_path):
    """Two runs: a price and an address change between orders, then the invariants."""
    m = Medallion(spark, str(tmp_path))
    T1, T2 = "2020-01-01 00:00:00", "2021-01-01 00:00:00"
    product = {"product_id": 1, "name": "Lamp", "price": "5.00", "currency": "EUR", "created_at": T1, "updated_at": T1}
    customer = {"customer_id": 7, "email": "a@b", "first_name": "A", "phone": "1", "created_at": T1, "updated_at": T1}
    address = {"address_id": 1, "customer_id": 7, "street": "s", "city": "Rome", "country": "IT",
               "is_default": True, "created_at": T1, "updated_at": T1}
    land(tmp_path, "products", "1.json", [product])
    land(tmp_path, "customers", "1.json", [customer])
    land(tmp_path, "addresses", "1.json", [address])
    land(tmp_path, "orders", "1.json", [order(1, created_at="2020-05-01 00:00:00")])
    item = {"order_item_id": 11, "order_id": 1, "product_id": 1, "quantity": 2, "unit_price": "5.00",
            "created_at": "2020-05-01 00:00:00"}
    land(tmp_path, "order_items", "1.json", [item])
    m.run("r1", T1)
    land(tmp_path, "products", "2.json", [product | {"price": "6.00", "updated_at": T2}])
    land(tmp_path, "addresses", "2.json", [address | {"city": "Oslo", "country": "NO", "updated_at": T2}])
    land(tmp_path, "orders", "2.json", [order(2, created_at="2021-05-01 00:00:00")])
    land(tmp_path, "order_items", "2.json", [
        item | {"order_item_id": 21, "order_id": 2, "created_at": "2021-05-01 00:00:00"},
        item | {"order_item_id": 22, "order_id": 99, "created_at": "2019-05-01 00:00:00"},
    ])
    m.run("r2", T2)

    products, customers = m.gold("dim_products").state(), m.gold("dim_customers").state()
    sales = m.gold("fact_sales").state()
    assert products.count() == 3 and customers.count() == 3
    for dim, key in ((products, "product_id"), (customers, "customer_id")):
        assert dim.where("is_current").groupBy(key).count().where("count > 1").isEmpty()
    by_item = {
        r.order_item_id: (r.price, r.city, r.total_line_amount)
        for r in sales.join(products.select("product_key", "price"), "product_key")
        .join(customers.select("customer_key", "city"), "customer_key").collect()
    }
    assert {k: (float(p), c, float(a)) for k, (p, c, a) in by_item.items()} == {
        11: (5.0, "Rome", 10.0), 21: (6.0, "Oslo", 10.0), 22: (0.0, "Unknown", 10.0),
    }
    assert sales.select("sales_key").distinct().count() == 3
    for dim, spec in ((products, DIM_PRODUCTS), (customers, DIM_CUSTOMERS)):
        assert sales.join(dim, spec.surrogate, "left_anti").isEmpty()
        after = F.lead("valid_from").over(Window.partitionBy(spec.natural_key).orderBy("valid_from"))
        assert dim.withColumn("after", after).where("after < valid_to").isEmpty()
    # a run without news writes nothing
    before = m.audit().count()
    m.run("r3", T2)
    assert m.audit().count() > before
    assert m.audit().where("pipeline_run_id = 'r3'").agg(F.sum("rows_affected")).first()[0] == 0
    assert m.dim_date().count() == 20000


def test_ambiguous_customers_stop_the_gold_layer(spark, tmp_path):
    m = Medallion(spark, str(tmp_path))
    land(tmp_path, "customers", "1.json", [
        {"customer_id": 7, "email": "a@b", "first_name": "A", "phone": "1", "created_at": T, "updated_at": T}
    ])
    land(tmp_path, "addresses", "1.json", [
        {"address_id": i, "customer_id": 7, "street": "s", "city": "c", "country": "X",
         "is_default": True, "created_at": T, "updated_at": T} for i in (1, 2)
    ])
    m.load_bronze("r", T)
    m.load_silver("r", T)
    with pytest.raises(Exception, match="occurs more than once"):
        m.load_gold("r", T)
    m.options = Options(one_default_address=True)
    m.load_dim("dim_customers", "r", T)
    assert m.gold("dim_customers").state().where("customer_id = 7").count() == 1
    m.load_fact("fact_orders", "r", T)
    assert m.gold("fact_orders").state().count() == 0
    seen = m.publish("ANALYST")["v_dim_customers"].where("customer_id = 7").first()
    assert seen.email == "***MASKED***" and seen.first_name == "A"
    assert spark.table("v_dim_customers").count() == 2


def test_change_table_reads_only_committed_batches(spark, tmp_path):
    t = ChangeTable(spark, str(tmp_path / "t"), "id bigint, v string", "id")
    assert t.state().count() == 0
    df = spark.createDataFrame([(1, "a", "insert")], t.feed_schema)
    t.write_changes(df, 0)
    (tmp_path / "t" / "changes" / f"{BATCH}=1").mkdir()  # a write that never committed
    assert [tuple(r) for r in t.state().collect()] == [(1, "a")]


def test_parallel_loads_share_one_session(spark, tmp_path):
    """Independent medallions may load at the same time."""

    def one(n):
        root = tmp_path / str(n)
        m = Medallion(spark, str(root), ingestion=ONLY_ORDERS)
        land(root, "orders", "a.json", [order(i) for i in range(n + 1)])
        m.load_bronze("r", T)
        m.load_silver("r", T)
        return m.silver("orders").state().count()

    with ThreadPoolExecutor(3) as pool:
        assert list(pool.map(one, range(3))) == [1, 2, 3]


def test_specs_name_existing_columns():
    for spec in (ORDERS, PRODUCTS, CUSTOMERS, ADDRESSES):
        assert set(spec.update) <= set(spec.columns)
        assert {p.column for p in spec.hash_parts} <= {n for n, _ in spec.fields}


def test_files_older_than_a_week_are_not_lost(spark, tmp_path):
    """A file that turns up with an old date after a newer one was loaded."""
    import os

    m = Medallion(spark, str(tmp_path), ingestion=ONLY_ORDERS)
    land(tmp_path, "orders", "new.json", [order(1)])
    m.load_bronze("r1", T)
    land(tmp_path, "orders", "old.json", [order(2)])
    os.utime(tmp_path / "landing" / "orders_raw" / "old.json", (1_000_000_000, 1_000_000_000))
    m.load_bronze("r2", T)
    assert m.bronze("orders").count() == 2


def test_a_load_that_died_halfway_is_made_good(spark, tmp_path, monkeypatch):
    """The driver fails between the quarantine and the changes; the next run repeats the batch."""
    m = Medallion(spark, str(tmp_path), ingestion=ONLY_ORDERS)
    land(tmp_path, "orders", "a.json", [order(1), order(2, order_total_amount="-1")])
    m.load_bronze("r1", T)
    m.load_silver("r1", T)
    land(tmp_path, "orders", "b.json", [order(1, order_status="SHIPPED"), order(3, order_total_amount="-1")])
    m.load_bronze("r2", T)

    def die(self, changes, batch_id):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(ChangeTable, "write_changes", die)
        with pytest.raises(Exception, match="lost"):
            m.load_silver("r2", T)
    assert [r.order_status for r in m.silver("orders").state().collect()] == ["PAID"]
    m.load_silver("r3", T)
    assert [r.order_status for r in m.silver("orders").state().collect()] == ["SHIPPED"]
    assert sorted(r.record_key for r in m.dq_errors("orders").collect()) == ["2", "3"]


def test_a_batch_written_again_upstream_is_not_read_again(spark, tmp_path):
    """New file names for a bronze batch that silver has taken change nothing downstream."""
    m = Medallion(spark, str(tmp_path), ingestion=ONLY_ORDERS)
    land(tmp_path, "orders", "a.json", [order(1), order(2, order_total_amount="-1"), order(None)])
    m.load_bronze("r1", T)
    m.load_silver("r1", T)

    def counts():
        log = m.audit().where("layer = 'SILVER' AND process_name = 'ORDERS' AND status = 'SUCCESS'")
        return (
            m.silver("orders").state().count(), m.dq_errors("orders").count(),
            log.agg(F.sum("rows_affected")).first()[0],
        )

    before = counts()
    folder = f"{m.bronze_path('orders')}/_batch_id=0"
    rows = spark.createDataFrame(m.bronze("orders").collect(), m.bronze("orders").schema)
    rows.write.mode("overwrite").parquet(folder)
    m.load_silver("r2", T)
    assert counts() == before
    land(tmp_path, "orders", "b.json", [order(3)])
    m.load_bronze("r3", T)
    m.load_silver("r3", T)
    assert counts() == (before[0] + 1, before[1], before[2] + 1)


def test_a_file_without_any_record_is_a_failure_in_the_log(spark, tmp_path):
    m = Medallion(spark, str(tmp_path), ingestion=ONLY_ORDERS)
    land(tmp_path, "orders", "a.json", [order(1)])
    land(tmp_path, "orders", "b.json", ["no", "json"])
    m.load_bronze("r1", T)
    last = m.audit().where("process_name = 'LOAD_BRONZE' AND status IN ('SUCCESS', 'FAIL')").collect()
    assert [(r.status, r.rows_affected) for r in last] == [("FAIL", 1)] and "1 files" in last[0].message


def test_all_layouts_read_arrays_and_reject_what_follows_a_value(spark, tmp_path, at):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "indented.json").write_text(json.dumps([order(1), order(2)], indent=2))
    (folder / "single.json").write_text(json.dumps(order(3), indent=2))
    lines = [json.dumps(order(4)), json.dumps([order(5), order(6)]), '{"order_id":7}{"order_id":8}',
             '{"order_id":9} oops', '{"order_id":10}] oops', '{"order_id":11},{"order_id":12}', '{"order_id":13}} x']
    (folder / "lines.json").write_text("\n".join(lines))
    raw = read_raw(spark, str(folder))
    ids = bronze_rows(raw, at(T)).select(F.expr("variant_get(payload, '$.order_id', 'int')").alias("i"))
    assert sorted(r.i for r in ids.collect()) == [1, 2, 3, 4, 5, 6]
    assert sum(r.bad_records for r in bad_records(raw).collect()) == 5


def test_a_fact_source_with_a_repeated_key_does_not_write(spark):
    from orelode.operators.keys import AMBIGUOUS, assign_keys

    df = spark.createDataFrame([(1,), (2,), (2,), (None,), (None,)], "k long")
    assert assign_keys(df, "sk", "k", 0, 8).count() == 5
    with pytest.raises(Exception, match=AMBIGUOUS):
        assign_keys(df, "sk", "k", 0, 8, unique=True).collect()


def test_state_by_another_column_takes_the_newest_image_first(spark, tmp_path):
    table = ChangeTable(spark, str(tmp_path / "t"), "id long, owner long, v string", "id")
    for n, rows in enumerate(([(1, 10, "a"), (2, 20, "b")], [(1, 20, "c")], [(3, 10, "d")])):
        table.write_changes(spark.createDataFrame(rows, table.schema).withColumn("_action", F.lit("x")), n)
    one = spark.createDataFrame([(10,)], "owner long")
    assert [tuple(r) for r in table.state(touching=one).collect()] == [(3, 10, "d")]
    two = spark.createDataFrame([(20,)], "owner long")
    assert sorted(tuple(r) for r in table.state(touching=two).collect()) == [(1, 20, "c"), (2, 20, "b")]


def test_forgetting_keeps_states_and_unread_feeds(spark, tmp_path):
    table = ChangeTable(spark, str(tmp_path / "t"), "id long, v string", "id", snapshot_every=2)
    for n in range(5):
        table.compact(n)
        rows = spark.createDataFrame([(n % 3, f"v{n}")], table.schema)
        table.write_changes(rows.withColumn("_action", F.lit("update" if n > 2 else "insert")), n)
    state, feed = snapshot_of(table.state()), snapshot_of(table.feed([4]))
    assert table.forget(before=4)
    assert snapshot_of(table.state()) == state and snapshot_of(table.feed([4])) == feed
    assert table.forget(before=4) == []


def test_array_files_hold_a_bounded_number_of_orders(spark, sf_dir, tmp_path, monkeypatch):
    """More orders give more files, not larger ones."""
    from orelode.registry import loads

    monkeypatch.setattr(loads, "FILE_KEYS", 50, raising=False)
    monkeypatch.setattr(loads, "scratch_dir", lambda spark, name: str(tmp_path / name))
    forms = {r["form"]: (r["n"], r["ids"], r["orders"]) for r in loads.bronze_scan_array(spark, sf_dir).collect()}
    assert len(forms) == 3 and len(set(forms.values())) == 1
    files = [p.read_text() for p in (tmp_path / "arrays" / "one_line").rglob("*.txt")]
    sizes = [len({r["order_id"] for r in json.loads(t)}) for t in files if t]
    assert sum(sizes) == forms["one line"][2] and max(sizes) <= 50


def test_a_run_keeps_its_landed_lines_compressed(spark, sf_dir, tmp_path):
    """Raw text would take most of the disk of a whole run; plain and compressed files are read alike."""
    from orelode.registry.loads import _land

    for batch in (1, 2):
        _land(spark, sf_dir, "orders", batch, str(tmp_path / "plain"))
        _land(spark, sf_dir, "orders", batch, str(tmp_path / "compact"), compact=True)
    size, rows = {}, {}
    for kind in ("plain", "compact"):
        size[kind] = sum(p.stat().st_size for p in (tmp_path / kind).rglob("part-*"))
        found = read_raw(spark, str(tmp_path / kind)).select(F.to_json("payload").alias("r"))
        rows[kind] = sorted(r.r for r in found.collect())
    assert rows["compact"] == rows["plain"] and size["compact"] * 4 < size["plain"]


def test_one_batch_of_a_feed_is_not_netted_again(spark, tmp_path):
    """Each key is in it once; several batches still come to the last image."""
    m = Medallion(spark, str(tmp_path / "m"))
    table = m.silver("orders")
    feed = spark.createDataFrame([(1, 0, "A"), (1, 1, "B"), (2, 1, "C")], "order_id long, _batch_id long, order_status string")
    one = m._net(feed.where("_batch_id = 1"), table, 1)
    assert "Window" not in one._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.order_id, r.order_status) for r in m._net(feed, table, 2).collect()) == [(1, "B"), (2, "C")]

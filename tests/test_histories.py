"""Bucketed tables, objects cut from splits, change images, marts, waiting rows and long histories."""

from __future__ import annotations

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from orelode.operators.changes import BATCH
from orelode.operators.images import apply_images, merge_images, net_images
from orelode.operators.lookup import history_lookup
from orelode.operators.merge import ACTION, INSERT
from orelode.plans.audit import Step
from orelode.plans.marts import Mart
from orelode.sources.bronze import read_raw
from orelode.sources.tables import BUCKET, ChangeTable, bucket_of
from orelode.specs import ENTITIES, INGESTION
from orelode.streaming.medallion import Medallion, Options, _joined

T = "2020-01-01 00:00:00"


def images(spark, rows):
    df = spark.createDataFrame(rows, "id long, v string")
    return df.withColumn(ACTION, F.lit(INSERT))


def as_dict(df):
    rows = [tuple(r) for r in df.collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return dict(rows)


# Buckets ------------------------------------------------------------------------------------------


def test_a_batch_reads_only_its_buckets(spark, tmp_path):
    t = ChangeTable(spark, str(tmp_path / "t"), "id long, v string", "id", buckets=8, snapshot_every=2)
    t.write_changes(images(spark, [(i, "a") for i in range(200)] + [(None, "n")]), 0)
    t.write_changes(images(spark, [(1, "b")]), 1)
    t.compact(2)
    keys = spark.createDataFrame([(1,)], "id long")
    own = keys.select(bucket_of("id", 8)).first()[0]
    t.write_changes(images(spark, [(1, "c")]), 2)
    state = t.state(touching=keys)
    assert as_dict(state) == {1: "c"}
    files = state.inputFiles()
    assert files and all(f"{BUCKET}={own}/" in f for f in files)
    assert t.touched(keys) == {own}
    assert as_dict(t.state()) == {i: "a" for i in range(200)} | {1: "c", None: "n"}


def test_a_snapshot_rewrites_only_changed_buckets(spark, tmp_path):
    t = ChangeTable(spark, str(tmp_path / "t"), "id long, v string", "id", buckets=8, snapshot_every=1)
    t.write_changes(images(spark, [(i, "a") for i in range(100)]), 0)
    t.compact(1)
    t.write_changes(images(spark, [(5, "b")]), 1)
    t.compact(2)
    assert len(t._buckets_in("snapshot", "_through", 0)) == 8
    assert len(t._buckets_in("snapshot", "_through", 1)) == 1
    want = {i: "a" for i in range(100)} | {5: "b"}
    assert as_dict(t.state()) == want
    assert as_dict(t.state(before=1)) == {i: "a" for i in range(100)}
    removed = t.forget(2)
    # The first snapshot still holds seven buckets.
    assert not any("/snapshot/_through" in r for r in removed) and as_dict(t.state()) == want


@pytest.mark.parametrize("buckets", [0, 4])
@pytest.mark.parametrize("insert_only", [False, True])
def test_state_reads_a_bounded_number_of_folders(spark, tmp_path, buckets, insert_only):
    t = ChangeTable(
        spark, str(tmp_path / "t"), "id long, v string", "id", insert_only, snapshot_every=2, buckets=buckets
    )
    for n in range(6):
        t.compact(n)
        t.write_changes(images(spark, [(n, "a")]), n)
    assert as_dict(t.state()) == {n: "a" for n in range(6)}
    folders = {f.rsplit("/", 1)[0] for f in t.state().inputFiles()}
    assert len([f for f in folders if "/changes/" in f]) <= 2


def test_medallion_with_buckets(spark, tmp_path):
    only = tuple(i for i in INGESTION if i.entity == "orders")
    m = Medallion(spark, str(tmp_path), ingestion=only, options=Options(buckets=4, snapshot_every=1))
    folder = tmp_path / "landing" / "orders_raw"
    folder.mkdir(parents=True)
    for n, status in enumerate(("PAID", "SHIPPED", "DELIVERED")):
        rows = [order(i, order_status=status) for i in range(n, 10)]
        (folder / f"{n}.json").write_text("\n".join(map(json.dumps, rows)))
        m.load_bronze(f"r{n}", T)
        m.load_silver(f"r{n}", T)
    got = {r.order_id: r.order_status for r in m.silver("orders").state().collect()}
    assert got == {0: "PAID", 1: "SHIPPED"} | {i: "DELIVERED" for i in range(2, 10)}


def test_marks_are_ranges(spark):
    rows = [("a", 0, 0), ("a", 1, 4), ("a", 6, 6), ("a", 5, 5), ("b", 3, 3), ("b", 5, 5)]
    out = _joined(spark.createDataFrame(rows, "_from string, _low long, _high long"))
    assert sorted(map(tuple, out.collect())) == [("a", 0, 6), ("b", 3, 3), ("b", 5, 5)]


# Objects out of splits --------------------------------------------------------------------------------


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "400")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def read(spark, path, layout="auto"):
    raw = read_raw(spark, str(path), layout)
    return [r[0] for r in raw.select(F.to_json("payload")).collect()]


def odd_record(rng, i):
    text = "".join(rng.choice(['"', "\\", "{", "}", "[", "]", ",", "a", "é", "\n", " "]) for _ in range(rng.randrange(30)))
    return {"id": i, "t": text, "o": [{"x": text}, {}, [1, {"y": None}]]}


@pytest.mark.parametrize("indent", [None, 2])
def test_arrays_are_read_in_splits(spark, tmp_path, small_splits, indent):
    rng = random.Random(3)
    for k in range(3):
        records = [odd_record(rng, 100 * k + i) for i in range(12)]
        (tmp_path / f"{k}.json").write_text(json.dumps(records, indent=indent, ensure_ascii=k == 1))
    found = [json.loads(r) for r in read(spark, tmp_path)]
    rng = random.Random(3)
    want = [odd_record(rng, 100 * k + i) for k in range(3) for i in range(12)]
    assert sorted(found, key=lambda r: r["id"]) == want


def test_good_elements_of_a_broken_array_stay(spark, tmp_path, small_splits):
    (tmp_path / "a.json").write_text('[{"a":1},{"b";2},{"c":{"d":3}}, oops {"e":4}, 7]')
    (tmp_path / "b.json").write_text('[{"f":1},{"g":{"h":2}')
    (tmp_path / "c.json").write_text("[]")
    (tmp_path / "d.json").write_text(" ")
    (tmp_path / "e.json").write_text('[{"i":1}}, {"j":2}]')
    found = read(spark, tmp_path, "array")
    good = sorted(r for r in found if r)
    assert good == ['{"a":1}', '{"c":{"d":3}}', '{"e":4}', '{"f":1}', '{"i":1}', '{"j":2}']
    # The broken element, two texts between, the object that is never closed, the brace too many.
    assert found.count(None) == 5


def test_small_splits_share_tasks_and_keep_their_places(spark, tmp_path, small_splits):
    from orelode.sources.bronze import _first_signs
    from orelode.sources.objects import TASKS, read_pieces

    (tmp_path / "a.json").write_text(json.dumps([odd_record(random.Random(i), i) for i in range(600)]))
    size = (tmp_path / "a.json").stat().st_size
    pieces = read_pieces(spark, str(tmp_path))
    assert pieces.rdd.getNumPartitions() <= TASKS * spark.sparkContext.defaultParallelism < size // 400
    assert pieces.select("block").distinct().count() > size // 800
    # The first sign is not looked for by every split.
    assert _first_signs(spark, str(tmp_path)).collect()[0].first == ord("[")
    assert sorted(json.loads(r)["id"] for r in read(spark, tmp_path)) == list(range(600))


def test_scratch_tables_are_not_read_in_the_inputs_splits(spark, tmp_path, small_splits):
    """The splits set for raw files decide the tasks that read them, not those on what is written between."""
    from orelode.sources.objects import _scratch

    stored = _scratch(spark.range(20000).select(F.sha2(F.col("id").cast("string"), 256).alias("h")).coalesce(1), "wide")
    assert stored.count() == 20000 and stored.rdd.getNumPartitions() <= 8


def test_kinds_of_files_are_told_without_sorting_lines(spark, tmp_path):
    from orelode.sources.bronze import _kinds

    # The code of the last one's first sign is that of a bracket plus 256.
    texts = {"a": '[\n{"n": 1}\n]', "b": '{"n": 1}\n{"n": 2}', "c": '\n\t{\n"n":\n1\n}', "d": "ś"}
    for name, text in texts.items():
        (tmp_path / f"{name}.json").write_text(text)
    found = _kinds(spark, str(tmp_path))
    lines = {r.source_file.rsplit("/", 1)[1][0]: r.by_line for r in found.collect()}
    assert lines == {"a": False, "b": True, "c": False, "d": True}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan.split("FileScan")[0].split("block")[-1] and "HashAggregate(keys=[source_file" in plan


def test_default_layout_tells_files_apart(spark, tmp_path, small_splits):
    (tmp_path / "array.json").write_text(json.dumps([{"n": i} for i in range(30)]))
    (tmp_path / "object.json").write_text(json.dumps({"n": 100, "o": {"p": 1}}, indent=4))
    (tmp_path / "lines.json").write_text("\n".join(['{"n": 200', *(json.dumps({"n": 201 + i}) for i in range(30))]))
    (tmp_path / "lists.json").write_text('[{"n": 300}, {"n": 301}]\n[{"n": 302}]\n')
    found = read(spark, tmp_path)
    ids = sorted(json.loads(r)["n"] for r in found if r)
    assert ids == [*range(30), 100, *range(201, 231), 300, 301, 302] and found.count(None) == 1


# Images and marts --------------------------------------------------------------------------------------


def state(spark, rows):
    return spark.createDataFrame(rows, "id long, v string, n int")


def test_net_images(spark):
    s0 = state(spark, [(1, "a", 1), (2, "a", 2), (3, "a", 3), (4, "a", 4)])
    first = merge_images(s0, state(spark, [(1, "b", 1), (2, "b", 2), (5, "x", 5), (6, "x", 6), (None, "z", 0)]), "id")
    s1 = apply_images(s0, first, "id")
    gone = spark.createDataFrame([(5,), (3,), (9,), (None,)], "id long")
    second = merge_images(s1, state(spark, [(1, "a", 1), (2, "c", 2), (3, "q", 3)]), "id", gone)
    s2 = apply_images(s1, second, "id")
    assert sorted(map(tuple, s2.collect()), key=str) == [(1, "a", 1), (2, "c", 2), (4, "a", 4), (6, "x", 6), (None, "z", 0)]
    feed = first.withColumn(BATCH, F.lit(1)).unionByName(second.withColumn(BATCH, F.lit(2)))
    net = {r["id"]: (r[ACTION], r["before"] and r["before"]["v"], r["after"] and r["after"]["v"])
           for r in net_images(feed, "id", ("v", "n")).collect()}
    assert net == {2: ("update", "a", "c"), 3: ("delete", "a", None), 6: ("insert", None, "x"), None: ("insert", None, "z")}
    assert net_images(feed.limit(0), "id", ("v",)).count() == 0


def test_marts_follow_images(spark):
    mart = Mart(("v",), ("n",))
    s0 = state(spark, [(1, "a", 1), (2, "a", None), (3, None, 3), (4, "gone", None)])
    now, current = mart.build(s0), s0
    steps = [
        ([(1, "b", 10), (5, None, 5)], [4]),
        ([(1, "a", 1)], [5]),
        ([(7, "a", None), (1, "a", None)], [3]),
    ]
    for rows, deleted in steps:
        gone = spark.createDataFrame([(d,) for d in deleted], "id long")
        batch = merge_images(current, state(spark, rows), "id", gone)
        current = apply_images(current, batch, "id")
        now = mart.apply(now, mart.delta(batch))
        want = current.groupBy("v").agg(F.count("*").alias("rows"), F.sum("n").cast("decimal(38,2)").alias("n"))
        assert sorted(map(tuple, mart.values(now).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert mart.delta(batch.limit(0)).count() == 0


# Waiting rows ---------------------------------------------------------------------------------------------


def order(i, **kw):
    return {
        "order_id": i, "customer_id": 7, "order_status": "PAID", "order_total_amount": "10.00",
        "currency": "EUR", "created_at": T, "updated_at": T,
    } | kw


def payment(i, of, **kw):
    return {
        "payment_id": i, "order_id": of, "provider": "VISA", "payment_status": "SUCCESS", "amount": "1.00",
        "created_at": T, "updated_at": T,
    } | kw


def test_children_wait_for_their_parents(spark, tmp_path, bronze):
    m = Medallion(spark, str(tmp_path), options=Options(hold_orphans=True, buckets=4))

    def land(entity, n, rows):
        bronze(rows).write.parquet(f"{m.bronze_path(entity)}/{BATCH}={n}")

    def load(n):
        m.load_entity("orders", f"r{n}", T)
        m.load_entity("payments", f"r{n}", T)
        paid = {r.payment_id: r.payment_status for r in m.silver("payments").state().collect()}
        return paid, {r.payment_id: r.payment_status for r in m.waiting("payments").collect()}

    land("orders", 0, [order(1)])
    land("payments", 0, [payment(10, 1), payment(20, 2), payment(30, 3), payment(40, None)])
    assert load(0) == ({10: "SUCCESS", 40: "SUCCESS"}, {20: "SUCCESS", 30: "SUCCESS"})
    # No new parent: a newer image of a waiting row takes its place.
    land("payments", 1, [payment(20, 2, payment_status="REFUNDED", updated_at="2020-01-02 00:00:00")])
    assert load(1)[1] == {20: "REFUNDED", 30: "SUCCESS"}
    # A parent without any new child.
    land("orders", 1, [order(2)])
    want = {10: "SUCCESS", 20: "REFUNDED", 40: "SUCCESS"}, {30: "SUCCESS"}
    assert load(2) == want
    # Nothing new: nothing moves. The last batch again: the same.
    assert load(3) == want
    again = spark.createDataFrame([], f"payload variant, ingestion_ts timestamp_ntz, source_file string, {BATCH} bigint, _from string")
    m.silver_batch(ENTITIES["payments"], Step(), "again", T)(again, 2)
    assert {r.payment_id for r in m.silver("payments").state().collect()} == {10, 20, 40}


# Long histories --------------------------------------------------------------------------------------------


def test_history_lookup(spark):
    rng = random.Random(1)
    day = lambda n: str(datetime(2020, 1, 1) + timedelta(hours=n))
    versions = [("hot", day(7 * i), i) for i in range(3000)] + [("cold", day(100), -1), ("cold", day(100), -2)]
    versions += [(None, day(1), 5), ("cold", None, 6)]
    facts = [("hot", day(rng.randrange(30_000)), i) for i in range(500)]
    facts += [("hot", day(70), 900), ("hot", "2019-01-01 00:00:00", 901), ("cold", day(99), 902), ("cold", day(100), 903),
              ("cold", "2035-01-01 00:00:00", 904), ("none", day(5), 905), (None, day(5), 906), ("hot", None, 907),
              ("hot", day(70), 900)]
    v = spark.createDataFrame(versions, "k string, since string, value int").withColumn("since", F.col("since").cast("timestamp_ntz"))
    f = spark.createDataFrame(facts, "k string, at string, n int").withColumn("at", F.col("at").cast("timestamp_ntz"))
    out = history_lookup(f, v, "k", "at", "since", ("value",))
    got = sorted((r.n, r.value) for r in out.select("n", "value").na.fill(-9).collect())
    hours = {}
    for k, at, n in facts:
        found = None
        if k and at:
            known = [(s, x) for kk, s, x in versions if kk == k and s and s <= at]
            found = max(known)[1] if known else None
        hours.setdefault(n, []).append(-9 if found is None else found)
    assert got == sorted((n, x) for n, xs in hours.items() for x in xs)
    assert out.columns == ["k", "at", "n", "value"]
    assert history_lookup(f, v.limit(0), "k", "at", "since", ("value",)).where("value is not null").count() == 0
    # Facts are sorted with versions, never joined with them.
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan

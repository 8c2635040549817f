"""One small hand-made case per behaviour that is easy to get wrong."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orelode.functions.masking import mask_columns
from orelode.operators.dedup import latest_per_key
from orelode.operators.lookup import pit_lookup
from orelode.operators.merge import (
    ACTION, MergeRule, apply_changes, duplicate_keys, insert_all, merge_apply, merge_changes,
)
from orelode.operators.quality import accepted, dq_tag, parse, quarantined, undecided, verdict
from orelode.operators.scd2 import scd2_apply, scd2_changes, unknown_member
from orelode.plans.gold import (
    changed_customer_ids, customer_source, dim_date, fact_source, product_source,
)
from orelode.plans.silver import silver_source, tag
from orelode.specs import (
    ADDRESSES, CUSTOMERS, DIM_CUSTOMERS, DIM_PRODUCTS, FACT_SHIPMENTS, ORDER_ITEMS, ORDERS, PRODUCTS,
    SHIPMENTS,
)

T = "2020-01-01 00:00:00"


def order(**kw):
    base = {
        "order_id": 1, "customer_id": 7, "order_status": "PAID", "order_total_amount": "10.00",
        "currency": "EUR", "created_at": T, "updated_at": T,
    }
    return {k: v for k, v in (base | kw).items() if v is not ...}


def product(**kw):
    base = {
        "product_id": 1, "name": "Lamp", "category": "Home", "brand": "B", "price": "5.00",
        "currency": "EUR", "status": "ACTIVE", "created_at": T, "updated_at": T,
    }
    return {k: v for k, v in (base | kw).items() if v is not ...}


def verdicts(tagged):
    return sorted(r[0] for r in tagged.select(verdict(tagged)).collect())


def next_state(state, source, spec, ts):
    return merge_apply(state, source, MergeRule.for_entity(spec), ts)


def test_null_comparison_leaves_row_undecided(bronze):
    tagged = tag(bronze([order(order_total_amount=...)]), ORDERS)
    assert verdicts(tagged) == ["undecided"]
    assert undecided(tagged).count() == 1
    assert verdicts(tag(bronze([order(order_total_amount=...)]), ORDERS, strict=True)) == ["UNKNOWN"]


def test_other_rule_decides_a_null_comparison(bronze):
    tagged = tag(bronze([order(order_total_amount=..., customer_id=...)]), ORDERS)
    assert verdicts(tagged) == ["MISSING_CUSTOMER"]


def test_json_null_is_present(bronze):
    tagged = tag(bronze([order(customer_id=None), order(order_id=2, customer_id=...)]), ORDERS)
    assert verdicts(tagged) == ["MISSING_CUSTOMER", "accepted"]
    assert accepted(tagged, ORDERS).first().customer_id is None
    # the typed check sees no difference
    both = tag(bronze([order(created_at=None), order(created_at=...)]), ORDERS)
    assert verdicts(both) == ["MISSING_DATE", "MISSING_DATE"]


def test_first_rule_names_the_error_and_raw_record_is_kept(bronze, at):
    bad = order(order_total_amount="-1", customer_id=..., extra="kept")
    row = quarantined(tag(bronze([bad]), ORDERS), ORDERS, "run", at(T)).select(
        "*", F.expr("variant_get(raw_record, '$.extra', 'string')").alias("extra")
    ).first()
    assert (row.error_type, row.record_key, row.extra) == ("NEGATIVE_AMOUNT", "1", "kept")
    assert row.error_message == "Validation Failed"


def test_blank_names(bronze):
    rows = [product(name="  "), product(name=...), product(name=None), product(name="x")]
    # an explicit JSON null is neither blank nor absent: nothing decides it
    assert verdicts(tag(bronze(rows), PRODUCTS)) == ["EMPTY_NAME", "EMPTY_NAME", "accepted", "undecided"]


@pytest.fixture
def priced(bronze, at, spark):
    """dim_products after a load at 5.00 and a price change the year after."""

    def run(mode, loads=2):
        dim, silver = unknown_member(spark, DIM_PRODUCTS), None
        for n in range(loads):
            day = f"202{n}-01-01 00:00:00"
            source = silver_source(
                tag(bronze([product(price=f"{5 + n}.00", updated_at=day)]), PRODUCTS), PRODUCTS
            )
            if silver is None:
                state = insert_all(source, MergeRule.for_entity(PRODUCTS), at(day))
            else:
                state = next_state(silver, source, PRODUCTS, at(day))
            changes = state.where(F.col(ACTION) != "keep")
            dim = scd2_apply(dim, product_source(changes), DIM_PRODUCTS, n, 8, mode)
            silver = state.drop(ACTION)
        return dim

    return run


def versions(dim):
    rows = dim.where("product_id = 1").orderBy("valid_from").collect()
    return [(r.price, r.valid_from.year, r.valid_to.year, r.is_current) for r in rows]


def test_close_only_leaves_a_gap_until_the_next_change(priced):
    assert versions(priced("close_only")) == [(Decimal("5.00"), 2020, 2021, False)]
    assert versions(priced("close_only", loads=3)) == [
        (Decimal("5.00"), 2020, 2021, False), (Decimal("7.00"), 2022, 9999, True),
    ]


def test_gap_resolves_to_unknown(priced, spark):
    facts = spark.sql(
        "SELECT 1L AS product_id, ts FROM VALUES (TIMESTAMP_NTZ '2020-06-01'), (TIMESTAMP_NTZ '2021-06-01'), "
        "(TIMESTAMP_NTZ '2021-01-01'), (TIMESTAMP_NTZ '2022-01-01') AS t(ts)"
    )
    found = pit_lookup(facts, priced("close_only", loads=3), DIM_PRODUCTS, "product_id", "ts")
    hit = {r.ts.isoformat()[:7]: r.product_key for r in found.collect()}
    assert hit["2020-06"] > 0 and hit["2022-01"] > hit["2020-06"]
    assert hit["2021-06"] == hit["2021-01"] == -1


def test_versioned_reopens_in_the_same_load(priced):
    assert versions(priced("versioned")) == [
        (Decimal("5.00"), 2020, 2021, False), (Decimal("6.00"), 2021, 9999, True),
    ]


def test_scd2_changes_applied_equal_scd2_apply(priced, spark, bronze):
    dim = priced("versioned")
    rows = [product(price="9.00", updated_at="2023-01-01 00:00:00"), product(product_id=2)]
    source = product_source(silver_source(tag(bronze(rows), PRODUCTS), PRODUCTS))
    for mode in ("versioned", "close_only"):
        whole = scd2_apply(dim, source, DIM_PRODUCTS, 5, 8, mode)
        written = scd2_changes(dim, source, DIM_PRODUCTS, 5, 8, mode)
        stepwise = apply_changes(dim, written, "product_key")
        assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, stepwise.collect()))


def test_order_before_the_customer_load_is_unknown(spark, bronze, at):
    customers = silver_source(tag(bronze([{
        "customer_id": 7, "email": "a@b", "first_name": "A", "last_name": "B", "phone": "1",
        "status": "ACTIVE", "created_at": "2019-01-01 00:00:00", "updated_at": "2019-01-01 00:00:00",
    }]), CUSTOMERS), CUSTOMERS)
    none = spark.createDataFrame([], ADDRESSES.schema)
    ids = changed_customer_ids(customers, none)
    source = customer_source(customers, none, ids, at("2020-06-01 00:00:00"))
    row = source.first()
    assert (row.city, row.address_type, row.phone) == ("Unknown", "Unknown", "1")
    # missing address parts hash as empty text
    assert source.where(F.col("hash_value") == F.sha2(F.lit("a@b|A|B|1|ACTIVE|||||"), 256)).count() == 1
    dim = scd2_apply(unknown_member(spark, DIM_CUSTOMERS), source, DIM_CUSTOMERS, 0, 8)
    orders = silver_source(
        tag(bronze([order(), order(order_id=2, created_at="2020-07-01 00:00:00")]), ORDERS), ORDERS
    )
    keys = {r.order_id: r.customer_key for r in fact_source("fact_orders", orders, dim_customers=dim).collect()}
    assert keys[1] == -1 and keys[2] > 0


def test_change_outside_the_hash_is_kept(bronze, at):
    first = silver_source(tag(bronze([order()]), ORDERS), ORDERS)
    second = silver_source(tag(bronze([order(customer_id=8, updated_at="2021-01-01 00:00:00")]), ORDERS), ORDERS)
    row = next_state(first, second, ORDERS, at("2021-01-01 00:00:00")).first()
    assert (row[ACTION], row.customer_id, row.updated_at.year) == ("keep", 7, 2020)
    assert merge_changes(first, second, MergeRule.for_entity(ORDERS), at(T)).count() == 0


def test_older_data_overwrites_unless_guarded(bronze, at):
    first = silver_source(tag(bronze([order()]), ORDERS), ORDERS)
    older = silver_source(
        tag(bronze([order(order_status="CREATED", updated_at="2019-01-01 00:00:00")]), ORDERS), ORDERS
    )
    row = next_state(first, older, ORDERS, at(T)).first()
    assert (row[ACTION], row.order_status, row.updated_at.year) == ("update", "CREATED", 2019)
    assert next_state(first, older, replace(ORDERS, guard_newer=True), at(T)).first()[ACTION] == "keep"


def test_hash_reads_raw_text(bronze, at):
    first = silver_source(tag(bronze([order(order_total_amount="10.001")]), ORDERS), ORDERS)
    second = silver_source(tag(bronze([order(order_total_amount="10.002")]), ORDERS), ORDERS)
    row = next_state(first, second, ORDERS, at(T)).first()
    assert (row[ACTION], row.order_total_amount) == ("update", Decimal("10.00"))


def test_hash_defaults(bronze):
    row = parse(bronze([order(order_total_amount=..., currency=...)]), ORDERS)
    assert row.where(F.col("hash_value") == F.sha2(F.lit("PAID|0|"), 256)).count() == 1
    shipment = {"shipment_id": 1, "order_id": 1, "carrier": "C", "shipment_status": "S", "shipped_at": T}
    row = parse(bronze([shipment]), SHIPMENTS)
    text = "C|S|2020-01-01 00:00:00|1900-01-01"
    assert row.where(F.col("hash_value") == F.sha2(F.lit(text), 256)).count() == 1


def test_null_timestamp_is_newest(bronze):
    rows = [order(order_status="OLD", updated_at="2030-01-01 00:00:00"), order(order_status="NEW", updated_at=None)]
    assert silver_source(tag(bronze(rows), ORDERS), ORDERS).first().order_status == "NEW"


def test_ties_do_not_depend_on_partitioning(bronze):
    rows = [order(order_status=s) for s in ("A", "C", "B")]
    tagged = accepted(tag(bronze(rows), ORDERS), ORDERS)
    seen = {latest_per_key(tagged.repartition(n), ORDERS).first().order_status for n in (1, 2, 3, 7)}
    assert seen == {"C"}


def test_rejected_newest_image_lets_an_older_one_win(bronze):
    rows = [order(), order(order_total_amount="-5", updated_at="2021-01-01 00:00:00")]
    assert silver_source(tag(bronze(rows), ORDERS), ORDERS).first().order_total_amount == Decimal("10.00")


def test_null_keys_gather_one_row_per_batch(bronze, at):
    state = None
    for _ in range(2):
        source = silver_source(tag(bronze([order(order_id=None), order(order_id=...)]), ORDERS), ORDERS)
        if state is None:
            state = insert_all(source, MergeRule.for_entity(ORDERS), at(T)).drop(ACTION)
        else:
            state = next_state(state, source, ORDERS, at(T)).drop(ACTION)
    assert state.where("order_id IS NULL").count() == 2
    keyed = replace(ORDERS, require_key=True)
    assert verdicts(tag(bronze([order(order_id=None)]), keyed)) == ["NULL_KEY"]


def test_malformed_values_raise_unless_lenient(bronze):
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
        tag(bronze([order(order_total_amount="abc")]), ORDERS).collect()
    lenient = replace(ORDERS, lenient_casts=True)
    assert verdicts(tag(bronze([order(order_total_amount="abc")]), lenient)) == ["undecided"]


def test_dim_date_is_a_pure_function(spark):
    days = dim_date(spark).union(dim_date(spark)).distinct()
    assert days.count() == 20000
    last = dim_date(spark).orderBy(F.desc("date_key")).first()
    assert last.date_value == dt.date(2054, 10, 3)
    sunday = dim_date(spark).where("date_key = 20210103").first()
    assert (sunday.week_of_year, sunday.day_of_week, sunday.is_weekend) == (53, 7, True)
    assert (sunday.day_name, sunday.day_name_short, sunday.month_name_short) == ("Sunday", "Sun", "Jan")


def test_dim_date_equals_sql(spark):
    from compare import duck_rows, spark_rows
    import duckdb

    sql = (
        "SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, d AS date_value, day(d) AS day_num, "
        "dayname(d) AS day_name, left(dayname(d), 3) AS day_name_short, isodow(d) AS day_of_week, "
        "dayofyear(d) AS day_of_year, weekofyear(d) AS week_of_year, month(d) AS month_num, "
        "monthname(d) AS month_name, left(monthname(d), 3) AS month_name_short, quarter(d) AS quarter, "
        "year(d) AS year, strftime(d, '%Y-%m') AS year_month, isodow(d) > 5 AS is_weekend, "
        "d = last_day(d) AS is_last_day_of_month, datediff('day', DATE '1970-01-01', d) AS epoch_days "
        "FROM (SELECT CAST(DATE '2000-01-01' + CAST(i AS INTEGER) AS DATE) AS d FROM range(20000) r(i))"
    )
    assert spark_rows(dim_date(spark)) == duck_rows(duckdb.connect(), sql)


def test_two_default_addresses_fire_the_guard(spark, bronze, at):
    customers = silver_source(tag(bronze([{
        "customer_id": 7, "email": "a@b", "first_name": "A", "phone": "1", "created_at": T, "updated_at": T,
    }]), CUSTOMERS), CUSTOMERS)
    address = {"customer_id": 7, "street": "s", "country": "X", "is_default": True, "created_at": T}
    addresses = silver_source(tag(bronze([
        address | {"address_id": 1, "city": "old", "updated_at": T},
        address | {"address_id": 2, "city": "new", "updated_at": "2021-01-01 00:00:00"},
    ]), ADDRESSES), ADDRESSES)
    ids = changed_customer_ids(customers, addresses)
    source = customer_source(customers, addresses, ids, at(T))
    assert [tuple(r) for r in duplicate_keys(source, "customer_id").collect()] == [(7, 2)]
    assert customer_source(customers, addresses, ids, at(T), one_default=True).first().city == "new"


def test_fact_keeps_first_insert_values(bronze, at, spark):
    dim = unknown_member(spark, DIM_CUSTOMERS)
    orders = silver_source(tag(bronze([order()]), ORDERS), ORDERS)

    def source(carrier, status):
        ship = {
            "shipment_id": 1, "order_id": 1, "carrier": carrier, "shipment_status": status,
            "shipped_at": "2019-12-31 23:59:00", "updated_at": T,
        }
        rows = silver_source(tag(bronze([ship]), SHIPMENTS), SHIPMENTS)
        return fact_source("fact_shipments", rows, orders, None, dim).withColumn("shipment_key", F.lit(1))

    first = insert_all(source("DHL", "SHIPPED"), MergeRule.for_fact(FACT_SHIPMENTS), at(T)).drop(ACTION)
    row = merge_apply(first, source("UPS", "LOST"), MergeRule.for_fact(FACT_SHIPMENTS), at(T)).first()
    assert (row.carrier, row.shipment_status) == ("DHL", "LOST")
    # negative days are normal, a missing delivery has no day key and no duration
    assert (row.days_to_ship, row.days_to_deliver, row.delivery_date_key) == (-1, None, -1)


def test_rounding_happens_at_the_cast(bronze):
    tagged = tag(bronze([order(order_total_amount="-0.004")]), ORDERS)
    assert accepted(tagged, ORDERS).first().order_total_amount == Decimal("0.00")
    item = {"order_item_id": 1, "order_id": 1, "product_id": 1, "quantity": 1.5, "unit_price": "1.00",
            "created_at": T}
    assert parse(bronze([item]), ORDER_ITEMS).first().quantity == 2


def test_masking(spark):
    people = spark.createDataFrame([(1, "a@b", None)], "customer_id long, email string, phone string")
    assert tuple(mask_columns(people, "ANALYST").first()) == (1, "***MASKED***", "***MASKED***")
    assert tuple(mask_columns(people, "ETL_ROLE").first()) == (1, "a@b", None)


def test_whole_and_stepwise_merge_agree(bronze, at):
    rule = MergeRule.for_entity(ORDERS)
    first = silver_source(tag(bronze([order(order_id=i) for i in range(1, 6)]), ORDERS), ORDERS)
    second = silver_source(
        tag(bronze([order(order_id=i, order_status="X" if i % 2 else "PAID") for i in range(3, 9)]), ORDERS),
        ORDERS,
    )
    whole = merge_apply(first, second, rule, at(T))
    for target in (first, first.join(second.select("order_id"), "order_id", "left_semi")):
        changes = merge_changes(target.select(*ORDERS.columns), second, rule, at(T))
        assert sorted(r[ACTION] for r in changes.collect()) == ["insert"] * 3 + ["update"] * 2
        stepwise = apply_changes(first, changes, "order_id")
        assert sorted(map(tuple, whole.drop(ACTION).collect())) == sorted(map(tuple, stepwise.collect()))


def test_verdicts_partition_the_input(bronze):
    rows = [order(order_id=i, order_total_amount=a, customer_id=c)
            for i, (a, c) in enumerate([("1", 1), ("-1", 1), (..., 1), (..., ...), ("1", ...)])]
    tagged = dq_tag(parse(bronze(rows), ORDERS), ORDERS)
    parts = (
        accepted(tagged, ORDERS).count(), undecided(tagged).count(), tagged.where("_rejected").count()
    )
    assert parts == (1, 1, 3)

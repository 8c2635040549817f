"""Feeds of the eight entities, derived from the given order-and-catalogue tables.

Every feed is a list of images of one scan: a filter, a batch number and an expression per column,
in SQL that Spark and other engines read alike (``{ts}`` stands for the zone-less timestamp type).
Dirty rows are injected by key arithmetic, as the tables hold no NULLs themselves.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orelode.functions.dates import ntz
from orelode.specs import ENTITIES, KINDS

LOAD_TS = {1: "1995-01-01 00:00:00", 2: "1998-01-01 00:00:00"}

_MONEY = "DECIMAL(18,2)"
_T1 = "CAST('1995-01-01 00:00:00' AS {ts})"
_T2 = "CAST('1998-01-01 00:00:00' AS {ts})"


@dataclass(frozen=True)
class Image:
    batch: int
    columns: dict[str, str]
    where: str | None = None
    source_file: str = ""

    @property
    def file(self) -> str:
        return self.source_file or f"b{self.batch}/a.json"


@dataclass(frozen=True)
class Feed:
    tables: tuple[str, ...]
    base: str
    images: tuple[Image, ...]


_TOTAL = f"CAST(o_totalprice AS {_MONEY})"
_PRICE = f"CAST(l_extendedprice AS {_MONEY})"
_RETAIL = f"CAST(p_retailprice AS {_MONEY})"
_GEO = "customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"

FEEDS: dict[str, Feed] = {
    "orders": Feed(
        tables=("orders",),
        base="orders",
        images=(
            Image(1, {
                "order_id": "o_orderkey",
                "customer_id": "CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_custkey END",
                "order_status": "CASE o_orderstatus WHEN 'F' THEN 'DELIVERED' WHEN 'O' THEN 'CREATED' ELSE 'PAID' END",
                "order_total_amount": f"CASE WHEN o_orderkey % 89 = 0 THEN -{_TOTAL} WHEN o_orderkey % 83 = 0 THEN NULL ELSE {_TOTAL} END",
                "currency": "'EUR'",
                "created_at": "CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE o_orderdate END",
                "updated_at": "CASE WHEN o_orderkey % 103 = 0 THEN NULL ELSE o_orderdate END",
            }),
            Image(1, {  # same batch, newer image
                "order_id": "o_orderkey", "customer_id": "o_custkey", "order_status": "'PAID'",
                "order_total_amount": _TOTAL, "currency": "'EUR'", "created_at": "o_orderdate",
                "updated_at": "o_orderdate + INTERVAL 1 DAY",
            }, "o_orderkey % 10 = 0", "b1/b.json"),
            Image(2, {  # status change
                "order_id": "o_orderkey", "customer_id": "o_custkey", "order_status": "'SHIPPED'",
                "order_total_amount": _TOTAL, "currency": "'EUR'", "created_at": "o_orderdate",
                "updated_at": "o_orderdate + INTERVAL 30 DAY",
            }, "o_orderkey % 7 = 0"),
            Image(2, {  # a change outside the hash
                "order_id": "o_orderkey", "customer_id": "o_custkey + 1", "order_status": "'CREATED'",
                "order_total_amount": _TOTAL, "currency": "'EUR'", "created_at": "o_orderdate",
                "updated_at": "o_orderdate + INTERVAL 40 DAY",
            }, "o_orderkey % 11 = 0 AND o_orderkey % 7 <> 0 AND o_orderstatus = 'O'", "b2/b.json"),
        ),
    ),
    "order_items": Feed(
        tables=("lineitem", "orders"),
        base="lineitem JOIN orders ON l_orderkey = o_orderkey",
        images=(
            Image(1, {
                "order_item_id": "l_orderkey * 10 + l_linenumber",
                "order_id": "l_orderkey",
                "product_id": "CASE WHEN l_partkey % 71 = 0 THEN NULL ELSE l_partkey END",
                "quantity": "CAST(l_quantity AS BIGINT)",
                "unit_price": f"CASE WHEN l_suppkey % 37 = 0 THEN NULL WHEN l_partkey % 73 = 0 THEN -{_PRICE} ELSE {_PRICE} END",
                "created_at": "CASE WHEN l_orderkey % 101 = 0 THEN NULL ELSE o_orderdate END",
            }),
        ),
    ),
    "order_status_history": Feed(
        tables=("events",),
        base="events",
        images=tuple(
            Image(batch, {
                "status_history_id": "event_id",
                "order_id": "CASE WHEN event_id % 61 = 0 THEN NULL ELSE user_id END",
                "status": "CASE WHEN event_id % 67 = 0 THEN NULL ELSE event_type END",
                "changed_at": "ts",
            }, f"event_id % 2 = {rest}")
            for batch, rest in ((1, 0), (2, 1))
        ),
    ),
    "payments": Feed(
        tables=("orders",),
        base="orders",
        images=(
            Image(1, {
                "payment_id": "o_orderkey", "order_id": "o_orderkey",
                "provider": "CASE WHEN o_orderkey % 47 = 0 THEN NULL WHEN o_orderkey % 2 = 0 THEN 'VISA' ELSE 'PAYPAL' END",
                "payment_status": "CASE WHEN o_orderkey % 43 = 0 THEN NULL WHEN o_orderstatus = 'O' THEN 'PENDING' ELSE 'SUCCESS' END",
                "amount": _TOTAL,
                "created_at": "CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE o_orderdate + INTERVAL 15 MINUTE END",
                "updated_at": "o_orderdate + INTERVAL 15 MINUTE",
            }),
            Image(2, {
                "payment_id": "o_orderkey", "order_id": "o_orderkey", "provider": "'VISA'",
                "payment_status": "'REFUNDED'", "amount": _TOTAL,
                "created_at": "o_orderdate + INTERVAL 15 MINUTE",
                "updated_at": "o_orderdate + INTERVAL 5 DAY",
            }, "o_orderstatus = 'F' AND o_orderkey % 9 = 0"),
        ),
    ),
    "shipments": Feed(
        tables=("lineitem",),
        base="lineitem",
        images=(
            Image(1, {
                "shipment_id": "l_orderkey * 10 + l_linenumber",
                "order_id": "l_orderkey",
                "carrier": "CASE WHEN l_suppkey % 31 = 0 THEN NULL ELSE 'DHL' END",
                "shipment_status": "CASE WHEN l_partkey % 79 = 0 THEN NULL WHEN l_linestatus = 'F' THEN 'DELIVERED' ELSE 'SHIPPED' END",
                "shipped_at": "CASE WHEN l_partkey % 83 = 0 THEN NULL ELSE l_shipdate END",
                "delivered_at": "CASE WHEN l_linestatus = 'F' THEN l_shipdate + INTERVAL 3 DAY ELSE NULL END",
                "updated_at": "l_shipdate",
            }),
        ),
    ),
    "products": Feed(
        tables=("part",),
        base="part",
        images=(
            Image(1, {
                "product_id": "p_partkey",
                "name": "CASE WHEN p_partkey % 53 = 0 THEN '  ' ELSE p_name END",
                "category": "p_type", "brand": "p_brand",
                "price": f"CASE WHEN p_partkey % 61 = 0 THEN NULL WHEN p_partkey % 59 = 0 THEN -{_RETAIL} ELSE {_RETAIL} END",
                "currency": "CASE WHEN p_partkey % 67 = 0 THEN NULL ELSE 'EUR' END",
                "status": "'ACTIVE'",
                "created_at": f"CASE WHEN p_partkey % 101 = 0 THEN NULL ELSE {_T1} END",
                "updated_at": _T1,
            }),
            Image(2, {
                "product_id": "p_partkey", "name": "p_name", "category": "p_type", "brand": "p_brand",
                "price": f"CAST({_RETAIL} + 10 AS {_MONEY})", "currency": "'EUR'", "status": "'ACTIVE'",
                "created_at": _T1, "updated_at": _T2,
            }, "p_partkey % 3 = 0"),
        ),
    ),
    "customers": Feed(
        tables=("customer",),
        base="customer",
        images=(
            Image(1, {
                "customer_id": "c_custkey",
                "email": "CASE WHEN c_custkey % 29 = 0 THEN 'no-at-sign' WHEN c_custkey % 31 = 0 THEN NULL ELSE concat(lower(c_name), '@example.com') END",
                "first_name": "CASE WHEN c_custkey % 37 = 0 THEN NULL ELSE c_mktsegment END",
                "last_name": "c_name",
                "phone": "CASE WHEN c_custkey % 41 = 0 THEN NULL ELSE concat('+', CAST(c_custkey AS VARCHAR(20))) END",
                "status": "'ACTIVE'",
                "created_at": f"CASE WHEN c_custkey % 101 = 0 THEN NULL ELSE {_T1} END",
                "updated_at": _T1,
            }),
            Image(2, {
                "customer_id": "c_custkey", "email": "concat(lower(c_name), '@example.org')",
                "first_name": "c_mktsegment", "last_name": "c_name",
                "phone": "concat('+', CAST(c_custkey AS VARCHAR(20)))", "status": "'ACTIVE'",
                "created_at": _T1, "updated_at": _T2,
            }, "c_custkey % 4 = 0"),
        ),
    ),
    "addresses": Feed(
        tables=("customer", "nation", "region"),
        base=_GEO,
        images=(
            Image(1, {
                "address_id": "c_custkey",
                "customer_id": "CASE WHEN c_custkey % 43 = 0 THEN NULL ELSE c_custkey END",
                "type": "'SHIPPING'",
                "street": "CASE WHEN c_custkey % 47 = 0 THEN NULL ELSE concat(CAST(c_custkey AS VARCHAR(20)), ' Main St') END",
                "city": "CASE WHEN c_custkey % 53 = 0 THEN NULL ELSE n_name END",
                "postal_code": "CAST(10000 + c_custkey AS VARCHAR(20))",
                "country": "CASE WHEN c_custkey % 59 = 0 THEN NULL ELSE r_name END",
                "is_default": "c_custkey % 5 <> 0",
                "created_at": f"CASE WHEN c_custkey % 101 = 0 THEN NULL ELSE {_T1} END",
                "updated_at": _T1,
            }),
            Image(2, {
                "address_id": "c_custkey", "customer_id": "c_custkey", "type": "'SHIPPING'",
                "street": "concat(CAST(c_custkey AS VARCHAR(20)), ' New St')", "city": "n_name",
                "postal_code": "CAST(10000 + c_custkey AS VARCHAR(20))", "country": "r_name",
                "is_default": "true", "created_at": _T1, "updated_at": _T2,
            }, "c_custkey % 6 = 0"),
        ),
    ),
}


def _emit(spark: SparkSession, sf_dir: str, entity: str, batches: tuple[int, ...], shape) -> DataFrame:
    """All images of the feed from one scan of its tables; ``shape`` gives an image's columns.

    The images leave through a generator, which also keeps the optimizer from evaluating a record
    anew in every filter above: consumers see a column that is read, as from a stored table.
    """
    feed = FEEDS[entity]
    images = [i for i in feed.images if not batches or i.batch in batches]
    base = feed.base
    tables = {}
    for t in feed.tables:
        base = base.replace(t, f"{{{t}}} AS {t}", 1)
        tables[t] = spark.read.parquet(f"{sf_dir}/{t}.parquet")
    rows = spark.sql(f"SELECT * FROM {base}", **tables)
    if len(images) == 1 and images[0].where:
        rows = rows.where(images[0].where)
        parts = [F.struct(*shape(images[0]))]
    else:
        parts = [
            F.when(F.expr(i.where), F.struct(*shape(i))) if i.where else F.struct(*shape(i))
            for i in images
        ]
    emitted = F.array(*parts)
    if any(i.where for i in images):
        emitted = F.filter(emitted, lambda r: r.isNotNull())
    return rows.select(F.inline(emitted))


def _typed(entity: str, image: Image) -> list:
    return [
        F.expr(image.columns[n].format(ts="timestamp_ntz")).cast(KINDS[k][1]).alias(n)
        for n, k in ENTITIES[entity].fields
    ]


def _json(entity: str, image: Image):
    """The record as JSON text: NULL fields are left out, money and timestamps are strings."""
    kinds = dict(ENTITIES[entity].fields)
    record = F.struct(*(
        c.cast("string").alias(n) if kinds[n] in ("money", "timestamp") else c
        for n, c in zip(kinds, _typed(entity, image), strict=True)
    ))
    return F.to_json(record, {"ignoreNullFields": "true"})


def _lineage(image: Image) -> list:
    return [F.lit(image.file).alias("source_file"), F.lit(image.batch).alias("batch_id")]


def typed_feed(spark: SparkSession, sf_dir: str, entity: str, *batches: int) -> DataFrame:
    """The feed with typed columns, ``source_file`` and ``batch_id``."""
    return _emit(
        spark, sf_dir, entity, batches, lambda i: [*_typed(entity, i), *_lineage(i)]
    )


def json_feed(spark: SparkSession, sf_dir: str, entity: str, *batches: int) -> DataFrame:
    """The feed as lines of JSON text."""
    return _emit(
        spark, sf_dir, entity, batches, lambda i: [_json(entity, i).alias("value"), *_lineage(i)]
    )


def bronze_feed(spark: SparkSession, sf_dir: str, entity: str, *batches: int) -> DataFrame:
    """The feed as bronze rows: variant payload, load time of its batch, lineage."""
    return _emit(
        spark,
        sf_dir,
        entity,
        batches,
        lambda i: [
            F.parse_json(_json(entity, i)).alias("payload"),
            ntz(LOAD_TS[i.batch]).alias("ingestion_ts"),
            *_lineage(i),
        ],
    )

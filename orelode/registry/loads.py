"""Queries that land files and run the incremental loads on shared scratch storage."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orelode.functions.dates import ntz
from orelode.operators.changes import BATCH, net_changes
from orelode.operators.merge import ACTION, MergeRule, merge_changes
from orelode.plans.audit import Step, observe_actions, observe_verdicts
from orelode.plans.silver import silver_source
from orelode.registry.layers import Layers, ts
from orelode.sources.bronze import BRONZE_SCHEMA, read_raw
from orelode.sources.feeds import LOAD_TS, bronze_feed, json_feed
from orelode.sources.paths import compact_write, scratch_dir
from orelode.specs import DIM_CUSTOMERS, DIM_PRODUCTS, DIMENSIONS, ENTITIES, FACTS, ORDERS
from orelode.streaming.medallion import Medallion, Options

BATCHES = (1, 2)
#: Keys of one array file: the files' number grows with the table, their size does not.
FILE_KEYS = 10_000


#: Lines of a compressed file, which is read by one task.
GZIP_LINES = 1_000_000


def _land(spark: SparkSession, d: str, entity: str, batch: int, landing: str, compact: bool = False) -> None:
    out = json_feed(spark, d, entity, batch).select("value").write.mode("append")
    if compact:
        out = out.option("compression", "gzip").option("maxRecordsPerFile", GZIP_LINES)
    out.text(f"{landing}/{ENTITIES[entity].path}")


def bronze_scan(spark: SparkSession, d: str) -> DataFrame:
    """Orders written as JSON lines and read back as variant rows."""
    landing = scratch_dir(spark, "scan")
    for batch in BATCHES:
        _land(spark, d, "orders", batch, landing)
    raw = read_raw(spark, f"{landing}/{ORDERS.path}")
    return raw.select(
        F.expr("variant_get(payload, '$.order_id', 'bigint')").alias("order_id"),
        F.expr("variant_get(payload, '$.order_status', 'string')").alias("order_status"),
        F.expr("variant_get(payload, '$.order_total_amount', 'string')").alias("order_total_amount"),
        F.col("source_file").contains(ORDERS.path).alias("has_file"),
    )


def bronze_scan_array(spark: SparkSession, d: str) -> DataFrame:
    """Orders as one-line arrays, as indented arrays and as lines, read alike by the default layout."""
    landing = scratch_dir(spark, "arrays")
    record = json_feed(spark, d, "orders").select(
        "value", F.floor(F.get_json_object("value", "$.order_id").cast("bigint") / FILE_KEYS).alias("part")
    )
    one = record.groupBy("part").agg(F.collect_list("value").alias("records"))
    indented = F.transform("records", lambda r: F.regexp_replace(r, r'([{,])"', '$1\n    "'))
    forms = {
        "one line": one.select(F.concat(F.lit("["), F.array_join("records", ","), F.lit("]"))),
        "indented": one.select(F.concat(F.lit("[\n  "), F.array_join(indented, ",\n  "), F.lit("\n]"))),
        "lines": record.select("value"),
    }
    parts = []
    for form, text in forms.items():
        # One record of text per file, as an array file is one value.
        out = text.toDF("value")
        folder = f"{landing}/{form.replace(' ', '_')}"
        out.write.option("maxRecordsPerFile", 0 if form == "lines" else 1).text(folder)
        ids = read_raw(spark, folder).select(
            F.expr("variant_get(payload, '$.order_id', 'bigint')").alias("order_id")
        )
        parts.append(ids.agg(
            F.count("order_id").alias("n"), F.sum("order_id").alias("ids"),
            F.count_distinct("order_id").alias("orders"),
        ).withColumn("form", F.lit(form)))
    return reduce(DataFrame.unionByName, parts)


def bronze_bad_records(spark: SparkSession, d: str) -> DataFrame:
    """Order lines of which some are cut short, doubled, or followed by text: readable and unreadable."""
    landing = scratch_dir(spark, "bad")
    lines = json_feed(spark, d, "orders")
    kind = F.get_json_object("value", "$.order_id").cast("bigint") % 50
    value = F.col("value")
    lines.select(
        F.when(kind == 0, F.expr("substring(value, 1, length(value) - 1)"))
        .when(kind == 1, F.concat(value, value))
        .when(kind == 2, F.concat(value, F.lit(" oops")))
        .when(kind == 3, F.concat(value, F.lit("] oops")))
        .otherwise(value).alias("value")
    ).write.text(f"{landing}/{ORDERS.path}")
    raw = read_raw(spark, f"{landing}/{ORDERS.path}")
    return raw.groupBy(F.col("payload").isNull().alias("is_bad")).agg(F.count(F.lit(1)).alias("n"))


def bronze_incremental(spark: SparkSession, d: str) -> DataFrame:
    """Two landings and three loads: the second load sees only new files, the third nothing."""
    root = scratch_dir(spark, "incremental")
    m = Medallion(spark, root)
    for batch in BATCHES:
        _land(spark, d, "orders", batch, m.landing)
        m.load_bronze(f"run-{batch}", LOAD_TS[batch])
    m.load_bronze("run-3", "2001-01-01 00:00:00")
    return m.bronze("orders").groupBy("ingestion_ts").agg(F.count(F.lit(1)).alias("n"))


def _bronze_batch(spark: SparkSession, d: str, m: Medallion, entity: str, batch: int) -> None:
    rows = bronze_feed(spark, d, entity, batch).select("payload", "ingestion_ts", "source_file")
    compact_write(rows).parquet(f"{m.bronze_path(entity)}/{BATCH}={batch - 1}")


def _silver_batches(
    spark: SparkSession, d: str, name: str, retry: bool, options: Options = Options()
) -> DataFrame:
    m = Medallion(spark, scratch_dir(spark, name), options=options)
    for batch in BATCHES:
        _bronze_batch(spark, d, m, "orders", batch)
        m.load_entity("orders", f"run-{batch}", LOAD_TS[batch])
        if retry:
            again = spark.read.schema(BRONZE_SCHEMA).parquet(f"{m.bronze_path('orders')}/{BATCH}={batch - 1}")
            m.silver_batch(ORDERS, Step(), f"run-{batch}", LOAD_TS[batch])(again, batch - 1)
    errors = m.dq_errors("orders").groupBy("record_key").agg(F.count(F.lit(1)).alias("dq_errors"))
    state = m.silver("orders").state()
    return state.join(
        errors.withColumn("order_id", F.col("record_key").cast("bigint")).drop("record_key"),
        "order_id",
        "left",
    )


def stream_silver_orders(spark: SparkSession, d: str) -> DataFrame:
    """Silver orders after two micro-batches, with the quarantined records per order."""
    return _silver_batches(spark, d, "stream", retry=False)


def stream_retry_idempotent(spark: SparkSession, d: str) -> DataFrame:
    """The same with every micro-batch run twice: nothing may change."""
    return _silver_batches(spark, d, "retry", retry=True)


def change_feed_net(spark: SparkSession, d: str) -> DataFrame:
    """The order feed of both batches collapsed to the last image per order."""
    layers = Layers(spark, d)
    feed = layers.changes("orders", 1).withColumn(BATCH, F.lit(0)).unionByName(
        layers.changes("orders", 2).withColumn(BATCH, F.lit(1))
    )
    return net_changes(feed, ORDERS.key)


def audit_counts(spark: SparkSession, d: str) -> DataFrame:
    """Counts of every load of every entity, observed on the write itself."""
    layers = Layers(spark, d)

    def one(name: str, batch: int) -> tuple:
        spec = ENTITIES[name]
        tagged, verdicts = observe_verdicts(layers.tagged(name, batch), f"audit_dq_{name}_{batch}")
        source = silver_source(tagged, spec)
        if batch == 1:
            target = source.limit(0)
        else:
            target = layers.silver(name, 1).drop(ACTION)
        changes = merge_changes(target, source, MergeRule.for_entity(spec), ts(batch))
        changes, actions = observe_actions(changes, f"audit_merge_{name}_{batch}")
        compact_write(changes).parquet(scratch_dir(spark, f"audit-{name}-{batch}"))
        v, a = verdicts.get, actions.get
        counts = v["read"], v["rejected"], v["accepted"], v["undecided"], a["inserted"], a["updated"]
        return name, batch, *counts

    tasks = [(e, b) for e in ENTITIES for b in BATCHES if b == 1 or layers.has_second(e)]
    with ThreadPoolExecutor(4) as pool:
        rows = list(pool.map(lambda t: one(*t), tasks))
    return spark.createDataFrame(
        rows,
        "entity string, batch int, read bigint, rejected bigint, accepted bigint, undecided bigint, "
        "inserted bigint, updated bigint",
    )


def _records(m: Medallion, entity: str, batch: int, rows: DataFrame) -> None:
    """A bronze batch of the given rows, dealt out first: a table's one small file would be one task's work."""
    record = F.parse_json(F.to_json(F.struct(*rows.columns)))
    rows.repartition(*rows.columns).select(
        F.explode(F.array(record)).alias("payload"), ntz(LOAD_TS[1]).alias("ingestion_ts"),
        F.lit(f"b{batch}/a.json").alias("source_file"),
    ).write.mode("overwrite").parquet(f"{m.bronze_path(entity)}/{BATCH}={batch}")


def _constant(rows: DataFrame, **values: str) -> DataFrame:
    return rows.withColumns({n: F.lit(v) for n, v in values.items()})


def moved_addresses(spark: SparkSession, d: str) -> DataFrame:
    """Every address leaves its customer; then some profiles change: no old street may come back."""
    m = Medallion(spark, scratch_dir(spark, "moved"))
    ids = spark.read.parquet(f"{d}/customer.parquet").select(F.col("c_custkey").alias("customer_id"))

    def profiles(phone: str, at: str) -> DataFrame:
        return _constant(
            ids, email="a@example.com", first_name="First", last_name="Last", phone=phone,
            status="ACTIVE", created_at=at, updated_at=at,
        )

    def homes(owner: Column, city: str, at: str) -> DataFrame:
        own = ids.select(
            F.col("customer_id").alias("address_id"), owner.alias("customer_id"),
            F.concat(F.col("customer_id").cast("string"), F.lit(" Main St")).alias("street"),
            F.lit(True).alias("is_default"),
        )
        return _constant(
            own, type="SHIPPING", city=city, postal_code="1", country="Land", created_at=at, updated_at=at
        )

    t1, t2, t3 = (f"199{y}-01-01 00:00:00" for y in (5, 6, 7))
    runs = (
        (t1, {"customers": profiles("+1", t1), "addresses": homes(F.col("customer_id"), "City", t1)}),
        (t2, {"addresses": homes(-F.col("customer_id") - 2, "Elsewhere", t2)}),
        (t3, {"customers": profiles("+2", t3).where("customer_id % 3 = 0")}),
    )
    for n, (at, feeds) in enumerate(runs):
        for entity, rows in feeds.items():
            _records(m, entity, n, rows)
            m.load_entity(entity, f"run-{n}", at)
        m.load_dim(DIM_CUSTOMERS.name, f"run-{n}", at)
    return m.gold(DIM_CUSTOMERS.name).state().where("customer_id >= 0").select(
        "customer_id", "phone", "street", "is_current"
    )


def late_products(spark: SparkSession, d: str) -> DataFrame:
    """A change older than the current version comes last: the versions stay disjoint."""
    m = Medallion(spark, scratch_dir(spark, "late"))
    parts = spark.read.parquet(f"{d}/part.parquet")
    for n, (name, month) in enumerate((("first", 1), ("second", 3), ("late", 2))):
        at = f"1995-0{month}-01 00:00:00"
        rows = parts.select(F.col("p_partkey").alias("product_id"), F.col("p_type").alias("category"))
        _records(m, "products", n, _constant(
            rows, name=name, brand="Brand", price="1.00", currency="EUR", status="ACTIVE",
            created_at=at, updated_at=at,
        ))
        m.load_entity("products", f"run-{n}", LOAD_TS[1])
        m.load_dim(DIM_PRODUCTS.name, f"run-{n}", LOAD_TS[1])
    return m.gold(DIM_PRODUCTS.name).state().where("product_id >= 0").select(
        "product_id", "name", "valid_from", "valid_to"
    )


def run_both_loads(spark: SparkSession, d: str, root: str) -> Medallion:
    """Land both batches of all eight feeds and run the three layers after each."""
    m = Medallion(spark, root)
    layers = Layers(spark, d)
    for batch in BATCHES:
        landing = [e for e in ENTITIES if batch == 1 or layers.has_second(e)]
        with ThreadPoolExecutor(len(landing)) as pool:
            # Most of what the loads keep on disk would be this text.
            list(pool.map(lambda e: _land(spark, d, e, batch, m.landing, compact=True), landing))  # noqa: B023
        m.run(f"run-{batch}", LOAD_TS[batch])
    return m


def medallion_end_to_end(spark: SparkSession, d: str) -> DataFrame:
    """All tables after two runs from JSON files to facts: rows, and how many found a customer."""
    m = run_both_loads(spark, d, scratch_dir(spark, "medallion"))
    none = F.lit(None).cast("bigint")
    parts = []
    for e in ENTITIES:
        parts.append(m.silver(e).state().agg(F.count(F.lit(1)).alias("n"), none.alias("known"))
                     .withColumn("table_name", F.lit(f"silver.{e}")))
        parts.append(m.dq_errors(e).agg(F.count(F.lit(1)).alias("n"), none.alias("known"))
                     .withColumn("table_name", F.lit(f"dq_errors.{e}")))
    for t in DIMENSIONS:
        parts.append(m.gold(t).state().agg(
            F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("is_current"), 1)).alias("known")
        ).withColumn("table_name", F.lit(f"gold.{t}")))
    for t in FACTS:
        df = m.gold(t).state()
        known = F.count(F.when(F.col("customer_key") != -1, 1)) if "customer_key" in df.columns else none
        parts.append(df.agg(F.count(F.lit(1)).alias("n"), known.alias("known"))
                     .withColumn("table_name", F.lit(f"gold.{t}")))
    return reduce(DataFrame.unionByName, parts)

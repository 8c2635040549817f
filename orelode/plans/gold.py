"""Sources of the dimensions and facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orelode.functions.dates import date_key, date_key_or_unknown, days_between
from orelode.functions.hashing import change_hash
from orelode.operators.lookup import pit_lookup
from orelode.specs import DIM_CUSTOMERS, DIM_PRODUCTS, FACTS, UNKNOWN_KEY, FactSpec

DIM_DATE_START = "2000-01-01"
DIM_DATE_DAYS = 20000


_ORDER_SIDE = ("order_id", "customer_id", "created_at", "currency")
#: The silver columns that the sources of the facts read, beside the dimensions.
FACT_READS: dict[str, dict[str, tuple[str, ...]]] = {
    "fact_orders": {"orders": (
        "order_id", "customer_id", "order_status", "order_total_amount", "currency", "created_at", "create_date",
        "updated_at",
    )},
    "fact_sales": {
        "order_items": (
            "order_item_id", "order_id", "product_id", "quantity", "unit_price", "created_at", "create_date",
        ),
        "orders": _ORDER_SIDE,
    },
    "fact_shipments": {
        "shipments": (
            "shipment_id", "order_id", "carrier", "shipment_status", "shipped_at", "ship_date", "delivered_at",
            "delivery_date", "updated_at",
        ),
        "orders": _ORDER_SIDE,
    },
    "fact_payments": {
        "payments": (
            "payment_id", "order_id", "provider", "payment_status", "amount", "created_at", "create_date",
        ),
        "orders": _ORDER_SIDE,
    },
    "fact_order_status_history": {
        "order_status_history": ("status_history_id", "order_id", "status", "changed_at"),
    },
}


def dim_date(spark: SparkSession, start: str = DIM_DATE_START, days: int = DIM_DATE_DAYS) -> DataFrame:
    """One row per day, a pure function of the range."""
    d = F.col("date_value")
    iso_day = F.weekday(d) + 1
    return (
        spark.range(days)
        .select(F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("date_value"))
        .select(
            date_key(d).alias("date_key"),
            d,
            F.dayofmonth(d).alias("day_num"),
            F.date_format(d, "EEEE").alias("day_name"),
            F.dayname(d).alias("day_name_short"),
            iso_day.alias("day_of_week"),
            F.dayofyear(d).alias("day_of_year"),
            F.weekofyear(d).alias("week_of_year"),
            F.month(d).alias("month_num"),
            F.date_format(d, "MMMM").alias("month_name"),
            F.monthname(d).alias("month_name_short"),
            F.quarter(d).alias("quarter"),
            F.year(d).alias("year"),
            F.date_format(d, "yyyy-MM").alias("year_month"),
            iso_day.isin(6, 7).alias("is_weekend"),
            (d == F.last_day(d)).alias("is_last_day_of_month"),
            F.datediff(d, F.lit("1970-01-01").cast("date")).alias("epoch_days"),
        )
    )


def product_source(changes: DataFrame) -> DataFrame:
    """Changed products; a version is valid from the source's own update time."""
    attrs = [a for a, _ in DIM_PRODUCTS.attributes]
    return changes.select(
        "product_id", *attrs, "hash_value", F.col("updated_at").alias("valid_from")
    )


def changed_customer_ids(customers: DataFrame, addresses: DataFrame) -> DataFrame:
    """Customers whose profile or address changed, each once."""
    return customers.select("customer_id").union(addresses.select("customer_id")).distinct()


def customer_source(
    customers: DataFrame,
    addresses: DataFrame,
    changed_ids: DataFrame,
    load_ts: Column,
    one_default: bool = False,
) -> DataFrame:
    """The full current record of the changed customers with their default address.

    A version is valid from the load. Missing address parts show as Unknown but hash as empty. A
    customer with two default addresses comes out twice, which the duplicate guard reports;
    ``one_default`` keeps the one updated last instead.
    """
    profile = ("email", "first_name", "last_name", "phone", "status")
    address = {
        "city": "city", "country": "country", "postal_code": "postal_code", "street": "street",
        "address_type": "type",
    }
    default = addresses.where(F.col("is_default"))
    if one_default:
        newest = Window.partitionBy("customer_id").orderBy(
            F.col("updated_at").desc_nulls_first(), F.col("address_id").desc_nulls_first()
        )
        default = default.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") == 1)
    default = default.select(
        F.col("customer_id").alias("_a_customer"),
        *(F.col(c).alias(f"_a_{n}") for n, c in address.items()),
    )
    joined = customers.join(changed_ids, "customer_id", "left_semi").join(
        default, F.col("customer_id") == F.col("_a_customer"), "left"
    )
    empty = F.lit("")
    return joined.select(
        "customer_id",
        *profile,
        *(F.coalesce(F.col(f"_a_{n}"), F.lit("Unknown")).alias(n) for n in address),
        change_hash(
            *(F.coalesce(F.col(c), empty) for c in profile),
            *(F.coalesce(F.col(f"_a_{n}"), empty) for n in address),
        ).alias("hash_value"),
        load_ts.alias("valid_from"),
    )


def _with_order(changes: DataFrame, orders: DataFrame) -> DataFrame:
    side = orders.select(
        F.col("order_id").alias("_o_id"),
        F.col("customer_id").alias("_o_customer"),
        F.col("created_at").alias("_o_created"),
    )
    return changes.join(side, F.col("order_id") == F.col("_o_id"), "left")


def orders_source(changes: DataFrame, dim_customers: DataFrame) -> DataFrame:
    return pit_lookup(changes, dim_customers, DIM_CUSTOMERS, "customer_id", "created_at").withColumn(
        "order_date_key", date_key(F.col("create_date"))
    )


def sales_source(
    changes: DataFrame, orders: DataFrame, dim_products: DataFrame, dim_customers: DataFrame
) -> DataFrame:
    """Items priced as sold: the product as of the item, the customer as of the order.

    The customer depends on the order alone, so it is looked up per order, before the items, which
    are several times as many, meet the orders. The items never move by customer.
    """
    bought = pit_lookup(orders, dim_customers, DIM_CUSTOMERS, "customer_id", "created_at").select(
        F.col("order_id").alias("_o_id"),
        F.col("currency").alias("_o_currency"),
        F.col("customer_key").alias("_o_customer_key"),
    )
    rows = changes.join(bought, F.col("order_id") == F.col("_o_id"), "left")
    rows = pit_lookup(rows, dim_products, DIM_PRODUCTS, "product_id", "created_at")
    return rows.withColumns({
        "customer_key": F.coalesce(F.col("_o_customer_key"), F.lit(UNKNOWN_KEY).cast("bigint")),
        "order_date_key": date_key(F.col("create_date")),
        "total_line_amount": (F.col("quantity") * F.col("unit_price")).cast("decimal(18,2)"),
        "currency": F.col("_o_currency"),
    })


def shipments_source(changes: DataFrame, orders: DataFrame, dim_customers: DataFrame) -> DataFrame:
    rows = pit_lookup(
        _with_order(changes, orders), dim_customers, DIM_CUSTOMERS, "_o_customer", "updated_at"
    )
    return rows.withColumns({
        "ship_date_key": date_key_or_unknown(F.col("ship_date")),
        "delivery_date_key": date_key_or_unknown(F.col("delivery_date")),
        "days_to_ship": days_between(F.col("_o_created"), F.col("shipped_at")),
        "days_to_deliver": days_between(F.col("shipped_at"), F.col("delivered_at")),
    })


def payments_source(changes: DataFrame, orders: DataFrame, dim_customers: DataFrame) -> DataFrame:
    rows = pit_lookup(
        _with_order(changes, orders), dim_customers, DIM_CUSTOMERS, "_o_customer", "created_at"
    )
    return rows.withColumn("date_key", date_key(F.col("create_date")))


def status_history_source(changes: DataFrame) -> DataFrame:
    return changes.withColumns({
        "date_key": date_key(F.col("changed_at")),
        "changed_at_ts": F.col("changed_at"),
    })


def fact_source(
    name: str,
    changes: DataFrame,
    orders: DataFrame | None = None,
    dim_products: DataFrame | None = None,
    dim_customers: DataFrame | None = None,
) -> DataFrame:
    """The merge source of a fact, without its surrogate key."""
    spec: FactSpec = FACTS[name]
    if name == "fact_orders":
        rows = orders_source(changes, dim_customers)
    elif name == "fact_sales":
        rows = sales_source(changes, orders, dim_products, dim_customers)
    elif name == "fact_shipments":
        rows = shipments_source(changes, orders, dim_customers)
    elif name == "fact_payments":
        rows = payments_source(changes, orders, dim_customers)
    else:
        rows = status_history_source(changes)
    return rows.select(spec.key, *(m for m, _ in spec.measures))

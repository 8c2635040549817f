"""Reporting views and marts over the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orelode.functions.masking import mask_columns
from orelode.specs import DIM_CUSTOMERS

VIEWS = (
    "dim_customers", "dim_products", "fact_orders", "fact_sales", "fact_payments", "fact_shipments",
    "fact_order_status_history",
)


def publish_views(tables: dict[str, DataFrame], role: str) -> dict[str, DataFrame]:
    """Register ``v_<table>`` for each given table; personal data shows to privileged roles only."""
    published = {}
    for name in VIEWS:
        if name in tables:
            df = tables[name]
            if name == DIM_CUSTOMERS.name:
                df = mask_columns(df, role)
            df.createOrReplaceTempView(f"v_{name}")
            published[f"v_{name}"] = df
    return published


def revenue_by_month(fact_sales: DataFrame, dim_products: DataFrame) -> DataFrame:
    """Revenue per month and category. Sums per product key first, so the join sees few rows."""
    per_key = fact_sales.groupBy(
        "product_key", F.floor(F.col("order_date_key") / 100).cast("bigint").alias("month_key")
    ).agg(
        F.sum("total_line_amount").alias("revenue"),
        F.sum("quantity").alias("units"),
        F.count(F.lit(1)).alias("lines"),
    )
    category = dim_products.select("product_key", "category")
    return (
        per_key.join(category, "product_key", "left")
        .groupBy("month_key", "category")
        .agg(
            F.sum("revenue").cast("decimal(38,2)").alias("revenue"),
            F.sum("units").cast("bigint").alias("units"),
            F.sum("lines").alias("lines"),
        )
    )


def shipping_by_carrier(fact_shipments: DataFrame) -> DataFrame:
    """Shipping speed per carrier and status; negative days are kept as they are."""
    return fact_shipments.groupBy("carrier", "shipment_status").agg(
        F.count(F.lit(1)).alias("shipments"),
        F.sum("days_to_ship").alias("sum_days_to_ship"),
        F.sum("days_to_deliver").alias("sum_days_to_deliver"),
        F.round(F.avg("days_to_ship"), 4).alias("avg_days_to_ship"),
        F.round(F.avg("days_to_deliver"), 4).alias("avg_days_to_deliver"),
    )


def orders_by_status(fact_orders: DataFrame) -> DataFrame:
    return fact_orders.groupBy("order_status", "currency").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("order_total_amount").cast("decimal(38,2)").alias("amount"),
    )

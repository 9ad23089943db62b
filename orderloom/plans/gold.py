"""Gold: five dimensions and two facts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import is_weekend, payment_label

# The calendar's first day and the day after its last.
CALENDAR_START = dt.date(2016, 1, 1)
CALENDAR_END = dt.date(2019, 1, 1)


def dim_customer(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
    )


def dim_product(products: DataFrame) -> DataFrame:
    return products.select(
        "product_id",
        "product_category_name",
        "product_category_name_english",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    )


def dim_seller(sellers: DataFrame) -> DataFrame:
    return sellers.select("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state")


def dim_payment_type(payments: DataFrame) -> DataFrame:
    """Types seen in any payment, whether or not its order has lines. The ``unknown`` of orders
    without a payment is not among them."""
    types = payments.select("payment_type").distinct()
    return types.withColumn("payment_type_label", payment_label("payment_type"))


def calendar_bounds(
    spark: SparkSession, start: dt.date = CALENDAR_START, end: dt.date = CALENDAR_END
) -> DataFrame:
    return spark.range(1).select(F.lit(start).alias("start_day"), F.lit(end).alias("end_day"))


def order_years(orders: DataFrame) -> DataFrame:
    """Bounds of the whole calendar years the orders fall in, end exclusive."""
    span = orders.selectExpr(
        "min(cast(order_purchase_timestamp as date)) as first_day",
        "max(cast(order_purchase_timestamp as date)) as last_day",
    )
    return span.selectExpr(
        "trunc(first_day, 'year') as start_day",
        "add_months(trunc(last_day, 'year'), 12) as end_day",
    )


def dim_date(bounds: DataFrame) -> DataFrame:
    """One row per day from ``start_day`` up to, not including, ``end_day``."""
    through_end = "sequence(start_day, greatest(start_day, end_day), interval 1 day)"
    days = bounds.selectExpr(f"explode({through_end}) as date_key", "end_day").where(
        "date_key < end_day"
    )
    return days.select(
        "date_key",
        F.expr("cast(year(date_key) as bigint) as year_num"),
        F.expr("cast(month(date_key) as bigint) as month_num"),
        F.expr("cast(day(date_key) as bigint) as day_num"),
        F.expr("date_format(date_key, 'yyyy-MM') as year_month"),
        is_weekend("date_key").alias("is_weekend"),
    )


def fct_orders(enriched: DataFrame) -> DataFrame:
    """One row per order line."""
    return enriched.selectExpr(
        "order_line_id",
        "order_id",
        "order_date as date_key",
        "customer_id",
        "product_id",
        "seller_id",
        "primary_payment_type as payment_type",
        "order_status",
        "order_item_id",
        "order_item_count",
        "item_price",
        "freight_value",
        "gross_item_amount",
        "payment_total_value",
        "avg_review_score",
    )


def fct_daily_sales(fct_orders: DataFrame) -> DataFrame:
    """Sales per day and seller. The distinct count groups by order before it groups by day and
    seller, so neither a busy seller nor a huge order gathers in one task."""
    return fct_orders.groupBy("date_key", "seller_id").agg(
        F.expr("count(distinct order_id) as order_count"),
        F.expr("count(*) as line_count"),
        F.expr("sum(item_price) as item_sales"),
        F.expr("sum(freight_value) as freight_sales"),
        F.expr("sum(gross_item_amount) as gross_sales"),
    )

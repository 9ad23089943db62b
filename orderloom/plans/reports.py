"""Report queries over the gold tables.

Joins to a dimension come after a first aggregation on the join key, so what is shuffled is one row
per key and task instead of the fact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOP_CATEGORIES = 10


def kpi_summary(fct_orders: DataFrame) -> DataFrame:
    """Orders, lines, revenue and the mean over lines of their order's mean review."""
    return fct_orders.selectExpr(
        "count(distinct order_id) as total_orders",
        "count(*) as total_items",
        "sum(gross_item_amount) as total_revenue",
        "avg(avg_review_score) as avg_review",
    )


def daily_sales_trend(fct_daily_sales: DataFrame) -> DataFrame:
    """Sales per day. An order served by two sellers counts once for each of them."""
    return (
        fct_daily_sales.groupBy("date_key")
        .agg(
            F.expr("sum(gross_sales) as gross_sales"),
            F.expr("sum(order_count) as order_count"),
        )
        .orderBy("date_key")
    )


def payment_mix(fct_orders: DataFrame, dim_payment_type: DataFrame) -> DataFrame:
    """Lines per payment label; lines of type ``unknown`` have no label and drop out."""
    lines = fct_orders.groupBy("payment_type").agg(F.expr("count(*) as lines"))
    return (
        lines.join(dim_payment_type, "payment_type")
        .groupBy(F.expr("payment_type_label as payment_type"))
        .agg(F.sum("lines").alias("cnt"))
        .orderBy(F.desc("cnt"), "payment_type")
    )


def top_categories(fct_orders: DataFrame, dim_product: DataFrame) -> DataFrame:
    """The ten categories with the highest revenue."""
    sales = fct_orders.groupBy("product_id").agg(F.sum("gross_item_amount").alias("sales"))
    products = dim_product.selectExpr(
        "product_id", "coalesce(product_category_name_english, 'unknown') as category"
    )
    return (
        sales.join(products, "product_id")
        .groupBy("category")
        .agg(F.sum("sales").alias("revenue"))
        .orderBy(F.desc_nulls_last("revenue"), "category")
        .limit(TOP_CATEGORIES)
    )


def state_orders(fct_orders: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Distinct orders per customer state.

    Orders are made distinct per customer first: the shuffles by customer and by state then carry
    one row per order, and an order with very many lines has already shrunk to one.
    """
    orders = fct_orders.select("customer_id", "order_id").distinct()
    customers = dim_customer.selectExpr("customer_id", "customer_state as state")
    return (
        orders.join(customers, "customer_id")
        .groupBy("state")
        .agg(F.count_distinct("order_id").alias("orders"))
        .orderBy(F.desc("orders"), "state")
    )

"""Order-level facts and the enriched order line.

Payments, reviews and line counts describe an order, not a line: on the enriched line they repeat
and must not be summed over lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import top_type
from ..operators import frequent_keys, spread_join
from .staging import ORDER_COLUMNS, order_headers, order_items, with_line_columns

ENRICHED_COLUMNS = (
    *ORDER_COLUMNS,
    "order_item_count",
    "payment_total_value",
    "primary_payment_type",
    "avg_review_score",
)


def payment_totals(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(F.sum("payment_value").alias("payment_total_value"))


def payment_types(payments: DataFrame) -> DataFrame:
    """Paid amount per order and payment type."""
    return payments.groupBy("order_id", "payment_type").agg(
        F.sum("payment_value").alias("payment_type_value")
    )


def payment_type_ranks(payments: DataFrame) -> DataFrame:
    """Payment types of an order by amount, largest first, ties by name, NULLs last."""
    by_value = Window.partitionBy("order_id").orderBy(
        F.desc_nulls_last("payment_type_value"), F.asc_nulls_last("payment_type")
    )
    return payment_types(payments).withColumn("rn", F.row_number().over(by_value))


def primary_payment_types(payments: DataFrame) -> DataFrame:
    """The first of the ranks; each task keeps one row per order before the shuffle."""
    return (
        payment_type_ranks(payments)
        .where("rn = 1")
        .selectExpr("order_id", "payment_type as primary_payment_type")
    )


def payment_summary(payments: DataFrame) -> DataFrame:
    """Total and primary type in one aggregate over the amounts per type."""
    return (
        payment_types(payments)
        .groupBy("order_id")
        .agg(
            F.sum("payment_type_value").alias("payment_total_value"),
            top_type("payment_type_value", "payment_type").alias("primary_payment_type"),
        )
    )


def review_averages(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("order_id").agg(
        F.expr("avg(cast(review_score as double)) as avg_review_score")
    )


def item_counts(lines: DataFrame) -> DataFrame:
    """Lines per order, over joined order lines."""
    return lines.groupBy("order_id").agg(F.expr("count(*) as order_item_count"))


def line_counts(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Lines per order without joining first.

    An order yields items x headers lines, so both are counted in one aggregate; a repeated header
    then gives the same count as the joined lines would.
    """
    sides = items.selectExpr("order_id", "1 as item", "0 as header").unionAll(
        orders.selectExpr("order_id", "0 as item", "1 as header")
    )
    return sides.groupBy("order_id").agg(F.expr("sum(item) * sum(header) as order_item_count"))


def order_profiles(
    orders: DataFrame, items: DataFrame, payments: DataFrame, reviews: DataFrame
) -> DataFrame:
    """Order headers with their order-level facts.

    The joins happen here, on one row per order, so that the much longer order items are shuffled
    and joined once. Every joined side is an aggregate on order_id: a report that does not read one
    of the facts loses its join in the optimizer.
    """
    return (
        order_headers(orders)
        .join(payment_summary(payments), "order_id", "left")
        .join(review_averages(reviews), "order_id", "left")
        .join(line_counts(orders, items), "order_id", "left")
    )


def int_orders_enriched(
    orders: DataFrame, items: DataFrame, payments: DataFrame, reviews: DataFrame
) -> DataFrame:
    """Order lines with their order's payment total, main payment type, mean review and length.

    ``orders`` and ``items`` are raw, ``payments`` and ``reviews`` staged. An order with too many
    items for one task is divided; a sketch of the items tells which, so a plan that does not read the
    orders' lengths does not count them.
    """
    profiles = order_profiles(orders, items, payments, reviews)
    hot = frequent_keys(items, "order_id")
    lines = with_line_columns(spread_join(order_items(items), profiles, "order_id", hot))
    return lines.selectExpr(
        *ORDER_COLUMNS,
        "order_item_count",
        "coalesce(payment_total_value, 0d) as payment_total_value",
        "coalesce(primary_payment_type, 'unknown') as primary_payment_type",
        "avg_review_score",
    )

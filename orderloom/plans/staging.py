"""Staging: raw tables to typed columns, one function per model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import order_line_id, whole

ORDER_COLUMNS = (
    "order_line_id",
    "order_id",
    "customer_id",
    "seller_id",
    "order_purchase_ts",
    "order_date",
    "order_status",
    "product_id",
    "order_item_id",
    "item_price",
    "freight_value",
    "gross_item_amount",
)


def order_headers(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(
        "order_id",
        "customer_id",
        "cast(order_purchase_timestamp as timestamp_ntz) as order_purchase_ts",
        "cast(order_purchase_timestamp as date) as order_date",
        "order_status",
    )


def order_items(items: DataFrame) -> DataFrame:
    """What the join has to carry per item; the rest of the line is derived after it."""
    return items.selectExpr(
        "order_id",
        "order_item_id",
        "seller_id",
        "product_id",
        "cast(price as double) as item_price",
        "cast(freight_value as double) as freight_value",
    )


def with_line_columns(lines: DataFrame) -> DataFrame:
    """What is derived from joined order items."""
    return lines.withColumns(
        {
            "order_line_id": order_line_id("order_id", "order_item_id"),
            "order_item_id": whole(lines, "order_item_id"),
            "gross_item_amount": F.expr("item_price + freight_value"),
        }
    )


def stg_orders(orders: DataFrame, items: DataFrame) -> DataFrame:
    """One row per order line; orders without items and items without a header disappear.

    Both sides are bare shuffles, so adaptive execution divides an order with too many items. Both
    are unbounded, hence the hint.
    """
    lines = order_items(items).hint("merge").join(order_headers(orders), "order_id")
    return with_line_columns(lines).select(*ORDER_COLUMNS)


def stg_customers(customers: DataFrame) -> DataFrame:
    return customers.selectExpr(
        "customer_id",
        "customer_unique_id",
        "cast(customer_zip_code_prefix as string) as customer_zip_code_prefix",
        "customer_city",
        "customer_state",
    )


def stg_products(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Products with the English category, NULL where there is no translation.

    The join carries no hint: the optimizer broadcasts the translation when its size allows and
    shuffles otherwise, with adaptive splitting of a category that holds many products.
    """
    names = translation.select("product_category_name", "product_category_name_english")
    return products.join(names, "product_category_name", "left").select(
        "product_id",
        "product_category_name",
        "product_category_name_english",
        whole(products, "product_name_lenght").alias("product_name_length"),
        whole(products, "product_description_lenght").alias("product_description_length"),
        whole(products, "product_photos_qty").alias("product_photos_qty"),
        whole(products, "product_weight_g").alias("product_weight_g"),
        whole(products, "product_length_cm").alias("product_length_cm"),
        whole(products, "product_height_cm").alias("product_height_cm"),
        whole(products, "product_width_cm").alias("product_width_cm"),
    )


def stg_sellers(sellers: DataFrame) -> DataFrame:
    return sellers.selectExpr(
        "seller_id",
        "cast(seller_zip_code_prefix as string) as seller_zip_code_prefix",
        "seller_city",
        "seller_state",
    )


def stg_payments(payments: DataFrame) -> DataFrame:
    return payments.select(
        "order_id",
        whole(payments, "payment_sequential").alias("payment_sequential"),
        "payment_type",
        whole(payments, "payment_installments").alias("payment_installments"),
        F.expr("cast(payment_value as double) as payment_value"),
    )


def stg_reviews(reviews: DataFrame) -> DataFrame:
    return reviews.select(
        "review_id",
        "order_id",
        whole(reviews, "review_score").alias("review_score"),
        F.expr("cast(review_creation_date as date) as review_creation_date"),
        F.expr("cast(review_answer_timestamp as timestamp_ntz) as review_answer_ts"),
    )

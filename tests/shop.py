"""The sample shop and helpers to vary it."""

from __future__ import annotations

# The columns of the raw tables.
HEADERS = {
    "olist_orders": [
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ],
    "olist_order_items": [
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "shipping_limit_date",
        "price",
        "freight_value",
    ],
    "olist_order_payments": [
        "order_id",
        "payment_sequential",
        "payment_type",
        "payment_installments",
        "payment_value",
    ],
    "olist_order_reviews": [
        "review_id",
        "order_id",
        "review_score",
        "review_creation_date",
        "review_answer_timestamp",
    ],
    "olist_customers": [
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
    ],
    "olist_products": [
        "product_id",
        "product_category_name",
        "product_name_lenght",
        "product_description_lenght",
        "product_photos_qty",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    ],
    "olist_sellers": [
        "seller_id",
        "seller_zip_code_prefix",
        "seller_city",
        "seller_state",
    ],
    "product_category_name_translation": [
        "product_category_name",
        "product_category_name_english",
    ],
}

# The sample rows.
SAMPLE = {
    "olist_orders": [
        ("o1", "c1", "delivered", "2018-01-01 09:00:00", "2018-01-01 10:00:00",
         "2018-01-02 09:00:00", "2018-01-05 12:00:00", "2018-01-07 00:00:00"),
        ("o2", "c2", "delivered", "2018-01-03 11:00:00", "2018-01-03 11:15:00",
         "2018-01-04 08:00:00", "2018-01-08 15:00:00", "2018-01-09 00:00:00"),
        ("o3", "c3", "shipped", "2018-01-08 13:00:00", "2018-01-08 13:20:00",
         "2018-01-09 10:00:00", "", "2018-01-14 00:00:00"),
        ("o4", "c4", "canceled", "2018-01-10 17:00:00", "", "", "", "2018-01-15 00:00:00"),
    ],
    "olist_order_items": [
        ("o1", "1", "p1", "s1", "2018-01-03 00:00:00", "100.0", "15.0"),
        ("o1", "2", "p2", "s2", "2018-01-03 00:00:00", "50.0", "8.0"),
        ("o2", "1", "p3", "s3", "2018-01-05 00:00:00", "80.0", "10.0"),
        ("o3", "1", "p2", "s1", "2018-01-10 00:00:00", "120.0", "12.0"),
    ],
    "olist_order_payments": [
        ("o1", "1", "credit_card", "1", "165.0"),
        ("o2", "1", "voucher", "1", "90.0"),
        ("o3", "1", "credit_card", "2", "132.0"),
        ("o4", "1", "boleto", "1", "0.0"),
    ],
    "olist_order_reviews": [
        ("r1", "o1", "5", "2018-01-06", "2018-01-06 10:00:00"),
        ("r2", "o2", "4", "2018-01-10", "2018-01-10 11:00:00"),
        ("r3", "o3", "3", "2018-01-14", "2018-01-14 19:00:00"),
    ],
    "olist_customers": [
        ("c1", "u1", "1000", "sao paulo", "SP"),
        ("c2", "u2", "2000", "rio de janeiro", "RJ"),
        ("c3", "u3", "3000", "curitiba", "PR"),
        ("c4", "u4", "4000", "salvador", "BA"),
    ],
    "olist_products": [
        ("p1", "beleza_saude", "20", "100", "1", "500", "20", "10", "15"),
        ("p2", "informatica_acessorios", "24", "130", "2", "700", "30", "8", "18"),
        ("p3", "utilidades_domesticas", "16", "90", "1", "900", "25", "14", "20"),
    ],
    "olist_sellers": [
        ("s1", "1100", "sao paulo", "SP"),
        ("s2", "2200", "rio de janeiro", "RJ"),
        ("s3", "3300", "curitiba", "PR"),
    ],
    "product_category_name_translation": [
        ("beleza_saude", "health_beauty"),
        ("informatica_acessorios", "computers_accessories"),
        ("utilidades_domesticas", "housewares"),
    ],
}


def sample(**extra: list[tuple]) -> dict[str, list[tuple]]:
    """The sample with rows added to some tables."""
    return {table: rows + extra.get(table, []) for table, rows in SAMPLE.items()}


def frames(spark, rows: dict[str, list[tuple]]) -> dict:
    """Raw tables as all-text frames, empty text as NULL."""
    return {
        table: spark.createDataFrame(
            [tuple(None if v == "" else v for v in row) for row in values],
            ", ".join(f"{name} string" for name in HEADERS[table]),
        )
        for table, values in rows.items()
    }


def _field(value: str) -> str:
    """A CSV field, quoted if it has to be."""
    if any(mark in value for mark in ',"\n'):
        return '"' + value.replace('"', '""') + '"'
    return value


def write_csv(folder, rows: dict[str, list[tuple]], suffix: str = "") -> str:
    """The tables as CSV files of plain text; returns the folder."""
    for table in rows:
        lines = [",".join(map(_field, row)) for row in (HEADERS[table], *rows[table])]
        (folder / f"{table}{suffix}.csv").write_text("\n".join([*lines, ""]), encoding="utf-8")
    return str(folder)

"""The eight raw tables read off a TPC-H-like parquet directory.

Ids stay numbers, free columns are filled from whatever fits; the result has the raw column names,
so every model runs on it unchanged.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

# Payment type by line number modulo five.
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card", "not_defined")

# Four of the six part types have a translation.
TRANSLATIONS = (
    ("STANDARD", "standard goods"),
    ("ECONOMY", "economy goods"),
    ("LARGE", "large goods"),
    ("PROMO", "promotion goods"),
)

# Hours by which an event type's newest entry is moved back, to see every verdict.
EVENT_AGES = (("click", 12), ("signup", 25), ("view", 48), ("error", 73))


# The columns used of each table. Declared, so that opening a table reads no footers.
SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
    "o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_tax double, l_returnflag string, "
    "l_shipdate timestamp_ntz",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "nation": "n_nationkey int, n_name string",
    "events": "ts timestamp_ntz, event_type string",
}


def _check_columns(path: str, name: str, present: tuple[str, ...]) -> None:
    wanted = [column.split()[0] for column in SCHEMAS[name].split(", ")]
    absent = [column for column in wanted if column not in present]
    if absent:
        raise ValueError(f"{path} has no column {', '.join(absent)}")


@lru_cache(maxsize=256)
def _present(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Columns of a table by its footer, looked up once."""
    return tuple(spark.read.parquet(path).columns)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A declared schema would read an absent column as NULL, so its columns must be there."""
    path = f"{sf_dir}/{name}.parquet"
    _check_columns(path, name, _present(spark, path))
    return spark.read.schema(SCHEMAS[name]).parquet(path)


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as order_id",
        "o_custkey as customer_id",
        "o_orderstatus as order_status",
        "o_orderdate as order_purchase_timestamp",
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey as order_id",
        "l_linenumber as order_item_id",
        "l_partkey as product_id",
        "l_suppkey as seller_id",
        "l_shipdate as shipping_limit_date",
        "l_extendedprice as price",
        "l_quantity * l_tax as freight_value",
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = ", ".join(f"'{kind}'" for kind in PAYMENT_TYPES)
    return (
        _table(spark, sf_dir, "lineitem")
        .where("l_returnflag <> 'N'")
        .selectExpr(
            "l_orderkey as order_id",
            "l_linenumber as payment_sequential",
            f"elt(l_linenumber % 5 + 1, {kinds}) as payment_type",
            "1 as payment_installments",
            "l_quantity as payment_value",
        )
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _table(spark, sf_dir, "lineitem")
        .where("l_returnflag = 'R'")
        .selectExpr(
            "l_orderkey || '-' || l_linenumber as review_id",
            "l_orderkey as order_id",
            "1 + cast(l_quantity as int) % 5 as review_score",
            "l_shipdate as review_creation_date",
            "l_shipdate as review_answer_timestamp",
        )
    )


def _with_state(rows: DataFrame, nation_key: str, sf_dir: str) -> DataFrame:
    states = _table(rows.sparkSession, sf_dir, "nation")
    return rows.join(states.withColumnRenamed("n_nationkey", nation_key), nation_key, "left")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_state(_table(spark, sf_dir, "customer"), "c_nationkey", sf_dir).selectExpr(
        "c_custkey as customer_id",
        "c_name as customer_unique_id",
        "lpad(cast(c_custkey as string), 12, '0') as customer_zip_code_prefix",
        "c_mktsegment as customer_city",
        "n_name as customer_state",
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "part").selectExpr(
        "p_partkey as product_id",
        "p_type as product_category_name",
        "length(p_name) as product_name_lenght",
        "length(p_brand) as product_description_lenght",
        "p_size % 6 as product_photos_qty",
        "p_size as product_weight_g",
        "p_size + 10 as product_length_cm",
        "p_size + 2 as product_height_cm",
        "p_size + 5 as product_width_cm",
    )


def translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ", ".join(f"('{name}', '{english}')" for name, english in TRANSLATIONS)
    return spark.sql(
        f"select * from values {rows} as t(product_category_name, product_category_name_english)"
    )


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_state(_table(spark, sf_dir, "supplier"), "s_nationkey", sf_dir).selectExpr(
        "s_suppkey as seller_id",
        "lpad(cast(s_suppkey as string), 12, '0') as seller_zip_code_prefix",
        "s_name as seller_city",
        "n_name as seller_state",
    )


RAW_ROLES = {
    "olist_orders": orders,
    "olist_order_items": order_items,
    "olist_order_payments": payments,
    "olist_order_reviews": reviews,
    "olist_customers": customers,
    "olist_products": products,
    "olist_sellers": sellers,
    "product_category_name_translation": translation,
}


def loads(spark: SparkSession, sf_dir: str, aged: bool = True) -> DataFrame:
    """Events as load stamps: one source per event type, each set back by hours of its own if ``aged``."""
    ages = " ".join(f"when '{kind}' then {hours}" for kind, hours in EVENT_AGES)
    back = f"make_dt_interval(0, case event_type {ages} else 0 end)" if aged else "interval 0 hours"
    return _table(spark, sf_dir, "events").selectExpr(
        "event_type as table_name", f"cast(ts - {back} as timestamp) as _loaded_at"
    )

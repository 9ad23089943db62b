"""CSV tables of the shop export: where they are and how they are read."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from .csv_records import read_records

SOURCE_DIR_ENV = "ORDERLOOM_SOURCE_DIR"


@dataclass(frozen=True)
class CsvTable:
    """``multiline``: free text may hold line breaks. Such a file is read three times, so only the
    table that needs it is read that way."""

    name: str
    files: tuple[str, ...]
    multiline: bool = False


# Table names and the file names each may come under, first match wins.
RAW_TABLES = {
    "olist_orders": CsvTable(
        "olist_orders", ("olist_orders.csv", "olist_orders_dataset.csv")
    ),
    "olist_order_items": CsvTable(
        "olist_order_items", ("olist_order_items.csv", "olist_order_items_dataset.csv")
    ),
    "olist_order_payments": CsvTable(
        "olist_order_payments", ("olist_order_payments.csv", "olist_order_payments_dataset.csv")
    ),
    "olist_order_reviews": CsvTable(
        "olist_order_reviews",
        ("olist_order_reviews.csv", "olist_order_reviews_dataset.csv"),
        multiline=True,
    ),
    "olist_customers": CsvTable(
        "olist_customers", ("olist_customers.csv", "olist_customers_dataset.csv")
    ),
    "olist_products": CsvTable(
        "olist_products", ("olist_products.csv", "olist_products_dataset.csv")
    ),
    "olist_sellers": CsvTable(
        "olist_sellers", ("olist_sellers.csv", "olist_sellers_dataset.csv")
    ),
    "product_category_name_translation": CsvTable(
        "product_category_name_translation", ("product_category_name_translation.csv",)
    ),
}


def _found(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, in whatever store the session reads from."""
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def resolve_source_dir(spark: SparkSession, given: str | None = None, root: str = ".") -> str:
    """The folder of the CSV files: the given one, else the environment's, and only if neither is
    named the project's, of which ``common`` goes before ``raw``."""
    named = [folder for folder in (given, os.environ.get(SOURCE_DIR_ENV)) if folder]
    candidates = named[:1] or [f"{root}/data/{folder}" for folder in ("common", "raw")]
    for folder in candidates:
        if _found(spark, folder):
            return folder
    raise FileNotFoundError(f"no folder of CSV files; not found: {candidates}")


def read_csv(
    spark: SparkSession, path: str, multiline: bool = False, keep_bad: bool = False
) -> DataFrame:
    """All columns as text under their header names; an empty field is NULL. Types are not guessed,
    so zip codes keep their leading zeros, and staging reads columns by name.

    A row with more or fewer fields than the header stops the read; with ``keep_bad`` it stands in
    the columns ``csv_records.BAD`` instead. A line break inside quotes is such a row unless
    ``multiline`` is set. A file of the folder whose header differs from the first one's stops the
    read, but where records are put together (``multiline``, ``keep_bad``) its columns may stand in
    another order.
    """
    reader = spark.read.options(header=True, encoding="UTF-8", quote='"', escape='"')
    names = reader.csv(path).schema
    if multiline or keep_bad:
        return read_records(spark, path, names.names, multiline, keep_bad)
    strict = reader.options(enforceSchema=False, mode="FAILFAST", columnPruning=False)
    return strict.schema(names).csv(path)


def open_table(
    spark: SparkSession, table: str, source_dir: str, multiline: bool = False, keep_bad: bool = False
) -> tuple[DataFrame, str]:
    """A raw table and the path it was found at: the first of its file names that exists."""
    spec = RAW_TABLES[table]
    paths = [f"{source_dir.rstrip('/')}/{file}" for file in spec.files]
    for path in paths:
        if _found(spark, path):
            return read_csv(spark, path, multiline or spec.multiline, keep_bad), path
    raise FileNotFoundError(f"table {table}: no file in {source_dir}, looked for {', '.join(spec.files)}")

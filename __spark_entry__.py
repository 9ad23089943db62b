"""

The raw shop tables are read off the given parquet tables (orderloom/sources/warehouse_roles.py).
Double sums are rounded to cents and means to six places in the query and in the SQL, as the two
engines add in different orders.
"""

from __future__ import annotations

import datetime as dt
import sys
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import duckdb_queries  # noqa: E402
from orderloom.functions import whole  # noqa: E402
from orderloom.plans import build, gold, intermediate, quality, reports, staging  # noqa: E402
from orderloom.sources import ingest as loading  # noqa: E402
from orderloom.sources import warehouse_roles as roles  # noqa: E402
from orderloom.sources.csv_tables import read_csv  # noqa: E402
from orderloom.sources.shared import shared_path, write_measured, write_once  # noqa: E402

try:  # the training-data operators are a part that can be left out
    import corpus_pipeline
    from orderloom.llm import queries as llm
except ModuleNotFoundError as error:
    if error.name not in ("corpus_pipeline", "orderloom.llm"):  # a library that it needs is missing
        raise
    llm = None

FLAGSHIP_DIR = "/root/testdata/sf0.001"
AS_OF = "timestamp_ntz'2024-01-31 00:00:00'"
FRESH_AT = dt.datetime(2024, 1, 31, tzinfo=dt.timezone.utc)


def _rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({name: F.expr(f"round({name}, {digits})") for name in names})


# staging


def stg_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_orders(roles.orders(spark, sf_dir), roles.order_items(spark, sf_dir))


def stg_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_customers(roles.customers(spark, sf_dir))


def stg_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_products(roles.products(spark, sf_dir), roles.translation(spark, sf_dir))


def stg_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_sellers(roles.sellers(spark, sf_dir))


def stg_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_payments(roles.payments(spark, sf_dir))


def stg_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_reviews(roles.reviews(spark, sf_dir))


# intermediate


def int_payment_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = intermediate.payment_totals(stg_payments(spark, sf_dir))
    return _rounded(totals, 2, "payment_total_value")


def int_primary_payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intermediate.primary_payment_types(stg_payments(spark, sf_dir))


def int_payment_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = intermediate.payment_summary(stg_payments(spark, sf_dir))
    return _rounded(summary, 2, "payment_total_value")


def int_review_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(intermediate.review_averages(stg_reviews(spark, sf_dir)), 6, "avg_review_score")


def int_item_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intermediate.item_counts(stg_orders(spark, sf_dir))


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intermediate.int_orders_enriched(
        roles.orders(spark, sf_dir),
        roles.order_items(spark, sf_dir),
        stg_payments(spark, sf_dir),
        stg_reviews(spark, sf_dir),
    )


def int_orders_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    enriched = _rounded(_enriched(spark, sf_dir), 2, "payment_total_value")
    return _rounded(enriched, 6, "avg_review_score")


# gold


def dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_customer(stg_customers(spark, sf_dir))


def dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_product(stg_products(spark, sf_dir))


def dim_seller(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_seller(stg_sellers(spark, sf_dir))


def dim_payment_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_payment_type(stg_payments(spark, sf_dir))


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_date(gold.order_years(roles.orders(spark, sf_dir)))


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.fct_orders(_enriched(spark, sf_dir))


def fct_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = _rounded(_facts(spark, sf_dir), 2, "payment_total_value")
    return _rounded(facts, 6, "avg_review_score")


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.fct_daily_sales(_facts(spark, sf_dir))


def fct_daily_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_daily(spark, sf_dir), 2, "item_sales", "freight_sales", "gross_sales")


# reports


def kpi_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    kpi = _rounded(reports.kpi_summary(_facts(spark, sf_dir)), 2, "total_revenue")
    return _rounded(kpi, 6, "avg_review")


def daily_sales_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(reports.daily_sales_trend(_daily(spark, sf_dir)), 2, "gross_sales")


def payment_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.payment_mix(_facts(spark, sf_dir), dim_payment_type(spark, sf_dir))


def top_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = reports.top_categories(_facts(spark, sf_dir), dim_product(spark, sf_dir))
    return _rounded(top, 2, "revenue")


def state_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.state_orders(_facts(spark, sf_dir), dim_customer(spark, sf_dir))


# checks


def _tables(spark: SparkSession, sf_dir: str) -> quality.Tables:
    """All tables that checks read, as plans: a check that reads each once needs nothing written, and
    its plan computes no column and no join but those it reads."""
    tables = {
        "olist_orders": roles.orders(spark, sf_dir),
        "olist_customers": roles.customers(spark, sf_dir),
        "stg_orders": stg_orders(spark, sf_dir),
        "stg_customers": stg_customers(spark, sf_dir),
        "stg_products": stg_products(spark, sf_dir),
        "stg_sellers": stg_sellers(spark, sf_dir),
        "stg_payments": stg_payments(spark, sf_dir),
        "stg_reviews": stg_reviews(spark, sf_dir),
        "fct_orders": _facts(spark, sf_dir),
        "dim_date": dim_date(spark, sf_dir),
    }
    return _with_derived(tables)


def _with_derived(tables: quality.Tables) -> quality.Tables:
    """With the daily fact and the dimensions, which come from other tables."""
    return {
        "fct_daily_sales": gold.fct_daily_sales(tables["fct_orders"]),
        "dim_customer": gold.dim_customer(tables["stg_customers"]),
        "dim_product": gold.dim_product(tables["stg_products"]),
        "dim_seller": gold.dim_seller(tables["stg_sellers"]),
        "dim_payment_type": gold.dim_payment_type(tables["stg_payments"]),
        **tables,
    }


def _written(spark: SparkSession, sf_dir: str) -> tuple[quality.Tables, quality.Observed]:
    """The tables of the suite, those with a join or an aggregate written once, and what their
    row-level checks and totals counted while they were written."""
    tables = _tables(spark, sf_dir)

    def write(name: str) -> tuple:
        columns = set(quality.NOT_NULL[name]) | set(quality.ACCEPTED_RANGES.get(name, ()))
        if name == "fct_daily_sales":
            columns |= {"line_count"}
        rows = tables[name].select(*(c for c in tables[name].columns if c in columns))
        return write_measured(rows, name, quality.metrics(name))

    first = ["stg_orders", "stg_products", "fct_orders"]
    with ThreadPoolExecutor(len(first)) as pool:
        found = dict(zip(first, pool.map(write, first)))
    facts = found["fct_orders"][0]
    tables["fct_daily_sales"] = gold.fct_daily_sales(facts)
    found["fct_daily_sales"] = write("fct_daily_sales")
    written = {name: df for name, (df, _) in found.items()}
    return {**tables, **written}, {name: seen for name, (_, seen) in found.items()}


def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unique_suite(_tables(spark, sf_dir))


def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.not_null_suite(_tables(spark, sf_dir))


def dq_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.relationships_suite(_tables(spark, sf_dir))


def dq_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.accepted_values_suite({"stg_payments": stg_payments(spark, sf_dir)})


def dq_accepted_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.accepted_range_suite(_tables(spark, sf_dir))


def dq_unique_combination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unique_combination_suite({"fct_daily_sales": _daily(spark, sf_dir)})


def _both_facts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    facts = _facts(spark, sf_dir)
    return gold.fct_daily_sales(facts), facts


def dq_line_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.line_count_matches(*_both_facts(spark, sf_dir))


def dq_sales_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.sales_reconcile(*_both_facts(spark, sf_dir))


def dq_sales_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The totals that are reconciled and their difference."""
    totals = quality.sales_totals(*_both_facts(spark, sf_dir))
    return totals.selectExpr(*(f"round(cast({c} as double), 2) as {c}" for c in totals.columns))


def _inner_years(bounds: DataFrame) -> DataFrame:
    """One year shorter at both ends."""
    return bounds.selectExpr(
        "add_months(start_day, 12) as start_day", "add_months(end_day, -12) as end_day"
    )


def dq_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Against the years the orders span, and against a calendar one year shorter at both ends."""
    bounds = write_once(gold.order_years(roles.orders(spark, sf_dir)), "order_years")
    facts = write_once(_facts(spark, sf_dir).select("order_line_id", "date_key"), "fct_orders")
    return quality.union(
        quality.within_calendar(facts, gold.dim_date(days)).withColumn("calendar", F.lit(name))
        for name, days in (("order years", bounds), ("inner years", _inner_years(bounds)))
    )


def dq_lines_outside(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order lines that the shorter calendar does not hold."""
    bounds = write_once(gold.order_years(roles.orders(spark, sf_dir)), "order_years")
    return quality.lines_outside_calendar(
        _facts(spark, sf_dir), gold.dim_date(_inner_years(bounds))
    )


def dq_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks, with the mart's own calendar, which does not come from the orders it checks."""
    tables, observed = _written(spark, sf_dir)
    calendar = gold.dim_date(gold.calendar_bounds(spark))
    return quality.check_suite({**tables, "dim_date": calendar}, observed)


def dq_failing_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What fails the declared checks, value by value."""
    return quality.failing_values(_tables(spark, sf_dir))


def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = quality.freshness(roles.loads(spark, sf_dir), F.expr(AS_OF))
    return verdicts.withColumn("max_loaded_at", F.expr("cast(max_loaded_at as timestamp_ntz)"))


# writing and loading


def _database(spark: SparkSession, name: str) -> tuple[str, str]:
    """A database of a fixed name, which each run overwrites, and its folder."""
    database = f"orderloom_{name}"
    if not spark.catalog.databaseExists(database):
        loading.create_database(spark, database, shared_path(spark, database))
    return database, spark.catalog.getDatabase(database).locationUri


def gold_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the written gold tables."""
    database, _ = _database(spark, "gold")
    raw = {name: role(spark, sf_dir) for name, role in roles.RAW_ROLES.items()}
    models = build.build(raw, gold.order_years(raw["olist_orders"]))
    saved = build.save_gold(spark, models, database)
    return quality.union(
        saved[name].selectExpr(f"'{name}' as table_name", "count(*) as row_count")
        for name in build.GOLD_TABLES
    )


def _ingested(spark: SparkSession, sf_dir: str, name: str, tables: Iterable[str], loaded_at=None):
    """Write raw tables as CSV to a shared folder and load them from there."""
    database, root = _database(spark, name)

    def export(table: str) -> None:
        rows = roles.RAW_ROLES[table](spark, sf_dir)
        rows.write.mode("overwrite").option("header", True).csv(f"{root}/csv/{table}.csv")

    tables = tuple(tables)
    with ThreadPoolExecutor(len(tables)) as pool:
        list(pool.map(export, tables))
    report = loading.ingest(spark, f"{root}/csv", database, tables, loaded_at)
    return loading.read_raw(spark, database, tables), report


def ingest_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, _ = _ingested(spark, sf_dir, "roundtrip", ("olist_orders", "olist_order_items"))
    return staging.stg_orders(raw["olist_orders"], raw["olist_order_items"])


def ingest_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, report = _ingested(spark, sf_dir, "row_counts", loading.RAW_TABLES)
    return report.select("table_name", "row_count")


ITEM_FIELDS = "order_id order_item_id product_id seller_id shipping_limit_date price freight_value".split()


def _ragged_items(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Order items as CSV: each 50th order has a field too many, the order before it one too few."""
    fields = ", ".join(f"cast({name} as string)" for name in ITEM_FIELDS)
    most = ", ".join(f"cast({name} as string)" for name in ITEM_FIELDS[:-1])
    line = (
        f"case when order_id % 50 = 0 then concat_ws(',', {fields}, 'extra') "
        f"when order_id % 50 = 49 then concat_ws(',', {most}) else concat_ws(',', {fields}) end"
    )
    # One column named like the whole header, parted by a mark that no line holds.
    lines = roles.order_items(spark, sf_dir).select(F.expr(line).alias(",".join(ITEM_FIELDS)))
    lines.write.mode("overwrite").options(header=True, sep="\x01").csv(path)


def ingest_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order items with malformed rows: what is loaded, what is set aside and what the report says."""
    database, root = _database(spark, "rejected")
    _ragged_items(spark, sf_dir, f"{root}/csv/olist_order_items.csv")
    report = loading.ingest(spark, f"{root}/csv", database, ("olist_order_items",), most_bad=0.2)
    loaded = spark.table(f"{database}.olist_order_items").selectExpr("'loaded' as kind", "price")
    rejected = spark.table(f"{database}.olist_order_items_rejected").selectExpr(
        f"if(size(split(_bad_record, ',')) > {len(ITEM_FIELDS)}, 'long', 'short') as kind",
        f"split(_bad_record, ',')[{ITEM_FIELDS.index('price')}] as price",
    )
    totals = loaded.unionAll(rejected).groupBy("kind").agg(
        F.expr("count(*) as row_count"), F.expr("round(sum(cast(price as double)), 2) as price")
    )
    told = report.selectExpr("stack(2, 'report good', row_count, 'report bad', bad_count) as (kind, row_count)")
    return totals.unionAll(told.selectExpr("kind", "row_count", "cast(null as double) as price"))


def ingest_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order items after a load and a second one that is stopped by its malformed rows."""
    table = "olist_order_items"
    _ingested(spark, sf_dir, "kept", (table,))
    database, root = _database(spark, "kept")
    _ragged_items(spark, sf_dir, f"{root}/csv/{table}.csv")
    try:
        loading.ingest(spark, f"{root}/csv", database, (table,), most_bad=0.0)
    except loading.TooManyBadRows:
        return spark.table(f"{database}.{table}").select("order_id", "order_item_id", "product_id", "seller_id")
    raise AssertionError("malformed rows were loaded")


def raw_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Age of the eight raw tables, loaded at the instant of the newest event."""
    newest = roles.loads(spark, sf_dir, aged=False).selectExpr("unix_micros(max(_loaded_at)) as us").first().us
    loaded_at = dt.datetime.fromtimestamp(0, dt.timezone.utc) + dt.timedelta(microseconds=newest)
    raw, _ = _ingested(spark, sf_dir, "freshness", loading.RAW_TABLES, loaded_at)
    verdicts = build.raw_freshness(raw, FRESH_AT)
    return verdicts.select("table_name", "age_seconds", "status")


def ingest_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with quotes, commas and line breaks through CSV and back, by many tasks for one file."""
    path = shared_path(spark, "texts.csv")
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr(
        "cast(doc_id as string) as doc_id", "concat('\"', replace(text, ' ', ', '), '\"\n') as text"
    )
    kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    rows.write.options(header=True, escape='"', **kept).csv(path)
    return read_csv(spark, path, multiline=True)


def whole_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decimal text as whole numbers."""
    text = spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr(
        "l_orderkey", "l_linenumber", "cast(cast(l_quantity * l_discount as decimal(18, 2)) as string) as amount"
    )
    return text.select("l_orderkey", "l_linenumber", "amount", whole(text, "amount").alias("whole"))


QUERIES = (
    stg_orders,
    stg_customers,
    stg_products,
    stg_sellers,
    stg_payments,
    stg_reviews,
    int_payment_totals,
    int_primary_payment,
    int_payment_summary,
    int_review_avg,
    int_item_count,
    int_orders_enriched,
    dim_customer,
    dim_product,
    dim_seller,
    dim_payment_type,
    dim_date,
    fct_orders,
    fct_daily_sales,
    kpi_summary,
    daily_sales_trend,
    payment_mix,
    top_categories,
    state_orders,
    dq_unique,
    dq_not_null,
    dq_relationships,
    dq_accepted_values,
    dq_accepted_range,
    dq_unique_combination,
    dq_line_count,
    dq_sales_reconcile,
    dq_sales_totals,
    dq_date_range,
    dq_lines_outside,
    dq_suite,
    dq_failing_values,
    freshness,
    gold_tables,
    ingest_roundtrip,
    ingest_row_counts,
    ingest_rejected,
    ingest_kept,
    raw_freshness,
    ingest_quoted,
    whole_numbers,
)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the daily seller sales fact, which runs through the whole mart."""
    return fct_daily_sales(spark, FLAGSHIP_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per model, report, check family and loading step, and per training-data operator."""
    own = {query.__name__: query for query in QUERIES}
    return own | (llm.queries() | {"pipeline": corpus_pipeline.run} if llm else {})


def oracle_sql() -> dict[str, str]:
    """The DuckDB SQL each query must agree with, where SQL can express it."""
    return duckdb_queries.oracle_sql() | (llm.oracle_sql() if llm else {})

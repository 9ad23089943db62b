"""The whole mart: raw tables to models, gold tables to disk, checks on top."""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.csv_tables import RAW_TABLES, resolve_source_dir
from ..sources.ingest import ingest, read_raw
from ..sources.publish import Staged, create_database, discard, publish, stage
from . import gold, quality, staging
from .intermediate import int_orders_enriched

GOLD_TABLES = (
    "dim_customer",
    "dim_product",
    "dim_seller",
    "dim_payment_type",
    "dim_date",
    "fct_orders",
    "fct_daily_sales",
)

#: Partition column of fct_orders, if it is partitioned.
MONTH = "date_month"


class FailedChecks(RuntimeError):
    """A build was stopped; ``verdicts`` has the failing ones."""

    def __init__(self, stage: str, verdicts: list):
        named = [f"{v.table_name}.{v.column_name} {v.check_name}: {v.failures}" for v in verdicts]
        super().__init__(f"{stage}: {'; '.join(named)}")
        self.verdicts = verdicts


def build(raw: dict[str, DataFrame], calendar: DataFrame) -> dict[str, DataFrame]:
    """All fourteen models as plans; nothing runs. ``calendar`` holds the bounds of dim_date."""
    orders, items = raw["olist_orders"], raw["olist_order_items"]
    models = {
        "stg_orders": staging.stg_orders(orders, items),
        "stg_customers": staging.stg_customers(raw["olist_customers"]),
        "stg_products": staging.stg_products(
            raw["olist_products"], raw["product_category_name_translation"]
        ),
        "stg_sellers": staging.stg_sellers(raw["olist_sellers"]),
        "stg_payments": staging.stg_payments(raw["olist_order_payments"]),
        "stg_reviews": staging.stg_reviews(raw["olist_order_reviews"]),
    }
    enriched = int_orders_enriched(orders, items, models["stg_payments"], models["stg_reviews"])
    facts = gold.fct_orders(enriched)
    return {
        **models,
        "int_orders_enriched": enriched,
        "dim_customer": gold.dim_customer(models["stg_customers"]),
        "dim_product": gold.dim_product(models["stg_products"]),
        "dim_seller": gold.dim_seller(models["stg_sellers"]),
        "dim_payment_type": gold.dim_payment_type(models["stg_payments"]),
        "dim_date": gold.dim_date(calendar),
        "fct_orders": facts,
        "fct_daily_sales": gold.fct_daily_sales(facts),
    }


def stage_gold(
    spark: SparkSession,
    models: dict[str, DataFrame],
    database: str = "gold",
    location: str | None = None,
    by_month: bool = False,
) -> dict[str, Staged]:
    """Write the gold tables aside, each to a fresh folder; the tables in use are not touched. What
    their checks count row by row is counted on the way.

    fct_daily_sales is computed from the written fct_orders, so the central join runs once.
    ``by_month`` partitions fct_orders by the month of its date, for reports over a few months.
    """
    create_database(spark, database, location)

    def write(name: str, rows: DataFrame) -> Staged:
        if by_month and name == "fct_orders":
            month = F.date_format("date_key", "yyyy-MM")
            # One task per month and slice of orders, so that a month is a few files.
            rows = rows.withColumn(MONTH, month).repartition(MONTH, F.expr("pmod(hash(order_id), 8)"))
            return stage(rows, database, name, (MONTH,), quality.metrics(name))
        return stage(rows, database, name, measures=quality.metrics(name))

    first = [name for name in GOLD_TABLES if name != "fct_daily_sales"]
    staged: dict[str, Staged] = {}
    try:
        with ThreadPoolExecutor(len(first)) as pool:  # dimensions do not wait for the order fact
            jobs = {name: pool.submit(write, name, models[name]) for name in first}
        staged = {name: job.result() for name, job in jobs.items() if job.exception() is None}
        for job in jobs.values():
            job.result()
        facts = staged["fct_orders"].read(spark)
        staged["fct_daily_sales"] = write("fct_daily_sales", gold.fct_daily_sales(facts))
    except BaseException:
        discard(spark, list(staged.values()))
        raise
    return staged


def _read_staged(
    spark: SparkSession, models: dict[str, DataFrame], staged: dict[str, Staged]
) -> dict[str, DataFrame]:
    read = {name: one.read(spark).select(*models[name].columns) for name, one in staged.items()}
    return {**models, **read}


def save_gold(
    spark: SparkSession,
    models: dict[str, DataFrame],
    database: str = "gold",
    location: str | None = None,
    by_month: bool = False,
) -> dict[str, DataFrame]:
    """Replace the gold tables and return the models with their gold part read from the tables. All
    are written before the first is replaced, see ``stage_gold``."""
    staged = stage_gold(spark, models, database, location, by_month)
    tables = publish(spark, list(staged.values()))
    return {**models, **{name: df.select(*models[name].columns) for name, df in tables.items()}}


def _stop_on_failures(stage: str, verdicts: DataFrame) -> None:
    failed = verdicts.where("status not in ('pass', 'warn')").collect()  # at most one per check
    if failed:
        raise FailedChecks(stage, failed)


def raw_freshness(raw: dict[str, DataFrame], as_of: dt.datetime) -> DataFrame:
    """Age of the newest load of each raw table."""
    return quality.freshness(quality.load_stamps(raw), F.lit(as_of))


def run(
    spark: SparkSession,
    source_dir: str | None = None,
    raw_database: str = "raw",
    gold_database: str = "gold",
    loaded_at: dt.datetime | None = None,
    as_of: dt.datetime | None = None,
    fail: bool = True,
) -> DataFrame:
    """Load, check, build, check again. Returns one verdict row per check.

    With ``fail``, a raw table that is stale at ``as_of`` (now) and a failing check of the raw and
    staging tables stop the build before a gold table is written, and a failing check of the gold
    tables, which are checked where they were written aside, before one is replaced. An empty raw table has no load to be fresh and counts as stale.
    """
    ingest(spark, resolve_source_dir(spark, source_dir), raw_database, loaded_at=loaded_at)
    raw = read_raw(spark, raw_database, tuple(RAW_TABLES))
    models = build(raw, gold.calendar_bounds(spark))
    if fail:
        as_of = as_of or dt.datetime.now(dt.timezone.utc)
        stale = raw_freshness(raw, as_of).selectExpr(
            "table_name", "'_loaded_at' as column_name", "'freshness' as check_name",
            "age_seconds as failures", "status",
        )
        inputs = {name: df for name, df in {**raw, **models}.items() if name not in GOLD_TABLES}
        _stop_on_failures("raw and staging", stale.unionByName(quality.input_suite(inputs)))
    staged = stage_gold(spark, models, gold_database)
    observed = {name: one.observed for name, one in staged.items()}
    verdicts = quality.check_suite({**raw, **_read_staged(spark, models, staged)}, observed)
    if fail:
        try:
            _stop_on_failures("gold", verdicts)
        except FailedChecks:
            discard(spark, list(staged.values()))
            raise
    publish(spark, list(staged.values()))
    return verdicts

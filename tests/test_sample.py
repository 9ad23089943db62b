"""The whole mart on the sample shop, from CSV files to report and check results."""

from __future__ import annotations

import datetime as dt

import pytest
from orderloom.__main__ import main as command
from orderloom.plans import build, gold, quality, reports
from orderloom.sources.ingest import ingest, read_raw
from pyspark.sql import functions as F
from shop import SAMPLE, write_csv


def day(number: int) -> dt.date:
    return dt.date(2018, 1, number)


@pytest.fixture(scope="module")
def mart(spark, tmp_path_factory):
    folder = write_csv(tmp_path_factory.mktemp("csv"), SAMPLE)
    ingest(spark, folder, "sample_raw")
    raw = read_raw(spark, "sample_raw")
    models = build.build(raw, gold.calendar_bounds(spark))
    assert len(models) == 14
    return {**raw, **build.save_gold(spark, models, "sample_gold")}


def rows(df) -> set[tuple]:
    return {tuple(row) for row in df.collect()}


def test_order_fact(mart):
    facts = mart["fct_orders"].select(
        "order_line_id", "date_key", "customer_id", "product_id", "seller_id", "payment_type",
        "order_item_count", "item_price", "freight_value", "gross_item_amount",
        "payment_total_value", "avg_review_score",
    )
    assert rows(facts) == {
        ("o1-1", day(1), "c1", "p1", "s1", "credit_card", 2, 100, 15, 115, 165, 5.0),
        ("o1-2", day(1), "c1", "p2", "s2", "credit_card", 2, 50, 8, 58, 165, 5.0),
        ("o2-1", day(3), "c2", "p3", "s3", "voucher", 1, 80, 10, 90, 90, 4.0),
        ("o3-1", day(8), "c3", "p2", "s1", "credit_card", 1, 120, 12, 132, 132, 3.0),
    }
    assert mart["fct_orders"].count() == 4
    assert len(mart["fct_orders"].columns) == 15


def test_types(mart):
    types = dict(mart["int_orders_enriched"].dtypes)
    assert types["order_purchase_ts"] == "timestamp_ntz"
    assert types["order_date"] == "date"
    assert types["order_item_id"] == "int"
    assert types["order_item_count"] == "bigint"
    assert types["payment_total_value"] == "double"
    assert dict(mart["dim_date"].dtypes)["year_num"] == "bigint"
    assert dict(mart["fct_daily_sales"].dtypes)["order_count"] == "bigint"


def test_daily_sales(mart):
    assert rows(mart["fct_daily_sales"]) == {
        (day(1), "s1", 1, 1, 100, 15, 115),
        (day(1), "s2", 1, 1, 50, 8, 58),
        (day(3), "s3", 1, 1, 80, 10, 90),
        (day(8), "s1", 1, 1, 120, 12, 132),
    }


def test_dimensions(mart):
    assert rows(mart["dim_payment_type"]) == {
        ("credit_card", "credit card"),
        ("voucher", "voucher"),
        ("boleto", "boleto"),
    }
    assert mart["dim_customer"].count() == 4
    assert rows(mart["dim_product"].select("product_id", "product_category_name_english")) == {
        ("p1", "health_beauty"),
        ("p2", "computers_accessories"),
        ("p3", "housewares"),
    }
    assert ("s1", "1100", "sao paulo", "SP") in rows(mart["dim_seller"])


def test_date_dimension(mart):
    dates = mart["dim_date"]
    assert dates.count() == 1096
    bounds = dates.selectExpr("min(date_key)", "max(date_key)").first()
    assert tuple(bounds) == (dt.date(2016, 1, 1), dt.date(2018, 12, 31))
    some = dates.where("date_key between '2018-01-05' and '2018-01-08'")
    assert rows(some.select("day_num", "is_weekend")) == {
        (5, False), (6, True), (7, True), (8, False),
    }
    assert rows(dates.where("date_key = '2016-02-29'")) == {
        (dt.date(2016, 2, 29), 2016, 2, 29, "2016-02", False)
    }


def test_reports(mart):
    facts = mart["fct_orders"]
    assert tuple(reports.kpi_summary(facts).first()) == (3, 4, 395.0, 4.25)
    trend = [tuple(r) for r in reports.daily_sales_trend(mart["fct_daily_sales"]).collect()]
    assert trend == [(day(1), 173, 2), (day(3), 90, 1), (day(8), 132, 1)]
    mix = reports.payment_mix(facts, mart["dim_payment_type"]).collect()
    assert [tuple(r) for r in mix] == [("credit card", 3), ("voucher", 1)]
    top = reports.top_categories(facts, mart["dim_product"]).collect()
    assert [tuple(r) for r in top] == [
        ("computers_accessories", 190),
        ("health_beauty", 115),
        ("housewares", 90),
    ]
    states = reports.state_orders(facts, mart["dim_customer"])
    assert rows(states) == {("SP", 1), ("RJ", 1), ("PR", 1)}


def test_every_check_passes(mart):
    verdicts = quality.check_suite(mart).collect()
    assert len(verdicts) == 63
    assert {v["status"] for v in verdicts} == {"pass"}
    kinds = [v["check_name"] for v in verdicts]
    assert {kind: kinds.count(kind) for kind in kinds} == {
        "not_null": 34,
        "unique": 12,
        "accepted_range": 7,
        "relationships": 5,
        "accepted_values": 1,
        "unique_combination": 1,
        "line_count_matches": 1,
        "sales_reconcile": 1,
        "within_calendar": 1,
    }


def test_run_and_rerun_replace_everything(spark, tmp_path):
    folder = write_csv(tmp_path, SAMPLE)
    for _ in range(2):
        verdicts = build.run(spark, folder, "rerun_raw", "rerun_gold")
        assert verdicts.where("status = 'fail'").count() == 0
    assert spark.table("rerun_gold.fct_orders").count() == 4
    assert spark.table("rerun_raw.olist_orders").count() == 4



def test_stale_or_failing_inputs_stop_the_build_before_gold(spark, tmp_path):
    folder = write_csv(tmp_path, SAMPLE)
    build.run(spark, folder, "stop_raw", "stop_gold")
    late = dt.datetime.now(dt.timezone.utc) + dt.timedelta(days=5)
    with pytest.raises(build.FailedChecks, match="freshness"):
        build.run(spark, folder, "stop_raw", "stop_gold", as_of=late)
    bad = {**SAMPLE, "olist_orders": SAMPLE["olist_orders"] + SAMPLE["olist_orders"][:1]}
    write_csv(tmp_path, bad)
    with pytest.raises(build.FailedChecks, match="olist_orders.order_id unique: 1") as failed:
        build.run(spark, folder, "stop_raw", "stop_gold")
    assert {v.check_name for v in failed.value.verdicts} == {"unique"}
    assert spark.table("stop_gold.fct_orders").count() == 4
    verdicts = build.run(spark, folder, "stop_raw", "stop_gold", fail=False)
    assert verdicts.where("status = 'fail'").count() > 0
    assert spark.table("stop_gold.fct_orders").count() == 6


def test_gold_by_month(spark, mart):
    saved = build.save_gold(spark, mart, "month_gold", by_month=True)
    assert saved["fct_orders"].columns == mart["fct_orders"].columns
    assert saved["fct_orders"].exceptAll(mart["fct_orders"]).isEmpty()
    months = [r[0] for r in spark.sql("show partitions month_gold.fct_orders").collect()]
    assert months == ["date_month=2018-01"]


def test_large_sums_reconcile(spark):
    """Totals of 1e15, where the order of addition alone moves a sum of doubles by cents. A day's
    own sum is a double and small enough to hold them."""
    lines = spark.range(100_000).selectExpr("id % 10000 as seller_id", "1e10 + id * 0.01 as gross_item_amount")
    daily = lines.groupBy("seller_id").agg(F.sum("gross_item_amount").alias("gross_sales"))
    assert quality.sales_reconcile(daily, lines).first()["failures"] == 0
    missing = lines.where("gross_item_amount > 1e10")
    totals = quality.sales_totals(daily, missing).first()
    assert float(totals["difference"]) == pytest.approx(1e10, rel=1e-9)
    assert quality.sales_reconcile(daily, missing).first()["failures"] == 1


def test_command(spark, tmp_path, capsys):
    folder = write_csv(tmp_path, SAMPLE)
    databases = ["--raw-database", "command_raw", "--gold-database", "command_gold"]
    assert command(["--source-dir", folder, *databases]) == 0
    assert "within_calendar" in capsys.readouterr().out
    write_csv(tmp_path, {"olist_orders": SAMPLE["olist_orders"] * 2})
    assert command(["--source-dir", folder, *databases]) == 1
    assert "olist_orders.order_id unique" in capsys.readouterr().err

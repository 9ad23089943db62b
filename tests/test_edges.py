"""Rows the sample does not have: missing parts, ties, duplicates, odd dates."""

from __future__ import annotations

import datetime as dt

import pytest
from orderloom.functions import order_line_id
from orderloom.plans import build, gold, intermediate, quality, reports
from shop import frames, sample


def order(order_id: str, customer: str = "c1", at: str = "2018-02-01 10:00:00") -> tuple:
    return (order_id, customer, "delivered", at, "", "", "", "")


def item(order_id, number="1", product="p1", price="10.0", freight="1.0") -> tuple:
    return (order_id, number, product, "s1", "", price, freight)


def models(spark, **extra):
    raw = frames(spark, sample(**extra))
    return {**raw, **build.build(raw, gold.calendar_bounds(spark))}


def line(mart, order_id: str):
    return mart["fct_orders"].where(f"order_id = '{order_id}'").first()


def failures(verdicts, column: str, check: str, table: str = "fct_orders") -> int:
    (row,) = verdicts.where(
        f"table_name = '{table}' and column_name = '{column}' and check_name = '{check}'"
    ).collect()
    return row["failures"]


def test_order_without_payment(spark):
    mart = models(spark, olist_orders=[order("x1")], olist_order_items=[item("x1")])
    assert line(mart, "x1")["payment_total_value"] == 0.0
    assert line(mart, "x1")["payment_type"] == "unknown"
    verdicts = quality.relationships_suite(mart)
    assert failures(verdicts, "payment_type", "relationships") == 1
    mix = reports.payment_mix(mart["fct_orders"], mart["dim_payment_type"]).collect()
    assert [tuple(r) for r in mix] == [("credit card", 3), ("voucher", 1)]


@pytest.mark.parametrize(
    ("paid", "primary"),
    [
        ([("voucher", "50"), ("boleto", "50")], "boleto"),
        ([("credit_card", "30"), ("credit_card", "30"), ("voucher", "50")], "credit_card"),
        ([("voucher", ""), ("debit_card", "-5")], "debit_card"),
        ([("voucher", ""), ("boleto", "")], "boleto"),
        ([("", "7"), ("voucher", "7")], "voucher"),
        ([("", "8"), ("voucher", "7")], "unknown"),
        ([("voucher", "NaN"), ("boleto", "9")], "voucher"),
    ],
)
def test_primary_payment_type_in_both_forms(spark, paid, primary):
    payments = [("x2", str(n), kind, "1", value) for n, (kind, value) in enumerate(paid)]
    mart = models(
        spark,
        olist_orders=[order("x2")],
        olist_order_items=[item("x2")],
        olist_order_payments=payments,
    )
    assert line(mart, "x2")["payment_type"] == primary
    ranked = intermediate.primary_payment_types(mart["stg_payments"])
    summary = intermediate.payment_summary(mart["stg_payments"])
    columns = ["order_id", "primary_payment_type"]
    assert sorted(map(str, ranked.select(columns).collect())) == sorted(
        map(str, summary.select(columns).collect())
    )


def test_reviews(spark):
    mart = models(
        spark,
        olist_orders=[order("x4"), order("x5")],
        olist_order_items=[item("x4"), item("x5")],
        olist_order_reviews=[("r8", "x5", "5", "", ""), ("r9", "x5", "2", "", "")],
    )
    assert line(mart, "x4")["avg_review_score"] is None
    assert line(mart, "x5")["avg_review_score"] == 3.5
    kpi = reports.kpi_summary(mart["fct_orders"]).first()
    assert kpi["avg_review"] == pytest.approx((5 + 5 + 4 + 3 + 3.5) / 5)


def test_untranslated_category(spark):
    mart = models(
        spark,
        olist_orders=[order("x6")],
        olist_order_items=[item("x6", product="p9", price="500.0")],
        olist_products=[("p9", "moveis", "", "", "", "", "", "", "")],
    )
    product = mart["dim_product"].where("product_id = 'p9'").first()
    assert product["product_category_name_english"] is None
    assert product["product_weight_g"] is None
    top = reports.top_categories(mart["fct_orders"], mart["dim_product"]).first()
    assert tuple(top) == ("unknown", 501.0)
    assert failures(
        quality.accepted_range_suite(mart), "product_weight_g", "accepted_range", "dim_product"
    ) == 0


def test_line_key_with_missing_parts(spark):
    pairs = spark.createDataFrame(
        [("a", 1), ("a", None), (None, 2), (None, None)], "o string, i int"
    )
    keys = pairs.select(order_line_id("o", "i")).collect()
    assert [row[0] for row in keys] == ["a-1", "a-", "-2", "-"]
    mart = models(spark, olist_orders=[order("x6")], olist_order_items=[item("x6", "")])
    assert line(mart, "x6")["order_line_id"] == "x6-"
    assert line(mart, "x6")["order_item_id"] is None


def test_lines_without_an_order_and_null_ids_disappear(spark):
    mart = models(
        spark,
        olist_orders=[order("")],
        olist_order_items=[item("nowhere"), item("")],
        olist_order_payments=[("", "1", "voucher", "1", "5")],
    )
    assert mart["fct_orders"].count() == 4


def test_repeated_order_header_repeats_lines_and_counts(spark):
    mart = models(
        spark,
        olist_orders=[order("x7"), order("x7", "c2")],
        olist_order_items=[item("x7", "1"), item("x7", "2")],
    )
    lines = mart["fct_orders"].where("order_id = 'x7'").collect()
    assert len(lines) == 4
    assert {row["order_item_count"] for row in lines} == {4}
    counted = intermediate.item_counts(mart["stg_orders"]).where("order_id = 'x7'").first()
    assert counted["order_item_count"] == 4


def test_gross_is_null_when_a_part_is(spark):
    mart = models(
        spark, olist_orders=[order("x8")], olist_order_items=[item("x8", freight="")]
    )
    assert line(mart, "x8")["gross_item_amount"] is None
    verdicts = quality.not_null_suite(mart)
    assert failures(verdicts, "gross_item_amount", "not_null") == 1
    assert failures(verdicts, "freight_value", "not_null") == 1


def test_order_outside_the_calendar(spark):
    mart = models(
        spark,
        olist_orders=[order("x9", at="2019-01-01 00:00:00")],
        olist_order_items=[item("x9")],
    )
    outside = quality.lines_outside_calendar(mart["fct_orders"], mart["dim_date"]).collect()
    assert [row["order_line_id"] for row in outside] == ["x9-1"]
    verdicts = quality.check_suite(mart)
    assert failures(verdicts, "date_key", "within_calendar") == 1
    assert failures(verdicts, "date_key", "relationships") == 1


def test_empty_calendar_has_no_days(spark):
    same = gold.calendar_bounds(spark, dt.date(2018, 1, 1), dt.date(2018, 1, 1))
    assert gold.dim_date(same).count() == 0
    day = gold.calendar_bounds(spark, dt.date(2018, 1, 1), dt.date(2018, 1, 2))
    assert gold.dim_date(day).count() == 1


def test_empty_raw_tables(spark):
    raw = {table: df.limit(0) for table, df in frames(spark, sample()).items()}
    mart = {**raw, **build.build(raw, gold.calendar_bounds(spark))}
    assert mart["fct_daily_sales"].count() == 0
    verdicts = quality.check_suite(mart).collect()
    assert len(verdicts) == 63
    assert {v["failures"] for v in verdicts} == {0}

"""Each kind of check on rows that break it, and the freshness thresholds."""

from __future__ import annotations

import datetime as dt

import __spark_entry__ as driver
import pytest
from orderloom.plans import gold, quality
from orderloom.sources.shared import measured, write_measured
from pyspark.sql import functions as F


def counts(verdicts) -> dict[tuple, int]:
    return {(v["column_name"], v["check_name"]): v["failures"] for v in verdicts.collect()}


def test_unique_counts_repeated_values_and_ignores_null(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), ("b",), ("c",), (None,), (None,)], "k string")
    verdicts = quality.unique([("t", "k", df), ("u", "k", df.where("k = 'c'"))])
    assert [tuple(r) for r in verdicts.collect()] == [("t", "k", "unique", 2), ("u", "k", "unique", 0)]


def test_unique_combination_compares_null_like_a_value(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (1, None), (2, "a")], "d int, s string")
    verdict = quality.unique_combination(df, "t", ("d", "s")).first()
    assert tuple(verdict) == ("t", "d,s", "unique_combination", 2)


def test_row_checks_share_one_aggregate(spark):
    df = spark.createDataFrame(
        [("x", 0.0), ("y", -1.0), ("z", 6.0), (None, None), ("y", 5.0)], "kind string, score double"
    )
    measures = [
        *quality.null_measures(["kind", "score"]),
        *quality.value_measures({"kind": ("x", "it's")}),
        *quality.range_measures({"score": (0, 5)}),
    ]
    assert counts(quality.row_verdicts(df, "t", measures)) == {
        ("kind", "not_null"): 1,
        ("score", "not_null"): 1,
        ("kind", "accepted_values"): 2,
        ("score", "accepted_range"): 2,
    }


@pytest.mark.parametrize(
    ("bounds", "expected"),
    [
        ((0, None), [-1]),
        ((None, 5), [6]),
        ((0, 5), [-1, 6]),
        ((0, 5, False), [-1, 0, 5, 6]),
        ((None, None), []),
    ],
)
def test_range_bounds(spark, bounds, expected):
    df = spark.createDataFrame([(-1,), (0,), (3,), (5,), (6,), (None,)], "v int")
    hits = df.where(quality.outside("v", *bounds)).orderBy("v").collect()
    assert [row["v"] for row in hits] == expected


def test_relationships_count_orphan_rows_per_key(spark):
    child = spark.createDataFrame(
        [(1, "a"), (1, "b"), (9, "b"), (9, None), (9, "zz"), (None, "a")], "p int, q string"
    )
    parents = spark.createDataFrame([(1, "a"), (2, "b"), (None, None)], "p int, q string")
    verdicts = quality.relationships(child, "t", [("p", parents, "p"), ("q", parents, "q")])
    assert counts(verdicts) == {("p", "relationships"): 3, ("q", "relationships"): 1}


def test_reconciliations(spark):
    orders = spark.createDataFrame([(10.0,), (20.0,)], "gross_item_amount double")

    def daily(lines: int, gross: float):
        return spark.createDataFrame([(lines, gross)], "line_count bigint, gross_sales double")

    assert quality.line_count_matches(daily(2, 30.0), orders).first()["failures"] == 0
    assert quality.line_count_matches(daily(3, 30.0), orders).first()["failures"] == 1
    assert quality.sales_reconcile(daily(2, 30.009), orders).first()["failures"] == 0
    assert quality.sales_reconcile(daily(2, 30.02), orders).first()["failures"] == 1
    empty = orders.limit(0)
    assert quality.sales_reconcile(daily(2, 30.0), empty).first()["failures"] == 0
    assert quality.line_count_matches(daily(2, 30.0), empty).first()["failures"] == 1


def test_freshness_thresholds(spark):
    now = dt.datetime(2024, 3, 10, 12, 0)

    def loaded(*hours: float):
        stamps = [(now - dt.timedelta(hours=h),) for h in hours]
        return spark.createDataFrame(stamps, "_loaded_at timestamp")

    tables = {
        "day": loaded(23, 400),
        "edge": loaded(24),
        "old": loaded(25),
        "edge_old": loaded(72),
        "stale": loaded(73),
    }
    unstamped = spark.createDataFrame([("unstamped", None)], "table_name string, _loaded_at timestamp")
    stamps = quality.load_stamps(tables).unionAll(unstamped)
    verdicts = quality.freshness(stamps, F.lit(now)).collect()
    assert {row["table_name"]: row["status"] for row in verdicts} == {
        "day": "pass",
        "edge": "pass",
        "old": "warn",
        "edge_old": "warn",
        "stale": "error",
        "unstamped": "error",
    }
    assert {r["table_name"]: r["age_seconds"] for r in verdicts}["day"] == 23 * 3600


def verdict_rows(df) -> list[tuple]:
    return sorted((r.table_name, r.column_name, r.check_name, r.failures) for r in df.collect())


def broken_fact(spark):
    return spark.sql(
        "select * from values ('a', 1L, 10d, 1d, 11d), (null, 2L, -1d, null, null), ('c', null, 5d, -2d, 3d) "
        "as t(order_line_id, order_id, item_price, freight_value, gross_item_amount)"
    ).selectExpr(
        "*", "1L as customer_id", "cast(null as bigint) as product_id", "2L as seller_id",
        "'boleto' as payment_type", "date'2018-01-01' as date_key",
    )


@pytest.mark.parametrize("rows", [3, 0])
def test_observed_metrics_are_the_row_level_checks(spark, rows):
    facts = broken_fact(spark).limit(rows)
    written, seen = write_measured(facts, "facts", quality.metrics("fct_orders"))
    known = quality.observed_rows("fct_orders", seen)
    assert sorted(known) == verdict_rows(quality.row_verdicts(facts, "fct_orders", quality.row_measures("fct_orders")))
    assert len(known) == 12 and (rows == 0 or sum(n for *_, n in known) == 9)
    daily = gold.fct_daily_sales(facts)
    observed = {"fct_orders": seen, "fct_daily_sales": measured(daily, quality.metrics("fct_daily_sales"))}
    plain = quality.line_count_matches(daily, facts).unionAll(quality.sales_reconcile(daily, facts))
    assert sorted(quality.observed_reconciliations(observed)) == verdict_rows(plain)
    # Totals that differ show in both forms.
    fewer = facts.where("order_line_id = 'a'")
    observed["fct_orders"] = measured(fewer, quality.metrics("fct_orders"))
    plain = quality.line_count_matches(daily, fewer).unionAll(quality.sales_reconcile(daily, fewer))
    assert sorted(quality.observed_reconciliations(observed)) == verdict_rows(plain)


def test_counts_of_distinct_values_are_not_observed(spark):
    names = [str(c) for c in quality.metrics("stg_payments")]
    assert not any("distinct" in name.lower() for name in names)
    assert len(names) == len(quality.NOT_NULL["stg_payments"]) + 1


def test_suite_looks_at_no_row_of_a_fact_again(spark):
    tables, observed = driver._written(spark, "/root/testdata/sf0.001")
    facts = {name: tables[name] for name in ("fct_orders", "fct_daily_sales")}
    text = quality.row_level_suite(facts, observed)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in text and "Scan" in text
    assert verdict_rows(quality.check_suite(tables, observed)) == verdict_rows(quality.check_suite(tables))


def test_failing_values_are_those_the_verdicts_count(spark):
    facts = broken_fact(spark)
    tables = {
        "fct_orders": facts.unionAll(facts.where("order_line_id = 'a'")),
        "stg_payments": spark.sql("select 1L as order_id, stack(4, 'cash', 'cash', 'boleto', null) as payment_type").selectExpr("*", "-2d as payment_value"),
        "dim_customer": spark.sql("select 7L as customer_id, 'u' as customer_unique_id, 1 as x").drop("x"),
        "fct_daily_sales": spark.sql("select date'2018-01-01' as date_key, 1L as seller_id, 1d as gross_sales from range(2)"),
    }
    found = {(r.table_name, r.column_name, r.check_name, r.value): r.row_count for r in quality.failing_values(tables).collect()}
    assert found == {
        ("fct_orders", "order_line_id", "not_null", None): 1,
        ("fct_orders", "order_id", "not_null", None): 1,
        ("fct_orders", "product_id", "not_null", None): 4,
        ("fct_orders", "freight_value", "not_null", None): 1,
        ("fct_orders", "gross_item_amount", "not_null", None): 1,
        ("fct_orders", "item_price", "accepted_range", "-1.0"): 1,
        ("fct_orders", "freight_value", "accepted_range", "-2.0"): 1,
        ("fct_orders", "order_line_id", "unique", "a"): 2,
        ("fct_orders", "customer_id", "relationships", "1"): 4,
        ("stg_payments", "payment_type", "not_null", None): 1,
        ("stg_payments", "payment_type", "accepted_values", "cash"): 2,
        ("stg_payments", "payment_value", "accepted_range", "-2.0"): 4,
        ("fct_daily_sales", "date_key,seller_id", "unique_combination", "2018-01-01,1"): 2,
    }

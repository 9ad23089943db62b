"""Physical plans: what is read, what is shuffled, which joins remain."""

from __future__ import annotations

import re

import __spark_entry__ as driver
import pytest
from orderloom.plans import reports
from orderloom.sources.shared import write_once

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark):
    """Plan as if every table were large."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", sorted(q.__name__ for q in driver.QUERIES))
def test_no_cross_joins_and_no_python(spark, name):
    text = plan(driver.queries()[name](spark, SMALL))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
        assert operator not in text


def final_plan(df) -> str:
    """The plan that ran: adaptive execution has dropped what turned out empty."""
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


def test_order_lines_are_shuffled_once(spark, no_broadcast):
    planned = plan(driver.fct_orders(spark, SMALL))
    assert "_salt" in planned  # the dividing join is there whatever the size of the input
    text = final_plan(driver.fct_orders(spark, SMALL))
    # items, headers by order and by order and split, reviews, line counts, payments by type and order
    assert text.count("Exchange hashpartitioning") == 7
    assert text.count("SortMergeJoin") == 4


def test_daily_sales_add_one_shuffle_to_the_order_fact(spark, no_broadcast):
    text = final_plan(driver.fct_daily_sales(spark, SMALL))
    # the order facts are not read, so of the join only items and headers remain; the distinct
    # orders and the sums take one shuffle each, as the join's key has the split in it
    assert text.count("Exchange hashpartitioning") == 4
    assert text.count("SortMergeJoin") == 1


def test_reports_drop_the_facts_they_do_not_read(spark, no_broadcast):
    assert plan(driver.kpi_summary(spark, SMALL)).count("SortMergeJoin") == 2
    assert "payment" not in optimized(driver.top_categories(spark, SMALL))
    assert "review" not in optimized(driver.payment_mix(spark, SMALL))


def test_reports_read_only_their_columns(spark):
    facts = write_once(driver.fct_orders(spark, SMALL), "facts")
    schema = re.findall(r"ReadSchema: struct<(.*?)>", plan(reports.kpi_summary(facts)))
    assert schema == ["order_id:bigint,gross_item_amount:double,avg_review_score:double"]


def test_filters_reach_the_scan(spark):
    text = plan(driver.stg_reviews(spark, SMALL))
    assert re.search(r"PushedFilters: \[.*EqualTo\(l_returnflag,R\)", text)


def test_fact_is_aggregated_before_its_dimension_join(spark, no_broadcast):
    text = optimized(driver.top_categories(spark, SMALL))
    join = text.index("Join Inner, (product_id")
    assert "Aggregate [product_id" in text[join:]


def test_first_rank_is_cut_before_the_shuffle(spark):
    text = plan(driver.int_primary_payment(spark, SMALL))
    cut = r"WindowGroupLimit.*Final.*Exchange hashpartitioning\(order_id.*WindowGroupLimit.*Partial"
    assert re.search(cut, text, re.DOTALL)


def test_top_categories_keep_only_ten(spark):
    assert "TakeOrderedAndProject(limit=10" in plan(driver.top_categories(spark, SMALL))

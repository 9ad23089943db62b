"""Divided joins give the plain join's rows and really divide a hot key."""

from __future__ import annotations

import __spark_entry__ as driver
import pytest
from orderloom.operators import skew, spread_join
from orderloom.plans import build, gold, intermediate, reports, staging
from orderloom.sources import warehouse_roles as roles
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def divide(spark):
    """Treat any key with over 20 rows as hot."""
    spark.conf.set(skew.MIN_ROWS_CONF, "20")
    yield
    spark.conf.unset(skew.MIN_ROWS_CONF)


@pytest.fixture(scope="module")
def lines(spark, tmp_path_factory):
    """6,000 lines in 16 files; a third are exact copies with one key."""
    path = str(tmp_path_factory.mktemp("skew") / "lines")
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000)
    rows = spark.range(0, 6000, 1, 16).select(
        key.cast("bigint").alias("k"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("v")
    )
    with_null = rows.unionAll(spark.sql("select cast(null as bigint) as k, 1 as v"))
    with_null.write.parquet(path)
    return spark.read.parquet(path)


def same(a, b) -> bool:
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def counted(rows):
    return rows.groupBy("k").agg(F.expr("count(*) as n"))


def hot(rows):
    return skew.hot_keys(counted(rows), "k", "n")


def test_few_rows_are_not_hot(lines):
    assert hot(lines).count() == 0


def test_hot_keys_are_found(divide, lines):
    found = {row["k"]: row["_parts"] for row in hot(lines).collect()}
    assert found == {7: 101}  # 2,004 rows of key 7, 20 in each split


@pytest.mark.parametrize("keys", [1, 3, 50])
@pytest.mark.parametrize("files", [1, 4])
def test_splits_are_even_for_few_keys_and_files(divide, spark, tmp_path, keys, files):
    path = str(tmp_path / "rows")
    spark.range(0, 6000, 1, files).selectExpr(f"id % {keys} as k", "0 as v").write.parquet(path)
    rows = spark.read.parquet(path)
    splits = hot(rows)
    assert splits.count() == keys
    sizes = skew.deal(rows, splits, "k").groupBy("k", skew.SALT).count()
    assert sizes.agg(F.max("count")).first()[0] <= 2 * 20
    assert sizes.agg(F.sum("count")).first()[0] == 6000


def test_the_list_of_hot_keys_is_bounded(spark, divide):
    """Were all keys over the limit, the limit would rise with the rows."""
    counts = spark.range(100_000).selectExpr("id as k", "30L as n")
    assert skew.hot_keys(counts, "k", "n").count() == 0
    one = counts.unionAll(spark.sql("select -1L as k, 10000000L as n"))
    assert [row["k"] for row in skew.hot_keys(one, "k", "n").collect()] == [-1]


def test_divided_join_equals_plain_join(divide, spark, lines):
    right = spark.sql("select explode(sequence(0, 800)) as k").selectExpr(
        "cast(k as bigint) as k", "k * 10 as w"
    )
    right = right.unionAll(spark.sql("select 7L as k, -1 as w"))  # a repeated key on the right
    divided = spread_join(lines, right, "k", hot(lines))
    plain = lines.join(right, "k")
    assert divided.columns == plain.columns
    assert same(divided, plain)
    assert divided.count() == plain.count()


def test_mart_is_the_same_with_divided_orders(spark, request):
    items = roles.order_items(spark, SMALL)
    one_hot = items.withColumn("order_id", F.expr("if(product_id % 3 = 0, 5L, order_id)"))
    orders = roles.orders(spark, SMALL)
    payments = staging.stg_payments(roles.payments(spark, SMALL))
    reviews = staging.stg_reviews(roles.reviews(spark, SMALL))

    def fact():
        return gold.fct_orders(intermediate.int_orders_enriched(orders, one_hot, payments, reviews))

    plain = fact()
    request.addfinalizer(lambda: spark.conf.unset(skew.MIN_ROWS_CONF))
    spark.conf.set(skew.MIN_ROWS_CONF, "20")
    divided = fact()
    assert skew.SALT in divided._jdf.queryExecution().optimizedPlan().toString()
    assert plain.where("order_id = 5").count() > 6000 / 4
    assert same(divided.drop("payment_total_value"), plain.drop("payment_total_value"))


def test_whole_mart_builds_divided(divide, spark):
    raw = {name: role(spark, SMALL) for name, role in roles.RAW_ROLES.items()}
    models = build.build(raw, gold.order_years(raw["olist_orders"]))
    assert models["fct_orders"].count() == 6000


def test_adaptive_skew_join_splits_a_hot_customer(spark, tmp_path, request):
    """The customer report joins two bare shuffles, which adaptive execution can split by itself."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)

    def restore():
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)

    request.addfinalizer(restore)
    hot = "if(id % 3 = 0, 1L, id % 500)"
    spark.range(0, 30000, 1, 8).selectExpr("id as order_id", f"{hot} as customer_id").write.parquet(
        str(tmp_path / "facts")
    )
    spark.range(500).selectExpr("id as customer_id", "id % 9 as customer_state").write.parquet(
        str(tmp_path / "customers")
    )
    facts = spark.read.parquet(str(tmp_path / "facts"))
    customers = spark.read.parquet(str(tmp_path / "customers"))
    report = reports.state_orders(facts, customers)
    assert sum(row["orders"] for row in report.collect()) == 30000
    assert "skew=true" in report._jdf.queryExecution().executedPlan().toString()


# the sketch


def frequent(rows, key="k"):
    return {row[key]: row["_parts"] for row in skew.frequent_keys(rows, key).collect()}


def test_sketch_finds_what_counts_find(divide, spark, lines):
    assert frequent(lines) == {7: 101} == {row["k"]: row["_parts"] for row in hot(lines).collect()}
    text = lines.selectExpr("'order ' || k as k")
    assert frequent(text) == {"order 7": 101}
    assert frequent(lines.where("false")) == {} and frequent(lines.where("k is null")) == {}


def test_sketch_of_more_keys_than_it_keeps(divide, spark):
    """A million keys, of which three are hot; the sketch keeps a small part of them."""
    rows = spark.range(0, 1_500_000, 1, 16).selectExpr("if(id % 3 = 0, id % 9, id + 100) as k")
    found = frequent(rows)
    assert set(found) == {0, 3, 6}
    limit = -(-1_500_000 // skew.HOT_KEYS)
    exact = -(-166_667 // limit)
    assert all(abs(parts - exact) <= 5 for parts in found.values())


def test_sketch_list_is_bounded(divide, spark):
    assert frequent(spark.range(0, 100_000, 1, 8).selectExpr("id % 20000 as k")) == {}
    assert len(frequent(spark.range(0, 100_000, 1, 8).selectExpr("id % 3000 as k"))) == 3000


def test_sketch_replaces_the_shuffle_of_counts(spark):
    """Nothing is shuffled by order to learn which orders are long."""
    items = roles.order_items(spark, SMALL)
    text = skew.frequent_keys(items, "order_id")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(order_id" not in text and "hashpartitioning(l_orderkey" not in text and "approx_top_k" in text
    kpi = driver.kpi_summary(spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "approx_top_k" in kpi and "sum(item" not in kpi and "header" not in kpi

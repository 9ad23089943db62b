"""Finding, reading and loading the CSV files."""

from __future__ import annotations

import datetime as dt

import pytest
from orderloom.functions import whole
from orderloom.plans import quality, staging
from orderloom.sources import csv_tables, shared, warehouse_roles
from orderloom.sources.ingest import drop_tables, ingest, read_raw
from shop import SAMPLE, write_csv

NOW = dt.datetime(2024, 3, 10, 12, 0, tzinfo=dt.timezone.utc)


def write(folder, name: str, text: str) -> str:
    (folder / name).write_text(text, encoding="utf-8")
    return str(folder)


def test_source_directory_order(spark, tmp_path, monkeypatch):
    monkeypatch.delenv(csv_tables.SOURCE_DIR_ENV, raising=False)
    root, given, named = str(tmp_path), tmp_path / "given", tmp_path / "named"
    for folder in (given, named):
        folder.mkdir()
    with pytest.raises(FileNotFoundError):
        csv_tables.resolve_source_dir(spark, root=root)
    for folder in ("raw", "common"):
        (tmp_path / "data" / folder).mkdir(parents=True)
        found = csv_tables.resolve_source_dir(spark, root=root)
        assert found == f"{root}/data/{folder}"
    monkeypatch.setenv(csv_tables.SOURCE_DIR_ENV, str(named))
    assert csv_tables.resolve_source_dir(spark, root=root) == str(named)
    assert csv_tables.resolve_source_dir(spark, str(given), root) == str(given)
    with pytest.raises(FileNotFoundError, match="not found"):
        csv_tables.resolve_source_dir(spark, str(tmp_path / "none"))


def test_alternative_file_name_and_missing_file(spark, tmp_path):
    folder = write(tmp_path, "olist_sellers_dataset.csv", "seller_id\ns1\n")
    rows, path = csv_tables.open_table(spark, "olist_sellers", folder)
    assert path.endswith("olist_sellers_dataset.csv")
    assert rows.count() == 1
    write(tmp_path, "olist_sellers.csv", "seller_id\ns1\ns2\n")
    assert csv_tables.open_table(spark, "olist_sellers", folder)[0].count() == 2
    with pytest.raises(FileNotFoundError, match="olist_orders.csv, olist_orders_dataset.csv"):
        csv_tables.open_table(spark, "olist_orders", folder)


def test_quoted_text_extra_columns_and_their_order(spark, tmp_path):
    folder = write(
        tmp_path,
        "olist_order_reviews.csv",
        "review_comment_message,order_id,review_id,review_score,review_answer_timestamp,"
        "review_creation_date\n"
        '"a ""q"" line\nsecond, with comma",o1,r1,4,2018-01-06 10:00:00,2018-01-06 00:00:00\n'
        ',o2,r2,"",,\n',
    )
    raw, _ = csv_tables.open_table(spark, "olist_order_reviews", folder)
    assert [r["review_comment_message"] for r in raw.collect()] == [
        'a "q" line\nsecond, with comma',
        None,
    ]
    staged = staging.stg_reviews(raw).collect()
    assert [tuple(row) for row in staged] == [
        ("r1", "o1", 4, dt.date(2018, 1, 6), dt.datetime(2018, 1, 6, 10, 0)),
        ("r2", "o2", None, None, None),
    ]


def test_zip_codes_stay_text(spark, tmp_path):
    folder = write(
        tmp_path,
        "olist_customers.csv",
        "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
        "c1,u1,01037,são paulo,SP\n",
    )
    row = staging.stg_customers(csv_tables.open_table(spark, "olist_customers", folder)[0]).first()
    assert row["customer_zip_code_prefix"] == "01037"
    assert row["customer_city"] == "são paulo"


def test_ingest_replaces_stamps_and_reports(spark, tmp_path):
    folder = write_csv(tmp_path, SAMPLE)
    ingest(spark, folder, "load_raw", loaded_at=NOW - dt.timedelta(days=9))
    report = ingest(spark, folder, "load_raw", loaded_at=NOW)
    assert {r["table_name"]: r["row_count"] for r in report.collect()} == {
        table: len(rows) for table, rows in SAMPLE.items()
    }
    assert all(r["source"].endswith(f"{r['table_name']}.csv") for r in report.collect())
    raw = read_raw(spark, "load_raw")
    stamps = quality.load_stamps(raw).selectExpr("count(distinct _loaded_at)", "max(_loaded_at)")
    distinct, newest = stamps.first()
    assert distinct == 1
    assert newest.timestamp() == NOW.timestamp()


def test_ingest_of_chosen_tables_and_cleaning(spark, tmp_path):
    folder = write_csv(tmp_path, SAMPLE, "_dataset")
    write_csv(tmp_path, {k: SAMPLE[k] for k in ["product_category_name_translation"]})
    ingest(spark, folder, "part_raw")
    chosen = ("olist_orders", "olist_sellers")
    report = ingest(spark, folder, "part_raw", chosen, clean=True, lineage=True)
    assert {r["table_name"] for r in report.collect()} == set(chosen)
    assert {t.name for t in spark.catalog.listTables("part_raw")} == set(chosen)
    rows = spark.table("part_raw.olist_orders").select("_load_id", "_row_id").collect()
    assert len({r["_load_id"] for r in rows}) == 1
    assert len({r["_row_id"] for r in rows}) == 4
    assert drop_tables(spark, "part_raw") == 2
    assert drop_tables(spark, "no_such_database") == 0


def test_missing_file_leaves_loaded_tables_alone(spark, tmp_path):
    folder = write_csv(tmp_path, {"olist_orders": SAMPLE["olist_orders"]})
    ingest(spark, folder, "safe_raw", ("olist_orders",))
    with pytest.raises(FileNotFoundError):
        ingest(spark, folder, "safe_raw", ("olist_orders", "olist_sellers"), clean=True)
    assert spark.table("safe_raw.olist_orders").count() == 4


def test_shared_folder_is_the_checkpoint_folder(spark):
    root = spark.conf.get(shared.CHECKPOINT_CONF)
    path = shared.shared_path(spark, "t")
    assert path.startswith(root) and path.endswith("/t")
    written = shared.write_once(spark.range(5).selectExpr("id", "id * 2 as twice"), "numbers")
    assert "FileScan parquet" in written._jdf.queryExecution().executedPlan().toString()
    assert written.selectExpr("sum(twice)").first()[0] == 20


HEADER = "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"


def test_quoted_line_break_in_any_table_that_asks_for_it(spark, tmp_path):
    folder = write(tmp_path, "olist_customers.csv", HEADER + 'c1,u1,01000,"sao\npaulo",SP\n')
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        csv_tables.open_table(spark, "olist_customers", folder)[0].collect()
    rows, _ = csv_tables.open_table(spark, "olist_customers", folder, multiline=True)
    assert [tuple(row) for row in rows.collect()] == [("c1", "u1", "01000", "sao\npaulo", "SP")]
    report = ingest(spark, folder, "multi_raw", ("olist_customers",), multiline=("olist_customers",))
    assert report.first()["row_count"] == 1


@pytest.mark.parametrize("row", ["c1,u1,01000,sao paulo,SP,more", "c1,u1,01000,sao paulo"])
def test_long_and_short_rows_stop_the_read(spark, tmp_path, row):
    folder = write(tmp_path, "olist_customers.csv", f"{HEADER}c0,u0,1,a,SP\n{row}\n")
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        csv_tables.open_table(spark, "olist_customers", folder)[0].collect()


def test_folder_of_files_with_different_headers_stops_the_read(spark, tmp_path):
    folder = tmp_path / "olist_sellers.csv"
    folder.mkdir()
    write(folder, "a.csv", "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,1,c,SP\n")
    write(folder, "b.csv", "seller_state,seller_city,seller_zip_code_prefix,seller_id\nRJ,c,2,s2\n")
    rows, _ = csv_tables.open_table(spark, "olist_sellers", str(tmp_path))
    with pytest.raises(Exception, match="header"):
        rows.collect()


def test_whole_numbers(spark):
    text = spark.createDataFrame(
        [("500.0",), ("2.7",), ("2.5",), ("-2.5",), ("7",), (" 8 ",), ("",), (None,), ("1e3",)], "v string"
    )
    want = [500, 3, 3, -3, 7, 8, None, None, 1000]  # as the SQL engine casts them
    before = spark.conf.get("spark.sql.ansi.enabled")
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            assert [r["v"] for r in text.select(whole(text, "v").alias("v")).collect()] == want
            for wrong in ("abc", "2147483648"):
                bad = spark.createDataFrame([(wrong,)], "v string")
                with pytest.raises(Exception, match="not a whole number"):
                    bad.select(whole(bad, "v")).collect()
        finally:
            spark.conf.set("spark.sql.ansi.enabled", before)
    doubles = spark.createDataFrame([(2.5,), (3.5,), (-1.2,)], "v double")
    assert [r[0] for r in doubles.select(whole(doubles, "v")).collect()] == [2, 4, -1]


def test_absent_parquet_column_is_an_error(spark, tmp_path):
    spark.range(3).selectExpr("id as n_nationkey").write.parquet(f"{tmp_path}/nation.parquet")
    with pytest.raises(ValueError, match="n_name"):
        warehouse_roles._table(spark, str(tmp_path), "nation")
    with pytest.raises(ValueError, match="l_tax"):
        short = "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_returnflag l_shipdate"
        columns = [f"1L as {name}" for name in short.split()]
        spark.range(1).selectExpr(*columns).write.parquet(f"{tmp_path}/lineitem.parquet")
        warehouse_roles.order_items(spark, str(tmp_path))


def test_no_tables_is_an_empty_report(spark, tmp_path):
    assert ingest(spark, str(tmp_path), "none_raw", ()).count() == 0

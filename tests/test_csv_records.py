"""CSV files with line breaks inside quotes, read by many tasks."""

from __future__ import annotations

import csv
import io
import random

import pytest
from orderloom.sources import csv_records, csv_tables
from orderloom.sources.ingest import TooManyBadRows, ingest

NAMES = ["a", "b", "c"]


@pytest.fixture
def small_splits(spark):
    """Files are cut every so many bytes, also in the middle of records and of quoted fields."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {key: spark.conf.get(key) for key in keys}

    def cut(size: int):
        spark.conf.set(keys[0], str(size))
        spark.conf.set(keys[1], "1")

    yield cut
    for key, value in before.items():
        spark.conf.set(key, value)


def as_csv(rows, end="\n", names=NAMES) -> str:
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows([names, *rows])
    return out.getvalue()


def save(path, text: str) -> str:
    path.write_bytes(text.encode())
    return str(path)


def plain(text: str) -> list[tuple]:
    """What Python's own reader makes of it, empty fields as None."""
    return [tuple(v or None for v in row) for row in csv.reader(io.StringIO(text, newline="")) if row][1:]


def found(df) -> list[tuple]:
    return [tuple(v or None for v in row) for row in df.collect()]


def some_rows(rng, n: int, long: int):
    fields = ["", "plain", "tail ", "é ñ", "1,2", '"', 'say ""', " lead", "a\nb", "\n", "x\r\ny", "\n\n,\n", "line\n" * long, 'q"\n' * 5]
    return [[rng.choice(fields) if rng.random() < 0.7 else f"{rng.random()}" for _ in NAMES[:-1]] + [str(i)] for i in range(n)]


@pytest.mark.parametrize("size", [97, 1000, 1 << 20])
def test_equals_a_reader_that_sees_the_whole_file(spark, tmp_path, small_splits, size):
    rng = random.Random(size)
    text = as_csv(some_rows(rng, 60, 60 if size == 97 else 400))
    small_splits(size)
    rows = csv_records.read_records(spark, save(tmp_path / "t.csv", text), NAMES)
    assert sorted(found(rows), key=str) == sorted(plain(text), key=str)
    # Spark's own multi-line reader, which is one task, agrees but for carriage returns.
    one = spark.read.options(header=True, quote='"', escape='"', multiLine=True).csv(str(tmp_path / "t.csv"))
    assert [r.c for r in one.orderBy("c").collect()] == [r.c for r in rows.orderBy("c").collect()]


def test_many_tasks_read_one_file(spark, tmp_path, small_splits):
    path = save(tmp_path / "t.csv", as_csv(some_rows(random.Random(1), 200, 5)))
    small_splits(1000)
    assert csv_tables.read_csv(spark, path, multiline=True).rdd.getNumPartitions() > 4
    assert spark.read.options(header=True, multiLine=True).csv(path).rdd.getNumPartitions() == 1


def test_record_over_many_splits_and_line_numbers(spark, tmp_path, small_splits):
    text = 'a,b,c\n1,x,"' + "long line\n" * 300 + '"\n2,y\n\n3,"z\nz",w,too many\n4,v,w\n'
    small_splits(128)
    rows = csv_records.read_records(spark, save(tmp_path / "t.csv", text), NAMES, keep_bad=True).collect()
    good = [r for r in rows if r._bad_record is None]
    assert sorted((r.a, r.b, len(r.c)) for r in good) == [("1", "x", 3000), ("4", "v", 1)]
    bad = {r._bad_line: r for r in rows if r._bad_record is not None}
    assert {n: r._bad_record for n, r in bad.items()} == {303: "2,y", 305: '3,"z\nz",w,too many'}
    assert all(r._bad_file.endswith("t.csv") and (r.a, r.b, r.c) == (None, None, None) for r in bad.values())


def test_windows_line_ends_and_a_quote_left_open(spark, tmp_path, small_splits):
    text = as_csv([["1", "x\r\ny", ""], ["2", "", "z"]], "\r\n") + '3,"open,\r\nto the end'
    small_splits(16)
    rows = csv_records.read_records(spark, save(tmp_path / "t.csv", text), NAMES, keep_bad=True)
    got = sorted(((r.a, r.b, r.c, r._bad_record, r._bad_line) for r in rows.collect()), key=str)
    assert got[:2] == [("1", "x\r\ny", None, None, None), ("2", None, "z", None, None)]
    assert got[2][3:] == ('3,"open,\r\nto the end', 5)


def test_folder_is_read_by_name(spark, tmp_path, small_splits):
    folder = tmp_path / "t.csv"
    folder.mkdir()
    save(folder / "1.csv", as_csv([["1", "b\n1", "c1"]]))
    save(folder / "2.csv", as_csv([["c2", "2", 'b"2']], names=["c", "a", "b"]) + "c,a,b\n")
    save(folder / "3.csv", "\n\n" + as_csv([]))
    small_splits(8)
    want = [("1", "b\n1", "c1"), ("2", 'b"2', "c2"), ("a", "b", "c")]
    assert sorted(found(csv_records.read_records(spark, str(folder), NAMES)), key=str) == want
    assert sorted(found(csv_tables.read_csv(spark, str(folder), multiline=True).select(*NAMES)), key=str) == want
    save(folder / "4.csv", as_csv([], names=["a", "b", "other"]))
    with pytest.raises(ValueError, match="header.*4.csv"):
        csv_records.read_records(spark, str(folder), NAMES)


def test_single_lines_are_numbered_without_python(spark, tmp_path, small_splits):
    text = "a,b,c\r\n" + "".join(f"{i},x,{'y,z' if i % 7 == 0 else 'y'}\r\n" for i in range(100)) + '100,"open,y\n'
    path = save(tmp_path / "t.csv", text)
    small_splits(50)
    rows = csv_records.read_records(spark, path, NAMES, breaks=False, keep_bad=True)
    assert "Python" not in rows._jdf.queryExecution().toString() and "MapInArrow" not in rows._jdf.queryExecution().toString()
    got = rows.collect()
    bad = {r._bad_line: r._bad_record for r in got if r._bad_record is not None}
    assert bad == {i + 2: f"{i},x,y,z" for i in range(0, 100, 7)} | {102: '100,"open,y'}
    assert len(got) == 101 and {r.c for r in got} == {"y", None}


def test_strict_reading_stops(spark, tmp_path):
    path = save(tmp_path / "t.csv", 'a,b,c\n1,"x\n",y\n2,z\n')
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        csv_records.read_records(spark, path, NAMES).collect()


def test_empty_files(spark, tmp_path):
    assert csv_records.read_records(spark, save(tmp_path / "t.csv", "a,b,c\n"), NAMES).count() == 0
    assert csv_records.read_records(spark, save(tmp_path / "u.csv", "a,b,c"), NAMES, breaks=False, keep_bad=True).count() == 0


# malformed rows set aside

SELLERS = "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"


def test_bad_rows_are_set_aside_and_counted(spark, tmp_path):
    (tmp_path / "olist_sellers.csv").write_text(SELLERS + "s1,01000,a,SP\ns2,2,b\ns3,3,c,RJ,more\ns4,4,d,MG\n")
    report = ingest(spark, str(tmp_path), "aside_raw", ("olist_sellers",), most_bad=0.5).first()
    assert (report.row_count, report.bad_count) == (2, 2)
    assert sorted(r.seller_id for r in spark.table("aside_raw.olist_sellers").collect()) == ["s1", "s4"]
    assert spark.table("aside_raw.olist_sellers").columns == [*SELLERS.strip().split(","), "_loaded_at"]
    rejected = spark.table("aside_raw.olist_sellers_rejected").orderBy("_bad_line").collect()
    assert [(r._bad_line, r._bad_record) for r in rejected] == [(3, "s2,2,b"), (4, "s3,3,c,RJ,more")]
    assert rejected[0]._bad_file.endswith("olist_sellers.csv") and rejected[0]._loaded_at is not None


def test_too_many_bad_rows_leave_the_old_table(spark, tmp_path):
    file = tmp_path / "olist_sellers.csv"
    file.write_text(SELLERS + "s1,01000,a,SP\n")
    ingest(spark, str(tmp_path), "share_raw", ("olist_sellers",), most_bad=0.0)
    assert spark.table("share_raw.olist_sellers_rejected").count() == 0
    file.write_text(SELLERS + "s5,1,a,SP\ns6\n")
    with pytest.raises(TooManyBadRows, match="olist_sellers: 1 of 2"):
        ingest(spark, str(tmp_path), "share_raw", ("olist_sellers",), most_bad=0.4)
    assert [r.seller_id for r in spark.table("share_raw.olist_sellers").collect()] == ["s1"]
    file.write_text(SELLERS + "s6\n")
    report = ingest(spark, str(tmp_path), "share_raw", ("olist_sellers",), most_bad=1.0).first()
    assert (report.row_count, report.bad_count) == (0, 1)
    assert spark.table("share_raw.olist_sellers").count() == 0
    assert spark.table("share_raw.olist_sellers_rejected").count() == 1


def test_lines_meet_their_split_without_being_dealt_or_sorted(spark, tmp_path, small_splits):
    """A task that had to gather or sort a split would hold all of its rows."""
    save(tmp_path / "t.csv", as_csv([(str(i), "x", "y") for i in range(300)]))
    small_splits(256)
    df = csv_records.lines(spark, str(tmp_path / "t.csv"))
    counted = csv_records.write_once(csv_records.splits(df, NAMES), "splits")
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")  # as if the sizes were not known
    try:
        rows = csv_records.single_lines(df, counted)
        plan = rows._jdf.queryExecution().executedPlan().toString().split("\n")
        lines = rows.collect()
    finally:
        spark.conf.set(limit, before)
    assert "BroadcastHashJoin" in next(step for step in plan if "Join" in step)  # the last join, that of the lines
    assert sorted(r.line for r in lines) == list(range(2, 302))


def test_both_folders_are_written_without_a_sort(spark, tmp_path, monkeypatch):
    from orderloom.sources import ingest as loading

    seen, stage = [], loading.publish.stage
    monkeypatch.setattr(loading.publish, "stage", lambda *a: (seen.append(spark.conf.get(loading.WRITERS)), stage(*a))[1])
    before = spark.conf.get(loading.WRITERS)
    text = "seller_id,seller_city\ns1,x\ns2\ns3,y,z\n"
    save(tmp_path / "olist_sellers.csv", text)
    report = ingest(spark, str(tmp_path), "raw_sortless", ("olist_sellers",), most_bad=1.0).first()
    assert int(seen[0]) >= 2 and spark.conf.get(loading.WRITERS) == before
    assert (report.row_count, report.bad_count) == (1, 2)
    assert [r.seller_id for r in spark.table("raw_sortless.olist_sellers").collect()] == ["s1"]
    assert spark.table("raw_sortless.olist_sellers_rejected").count() == 2

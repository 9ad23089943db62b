"""Loading CSV tables into a raw database: full replace, load stamp, report, malformed rows set aside."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Collection, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager, nullcontext
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import publish
from .csv_records import BAD
from .csv_tables import RAW_TABLES, open_table
from .publish import Staged, create_database

LOADED_AT = "_loaded_at"


def stamp(df: DataFrame, loaded_at: dt.datetime, load_id: str | None = None) -> DataFrame:
    """Add the load instant, one for the whole run, and on request where each row came from."""
    df = df.withColumn(LOADED_AT, F.lit(loaded_at).cast("timestamp"))
    if load_id is not None:
        df = df.withColumn("_load_id", F.lit(load_id)).withColumn("_row_id", F.expr("uuid()"))
    return df


def drop_tables(spark: SparkSession, database: str) -> int:
    """Drop every table of a database and return how many there were."""
    if not spark.catalog.databaseExists(database):
        return 0
    tables = [t for t in spark.catalog.listTables(database) if not t.isTemporary]
    for table in tables:
        publish.drop(spark, database, table.name)
    return len(tables)


class TooManyBadRows(RuntimeError):
    """More rows of a file are malformed than the load may set aside."""


#: Where the malformed rows of a table go, and the column that parts them from the others.
REJECTED, IS_BAD = "{}_rejected", "is_bad"

#: Files that a task may write side by side; with 0, Spark's default, it sorts its rows by folder first.
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def _both_folders(spark: SparkSession) -> Iterator[None]:
    """While tables are written to two folders, a task keeps a file open in each and sorts nothing, so
    that it holds none of its rows."""
    before = spark.conf.get(WRITERS)
    spark.conf.set(WRITERS, str(max(2, int(before))))
    try:
        yield
    finally:
        spark.conf.set(WRITERS, before)


def _stage(df: DataFrame, database: str, table: str, keep_bad: bool) -> list[Staged]:
    """A raw table written aside, and behind it the table of its malformed rows if they are kept.

    Both come from one pass over the file: rows are written to a folder each, and counted there.
    """
    if not keep_bad:
        return [publish.stage(df, database, table)]
    bad = F.col(BAD[0]).isNotNull()
    counted = F.count_if(bad).alias("bad_count")
    both = publish.stage(df.withColumn(IS_BAD, bad), database, table, (IS_BAD,), (counted,))
    good = StructType([f for f in df.schema if f.name not in BAD])
    own = [f for f in df.schema if f.name in (*BAD, LOADED_AT)]
    return [
        replace(both, schema=good, partitions=(), part=f"{IS_BAD}=false"),
        replace(both, table=REJECTED.format(table), schema=StructType(own), partitions=(), part=f"{IS_BAD}=true"),
    ]


def ingest(
    spark: SparkSession,
    source_dir: str,
    database: str = "raw",
    tables: Sequence[str] = tuple(RAW_TABLES),
    loaded_at: dt.datetime | None = None,
    location: str | None = None,
    clean: bool = False,
    lineage: bool = False,
    multiline: Collection[str] = (),
    most_bad: float | None = None,
) -> DataFrame:
    """Replace the chosen raw tables by their CSV files and report what was loaded.

    ``clean`` also drops the tables of the database that are not loaded now; ``lineage`` adds a load
    id and a row id; ``multiline`` names further tables with line breaks inside quotes. All files are
    located before anything is written, all tables are written aside and their counts compared before
    the first is replaced: a load that fails leaves every table as it was.

    A malformed row, one with more or fewer fields than the header, stops the load. With ``most_bad``,
    a share of a file's rows, such rows are set aside instead, in ``<table>_rejected`` with their file
    and line, and only a greater share stops the load. Rows are counted while they are written. The
    report has table_name, row_count, bad_count and source.
    """
    loaded_at = loaded_at or dt.datetime.now(dt.timezone.utc)
    load_id = uuid.uuid4().hex if lineage else None
    keep_bad = most_bad is not None
    found = {table: open_table(spark, table, source_dir, table in multiline, keep_bad) for table in tables}
    create_database(spark, database, location)

    def write(table: str) -> list[Staged]:
        return _stage(stamp(found[table][0], loaded_at, load_id), database, table, keep_bad)

    folders = _both_folders(spark) if keep_bad else nullcontext()
    with folders, ThreadPoolExecutor(max(1, len(found))) as pool:  # small tables do not wait for large ones
        jobs = {table: pool.submit(write, table) for table in found}
    staged = {table: job.result() for table, job in jobs.items() if job.exception() is None}
    every = [one for some in staged.values() for one in some]
    report = []
    try:
        for table, job in jobs.items():
            if job.exception() is not None:
                raise job.exception()
            rows = staged[table][0].observed["row_count"]
            bad = staged[table][0].observed.get("bad_count", 0)
            if keep_bad and bad > most_bad * rows:
                raise TooManyBadRows(f"{table}: {bad} of {rows} rows are malformed, {most_bad:.2%} may be")
            report.append((table, rows - bad, bad, found[table][1]))
    except BaseException:
        publish.discard(spark, every)
        raise
    if clean:
        names = {one.table for one in every}
        for old in spark.catalog.listTables(database):
            if not old.isTemporary and old.name not in names:
                publish.drop(spark, database, old.name)
    publish.publish(spark, every)
    return spark.createDataFrame(
        report, "table_name string, row_count bigint, bad_count bigint, source string"
    )


def read_raw(
    spark: SparkSession, database: str = "raw", tables: Sequence[str] = tuple(RAW_TABLES)
) -> dict[str, DataFrame]:
    return {table: spark.table(f"{database}.{table}") for table in tables}

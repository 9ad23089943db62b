"""Replacing a table in steps: write aside, compare counts, then point the table at the new files.

Readers see the old rows or the new ones, never none or a part: until a table is pointed at its new
folder nothing of it is touched, and a write that fails leaves it as it was. The folder replaced
last stays for readers that have begun; older ones are deleted.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

ROWS = "row_count"


class IncompleteWrite(RuntimeError):
    """The files of a staged table hold another number of rows than were written."""


@dataclass
class Staged:
    """A table written aside. ``path`` is its folder, ``part`` what of it belongs to the table, and
    ``observed`` what was measured while it was written."""

    database: str
    table: str
    path: str
    schema: StructType
    partitions: tuple[str, ...] = ()
    part: str = ""
    observed: dict = field(default_factory=dict)

    @property
    def location(self) -> str:
        return f"{self.path}/{self.part}" if self.part else self.path

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self.schema).parquet(self.location)


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION {quoted(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")


def _folder(spark: SparkSession, database: str, table: str) -> str:
    """Where a table's folders are: not where the database would put a table of its own, as that
    place goes with the table when it is dropped."""
    return f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/{table}__files"


def _files(spark: SparkSession, path: str):
    """The store a path is in, and the path as that store's own."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _delete(spark: SparkSession, path: str) -> None:
    store, at = _files(spark, path)
    store.delete(at, True)


def stage(
    df: DataFrame,
    database: str,
    table: str,
    partitions: Sequence[str] = (),
    measures: Sequence[Column] = (),
) -> Staged:
    """Write ``df`` to a fresh folder of the table and compare the number of rows in its files, which
    their footers tell, with the number written. ``measures`` are aggregates to take on the way."""
    spark = df.sparkSession
    path = f"{_folder(spark, database, table)}/v{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    written = Observation()
    out = Staged(database, table, path, df.schema, tuple(partitions))
    try:
        counted = df.observe(written, F.count(F.lit(1)).alias(ROWS), *measures)
        counted.write.partitionBy(*partitions).parquet(path)
        out.observed = dict(written.get)
        found = out.read(spark).count()
        if found != out.observed[ROWS]:
            raise IncompleteWrite(f"{database}.{table}: {out.observed[ROWS]} rows written, {found} found")
    except BaseException:
        discard(spark, [out])
        raise
    return out


def discard(spark: SparkSession, staged: Sequence[Staged]) -> None:
    """Delete tables that were staged and will not be published."""
    for table in staged:
        _delete(spark, table.path)


def _described(spark: SparkSession, name: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    return {row.col_name: row.data_type for row in rows}


def publish(spark: SparkSession, staged: Sequence[Staged], keep: int = 1) -> dict[str, DataFrame]:
    """Point each table at its staged folder, then delete folders older than the ``keep`` last ones.

    A table with the same columns and no partitions gets its new place in one step. One whose columns
    change, or whose partitions the catalog lists, is declared anew, which moves no data either; if
    that fails it is declared as it was.
    """
    for new in staged:
        name = f"{new.database}.{new.table}"
        exists = spark.catalog.tableExists(name)
        old = _described(spark, name) if exists else {}
        same = exists and old.get("Type") == "EXTERNAL" and spark.table(name).schema == new.schema
        if same and not new.partitions and "# Partition Information" not in old:
            spark.sql(f"ALTER TABLE {name} SET LOCATION {quoted(new.location)}")
            spark.catalog.refreshTable(name)
        else:
            _declare(spark, name, new, old)
    for new in staged:
        _prune(spark, new, keep)
    return {new.table: spark.table(f"{new.database}.{new.table}") for new in staged}


def _declare(spark: SparkSession, name: str, new: Staged, old: dict[str, str]) -> None:
    def create(schema: StructType, location: str, partitions: Sequence[str]) -> None:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        by = f" PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet{by} LOCATION {quoted(location)}")
        if partitions:
            spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")

    before = None
    if old:
        if old.get("Type") == "EXTERNAL":
            columns = spark.table(name).schema
            by = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
            before = columns, old["Location"], by
        spark.sql(f"DROP TABLE {name}")
    try:
        create(new.schema, new.location, new.partitions)
    except BaseException:
        if before:
            create(*before)
        raise


def _prune(spark: SparkSession, new: Staged, keep: int) -> None:
    store, folder = _files(spark, _folder(spark, new.database, new.table))
    if not store.exists(folder):
        return
    found = sorted(s.getPath().getName() for s in store.listStatus(folder) if s.getPath().getName().startswith("v"))
    current = new.path.rsplit("/", 1)[1]
    older = [name for name in found if name < current]
    for name in older[: max(0, len(older) - keep)]:
        _delete(spark, f"{_folder(spark, new.database, new.table)}/{name}")


def drop(spark: SparkSession, database: str, table: str) -> None:
    """Drop a table with all its folders."""
    spark.sql(f"DROP TABLE IF EXISTS {database}.{table}")
    _delete(spark, _folder(spark, database, table))

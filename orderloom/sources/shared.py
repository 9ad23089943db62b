"""Tables written once and read several times within one run."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder all executors share.

    The folder is the session's checkpoint directory, from the setting or from setCheckpointDir.
    Only a local session without either gets a temporary folder, as the machine's own disk is then
    the shared one.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except PySparkException:  # a Connect session has no context
            root = None
    if not root:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder all executors reach")
        root = tempfile.mkdtemp(prefix="orderloom-")
    return f"{root.rstrip('/')}/orderloom-{uuid.uuid4().hex}/{name}"


def measured(df: DataFrame, measures: Sequence[Column], path: str | None = None) -> dict:
    """Aggregates of ``df`` taken while its rows are written to ``path``, or while they pass by."""
    seen = Observation()
    rows = df.observe(seen, *measures).write
    rows.parquet(path) if path else rows.format("noop").mode("overwrite").save()
    return dict(seen.get)


def write_measured(df: DataFrame, name: str, measures: Sequence[Column]) -> tuple[DataFrame, dict]:
    """``write_once``, with aggregates taken on the way."""
    path = shared_path(df.sparkSession, name)
    found = measured(df, measures, path)
    return df.sparkSession.read.schema(df.schema).parquet(path), found


def write_once(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet to the shared folder and return the table read back: its readers
    prune columns, and a lost executor costs no more than reading a file again."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""Compare every query with its SQL on a test data directory: ``python tests/oracle_check.py DIR``."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def normal(df: pd.DataFrame) -> pd.DataFrame:
    """Columns and rows in a fixed order, values as text of their plain Python form."""
    df = df[sorted(df.columns)].copy()
    for name in df.columns:
        column = df[name]
        if pd.api.types.is_float_dtype(column):
            column = column.map(lambda v: "" if pd.isna(v) else repr(float(v)))
        elif pd.api.types.is_datetime64_any_dtype(column) or column.dtype == object:
            column = column.map(
                lambda v: ""
                if pd.isna(v)
                else str(pd.Timestamp(v)) if hasattr(v, "year") else str(v)
            )
        df[name] = column.astype(str)
    return df.sort_values(list(df.columns), ignore_index=True)


def difference(ours: pd.DataFrame, theirs: pd.DataFrame) -> str | None:
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} != {sorted(theirs.columns)}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    a, b = normal(ours), normal(theirs)
    if not a.equals(b):
        unequal = (a != b).any(axis=1)
        return f"values\n{a[unequal].head(3)}\n{b[unequal].head(3)}"
    return None


def main(sf_dir: str, only: list[str]) -> int:
    import __spark_entry__ as spark_entry
    from orderloom.session import local_session

    spark = local_session()
    con = duck(sf_dir)
    oracle, wrong = spark_entry.oracle_sql(), 0
    for name, query in spark_entry.queries().items():
        if name not in oracle or (only and name not in only):
            continue
        start = time.time()
        ours = query(spark, sf_dir).toPandas()
        spent = time.time() - start
        problem = difference(ours, con.execute(oracle[name]).df())
        wrong += problem is not None
        print(f"{name:24s} {len(ours):8d} rows {spent:6.2f}s {problem or 'ok'}", flush=True)
    return wrong


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))

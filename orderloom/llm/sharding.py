"""Rendezvous hashing of stable record keys over weighted shards. DataFrame functions only.

Every (key, shard) pair has its own pseudo-random number and the shard with the best weighted one
takes the record. A new shard can only win records, never move them between the others.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import write_once

#: Numbering cells of each shard: rows are numbered within a cell, cells are counted up.
CELLS = 1024
#: Copies of one row that are numbered by one task at a time.
RUN = 100_000


def _number(key: str, salt: str) -> str:
    """52 bits of the MD5 of key and salt, as SQL text."""
    return f"cast(conv(substr(md5(concat({key}, '/{salt}')), 1, 13), 16, 10) as bigint)"


def rendezvous(key: str, weights: Mapping[int, float] | Sequence[float]) -> Column:
    """The shard of a text key: the least of -ln(u) / weight, ties to the smaller shard number.

    A null key is treated as the text ``null``. Weights must be positive; a shard gets records in
    proportion to its weight.
    """
    shards = dict(weights) if isinstance(weights, Mapping) else dict(enumerate(weights))
    if not shards or min(shards.values()) <= 0:
        raise ValueError("at least one shard, and every weight above 0")
    key = f"coalesce({key}, 'null')"
    tries = [
        f"struct(-ln(({_number(key, str(s))} + 0.5D) / 4503599627370496D) / {float(w)!r}D as cost, {s} as shard)"
        for s, w in sorted(shards.items())
    ]
    if len(tries) == 1:
        return F.expr(f"{min(shards)}")
    return F.expr(f"least({', '.join(tries)}).shard")


def assign(df: DataFrame, key: str, weights, out: str = "shard") -> DataFrame:
    """``df`` with the shard of each row; narrow, no shuffle. ``key`` is an SQL expression."""
    return df.withColumn(out, rendezvous(f"cast({key} as string)", weights))


def number(rows: DataFrame, shard: str = "shard", key: str = "doc_id") -> DataFrame:
    """Give the rows of each shard gapless numbers from 0 in column ``slot``.

    Equal rows are counted before the shuffle and expanded again after it in runs, so a row that
    makes up a third of the input never meets in one task. Order: cell of the key, then the columns.
    """
    columns = rows.columns
    text = f"coalesce(cast({key} as string), 'null')"
    groups = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    groups = groups.withColumn("_cell", F.expr(f"{_number(text, 'cell')} % {CELLS}"))
    groups = write_once(groups, "groups")
    cells = groups.groupBy(shard, "_cell").agg(F.sum("_n").alias("_sum"))
    # At most CELLS rows for each shard, whatever the input: bounded for the window and the broadcast.
    before = cells.selectExpr(
        f"{shard}", "_cell",
        f"coalesce(sum(_sum) over (partition by {shard} order by _cell "
        "rows between unbounded preceding and 1 preceding), 0) as _before",
    )
    order = ", ".join(columns)
    placed = groups.join(F.broadcast(before), [shard, "_cell"]).selectExpr(
        *columns, "_n",
        f"_before - _n + sum(_n) over (partition by {shard}, _cell order by {order} "
        "rows between unbounded preceding and current row) as _first",
    )
    placed = write_once(placed, "placed")
    single = placed.where("_n = 1").selectExpr(*columns, "_first as slot")
    runs = placed.where("_n > 1").selectExpr(
        *columns, "_first + _n as _end", f"explode(sequence(_first, _first + _n - 1, {RUN}L)) as _run"
    )
    copies = runs.repartition("_run").selectExpr(
        *columns, f"explode(sequence(_run, least(_end, _run + {RUN}) - 1)) as slot"
    )
    return single.union(copies)


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Equal shards by doc_id, with what becomes of each document when one more shard is added.

    size: UTF-8 bytes of the text plus 1; text_crc32: of the UTF-8 bytes. A null text has no bytes.
    Repeated rows and null doc_ids are numbered like any other row; an empty table gives no rows.
    """
    text = "coalesce(cast(text as binary), X'')"
    rows = docs.selectExpr(
        "cast(doc_id as bigint) as doc_id",
        f"cast(octet_length({text}) + 1 as bigint) as size",
        f"crc32({text}) as text_crc32",
        "'key' as law",
    )
    rows = assign(rows, "doc_id", [1.0] * shards)
    rows = assign(rows, "doc_id", [1.0] * (shards + 1), "grown_shard")
    return number(rows).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )

"""Equi-joins that stay balanced when one key holds a large share of the rows.

Adaptive skew handling only splits a join whose two inputs are bare shuffles. The order-level side
of the mart's central join is itself a chain of joins and aggregates, so it would never be split.
Hot keys are therefore divided explicitly: rows of a hot key are dealt over several splits and the
matching rows of the other side are copied to each of them. Which keys are hot follows from counts
per key alone, or from a sketch of them; a join without hot keys runs the same plan with an empty list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows that one split of a hot key should hold.
MIN_ROWS_CONF = "spark.orderloom.skew.minRowsPerSplit"
DEFAULT_MIN_ROWS = 1_000_000

# A hot key holds more than 1 / HOT_KEYS of all rows: there are fewer than HOT_KEYS of them,
# whatever the input, and their list may be broadcast.
HOT_KEYS = 1 << 14

SALT = "_salt"


def hot_keys(counts: DataFrame, key: str, rows: str) -> DataFrame:
    """Keys with too many rows for one task and their number of splits: (key, _parts).

    ``counts`` has one row per key with its number of rows. A split holds the configured number of
    rows, or more where the input is so large that there would be too many splits to list.
    """
    least = int(counts.sparkSession.conf.get(MIN_ROWS_CONF, str(DEFAULT_MIN_ROWS)))
    share = counts.selectExpr(f"coalesce(ceil(sum({rows}) / {HOT_KEYS}), 0)").scalar()
    limit = F.greatest(F.lit(least).cast("bigint"), share)
    sized = counts.where(F.col(key).isNotNull()).withColumn("_limit", limit)
    return sized.where(f"{rows} > _limit").selectExpr(
        key, f"cast(ceil({rows} / _limit) as int) as _parts"
    )


#: Keys a sketch keeps. Its counts are off by at most 3.5 rows in this many, less than the share that
#: makes a key hot, so no hot key is missed.
TRACKED = 1 << 16
#: Groups in which the sketches of the tasks are merged before one task merges theirs.
MERGERS = 256


def frequent_keys(rows: DataFrame, key: str) -> DataFrame:
    """``hot_keys`` of ``rows`` by a sketch of frequent items instead of a count per key.

    Nothing is shuffled but the sketches, at most TRACKED keys for each task. Counts may be off by
    a little, so a key just at the limit may or may not be divided; joins give the same either way.
    """
    least = int(rows.sparkSession.conf.get(MIN_ROWS_CONF, str(DEFAULT_MIN_ROWS)))
    merged = (
        rows.where(F.col(key).isNotNull())
        .groupBy(F.expr(f"pmod(spark_partition_id(), {MERGERS})").alias("_merger"))
        .agg(F.expr(f"approx_top_k_accumulate({key}, {TRACKED}) as _sketch"), F.expr("count(*) as _rows"))
        .groupBy(F.lit(0).alias("_all"))  # no group, and no sketch to merge, where there are no rows
        .agg(F.expr(f"approx_top_k_combine(_sketch, {TRACKED}) as _sketch"), F.expr("sum(_rows) as _rows"))
    )
    limit = f"greatest({least}L, cast(ceil(_rows / {HOT_KEYS}) as bigint)) as _limit"
    listed = merged.selectExpr(
        limit, f"inline(approx_top_k_estimate(_sketch, {HOT_KEYS})) as (_item, _count)"
    )
    return listed.where("_count > _limit").selectExpr(
        f"_item as {key}", "cast(ceil(_count / _limit) as int) as _parts"
    )


def _parts(df: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    return df.join(F.broadcast(hot), key, "left").withColumn(
        "_parts", F.coalesce("_parts", F.lit(1))
    )


def deal(df: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    """Give each row one split of its key.

    Rows are dealt in turn by their number within the scan's partition: exact copies and the rows of
    a single file spread too, and a re-run task deals its rows the same way again. ``df`` should be
    a scan with narrow steps only.
    """
    numbered = df.withColumn("_number", F.monotonically_increasing_id())
    dealt = F.pmod("_number", "_parts").cast("int")
    return _parts(numbered, hot, key).withColumn(SALT, dealt).drop("_parts", "_number")


def _copy(df: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    """Repeat each row once per split of its key on the other side."""
    every = F.sequence(F.lit(0), F.col("_parts") - 1)
    return _parts(df, hot, key).withColumn(SALT, F.explode(every)).drop("_parts")


def spread_join(left: DataFrame, right: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """The inner join ``left.join(right, key)`` with the hot keys of ``left`` divided.

    Every pair of matching rows meets in exactly one split, so the result is that of the plain
    join. Both sides are taken to be unbounded and are shuffled and merged: without the hint a
    compressed file just under the broadcast limit would have the longest table broadcast.
    """
    dealt, copied = deal(left, hot, key), _copy(right, hot, key)
    return dealt.hint("merge").join(copied, [key, SALT]).drop(SALT)

"""Approximate nearest neighbours by cross-polytope hashing.

A pseudo-rotation (random signs, then a fast Hadamard transform, three times) is followed by the
nearest signed axis. Several rotations give several tables. A query looks into the buckets of the
axes that its rotated vector is nearest to; within a bucket, queries meet vectors in blocks of numpy
rows and only the best few of each block leave it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, write_once
from .vectors import common_size, cosines, matrix, scaled, usable

#: Tables, buckets each query opens in a table, and polytopes joined to one bucket. One polytope
#: parts the vectors into twice their size, so a table of n vectors wants log(n / BLOCK) / log(2 * size).
TABLES, PROBES, POLYTOPES = 8, 10, 1
#: Vectors, and queries, that meet at once.
BLOCK = 2048


class Rotations:
    """Seeded pseudo-rotations of vectors padded to a power of two."""

    def __init__(self, size: int, tables: int, polytopes: int, seed: int):
        self.size, self.polytopes = size, polytopes
        self.wide = 1 << max(1, (size - 1).bit_length())
        self.count = (2 * self.wide) ** polytopes
        self.signs = np.random.default_rng(seed).choice([-1.0, 1.0], (tables, polytopes, 3, self.wide))

    def axes(self, x: np.ndarray, t: int, p: int) -> np.ndarray:
        """How near each row is to each signed axis."""
        y = np.zeros((len(x), self.wide))
        y[:, : self.size] = x
        for signs in self.signs[t, p]:
            y = y * signs
            step = 1
            while step < self.wide:
                y = y.reshape(len(x), -1, 2, step)
                y = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(len(x), -1)
                step *= 2
            y /= np.sqrt(self.wide)
        return np.hstack([y, -y])

    def buckets(self, x: np.ndarray, t: int, probes: int) -> np.ndarray:
        """The nearest buckets of each row, best first."""
        best, value = np.zeros((len(x), 1), np.int64), np.zeros((len(x), 1))
        for p in range(self.polytopes):
            near = self.axes(x, t, p)
            order = np.argsort(-near, axis=1, kind="stable")[:, :probes]
            each = np.take_along_axis(near, order, axis=1)
            both = (value[:, :, None] + each[:, None]).reshape(len(x), -1)
            name = (best[:, :, None] * 2 * self.wide + order[:, None]).reshape(len(x), -1)
            top = np.argsort(-both, axis=1, kind="stable")[:, :probes]
            best, value = np.take_along_axis(name, top, axis=1), np.take_along_axis(both, top, axis=1)
        return best


def _hashed(df: DataFrame, rotations: Rotations, tables: int, probes: int) -> DataFrame:
    """One row for each table and opened bucket: t, bucket, row, id, v."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                batch = whole.slice(start, 1000)
                x = scaled(matrix(batch.column("v"), rotations.size))
                for t in range(tables):
                    buckets = rotations.buckets(x, t, probes)
                    n, k = buckets.shape
                    at = pa.array(np.repeat(np.arange(n), k))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(n * k, t, np.int32)), pa.array(buckets.ravel()),
                            *(batch.column(c).take(at) for c in ("row", "id", "v")),
                        ],
                        names=["t", "bucket", "row", "id", "v"],
                    )

    return df.select("row", "id", "v").mapInArrow(run, "t int, bucket long, row long, id long, v array<double>")


def _best(k: int, size: int):
    def best(block: pa.Table) -> pa.Table:
        block = block.combine_chunks()
        queries, index = block.filter(block["query"]), block.filter(pa.compute.invert(block["query"]))
        found: dict[str, list] = {"query": [], "row": [], "query_id": [], "id": [], "score": []}
        if queries.num_rows and index.num_rows:
            a, b = (scaled(matrix(x["v"].combine_chunks(), size)) for x in (queries, index))
            rows, ids = index["row"].to_numpy(), index["id"].to_pylist()
            order = np.array([np.inf if i is None else i for i in ids])
            mine = queries["row"].to_numpy()
            score = cosines(a, b)
            score[mine[:, None] == rows] = -np.inf
            for i, line in enumerate(score):
                least = np.partition(line, -k)[-k] if len(line) > k else -np.inf
                at = np.flatnonzero((line >= least) & np.isfinite(line))
                at = at[np.lexsort((rows[at], order[at], -line[at]))][:k]
                found["query"] += [mine[i]] * len(at)
                found["query_id"] += [queries["id"][i].as_py()] * len(at)
                found["row"] += rows[at].tolist()
                found["id"] += [ids[j] for j in at]
                found["score"] += line[at].tolist()
        return pa.table({
            n: pa.array(v, pa.float64() if n == "score" else pa.int64()) for n, v in found.items()
        })

    return best


def _meet(queries: DataFrame, index: DataFrame, k: int, size: int, buckets: int) -> DataFrame:
    """The best ``k`` of each block of a bucket for each query that opens it.

    A bucket of many vectors or queries is a grid of blocks: a vector stands in one row of blocks, a
    query in one column, so no task holds more than a block of each, however full the bucket is.
    ``buckets``: how many there can be, which bounds the grid that is broadcast.
    """
    sides = []
    for df, mine in ((index, "rows"), (queries, "columns")):
        counts = df.groupBy("t", "bucket").agg(F.expr(f"cast(ceil(count(*) / {BLOCK}) as int)").alias(mine))
        sides.append(counts)
    grid = sides[0].join(sides[1], ["t", "bucket"])  # at most one row for each bucket
    grid = write_once(grid, "grid")

    def placed(df: DataFrame, own: str, other: str, query: bool) -> DataFrame:
        df = df.join(F.broadcast(grid) if buckets <= 1_000_000 else grid, ["t", "bucket"])
        return df.selectExpr(
            "t", "bucket", f"{str(query).lower()} as query", "row", "id", "v",
            f"pmod(xxhash64(row), {own}) as _{own}", f"explode(sequence(0, {other} - 1)) as _{other}",
        )

    both = placed(index, "rows", "columns", False).unionByName(placed(queries, "columns", "rows", True))
    return both.groupBy("t", "bucket", "_rows", "_columns").applyInArrow(
        _best(k, size), "query long, row long, query_id long, id long, score double"
    )


def search(
    df: DataFrame, queries: str, k: int = 5, vector: str = "embedding", key: str = "vec_id",
    tables: int = TABLES, probes: int = PROBES, polytopes: int = POLYTOPES, seed: int = 1,
) -> DataFrame:
    """The ``k`` nearest rows by cosine that are found for each row which the SQL ``queries`` picks.

    Returns query_id, rank from 1, vec_id and score, nearest first, equal scores by smaller key (null
    last). A query's own row is no candidate; another row with the same key or vector is. Vectors that
    are null, empty or zero, hold null or non-finite components, or differ in size from most, take
    no part. A query whose buckets hold fewer than ``k`` rows is compared with all rows instead.
    """
    rows = df.selectExpr(f"cast({key} as bigint) as id", f"{vector} as v", f"coalesce({queries}, false) as asks")
    rows = rows.where(usable("v")).withColumn("v", F.expr("cast(v as array<double>)"))
    rows = write_once(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    size = common_size(rows, "v")
    rows = rows.where(f"size(v) = {size}")
    asking = rows.where("asks")
    rotations = Rotations(max(1, size), tables, polytopes, seed)
    index = _hashed(rows, rotations, tables, 1)
    found = _meet(_hashed(asking, rotations, tables, probes), index, k, size, tables * rotations.count).dropDuplicates(["query", "row"])
    order = "row_number() over (partition by query order by score desc, id asc nulls last, row)"
    top = write_once(found.selectExpr("*", f"{order} as rank").where(f"rank <= {k}"), "found")
    enough = top.where(f"rank = {k}").selectExpr("query as row")
    short = write_once(asking.join(enough, "row", "left_anti"), "short")
    if not short.isEmpty():
        axes = Rotations(max(1, size), 1, 1, seed)
        one = _hashed(rows, axes, 1, 1)
        # Every bucket of one table: at most as many as a polytope has axes.
        names = F.array(*(F.lit(r.bucket).cast("long") for r in one.select("bucket").distinct().collect()))
        every = short.select(F.lit(0).alias("t"), F.explode(names).alias("bucket"), "row", "id", "v")
        rest = _meet(every, one, k, size, axes.count)
        rest = rest.selectExpr("*", f"{order} as rank").where(f"rank <= {k}")
        top = top.join(short.selectExpr("row as query"), "query", "left_anti").unionByName(rest)
    return top.selectExpr("query_id", "cast(rank as int) as rank", f"id as {key}", "score")


def search_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0")

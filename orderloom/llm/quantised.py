"""Near-duplicate embeddings by iterative quantisation.

Rotations are learned from a bounded sample so that the signs of rotated vectors are balanced, tight
binary codes. Codes are cut into chunks, each with a table of its own. Vectors that share a chunk
and whose whole codes are close in Hamming distance are candidates, and the original vectors decide.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import connected, sampled, table, width, write_once
from .runs import pairs_in_runs, whole_runs
from .vectors import common_size, matrix, norms, scaled, usable

#: Fitted sample, rounds of the fit.
SAMPLE, ROUNDS = 4096, 20
#: Tables and bits of a chunk. Two unit vectors at cosine 0.93 differ in 12% of their bits: a chunk
#: agrees with probability 0.88 ** 12 = 0.22, no chunk of 40 with probability 0.00006.
TABLES, BITS = 40, 12
#: Candidates differ in fewer bits than expected at the threshold by so many standard deviations.
SLACK = 6.0
#: Codes of one bucket that meet at once.
BLOCK = 512


def learn(x: np.ndarray, bits: int, rounds: int, seed: int) -> np.ndarray:
    """Directions as columns: rotations by iterative quantisation, side by side.

    A rotation is first random over the sample's principal axes; each round takes the signs of the
    rotated sample and then the rotation that brings the sample nearest to them. Vectors are not
    centred, since cosines are angles about the origin.
    """
    size = x.shape[1]
    rng = np.random.default_rng(seed)
    axes = np.linalg.svd(x, full_matrices=True)[2].T if len(x) else np.eye(size)
    out = []
    for _ in range(-(-bits // size)):
        turn = np.linalg.qr(rng.standard_normal((size, size)))[0]
        y = x @ axes
        for _ in range(rounds if len(x) else 0):
            u, _, v = np.linalg.svd(y.T @ np.sign(y @ turn))
            turn = u @ v
        out.append(axes @ turn)
    return np.hstack(out)[:, :bits]


def _tables(directions: np.ndarray, tables: int, bits: int, size: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row for each table: its number, the chunk's value, and the whole code."""
        for whole in batches:
            for start in range(0, whole.num_rows, 2000):
                batch = whole.slice(start, 2000)
                x = matrix(batch.column("v"), size)
                ones = scaled(x) @ directions > 0
                code = np.packbits(ones, axis=1)
                chunk = ones.reshape(len(x), tables, bits) @ (1 << np.arange(bits))
                codes = pa.array([row.tobytes() for row in code], pa.binary())
                for t in range(tables):
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("label"), pa.array(np.full(len(x), t, np.int32)),
                            pa.array(chunk[:, t].astype(np.int32)), batch.column("c"), codes,
                        ],
                        names=["label", "t", "chunk", "c", "code"],
                    )

    return run


_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint16)


def _candidates(most: int, tables: int, bits: int):
    def found(rows: pa.Table, starts: np.ndarray, ends: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Candidates among whole runs, each of one bucket and pair of blocks."""
        n = rows.num_rows
        ids, mine, t = rows["c"].to_numpy(), rows["_mine"].to_numpy(), rows["t"].to_numpy()
        same = rows["_a"].to_numpy() == rows["_b"].to_numpy()
        code = np.frombuffer(b"".join(rows["code"].to_pylist()), np.uint8).reshape(n, -1)
        chunk = np.unpackbits(code, axis=1)[:, : tables * bits].reshape(n, tables, bits) @ (1 << np.arange(bits))
        for left, right in pairs_in_runs(starts, ends):
            # Two blocks of one bucket: only pairs across; a block with itself: all.
            ok = same[left] | (mine[left] != mine[right])
            left, right = left[ok], right[ok]
            for s in range(0, len(left), 200_000):
                a, b = left[s : s + 200_000], right[s : s + 200_000]
                near = _ONES[code[a] ^ code[b]].sum(axis=1) <= most
                a, b = a[near], b[near]
                # Reported by the first table in which the two meet.
                first = (chunk[a] == chunk[b]).argmax(axis=1) == t[a]
                a, b = ids[a[first]], ids[b[first]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"]
                )

    return lambda batches: whole_runs(batches, ("label", "t", "chunk", "_a", "_b"), found)


def _near(least: float, size: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pairs with both vectors, those with cosine of at least ``least``."""
    for batch in batches:
        a, b = (scaled(matrix(batch.column(c), size)) for c in ("va", "vb"))
        total = np.zeros(len(a))
        for k in range(size):
            total += a[:, k] * b[:, k]
        at = pa.array(np.flatnonzero(total / (norms(a) * norms(b)) >= least))
        yield pa.RecordBatch.from_arrays([batch.column("a").take(at), batch.column("b").take(at)], names=["a", "b"])


def links(classes: DataFrame, least: float, size: int, tables: int = TABLES, bits: int = BITS, seed: int = 4) -> DataFrame:
    """Pairs (a, b) of rows of ``classes`` (c, label as long, v) with equal label and a cosine of at
    least ``least``, each once. Buckets of more than BLOCK codes meet as pairs of blocks."""
    seen = sampled(classes, ["v"], "xxhash64(v)", SAMPLE)
    sample = np.array([r.v for r in seen], np.float64).reshape(-1, size)
    sample = scaled(sample) if len(sample) else sample
    sample = sample / np.linalg.norm(sample, axis=1, keepdims=True) if len(sample) else sample
    bits = min(bits, 16)
    directions = learn(sample[np.lexsort(sample.T[::-1])], tables * bits, ROUNDS, seed)
    share = np.arccos(min(1.0, least)) / np.pi
    total = tables * bits
    # Directions of one rotation are orthogonal, several rotations are not: the variance is that of
    # as many bits as the vectors have components.
    most = int(np.ceil(total * (share + SLACK * np.sqrt(share * (1 - share) / min(total, size)))))
    most = min(most, total)
    key = ["label", "t", "chunk"]
    rows = classes.select("label", "c", "v").mapInArrow(
        _tables(directions, tables, bits, size), "label long, t int, chunk int, c long, code binary"
    )
    rows = write_once(rows, "codes")
    full = rows.groupBy(*key).count().where(f"count > {BLOCK}").selectExpr(
        *key, f"cast(ceil(count / {BLOCK}) as int) as _blocks"
    )
    rows = rows.join(full, key, "left").selectExpr(
        "*", "if(_blocks is null, 0, cast(pmod(xxhash64(c), _blocks) as int)) as _mine"
    )
    rows = rows.selectExpr(
        *key, "c", "code", "_mine", "explode(sequence(0, coalesce(_blocks, 1) - 1)) as _other",
    ).selectExpr(*key, "c", "code", "_mine", "least(_mine, _other) as _a", "greatest(_mine, _other) as _b")
    rows = rows.repartition(width(classes.sparkSession), *key, "_a", "_b").sortWithinPartitions(*key, "_a", "_b")
    pairs = rows.mapInArrow(_candidates(most, tables, bits), "a long, b long")
    vectors = classes.select("c", "v")
    both = pairs.join(vectors.toDF("a", "va"), "a").join(vectors.toDF("b", "vb"), "b").select("a", "b", "va", "vb")
    return both.mapInArrow(partial(_near, least, size), "a long, b long")


def dedup(df: DataFrame, least: float = 0.93, vector: str = "embedding", key: str = "vec_id", label: str = "label") -> DataFrame:
    """Each row with its links to other vectors of its label, its component and whether it is kept.

    Rows with an equal label and vector form one class, so copies link without being paired. n_links
    counts the other rows linked directly; component_id is the smallest key reachable by links; a
    row is kept if that is its own. Rows with a null label, or a vector that is null, empty or zero,
    holds null or non-finite components, or differs in size from most, link with nothing.
    """
    rows = df.selectExpr(f"cast({key} as bigint) as id", f"{label} as name", f"{vector} as v")
    size = common_size(rows.where(usable("v")), "v")
    rows = rows.selectExpr(
        "id", "xxhash64(name) as label",
        f"name is not null and {usable('v')} and coalesce(size(v) = {size}, false) as fits",
        # 128 bits of label and vector name a class.
        "xxhash64(name, v) as k1", "xxhash64(v, name, 1) as k2", "cast(v as array<double>) as v",
    )
    rows = write_once(rows, "rows")
    classes = rows.where("fits").groupBy("label", "k1", "k2").agg(
        F.min("id").alias("first"), F.count(F.lit(1)).alias("n"), F.any_value("v").alias("v")
    )
    classes = write_once(classes.withColumn("c", F.monotonically_increasing_id()), "classes")
    found = write_once(links(classes, least, max(1, size)), "pairs")
    ends = found.union(found.selectExpr("b", "a"))
    others = ends.join(classes.selectExpr("c as b", "n"), "b").groupBy("a").agg(F.sum("n").alias("others"))
    parts = connected(found, "a", "b").selectExpr("vertex as a", "component as part")
    named = classes.selectExpr("c as a", "label", "k1", "k2", "first", "n").join(others, "a", "left").join(parts, "a", "left")
    named = write_once(named.withColumn("part", F.coalesce("part", "a")), "named")
    least_id = named.groupBy("part").agg(F.min("first").alias("component"))
    named = named.join(least_id, "part").selectExpr("label", "k1", "k2", "n - 1 + coalesce(others, 0) as links", "component")
    out = rows.where("fits").select("id", "label", "k1", "k2").join(named, ["label", "k1", "k2"], "left")
    out = out.selectExpr("id", "links", "component").union(
        rows.where("not fits").selectExpr("id", "cast(0 as bigint)", "id")
    )
    return out.selectExpr(
        f"id as {key}", "links as n_links", "component as component_id", "id <=> component as kept"
    )


def dedup_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "embeddings"))

"""What several of the operators share: input tables, key remainders, text as bytes, vertex ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from orderloom.sources.shared import shared_path, write_once

__all__ = [
    "WORD", "connected", "documents", "key_remainder", "sampled", "shared_path", "table",
    "text_bytes", "unused", "width", "write_once",
]

#: A word: what stands between ASCII white space. ``bytes.split()`` splits exactly so.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def key_remainder(key: str, divisor: int) -> Column:
    """crc32 of the key's text modulo ``divisor``; a null key counts as empty text."""
    return F.expr(f"crc32(coalesce(cast({key} as string), '')) % {divisor}").cast("int")


def text_bytes(text: str) -> Column:
    """UTF-8 bytes of a text column, null as empty: Python tasks get them without decoding."""
    return F.expr(f"coalesce(cast({text} as binary), X'')")


def sampled(df: DataFrame, columns: list[str], by: str, slots: int) -> list[Row]:
    """At most ``slots`` rows for the driver: of each slot of the hash ``by`` the row that has the
    smallest. Tasks keep one row a slot before the shuffle, so nothing grows with the input."""
    rows = df.selectExpr(*columns, f"{by} as _h")
    least = rows.groupBy(F.expr(f"pmod(_h, {slots})").alias("_slot")).agg(
        F.expr(f"min_by(struct({', '.join(columns)}), _h)").alias("row")
    )
    return [r.row for r in least.select("row").collect()]


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores added until no column of ``df`` is called so."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def width(spark: SparkSession) -> int:
    """How many tasks a shuffle of this session has."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _mixed(df: DataFrame, name: str, out: str) -> DataFrame:
    """``out``: a one-to-one mixing of a 64-bit number by shifts, which never overflow."""
    df = df.withColumn(out, F.expr(f"{name} ^ shiftleft({name}, 13)"))
    df = df.withColumn(out, F.expr(f"{out} ^ shiftrightunsigned({out}, 7)"))
    return df.withColumn(out, F.expr(f"{out} ^ shiftleft({out}, 17)"))


def connected(links: DataFrame, a: str, b: str) -> DataFrame:
    """Connected components of an undirected graph: (vertex, component = its smallest vertex).

    Only vertices with a link are returned. Each round contracts every vertex into the smallest of
    its neighbours under a scrambled order, so the graph left shrinks by a constant share per round
    in expectation, however long its chains are. The minimum is combined before the shuffle and
    joins look a vertex up in a table unique in it, so a hub is split like any skewed join. Rounds
    are written to the shared folder: lineage stays short and a lost executor costs one re-read.
    Null or self links are ignored, repeated links count once.
    """
    links = links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
    links = links.where("a is not null and b is not null and a <> b")
    edges = write_once(_mixed(_mixed(links, "a", "u"), "b", "v"), "links")
    names = edges.selectExpr("u as x", "a as name").union(edges.selectExpr("v as x", "b as name"))
    names = write_once(names.distinct(), "names")
    label = None
    left = edges.selectExpr("least(u, v) as u", "greatest(u, v) as v").distinct()
    while True:
        left = write_once(left, "round")
        if left.isEmpty():
            break
        ends = left.union(left.selectExpr("v", "u"))
        into = ends.groupBy("u").agg(F.min("v").alias("v")).selectExpr("u", "least(u, v) as m")
        into = write_once(into, "into")
        if label is None:
            label = into.selectExpr("u as x", "m as root")
        else:
            moved = label.join(into, label.root == into.u, "left")
            label = moved.selectExpr("x", "coalesce(m, root) as root")
        label = write_once(label, "label")
        left = left.join(into, "u").selectExpr("m as u", "v").join(
            into.selectExpr("u as v", "m"), "v"
        ).selectExpr("u", "m as v").where("u <> v").selectExpr(
            "least(u, v) as u", "greatest(u, v) as v"
        ).distinct()
    if label is None:
        return names.selectExpr("name as vertex", "name as component")
    named = label.join(names, "x")
    least = named.groupBy("root").agg(F.min("name").alias("component"))
    return named.join(least, "root").selectExpr("name as vertex", "component")

"""URL filters as a sort-merge range join.

A host with its labels reversed turns "this host and all subdomains" into one interval of sorted
keys. Pages and rules are dealt over the same key ranges and sorted; each task sweeps its range once
with a stack of the rules whose interval is open. Intervals nest, so the stack is as deep as a host
has labels with rules.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import sampled, table, width

#: Keys that the cuts between ranges are taken from.
SAMPLE = 16_384
#: Ends a host in a key, and stands between its labels. Both sort before every character of a host:
#: a host is followed at once by its subdomains, so what a rule covers is one interval.
END, DOT = "\x00", "\x01"

# The rules of the query.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)

#: SQL for host and path of column url.
HOST = (
    "case when instr(url, '://') > 0 then translate(regexp_extract("
    "substr(url, instr(url, '://') + 3), '^([^/?#]*)', 1), "
    "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') else '' end"
)
PATH = (
    "case when instr(url, '://') > 0 then regexp_extract("
    "substr(url, instr(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) else '' end"
)
#: SQL for a sort key of column host: its labels from the last to the first.
KEY = "concat(array_join(reverse(split(host, '[.]')), char(1)), char(0))"


def _ranges(cuts: list, low, high) -> range:
    return range(bisect.bisect_right(cuts, low), bisect.bisect_right(cuts, high) + 1)


def _deal_pages(cuts: list):
    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, salts = batch.column("key").to_pylist(), batch.column("salt").to_pylist()
            part = [bisect.bisect_right(cuts, x) for x in zip(keys, salts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(part, pa.int32())], names=[*batch.schema.names, "part"]
            )

    return deal


def _deal_rules(cuts: list):
    """A rule goes to every range that its interval of keys touches."""

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for rule in batch.to_pylist():
                stem = rule["key"].removesuffix(END)
                first, last = (stem + END, -(1 << 63)), (stem + chr(2), -(1 << 63))
                rows += [rule | {"part": p} for p in _ranges(cuts, first, last)]
            yield pa.RecordBatch.from_pylist(rows, schema=batch.schema.append(pa.field("part", pa.int32())))

    return deal


class _Open:
    """The rules of one host: which of its path prefixes a path has, longest first."""

    def __init__(self, key: str):
        self.stem, self.rules, self.sizes = key.removesuffix(END), {}, []

    def add(self, path: str, rule: str, verdict: str) -> None:
        if path not in self.rules or (verdict == "block" and self.rules[path][1] != "block"):
            self.rules[path] = (rule, verdict)
        self.sizes = sorted({len(p) for p in self.rules}, reverse=True)

    def holds(self, key: str) -> bool:
        return key == self.stem + END or key.startswith(self.stem + DOT)

    def best(self, path: str) -> tuple[str, str] | None:
        return next((self.rules[path[:n]] for n in self.sizes if n <= len(path) and path[:n] in self.rules), None)


def _sweep(names: list[str]):
    def sweep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by (part, key, rules first)."""
        part, stack = None, []
        for batch in batches:
            rows = {n: batch.column(n).to_pylist() for n in ("part", "key", "is_page", "path", "rule", "verdict")}
            keep, rules, verdicts = [], [], []
            for i, (p, key) in enumerate(zip(rows["part"], rows["key"], strict=True)):
                if p != part:
                    part, stack = p, []
                while stack and not stack[-1].holds(key):
                    stack.pop()
                path = rows["path"][i]
                if not rows["is_page"][i]:
                    if not stack or stack[-1].stem + END != key:
                        stack.append(_Open(key))
                    stack[-1].add(path, rows["rule"][i], rows["verdict"][i])
                    continue
                fits = [x for o in stack if (x := o.best(path))]
                # Longest rule; of two as long, the one of the longer host, which is higher up.
                best = max(enumerate(fits), key=lambda x: (len(x[1][0]), x[0]))[1] if fits else (None, None)
                keep.append(i)
                rules.append(best[0])
                verdicts.append(best[1])
            kept = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*(kept.column(n) for n in names), pa.array(rules, pa.string()), pa.array(verdicts, pa.string())],
                names=[*names, "rule", "verdict"],
            )

    return sweep


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", carry: Sequence[str] = ("page_id",)) -> DataFrame:
    """Verdict of the longest rule that fits each url.

    ``pages`` has ``url`` and the columns to carry, ``rules`` has host, path and verdict (allow or
    block). A rule fits its host and all subdomains if the url's path starts with the rule's path;
    a null rule path is empty. Two equal rules with different verdicts block. A url that is null or
    has no ``://`` has empty host and path; what no rule fits gets ``default`` and a null rule.
    Pages of one host are split over several ranges by a hash of the row, and rules
    are copied only to the ranges they touch, so neither table has to be small.
    """
    spark = pages.sparkSession
    names = [f"c{i}" for i in range(len(carry))]
    page = pages.selectExpr(
        *(f"`{c}` as {n}" for c, n in zip(carry, names, strict=True)), f"{HOST} as host", f"{PATH} as path"
    )
    page = page.selectExpr("*", f"{KEY} as key", f"xxhash64({', '.join(names)}, path) as salt")
    # A bounded sample only places the cuts between ranges; every row is judged.
    seen = sampled(page, ["key", "salt"], "xxhash64(key, salt)", SAMPLE)
    keys, n = sorted((r.key, r.salt) for r in seen), width(spark)
    cuts = sorted({keys[len(keys) * i // n] for i in range(1, n)}) if keys else []
    rule = rules.selectExpr(
        "lower(host) as host", "coalesce(path, '') as path", "verdict",
    ).selectExpr(f"{KEY} as key", "path", "concat(host, path) as rule", "verdict")
    page_schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in page.schema.fields)
    dealt_pages = page.mapInArrow(_deal_pages(cuts), page_schema + ", part int")
    dealt_rules = rule.mapInArrow(_deal_rules(cuts), "key string, path string, rule string, verdict string, part int")
    both = dealt_pages.selectExpr(
        "part", "key", "true as is_page", "host", "path", "cast(null as string) as rule",
        "cast(null as string) as verdict", *names,
    ).unionByName(
        dealt_rules.selectExpr("part", "key", "false as is_page", "path", "rule", "verdict"),
        allowMissingColumns=True,
    )
    both = both.repartitionById(n, F.col("part")).sortWithinPartitions("part", "key", "is_page")
    carried = [*names, "host", "path"]
    out_schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in both.select(*carried).schema.fields)
    judged = both.select("part", "key", "is_page", "rule", "verdict", *carried).mapInArrow(
        _sweep(carried), out_schema + ", rule string, verdict string"
    )
    return judged.selectExpr(
        *(f"{n} as `{c}`" for c, n in zip(carry, names, strict=True)), "host", "path", "rule",
        f"coalesce(verdict, '{default}') as verdict",
    )


def judge_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge(table(spark, sf_dir, "pages"), rules)

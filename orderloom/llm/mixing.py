"""Mixing overlapping sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources that hold them). Words flow from
patterns to the quotas of their sources; the r-th repetition of a pattern costs more than the one
before, so that repetition is spread before it is deepened. What each pattern shall deliver is then
taken from its documents in a seeded order.
"""

from __future__ import annotations

from collections import defaultdict, deque
from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, unused, write_once

#: Documents in one step of the seeded order; only the step at a quota's end is looked at singly.
STEP = 1024
#: Patterns that the driver solves for. Sources are a dimension; more than this is an error.
MAX_PATTERNS = 100_000

Pattern = tuple[str | None, ...]


def targets(
    sizes: Mapping[str | None, int], weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5, most: float = 2.0,
) -> dict[str | None, float]:
    """Words wanted of each source: ``share`` of all words by weight, at most ``most`` times the
    source's own; what a full source cannot take is dealt to the others by weight, and so on.
    Sources in code-point order, null last, take the weights in turn."""
    # UTF-8 bytes sort by code point.
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-8", "surrogatepass")))
    weight = {s: float(weights[i % len(weights)]) for i, s in enumerate(names)}
    wanted = dict.fromkeys(names, 0.0)
    left, free = share * sum(sizes.values()), list(names)
    while free and left > 0:
        unit = left / sum(weight[s] for s in free)
        full = [s for s in free if unit * weight[s] > most * sizes[s]]
        if not full:
            wanted.update((s, unit * weight[s]) for s in free)
            break
        for s in full:
            wanted[s] = most * sizes[s]
            left -= wanted[s]
        free = [s for s in free if s not in set(full)]
    return wanted


def _flow(words: dict[Pattern, int], quota: dict[str | None, float], repeats: int) -> dict[Pattern, float]:
    """Cheapest flow that fills the quotas as far as possible: successive shortest paths."""
    graph: dict = defaultdict(dict)  # node -> node -> [capacity left, cost]

    def arc(u, v, capacity, cost):
        graph[u][v] = [float(capacity), cost]
        graph[v].setdefault(u, [0.0, -cost])

    for p, size in words.items():
        for r in range(repeats):
            arc("in", ("pass", p, r), size, r)
            arc(("pass", p, r), ("pattern", p), size, 0)
        for s in set(p):
            arc(("pattern", p), ("source", s), np.inf, 0)
    for s in {s for p in words for s in p}:
        arc(("source", s), "out", quota[s], 0)
    while True:
        cost, back, queue, queued = {"in": 0}, {}, deque(["in"]), {"in"}
        while queue:
            u = queue.popleft()
            queued.discard(u)
            for v, (capacity, c) in graph[u].items():
                if capacity > 1e-6 and cost[u] + c < cost.get(v, np.inf):
                    cost[v], back[v] = cost[u] + c, u
                    if v not in queued:
                        queue.append(v)
                        queued.add(v)
        if "out" not in back:
            break
        path, v = [], "out"
        while v != "in":
            path.append((back[v], v))
            v = back[v]
        amount = min(graph[u][v][0] for u, v in path)
        for u, v in path:
            graph[u][v][0] -= amount
            graph[v][u][0] += amount
    return {p: sum(graph[("pass", p, r)]["in"][0] for r in range(repeats)) for p in words}


def route(words: dict[Pattern, int], quota: dict[str | None, float], repeats: int = 2) -> dict[Pattern, float]:
    """Words each pattern delivers, repetitions counted. Sources that share no pattern are solved
    apart, so disjoint sources cost one small problem each."""
    top: dict = {}

    def find(s):
        while top.setdefault(s, s) != s:
            top[s] = s = top[top[s]]
        return s

    for p in words:
        for s in p:
            top[find(s)] = find(p[0])
    parts: dict = defaultdict(dict)
    for p, size in words.items():
        parts[find(p[0])][p] = size
    return {p: x for part in parts.values() for p, x in _flow(part, quota, repeats).items()}


def _fill(rows: pd.DataFrame) -> pd.DataFrame:
    """Take documents in seeded order as long as they fit into what is left of the quota."""
    rows = rows.sort_values(["_order", "_size"], kind="stable", ignore_index=True)
    left, extra = float(rows["_left"].iloc[0]), np.zeros(len(rows), dtype=np.int32)
    sizes = rows["_size"].to_numpy()
    for i, size in enumerate(sizes):
        if 0 < size <= left:
            extra[i], left = 1, left - size
    # The document that passes the end is taken too if that leaves less missing than it adds.
    rest = np.where((extra == 0) & (sizes > 0))[0]
    if len(rest) and sizes[i := rest[np.argmin(sizes[rest])]] < 2 * left:
        extra[i] = 1
    return rows.assign(_extra=extra)[["_row", "_extra"]]


def mix(
    docs: DataFrame, sources: str, size: str, carry: Sequence[str],
    aim: Callable[[Mapping[str | None, int]], Mapping[str | None, float]] = targets,
    repeats: int = 2, seed: int = 20,
) -> DataFrame:
    """How often the mix takes each document.

    ``sources``: SQL for the array of sources a document belongs to; ``size``: SQL for its words;
    ``carry``: SQL of the columns to return. Adds ``sources`` (the sorted array), ``size``, ``target``
    and ``source_size`` (sums over the array) and ``copies`` (0 to ``repeats``). ``aim`` gets the words
    of each source and returns its target. Null and empty arrays count as the one null source. Equal
    runs over equal rows agree: the order hangs on the first carried column and the size alone.
    """
    spark = docs.sparkSession
    array = f"array_sort(array_distinct({sources}))"
    names = [f"c{i}" for i in range(len(carry))]
    rows = docs.selectExpr(
        *(f"{c} as {n}" for c, n in zip(carry, names, strict=True)),
        f"case when size({array}) > 0 then {array} else array(cast(null as string)) end as _p",
        f"cast(coalesce({size}, 0) as bigint) as _size",
    )
    rows = rows.selectExpr("*", f"xxhash64({seed}, c0, _size) as _order", "monotonically_increasing_id() as _row")
    rows = write_once(rows, "sized")
    sums = rows.groupBy("_p").agg(F.sum("_size").alias("words"), F.count(F.lit(1)).alias("n"))
    found = sums.limit(MAX_PATTERNS + 1).collect()
    if len(found) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    words: dict[Pattern, int] = {tuple(r._p): r.words for r in found}
    by_source: dict[str | None, int] = defaultdict(int)
    for p, n in words.items():
        for s in p:
            by_source[s] += n
    wanted = aim(by_source)
    sent = route(words, wanted, repeats)
    plan = []
    for r in found:
        p = tuple(r._p)
        base = min(repeats, int((sent[p] + 1e-6) // r.words)) if r.words else 0
        steps = max(1, min(65536, -(-r.n // STEP)))
        plan.append((
            list(p), base, float(max(0.0, sent[p] - base * r.words)), steps,
            float(sum(wanted[s] for s in p)), int(sum(by_source[s] for s in p)),
        ))
    schema = "_p array<string>, _base int, _quota double, _steps int, target double, source_size long"
    plans = spark.createDataFrame(plan, schema)
    # One row for each pattern, of which there are MAX_PATTERNS at most.
    plans = plans.withColumn("_key", F.expr("to_json(_p)")).drop("_p")
    rows = rows.withColumn("_key", F.expr("to_json(_p)")).join(F.broadcast(plans), "_key")
    rows = rows.withColumn("_step", F.expr("pmod(_order, _steps)"))
    steps = rows.groupBy("_key", "_quota", "_step").agg(F.sum("_size").alias("_words"))
    last = steps.selectExpr(
        "_key", "_quota", "_step", "_words",
        "sum(_words) over (partition by _key order by _step rows between unbounded preceding and current row) as _end",
    ).where("_end > _quota").groupBy("_key").agg(
        F.expr("min(struct(_step, _quota - (_end - _words) as _left))").alias("_at")
    ).selectExpr("_key", "_at._step as _last", "_at._left as _left")
    rows = rows.join(F.broadcast(last), "_key", "left")
    picked = rows.where("_step = _last").select("_key", "_row", "_order", "_size", "_left")
    picked = picked.groupBy("_key").applyInPandas(_fill, "_row long, _extra int")
    out = rows.join(picked, "_row", "left").selectExpr(
        *names, "_p as sources", "_size as size", "target", "source_size",
        "_base + case when _size = 0 then 0 when _last is null or _step < _last then if(_quota > 0, 1, 0) "
        "when _step = _last then coalesce(_extra, 0) else 0 end as copies",
    )
    return out


#: Words of a text: what stands between ASCII white space.
WORDS = f"regexp_count(coalesce(text, ''), r'{WORD}')"


def mix_documents(docs: DataFrame, seed: int = 20) -> DataFrame:
    """All documents with the words the mix takes of each; sources weigh 3, 1, 2 in turn.

    A null text has no words and is never taken. Repeated rows are taken or left one by one. A
    source whose words are all taken twice has reached its target; an empty table gives no rows.
    """
    mixed = mix(docs, "array(cast(source as string))", WORDS, ["cast(doc_id as bigint)"], seed=seed)
    return mixed.selectExpr(
        "c0 as doc_id", "size", "source_size", "target", "size * copies as taken",
        "sources[0] as source",
    )


#: SQL for the columns that tell rows apart.
KEYS = ("coalesce(cast(doc_id as bigint), -9223372036854775808)", "xxhash64(text)", "xxhash64(text, 1)")


def repeat(docs: DataFrame, seed: int = 20) -> DataFrame:
    """The mix itself: each row with all its columns, whatever their names, as often as the mix takes it.

    Repeated rows (same doc_id and text) add up what is taken of each and may change places.
    """
    *keys, times, time = unused(docs, "_id", "_h1", "_h2", "_times", "_time")
    mixed = mix(docs, "array(cast(source as string))", WORDS, KEYS, seed=seed)
    taken = mixed.where("copies > 0").toDF(*keys, *mixed.columns[3:]).groupBy(*keys).agg(F.sum("copies").cast("int").alias(times))
    named = docs.withColumns(dict(zip(keys, map(F.expr, KEYS), strict=True)))
    once = named.join(taken, keys).dropDuplicates(keys)
    return once.withColumn(time, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*docs.columns)

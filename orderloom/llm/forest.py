"""Near-duplicate documents by an LSH forest of MinHash signatures.

Every tree orders documents by a signature string of its own. Documents with a common prefix form a
region; a region is read at the least depth at which it is small, so a sparse neighbourhood is
searched with a short prefix and a crowded one with a long prefix. Regions that stay large at full
depth meet as pairs of blocks, without the pairs already in one component. Candidates are confirmed
on whole shingle sets, those of a crowd where its blocks meet.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, connected, documents, text_bytes, unused, width, write_once
from .runs import pairs_in_runs, whole_runs

#: Trees, and signature values along a tree. Two documents of similarity 0.8 share the first value in
#: a tree with probability 0.8, and in none of 16 trees with probability 6e-12.
TREES, DEPTH = 16, 6
#: Largest region in which every document is compared with every other by sketch.
REGION = 64
#: Documents of a block of a region that stays larger.
BLOCK = 1024
#: Sketch: of each signature value four bits. Its estimate deviates by 0.045 at similarity 0.8.
SLACK = 0.2
#: Pairs of a run checked before it is seen again which are still apart, and shingles kept for them.
CHECKED, HELD = 256, 8_000_000
#: Classes that a task knows it has met.
REMEMBERED = 200_000

_MIX = np.random.default_rng(10).integers(1, 2**63, (2, TREES * DEPTH), dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles(words: list[bytes], n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of ``n`` words in a row; fewer words are one shingle."""
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < n:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words))], np.uint64)
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    many = len(words) - n + 1
    total = each[:many].copy()
    for k in range(1, n):
        total = (total ^ (total >> np.uint64(29))) * _STEP + each[k : k + many]
    total = (total ^ (total >> np.uint64(32))) * _STEP
    return np.unique(total ^ (total >> np.uint64(29)))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Least values of each of the hash functions over each (not empty) set."""
    starts = np.cumsum([0, *map(len, sets)])[:-1]
    flat = np.concatenate(sets)
    out = np.empty((len(sets), TREES * DEPTH), np.uint32)
    for k in range(TREES * DEPTH):
        values = (((flat ^ _MIX[0, k]) * (_MIX[1, k] | np.uint64(1))) >> np.uint64(32)).astype(np.uint32)
        out[:, k] = np.minimum.reduceat(values, starts)
    return out


def _read(n: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Class, set size and, once in a task for each class, signature and packed words."""
    pack, seen = zstandard.ZstdCompressor(level=1), {}
    for whole in batches:
        for start in range(0, whole.num_rows, 256):
            batch = whole.slice(start, 256)
            keys, sizes, sets, fresh, packed = [], [], [], [], [None] * batch.num_rows
            for i, text in enumerate(batch.column("text").to_pylist()):
                words = text.lower().split()
                body = b" ".join(words)
                key = xxhash.xxh3_128_digest(body)
                keys.append(key)
                if not words or key in seen:
                    sizes.append(seen[key] if words else 0)
                    continue
                sets.append(shingles(words, n))
                sizes.append(len(sets[-1]))
                if len(seen) < REMEMBERED:
                    seen[key] = sizes[-1]
                fresh.append(i)
                packed[i] = pack.compress(body)
            found = [None] * batch.num_rows
            if sets:
                for i, row in zip(fresh, signatures(sets), strict=True):
                    found[i] = row.astype(">u4").tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("id", "h1", "h2")), pa.array(keys, pa.binary()),
                    pa.array(sizes, pa.int64()), pa.array(found, pa.binary()), pa.array(packed, pa.binary()),
                ],
                names=["id", "h1", "h2", "k", "n", "sig", "body"],
            )


def _regions(reps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (c, t, region) of small regions, and rows (c, t, path) of those large at full depth.

    One level after the other, only with the documents whose regions are still large: most documents
    share no first value with any other and leave at once.
    """
    value = 4
    paths = reps.select("c", "sig", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("t"))
    left = paths.selectExpr("c", "t", f"substring(sig, t * {DEPTH * value} + 1, {DEPTH * value}) as path")
    small = None
    for depth in range(1, DEPTH + 1):
        left = left.withColumn("region", F.expr(f"xxhash64(substring(path, 1, {value * depth}))"))
        counts = write_once(left.groupBy("t", "region").count().where("count > 1"), "counts")
        # Counts and rows meet in a plain join of two shuffles, of which Spark splits a crowded side.
        level = write_once(left.join(counts, ["t", "region"]), "level")
        here = level.where(f"count <= {REGION}").select("c", "t", F.expr(f"xxhash64(region, {depth})").alias("region"))
        small = here if small is None else small.union(here)
        left = level.where(f"count > {REGION}").select("c", "t", "path")
        if depth < DEPTH and left.isEmpty():
            break
    return small, left


def _sketch(sig: pa.ChunkedArray | pa.Array) -> np.ndarray:
    values = np.frombuffer(b"".join(sig.to_pylist()), np.uint8).reshape(len(sig), -1)[:, 3::4]
    return values & 15


def _likely(sketch, n, label, i, j, least):
    """Which pairs may be similar enough: by size, by label and by sketch; with the estimate."""
    ok = np.minimum(n[i], n[j]) >= least * np.maximum(n[i], n[j]) - 1e-9
    ok &= label[i] != label[j]
    i, j = i[ok], j[ok]
    same = np.empty(len(i))
    for s in range(0, len(i), 100_000):
        same[s : s + 100_000] = (sketch[i[s : s + 100_000]] == sketch[j[s : s + 100_000]]).mean(axis=1)
    estimate = (same - 1 / 16) / (15 / 16)
    ok = estimate >= least - SLACK
    return i[ok], j[ok], estimate[ok]


def _search(least: float, nearest: bool, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidates of small regions. ``nearest``: only the best partner of each row; else every partner
    with another label."""

    def found(rows: pa.Table, starts: np.ndarray, ends: np.ndarray) -> Iterator[pa.RecordBatch]:
        c, n, label = (rows[k].to_numpy() for k in ("c", "n", "label"))
        sketch = _sketch(rows["sig"])
        for i, j in pairs_in_runs(starts, ends):
            i, j, estimate = _likely(sketch, n, label, i, j, least)
            if nearest and len(i):
                row, other, value = np.r_[i, j], np.r_[j, i], np.r_[estimate, estimate]
                order = np.lexsort((c[other], -value, row))
                first = order[np.r_[True, np.diff(row[order]) != 0]]
                i, j = row[first], other[first]
            yield _pairs(c, i, j)

    return whole_runs(batches, ("t", "region"), found)


def _pairs(c: np.ndarray, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(c[i], c[j])), pa.array(np.maximum(c[i], c[j]))], names=["a", "b"])


def _beside(least: float, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidates among neighbours in the sorted order of large regions: a start, which spares later
    pairs. Nothing depends on where the order is cut."""
    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows])
        if not rows.num_rows:
            continue
        c, n, label, t, region = (rows[k].to_numpy() for k in ("c", "n", "label", "t", "region"))
        i = np.flatnonzero((t[1:] == t[:-1]) & (region[1:] == region[:-1]))
        i, j, _ = _likely(_sketch(rows["sig"]), n, label, i, i + 1, least)
        yield _pairs(c, i, j)
        held = rows.slice(rows.num_rows - 1)


def _blocks(rows: DataFrame) -> DataFrame:
    """Rows of large regions once for each block theirs has to meet, under the pair (_a, _b) of block
    numbers. A label with more than BLOCK rows of a region has blocks of its own, which do not meet
    each other; the other labels share blocks, which meet all."""
    region = ["t", "region"]
    labels = rows.groupBy(*region, "label").count()
    labels = labels.selectExpr(*region, f"if(count > {BLOCK}, label, null) as own", "count")
    each = labels.groupBy(*region, "own").agg(F.expr(f"cast(ceil(sum(count) / {BLOCK}) as int)").alias("many"))
    # One row a region, with a number for each BLOCK rows of it; the documents stay apart.
    lists = each.groupBy(*region).agg(F.expr("sort_array(collect_list(struct(own, many)))").alias("each"))
    lists = lists.selectExpr(
        *region, "flatten(transform(each, x -> transform(sequence(1, x.many), k -> x.own))) as owns",
    )
    rows = rows.join(lists, region).withColumn("own", F.expr("if(array_contains(owns, label), label, null)"))
    rows = rows.withColumn("mine", F.expr("filter(sequence(0, size(owns) - 1), k -> owns[k] <=> own)"))
    rows = rows.withColumn("_mine", F.expr("mine[cast(pmod(xxhash64(c), size(mine)) as int)]"))
    others = "filter(sequence(0, size(owns) - 1), k -> owns[k] is null or not owns[k] <=> own)"
    rows = rows.selectExpr(*region, "c", "n", "label", "sig", "body", "_mine", f"explode({others}) as _other")
    return rows.selectExpr(
        *region, "c", "n", "label", "sig", "body", "_mine", "least(_mine, _other) as _a", "greatest(_mine, _other) as _b"
    )


class _Sets:
    """Shingle sets of the rows of one pair of blocks, by row; so many numbers are kept at once."""

    def __init__(self, body: pa.ChunkedArray, n: int):
        self.body, self.n, self.unpack = body, n, zstandard.ZstdDecompressor()
        self.known: dict[int, np.ndarray] = {}
        self.held = 0

    def __getitem__(self, row: int) -> np.ndarray:
        found = self.known.get(row)
        if found is None:
            found = shingles(self.unpack.decompress(self.body[row].as_py()).split(), self.n)
            if self.held > HELD:
                self.known.clear()
                self.held = 0
            self.known[row], self.held = found, self.held + len(found)
        return found


def _meet(size: int, percent: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within whole runs, each of one pair of blocks of a large region: of all pairs that are
    similar enough, those that join components not yet joined by others of the run. So a run has
    fewer links than documents, and the components are those of all its links."""
    least = percent / 100

    def found(rows: pa.Table, starts: np.ndarray, ends: np.ndarray) -> Iterator[pa.RecordBatch]:
        for low, high in zip(starts, ends, strict=True):
            yield from pair(rows.slice(low, high - low))

    def pair(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        c, n, label, mine = (rows[k].to_numpy() for k in ("c", "n", "label", "_mine"))
        t, same = rows["t"][0].as_py(), rows["_a"][0].as_py() == rows["_b"][0].as_py()
        sets, (_, part) = _Sets(rows["body"], size), np.unique(label, return_inverse=True)
        root = np.arange(len(c))  # of each label its component's number
        sketch = _sketch(rows["sig"]).T.copy()
        path = np.frombuffer(b"".join(rows["sig"].to_pylist()), np.uint32).reshape(len(c), TREES, DEPTH)
        left = np.arange(len(c)) if same else np.flatnonzero(mine == mine.min())
        right = left if same else np.flatnonzero(mine != mine.min())
        if not len(right):
            return
        other = sketch[:, right]
        enough = (least - SLACK) * 15 / 16 + 1 / 16
        for start in range(0, len(left), 256):
            here = left[start : start + 256]
            agree = np.zeros((len(here), len(right)), np.uint8)
            for k in range(len(sketch)):
                agree += sketch[k, here][:, None] == other[k]
            x, y = n[here][:, None], n[right]
            ok = (agree >= enough * len(sketch) - 1e-9) & (label[here][:, None] != label[right])
            ok &= np.minimum(x, y) >= least * np.maximum(x, y) - 1e-9
            if same:
                ok &= here[:, None] < right
            i, j = np.nonzero(ok)
            order = np.argsort(-agree[i, j].astype(np.int64), kind="stable")  # the likeliest first
            i, j = here[i[order]], right[j[order]]
            # Two that share the path of an earlier tree meet there.
            for s in range(t):
                apart = (path[i, s] != path[j, s]).any(axis=1)
                i, j = i[apart], j[apart]
            linked = []
            while len(i):
                apart = root[part[i]] != root[part[j]]
                i, j = i[apart], j[apart]
                for x, y in zip(i[:CHECKED].tolist(), j[:CHECKED].tolist()):
                    one, two = root[part[x]], root[part[y]]
                    if one != two and _similar(sets[x], sets[y], percent):
                        root[root == max(one, two)] = min(one, two)
                        linked.append((x, y))
                i, j = i[CHECKED:], j[CHECKED:]
            if linked:
                yield _pairs(c, *np.array(linked).T)

    return whole_runs(batches, ("t", "region", "_a", "_b"), found)


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _confirm(n: int, least: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pairs with packed words, those whose shingle sets are similar enough. Pairs come sorted by
    the first document, whose set is kept."""
    unpack, last, mine = zstandard.ZstdDecompressor(), None, None
    words = lambda body: unpack.decompress(body).split()
    for batch in batches:
        keep = []
        for i, (a, x, y) in enumerate(zip(*(batch.column(k).to_pylist() for k in ("a", "xa", "xb")), strict=True)):
            if a != last:
                last, mine = a, shingles(words(x), n)
            if _similar(mine, shingles(words(y), n), least):
                keep.append(i)
        at = pa.array(keep, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("a").take(at), batch.column("b").take(at)], names=["a", "b"])


def dedup(docs: DataFrame, n: int = 5, least: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row as id, n_shingles, component_id (the smallest id reachable by links, its own without)
    and first, with h1 and h2: hashes of the text that tell rows with one id apart.

    ``first`` marks one (id, h1, h2) of each component, the smallest by id (null last). Words are
    lower-cased A-Z and split at ASCII white space; a set holds the distinct shingles of ``n`` words,
    or the whole sequence if shorter. Documents are linked if 100 * intersection >= ``least`` * union.
    Equal word sequences are one class and never paired. A document without words or text has an
    empty set and links with nothing, and each such row is first.
    """
    rows = docs.select(
        F.expr(f"cast({key} as bigint)").alias("id"), F.expr(f"xxhash64({text})").alias("h1"),
        F.expr(f"xxhash64({text}, 1)").alias("h2"), text_bytes(text).alias("text"),
    )
    read = rows.mapInArrow(partial(_read, n), "id long, h1 long, h2 long, k binary, n long, sig binary, body binary")
    read = write_once(read.withColumn("c", F.monotonically_increasing_id()), "read")
    # Of each class the first row that has a signature; further copies in other tasks do not count.
    classes = read.where("sig is not null").groupBy("k").agg(F.min("c").alias("c"))
    classes = write_once(classes, "classes")
    reps = write_once(read.where("sig is not null").select("c", "n", "sig").join(classes.select("c"), "c"), "reps")
    small, large = _regions(reps)
    parts = width(docs.sparkSession)
    bodies = read.select("c", "body")

    def near(facts: DataFrame, nearest: bool) -> DataFrame:
        rows = small.join(facts, "c").repartition(parts, "t", "region").sortWithinPartitions("t", "region", "c")
        return rows.mapInArrow(partial(_search, least / 100, nearest), "a long, b long")

    def confirmed(pairs: DataFrame) -> DataFrame:
        pairs = write_once(pairs.distinct(), "pairs")
        both = pairs.join(bodies.toDF("a", "xa"), "a").join(bodies.toDF("b", "xb"), "b")
        both = both.select("a", "b", "xa", "xb").sortWithinPartitions("a")
        return both.mapInArrow(partial(_confirm, n, least), "a long, b long")

    crowded = large.withColumn("region", F.expr("xxhash64(path)"))
    # First each document with its likeliest partners, in a crowd with those beside it by the values of
    # the trees that follow: another order in each tree.
    facts = reps.withColumn("label", F.col("c"))
    turned = crowded.join(facts, "c").withColumn("turn", F.expr(f"concat(substring(sig, t * {4 * DEPTH} + 1), sig)"))
    turned = turned.repartitionByRange(parts, "t", "turn", "c").sortWithinPartitions("t", "turn", "c")
    beside = turned.select("c", "t", "region", "n", "label", "sig").mapInArrow(partial(_beside, least / 100), "a long, b long")
    links = write_once(confirmed(near(facts, True).union(beside)), "links")
    joined = write_once(connected(links, "a", "b").selectExpr("vertex as c", "component as label"), "joined")
    # Then all that are still apart. Pairs of a crowd are checked where they meet: a crowd has too many
    # of them to send on.
    facts = reps.join(joined, "c", "left").withColumn("label", F.coalesce("label", "c"))
    links = links.union(write_once(confirmed(near(facts, False)), "links"))
    key = ["t", "region", "_a", "_b"]
    blocks = _blocks(crowded.join(facts, "c").join(bodies.where("body is not null"), "c"))
    blocks = blocks.repartition(parts, *key).sortWithinPartitions(*key)
    links = links.union(write_once(blocks.mapInArrow(partial(_meet, n, least), "a long, b long"), "met"))
    parts_of = connected(links, "a", "b").selectExpr("vertex as c", "component as part")
    named = write_once(
        classes.join(parts_of, "c", "left").selectExpr("k", "coalesce(part, c) as part"), "named"
    )
    owner = "min(struct(id is null as last, id, h1, h2))"
    found = read.where("n > 0").select("id", "h1", "h2", "k", "n").join(named.select("k", "part"), "k")
    found = write_once(found.select("id", "h1", "h2", "n", "part"), "found")
    best = write_once(found.groupBy("part").agg(F.expr(owner).alias("best")), "best")
    linked = found.join(best, "part").selectExpr(
        "id", "h1", "h2", "n as n_shingles", "best.id as component_id",
        "best.id <=> id and best.h1 = h1 and best.h2 = h2 as first",
    )
    alone = read.where("n = 0").selectExpr("id", "h1", "h2", "n as n_shingles", "id as component_id", "true as first")
    return linked.union(alone)


#: SQL for the columns that tell rows apart.
KEYS = ("coalesce(cast(doc_id as bigint), -9223372036854775808)", "xxhash64(text)", "xxhash64(text, 1)")
#: SQL: the text has a word.
WORDED = f"coalesce(text rlike r'{WORD}', false)"


def keep(docs: DataFrame, n: int = 5, least: int = 80) -> DataFrame:
    """One row of each component with all its columns, whatever their names, and all rows without
    words. Of repeated rows (same doc_id and text) any one stays."""
    keys = unused(docs, "_id", "_h1", "_h2")
    best = dedup(docs.where(WORDED), n, least).where("first").selectExpr(
        "coalesce(id, -9223372036854775808)", "h1", "h2"
    ).toDF(*keys).distinct()
    named = docs.where(WORDED).withColumns(dict(zip(keys, map(F.expr, KEYS), strict=True)))
    kept = named.join(best, keys).dropDuplicates(keys).select(*docs.columns)
    return kept.union(docs.where(f"not {WORDED}"))


def dedup_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup(documents(spark, sf_dir), n=4)
    return found.selectExpr("id as doc_id", "n_shingles", "component_id", "id <=> component_id as kept")

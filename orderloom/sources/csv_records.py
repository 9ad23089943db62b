"""CSV records with line breaks inside quotes, read by many tasks for one file.

Whether a line break ends a record depends on how many quotes stand before it in the file, odd or
even. So the file is read as lines, which can be split anywhere, three times and without a shuffle
of its text: first the quotes of each split are counted and added up in file order, which tells of
every split whether it begins inside quotes. Then each task joins the lines of its splits to
records. What a split has of a record that begins or ends in another one, at most two pieces, is
read apart and put together.

A doubled quote counts twice, so it changes nothing. Files must be quoted well, as a quote inside
an unquoted field would count too; such a record shows as malformed, as it does in other readers.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import write_once

#: Columns of a malformed record.
BAD = ("_bad_record", "_bad_file", "_bad_line")

#: Splits known at most: one entry for each 128 MB, so this is a table of over 100 TB.
MAX_SPLITS = 1 << 20


def lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file, the place where their split of it begins, and a rising number. Only
    ``\\n`` ends a line, so that a carriage return inside quotes stays as it is."""
    rows = spark.read.option("lineSep", "\n").text(path)
    return rows.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("number"),
        F.col("value").alias("line"),
    )


def _fields(header: str) -> str:
    """SQL: the names in a header line."""
    return f"split(replace(replace(replace({header}, '\r', ''), '\"', ''), '﻿', ''), ',')"


def splits(df: DataFrame, names: list[str]) -> DataFrame:
    """For each split its lines, its quotes and, of the first of a file, the lines that may be its
    header: those that hold just ``names``, in any order."""
    text = ", ".join("'" + n.replace("\\", "\\\\").replace("'", "\\'") + "'" for n in names)
    header = f"block = 0 and length(line) between {len(','.join(names))} and {len(','.join(names)) + 2 * len(names) + 2}"
    header += f" and array_sort({_fields('line')}) = array_sort(array({text}))"
    return df.groupBy("file", "block").agg(
        F.expr("count(*) as lines"),
        F.expr("sum(length(line) - length(replace(line, '\"', ''))) as quotes"),
        F.expr("min(number) as first"),
        F.expr(f"array_min(collect_list(struct(number, line)) filter (where {header})) as header"),
    )


def starts(counted: DataFrame) -> DataFrame:
    """Of each split how many lines of its file come before it, and whether it begins inside quotes.
    One narrow row for each 128 MB goes through the window."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return counted.select(
        "file", "block", F.coalesce(F.sum("lines").over(before), F.lit(0)).alias("before"),
        (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("inside"),
    )


PIECES = "file string, block bigint, line bigint, kind int, record string"
#: Kinds of pieces: a whole record; what a split has of one that began before it; one that it begins.
WHOLE, HEAD, TAIL = range(3)


class _Split:
    """The lines of one split, batch after batch."""

    def __init__(self, file: str, block: int, before: int, inside: bool):
        self.file, self.block, self.next, self.inside = file, block, before + 1, inside
        self.header = block == 0  # the first line that is not empty is still to come
        self.kind = HEAD if inside else TAIL
        self.open: list[str] = []
        self.open_line = self.next

    def add(self, text: pa.Array) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
        """Records and their lines and kinds."""
        if self.header:
            empty = pc.is_in(text, pa.array(["", "\r"])).to_numpy(zero_copy_only=False)
            skip = len(text) if empty.all() else int(np.argmin(empty)) + 1
            self.header = bool(empty.all())
            self.next, self.open_line, text = self.next + skip, self.next + skip, text.slice(skip)
        if not len(text):
            return
        quotes = pc.count_substring(text, '"').to_numpy().astype(np.int64)
        inside = (np.cumsum(quotes) + self.inside) % 2 == 1
        begins_inside = np.concatenate([[self.inside], inside[:-1]])
        number = self.next + np.arange(len(text))
        alone = ~inside & ~begins_inside
        first, last = np.flatnonzero(inside & ~begins_inside), np.flatnonzero(begins_inside & ~inside)
        records, at, kinds = [], [], []
        if self.inside:
            end = last[0] + 1 if len(last) else len(text)
            self.open += text.slice(0, end).to_pylist()
            if len(last):
                records.append("\n".join(self.open))
                at.append(self.open_line)
                kinds.append(self.kind if self.kind == HEAD else WHOLE)
                self.kind, self.open, last = TAIL, [], last[1:]
        for a, b in zip(first.tolist(), last.tolist()):
            records.append("\n".join(text.slice(a, b + 1 - a).to_pylist()))
            at.append(int(number[a]))
            kinds.append(WHOLE)
        if len(first) > len(last):
            self.open, self.open_line = text.slice(int(first[-1])).to_pylist(), int(number[first[-1]])
        self.inside, self.next = bool(inside[-1]), self.next + len(text)
        every = pa.concat_arrays([text.filter(pa.array(alone)), pa.array(records, pa.string())])
        at, kinds = np.append(number[alone], at), np.append(np.full(alone.sum(), WHOLE), kinds)
        order = np.argsort(at)  # as they stand in the file
        yield every.take(pa.array(order)), at[order], kinds[order]

    def rest(self) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
        """What is still open at the end of the split."""
        if self.open:
            yield pa.array(["\n".join(self.open)]), np.array([self.open_line]), np.array([self.kind])


def _pieces(known: dict[str, list[np.ndarray]], whole: bool):
    """What a task does to batches of lines: whole records, or else the pieces of others."""

    def start(file: str, block: int) -> _Split:
        if file not in known or block == 0:
            return _Split(file, block, 0, False)
        blocks, before, inside = known[file]
        i = int(np.searchsorted(blocks, block))
        return _Split(file, block, int(before[i]), bool(inside[i]))

    def batch(split: _Split, found) -> Iterator[pa.RecordBatch]:
        for text, number, kind in found:
            keep = (kind == WHOLE) if whole else (kind != WHOLE)
            if whole:  # an empty line is no record
                keep &= ~pc.is_in(text, pa.array(["", "\r"])).to_numpy(zero_copy_only=False)
            n = int(keep.sum())
            if n:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([split.file]).take(pa.array(np.zeros(n, np.int64))), pa.array(np.full(n, split.block)),
                        pa.array(number[keep].astype(np.int64)), pa.array(kind[keep].astype(np.int32)), text.filter(pa.array(keep)),
                    ],
                    names=["file", "block", "line", "kind", "record"],
                )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = None
        for rows in batches:
            if not rows.num_rows:
                continue
            block, file = rows.column(1).to_numpy(), rows.column(0)
            changed = pc.not_equal(file.slice(1), file.slice(0, len(file) - 1)).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(changed | (block[1:] != block[:-1])) + 1).tolist(), len(file)]
            for a, b in zip(cuts, cuts[1:]):
                key = file[a].as_py(), int(block[a])
                if split is None or key != (split.file, split.block):
                    if split is not None:
                        yield from batch(split, split.rest())
                    split = start(*key)
                yield from batch(split, split.add(rows.column(2).slice(a, b - a)))
        if split is not None:
            yield from batch(split, split.rest())

    return run


def records(df: DataFrame, begins: DataFrame) -> DataFrame:
    """Records of the lines ``df`` with file and number of their first line; headers are left out.

    ``begins`` comes from ``starts``. Its splits behind the first of a file are collected and
    broadcast, one entry for each 128 MB of input.
    """
    later = begins.where("block > 0").orderBy("file", "block").limit(MAX_SPLITS + 1).collect()
    if len(later) > MAX_SPLITS:
        raise ValueError("too many splits: raise spark.sql.files.maxPartitionBytes")
    known: dict[str, list] = {}
    for row in later:
        known.setdefault(row.file, []).append((row.block, row.before, row.inside))
    arrays = {file: [np.array(column) for column in zip(*rows)] for file, rows in known.items()}
    text = df.select("file", "block", "line")
    whole = text.mapInArrow(_pieces(arrays, True), PIECES).select("file", "line", "record")
    if not arrays:
        # No file is split, so nothing but an unclosed quote at its end can be open.
        pieces = text.mapInArrow(_pieces(arrays, False), PIECES).select("file", "line", "record")
        return whole.unionByName(pieces)
    pieces = text.mapInArrow(_pieces(arrays, False), PIECES)
    order = Window.partitionBy("file").orderBy("block", "kind")
    pieces = pieces.withColumn("nth", F.expr(f"count_if(kind = {TAIL})").over(order))
    joined = pieces.groupBy("file", "nth").agg(
        F.expr("min(line) as line"),
        F.expr("array_join(transform(array_sort(collect_list(struct(block, record))), p -> p.record), '\n') as record"),
    )
    return whole.unionByName(joined.select("file", "line", "record"))


def _parsed(names: list[str], mode: str) -> Column:
    options = {"quote": '"', "escape": '"', "multiLine": "true", "mode": mode, "columnNameOfCorruptRecord": BAD[0]}
    fields = [*names, BAD[0]] if mode == "PERMISSIVE" else names
    schema = ", ".join("`" + n.replace("`", "``") + "` string" for n in fields)
    return F.from_csv(F.col("record"), schema, options)


def single_lines(df: DataFrame, counted: DataFrame) -> DataFrame:
    """The lines ``df`` as records, where no quoted field holds a line break; headers are left out.

    A line's number follows from its place in its split. Both scans deal the same splits over tasks
    alike, so the rising numbers of ``lines`` are those that were counted. What is known of the splits,
    one narrow row for each 128 MB, goes to the lines: dealt by split, a task would sort a whole one.
    """
    heads = counted.where("block = 0").select("file", F.col("header.number").alias("head"))
    places = starts(counted).drop("inside").join(counted.select("file", "block", "first"), ["file", "block"])
    rows = df.join(F.broadcast(places.join(heads, "file")), ["file", "block"])
    rows = rows.where("not (block = 0 and number <= head) and line not in ('', '\r')")
    return rows.selectExpr("file", "before + number - first + 1 as line", "line as record")


def read_records(
    spark: SparkSession, path: str, names: list[str], breaks: bool = True, keep_bad: bool = False
) -> DataFrame:
    """The table of CSV files at ``path`` with the columns ``names``, all text, an empty field NULL.
    ``breaks`` says that quoted fields may hold line breaks.

    The files' headers hold these names, each file in an order of its own; another header stops the
    read. A record with more or fewer fields stops it too, unless ``keep_bad``: then such a record
    has NULL in all columns and stands in the columns BAD, with its file and the number of its line.
    """
    df = lines(spark, path)
    counted = write_once(splits(df, names), "splits")
    first = counted.where("block = 0")
    unknown = [row.file for row in first.where("header is null").limit(3).collect()]
    if unknown:
        raise ValueError(f"header without just the columns {names}: {unknown}")
    orders = [row.fields for row in first.selectExpr(f"{_fields('header.line')} as fields").distinct().limit(101).collect()]
    if len(orders) > 100:
        raise ValueError("over 100 different orders of columns")
    rows = records(df, starts(counted)) if breaks else single_lines(df, counted)
    rows = rows.withColumn("record", F.expr("if(right(record, 1) = '\r', left(record, length(record) - 1), record)"))
    mode = "PERMISSIVE" if keep_bad else "FAILFAST"
    if len(orders) == 1:
        parsed = rows.select("file", "line", "record", _parsed(orders[0], mode).alias("row"))
        parsed = parsed.selectExpr("file", "line", "record", "inline(array(row))")
    else:
        heads = first.selectExpr("file", f"{_fields('header.line')} as fields")
        rows = rows.join(heads, "file")
        common = [*names, BAD[0]] if keep_bad else names
        whole = ", ".join("row.`" + n.replace("`", "``") + "`" for n in common)
        parts = []
        for fields in orders:
            mine = rows.where(F.col("fields") == F.array(*map(F.lit, fields)))
            parsed = mine.select("file", "line", "record", _parsed(list(fields), mode).alias("row"))
            parts.append(parsed.selectExpr("file", "line", "record", f"inline(array(struct({whole})))"))
        parsed = parts[0]
        for part in parts[1:]:
            parsed = parsed.unionByName(part)
    columns = [F.col("`" + n.replace("`", "``") + "`") for n in names]
    if not keep_bad:
        return parsed.select(*columns)
    bad = F.col(BAD[0]).isNotNull()
    kept = [F.when(~bad, c).alias(n) for c, n in zip(columns, names)]
    return parsed.select(*kept, F.when(bad, F.col("record")).alias(BAD[0]), F.when(bad, F.col("file")).alias(BAD[1]), F.when(bad, F.col("line")).alias(BAD[2]))

"""Byte-level BPE encoding and decoding with numpy matrices.

Distinct pieces of text are put into padded matrices by length. In each round every row looks its
neighbouring pairs up in a hash table and merges the leftmost pair of least rank; finished rows
leave the matrix. A row too long for a matrix is worked on alone.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark.sql import DataFrame


NONE = np.int32(2**31 - 1)
#: Longest piece, in bytes, that goes into a matrix; the matrices are 2, 4, 8 ... wide.
WIDEST = 64
#: Rows of one matrix, pieces remembered, and texts at a time of a task: bounds of its memory.
ROWS, REMEMBERED, SLICE = 20_000, 150_000, 500
#: Marks that end a word and are a match of their own.
MARKS = (".", ",")


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a ``.tiktoken`` file. Read on the driver; a vocabulary is bounded data."""
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


@dataclass
class Pairs:
    """Open-addressing hash table from a pair of ids to the id of the two joined."""

    keys: np.ndarray
    values: np.ndarray

    @staticmethod
    def slot(keys: np.ndarray, size: int) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)) & np.uint64(size - 1)

    @classmethod
    def build(cls, ranks: dict[bytes, int]) -> Pairs:
        found = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    found[(a << 32) | b] = rank
        size = 1 << max(4, (4 * len(found)).bit_length())
        todo = np.fromiter(found.keys(), np.uint64, len(found))
        joined = np.fromiter(found.values(), np.int32, len(found))
        keys = np.full(size, np.iinfo(np.uint64).max, np.uint64)
        values = np.full(size, NONE, np.int32)
        at = cls.slot(todo, size)
        while len(todo):
            free = keys[at] == np.iinfo(np.uint64).max
            slots, first = np.unique(at[free], return_index=True)
            mine = np.flatnonzero(free)[first]
            keys[slots], values[slots] = todo[mine], joined[mine]
            rest = np.ones(len(todo), bool)
            rest[mine] = False
            todo, joined = todo[rest], joined[rest]
            at = (at[rest] + np.uint64(1)) & np.uint64(size - 1)
        return cls(keys, values)

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Joined ids, NONE where a pair does not join; ids below 0 are padding and never do."""
        shape = a.shape
        keys = (a.astype(np.int64).astype(np.uint64) << np.uint64(32)) | b.astype(np.uint32).astype(np.uint64)
        keys = keys.ravel()
        at = self.slot(keys, len(self.keys)).astype(np.int64)
        out, todo = np.full(len(keys), NONE, np.int32), np.arange(len(keys))
        while len(todo):
            seen = self.keys[at]
            hit = seen == keys[todo]
            out[todo[hit]] = self.values[at[hit]]
            more = ~hit & (seen != np.iinfo(np.uint64).max)
            todo, at = todo[more], (at[more] + 1) & (len(self.keys) - 1)
        return np.where((a < 0) | (b < 0), NONE, out.reshape(shape))


class Codec:
    """Encoder and decoder of one vocabulary; what a task keeps."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, pairs: Pairs):
        self.pattern, self.pairs = regex.compile(pattern), pairs
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.single = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        self.loose = regex.compile(r" (?!\S)")
        self.matches: dict[str, bytes] = {}
        self.first: dict[str, bytes] = {}
        self.after: dict[str, bytes] = {}
        # The short cuts hold if the pattern binds a space to what follows and splits letters from marks.
        self.spaced = all(
            [m.group() for m in self.pattern.finditer(t)] == want
            for t, want in (
                ("a b", ["a", " b"]), ("a\n b", ["a", "\n", " b"]), ("1 !", ["1", " !"]),
                ("it's", ["it", "'s"]), (" ab,", [" ab", ","]),
            )
        )

    def merge_rows(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of pieces, each as little-endian 32-bit numbers."""
        out: list[bytes] = [b""] * len(pieces)
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        for i in np.flatnonzero(lengths > WIDEST):
            out[i] = self.merge_long(np.frombuffer(pieces[i], np.uint8))
        low, wide = 0, 2
        while low < WIDEST:
            at = np.flatnonzero((lengths > low) & (lengths <= wide))
            for start in range(0, len(at), ROWS):
                self.merge_matrix(pieces, at[start : start + ROWS], lengths, wide, out)
            low, wide = wide, wide * 2
        return out

    def merge_matrix(self, pieces, at, lengths, wide, out) -> None:
        size = lengths[at]
        flat = self.single[np.frombuffer(b"".join([pieces[i] for i in at]), np.uint8)]
        ids = np.full((len(at), wide), -1, np.int32)
        ids[np.arange(wide) < size[:, None]] = flat
        rank = self.pairs(ids[:, :-1], ids[:, 1:])
        columns = np.arange(wide)
        while len(at):
            j = rank.argmin(axis=1)
            rows = np.arange(len(at))
            best = rank[rows, j]
            done = best == NONE
            if done.any():
                for i, row, n in zip(at[done], ids[done], size[done], strict=True):
                    out[i] = row[:n].tobytes()
                live = ~done
                at, ids, rank, size, j, best = at[live], ids[live], rank[live], size[live], j[live], best[live]
                rows = np.arange(len(at))
                if not len(at):
                    return
            ids[rows, j] = best
            # Close the gap behind the merged pair.
            source = np.minimum(columns + (columns > j[:, None]), wide - 1)
            ids = np.take_along_axis(ids, source, axis=1)
            ids[:, -1] = np.where(size == wide, -1, ids[:, -1])
            rank = np.take_along_axis(rank, np.minimum(source[:, :-1], wide - 2), axis=1)
            rank[:, -1] = NONE
            size = size - 1
            right = np.minimum(j + 1, wide - 1)
            rank[rows, np.minimum(j, wide - 2)] = np.where(
                j < wide - 1, self.pairs(ids[rows, j], np.where(j < wide - 1, ids[rows, right], -1)), NONE
            )
            left = np.maximum(j - 1, 0)
            rank[rows, left] = np.where(
                j > 0, self.pairs(np.where(j > 0, ids[rows, left], -1), ids[rows, j]), rank[rows, left]
            )

    def merge_long(self, piece: np.ndarray) -> bytes:
        """One long row. All places of the least rank are merged in one round, from left to right,
        unless one of them makes a pair of still lower rank, which would have to come first."""
        ids = self.single[piece]
        while len(ids) > 1:
            rank = self.pairs(ids[:-1], ids[1:])
            best = rank.min()
            if best == NONE:
                break
            at = np.flatnonzero(rank == best)
            # Of places that overlap, as in a run of one letter, every other one counts.
            run = np.concatenate([[True], np.diff(at) > 1])
            start = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - start) % 2 == 0]
            joined = self._join(ids, at, best)
            new = np.flatnonzero(joined == best)
            around = [self.pairs(joined[new[new > 0] - 1], joined[new[new > 0]])]
            inner = new[new < len(joined) - 1]
            around.append(self.pairs(joined[inner], joined[inner + 1]))
            if len(at) > 1 and min([NONE, *(x.min() for x in around if len(x))]) < best:
                joined = self._join(ids, at[:1], best)
            ids = joined
        return ids.tobytes()

    @staticmethod
    def _join(ids: np.ndarray, at: np.ndarray, best: int) -> np.ndarray:
        keep = np.ones(len(ids), bool)
        keep[at + 1] = False
        ids = ids.copy()
        ids[at] = best
        return ids[keep]

    def _learn(self, known: dict[str, bytes], pieces: set[str], lead: str) -> None:
        """Encode pieces not met before and remember them, and the matches they consist of.

        A word, alone or before one mark, needs no search by the pattern.
        """
        ids, words, marked, rest = self.matches, [], [], []
        for p in pieces:
            if p.isalpha():
                words.append(p)
            elif p[-1:] in MARKS and p[:-1].isalpha():
                marked.append(p)
            else:
                rest.append(p)
        if not self.spaced:
            words, marked, rest = [], [], list(pieces)
        parts = [self.pattern.findall(lead + p) for p in rest]
        wanted = {lead + p for p in words}
        wanted.update([lead + p[:-1] for p in marked])
        wanted.update(MARKS if marked else ())
        wanted.update(*parts)
        new = list(wanted.difference(ids))
        ids.update(zip(new, self.merge_rows([x.encode() for x in new]), strict=True))
        known.update([(p, ids[lead + p]) for p in words])
        known.update([(p, ids[lead + p[:-1]] + ids[p[-1]]) for p in marked])
        known.update([(p, b"".join([ids[x] for x in found])) for p, found in zip(rest, parts, strict=True)])

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """Ids of whole texts, as little-endian unsigned 32-bit numbers."""
        out = []
        for start in range(0, len(texts), SLICE):
            some = texts[start : start + SLICE]
            for known in (self.first, self.after, self.matches):
                if len(known) > REMEMBERED:
                    known.clear()
            # A space before a non-space always starts a match. Texts with no other spaces are cut at
            # them and the pieces, which repeat, are encoded once; the rest are cut by the pattern.
            plain = [self.spaced and self.loose.search(t) is None for t in some]
            cut = [t.split(" ") if ok else self.pattern.findall(t) for t, ok in zip(some, plain, strict=True)]
            first, after = set(), set()
            for c, ok in zip(cut, plain, strict=True):
                if ok:
                    first.add(c[0])
                    after.update(c[1:])
                else:
                    first.update(c)
            if new := after.difference(self.after):
                self._learn(self.after, new, " ")
            if new := first.difference(self.first):
                self._learn(self.first, new, "")
            for c, ok in zip(cut, plain, strict=True):
                if ok:
                    out.append(self.first[c[0]] + b"".join(map(self.after.__getitem__, c[1:])))
                else:
                    out.append(b"".join(map(self.first.__getitem__, c)))
        return out

    def decode(self, ids: bytes) -> bytes:
        """The bytes of ids; an id that is not in the vocabulary is an error."""
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _codec_of(spark, path: str, pattern: str):
    """A function that gives each Python process its codec, from tables broadcast once: they are
    bounded by the vocabulary, not by the data."""
    ranks = read_ranks(path)
    sent = spark.sparkContext.broadcast((ranks, Pairs.build(ranks)))
    kept: dict = {}

    def codec() -> Codec:
        if not kept:
            kept[0] = Codec(sent.value[0], pattern, sent.value[1])
        return kept[0]

    return codec


def _texts(column: pa.Array) -> list[str]:
    return ["" if t is None else t for t in column.to_pylist()]


def _added(df: DataFrame, column: str, fields: dict[str, str], work) -> DataFrame:
    """``df`` with columns made from another by ``work``, SLICE rows at a time; columns of the same
    names are replaced."""
    rest = [c for c in df.columns if c not in fields]
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*rest).schema]
    schema = ", ".join([*kept, *(f"`{name}` {kind}" for name, kind in fields.items())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE):
                batch = whole.slice(start, SLICE)
                new = work(batch.column(column))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), *new], names=[*rest, *fields])

    return df.mapInArrow(run, schema)


def encode(
    df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids", check: str | None = None
) -> DataFrame:
    """``df`` with the token ids of each whole text as an array; a null or empty text has none.

    ``check`` names a column that tells whether decoding the ids gives the text again, in the same pass.
    """
    codec = _codec_of(df.sparkSession, path, pattern)
    fields = {ids: "array<int>"} | ({check: "boolean"} if check else {})

    def work(column):
        texts = _texts(column)
        found = codec().encode(texts)
        ends = np.concatenate([[0], np.cumsum([len(x) // 4 for x in found])]).astype(np.int32)
        yield pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(found), np.int32)))
        if check:
            yield pa.array([codec().decode(x) == t.encode() for x, t in zip(found, texts, strict=True)], pa.bool_())

    return _added(df, text, fields, work)


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", data: str = "data") -> DataFrame:
    """``df`` with the bytes that the ids stand for; a null array stands for no bytes."""
    codec = _codec_of(df.sparkSession, path, pattern)

    def work(column):
        # Null arrays have no ids, so the lengths give the places of the others.
        sizes = pa.compute.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes) * 4
        data = column.flatten().to_numpy(zero_copy_only=False).astype("<u4").tobytes()
        rows = [data[e - 4 * n : e] for e, n in zip(ends, sizes, strict=True)]
        yield pa.array([codec().decode(x) for x in rows], pa.binary())

    return _added(df, ids, {data: "binary"}, work)


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Digests of the encoded and of the decoded text of each document. One task, one pass.

    A null text counts as empty: no tokens and the digest of no bytes. Repeated rows are encoded
    like any other; a text of any length is encoded whole.
    """
    codec = _codec_of(docs.sparkSession, path, pattern)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = lambda data: hashlib.sha256(data).hexdigest()
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                found = codec().encode(_texts(part.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([len(x) // 4 for x in found], pa.int64()),
                        pa.array([digest(x) for x in found]),
                        pa.array([digest(codec().decode(x)) for x in found]),
                    ],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return docs.selectExpr("cast(doc_id as bigint) as doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )

"""Alignment of two tokenizers over the same bytes, by merge-path partitioning.

Tokenizer A gets a space and the text, tokenizer B the text, to which it adds that space itself, so
both cut the same bytes. The ends of A's and of B's tokens are two sorted lists. Their merge is a
path through a grid; diagonals at equal distances cut it into pieces of equal work, wherever the
tokens of one side are many. A binary search on each diagonal finds where the path crosses it, all
pieces then merge side by side, and each gives the ends that both lists have. A group that a
diagonal cuts is closed by the later piece: the ends of all pieces, put end to end, are the groups.

A pair of tokens that end together is linked. Both are read off the same bytes, so one is a suffix
of the other: the pairs that can ever be linked follow from the vocabularies alone. They are
numbered once, and corpus-wide counts are one number for each, whatever the input.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import write_once

#: Steps of one piece of the merge.
PIECE = 64
#: Texts and new words at a time, and words remembered, by a task.
SLICE, WORDS, REMEMBERED = 200, 2000, 150_000
#: What B writes for a space.
SPACE = "▁"

#: A space not followed by a visible character, or B's own space: such a text is encoded whole. In
#: any other, each space starts a token of both tokenizers.
LOOSE = re.compile(rf" (?!\S)|{SPACE}")
#: Fixed value: the pattern by which byte-level tokenizers cut a text.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Marks that may end a word.
MARKS = (".", ",")
BYTE = re.compile(r"<0x([0-9A-F]{2})>")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in A's entries: itself if it can be seen, else the next
    letter from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(256 + n): b for n, b in enumerate(rest)}


def _summed(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


def _byte_level(vocabulary: str) -> tuple[Callable[[list[str]], list[list[int]]], dict[str, int]]:
    """An encoder of texts by the contents of a tokenizer's file, and the ids of its entries.

    Where merges come in the order of the ids they make, ids are ranks and the text is cut by the
    usual pattern, the rank-based library gives the same ids, several times as fast.
    """
    import tiktoken
    import tokenizers

    parts = json.loads(vocabulary)
    entries = parts["model"]["vocab"] | {t["content"]: t["id"] for t in parts["added_tokens"]}
    letters, model, cut = byte_letters(), parts["model"], parts["pre_tokenizer"] or {}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", ())]
    made = [model["vocab"][x + y] for x, y in merges]
    added = {t["id"] for t in parts["added_tokens"]}
    ranked = (
        model["type"] == "BPE" and all(x < y for x, y in zip(made, made[1:])) and parts["normalizer"] is None
        and cut == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": cut.get("trim_offsets"), "use_regex": True}
        and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        and len(merges) + 256 + len(added - {*made}) == len(entries)
    )
    if ranked:
        ranks = {bytes(map(letters.__getitem__, t)): i for t, i in model["vocab"].items() if i not in added}
        fast = tiktoken.Encoding("aligned", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        return lambda texts: [fast.encode_ordinary(t) for t in texts], entries
    slow = tokenizers.Tokenizer.from_str(vocabulary)
    slow.encode_special_tokens = True
    return lambda texts: [e.ids for e in slow.encode_batch(texts, add_special_tokens=False)], entries


class Tokenizers:
    """Both tokenizers of a task, from the contents of their files, and the bytes of their tokens."""

    def __init__(self, vocabulary: str, model: bytes):
        import sentencepiece

        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.encode_a, entries = _byte_level(vocabulary)
        letters = byte_letters()
        self.a_bytes = [b""] * (max(entries.values()) + 1)
        for token, i in entries.items():
            # An added token is not spelt in letters for bytes; it never comes out of a plain text.
            known = all(c in letters for c in token)
            self.a_bytes[i] = bytes(map(letters.__getitem__, token)) if known else token.encode()
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            byte = BYTE.fullmatch(piece)
            self.b_bytes.append(bytes.fromhex(byte[1]) if byte else piece.replace(SPACE, " ").encode())
        # Words may be encoded one by one if no entry of B goes on after a space.
        self.by_word = not any(SPACE in self.b.id_to_piece(i).lstrip(SPACE) for i in range(len(self.b_bytes)))
        self.a_length, self.b_length = (np.array([len(t) for t in x], np.int64) for x in (self.a_bytes, self.b_bytes))
        # A mark behind a word is a token of its own if no entry of either side goes on to it.
        self.marks = {
            mark: tuple(np.array(ids, "<i4").tobytes() for ids in (self.encode_a([mark])[0], [self.b.piece_to_id(mark)]))
            for mark in MARKS
            if not any(mark.encode() in t and t[: t.index(mark.encode())][-1:].isalpha() for t in self.a_bytes)
            and self.b.id_to_piece(self.b.piece_to_id(mark)) == mark
            and not any(mark in t and t[: t.index(mark)][-1:].isalpha() for t in map(self.b.id_to_piece, range(len(self.b_bytes))))
        }
        self.a_known: dict[str, bytes] = {}
        self.b_known: dict[str, bytes] = {}
        self.changed: set[str] = set()

    def _whole(self, texts: list[str]) -> tuple[list[bytes], list[bytes], np.ndarray]:
        """Ids of both sides as 32-bit numbers, and whether both spell the text."""
        a = self.encode_a([f" {t}" for t in texts])
        b = self.b.encode(texts, num_threads=1)
        want = [f" {t}".encode() for t in texts]
        size, good, out = np.array([len(w) for w in want], np.int64), np.ones(len(texts), bool), []
        for side, tokens, length in ((a, self.a_bytes, self.a_length), (b, self.b_bytes, self.b_length)):
            n = np.fromiter(map(len, side), np.int64, len(side))
            flat = np.fromiter(chain.from_iterable(side), "<i4", n.sum())
            same = _summed(length[flat], n) == size
            if not (same.all() and self._spelt(chain.from_iterable(side), tokens, b"".join(want))):
                same = np.array([self._spelt(ids, tokens, w) for ids, w in zip(side, want, strict=True)], bool)
            good &= same
            data, ends = flat.tobytes(), (4 * np.cumsum(n)).tolist()
            out.append([data[s:e] for s, e in zip([0, *ends], ends)])
        return out[0], out[1], good

    def _words(self, words: list[str]) -> tuple[list[bytes], list[bytes], np.ndarray]:
        """What ``_whole`` gives, for words that both sides cut a text into: they are encoded as one
        text and parted where tokens end with them. If a side changes one, each is encoded alone."""
        text = " ".join(words)
        want = f" {text}".encode()
        a, b = self.encode_a([f" {text}"])[0], self.b.encode(text)
        ends, out = np.cumsum([len(w.encode()) + 1 for w in words]), []
        for ids, tokens, length in ((a, self.a_bytes, self.a_length), (b, self.b_bytes, self.b_length)):
            flat = np.array(ids, "<i4")
            at = np.cumsum(length[flat])
            cuts = np.searchsorted(at, ends)
            if at[-1] != len(want) or (at[cuts] != ends).any() or not self._spelt(ids, tokens, want):
                return self._whole(words)
            data, cuts = flat.tobytes(), (4 * cuts + 4).tolist()
            out.append([data[s:e] for s, e in zip([0, *cuts], cuts)])
        return out[0], out[1], np.ones(len(words), bool)

    @staticmethod
    def _spelt(ids: Iterable[int], tokens: list[bytes], want: bytes) -> bool:
        return want == b"".join(map(tokens.__getitem__, ids))

    def _learn(self, words: set[str]) -> None:
        if len(self.a_known) > REMEMBERED:
            for known in (self.a_known, self.b_known, self.changed):
                known.clear()
        unknown = words.difference(self.a_known)
        marked = [w for w in unknown if w[-1] in self.marks and w[:-1].isalpha()]
        new = list(unknown.difference(marked).union([w[:-1] for w in marked]).difference(self.a_known))
        for start in range(0, len(new), WORDS):
            some = new[start : start + WORDS]
            a, b, good = self._words(some)
            self.a_known.update(zip(some, a, strict=True))
            self.b_known.update(zip(some, b, strict=True))
            self.changed.update([w for w, ok in zip(some, good, strict=True) if not ok])
        for word in marked:
            a, b = self.marks[word[-1]]
            self.a_known[word], self.b_known[word] = self.a_known[word[:-1]] + a, self.b_known[word[:-1]] + b
            if word[:-1] in self.changed:
                self.changed.add(word)

    def encode(self, texts: Sequence[str]) -> list[tuple[bytes, bytes]]:
        """Ids of A and of B for each whole text; none for a text that one of them does not spell.

        A text that both cut at its spaces is put together from its words, which repeat; of one with
        a word that comes out changed, and of any other, the whole text decides.
        """
        cut = [t.split(" ") if t and self.by_word and not LOOSE.search(f" {t}") else None for t in texts]
        self._learn(set().union(*(words for words in cut if words)))
        if self.changed:
            cut = [None if words is None or not self.changed.isdisjoint(words) else words for words in cut]
        rest = [t for t, words in zip(texts, cut, strict=True) if t and words is None]
        whole = iter(list(zip(*self._whole(rest), strict=True)) if rest else [])
        out = []
        for text, words in zip(texts, cut, strict=True):
            if words is not None:
                out.append((b"".join(map(self.a_known.__getitem__, words)), b"".join(map(self.b_known.__getitem__, words))))
            elif text:
                a, b, good = next(whole)
                out.append((a, b) if good else (b"", b""))
            else:
                out.append((b"", b""))
        return out


def linkable(a_bytes: Sequence[bytes], b_bytes: Sequence[bytes]) -> np.ndarray:
    """All pairs (A id, B id) of which one is a suffix of the other, as sorted numbers (a << 32) | b.

    Their number is bounded by the vocabularies: a token has as many suffixes as bytes.
    """

    def by_bytes(tokens):
        out: dict[bytes, list[int]] = {}
        for i, token in enumerate(tokens):
            out.setdefault(token, []).append(i)
        return out

    a_at, b_at = by_bytes(a_bytes), by_bytes(b_bytes)
    pairs = set()
    for token, ids in a_at.items():
        for start in range(len(token)):
            for b in b_at.get(token[start:], ()):
                pairs.update([(a << 32) | b for a in ids])
    for token, ids in b_at.items():
        for start in range(1, len(token)):
            for a in a_at.get(token[start:], ()):
                pairs.update([(a << 32) | b for b in ids])
    return np.array(sorted(pairs), np.int64)


def crossings(a: np.ndarray, b: np.ndarray, step: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """Where the merge of two sorted lists crosses the diagonals 0, step, 2 step ... and the end: so
    many of ``a`` and so many of ``b`` come before. Of equal values that of ``a`` comes first."""
    d = np.append(np.arange(0, len(a) + len(b), step), len(a) + len(b))
    low, high = np.maximum(0, d - len(b)), np.minimum(d, len(a))
    while (live := np.flatnonzero(low < high)).size:
        middle = (low[live] + high[live]) // 2
        before = a[middle] <= b[d[live] - 1 - middle]
        low[live] = np.where(before, middle + 1, low[live])
        high[live] = np.where(before, high[live], middle)
    return low, d - low


def shared_ends(a: np.ndarray, b: np.ndarray, step: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """Places in two strictly rising lists of the values that both have, by merging in pieces.

    A piece looks back at the last value of ``a`` before it, which may belong to the piece before:
    a pair that a diagonal separates is found by the later piece.
    """
    if not len(a) or not len(b):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    i, j = crossings(a, b, step)
    i, last_i, j, last_j = i[:-1].copy(), i[1:], j[:-1].copy(), j[1:]
    met, place = np.zeros((len(i), step), bool), np.zeros((len(i), step), np.int64)
    top_a, top_b = len(a) - 1, len(b) - 1
    for t in range(step):
        more_a, more_b = i < last_i, j < last_j
        x, y = a[np.minimum(i, top_a)], b[np.minimum(j, top_b)]
        take_a = more_a & (~more_b | (x <= y))
        take_b = more_b & ~take_a
        met[:, t] = take_b & (i > 0) & (a[i - 1] == y)
        place[:, t] = j
        i, j = i + take_a, j + take_b
    found = place[met]
    # The value is the same on both sides, so its place in a follows from how many of a came before.
    return np.searchsorted(a, b[found]), found


def _listed(values: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(ends, pa.array(values.astype(np.int32)))


#: The tokenizers a Python process has open, so that its tasks share the words it has met.
_OPEN: dict[tuple[str, str], Tokenizers] = {}


def _files(json_path: str, model_path: str) -> tuple[str, bytes]:
    """Contents of the files, read on the driver: a vocabulary is bounded data that may be broadcast,
    and a worker need not have the files."""
    with open(json_path, encoding="utf-8") as file, open(model_path, "rb") as model:
        return file.read(), model.read()


def _slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE):
            yield batch.slice(start, SLICE)


#: Columns that align adds: ids of both sides, and how many tokens of each every group has.
ALIGNED = {"a_ids": "array<int>", "b_ids": "array<int>", "a_sizes": "array<int>", "b_sizes": "array<int>"}


def _aligner(spark: SparkSession, json_path: str, model_path: str, rest: list[str]):
    """What a task does to batches of the columns ``rest`` and, behind them, the text."""
    key, files = (json_path, model_path), spark.sparkContext.broadcast(_files(json_path, model_path))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _OPEN:
            _OPEN.clear()
            _OPEN[key] = Tokenizers(*files.value)
        own = _OPEN[key]
        for batch in _slices(batches):
            found = own.encode(["" if t is None else t for t in batch.column(len(rest)).to_pylist()])
            a, b = (np.frombuffer(b"".join([f[side] for f in found]), "<i4") for side in (0, 1))
            n_a, n_b = (np.array([len(f[side]) // 4 for f in found], np.int64) for side in (0, 1))
            # The texts of a slice are merged as one: each one's end is an end of both sides.
            at_a, at_b = shared_ends(np.cumsum(own.a_length[a]), np.cumsum(own.b_length[b]))
            groups = np.diff(np.searchsorted(at_a, np.concatenate([[0], np.cumsum(n_a)])))
            sizes = [np.diff(at, prepend=-1) for at in (at_a, at_b)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(rest)], _listed(a, n_a), _listed(b, n_b), *(_listed(s, groups) for s in sizes)],
                names=[*rest, *ALIGNED],
            )

    return run


def align(df: DataFrame, json_path: str, model_path: str, text: str = "text") -> DataFrame:
    """``df`` without the text, with the token ids of both sides and the sizes of the groups that
    their common ends cut them into; other columns of these four names are replaced.

    Null and empty texts, and those of which a tokenizer changes the bytes, have empty lists.
    Repeated rows are worked on like any other, an empty table gives none, and a text of any length
    is encoded whole.
    """
    rest = [c for c in df.columns if c != text and c not in ALIGNED]
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*(f"`{c}`" for c in rest)).schema]
    schema = ", ".join([*kept, *(f"{name} {kind}" for name, kind in ALIGNED.items())])
    rows = df.select(*(f"`{c}`" for c in rest), F.col(f"`{text}`").cast("string").alias(text))
    return rows.mapInArrow(_aligner(df.sparkSession, json_path, model_path, rest), schema)


def _numbers(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def _sizes(column: pa.Array) -> np.ndarray:
    return np.diff(column.offsets.to_numpy()).astype(np.int64)


class Spelling:
    """Decimal ids with the mark behind them, as rows of bytes: ``,`` or ``|`` after an A id, ``,``
    or ``;`` after a B id."""

    def __init__(self, a: int, b: int):
        rows = [f"{i}{mark}".encode() for n, marks in ((a, ",|"), (b, ",;")) for i in range(n) for mark in marks]
        self.b_from, self.length = 2 * a, np.array([len(r) for r in rows], np.int64)
        wide = self.length.max()
        self.rows = np.frombuffer(b"".join(r.ljust(wide) for r in rows), np.uint8).reshape(len(rows), wide)

    def __call__(self, a: np.ndarray, b: np.ndarray, a_sizes: np.ndarray, b_sizes: np.ndarray) -> tuple[bytes, np.ndarray]:
        """All groups as text, each ``a1,a2|b1,b2;``, and the length of each."""
        a_end, b_end = np.cumsum(a_sizes), np.cumsum(b_sizes)
        codes = np.zeros(len(a) + len(b), np.int64)
        a_code, b_code = 2 * a, self.b_from + 2 * b
        a_code[a_end - 1] += 1
        b_code[b_end - 1] += 1
        codes[np.arange(len(a)) + np.repeat(b_end - b_sizes, a_sizes)] = a_code
        codes[np.arange(len(b)) + np.repeat(a_end, b_sizes)] = b_code
        length = self.length[codes]
        text = self.rows[codes][np.arange(self.rows.shape[1]) < length[:, None]].tobytes()
        ends = np.concatenate([[0], np.cumsum(length)])[np.concatenate([[0], a_end + b_end])]
        return text, np.diff(ends)


def link_documents(docs: DataFrame, json_path: str, model_path: str) -> DataFrame:
    """Sizes, groups and corpus-wide link counts of each document; its groups as a digest.

    The aligned documents are read once and written with the numbers of their linked pairs. Counts
    are added up within each task first; the whole list of them has a length fixed by the
    vocabularies, so it may pass the driver and be broadcast.
    """
    aligner = _aligner(docs.sparkSession, json_path, model_path, ["doc_id"])
    both = Tokenizers(*_files(json_path, model_path))
    pairs = linkable(both.a_bytes, both.b_bytes)
    context = docs.sparkSession.sparkContext
    sent = context.broadcast((pairs, Spelling(len(both.a_bytes), len(both.b_bytes))))
    plain = {"doc_id": "bigint", "n_a": "bigint", "n_b": "bigint", "n_groups": "bigint"}
    schema = plain | {"groups_sha256": "string", "pairs": "array<int>", "times": "array<int>"}

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, spelling = sent.value
        for batch in aligner(batches):
            lists = [batch.column(name) for name in ALIGNED]
            a, b, a_sizes, b_sizes = map(_numbers, lists)
            n_a, n_b, n_groups, _ = map(_sizes, lists)
            text, length = spelling(a, b, a_sizes, b_sizes)
            ends = np.cumsum(_summed(length, n_groups))
            starts = np.concatenate([[0], ends])
            # The mark behind a document's last group is not part of it.
            shas = [hashlib.sha256(text[s : e - 1]).hexdigest() if e > s else "" for s, e in zip(starts, ends)]
            link = np.searchsorted(pairs, (a[np.cumsum(a_sizes) - 1] << 32) | b[np.cumsum(b_sizes) - 1])
            owner = np.repeat(np.arange(batch.num_rows), n_groups)
            found, times = np.unique(owner * len(pairs) + link, return_counts=True)
            kinds = np.bincount(found // len(pairs), minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), *(pa.array(n) for n in (n_a, n_b, n_groups)), pa.array(shas, pa.string()),
                    _listed(found % len(pairs), kinds), _listed(times, kinds),
                ],
                names=[*schema],
            )

    rows = docs.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text")
    digests = rows.mapInArrow(digest, ", ".join(f"{name} {kind}" for name, kind in schema.items()))
    digests = write_once(digests, "aligned")

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(sent.value[0]), np.int64)
        for batch in batches:
            np.add.at(total, _numbers(batch.column(0)), _numbers(batch.column(1)))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["pair", "n"])

    counted = digests.select("pairs", "times").mapInArrow(count, "pair bigint, n bigint")
    counted = counted.groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(len(pairs), np.int64)
    total[counted["pair"].to_numpy()] = counted["n"].to_numpy()
    highest = np.zeros(len(both.b_bytes), np.int64)
    np.maximum.at(highest, pairs & 0xFFFFFFFF, total)
    counts = context.broadcast((total, total == highest[pairs & 0xFFFFFFFF]))
    out = plain | {"n_links": "bigint", "n_best": "bigint", "count_sum": "bigint", "groups_sha256": "string"}

    def weigh(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, best = counts.value
        for batch in _slices(batches):
            pair, times = _numbers(batch.column("pairs")), _numbers(batch.column("times"))
            sizes = _sizes(batch.column("pairs"))
            sums = [_summed(v, sizes) for v in (times, times * best[pair], times * total[pair])]
            arrays = [batch.column(name) for name in plain] + [pa.array(s, pa.int64()) for s in sums]
            yield pa.RecordBatch.from_arrays([*arrays, batch.column("groups_sha256")], names=[*out])

    return digests.mapInArrow(weigh, ", ".join(f"{name} {kind}" for name, kind in out.items()))

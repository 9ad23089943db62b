"""Repair of conversations by weighted interval parsing.

A well-formed conversation reads ``(s?(ua)+)?`` by the initials of its roles: perhaps a system row,
then user and assistant in turn. Each row may be kept (free), given the role user or assistant (3)
or deleted (4), and an empty row of either role may be inserted anywhere (3); a truncated row that
stays costs 3, a blank or repeated one must go. Wanted are the cheapest edits.

The grammar is in Chomsky normal form. Its symbols are pairs (p, q): what leads from a text that
ended in p to one that ends in q, where p and q are ``-`` (nothing yet), s, u or a. One row gives
(p, q) by an edit, an insertion gives it from nothing, and (p, q) becomes (p, r) (r, q). A cell holds
the least (cost, edits) of its span for each symbol. No two edit lists of a cell that cost the same
start alike: what one has more would be insertions, which cost. So the least lists of two spans, put
together, are the least list of both, ties of cost included.

Spans of up to PIECE rows are parsed bottom-up in numpy, all conversations of a batch at once, with
the edits packed into one 64-bit number. Longer spans join cells pairwise. As a symbol says all that
the rest of a conversation needs to know, a conversation may be cut anywhere: rows are dealt over
tasks by ranges, so a very long conversation is worked on by many, and only one cell for each of its
ranges is put together in the end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import write_once

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Rows of a span that is parsed in numpy: 8 edits and 18 insertions fit into 32 places of two bits.
PIECE, PLACES = 8, 32
#: What a text may end in, and what may follow it. The edits stand in the order of their letters.
STATES, EDITS = "-sua", "DIKR"
FOLLOWS = {0: (1, 2), 1: (2,), 2: (3,), 3: (2,)}
#: Faults of a row.
FINE, CUT, BLANK, REPEATED = range(4)
NEVER = 1 << 60

SPACE = r"' \t\n\u000b\f\r'"


class Cells:
    """Cost, packed edits and their number for each symbol of many spans: arrays (spans, 4, 4)."""

    def __init__(self, cost: np.ndarray, edits: np.ndarray, size: np.ndarray):
        self.cost, self.edits, self.size = cost, edits, size

    @classmethod
    def never(cls, *shape: int) -> Cells:
        return cls(np.full(shape, NEVER, np.int64), np.zeros(shape, np.uint64), np.zeros(shape, np.uint64))

    def __getitem__(self, at) -> Cells:
        return Cells(self.cost[at], self.edits[at], self.size[at])

    def __setitem__(self, at, other: Cells) -> None:
        self.cost[at], self.edits[at], self.size[at] = other.cost, other.edits, other.size

    def least(self, other: Cells) -> Cells:
        less = (other.cost < self.cost) | ((other.cost == self.cost) & (other.edits < self.edits))
        return Cells(*(np.where(less, b, a) for a, b in zip(vars(self).values(), vars(other).values(), strict=True)))

    def then(self, other: Cells) -> Cells:
        """Symbols of two neighbouring spans put together: (p, q) from the least (p, r) (r, q)."""
        out = None
        for r in range(4):
            x, y = self[..., :, r, None], other[..., None, r, :]
            cost = np.minimum(x.cost + y.cost, NEVER)
            both = Cells(cost, x.edits | (y.edits >> (x.size * np.uint64(2))), x.size + y.size)
            out = both if out is None else out.least(both)
        return out


def _one(symbols: dict[tuple[int, int], tuple[int, str]]) -> Cells:
    out = Cells.never(4, 4)
    for (p, q), (cost, edit) in symbols.items():
        code = EDITS.index(edit) << (2 * PLACES - 2) if edit else 0
        out[p, q] = Cells(np.int64(cost), np.uint64(code), np.uint64(len(edit)))
    return out


def nothing() -> Cells:
    """What no rows at all give: insertions, as many as help (the closure)."""
    out = _one({(p, p): (0, "") for p in range(4)})
    insert = _one({(p, q): (INSERT, "I") for p in range(4) for q in FOLLOWS[p] if q > 1})
    for _ in range(3):
        out = out.least(out.then(insert))
    return out


def single_rows() -> Cells:
    """What one row gives, by 4 * initial + fault; initials are numbered as in STATES, 0 for others.
    Insertions may come before and behind it."""
    out = Cells.never(16, 4, 4)
    for kind in range(16):
        initial, fault = divmod(kind, 4)
        symbols = {(p, p): (DELETE, "D") for p in range(4)}
        if fault in (FINE, CUT):
            extra = TRUNCATED if fault == CUT else 0
            for p in range(4):
                for q in FOLLOWS[p]:
                    if q == initial:
                        symbols[p, q] = KEEP + extra, "K"
                    elif q > 1:
                        symbols[p, q] = REROLE + extra, "R"
        out[kind] = nothing().then(_one(symbols)).then(nothing())
    return out


SINGLE = single_rows()


def parse(kinds: np.ndarray) -> Cells:
    """The cells of whole spans of at most PIECE rows, one span a line of ``kinds``."""
    wide = kinds.shape[1]
    cells = {(i, i + 1): SINGLE[kinds[:, i]] for i in range(wide)}
    for size in range(2, wide + 1):
        for i in range(wide - size + 1):
            j, best = i + size, None
            for k in range(i + 1, j):
                both = cells[i, k].then(cells[k, j])
                best = both if best is None else best.least(both)
            cells[i, j] = best
    return cells[0, wide]


#: A cell of a span of any length: 16 pairs of cost and edits.
Span = list[tuple[int, str]]


def spelt(cells: Cells) -> list[Span]:
    """Cells with their edits as text."""
    shifts = np.arange(2 * PLACES - 2, -1, -2, dtype=np.uint64)
    codes = (cells.edits.reshape(-1, 1) >> shifts) & np.uint64(3)
    letters = np.frombuffer(EDITS.encode(), np.uint8)[codes]
    letters[np.arange(PLACES) >= cells.size.reshape(-1, 1)] = 0
    text = np.ascontiguousarray(letters).view(f"S{PLACES}").ravel().astype(str).tolist()
    pairs = list(zip(cells.cost.ravel().tolist(), text, strict=True))
    return [pairs[i : i + 16] for i in range(0, len(pairs), 16)]


def join(x: Span, y: Span) -> Span:
    """Cells of two neighbouring spans put together."""
    out = []
    for p in range(4):
        for q in range(4):
            costs = [x[4 * p + r][0] + y[4 * r + q][0] for r in range(4)]
            least = min(costs)
            if least >= NEVER:
                out.append((NEVER, ""))
            else:
                out.append((least, min(x[4 * p + r][1] + y[4 * r + q][1] for r in range(4) if costs[r] == least)))
    return out


def join_all(spans: list[Span]) -> Span:
    """Cells of neighbouring spans put together in pairs, in rounds of twice the length."""
    while len(spans) > 1:
        spans = [join(*spans[i : i + 2]) if i + 1 < len(spans) else spans[i] for i in range(0, len(spans), 2)]
    return spans[0]


def parse_runs(kinds: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[Span]:
    """The cell of each run of rows. Runs are cut into pieces, pieces of one length parsed together."""
    counts = -(-(ends - starts) // PIECE)
    owner = np.repeat(np.arange(len(starts)), counts)
    low = starts[owner] + PIECE * (np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts))
    size = np.minimum(low + PIECE, ends[owner]) - low
    pieces: list[Span] = [[]] * len(owner)
    for n in np.unique(size):
        at = np.flatnonzero(size == n)
        # Many short spans look alike; each look is parsed once.
        looks, look = np.unique(kinds[low[at, None] + np.arange(n)], axis=0, return_inverse=True)
        found = spelt(parse(looks))
        for i, which in zip(at.tolist(), look.ravel().tolist(), strict=True):
            pieces[i] = found[which]
    cuts = np.concatenate([[0], np.cumsum(counts)]).tolist()
    return [join_all(pieces[a:b]) for a, b in zip(cuts, cuts[1:])]


#: What is known of a stretch of a conversation: rows, faults, forbidden neighbours, ends and turns.
STRETCH = {
    "rows": "bigint", "blank": "bigint", "duplicate": "bigint", "truncated": "bigint", "illegal": "bigint",
    "first": "int", "last": "int", "low": "bigint", "high": "bigint", "turns": "bigint",
    "costs": "array<bigint>", "edits": "array<string>",
}
KEY = {"no_conv": "boolean", "conv": "bigint"}
LEGAL = {(STATES.index(a), STATES.index(b)) for a, b in ("su", "ua", "au")}


def _stretches(rows: pa.Table, starts: np.ndarray, ends: np.ndarray) -> list[dict]:
    """Each run of rows, which come in order, as one stretch."""
    n = rows["n"].to_numpy()
    own = np.repeat(np.arange(len(n)), n)
    kind, rest = rows["kind"].to_numpy()[own], rows["rest"].to_numpy()[own]
    copies = np.ones(len(own), bool)
    copies[np.cumsum(n) - n] = False  # the first of each row's copies
    kind = np.where(copies, rest, kind)
    initial, fault = kind // 4, kind % 4
    turn, has = rows["turn"].to_numpy(), rows["has_turn"].to_numpy(zero_copy_only=False)
    after = np.concatenate([[0], np.cumsum(n)])
    cells = parse_runs(kind, after[starts], after[ends])
    bad = np.array([[(a, b) not in LEGAL for b in range(4)] for a in range(4)])
    illegal = np.concatenate([[0, 0], np.cumsum(bad[initial[:-1], initial[1:]])])
    sums = [np.concatenate([[0], np.cumsum(fault == f)]) for f in (BLANK, REPEATED, CUT)]
    new = has & np.concatenate([[True], (turn[1:] != turn[:-1]) | ~has[:-1]])
    new[starts] = has[starts]
    new, count = np.concatenate([[0], np.cumsum(new)]), np.concatenate([[0], np.cumsum(has)])
    out = []
    for s, e, cell in zip(starts.tolist(), ends.tolist(), cells, strict=True):
        a, b = int(after[s]), int(after[e])
        some = count[e] > count[s]
        out.append({
            "rows": b - a, **{k: int(c[b] - c[a]) for k, c in zip(("blank", "duplicate", "truncated"), sums, strict=True)},
            "illegal": int(illegal[b] - illegal[a + 1]), "first": int(initial[a]), "last": int(initial[b - 1]),
            "low": int(turn[e - (count[e] - count[s])]) if some else None, "high": int(turn[e - 1]) if some else None,
            "turns": int(new[e] - new[s]), "costs": [c for c, _ in cell], "edits": [t for _, t in cell],
        })
    return out


def _add(x: dict | None, y: dict) -> dict:
    """Two neighbouring stretches as one. A stretch without rows changes nothing."""
    if x is None or not y["rows"]:
        return y if x is None else x
    if not x["rows"]:
        return y
    out = {k: x[k] + y[k] for k in ("rows", "blank", "duplicate", "truncated", "illegal", "turns")}
    out["illegal"] += (x["last"], y["first"]) not in LEGAL
    out["first"], out["last"] = x["first"], y["last"]
    # Turns rise, those without one come first: two stretches share at most the turn where they meet.
    out["turns"] -= x["high"] is not None and x["high"] == y["low"]
    out["low"] = y["low"] if x["low"] is None else x["low"]
    out["high"] = x["high"] if y["high"] is None else y["high"]
    cell = join(*(list(zip(z["costs"], z["edits"], strict=True)) for z in (x, y)))
    return out | {"costs": [c for c, _ in cell], "edits": [t for _, t in cell]}


def _runs(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    keys = [rows[k].to_numpy() for k in KEY]
    new = np.ones(rows.num_rows, bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    starts = np.flatnonzero(new)
    return starts, np.append(starts[1:], rows.num_rows)


def _batch(keys: list[tuple], stretches: list[dict], part: int) -> pa.RecordBatch:
    columns = [pa.array([k[i] for k in keys], t) for i, t in ((0, pa.bool_()), (1, pa.int64()))]
    columns.append(pa.array([part] * len(keys), pa.int32()))
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "array<bigint>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
    columns += [pa.array([s[name] for s in stretches], kinds[kind]) for name, kind in STRETCH.items()]
    return pa.RecordBatch.from_arrays(columns, names=[*KEY, "part", *STRETCH])


def _ranges(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One stretch for each conversation of a task, whose rows come in order. A conversation longer
    than a batch is held as the stretch so far, not as rows; equal lengths are joined first."""
    part = TaskContext.get().partitionId()
    held: list[tuple[int, dict]] = []
    at = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        starts, ends = _runs(rows)
        keys = list(zip(*(rows[k].take(starts).to_pylist() for k in KEY), strict=True))
        found = _stretches(rows, starts, ends)
        done_keys, done = [], []
        for key, stretch in zip(keys, found, strict=True):
            if key != at:
                if held:
                    done_keys.append(at)
                    done.append(_closed(held))
                at, held = key, []
            held.append((1, stretch))
            while len(held) > 1 and held[-2][0] == held[-1][0]:
                (n, x), (_, y) = held[-2:]
                held[-2:] = [(2 * n, _add(x, y))]
        if done:
            yield _batch(done_keys, done, part)
    if held:
        yield _batch([at], [_closed(held)], part)


def _closed(held: list[tuple[int, dict]]) -> dict:
    out = None
    for _, stretch in reversed(held):
        out = stretch if out is None else _add(stretch, out)
    return out


#: Result for each conversation; audit lists the edits by their initials.
VERDICT = {
    "gaps": "bigint", "blank": "bigint", "duplicate": "bigint", "truncated": "bigint", "illegal": "bigint",
    "cost": "bigint", "audit": "string",
}


def _verdicts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The stretches of each conversation, which come in order, as one verdict."""

    def rows(found: list[tuple[tuple, dict]]) -> pa.RecordBatch:
        out = []
        for _, s in found:
            gaps = 0 if s["low"] is None else s["high"] - s["low"] + 1 - s["turns"]
            ends = (0, 4 * 0 + 3)  # from nothing to nothing, or to an assistant's row
            cost, audit = min((s["costs"][i], s["edits"][i]) for i in ends) if s["rows"] else (0, "")
            out.append((gaps, *(s[k] for k in ("blank", "duplicate", "truncated", "illegal")), cost, audit))
        columns = [pa.array([k[i] for k, _ in found], t) for i, t in ((0, pa.bool_()), (1, pa.int64()))]
        kinds = {"bigint": pa.int64(), "string": pa.string()}
        columns += [pa.array([r[i] for r in out], kinds[kind]) for i, kind in enumerate(VERDICT.values())]
        return pa.RecordBatch.from_arrays(columns, names=[*KEY, *VERDICT])

    held = None
    for batch in batches:
        found = []
        for row in batch.to_pylist():
            key = row["no_conv"], row["conv"]
            if held is not None and held[0] == key:
                held = key, _add(held[1], row)
            else:
                if held is not None:
                    found.append(held)
                held = key, row
        if found:
            yield rows(found)
    if held is not None:
        yield rows([held])


def _ordered(df: DataFrame) -> DataFrame:
    """Rows with what orders them: nulls are one space (but for the order by turn, nulls first), a
    conversation's rows go by turn, then role, then a digest of the text."""
    trimmed = f"rtrim({SPACE}, text)"
    rows = df.selectExpr(
        "conv_id is null as no_conv", "coalesce(cast(conv_id as bigint), 0L) as conv",
        "turn is not null as has_turn", "coalesce(cast(turn as bigint), 0L) as turn",
        "coalesce(cast(role as string), ' ') as role", "coalesce(cast(text as string), ' ') as text",
        "cast(n as bigint) as n",
    ).where("n > 0")
    rows = rows.selectExpr("*", "sha2(text, 256) as digest", f"{trimmed} as end")
    fault = f"case when end = '' then {BLANK} when right(end, 1) in ('.', '!', '?') then {FINE} else {CUT} end"
    return rows.selectExpr("*", f"{fault} as fault").drop("end")


ORDER = ["no_conv", "conv", "has_turn", "turn", "role", "digest"]


def inspect(df: DataFrame, every: DataFrame) -> DataFrame:
    """Faults and cheapest repair of each conversation in ``every`` (column conv_id).

    ``df`` has conv_id, turn, role, text and n, how often the row stands there; other columns play
    no part. Returned are no_conv, conv and the columns of VERDICT: gaps counts the turns missing
    between the least and the greatest, each row counts with its first fault (blank, duplicate: role
    and text came before, truncated: no mark at its end), illegal counts neighbours out of order. A
    null id is a conversation of its own; a conversation without rows has zeros and no edits, and an
    empty table none at all. Repeated rows are duplicates; rows of one turn go by role and text.
    """
    rows = _ordered(df).groupBy(*ORDER, "fault").agg(F.sum("n").alias("n"))  # copies meet before the shuffle
    rows = write_once(rows, "rows")
    same = ["no_conv", "conv", "role", "digest"]
    seen = rows.where(f"fault <> {BLANK}").groupBy(*same).agg(
        F.expr("min(struct(has_turn, turn)) as first"), F.expr("count(*) as places")
    )
    # Both sides are read from files, so adaptive execution can split a text that one conversation repeats.
    seen = write_once(seen.where("places > 1").drop("places"), "repeated")
    initial = "cast(position(left(role, 1) in 'sua') as int)"
    kinds = rows.join(seen, same, "left").selectExpr(
        *ORDER, "n", f"if(role = '', 0, {initial}) as initial", "fault",
        f"if(fault <> {BLANK} and first is not null and struct(has_turn, turn) > first, {REPEATED}, fault) as found",
    ).selectExpr(
        *ORDER, "n", "4 * initial + found as kind", f"4 * initial + if(fault = {BLANK}, {BLANK}, {REPEATED}) as rest"
    )
    ranges = kinds.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    fields = KEY | {"part": "int"} | STRETCH
    schema = ", ".join(f"{name} {kind}" for name, kind in fields.items())
    stretches = ranges.select(*KEY, "has_turn", "turn", "n", "kind", "rest").mapInArrow(_ranges, schema)
    none = {"rows": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "turns": 0, "part": -1}
    empty = every.selectExpr("conv_id is null as no_conv", "coalesce(cast(conv_id as bigint), 0L) as conv").distinct()
    empty = empty.selectExpr(*KEY, *(f"cast({none.get(k, 'null')} as {t}) as {k}" for k, t in fields.items() if k not in KEY))
    every_one = stretches.unionByName(empty).repartition(*KEY).sortWithinPartitions(*KEY, "part")
    return every_one.mapInArrow(_verdicts, ", ".join(f"{name} {kind}" for name, kind in (KEY | VERDICT).items()))


REPAIRED = {
    "no_conv": "boolean", "conv": "bigint", "position": "bigint", "edit": "string", "turn": "bigint",
    "role": "string", "text": "string",
}


def _repaired(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows left of each conversation. Its verdict comes first and its rows in order."""
    at, audit, place, state, position = None, "", 0, "-", 0
    next_role = {"-": "user", "s": "user", "a": "user", "u": "assistant"}
    for batch in batches:
        out: list[tuple] = []  # index of the row or None, key, position, edit, role

        def insert():
            nonlocal place, state, position
            while audit[place : place + 1] == "I":
                role = next_role[state]
                out.append((None, at, position, "I", role))
                place, state, position = place + 1, role[0], position + 1

        columns = [batch.column(c).to_pylist() for c in ("no_conv", "conv", "is_row", "audit", "role", "n")]
        for i, (no_conv, conv, is_row, edits, role, n) in enumerate(zip(*columns, strict=True)):
            if not is_row:
                at, audit, place, state, position = (no_conv, conv), edits, 0, "-", 0
                continue
            for _ in range(n):
                insert()
                edit = audit[place]
                place += 1
                if edit != "D":
                    role_now = role if edit == "K" else next_role[state]
                    out.append((i, at, position, edit, role_now))
                    state, position = role_now[0], position + 1
            insert()
        if out:
            index = pa.array([o[0] for o in out], pa.int64())
            turn = batch.column("turn").take(index)
            has = batch.column("has_turn").take(index).fill_null(False)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([o[1][0] for o in out], pa.bool_()), pa.array([o[1][1] for o in out], pa.int64()),
                    pa.array([o[2] for o in out], pa.int64()), pa.array([o[3] for o in out], pa.string()),
                    pa.compute.if_else(has, turn, pa.scalar(None, pa.int64())), pa.array([o[4] for o in out], pa.string()),
                    batch.column("text").take(index).fill_null(""),
                ],
                names=[*REPAIRED],
            )


def _hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the rows of each conversation, which come in order."""

    def rows(found):
        arrays = [pa.array([k[0] for k, _ in found], pa.bool_()), pa.array([k[1] for k, _ in found], pa.int64())]
        return pa.RecordBatch.from_arrays([*arrays, pa.array([s for _, s in found], pa.string())], names=[*KEY, "sha"])

    at, sha = None, hashlib.sha256()
    for batch in batches:
        found = []
        for no_conv, conv, role, text in zip(*(batch.column(c).to_pylist() for c in (*KEY, "role", "text")), strict=True):
            if (no_conv, conv) != at:
                if at is not None:
                    found.append((at, sha.hexdigest()))
                at, sha = (no_conv, conv), hashlib.sha256(f"{role}:{text}".encode())
            else:
                sha.update(f"\n{role}:{text}".encode())
        if found:
            yield rows(found)
    if at is not None:
        yield rows([(at, sha.hexdigest())])


def _audited(df: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Each conversation's verdict and behind it its rows, in order."""
    rows = _ordered(df).selectExpr(*ORDER, "true as is_row", "text", "n", "cast(null as string) as audit")
    marks = verdicts.selectExpr(
        *KEY, "false as has_turn", "0L as turn", "'' as role", "'' as digest", "false as is_row",
        "'' as text", "1L as n", "audit",
    )
    return rows.unionByName(marks).repartition(*KEY).sortWithinPartitions(*KEY, "is_row", *ORDER[2:])


def repair(df: DataFrame, verdicts: DataFrame) -> DataFrame:
    """The rows of each conversation after the edits of its verdict: conv_id, position, edit (K, R or
    I), turn (null for inserted rows), role and text. Deleted rows are left out. A task reads a
    conversation row by row, so one of any length takes no more memory than its list of edits."""
    schema = ", ".join(f"{name} {kind}" for name, kind in REPAIRED.items())
    rows = _audited(df, verdicts).mapInArrow(_repaired, schema)
    return rows.selectExpr("if(no_conv, null, conv) as conv_id", "position", "edit", "turn", "role", "text")


def digests(df: DataFrame, verdicts: DataFrame) -> DataFrame:
    """SHA-256 over ``role:text`` of the repaired rows, joined by line breaks; conversations that have
    none left are missing. The digest of a conversation is taken in order, by one task, as it must be."""
    return _audited(df, verdicts).mapInArrow(lambda b: _hashed(_repaired(b)), "no_conv boolean, conv bigint, sha string")


def damage(conversations: DataFrame) -> DataFrame:
    """Rows with damage by crc32 of ``conv_id:turn`` modulo 20: 0 drops the row, 1 empties its text, 2
    takes its end marks, 3 repeats it, 4 gives it the role user. Nulls are one space."""
    rows = conversations.selectExpr(
        "conv_id", "turn", "coalesce(cast(role as string), ' ') as role", "coalesce(cast(text as string), ' ') as text",
        "crc32(coalesce(cast(conv_id as string), ' ') || ':' || coalesce(cast(turn as string), ' ')) % 20 as kind",
    )
    return rows.selectExpr(
        "conv_id", "turn", "if(kind = 4, 'user', role) as role",
        "case kind when 1 then '' when 2 then translate(text, '.!?', '') else text end as text",
        "case kind when 0 then 0 when 3 then 2 else 1 end as n",
    )


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """Damage, verdicts, and a digest of each conversation's repaired rows."""
    rows = damage(conversations)
    verdicts = write_once(inspect(rows, conversations), "verdicts")
    found = verdicts.join(digests(rows, verdicts), [*KEY], "left")
    return found.selectExpr(
        "if(no_conv, null, conv) as conv_id", *VERDICT, "coalesce(sha, sha2('', 256)) as repaired_sha256"
    )

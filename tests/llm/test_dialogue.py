from __future__ import annotations

import hashlib
import itertools
import random
import zlib
from functools import lru_cache

import pytest

from orderloom.llm import dialogue

SMALL = "/root/testdata/sf0.001"
FOLLOWS = {"-": "su", "s": "u", "u": "a", "a": "u"}
NAMES = {"u": "user", "a": "assistant"}


def faults(rows):
    """The first fault of each row (role, text): b, d, t or nothing."""
    out, seen = [], set()
    for role, text in rows:
        end = text.strip(" \t\n\v\f\r")
        fault = "b" if not end else "d" if (role, text) in seen else "" if end[-1] in ".!?" else "t"
        seen.add((role, text))
        out.append(fault)
    return out


def cheapest(rows):
    """Least (cost, audit) by trying every edit from left to right."""
    found = faults(rows)

    @lru_cache(None)
    def best(i, state, inserted):
        options = []
        if i == len(rows) and state in "-a":
            options.append((0, ""))
        if inserted < 3:
            for role in "ua":
                if role in FOLLOWS[state]:
                    cost, audit = best(i, role, inserted + 1)
                    options.append((cost + 3, "I" + audit))
        if i < len(rows):
            cost, audit = best(i + 1, state, 0)
            options.append((cost + 4, "D" + audit))
            if found[i] not in ("b", "d"):
                extra = 3 if found[i] == "t" else 0
                for role in FOLLOWS[state]:
                    kept = rows[i][0][:1] == role
                    if kept or role != "s":
                        cost, audit = best(i + 1, role, 0)
                        options.append((cost + extra + (0 if kept else 3), ("K" if kept else "R") + audit))
        return min(options, default=(10**6, ""))

    return best(0, "-", 0)


def repaired(rows, audit):
    out, left, state = [], iter(rows), "-"
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(left)
        if edit == "D":
            continue
        if edit != "K":
            role = NAMES["a" if state == "u" else "u"]
        out.append((role, text))
        state = role[0]
    return out


def plain(table):
    """The query's result by definition, from rows (conv_id, turn, role, text)."""
    convs = {}
    space = lambda v: " " if v is None else v
    for conv, turn, role, text in table:
        rows, role, text = convs.setdefault(conv, []), space(role), space(text)
        kind = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        role, text = "user" if kind == 4 else role, "" if kind == 1 else text
        if kind == 2:
            text = text.translate(str.maketrans("", "", ".!?"))
        rows += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = []
    for conv, rows in convs.items():
        key = lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).hexdigest())
        rows.sort(key=key)
        pairs = [(role, text) for _, role, text in rows]
        turns = {t for t, _, _ in rows if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        found = faults(pairs)
        illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for (a, _), (b, _) in itertools.pairwise(pairs))
        cost, audit = cheapest(tuple(pairs)) if pairs else (0, "")
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired(pairs, audit)).encode()).hexdigest()
        out.append((conv, gaps, found.count("b"), found.count("d"), found.count("t"), illegal, cost, audit, sha))
    return sorted(out, key=str)


def found(df):
    names = ["conv_id", *dialogue.VERDICT, "repaired_sha256"]
    return sorted((tuple(r) for r in df.select(*names).collect()), key=str)


@pytest.fixture
def talk(spark):
    def build(rows):
        wide = [(*r, 1, "x") for r in rows]
        return spark.createDataFrame(wide, "conv_id long, turn long, role string, text string, n int, kind string")

    return build


def test_query_equals_plain_version(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    from orderloom.llm import queries

    assert found(queries.op11_dialogue_repair(spark, SMALL)) == plain(rows)


def test_random_conversations(talk):
    rng, rows = random.Random(3), []
    for conv in range(300):
        for _ in range(rng.choice([1, 2, 3, 5, 9, 17, 40])):
            text = rng.choice(["", " \n", "Yes.", "no", "What?", f"{rng.random()}!", "tail. \t", "cut , "])
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", "s", None])
            rows.append((conv if conv else None, rng.choice([None, *range(60)]), role, rng.choice([text, text, None])))
    assert found(dialogue.repair_conversations(talk(rows))) == plain(rows)


def test_long_conversation_over_many_tasks(spark, talk):
    """One conversation with most rows, one text repeated through it, exact copies in thousands."""
    rng = random.Random(4)
    rows = [(1, i, rng.choice(["user", "assistant", "system"]), rng.choice(["same.", f"{i}!", "", f"{i}"])) for i in range(3000)]
    rows += [(1, 7, "user", "copy.")] * 2000 + [(2, 0, "user", "a."), (2, 1, "assistant", "b.")]
    table = talk(rows).repartition(16)
    every = table.select("conv_id").distinct()
    got = {r.conv: r for r in dialogue.inspect(table, every).collect()}
    big = sorted(((t, r, x) for c, t, r, x in rows if c == 1), key=lambda r: (r[0], r[1].encode(), hashlib.sha256(r[2].encode()).hexdigest()))
    pairs = [(r, x) for _, r, x in big]
    kinds = [4 * ("-sua".index(r[0]) if r[0] in "sua" else 0) + {"": 0, "t": 1, "b": 2, "d": 3}[f] for (r, _), f in zip(pairs, faults(pairs))]
    # Row by row from the left, without spans.
    state = {0: (0, "")}
    single = [dialogue.spelt(dialogue.SINGLE[k][None])[0] for k in range(16)]
    for k in kinds:
        step = [(q, c + single[k][4 * p + q][0], a + single[k][4 * p + q][1]) for p, (c, a) in state.items() for q in range(4)]
        state = {}
        for q, cost, audit in step:
            if cost < dialogue.NEVER:
                state[q] = min(state.get(q, (dialogue.NEVER, "")), (cost, audit))
    assert (got[1].cost, got[1].audit) == min(state[q] for q in (0, 3) if q in state)
    assert (got[2].cost, got[2].audit, got[2].illegal) == (0, "KK", 0)
    assert got[1].gaps == 0 and got[1].blank == faults(pairs).count("b") and got[1].duplicate == faults(pairs).count("d")


def test_repaired_rows(talk):
    rows = [(1, 0, "assistant", "Hello."), (1, 1, "assistant", "Hello."), (1, 2, "user", "so"), (1, None, "system", "Be kind.")]
    table = talk(rows)
    verdicts = dialogue.inspect(table, table)
    assert [(r.cost, r.audit) for r in verdicts.collect()] == [cheapest([("system", "Be kind."), *((r, t) for _, _, r, t in rows[:3])])]
    kept = dialogue.repair(table, verdicts).orderBy("position").collect()
    assert kept[0].role == "system" and [r.role for r in kept[1:]] == ["user", "assistant"] * ((len(kept) - 1) // 2)


def test_empty_and_dropped(spark, talk):
    assert dialogue.repair_conversations(talk([])).count() == 0
    none = hashlib.sha256(b"").hexdigest()
    dropped = next(i for i in range(100) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    assert found(dialogue.repair_conversations(talk([(dropped, 0, "user", "Hi.")]))) == [(dropped, 0, 0, 0, 0, 0, 0, "", none)]
    big = "word " * 200_000 + "end."
    rows = [(None, None, None, None), (5, 1, "user", big), (5, 2, "assistant", big)]
    assert found(dialogue.repair_conversations(talk(rows))) == plain(rows)

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from pulsegrid.llm import repair

SF = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def faults(rows):
    """The first fault of each row, in order."""
    seen, out = set(), []
    for _, _, role, text in rows:
        solid = text.strip(SPACE)
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "" if solid[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append(fault)
    return out


def cheapest(rows, found):
    """Least (cost, audit, lines) over all edits, row by row from left to right."""
    follow = lambda before, x: (before, x) in {("", "s"), ("", "u"), ("s", "u"), ("a", "u"), ("u", "a")}
    states = {"": (0, "", ())}

    def closed(states):
        for _ in range(2):
            for before, (cost, audit, lines) in list(states.items()):
                for x, line in (("u", "user:"), ("a", "assistant:")):
                    if follow(before, x):
                        new = (cost + 5, audit + "I", (*lines, line))
                        states[x] = min(states.get(x, new), new)
        return states

    states = closed(states)
    for (_, _, role, text), fault in zip(rows, found):
        after = {}
        for before, (cost, audit, lines) in states.items():
            options = [(before, (cost + 2, audit + "D", lines))]
            if fault not in ("blank", "duplicate"):
                extra = 5 if fault else 0
                options += [(x, (cost + 1 + extra, audit + "R", (*lines, f"{name}:{text}"))) for x, name in (("u", "user"), ("a", "assistant")) if follow(before, x)]
                if follow(before, role[:1]):
                    options.append((role[:1], (cost + extra, audit + "K", (*lines, f"{role}:{text}"))))
            for state, new in options:
                after[state] = min(after.get(state, new), new)
        states = closed(after)
    return min(states[x] for x in ("", "a") if x in states)


def brute(rows):
    convs = defaultdict(list)
    for row in damage(rows):
        convs[row[0]].append(row)
    out = {}
    for conv in {r[0] for r in rows}:
        held = sorted(convs[conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        found = faults(held)
        turns = [r[1] for r in held if r[1] is not None]
        cost, audit, lines = cheapest(held, found) if held else (0, "", ())
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *[found.count(x) for x in ("blank", "duplicate", "truncated")],
            sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(held)),
            cost,
            audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def ours(found):
    rows = found.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r[c] for c in COLUMNS) for r in rows}


def test_query_equals_brute_force(spark):
    from pulsegrid.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert ours(QUERIES["op11_conversation_repair"](spark, SF)) == brute(rows)


def odd_rows(n, seed):
    draw = random.Random(seed)
    roles = [None, "", "system", "user", "assistant", "tool", "User", "s"]
    texts = [None, "", " \n\t", "Yes.", "No", "Why? ", "É ü!", "x" * 70 + "a.", "x" * 70 + "b.", "ends here?\x0b", "...", "\x1f"]
    return [
        (draw.choice([None, *range(n // 8)]), draw.choice([None, *range(9), *range(9), -3]), draw.choice(roles + roles[2:5] * 3), draw.choice(texts + ["Fine.", "So."] * 6))
        for _ in range(n)
    ]


@pytest.mark.parametrize("block,fan", [(1024, 64), (3, 2)])
def test_odd_rows_ties_and_nulls(spark, monkeypatch, block, fan):
    """The same whether a conversation is one span or is joined in rounds."""
    monkeypatch.setattr(repair, "BLOCK", block)
    monkeypatch.setattr(repair, "FAN", fan)
    rows = odd_rows(900, block)
    assert ours(repair.repair_conversations(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_sql_equals_brute_force(seed):
    import duckdb

    rows, con = odd_rows(900, seed), duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    assert {r[0]: r[1:] for r in con.execute(repair.oracle()).fetchall()} == brute(rows)


def test_one_long_conversation_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(repair, "BLOCK", 16)
    monkeypatch.setattr(repair, "FAN", 4)
    draw = random.Random(5)
    rows = [(7, i, draw.choice(["user", "assistant", "assistant", "system"]), f"say {i % 50}{draw.choice(['.', '.', ''])}") for i in range(700)]
    rows += [(7, 3, "user", "the same.")] * 40 + [(8, 0, "user", "a."), (8, 1, "assistant", "b.")]
    spark.conf.set("spark.pulsegrid.maxGroupRows", "100")
    try:
        assert ours(repair.repair_conversations(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
    finally:
        spark.conf.unset("spark.pulsegrid.maxGroupRows")


@pytest.mark.parametrize("length", [0, 1, 2, 3, 5, 6])
def test_cells_equal_a_search_over_all_edits(length):
    """Every way to delete, keep, rerole and insert (up to two turns in each gap) is tried."""
    draw = random.Random(length)
    gaps = ["", "u", "a", "ua", "au"]
    for _ in range(4 if length > 4 else 12):
        symbols = "".join(draw.choice("suaxdSUAX") for _ in range(length))
        states = {("", 0, "")}
        for i in range(length + 1):
            states = {(o + g, c + 5 * len(g), a + "I" * len(g)) for o, c, a in states for g in gaps}
            if i < length:
                s = symbols[i]
                extra = 5 if s.isupper() else 0
                acts = [("", 2, "D")] + ([] if s == "d" else [("u", 1 + extra, "R"), ("a", 1 + extra, "R"), (s.lower(), extra, "K")])
                states = {(o + x, c + k, a + e) for o, c, a in states for x, k, e in acts}
            states = {x for x in states if re.fullmatch("(s?(ua)*u?)?", x[0])}
        want = min((c, a) for o, c, a in states if re.fullmatch("(s?(ua)+)?", o))
        assert repair.best(repair.cell(symbols)) == want


def test_repaired_turns_and_other_key_types(spark):
    rows = [("a", 0, "user", "Hi."), ("a", 1, "user", "And?"), ("b", 0, "assistant", "Well."), ("b", 1, "user", "cut")]
    made = repair.Repair(spark.createDataFrame(rows, "conv_id string, turn long, role string, text string").selectExpr("*", "1 AS times"))
    got = [tuple(r) for r in made.repaired().orderBy("conv_id", "turn").collect()]
    assert got == [("a", 0, "user", "Hi."), ("a", 1, "assistant", "And?")]


def test_empty_table_and_extra_columns(spark):
    assert repair.repair_conversations(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, 0, "user", "A.", "x", 9), (1, 1, "assistant", "B.", "y", 9)]
    found = repair.repair_conversations(spark.createDataFrame(rows, SCHEMA + ", digest string, at int"))
    assert ours(found) == brute([r[:4] for r in rows])

"""Conversation repair by weighted interval parsing.

A conversation is well formed if its role initials spell ``(s?(ua)+)?``. Rows may be kept (0), given another
role (1), deleted (2) or preceded and followed by inserted empty turns (5); an undeleted truncated row
adds 5, blank and duplicate rows must go. Wanted are the cheapest edits, and among those the ASCII-least
sequence of their initials.

*Grammar.* A nonterminal (p, q) stands for spans that lead from p to q, where p and q tell what the output
ends with: nothing, s, u or a. Binary rules (p, q) -> (p, r)(r, q) join neighbouring spans, terminal rules
rewrite one row, the unary *insertion closure* (p, q) -> edits of a span with inserted turns around it;
this is Chomsky normal form with S = (nothing, nothing) | (nothing, a).

*Cells.* The cell of a span holds for each nonterminal the least (cost, audit). Every binary rule is there for
every r, so the least over one split of a span equals the least over all splits, and a span is built
from two halves: spans of 1, 2, 4, ... rows, bottom-up. (Least audits may be joined from least parts: of two
audits of one span and cost, none is the beginning of the other.) Spans with the same row symbols share
their cell.

*Spark.* Texts do not take part: a row is reduced to role, flags and a digest, equal rows
are counted before any shuffle, positions come from ``plans.ordered`` (safe for a conversation of any
size), a task parses blocks of ``BLOCK`` rows, and rounds that join up to ``FAN`` neighbouring spans of a
conversation lead to its cell. Only texts of undeleted rows are moved once, for the hash: SHA-256 reads
a conversation's output in order, as a stream that holds one row at a time.

Defined cases: nulls in role and text become one space (such a text is blank), a null conv_id is a conversation of
its own; rows of one turn are ordered by role, then by the first 64 characters of the text, then by its
digest; equal rows are neighbours, the first of them counts, the others are duplicates; conversations of which
no row is left have zeros, an empty audit and the hash of the empty text; an empty table gives no row; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from pulsegrid.llm.common import written
from pulsegrid.plans.ordered import null_safe_join, with_ordinal

#: Rows that one task parses as a span before spans of a conversation are joined in rounds, and spans joined in a round.
BLOCK = 1024
FAN = 64
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
TRUNCATED = 5
#: What the output ends with: nothing, s, u, a; the initials that may follow; where an output may end.
STATES = range(4)
STEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
ENDS = (0, 3)
INSERTED = {"u": "user", "a": "assistant"}
#: Symbols of rows: must go; else the role's initial (x: none of s, u, a), in capitals if truncated.
GONE = "d"
_SOLID = r"[^\x20\x09-\x0D]"

Cell = tuple  # of 16 (cost, audit) or None, at 4 p + q


def _least(a, b):
    return b if a is None or (b is not None and b < a) else a


def join(left: Cell, right: Cell) -> Cell:
    """Binary rules over two neighbouring spans."""
    made = [None] * 16
    for p in STATES:
        for r in STATES:
            x = left[4 * p + r]
            if x is None:
                continue
            for q in STATES:
                y = right[4 * r + q]
                if y is not None:
                    made[4 * p + q] = _least(made[4 * p + q], (x[0] + y[0], x[1] + y[1]))
    return tuple(made)


def _empty() -> Cell:
    """The empty span and its insertions; more than two in a row only come back to where one was."""
    made = [None] * 16
    for p in STATES:
        made[5 * p] = (0, "")
    for _ in range(2):
        for p in STATES:
            for r in STATES:
                for symbol in INSERTED:
                    q = STEPS.get((r, symbol))
                    x = made[4 * p + r]
                    if q is not None and x is not None:
                        made[4 * p + q] = _least(made[4 * p + q], (x[0] + COST[INSERT], x[1] + INSERT))
    return tuple(made)


EMPTY = _empty()


@lru_cache(maxsize=64)
def _row(symbol: str) -> Cell:
    """Terminal rules of one row, closed under insertion on both sides."""
    made = [None] * 16
    extra = TRUNCATED if symbol.isupper() else 0
    for p in STATES:
        made[5 * p] = (COST[DELETE], DELETE)
        if symbol != GONE:
            for s in INSERTED:
                if (q := STEPS.get((p, s))) is not None:
                    made[4 * p + q] = _least(made[4 * p + q], (COST[REROLE] + extra, REROLE))
            if (q := STEPS.get((p, symbol.lower()))) is not None:
                made[4 * p + q] = _least(made[4 * p + q], (COST[KEEP] + extra, KEEP))
    return join(join(EMPTY, tuple(made)), EMPTY)


def cell(symbols: str) -> Cell:
    """The cell of a span of rows, from its two halves (of which the left one has a power of two)."""
    return _short(symbols) if len(symbols) <= 16 else _halves(symbols)


@lru_cache(maxsize=1 << 15)
def _short(symbols: str) -> Cell:
    return _halves(symbols)


def _halves(symbols: str) -> Cell:
    if not symbols:
        return EMPTY
    if len(symbols) == 1:
        return _row(symbols)
    half = 1 << ((len(symbols) - 1).bit_length() - 1)
    return join(cell(symbols[:half]), cell(symbols[half:]))


def best(found: Cell) -> tuple[int, str]:
    """Least (cost, audit) of a whole conversation."""
    return min(found[q] for q in ENDS if found[q] is not None)


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after the damage that crc32(conv_id:turn) chooses (nulls: one space).

    Of twenty remainders 0 drops the row, 1 empties its text, 2 takes out . ! ?, 3 repeats it, 4 makes it the user's.
    """
    spelled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    key = F.concat_ws(":", spelled("conv_id"), spelled("turn"))
    kind = F.crc32(key.cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(spelled("text"), "[.!?]", "")).otherwise(spelled("text"))
    role = F.when(kind == 4, "user").otherwise(spelled("role"))
    return rows.where(kind != 0).select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        text.alias("text"),
        F.when(kind == 3, 2).otherwise(1).alias("times"),
    )


_ORDER = ("turn", "role", "begins", "digest")


def _digest() -> Column:
    return F.unhex(F.sha2("text", 256))


def _reduced(rows: DataFrame) -> DataFrame:
    """Rows without texts, equal ones counted: conv_id, turn, role, begins, digest, blank, truncated, times."""
    last = F.substring(F.rtrim("text", F.lit(" \t\n\x0b\x0c\r")), -1, 1)
    return (
        rows.select(
            "conv_id",
            "turn",
            "role",
            F.substring("text", 1, 64).alias("begins"),
            _digest().alias("digest"),
            (last == "").alias("blank"),
            ((last != "") & ~last.isin(".", "!", "?")).alias("truncated"),
            "times",
        )
        .groupBy("conv_id", *_ORDER, "blank", "truncated")
        .agg(F.sum("times").alias("times"))
    )


def _judged(rows: DataFrame) -> DataFrame:
    """Reduced rows in their places (``at``, ``block``) with ``symbol``: written, as it is read three times."""
    placed = written(with_ordinal(_reduced(rows), ["conv_id"], [F.col("turn").asc_nulls_first(), *_ORDER[1:]], "at"), "placed")
    first = placed.groupBy("conv_id", "role", "digest").agg(F.min("at").alias("at")).select("conv_id", "at", F.lit(True).alias("first"))
    joined = null_safe_join(placed, first, ["conv_id", "at"], "left")
    repeated = ~F.col("blank") & F.col("first").isNull()
    initial = F.substring("role", 1, 1)
    symbol = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    symbol = F.when(F.col("truncated"), F.upper(symbol)).otherwise(symbol)
    judged = joined.select(
        "conv_id",
        "at",
        F.floor(F.col("at") / BLOCK).alias("block"),
        *_ORDER,
        initial.alias("initial"),
        "times",
        F.when(F.col("blank"), F.col("times")).otherwise(0).alias("blank"),
        # of equal rows the first is judged by its place, the others are duplicates
        F.when(F.col("blank"), 0).when(repeated, F.col("times")).otherwise(F.col("times") - 1).alias("duplicate"),
        F.when(~F.col("blank") & ~repeated & F.col("truncated"), 1).otherwise(0).alias("truncated"),
        F.when(F.col("blank") | repeated, GONE).otherwise(symbol).alias("symbol"),
    )
    return written(judged, "judged")


_CELLS = "block long, first string, last string, illegal long, costs array<long>, audits array<string>"
_PAIRS = frozenset(("su", "ua", "au"))


def _spans(batches: Iterator[pa.RecordBatch], key: int = 2) -> Iterator[list[tuple]]:
    """Rows of one (conv_id, block) after another; rows come sorted."""
    held, now = [], None
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and row[:key] != now:
                yield held
                held = []
            now = row[:key]
            held.append(row)
    if held:
        yield held


def _packed(made: list[tuple], conv: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*made)) or [()] * 7
    kinds = (conv, pa.int64(), pa.string(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()))
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=["conv_id", *(f.split()[0] for f in _CELLS.split(", "))])


def _flat(found: Cell) -> tuple[list, list]:
    return [x and x[0] for x in found], [x and x[1] for x in found]


def _parse_blocks(batches: Iterator[pa.RecordBatch], conv: pa.DataType) -> Iterator[pa.RecordBatch]:
    """conv_id, block, at, initial, symbol, times of sorted rows: one row of cells for each block."""
    made = []
    for rows in _spans(batches):
        illegal, before, spans, run = 0, None, [], []
        for _, _, _, initial, symbol, times in rows:
            illegal += before is not None and before + initial not in _PAIRS
            illegal += times - 1  # no initial may follow itself
            before = initial
            run.append(symbol)
            if times > 1:  # the others of equal rows go: one more letter of every audit each
                whole = cell("".join(run))
                spans.append(tuple(x and (x[0] + COST[DELETE] * (times - 1), x[1] + DELETE * (times - 1)) for x in whole))
                run = []
        if run or not spans:
            spans.append(cell("".join(run)))
        while len(spans) > 1:
            spans = [join(*spans[i : i + 2]) if i + 1 < len(spans) else spans[i] for i in range(0, len(spans), 2)]
        # An insertion behind the last equal row may stand before its deletions' letters: close once more.
        made.append((*rows[0][:2], rows[0][3], before, illegal, *_flat(join(spans[0], EMPTY))))
        if len(made) >= 2000:
            yield _packed(made, conv)
            made = []
    yield _packed(made, conv)


def _parse_rounds(batches: Iterator[pa.RecordBatch], conv: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Joins the neighbouring spans of (conv_id, block); columns: conv_id, block, child, then the cells'."""
    made = []
    for rows in _spans(batches):
        spans = [tuple(None if c is None else (c, a) for c, a in zip(r[6], r[7])) for r in rows]
        illegal = sum(r[5] for r in rows) + sum(x[4] + y[3] not in _PAIRS for x, y in zip(rows, rows[1:]))
        while len(spans) > 1:
            spans = [join(*spans[i : i + 2]) if i + 1 < len(spans) else spans[i] for i in range(0, len(spans), 2)]
        made.append((*rows[0][:2], rows[0][3], rows[-1][4], illegal, *_flat(spans[0])))
        yield _packed(made, conv)
        made = []
    yield _packed(made, conv)


def _parsed(judged: DataFrame) -> DataFrame:
    """One row of cells for each conversation."""
    conv = judged.schema["conv_id"].dataType
    schema, kind = f"conv_id {conv.simpleString()}, {_CELLS}", to_arrow_type(conv)
    rows = judged.select("conv_id", "block", "at", "initial", "symbol", "times")
    ready = rows.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "at")
    found = written(ready.mapInArrow(lambda batches: _parse_blocks(batches, kind), schema), "cells")
    while (found.agg(F.max("block")).first()[0] or 0) > 0:
        parent = F.floor(F.col("block") / FAN).alias("block")
        ready = found.select("conv_id", parent, F.col("block").alias("child"), *found.columns[2:])
        ready = ready.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "child")
        found = written(ready.mapInArrow(lambda batches: _parse_rounds(batches, kind), schema), "cells")
    return found


def _chosen(batches: Iterator[pa.RecordBatch], conv: pa.DataType) -> Iterator[pa.RecordBatch]:
    """conv_id, illegal, cost, audit of each conversation."""
    for batch in batches:
        convs, _, _, _, illegal, costs, audits = (c.to_pylist() for c in batch.columns)
        picked = [best(tuple(None if c is None else (c, a) for c, a in zip(*x))) for x in zip(costs, audits)]
        columns = [pa.array(convs, conv), pa.array(illegal, pa.int64()), pa.array([x[0] for x in picked], pa.int64()), pa.array([x[1] for x in picked], pa.string())]
        yield pa.record_batch(columns, names=["conv_id", "illegal", "cost", "audit"])


#: Where a line stands among those of its row: insertions before it, the row's new role, its text, insertions after it.
_ROLE_AT, _TEXT_AT = 1 << 30, (1 << 30) + 1


def _decided(batches: Iterator[pa.RecordBatch], conv: pa.DataType) -> Iterator[pa.RecordBatch]:
    """New roles and insertions of each conversation, from its audit (a row before the others) and its reduced rows.

    Columns in: conv_id, kind (0: audit, 1: row), at, audit, turn, role, begins, digest, times; out: conv_id, turn, role,
    begins, digest, sub, new. A conversation's rows are read as a stream.
    """
    names = ["conv_id", *_ORDER, "sub", "new"]
    kinds = [conv, pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string()]
    made: list[tuple] = []

    def packed() -> pa.RecordBatch:
        columns = list(zip(*made)) or [()] * len(kinds)
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    audit, letter_at, item, odd, row = "", 0, 0, 0, None

    def initial() -> str:
        nonlocal item
        item += 1
        return "s" if odd and item == 1 else "ua"[(item - 1 - odd) % 2]

    def inserted(sub: int) -> None:
        nonlocal letter_at
        while letter_at < len(audit) and audit[letter_at] == INSERT:
            made.append((row[0], *row[4:8], sub, INSERTED[initial()]))
            letter_at, sub = letter_at + 1, sub + 1

    for batch in batches:
        for now in zip(*(c.to_pylist() for c in batch.columns)):
            if now[1] == 0:
                if row is not None:
                    inserted(_TEXT_AT + 1)
                audit, letter_at, item, row = now[3], 0, 0, None
                odd = (len(audit) - audit.count(DELETE)) % 2
                continue
            row = now
            inserted(0)
            letter = audit[letter_at]
            if letter != DELETE:
                new = initial()
                made.append((row[0], *row[4:8], _ROLE_AT, row[5] if letter == KEEP else INSERTED[new]))
            letter_at += 1
            for copy in range(1, row[8]):  # equal rows are deleted; an insertion may stand between them
                inserted(_TEXT_AT + 8 * copy)
                letter_at += 1
            if len(made) >= 4000:
                yield packed()
                made = []
    if row is not None:
        inserted(_TEXT_AT + 1)
    yield packed()


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, role, text bytes) of the repaired turns, from sorted rows: conv_id, sub, new, text."""
    role = None
    for batch in batches:
        for conv, sub, new, text in zip(*(c.to_pylist() for c in batch.columns)):
            if sub == _ROLE_AT:
                role = new
            elif sub != _TEXT_AT:
                role = None
                yield conv, new, b""
            elif role is not None:  # the text of the row whose role came before; equal rows have none
                yield conv, role, text
                role = None


def _hashed(batches: Iterator[pa.RecordBatch], conv: pa.DataType) -> Iterator[pa.RecordBatch]:
    found, state, now = [], None, None
    for at, role, text in _turns(batches):
        if state is None or at != now:
            if state is not None:
                found.append((now, state.hexdigest()))
            state, now = hashlib.sha256(), at
        else:
            state.update(b"\n")
        state.update(role.encode() + b":" + text)
        if len(found) >= 4000:
            yield pa.record_batch([pa.array([x[0] for x in found], conv), pa.array([x[1] for x in found], pa.string())], names=["conv_id", "repaired_sha256"])
            found = []
    if state is not None:
        found.append((now, state.hexdigest()))
    yield pa.record_batch([pa.array([x[0] for x in found], conv), pa.array([x[1] for x in found], pa.string())], names=["conv_id", "repaired_sha256"])


def _numbered(batches: Iterator[pa.RecordBatch], conv: pa.DataType) -> Iterator[pa.RecordBatch]:
    made, now, n = [], object(), 0

    def packed() -> pa.RecordBatch:
        columns = list(zip(*made)) or [()] * 4
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, (conv, pa.int64(), pa.string(), pa.string()))], names=["conv_id", "turn", "role", "text"])

    for at, role, text in _turns(batches):
        n = n + 1 if at == now else 0
        now = at
        made.append((at, n, role, text.decode("utf-8", "replace")))
        if len(made) >= 1000:
            yield packed()
            made = []
    yield packed()


class Repair:
    """The parse of a table of conversations (conv_id, turn, role, text, and how many ``times`` each row is there)."""

    def __init__(self, rows: DataFrame):
        self.rows = rows
        self.conv = rows.schema["conv_id"].dataType
        self.judged = _judged(rows)
        self.chosen = written(_parsed(self.judged).mapInArrow(self._with_type(_chosen), f"{self._key()}, illegal long, cost long, audit string"), "audits")

    def _key(self) -> str:
        return f"conv_id {self.conv.simpleString()}"

    def _with_type(self, run):
        conv = to_arrow_type(self.conv)
        return lambda batches: run(batches, conv)

    def faults(self) -> DataFrame:
        """conv_id, gaps, blank, duplicate, truncated of each conversation."""
        turns = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
        return self.judged.groupBy("conv_id").agg(
            F.coalesce(turns, F.lit(0)).alias("gaps"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")]
        )

    def _stream(self) -> DataFrame:
        """conv_id, sub, new, text: the edits and, behind each of them, the text that it keeps; sorted, a conversation in one task."""
        row = ["conv_id", *_ORDER]
        audits = self.chosen.select("conv_id", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("at"), "audit")
        rows = self.judged.select("conv_id", F.lit(1).alias("kind"), "at", *_ORDER, "times")
        both = audits.unionByName(rows, allowMissingColumns=True).select("conv_id", "kind", "at", "audit", *_ORDER, "times")
        sorted_rows = both.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "at")
        schema = f"{self._key()}, turn long, role string, begins string, digest binary, sub long, new string"
        decided = sorted_rows.mapInArrow(self._with_type(_decided), schema)
        texts = self.rows.where(F.col("text").rlike(_SOLID)).select(
            "conv_id", "turn", "role", F.substring("text", 1, 64).alias("begins"), _digest().alias("digest"),
            F.lit(_TEXT_AT).cast("long").alias("sub"), F.col("text").cast("binary").alias("text"),
        )
        united = decided.unionByName(texts, allowMissingColumns=True).repartition("conv_id")
        return united.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), *row[2:], "sub").select("conv_id", "sub", "new", "text")

    def hashes(self) -> DataFrame:
        """conv_id, repaired_sha256 of conversations of which something is left."""
        return self._stream().mapInArrow(self._with_type(_hashed), f"{self._key()}, repaired_sha256 string")

    def repaired(self) -> DataFrame:
        """The repaired conversations: conv_id, turn (0, 1, 2, ...), role, text."""
        return self._stream().mapInArrow(self._with_type(_numbered), f"{self._key()}, turn long, role string, text string")


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """Faults, cheapest edits and hash of every conversation after ``damaged``."""
    made = Repair(damaged(conversations))
    parts = [conversations.select("conv_id").distinct(), made.faults(), made.chosen, made.hashes()]
    united = parts[0]
    for part in parts[1:]:
        united = united.unionByName(part, allowMissingColumns=True)
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return united.groupBy("conv_id").agg(
        *[F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )


def _extended(state: str, cost: str, letter: str, line: str) -> str:
    """DuckDB expression: a state with one more edit; NULL for a state that is not reached."""
    return f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {state}.t || {line}}} END"


def oracle() -> str:
    """The query's result as DuckDB SQL: rows are taken one by one, with the least (cost, audit, text) for each end of the output."""
    crc_byte = "(('0x' || substr(hex(encode(k)), 2 * i - 1, 2))::UBIGINT)"
    crc = (
        f"xor(list_reduce(list_concat([4294967295::UBIGINT], list_transform(range(1, octet_length(encode(k)) + 1), lambda i: {crc_byte})), "
        "lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255::UBIGINT)::BIGINT + 1])), 4294967295::UBIGINT) % 20"
    )
    newline = "chr(10)"
    inserted = {s: lambda state, who=who: _extended(state, str(COST[INSERT]), INSERT, f"{newline} || '{who}:'") for s, who in INSERTED.items()}

    def closed(s0: str, ss: str, su: str, sa: str, source: str) -> str:
        """Insertions before the next row, in two rounds."""
        first = f"SELECT *, least({su}, {inserted['u'](s0)}, {inserted['u'](ss)}, {inserted['u'](sa)}) AS u1, least({sa}, {inserted['a'](su)}) AS a1 FROM {source}"
        return f"SELECT *, least(u1, {inserted['u']('a1')}) AS u2, least(a1, {inserted['a']('u1')}) AS a2 FROM ({first})"

    gone = lambda state: _extended(state, str(COST[DELETE]), DELETE, "''")
    extra = f"(CASE WHEN r.fault = 'truncated' THEN {TRUNCATED} ELSE 0 END)"

    def stays(state: str, who: str, when: str, letter: str) -> str:
        made = _extended(state, f"{COST[letter]} + {extra}", letter, f"{newline} || {who} || ':' || r.text")
        return f"CASE WHEN r.fault NOT IN ('blank', 'duplicate') AND {when} THEN {made} END"

    keep = lambda state, initial: stays(state, "r.role", f"r.ini = '{initial}'", KEEP)
    rerole = lambda state, who: stays(state, f"'{who}'", "TRUE", REROLE)
    none = "NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR)"
    solid = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH RECURSIVE crc_table AS (
    SELECT list(list_reduce(list_concat([c], range(8)::UBIGINT[]), lambda x, k: xor(x >> 1, (x & 1) * 3988292384::UBIGINT)) ORDER BY c) AS crc
    FROM (SELECT i::UBIGINT AS c FROM range(256) g(i))
), drawn AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc} AS kind
    FROM (SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations), crc_table
), damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
           CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
           unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
    FROM drawn WHERE kind <> 0
), placed AS (
    SELECT *, substr(role, 1, 1) AS ini, rtrim(text, {solid}) AS bare, row_number() OVER o AS i
    FROM damaged WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, left(text, 64), sha256(text), copy)
), r AS (
    SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
           lag(ini) OVER (PARTITION BY conv_id ORDER BY i) || ini AS pair FROM placed
), start AS (
    SELECT DISTINCT conv_id, 0::BIGINT AS i, {{'c': 0::BIGINT, 'a': '', 't': ''}} AS s0, {none} AS ss, {none} AS su, {none} AS sa FROM r
), dp AS (
    SELECT conv_id, i, s0, ss, u2 AS su, a2 AS sa FROM ({closed('s0', 'ss', 'su', 'sa', 'start')})
    UNION ALL
    SELECT conv_id, i, n0, ns, u2, a2 FROM ({closed('n0', 'ns', 'nu', 'na', f'''(
        SELECT r.conv_id, r.i, {gone('s0')} AS n0, least({gone('ss')}, {keep('s0', 's')}) AS ns,
               least({gone('su')}, {keep('s0', 'u')}, {keep('ss', 'u')}, {keep('sa', 'u')}, {rerole('s0', 'user')}, {rerole('ss', 'user')}, {rerole('sa', 'user')}) AS nu,
               least({gone('sa')}, {keep('su', 'a')}, {rerole('su', 'assistant')}) AS na
        FROM dp JOIN r ON r.conv_id IS NOT DISTINCT FROM dp.conv_id AND r.i = dp.i + 1)''')})
), best AS (
    SELECT conv_id, arg_max(least(s0, sa), i) AS x FROM dp GROUP BY conv_id
), told AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
           count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM r GROUP BY conv_id
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(x.c, 0) AS cost, coalesce(x.a, '') AS audit, sha256(coalesce(substr(x.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN told ON told.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM c.conv_id"""

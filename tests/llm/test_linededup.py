import pytest
from compare import compare, duck
from pyspark.sql import functions as F

from pulsegrid.llm import linededup
from pulsegrid.llm.queries import QUERIES, SQL

SPACE = " \t\n\x0b\x0c\r"


def brute(rows, short=False):
    """rows of (doc_id, text): every window against all windows before it; ``short``: a text of one or two lines is one window."""
    order = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0))
    seen, out = {}, {}
    for key in order:
        lines = (key[1] or "").split("\n")
        solid = [i for i, x in enumerate(lines) if x.strip(SPACE)]
        gone = set()
        size = min(3, len(solid)) if short and solid else 3
        for k in range(len(solid) - size + 1):
            window = tuple(lines[i].strip(SPACE) for i in solid[k : k + size])
            if seen.setdefault(window, (key, k)) != (key, k):
                gone |= set(range(solid[k], solid[k + size - 1] + 1))
        rest = [x for i, x in enumerate(lines) if i not in gone]
        text = key[1] if not gone else "\n".join(rest) if any(x.strip(SPACE) for x in rest) else ""
        out[key] = text
    return sorted(((d, out[d, t]) for d, t in rows), key=str)


CASES = {
    "passage": [(1, "x\na\nb\nc\ny"), (2, "z\na\n b\t\n\nc\nw"), (3, "a\nb"), (4, "b\nc\na\nb\nc\nd")],
    "within": [(1, "a\nb\nc\nq\na\nb\nc\nr"), (2, "a\na\na\na\na")],
    "copies": [(3, "a\nb\nc\nd"), (2, "a\nb\nc\nd"), (7, "a\nb\nc\n\nnew"), (2, "a\nb\nc\nd")],
    "nulls": [(None, "a\nb\nc"), (5, "a\nb\nc\nrest"), (6, None), (7, ""), (None, None), (8, " \n \n \n"), (9, " \n \n \n")],
    "long": [(1, "\n".join(f"line {i}" for i in range(3000))), (2, "\n".join(f"line {i}" for i in range(1000, 2500)) + "\nend")],
    "none": [],
}


@pytest.mark.parametrize("case", CASES)
def test_equals_brute_force(spark, case):
    rows = CASES[case]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"pos": F.lit(1), "h1": F.lit("x"), "n_removed": F.lit("y")})
    got = linededup.dedup_lines(df)
    assert got.columns == ["doc_id", "text", "pos", "h1", "n_removed"]
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == brute(rows)


def test_columns_named_like_our_own_stay(spark):
    df = spark.createDataFrame([(1, "a\nb\nc"), (2, "a\nb\nc")], "doc_id long, text string")
    df = df.withColumns({n: F.col("doc_id") for n in ("_pg_starts", "_pg_id", "_pg_edit", "_pg_row", "a.b")})
    got = linededup.dedup_lines(df)
    assert got.columns == [*df.columns, "n_removed"]
    assert {(r.doc_id, r.text, r._pg_starts, r["a.b"]) for r in got.collect()} == {(1, "a\nb\nc", 1, 1), (2, "", 2, 2)}


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    assert compare(spark, duck(sf), sf, "op4", QUERIES["op4_line_windows"], SQL["op4_line_windows"]) is None


SHORT = {
    "copies": [(1, "a"), (2, " a\t"), (3, "\n\na\n"), (4, "a b"), (5, None), (None, "a"), (2, " a\t")],
    "two": [(1, "a\nb"), (2, "a\n\n b"), (3, "b\na"), (4, "a"), (5, "a\nb\nc"), (6, "x\na\nb\nc\ny"), (7, "a b")],
}
SHORT_WANT = {
    "copies": [(1, "a"), (2, ""), (3, ""), (4, "a b"), (5, None), (None, ""), (2, "")],
    "two": [(1, "a\nb"), (2, ""), (3, "b\na"), (4, "a"), (5, "a\nb\nc"), (6, "x\ny"), (7, "a b")],
}


@pytest.mark.parametrize("case", SHORT)
def test_short_texts_are_compared(spark, case):
    df = spark.createDataFrame(SHORT[case], "doc_id long, text string")
    got = [(r.doc_id, r.text) for r in linededup.dedup_lines(df, short=True).collect()]
    assert sorted(got, key=str) == sorted(SHORT_WANT[case], key=str)


def test_short_query_equals_sql_and_edits_more(spark):
    sf = "/root/testdata/sf0.01"
    con = duck(sf)
    assert compare(spark, con, sf, "op4", QUERIES["op4_line_windows_short"], SQL["op4_line_windows_short"]) is None
    gone = {k: con.execute(f"SELECT count(*) FROM ({SQL[k]}) WHERE n_removed > 0").fetchone()[0] for k in ("op4_line_windows", "op4_line_windows_short")}
    assert gone["op4_line_windows_short"] > gone["op4_line_windows"]


def test_pipeline_empties_short_copies_and_keeps_one_empty_document(spark):
    from corpus_pipeline import line_dedup, near_dedup

    rows = [(1, "one short line of words"), (2, "one short line of words"), (3, "two\nlines"), (4, "two\nlines"), (5, "something else here")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    edited = line_dedup(spark, df, "")
    assert {r.doc_id: r.text for r in edited.collect()} == {1: rows[0][1], 2: "", 3: rows[2][1], 4: "", 5: rows[4][1]}
    assert sorted(r.doc_id for r in near_dedup(spark, edited, "").collect()) == [1, 2, 3, 5]

"""Removal of passages that were seen before: overlapping windows of three lines.

A window is three consecutive lines that hold a word; blank lines between them are passed over
and belong to the window's span. Lines are compared without the white space at their ends. A
window that occurs again, in any document, is removed wherever it is not the first: the spans
of all such windows in a document are merged and the lines they cover go. Occurrences are
ordered by doc_id (null last), then by position.

Scale: windows travel as 128-bit hashes with a position, never as text; the first occurrence is
a pre-aggregated minimum, and windows that occur once drop out before the join. The join reads
both sides from files, so AQE can split a hot window. Only removals come back to the documents.

A text of one or two such lines has no window of three. With ``short`` it gets one window over all
its lines, so it is compared with other texts of as many lines and a later copy becomes empty;
without it (the SQL of ``op4_line_windows``) it is left alone. A passage inside a longer line is
not seen in either way.

Defined cases: null stays null; if no line
with a word remains the text becomes empty; rows with equal doc_id and text are one document
(both are edited alike, neither repeats the other); rows are never dropped; all columns are kept
(``n_removed`` is added, or replaced if the input has one).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import utf8, written

LINES = 3
_PLACE = ("no_id", "doc_id", "digest", "pos")


def solid_lines(text: bytes) -> tuple[list[bytes], list[int]]:
    """All lines, and the numbers of those that hold a word."""
    lines = text.split(b"\n")
    return lines, [i for i, line in enumerate(lines) if line and not line.isspace()]


def window_hashes(text: bytes | None, short: bool = False) -> np.ndarray:
    """Two longs for each window of ``LINES`` solid lines (``short``: or of all, if fewer), in order."""
    if not text:
        return np.zeros((0, 2), dtype=np.int64)
    lines, solid = solid_lines(text)
    bare = [lines[i].strip() for i in solid]
    size = min(LINES, len(bare)) if short and bare else LINES
    digests = [xxhash.xxh3_128_digest(b"\n".join(bare[i : i + size])) for i in range(len(bare) - size + 1)]
    return np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)


def without_windows(text: bytes, starts: np.ndarray) -> tuple[str, int]:
    """The text without the windows that start at these solid lines, and how many lines went."""
    lines, solid = solid_lines(text)
    size = min(LINES, len(solid))
    edges = np.zeros(len(lines) + 1, dtype=np.int64)
    for s in starts:
        edges[solid[s]] += 1
        edges[solid[s + size - 1] + 1] -= 1
    covered = np.cumsum(edges[:-1]) > 0
    rest = [line for line, gone in zip(lines, covered.tolist()) if not gone]
    if all(not line or line.isspace() for line in rest):
        return "", len(lines)
    return b"\n".join(rest).decode("utf-8", "replace"), int(covered.sum())


def _window_batches(short: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [window_hashes(x.as_py(), short) for x in batch.column(2)]
            counts = np.array([len(f) for f in found], dtype=np.int64)
            at = np.repeat(np.arange(len(found)), counts)
            hashes = np.concatenate(found) if found else np.zeros((0, 2), dtype=np.int64)
            pos = np.arange(len(at)) - np.repeat(np.cumsum(counts) - counts, counts)
            yield pa.record_batch(
                [batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at)), pa.array(pos.astype(np.int32)), pa.array(hashes[:, 0]), pa.array(hashes[:, 1])],
                names=["doc_id", "digest", "pos", "h1", "h2"],
            )

    return run


def _edited(text: pd.Series, starts: pd.Series) -> pd.DataFrame:
    made = [(None, 0) if t is None else without_windows(t, s) for t, s in zip(text, starts)]
    return pd.DataFrame(made, columns=["text", "n_removed"])


def repeated_windows(docs: DataFrame, short: bool = False) -> DataFrame:
    """doc_id, digest of the text, starts (positions of windows that occurred before)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("digest"), utf8("text").alias("text"))
    windows = written(rows.mapInArrow(_window_batches(short), "doc_id long, digest long, pos int, h1 long, h2 long"), "windows")
    windows = windows.withColumn("no_id", F.col("doc_id").isNull())
    firsts = windows.groupBy("h1", "h2").agg(F.min(F.struct(*_PLACE)).alias("first"), F.count(F.lit(1)).alias("n"))
    firsts = written(firsts.where("n > 1").select("h1", "h2", "first"), "repeated-windows")
    later = windows.join(firsts, ["h1", "h2"]).where(~F.struct(*_PLACE).eqNullSafe(F.col("first")))
    return later.groupBy("doc_id", "digest").agg(F.collect_set("pos").alias("starts"))


def dedup_lines(docs: DataFrame, short: bool = False) -> DataFrame:
    """The documents with ``text`` edited and ``n_removed`` (lines taken out) added."""
    gone = repeated_windows(docs, short).select(F.col("doc_id").alias("_pg_id"), F.col("digest").alias("_pg_digest"), F.col("starts").alias("_pg_starts"))
    packed = docs.select(F.struct("*").alias("_pg_row"), F.col("doc_id").cast("long").alias("_pg_key"), F.xxhash64("text").alias("_pg_sum"))
    same = packed["_pg_key"].eqNullSafe(gone["_pg_id"]) & (packed["_pg_sum"] == gone["_pg_digest"])
    joined = packed.join(gone, same, "left")
    hit = F.col("_pg_starts").isNotNull()
    edit = F.pandas_udf(_edited, "text string, n_removed int")
    edited = joined.withColumn("_pg_edit", edit(F.when(hit, utf8(F.col("_pg_row.text"))), F.col("_pg_starts")))
    made = {
        "text": F.when(hit, F.col("_pg_edit.text")).otherwise(F.col("_pg_row.text")),
        "n_removed": F.when(hit, F.col("_pg_edit.n_removed")).otherwise(0).cast("int"),
    }
    columns = list(dict.fromkeys([*docs.columns, "n_removed"]))
    return edited.select(*[made.get(c, F.col(f"_pg_row.`{c}`")).alias(c) for c in columns])


ORACLE = r"""
WITH l AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
    FROM documents
), n AS (
    SELECT doc_id, i, trim(line, chr(9) || chr(11) || chr(12) || chr(13) || ' ') AS bare FROM l
), w AS (
    SELECT doc_id, i AS lo, lead(i, 2) OVER d AS hi, bare AS l0, lead(bare) OVER d AS l1, lead(bare, 2) OVER d AS l2
    FROM n WHERE bare <> '' WINDOW d AS (PARTITION BY doc_id ORDER BY i)
), again AS (
    SELECT doc_id, lo, hi, row_number() OVER (PARTITION BY l0, l1, l2 ORDER BY doc_id, lo) AS nth FROM w WHERE hi IS NOT NULL
), gone AS (
    SELECT DISTINCT doc_id, unnest(generate_series(lo, hi)) AS i FROM again WHERE nth > 1
), rest AS (
    SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE gone.i IS NULL) AS text,
           bool_or(gone.i IS NULL AND trim(l.line, chr(9) || chr(11) || chr(12) || chr(13) || ' ') <> '') AS solid,
           count(gone.i) AS n_gone, count(*) AS n_lines
    FROM l LEFT JOIN gone USING (doc_id, i) GROUP BY l.doc_id
)
SELECT d.doc_id,
       CASE WHEN d.text IS NULL THEN NULL WHEN r.n_gone = 0 THEN d.text WHEN r.solid THEN r.text ELSE '' END AS text,
       CAST(CASE WHEN d.text IS NULL OR r.n_gone = 0 THEN 0 WHEN r.solid THEN r.n_gone ELSE r.n_lines END AS INTEGER) AS n_removed
FROM documents d LEFT JOIN rest r USING (doc_id)
"""

#: With ``short``: the first line of a text of one or two starts a window over all of them.
ORACLE_SHORT = ORACLE.replace(
    "lead(i, 2) OVER d AS hi",
    "CASE WHEN row_number() OVER d = 1 AND count(*) OVER (PARTITION BY doc_id) < 3 "
    "THEN max(i) OVER (PARTITION BY doc_id) ELSE lead(i, 2) OVER d END AS hi",
)

"""Checks and segments that keep state across micro-batches.

``record_checks`` follows the order checks of samples and annotations over any number of micro-batches: the state of a
record is its last index and time and its counts, so the report after any cut of the input equals
the batch report. ``live_segments`` keeps runs of flagged windows open for late windows: a window that joins two
segments takes both back and adds the joined one, until the watermark closes them.

State lives in the state store of the query (RocksDB) and is restored from its checkpoint after a lost executor.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from pulsegrid.operators.sequence import last_wins

KEY = "recording_id"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"

CHECKS = (
    f"{KEY} string, row_count long, gaps long, time_faults long, time_falls long, index_falls long, extra_seen boolean, "
    "first_timestamp timestamp, last_timestamp timestamp, ended boolean"
)
_CHECK_STATE = (
    "row_count long, gaps long, time_faults long, time_falls long, index_falls long, extra_seen boolean, "
    "first_us long, last_us long, last_index long"
)
MISSING = np.iinfo(np.int64).min


def _whole(values: pd.Series) -> np.ndarray:
    """64-bit integers; ``MISSING`` for nulls."""
    if values.isna().any():
        return np.array([MISSING if pd.isna(v) else int(v) for v in values], dtype=np.int64)
    return values.to_numpy(dtype=np.int64)


def compared(index: np.ndarray, at: np.ndarray) -> tuple[int, int, int, int]:
    """Gaps, times not after, times before and indexes before the previous row; nulls compare with nothing."""
    a, b = index[:-1], index[1:]
    known = (a != MISSING) & (b != MISSING)
    s, t = at[:-1], at[1:]
    timed = (s != MISSING) & (t != MISSING)
    return int((known & (b != a + 1)).sum()), int((timed & (t <= s)).sum()), int((timed & (t < s)).sum()), int((known & (b < a)).sum())


class RecordChecks(StatefulProcessor):
    """Input columns: place, index, at_us (microseconds), extra. A record ends after ``idle_ms`` without rows."""

    def __init__(self, idle_ms: int | None):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("checks", _CHECK_STATE)

    def _row(self, key, values, ended: bool) -> pd.DataFrame:
        n, gaps, faults, falls, index_falls, extra, first, last, _ = values
        stamp = lambda us: pd.NaT if us is None or us == MISSING else pd.Timestamp(us, unit="us")
        made = [key[0], n, gaps, faults, falls, index_falls, extra, stamp(first), stamp(last), ended]
        return pd.DataFrame([made], columns=[c.split()[0] for c in CHECKS.split(", ")])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        parts = [(_whole(p["place"]), _whole(p["index"]), _whole(p["at_us"]), bool(p["extra"].fillna(False).any())) for p in rows]
        place, index, at = (np.concatenate([p[i] for p in parts]) for i in range(3))
        order = np.argsort(place, kind="stable")
        index, at = index[order], at[order]
        held = self.state.get() if self.state.exists() else None
        n, *counts = held[:5] if held else (0, 0, 0, 0, 0)
        found = compared(*((np.concatenate([[held[8]], index]), np.concatenate([[held[7]], at])) if held else (index, at)))
        values = (
            n + len(index), *(a + b for a, b in zip(counts, found)), bool(held and held[5]) or any(p[3] for p in parts),
            held[6] if held else int(at[0]), int(at[-1]), int(index[-1]),
        )
        self.state.update(values)
        if self.idle_ms is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)
        yield self._row(key, values, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.state.exists():
            yield self._row(key, self.state.get(), True)
            self.state.clear()

    def close(self) -> None:
        pass


def record_checks(
    stream: DataFrame, place: str, index: str = "sample_index", time_col: str = "recorded_at", extra=None, idle_ms: int | None = None
) -> DataFrame:
    """Counts of each record after every micro-batch that brings rows of it (the latest row counts).

    Rows of a record come in order of micro-batches, inside one in any order (``place`` sorts them). After ``idle_ms`` milliseconds without
    rows a record's state is dropped with a last row ``ended``; it begins anew if more rows come.
    """
    slim = stream.select(
        F.col(KEY).cast("string").alias(KEY), F.col(place).cast("long").alias("place"), F.col(index).cast("long").alias("index"),
        F.unix_micros(F.col(time_col).cast("timestamp")).alias("at_us"),
        (F.lit(False) if extra is None else extra).alias("extra"),
    )
    mode = "None" if idle_ms is None else "ProcessingTime"
    return slim.groupBy(KEY).transformWithStateInPandas(RecordChecks(idle_ms), CHECKS, "Update", mode)


SEGMENTS = f"{KEY} string, start_minute long, end_minute long, max_score double, change int"


def merged(starts: np.ndarray, ends: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals that overlap or follow each other without a gap, joined; the highest score stays."""
    order = np.lexsort((ends, starts))
    starts, ends, scores = starts[order], ends[order], scores[order]
    reach = np.maximum.accumulate(ends)
    first = np.concatenate([[True], starts[1:] > reach[:-1] + 1])
    at = np.flatnonzero(first)
    return starts[at], np.maximum.reduceat(ends, at), np.maximum.reduceat(scores, at)


class LiveSegments(StatefulProcessor):
    """Input columns: minute, score of flagged windows; emits segments taken back (change -1) and added (+1)."""

    def __init__(self, minute_ms: int, origin_ms: int):
        self.minute_ms, self.origin_ms = minute_ms, origin_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("open", "starts array<long>, ends array<long>, scores array<double>")

    def _keep(self, starts, ends, scores, watermark_ms: int) -> None:
        """Only what a window that is not late can still touch stays; a timer closes the rest."""
        minute = (watermark_ms - self.origin_ms) // self.minute_ms
        touched = ends + 1 >= minute
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if touched.any():
            self.state.update((starts[touched].tolist(), ends[touched].tolist(), scores[touched].tolist()))
            self.handle.registerTimer(int(self.origin_ms + (ends[touched].max() + 2) * self.minute_ms))
        elif self.state.exists():
            self.state.clear()

    def _held(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        held = self.state.get() if self.state.exists() else ([], [], [])
        return np.array(held[0], dtype=np.int64), np.array(held[1], dtype=np.int64), np.array(held[2], dtype=np.float64)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        before = after = self._held()
        for part in rows:  # each part shrinks to its runs at once
            minute, score = part["minute"].to_numpy(np.int64), part["score"].to_numpy(np.float64)
            after = merged(*(np.concatenate(x) for x in zip(after, (minute, minute, score))))
        old, new = set(zip(*(x.tolist() for x in before))), set(zip(*(x.tolist() for x in after)))
        self._keep(*after, timerValues.getCurrentWatermarkInMs())
        changes = [(key[0], *s, -1) for s in sorted(old - new)] + [(key[0], *s, 1) for s in sorted(new - old)]
        yield pd.DataFrame(changes, columns=[c.split()[0] for c in SEGMENTS.split(", ")])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._keep(*self._held(), timerValues.getCurrentWatermarkInMs())
        yield pd.DataFrame([], columns=[c.split()[0] for c in SEGMENTS.split(", ")])

    def close(self) -> None:
        pass


def live_segments(
    windows: DataFrame, delay: str, origin: str, minute: str = "minute_index", time_col: str = "window_start_at", flag: str = "y_pred", score: str = "score",
    width_seconds: int = 60,
) -> DataFrame:
    """Changes of the segments of flagged windows as a stream (see ``current_segments``).

    Window i starts at ``origin`` plus i times the width; windows may come in any order inside ``delay``, and repeats of a window do
    no harm.
    """
    origin_ms = int(pd.Timestamp(origin, tz="UTC").timestamp() * 1000)
    flagged = windows.where(F.col(flag) == 1).select(
        F.col(KEY).cast("string").alias(KEY), F.col(minute).cast("long").alias("minute"), F.col(score).cast("double").alias("score"),
        F.col(time_col).cast("timestamp").alias("_at"),
    )
    grouped = flagged.withWatermark("_at", delay).groupBy(KEY)
    return grouped.transformWithStateInPandas(LiveSegments(1000 * width_seconds, origin_ms), SEGMENTS, "Update", "EventTime")


def start(changes: DataFrame, target: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Write the rows of every batch under its number; a batch that is run again writes the same folder again.

    The query takes what is there and ends; with ``every`` it goes on at that interval until it is stopped. Checks with ``idle_ms`` need
    ``every``: their timers call for a batch at any time, so such a query never comes to an end by itself.
    """
    trigger = {"availableNow": True} if every is None else {"processingTime": every}

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    return _with_rocksdb(
        changes.sparkSession,
        lambda: changes.writeStream.outputMode("update").foreachBatch(save).option("checkpointLocation", checkpoint)
        .trigger(**trigger).start(),
    )


def _with_rocksdb(spark: SparkSession, begin: Callable[[], StreamingQuery]) -> StreamingQuery:
    """Start a query with the state store that these operators need; other queries keep the session's."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, ROCKSDB)
    try:
        return begin()
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def current_checks(spark: SparkSession, target: str) -> DataFrame:
    """The latest counts of every record."""
    return last_wins(spark.read.parquet(target), [KEY], "batch").drop("batch")


def current_segments(spark: SparkSession, target: str) -> DataFrame:
    """The segments that were added and not taken back: start, end, length, top score."""
    columns = [KEY, "start_minute", "end_minute", "max_score"]
    left = spark.read.parquet(target).groupBy(*columns).agg(F.sum("change").alias("n")).where("n > 0")
    return left.select(KEY, "start_minute", "end_minute", (F.col("end_minute") - F.col("start_minute") + 1).alias("length"), "max_score")

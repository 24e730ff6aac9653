"""Order-dependent checks and numbering inside a record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.plans.ordered import with_ordinal, with_previous


def index_gaps(
    df: DataFrame, group: Sequence[str], order: Sequence[str | Column], index: str = "sample_index", limit=None
) -> DataFrame:
    """Rows whose index is not the previous one plus one."""
    seen = with_previous(df, group, order, {"previous_index": index}, "_has", limit)
    return seen.where(F.col("_has") & (F.col(index) != F.col("previous_index") + 1)).drop("_has")


def non_increasing_ts(
    df: DataFrame, group: Sequence[str], order: Sequence[str | Column], time_col: str = "recorded_at", limit=None
) -> DataFrame:
    """Rows whose timestamp is not after the previous one (samples: strict)."""
    seen = with_previous(df, group, order, {"previous_ts": time_col}, None, limit)
    return seen.where(F.col(time_col) <= F.col("previous_ts"))


def non_monotonic(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str | Column],
    columns: Sequence[str] = ("recorded_at", "minute_index"),
    limit=None,
) -> DataFrame:
    """Rows before which a column was larger (annotations: ties allowed), one flag per column."""
    seen = with_previous(df, group, order, {f"_p_{c}": c for c in columns}, None, limit)
    flags = {c: F.coalesce(F.col(c) < F.col(f"_p_{c}"), F.lit(False)) for c in columns}
    for c, flag in flags.items():
        seen = seen.withColumn(f"{c}_falls", flag)
    bad = F.lit(False)
    for c in columns:
        bad = bad | F.col(f"{c}_falls")
    return seen.where(bad).drop(*[f"_p_{c}" for c in columns])


def first_last_ts(df: DataFrame, group: Sequence[str], position: str, time_col: str = "recorded_at") -> DataFrame:
    """Timestamps of the first and last row by position, not the smallest and largest."""
    return df.groupBy(*group).agg(
        F.min_by(time_col, position).alias("first_at"), F.max_by(time_col, position).alias("last_at")
    )


def ordinal_minute(
    labels: DataFrame, group: Sequence[str], order: Sequence[str | Column], out: str = "minute_index", limit=None
) -> DataFrame:
    """Position of each label in its record, from 0."""
    return with_ordinal(labels, group, order, out, limit)


def last_wins(df: DataFrame, keys: Sequence[str], order: Column | str) -> DataFrame:
    """Keep the row with the highest order per key, by aggregation."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_best"))
    return best.select(*keys, "_best.*")


def first_seen_subject(
    recordings: DataFrame, order: Column | str, subject: str = "subject_id", record: str = "recording_id"
) -> DataFrame:
    """One row per subject; the note names the record seen first."""
    first = recordings.groupBy(subject).agg(F.min_by(record, order).alias("_first"))
    return first.select(subject, F.concat(F.lit("Derived from "), F.col("_first")).alias("notes"))


def flagged_segments(
    windows: DataFrame,
    group: Sequence[str] = ("recording_id",),
    minute: str = "minute_index",
    flag: str = "y_pred",
    score: str = "score",
    limit=None,
) -> DataFrame:
    """Runs of consecutive flagged windows: start, end, length and top score."""
    flagged = windows.where(F.col(flag) == 1)
    numbered = with_ordinal(flagged, group, [minute], "_ordinal", limit)
    runs = numbered.withColumn("_run", F.col(minute) - F.col("_ordinal"))
    return (
        runs.groupBy(*group, "_run")
        .agg(
            F.min(minute).alias("start_minute"),
            F.max(minute).alias("end_minute"),
            F.count(F.lit(1)).alias("length"),
            F.max(score).alias("max_score"),
        )
        .drop("_run")
    )

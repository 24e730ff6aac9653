"""Filters, predicates and quality rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions import text
from pulsegrid.plans.joins import join_lookup, rows_with_keys
from pulsegrid.plans.ordered import with_ordinal
from pulsegrid.schema import DEVELOPMENT_RECORDS
from pulsegrid.session import materialise, named


def range_query(
    df: DataFrame,
    record: str,
    start: str,
    width: str = "1 hour",
    columns: Sequence[str] = ("recorded_at", "ecg_value"),
    record_col: str = "recording_id",
    time_col: str = "recorded_at",
    tie: str | None = None,
) -> DataFrame:
    """One record, a half-open time range, in time order; both predicates reach the scan.

    ``tie`` names a selected column that orders rows of the same time.
    """
    begin = F.lit(start).cast(df.schema[time_col].dataType)
    end = begin + F.expr(f"interval {width}")
    return (
        df.where((F.col(record_col) == record) & (F.col(time_col) >= begin) & (F.col(time_col) < end))
        .select(*columns)
        .orderBy(time_col, *([tie] if tie else []))
    )


def ranges_per_record(
    df: DataFrame,
    starts: DataFrame,
    width: str = "1 hour",
    record_col: str = "recording_id",
    time_col: str = "recorded_at",
    start_col: str = "start_at",
) -> DataFrame:
    """The same range for every record of ``starts`` (one start per record)."""
    joined = join_lookup(df, starts.select(record_col, start_col), [record_col], "inner", computed=True)
    end = F.col(start_col) + F.expr(f"interval {width}")
    return joined.where((F.col(time_col) >= F.col(start_col)) & (F.col(time_col) < end))


def unknown_ids(wanted: DataFrame, known: DataFrame, key: str = "recording_id") -> DataFrame:
    """Wanted ids that no known row carries."""
    return wanted.select(key).distinct().join(known.select(key).distinct(), key, "left_anti")


def select_records(df: DataFrame, ids: DataFrame | None = None, key: str = "recording_id") -> DataFrame:
    """Rows of the listed records, all when no list is given; unknown ids raise."""
    if ids is None:
        return df
    missing = named(materialise(unknown_ids(ids, df, key)), key)
    if missing:
        raise ValueError(f"unknown records: {missing}; unknown_ids() lists them all")
    return rows_with_keys(df, ids, [key])


def cap_samples(df: DataFrame, *limits: Column, index: str = "sample_index") -> DataFrame:
    """Keep samples below the shortest of the given lengths (NULL limits do not count)."""
    if not limits:
        return df
    bound = limits[0] if len(limits) == 1 else F.least(*limits)
    return df.where(bound.isNull() | (F.col(index) < bound))


def cap_annotations(
    df: DataFrame, cap: Column | None, group: Sequence[str], order: Sequence[str], index: str = "sample_index"
) -> DataFrame:
    """Number the annotations of a record first, then drop those at or past the cap."""
    numbered = with_ordinal(df, group, order, "minute_index")
    return numbered if cap is None else numbered.where(cap.isNull() | (F.col(index) < cap))


def control_normal(df: DataFrame, record: str = "recording_id", y: str = "y", check: bool = False) -> DataFrame:
    """Normal windows of control records."""
    kept = df.where((text.category(F.col(record)) == "c") & (F.col(y) == 0))
    return _non_empty(kept, "control windows") if check else kept


def all_normal(df: DataFrame, y: str = "y", check: bool = False) -> DataFrame:
    """All normal windows."""
    kept = df.where(F.col(y) == 0)
    return _non_empty(kept, "normal windows") if check else kept


def _non_empty(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"no {what}")
    return df


def development_member(record: Column, records: Sequence[str] = DEVELOPMENT_RECORDS) -> Column:
    """Whether a record belongs to the fixed development set."""
    return F.lower(record).isin(*records)


def quality_rules(
    df: DataFrame,
    table: str,
    checks: Mapping[str, Column],
    unique: Mapping[str, Sequence[str]] | None = None,
    foreign: Mapping[str, tuple[str, DataFrame, str]] | None = None,
) -> DataFrame:
    """Violations per rule: (table_name, rule, violations).

    Checks are counted in one pass (a rule that is NULL is not violated, as in SQL). A
    unique rule counts rows beyond the first of each key. A foreign rule counts rows whose
    non-NULL key has no parent. Keys are counted before any shuffle of rows.
    """
    parts: list[DataFrame] = []
    if checks:
        one = df.agg(
            *[F.coalesce(F.sum(F.when(~rule, 1)), F.lit(0)).cast("long").alias(n) for n, rule in checks.items()]
        )
        pairs = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in checks])
        parts.append(one.select(F.inline(pairs)))
    for name, keys in (unique or {}).items():
        counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        extra = F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n") - 1)), F.lit(0)).cast("long")
        parts.append(counted.agg(extra.alias("violations")).select(F.lit(name).alias("rule"), "violations"))
    for name, (child_key, parent, parent_key) in (foreign or {}).items():
        keys = df.where(F.col(child_key).isNotNull()).groupBy(F.col(child_key).alias("k")).count()
        lost = keys.join(parent.select(F.col(parent_key).alias("k")).distinct(), "k", "left_anti")
        total = F.coalesce(F.sum("count"), F.lit(0)).cast("long")
        parts.append(lost.agg(total.alias("violations")).select(F.lit(name).alias("rule"), "violations"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select(F.lit(table).alias("table_name"), "rule", "violations")

"""Validation of extracted streams: issues fail a record, warnings do not."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pulsegrid.functions.timeline import rate_of
from pulsegrid.operators.sequence import first_last_ts
from pulsegrid.plans.ordered import with_previous
from pulsegrid.schema import EXTRA_CHANNELS, SAMPLING_RATE_HZ, WINDOW_SECONDS

KEY = "recording_id"


def messages(rules: Sequence[tuple[Column, Column | str]]) -> Column:
    """Texts of the rules that hold, in order."""
    parts = [F.when(rule, F.lit(t) if isinstance(t, str) else t) for rule, t in rules]
    return F.array_compact(F.array(*parts)) if parts else F.array().cast("array<string>")


def expected_rows(metadata: DataFrame, summary: DataFrame | None, cap: int | None = None) -> DataFrame:
    """Rows a record should have: the summary's figure, else the header's, at most the cap."""
    given = metadata.select(KEY, "num_samples")
    if summary is not None:
        given = given.join(summary.select(KEY, "expected_samples"), KEY, "left")
        value = F.coalesce("expected_samples", "num_samples")
    else:
        value = F.col("num_samples")
    if cap is not None:
        value = F.least(value, F.lit(cap))
    return given.select(KEY, value.cast("long").alias("expected_row_count"))


def validate_signals(
    signals: DataFrame, metadata: DataFrame, expected: DataFrame, order: str, block: int = 100_000
) -> DataFrame:
    """Gaps, time order, row count and channel presence of the samples of each record.

    Every gap and every time fault counts one issue; the two are reported with their
    number so that a record with many faults stays one row. ``order`` is an integer: the place
    of a sample in its record. Samples are compared inside blocks of ``block`` places, blocks
    with the one before through one summary row each, so a record of any length spreads over
    tasks and nothing but order, index, time and one flag moves.
    """
    extra_seen = F.coalesce(*[F.col(c) for c in EXTRA_CHANNELS]).isNotNull()
    slim = signals.select(
        KEY, F.floor(F.col(order) / F.lit(block)).alias("_block"), F.col(order).alias("_order"), "sample_index", "recorded_at",
        extra_seen.alias("_any_extra"),
    )
    inside = Window.partitionBy(KEY, "_block").orderBy("_order")
    ends = F.struct("sample_index", "recorded_at")
    gap = lambda before: F.col("sample_index") != before["sample_index"] + 1
    late = lambda before: F.col("recorded_at") <= before["recorded_at"]
    one = lambda c: F.when(c, 1).otherwise(0)
    blocks = slim.withColumn("_p", F.lag(ends).over(inside)).groupBy(KEY, "_block").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(one(gap(F.col("_p")))).alias("gaps"),
        F.sum(one(late(F.col("_p")))).alias("time_faults"),
        F.max("_any_extra").alias("extra_seen"),
        F.min_by(ends, "_order").alias("_first"),
        F.max_by(ends, "_order").alias("_last"),
    )
    blocks = blocks.withColumn("_before", F.lag("_last").over(Window.partitionBy(KEY).orderBy("_block"))).select("*", "_first.*")
    measured = blocks.groupBy(KEY).agg(
        F.sum("n").alias("row_count"),
        F.sum(F.col("gaps") + one(gap(F.col("_before")))).alias("gaps"),
        F.sum(F.col("time_faults") + one(late(F.col("_before")))).alias("time_faults"),
        F.max("extra_seen").alias("extra_seen"),
        F.min_by("_first.recorded_at", "_block").alias("first_timestamp"),
        F.max_by("_last.recorded_at", "_block").alias("last_timestamp"),
    )
    return signal_report(measured, metadata, expected)


def signal_report(measured: DataFrame, metadata: DataFrame, expected: DataFrame) -> DataFrame:
    """Issues and warnings from the counts of each record, wherever they were counted (batch or stream)."""
    facts = metadata.select(KEY, "has_respiration").join(expected, KEY, "left").join(measured, KEY, "left")
    rows = F.coalesce("row_count", F.lit(0)).cast("long")
    missing = F.col("row_count").isNull()
    number = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    extra = F.coalesce("extra_seen", F.lit(False))
    mismatch = F.concat(
        F.lit("signal row count mismatch: expected "), F.col("expected_row_count").cast("string"),
        F.lit(", found "), rows.cast("string"),
    )
    return facts.select(
        KEY,
        rows.alias("row_count"),
        "expected_row_count",
        "first_timestamp",
        "last_timestamp",
        messages([
            (missing, "missing signals"),
            (number("gaps") > 0, F.concat(F.lit("sample_index gaps: "), number("gaps").cast("string"))),
            (number("time_faults") > 0,
             F.concat(F.lit("non-increasing timestamps: "), number("time_faults").cast("string"))),
            (~missing & (rows != F.col("expected_row_count")), mismatch),
            (~F.col("has_respiration") & extra, "single-channel record contains extra channel values"),
        ]).alias("issues"),
        messages([
            (F.col("has_respiration") & ~missing & ~extra, "extra channels announced but all values are NULL"),
        ]).alias("warnings"),
    )


def validate_annotations(
    rows: DataFrame, metadata: DataFrame, expected_flag: str, index: str, order: str,
    present: DataFrame | None = None, limit=None,
) -> DataFrame:
    """Presence and (non-strict) order of annotations.

    ``present`` lists records whose artifact exists (default: all in ``metadata``): a
    required artifact that is absent is an issue, one without rows a warning.
    """
    slim = rows.select(*dict.fromkeys([KEY, order, index, "recorded_at"]))
    seen = with_previous(slim, [KEY], [order], {"_pt": "recorded_at", "_pi": index}, None, limit)
    measured = seen.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(F.when(F.col("recorded_at") < F.col("_pt"), 1).otherwise(0)).alias("time_faults"),
        F.sum(F.when(F.col(index) < F.col("_pi"), 1).otherwise(0)).alias("index_faults"),
        F.min_by("recorded_at", order).alias("first_timestamp"),
        F.max_by("recorded_at", order).alias("last_timestamp"),
    )
    return annotation_report(measured, metadata, expected_flag, index, present)


def annotation_report(
    measured: DataFrame, metadata: DataFrame, expected_flag: str, index: str, present: DataFrame | None = None
) -> DataFrame:
    """Issues and warnings of annotations from the counts of each record."""
    facts = metadata.select(KEY, F.col(expected_flag).alias("_want")).join(measured, KEY, "left")
    if present is None:
        facts = facts.withColumn("_there", F.lit(True))
    else:
        there = present.select(KEY).distinct().withColumn("_there", F.lit(True))
        facts = facts.join(there, KEY, "left").withColumn("_there", F.coalesce("_there", F.lit(False)))
    number = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    count = number("row_count")
    return facts.select(
        KEY,
        count.alias("row_count"),
        "first_timestamp",
        "last_timestamp",
        messages([
            (F.col("_want") & ~F.col("_there"), "missing required annotations"),
            (number("time_faults") > 0,
             F.concat(F.lit("non-monotonic timestamps: "), number("time_faults").cast("string"))),
            (number("index_faults") > 0,
             F.concat(F.lit(f"non-monotonic {index}: "), number("index_faults").cast("string"))),
        ]).alias("issues"),
        messages([(F.col("_want") & F.col("_there") & (count == 0), "annotations expected but empty")]).alias(
            "warnings"
        ),
    )


def validate_windows(
    windows: DataFrame, metadata: DataFrame, expected: DataFrame, order: str = "minute_index",
    rate: int | str = SAMPLING_RATE_HZ, width: int = WINDOW_SECONDS, limit=None,
) -> DataFrame:
    """Minute order, row count, label and channel rules of the window table.

    ``rate`` is one rate or the column of ``metadata`` that holds each record's own.
    """
    open_extra = F.lit(False)
    for c in EXTRA_CHANNELS:
        open_extra = open_extra | F.coalesce(F.col("modalities")[c]["available"], F.lit(False))
    slim = windows.select(
        KEY, "minute_index", F.col("apnea_label").isNotNull().alias("_labelled"), open_extra.alias("_open"),
        F.col(order).alias("_order"),
    )
    seen = with_previous(slim, [KEY], ["_order"], {"_pm": "minute_index"}, None, limit)
    measured = seen.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(F.when(F.col("minute_index") <= F.col("_pm"), 1).otherwise(0)).alias("order_faults"),
        F.sum(F.col("_labelled").cast("long")).alias("labeled_windows"),
        F.max("_open").alias("open_extra"),
    )
    facts = (
        metadata.select(KEY, "has_respiration", "has_apnea_annotations", rate_of(rate).alias("_rate")).join(expected, KEY, "left")
        .join(measured, KEY, "left")
    )
    number = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    count, labelled = number("row_count"), number("labeled_windows")
    missing = F.col("row_count").isNull()
    opened = F.coalesce("open_extra", F.lit(False))
    want = F.ceil(F.col("expected_row_count") / (F.col("_rate") * F.lit(width))).cast("long")
    mismatch = F.concat(
        F.lit("window row count mismatch: expected "), want.cast("string"), F.lit(", found "), count.cast("string")
    )
    return facts.select(
        KEY,
        count.alias("row_count"),
        want.alias("expected_row_count"),
        labelled.alias("labeled_windows"),
        messages([
            (missing, "missing windows"),
            (number("order_faults") > 0,
             F.concat(F.lit("non-increasing minute_index: "), number("order_faults").cast("string"))),
            (~missing & (count != want), mismatch),
            (~F.col("has_apnea_annotations") & (labelled > 0), "unlabelled record contains labels in windows"),
            (~F.col("has_respiration") & opened, "single-channel record windows advertise extra channels"),
        ]).alias("issues"),
        messages([
            (F.col("has_apnea_annotations") & (labelled == 0) & (count > 0), "labelled record has no labeled windows"),
            (F.col("has_respiration") & ~missing & ~opened, "extra channels announced but not in windows"),
        ]).alias("warnings"),
    )


def status_of(issues: Sequence[Column], warnings: Sequence[Column]) -> Column:
    """fail on any issue, else warn on any warning, else pass."""
    some = lambda arrays: sum((F.size(a) for a in arrays), F.lit(0)) > 0
    return F.when(some(issues), "fail").when(some(warnings), "warn").otherwise("pass")


def classify(sections: dict[str, DataFrame]) -> DataFrame:
    """One report row per record: a struct per section and the status."""
    out = None
    for name, section in sections.items():
        part = section.select(KEY, F.struct(*[c for c in section.columns if c != KEY]).alias(name))
        out = part if out is None else out.join(part, KEY, "full_outer")
    empty = F.array().cast("array<string>")
    pick = lambda f: [F.coalesce(F.col(f"{n}.{f}"), empty) for n in sections]
    return out.withColumn("status", status_of(pick("issues"), pick("warnings")))


def status_counts(reports: DataFrame, status: str = "status") -> DataFrame:
    """Records per status, a row for every status also when none has it."""
    one = reports.agg(
        *[F.coalesce(F.sum(F.when(F.col(status) == s, 1)), F.lit(0)).cast("long").alias(s)
          for s in ("pass", "warn", "fail")]
    )
    pairs = F.array(*[F.struct(F.lit(s).alias("status"), F.col(s).alias("n")) for s in ("pass", "warn", "fail")])
    return one.select(F.inline(pairs))


def merge_reports(
    fresh: DataFrame, stored: DataFrame, values: Sequence[str], key: str = KEY,
    retained: bool = True, path: str | None = None,
) -> DataFrame:
    """Fresh reports win, stored ones stand in for records that were not re-run.

    Without retained artifacts the path moves to ``source_path`` and is blanked.
    """
    tag = F.lit(True).alias("_fresh")
    a = fresh.select(key, tag, *[F.col(v).alias(f"_a_{v}") for v in values])
    b = stored.select(key, *[F.col(v).alias(f"_b_{v}") for v in values])
    joined = a.join(b, key, "full_outer")
    out = joined.select(
        key,
        *[F.when(F.col("_fresh"), F.col(f"_a_{v}")).otherwise(F.col(f"_b_{v}")).alias(v) for v in values],
        F.when(F.col("_fresh"), "fresh").otherwise("stored").alias("origin"),
    )
    if path and not retained:
        out = out.withColumn("source_path", F.col(path)).withColumn(
            path, F.lit(None).cast(out.schema[path].dataType)
        ).withColumn("artifact_retained", F.lit(False))
    return out


def extraction_stats(
    signals: DataFrame, labels: DataFrame, beats: DataFrame, windows: DataFrame, replaced: Sequence[str],
    signal_order: str = "sample_index", order: str = "row_id",
) -> DataFrame:
    """Counts, first and last timestamps per stream, windows and replaced values per record."""
    bad = sum((F.col(c).cast("long") for c in replaced), F.lit(0))
    s = signals.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("signal_rows"),
        F.min_by("recorded_at", signal_order).alias("signal_start_at"),
        F.max_by("recorded_at", signal_order).alias("signal_end_at"),
        F.sum(bad).alias("non_finite_values_replaced"),
    )
    parts = [s]
    for stream, name in ((labels, "apnea"), (beats, "qrs")):
        span = first_last_ts(stream, [KEY], order)
        span = span.select(KEY, F.col("first_at").alias(f"{name}_start_at"), F.col("last_at").alias(f"{name}_end_at"))
        counts = stream.groupBy(KEY).agg(F.count(F.lit(1)).alias(f"{name}_events"))
        parts.append(counts.join(span, KEY))
    parts.append(
        windows.groupBy(KEY).agg(
            F.count(F.lit(1)).alias("window_rows"),
            F.sum(F.col("apnea_label").isNotNull().cast("long")).alias("annotated_window_rows"),
        )
    )
    out = parts[0]
    for part in parts[1:]:
        out = out.join(part, KEY, "full_outer")
    numbers = ("signal_rows", "non_finite_values_replaced", "apnea_events", "qrs_events", "window_rows",
               "annotated_window_rows")
    for n in numbers:
        out = out.withColumn(n, F.coalesce(F.col(n), F.lit(0)).cast("long"))
    return out


TOTALS = ("signal_rows", "apnea_events", "qrs_events", "window_rows", "annotated_window_rows",
          "non_finite_values_replaced")


def transformation_totals(stats: DataFrame, columns: Sequence[str] = TOTALS) -> DataFrame:
    """Sums of the extraction figures over all records."""
    return stats.agg(
        F.count(F.lit(1)).alias("record_count"),
        *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in columns],
    )

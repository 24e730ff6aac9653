"""Bucket, channel and window aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pulsegrid.functions import timeline
from pulsegrid.plans.joins import broadcast_if_small, join_lookup, salted_join
from pulsegrid.plans.ordered import largest_group
from pulsegrid.schema import CHANNELS, MAIN_CHANNEL, SAMPLING_RATE_HZ, WINDOW_SECONDS
from pulsegrid.session import group_row_limit, materialise, stored


def bucket_stats(
    df: DataFrame,
    seconds: int = WINDOW_SECONDS,
    value: str = MAIN_CHANNEL,
    keys: Sequence[str] = ("recording_id",),
    time_col: str = "recorded_at",
) -> DataFrame:
    """Mean, minimum and maximum per time bucket."""
    return df.groupBy(*keys, timeline.bucket(F.col(time_col), seconds).alias("bucket")).agg(
        F.avg(value).alias("avg_value"), F.min(value).alias("min_value"), F.max(value).alias("max_value")
    )


def bucket_counts(
    df: DataFrame,
    seconds: int = WINDOW_SECONDS,
    keys: Sequence[str] = ("recording_id",),
    time_col: str = "recorded_at",
) -> DataFrame:
    """Events per time bucket."""
    return df.groupBy(*keys, timeline.bucket(F.col(time_col), seconds).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n")
    )


def channel_aggregates(channels: Sequence[str], replaced: str = "{}_replaced", flags: bool = True) -> list[Column]:
    """Partial-aggregable measures of every channel, all in one pass."""
    out: list[Column] = []
    for c in channels:
        bad = F.count_if(F.col(replaced.format(c))) if flags else F.lit(0)
        out += [
            F.count(c).alias(f"{c}__count"),
            (F.count(F.lit(1)) - F.count(c)).alias(f"{c}__missing_count"),
            bad.cast("long").alias(f"{c}__non_finite_replaced"),
            F.min(c).alias(f"{c}__min"),
            F.max(c).alias(f"{c}__max"),
            F.avg(c).alias(f"{c}__mean"),
            F.stddev_pop(c).alias(f"{c}__std"),
        ]
    return out


def _stats_struct(c: str, available: Column, normalized: Column | None = None) -> Column:
    """The statistics of one channel; zeros and NULLs when it is not available."""
    number = lambda f: F.when(available, F.col(f"{c}__{f}"))
    count = lambda f: F.coalesce(number(f), F.lit(0)).cast("long")
    return F.struct(
        F.coalesce(available, F.lit(False)).alias("available"),
        count("count").alias("count"),
        count("missing_count").alias("missing_count"),
        count("non_finite_replaced").alias("non_finite_replaced"),
        number("min").alias("min"),
        number("max").alias("max"),
        number("mean").alias("mean"),
        F.when(F.col(f"{c}__count") > 1, number("std")).alias("std"),
        (F.lit(None).cast("double") if normalized is None else F.when(available, normalized)).alias(
            "normalized_mean"
        ),
    )


def availability(channels: Sequence[str], has_extra: Column, main: str = MAIN_CHANNEL) -> dict[str, Column]:
    """The main channel is always there, the others where the record says so."""
    return {c: F.lit(True) if c == main else F.coalesce(has_extra, F.lit(False)) for c in channels}


def channel_stats(
    df: DataFrame,
    keys: Sequence[str],
    channels: Sequence[str] = CHANNELS,
    has_extra: str | None = None,
) -> DataFrame:
    """Statistics per group as a map from channel to struct."""
    extra = [F.max(has_extra).alias("_extra")] if has_extra else []
    grouped = df.groupBy(*keys) if keys else df.groupBy()
    stats = grouped.agg(*extra, *channel_aggregates(channels))
    open_ = availability(channels, F.col("_extra") if has_extra else F.lit(True))
    entries = [x for c in channels for x in (F.lit(c), _stats_struct(c, open_[c]))]
    return stats.select(*keys, F.create_map(*entries).alias("modalities"))


def modalities_long(df: DataFrame, keys: Sequence[str], column: str = "modalities") -> DataFrame:
    """One row per group and channel out of the map form."""
    return df.select(*keys, F.explode(column).alias("channel", "s")).select(*keys, "channel", "s.*")


def record_stats_from_windows(windows: DataFrame, channels: Sequence[str], key: str = "recording_id") -> DataFrame:
    """Record-level statistics merged from window-level ones; raw samples are not read again.

    The spread is merged around the record mean, so it does not cancel.
    """
    means = windows.groupBy(key).agg(
        *[
            (F.sum(F.col(f"{c}__mean") * F.col(f"{c}__count")) / F.nullif(F.sum(f"{c}__count"), F.lit(0))).alias(
                f"{c}__rec_mean"
            )
            for c in channels
        ]
    )
    centred = join_lookup(windows, means, [key])
    aggs: list[Column] = [F.max("_extra").alias("_extra"), F.sum("sample_count").alias("sample_count")]
    for c in channels:
        n = F.sum(f"{c}__count")
        shift = F.col(f"{c}__mean") - F.col(f"{c}__rec_mean")
        spread = F.sum(F.col(f"{c}__count") * (F.col(f"{c}__std") * F.col(f"{c}__std") + shift * shift))
        aggs += [
            n.alias(f"{c}__count"),
            F.sum(f"{c}__missing_count").alias(f"{c}__missing_count"),
            F.sum(f"{c}__non_finite_replaced").alias(f"{c}__non_finite_replaced"),
            F.min(f"{c}__min").alias(f"{c}__min"),
            F.max(f"{c}__max").alias(f"{c}__max"),
            F.first(f"{c}__rec_mean").alias(f"{c}__mean"),
            F.sqrt(spread / F.nullif(n, F.lit(0))).alias(f"{c}__std"),
        ]
    return centred.groupBy(key).agg(*aggs)


def window_partials(
    signals: DataFrame,
    channels: Sequence[str] = CHANNELS,
    rate: int | str = SAMPLING_RATE_HZ,
    width: int = WINDOW_SECONDS,
    key: str = "recording_id",
    has_extra: str = "has_respiration",
) -> DataFrame:
    """Wide window measures; windows exist only where samples exist.

    ``rate`` is one rate for all records or the column that holds each record's own.
    """
    own = [F.max(rate).alias("_rate")] if isinstance(rate, str) else []
    minute = timeline.minute_of(F.col("sample_index"), rate, width).alias("minute_index")
    return signals.groupBy(key, minute).agg(
        F.count(F.lit(1)).alias("sample_count"),
        F.max(has_extra).alias("_extra"),
        *own,
        *channel_aggregates(channels),
    )


def last_label(labels: DataFrame, key: str = "recording_id", order: str = "ordinal") -> DataFrame:
    """One label per (record, minute): on duplicates the last one wins."""
    chosen = F.max_by(F.struct("label", "is_apnea"), F.col(order)).alias("chosen")
    return (
        labels.groupBy(key, "minute_index")
        .agg(chosen)
        .select(key, "minute_index", F.col("chosen.label").alias("apnea_label"), F.col("chosen.is_apnea"))
    )


def attach_labels(windows: DataFrame, labels: DataFrame, key: str = "recording_id", order: str = "ordinal") -> DataFrame:
    """Left join of windows to the winning label of their minute.

    Both sides are grouped on the join keys, so the join adds no shuffle to an aggregated
    window table; the keys are unique, so it cannot skew.
    """
    return windows.join(last_label(labels, key, order), [key, "minute_index"], "left")


def attach_event_counts(
    windows: DataFrame,
    beats: DataFrame,
    rate: int | str = SAMPLING_RATE_HZ,
    width: int = WINDOW_SECONDS,
    key: str = "recording_id",
) -> DataFrame:
    """Beats per window, 0 where none; minutes without samples are dropped."""
    minute = timeline.minute_of(F.col("sample_index"), rate, width).alias("minute_index")
    counts = beats.groupBy(key, minute).agg(F.count(F.lit(1)).alias("qrs_count"))
    joined = windows.join(counts, [key, "minute_index"], "left")
    return joined.withColumn("qrs_count", F.coalesce(F.col("qrs_count"), F.lit(0)).cast("long"))


def attach_record_stats(
    windows: DataFrame, record_stats: DataFrame, columns: Sequence[str], key: str = "recording_id"
) -> DataFrame:
    """Record-level columns on every window row."""
    return join_lookup(windows, record_stats.select(key, *columns), [key])


def with_record_stats(parts: DataFrame, channels: Sequence[str], key: str = "recording_id") -> DataFrame:
    """Add each channel's record mean and spread (``__rmean``, ``__rstd``, NULL below two values) to its windows.

    Where no record has more windows than one task may sort, two window functions over the same partitioning do it with one
    shuffle; beyond that the statistics are aggregated and joined. Windows without a record get none.
    """
    if largest_group(parts.where(F.col(key).isNotNull()), [key]) > group_row_limit(parts.sparkSession):
        records = record_stats_from_windows(parts, channels, key).select(
            key,
            *[F.col(f"{c}__mean").alias(f"{c}__rmean") for c in channels],
            *[F.when(F.col(f"{c}__count") > 1, F.col(f"{c}__std")).alias(f"{c}__rstd") for c in channels],
        )
        return join_lookup(parts, records, [key], computed=True)
    whole, known = Window.partitionBy(key), F.col(key).isNotNull()
    total = lambda x: F.sum(x).over(whole)
    count = lambda c: total(F.col(f"{c}__count"))
    means = {f"{c}__rmean": F.when(known, total(F.col(f"{c}__mean") * F.col(f"{c}__count")) / F.nullif(count(c), F.lit(0))) for c in channels}
    centred = parts.withColumns(means)

    def spread(c: str) -> Column:
        shift = F.col(f"{c}__mean") - F.col(f"{c}__rmean")
        squares = total(F.col(f"{c}__count") * (F.col(f"{c}__std") * F.col(f"{c}__std") + shift * shift))
        return F.when(count(c) > 1, F.sqrt(squares / F.nullif(count(c), F.lit(0))))

    return centred.withColumns({f"{c}__rstd": spread(c) for c in channels})


def normalised_mean(mean: Column, record_mean: Column, record_std: Column) -> Column:
    """Window mean in record standard deviations; NULL without a usable spread."""
    return F.when(record_std != 0, (mean - record_mean) / record_std)


def window_summaries(
    signals: DataFrame,
    labels: DataFrame,
    beats: DataFrame,
    channels: Sequence[str] = CHANNELS,
    rate: int | str = SAMPLING_RATE_HZ,
    width: int = WINDOW_SECONDS,
    base: str | None = None,
    key: str = "recording_id",
    label_order: str = "ordinal",
    has_extra: str = "has_respiration",
) -> DataFrame:
    """Window rows with label, beat count and per-channel statistics.

    One pass over the samples. Samples, labels and beats are all grouped on (record,
    minute), so joining them adds no shuffle; the joined window table, thousands of times
    smaller than the samples, is written once and gives the record statistics (``with_record_stats``). ``rate`` may
    name a column of samples and beats with the rate of each record.
    """
    parts = window_partials(signals, channels, rate, width, key, has_extra)
    parts = attach_labels(parts, labels, key, label_order)
    parts = stored(attach_event_counts(parts, beats, rate, width, key), "window-parts")
    out = with_record_stats(parts, channels, key)
    open_ = availability(channels, F.col("_extra"))
    entries = []
    for c in channels:
        norm = normalised_mean(F.col(f"{c}__mean"), F.col(f"{c}__rmean"), F.col(f"{c}__rstd"))
        entries += [F.lit(c), _stats_struct(c, open_[c], norm)]
    bounds = timeline.window_bounds(
        F.col("minute_index"), "_rate" if isinstance(rate, str) else rate, width, **({"base": base} if base else {})
    )
    return out.select(
        key,
        "minute_index",
        *[c.alias(n) for n, c in bounds.items()],
        "sample_count",
        "apnea_label",
        "is_apnea",
        "qrs_count",
        F.create_map(*entries).alias("modalities"),
    )


def assemble_windows(
    signals: DataFrame,
    samples: int,
    rate: int = SAMPLING_RATE_HZ,
    width: int = WINDOW_SECONDS,
    value: str = MAIN_CHANNEL,
    key: str = "recording_id",
    order: Sequence[str] = ("sample_index",),
) -> DataFrame:
    """Full windows as arrays in index order.

    Windows with more rows than they may hold are dropped before any list is built, so a
    list never exceeds ``samples`` entries.
    """
    minute = timeline.minute_of(F.col("sample_index"), rate, width)
    rows = signals.select(key, minute.alias("minute_index"), *order, value)
    sizes = rows.groupBy(key, "minute_index").agg(F.count(F.lit(1)).alias("n_samples"))
    over = materialise(sizes.where(F.col("n_samples") > samples).select(key, "minute_index"))
    over = broadcast_if_small(over)
    bounded = rows.join(over, [key, "minute_index"], "left_anti")
    entry = F.struct(*order, F.col(value).alias("_v"))
    return (
        bounded.groupBy(key, "minute_index")
        .agg(F.sort_array(F.collect_list(entry)).alias("_rows"))
        .where(F.size("_rows") == samples)
        .select(
            key,
            "minute_index",
            F.transform("_rows", lambda r: r["_v"]).alias("ecg"),
            F.size("_rows").alias("n_samples"),
        )
    )


def interval_join(
    labels: DataFrame,
    samples: DataFrame,
    seconds: int = WINDOW_SECONDS,
    key: str = "recording_id",
    label_time: str = "label_at",
    sample_time: str = "recorded_at",
) -> DataFrame:
    """Samples inside [label, label + width) of the same record.

    Every label is repeated for the (at most two) buckets it touches, so the join is an
    equi join on (record, bucket); a small label table is broadcast, otherwise hot
    (record, bucket) keys are salted.
    """
    step = seconds * timeline.MICROS
    start = timeline.micros(F.col(label_time))
    first = timeline.floor_div(start, step)
    last = timeline.floor_div(start + F.lit(step - 1), step)
    touching = labels.withColumn("_bucket", F.explode(F.sequence(first, last)))
    placed = samples.withColumn("_bucket", timeline.floor_div(timeline.micros(F.col(sample_time)), step))
    small = broadcast_if_small(touching)
    keys = [key, "_bucket"]
    joined = placed.join(small, keys) if small is not touching else salted_join(placed, touching, keys)
    offset = timeline.micros(F.col(sample_time)) - timeline.micros(F.col(label_time))
    return joined.where((offset >= 0) & (offset < step)).drop("_bucket")


def interval_join_plain(
    labels: DataFrame,
    samples: DataFrame,
    seconds: int = WINDOW_SECONDS,
    key: str = "recording_id",
    label_time: str = "label_at",
    sample_time: str = "recorded_at",
) -> DataFrame:
    """The same join with the range as a residual condition on the record key."""
    offset = timeline.micros(F.col(sample_time)) - timeline.micros(F.col(label_time))
    return samples.join(labels, key).where((offset >= 0) & (offset < seconds * timeline.MICROS))


def label_signal_stats(
    labels: DataFrame,
    samples: DataFrame,
    seconds: int = WINDOW_SECONDS,
    by: Sequence[str] = ("recording_id", "minute_index", "label"),
    value: str = MAIN_CHANNEL,
    key: str = "recording_id",
) -> DataFrame:
    """Count and mean of the samples under each label."""
    return (
        interval_join(labels, samples, seconds, key)
        .groupBy(*by)
        .agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("avg_value"))
    )


def earliest(df: DataFrame, keys: Sequence[str], time_col: str = "recorded_at") -> DataFrame:
    """Earliest timestamp per record."""
    return df.groupBy(*keys).agg(F.min(time_col).alias("start_at"))

"""Time and index arithmetic; instants are UTC, maths is on integer microseconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulsegrid.schema import BASE_TIME, SAMPLING_RATE_HZ, WINDOW_SECONDS

MICROS = 1_000_000


def rate_of(rate: Column | int | str) -> Column:
    """A sampling rate given as a number, as the name of a column or as a column."""
    if isinstance(rate, int):
        return F.lit(rate)
    return (F.col(rate) if isinstance(rate, str) else rate).cast("long")


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def ntz(us: Column) -> Column:
    return F.timestamp_micros(us).cast("timestamp_ntz")


def base_micros(base: str = BASE_TIME) -> Column:
    return micros(F.lit(base))


def synth_ts(index: Column, rate: Column | int = SAMPLING_RATE_HZ, base: str = BASE_TIME) -> Column:
    """Timestamp of a sample: base + index / rate seconds."""
    rate = F.lit(rate) if isinstance(rate, int) else rate
    return ntz(base_micros(base) + floor_div(index.cast("long") * F.lit(MICROS), rate.cast("long")))


def sample_index(ts: Column, rate: int = SAMPLING_RATE_HZ, base: str = BASE_TIME) -> Column:
    """Index of the sample slot an instant falls in."""
    offset = micros(ts) - base_micros(base)
    return floor_div(offset * F.lit(rate), MICROS)


def floor_div(value: Column, by: int | Column) -> Column:
    """Integer division that floors, also below zero."""
    by = F.lit(by) if isinstance(by, int) else by
    value = value.cast("long")
    return F.call_function("div", value - F.pmod(value, by), by)


def minute_of(index: Column, rate: Column | int | str = SAMPLING_RATE_HZ, width: int = WINDOW_SECONDS) -> Column:
    """Window number of a sample index."""
    return floor_div(index.cast("long"), rate * width if isinstance(rate, int) else rate_of(rate) * F.lit(width))


def bucket(ts: Column, seconds: int) -> Column:
    """Start of the fixed-width time bucket, as timestamp without zone."""
    us = micros(ts)
    return ntz(us - F.pmod(us, F.lit(seconds * MICROS).cast("long")))


def window_bounds(
    minute: Column,
    rate: Column | int | str = SAMPLING_RATE_HZ,
    width: int = WINDOW_SECONDS,
    base: str = BASE_TIME,
) -> dict[str, Column]:
    """First and last sample of a window, as indexes and as timestamps."""
    rate = rate_of(rate)
    start = minute.cast("long") * F.lit(width) * rate
    end = start + F.lit(width) * rate - 1
    return {
        "sample_start_index": start,
        "sample_end_index": end,
        "window_start_at": synth_ts(start, rate, base),
        "window_end_at": synth_ts(end, rate, base),
    }


def normalise_ts(value: Column) -> Column:
    """ISO text (Z, offset or naive = UTC) to UTC ISO text with an explicit offset."""
    parsed = F.to_timestamp(F.trim(value))
    fraction = F.date_format(parsed, "SSSSSS")
    return F.concat(
        F.date_format(parsed, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(fraction == "000000", F.lit("")).otherwise(F.concat(F.lit("."), fraction)),
        F.lit("+00:00"),
    )


def iso(ts: Column) -> Column:
    """ISO text of a timestamp."""
    return normalise_ts(ts.cast("string"))


def length_seconds(samples: Column, rate: Column | int) -> Column:
    """Duration in whole seconds, half to even."""
    rate = F.lit(rate) if isinstance(rate, int) else rate
    return F.bround(samples / rate, 0).cast("long")

"""Cleaning rules for channel values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.schema import CHANNELS, EXTRA_CHANNELS


def is_non_finite(value: Column) -> Column:
    """True for NaN and both infinities, False for numbers and NULL."""
    bad = F.isnan(value) | (F.abs(value) == F.lit(float("inf")))
    return F.coalesce(bad, F.lit(False))


def finite(value: Column) -> Column:
    return F.when(~is_non_finite(value), value)


def clean_non_finite(df: DataFrame, columns: Sequence[str] = CHANNELS, flag: str = "{}_replaced") -> DataFrame:
    """NaN and infinities become NULL; one flag per column tells a replacement from a gap."""
    for name in columns:
        df = df.withColumn(flag.format(name), is_non_finite(F.col(name)))
    for name in columns:
        df = df.withColumn(name, finite(F.col(name)))
    return df


def structural_nulls(
    df: DataFrame,
    has_extra: Column,
    extra_count: Column | int = 4,
    columns: Sequence[str] = EXTRA_CHANNELS,
    required: int = 4,
) -> DataFrame:
    """Extra channels only where the record says so and all of them were read."""
    extra_count = F.lit(extra_count) if isinstance(extra_count, int) else extra_count
    allowed = F.coalesce(has_extra & (extra_count >= required), F.lit(False))
    for name in columns:
        df = df.withColumn(name, F.when(allowed, F.col(name)))
    return df

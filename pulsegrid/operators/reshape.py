"""Channel layout, unions, heads and previews."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pulsegrid.schema import CHANNELS


def to_long(df: DataFrame, keys: Sequence[str], channels: Sequence[str] = CHANNELS) -> DataFrame:
    """One row per sample and channel."""
    return df.unpivot(list(keys), list(channels), "channel", "value")


def to_wide(df: DataFrame, keys: Sequence[str], channels: Sequence[str] = CHANNELS) -> DataFrame:
    """One row per sample, a column per channel; the channel list is fixed, so no extra pass."""
    return df.groupBy(*keys).pivot("channel", list(channels)).agg(F.first("value", ignorenulls=True))


def distinct_ids(*frames: DataFrame, key: str = "recording_id") -> DataFrame:
    """Ids over several tables; each table is reduced before the union."""
    return reduce(DataFrame.unionByName, [f.select(key).distinct() for f in frames]).distinct()


def union_tables(*frames: DataFrame) -> DataFrame:
    """Stack tables by column name, absent columns NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def head_per_group(df: DataFrame, n: int, group: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """First n rows per group; Spark keeps only n candidates per task before the shuffle."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def head(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    """First n rows in the given order."""
    return df.orderBy(*order).limit(n)


def preview(
    df: DataFrame, n: int, group: Sequence[str], order: Sequence[str], channels: Sequence[str] = CHANNELS
) -> DataFrame:
    """First n samples per record, channel values as text with six decimals."""
    shown = [F.when(F.col(c).isNotNull(), F.format_string("%.6f", F.col(c))).alias(c) for c in channels]
    return head_per_group(df, n, group, order).select(*group, *order, *shown)


def preview_lines(df: DataFrame, n: int, path: str = "path", text: str = "value") -> DataFrame:
    """First n lines of each text file read whole."""
    lines = F.slice(F.split(F.col(text), "\r?\n"), 1, n)
    return df.select(path, F.posexplode(lines).alias("line_number", "line"))

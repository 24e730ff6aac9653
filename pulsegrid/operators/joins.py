"""Join operators between streams of a recording and between tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.plans.joins import join_lookup, rows_with_keys
from pulsegrid.schema import EXTRA_CHANNELS


def fk_orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent.

    The orphan keys are found on distinct keys, so rows of a hot key are not shuffled for
    the test itself.
    """
    keys = child.where(F.col(child_key).isNotNull()).select(child_key).distinct()
    parents = parent.select(F.col(parent_key).alias(child_key)).distinct()
    lost = keys.join(parents, child_key, "left_anti")
    return rows_with_keys(child, lost, [child_key])


def record_exists(wanted: DataFrame, table: DataFrame, key: str = "recording_id") -> DataFrame:
    """Wanted ids that already have rows in the table."""
    return wanted.select(key).distinct().join(table.select(key).distinct(), key, "left_semi")


def without_match(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` with no row in ``right`` (NOT EXISTS)."""
    return rows_with_keys(left, right, keys, keep=False)


def compare_runs(a: DataFrame, b: DataFrame, key: str, names: tuple[str, str], values: Sequence[str]) -> DataFrame:
    """Two summary tables side by side, NULL where one lacks the test."""
    left = a.select(key, *[F.col(v).alias(f"{names[0]}_{v}") for v in values])
    right = b.select(key, *[F.col(v).alias(f"{names[1]}_{v}") for v in values])
    return left.join(right, key, "full_outer")


def align_channels(
    main: DataFrame,
    extra: DataFrame | None,
    keys: Sequence[str] = ("recording_id", "sample_index"),
    channels: Sequence[str] = EXTRA_CHANNELS,
    expected: DataFrame | None = None,
) -> DataFrame:
    """Main and extra channels on the same sample index.

    A record with an extra file is truncated to the shorter of both; a record without one
    keeps its main samples with NULL extras. ``expected`` lists the records that have an
    extra file (default: those seen in ``extra``).
    """
    record = keys[0]
    empty = [F.lit(None).cast("double").alias(c) for c in channels]
    if extra is None:
        return main.select("*", *empty)
    having = (extra if expected is None else expected).select(record).distinct().withColumn("_has", F.lit(True))
    tagged = join_lookup(main, having, [record], computed=True)
    joined = tagged.join(extra.select(*keys, *channels, F.lit(True).alias("_seen")), list(keys), "left")
    return joined.where(F.col("_has").isNull() | F.col("_seen").isNotNull()).drop("_has", "_seen")


def zip_arrays(x: Column, x_hat: Column) -> Column:
    """Positions of two arrays paired as (x, x_hat) structs."""
    return F.zip_with(x, x_hat, lambda a, b: F.struct(a.alias("x"), b.alias("x_hat")))


def zip_reconstruction(df: DataFrame, keys: Sequence[str], x: str = "x", x_hat: str = "x_hat") -> DataFrame:
    """One row per array position with both values."""
    return df.select(*keys, F.posexplode(zip_arrays(F.col(x), F.col(x_hat))).alias("pos", "p")).select(
        *keys, "pos", "p.x", "p.x_hat"
    )

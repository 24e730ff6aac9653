"""Load logs and timing samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.plans.ordered import order_statistic

# Tables whose load is tracked, and the name of the layout step.
TRACKED = ("signals", "annotations_apnea", "annotations_qrs")
COMPRESSION = "compression"


def _rate() -> Column:
    return F.when(F.col("duration_sec") > 0, F.col("rows_inserted") / F.col("duration_sec"))


def ingest_throughput(log: DataFrame, tracked: Sequence[str] = TRACKED) -> DataFrame:
    """Rows, seconds and rows per second of each tracked table and of all of them."""
    sums = [
        F.coalesce(F.sum("rows_inserted"), F.lit(0)).cast("long").alias("rows_inserted"),
        F.coalesce(F.sum("duration_sec"), F.lit(0.0)).alias("duration_sec"),
    ]
    rolled = log.where(F.col("table").isin(*tracked)).rollup("table").agg(*sums)
    return rolled.select(F.coalesce("table", F.lit("total")).alias("table"), "rows_inserted", "duration_sec", _rate().alias("rows_per_sec"))


def compression_entry(log: DataFrame) -> DataFrame:
    """The layout step, kept out of the throughput figures."""
    return log.where(F.col("table") == COMPRESSION).groupBy("table").agg(
        F.sum("rows_inserted").cast("long").alias("rows_inserted"), F.sum("duration_sec").alias("duration_sec")
    )


def merge_load_logs(log: DataFrame, order: str = "seq") -> DataFrame:
    """Sums per table in first-seen order."""
    return log.groupBy("table").agg(
        F.sum("rows_inserted").cast("long").alias("rows_inserted"),
        F.sum("duration_sec").alias("duration_sec"),
        F.min(order).alias("first_seen"),
    ).orderBy("first_seen")


def load_span(log: DataFrame, order: str = "seq", start: str = "start_time", end: str = "end_time") -> DataFrame:
    """Start of the first load and end of the last one."""
    return log.agg(F.min_by(start, order).alias("start_time"), F.max_by(end, order).alias("end_time"))


def timing_stats(samples: DataFrame, by: Sequence[str] = ("test_name", "record_id"), value: str = "ms") -> DataFrame:
    """Minimum, maximum, mean, spread (0 for one sample) and total of timing samples."""
    return samples.groupBy(*by).agg(
        F.count(value).alias("iterations"), F.min(value).alias("min_ms"), F.max(value).alias("max_ms"),
        F.avg(value).alias("avg_ms"), F.stddev_pop(value).alias("stdev_ms"), F.sum(value).alias("total_ms"),
    )


def latency_summary(samples: DataFrame, test: str = "test_name", record: str = "record_id", value: str = "ms", limit=None) -> DataFrame:
    """Mean of the record means and the low nearest-rank 95 % sample of each test."""
    means = samples.groupBy(test, record).agg(F.avg(value).alias("m")).groupBy(test).agg(F.avg("m").alias("avg_ms"))
    rank = lambda n: F.greatest(F.floor(n * F.lit(0.95)) - 1, F.lit(0))
    return means.join(order_statistic(samples, [test], value, rank, "p95_ms", limit), test, "left")

"""The tables of a benchmark and evaluation report, each as one frame that ``sinks.exports.write_csv_tables`` can write."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.operators import benchlog as bl
from pulsegrid.operators import joins as jn
from pulsegrid.plans.ordered import with_ordinal
from pulsegrid.sinks.tables import stored_bytes

#: Tables whose size a report states.
SIZED = ("signals", "annotations_apnea", "annotations_qrs")


def latency_table(samples: Mapping[str, DataFrame]) -> DataFrame:
    """test_name, then mean and 95 % sample of two stores side by side; NULL where a store lacks the test.

    ``samples``: timing samples (test_name, record_id, ms) by name of the store.
    """
    (a, first), (b, second) = samples.items()
    both = jn.compare_runs(bl.latency_summary(first), bl.latency_summary(second), "test_name", (a, b), ["avg_ms", "p95_ms"])
    return both.select("test_name", *[f"{name}_{value}" for value in ("avg_ms", "p95_ms") for name in (a, b)])


def throughput_table(logs: Mapping[str, DataFrame]) -> DataFrame:
    """database, rows, seconds and rows a second over all tracked tables, one row for each store's load log."""
    rows = [
        bl.ingest_throughput(log).where(F.col("table") == "total").select(F.lit(name).alias("database"), "rows_inserted", "duration_sec", "rows_per_sec")
        for name, log in logs.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), rows)


def storage_table(spark: SparkSession, roots: Mapping[str, str]) -> DataFrame:
    """database, bytes of each record table below its root and of all of them, one row for each store."""
    rows = None
    for name, root in roots.items():
        for table in SIZED:
            size = stored_bytes(spark, f"{root}/{table}").select(F.lit(name).alias("database"), F.lit(table).alias("table"), "n_bytes")
            rows = size if rows is None else rows.unionByName(size)
    wide = rows.groupBy("database").pivot("table", list(SIZED)).agg(F.sum("n_bytes"))
    total = reduce(lambda a, b: a + b, [F.col(t) for t in SIZED])
    return wide.select("database", *[F.col(t).alias(f"{t}_bytes") for t in SIZED], total.alias("total_bytes"))


def window_prediction_table(scored: DataFrame, protocol: str, method: str, order: str = "window_id", extra: tuple[str, ...] = ()) -> DataFrame:
    """protocol, method, split, index (place in the split), record, truth, flag and score of every window."""
    placed = with_ordinal(scored, ["split"], [order], "index")
    return placed.select(
        F.lit(protocol).alias("protocol"), F.lit(method).alias("method"), "split", "index", "recording_id",
        F.col("y_true").cast("int").alias("y_true"), F.col("y_pred").cast("int").alias("y_pred"), F.col("score").cast("double").alias("score"), *extra,
    )

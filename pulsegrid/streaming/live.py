"""Streaming forms of the bucket aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pulsegrid.operators.sequence import last_wins


def stream_bucket_stats(
    stream: DataFrame, width: str = "1 minute", delay: str = "10 minutes", value: str = "ecg_value",
    keys: Sequence[str] = ("recording_id",), time_col: str = "recorded_at",
) -> DataFrame:
    """Mean, minimum, maximum and count per tumbling bucket; late rows beyond the delay are dropped."""
    grouped = stream.withWatermark(time_col, delay).groupBy(*keys, F.window(F.col(time_col), width).alias("_w"))
    stats = grouped.agg(
        F.avg(value).alias("avg_value"), F.min(value).alias("min_value"), F.max(value).alias("max_value"),
        F.count(F.lit(1)).alias("n"),
    )
    return stats.select(*keys, F.col("_w.start").alias("bucket"), "avg_value", "min_value", "max_value", "n")


def start_updates(aggregated: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Write the changed buckets of every batch under its batch number.

    A batch that is run again writes the same folder again, so restarts add nothing twice.
    """

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    return (
        aggregated.writeStream.outputMode("update").foreachBatch(save).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def read_updates(spark: SparkSession, target: str, keys: Sequence[str] = ("recording_id", "bucket")) -> DataFrame:
    """The latest state of every bucket."""
    return last_wins(spark.read.parquet(target), list(keys), "batch").drop("batch")

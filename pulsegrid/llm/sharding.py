"""Rendezvous (highest random weight) hashing of record keys over weighted shards.

Every record scores each shard from its key and the shard's number only and goes to the
highest score. Removing or adding a shard leaves all other scores alone, so records move only
from or to that shard. With weight w and uniform u the score is -w / ln(u), which gives shards
records in proportion to their weights.

Defined cases: a null key is a key like any other; repeated keys share a shard; a shard of
weight zero gets nothing; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pulsegrid.llm.common import written

_PARTITION_SHIFT = 33  # monotonically_increasing_id keeps the partition above bit 33


def _score(keys: Sequence[Column], shard: int, weight: float) -> Column:
    drawn = F.shiftrightunsigned(F.xxhash64(*keys, F.lit(shard)), 11)
    return F.lit(-float(weight)) / F.ln((drawn.cast("double") + 0.5) / F.lit(float(2**53)))


def rendezvous(keys: Sequence[str | Column], weights: Sequence[float]) -> Column:
    """Shard number of a key among ``len(weights)`` shards."""
    if not weights or min(weights) < 0 or max(weights) <= 0:
        raise ValueError("weights must not be negative, and one must be positive")
    columns = [F.col(k) if isinstance(k, str) else k for k in keys]
    scored = [
        F.struct(_score(columns, j, w).alias("score"), F.lit(j).alias("shard"))
        for j, w in enumerate(weights)
        if w > 0
    ]
    return F.array_max(F.array(*scored))["shard"]


def with_slots(df: DataFrame, group: str, order: Sequence[str], out: str = "slot") -> DataFrame:
    """Add gapless positions from 0 inside each group, in the given order.

    Rows are range-partitioned on (group, order, row), so a huge group spreads over tasks, and
    written; each (group, partition) piece starts where the pieces before it end. The summary
    has one row per piece. Equal rows are told apart by a row number that is written first.
    """
    numbered = written(df.withColumn("_pg_row", F.monotonically_increasing_id()), "slots-rows")
    keys = [group, *order, "_pg_row"]
    laid = written(
        numbered.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_pg_at", F.monotonically_increasing_id()),
        "slots-laid",
    ).withColumn("_pg_piece", F.shiftright("_pg_at", _PARTITION_SHIFT))
    ahead = Window.partitionBy(group).orderBy("_pg_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        laid.groupBy(group, "_pg_piece")
        .agg(F.count(F.lit(1)).alias("_pg_n"), F.min("_pg_at").alias("_pg_first"))
        .withColumn("_pg_base", F.coalesce(F.sum("_pg_n").over(ahead), F.lit(0)))
        .drop("_pg_n")
    )
    return (
        laid.join(starts, [group, "_pg_piece"])
        .withColumn(out, (F.col("_pg_base") + F.col("_pg_at") - F.col("_pg_first")).cast("long"))
        .drop("_pg_row", "_pg_at", "_pg_piece", "_pg_first", "_pg_base")
    )


def shard_documents(docs: DataFrame, weights: Sequence[float], added: float = 1.0) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (with one more shard)."""
    bytes_ = F.col("text").cast("binary")
    thin = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(bytes_), F.lit(0)).cast("long").alias("text_crc32"),
    )
    placed = thin.withColumns(
        {
            "law": F.lit("key"),
            "shard": rendezvous(["doc_id"], weights).cast("int"),
            "grown_shard": rendezvous(["doc_id"], [*weights, added]).cast("int"),
        }
    )
    slotted = with_slots(placed, "shard", ["doc_id", "size", "text_crc32"])
    return slotted.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")

"""Staged, resumable loading of records with a validation gate.

Records wait as Parquet tables in staging folders, one for each hand-over; a manifest names the
records that are complete and their folder, so a batch reads its own folders only. The manifest is a file stream: every micro-batch is a set of whole records
that is validated, loaded and published. A failing record stops the stream; the checkpoint
then still points before that batch and its staging stays.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pulsegrid.plans.joins import tables_with_keys
from pulsegrid.session import materialise, named, stored
from pulsegrid.sinks import tables

KEY = "recording_id"
MANIFEST = "recording_id string, folder string"


def stage(frames: Mapping[str, DataFrame], root: str, partition: Sequence[str] = (KEY,), folder: str | None = None) -> str:
    """Write the tables of new records to a staging folder of their own; returns its name.

    Tables are partitioned by record, so that single records can be dropped.
    """
    folder = folder or uuid.uuid4().hex
    for name, df in frames.items():
        keys = [k for k in partition if k in df.columns]
        ordered = df.repartitionByRange(KEY) if keys else df
        ordered.write.mode("append").partitionBy(*keys).parquet(f"{root}/{folder}/{name}")
    return folder


def announce(records: DataFrame, root: str, folder: str) -> None:
    """Declare records of a staging folder complete; comes after their rows were staged."""
    records.select(KEY).distinct().withColumn("folder", F.lit(folder)).write.mode("append").json(f"{root}/manifest")


def staged_tables(spark: SparkSession, root: str, announced: DataFrame, names: Sequence[str]) -> dict[str, DataFrame]:
    """The tables of announced records, read from the folders that hold them and no others.

    ``announced`` is a written table. The list of its records is made once for all tables, not once for each.
    """
    folders = [r["folder"] for r in announced.select("folder").distinct().collect()]  # one for each stage() call
    frames: dict[str, DataFrame] = {}
    for name in names:
        parts = [tables.read_table(spark, f"{root}/{folder}/{name}") for folder in sorted(folders)]
        parts = [p for p in parts if p is not None]
        if parts:
            frames[name] = reduce(lambda a, b: a.unionByName(b), parts)
    keyed = [name for name, whole in frames.items() if KEY in whole.columns]
    if keyed:
        records = announced.select(KEY) if len(folders) == 1 else stored(announced.select(KEY).distinct(), "records")
        frames |= zip(keyed, tables_with_keys([frames[name] for name in keyed], records, [KEY]), strict=True)
    return frames


class ValidationFailed(RuntimeError):
    """Some records of a batch did not pass."""


def staged_ingest(
    spark: SparkSession,
    staging: str,
    store: str,
    checkpoint: str,
    validate: Callable[[Mapping[str, DataFrame]], DataFrame],
    names: Sequence[str] = tables.LOAD_ORDER,
    subjects_of: Callable[[DataFrame], DataFrame] | None = None,
    files_per_batch: int | None = None,
    orders: Mapping[str, str] | None = None,
    partition: Sequence[str] = (KEY,),
    keep_staging: bool = True,
) -> StreamingQuery:
    """Start the load of all announced records; it ends when they are done.

    ``validate`` maps the staged tables of a batch to (recording_id, status). Loading skips
    what is already there, and the log and report of a batch are written under its number,
    so a restart after any interruption repeats nothing.
    """
    manifest = spark.readStream.schema(MANIFEST)
    if files_per_batch:
        manifest = manifest.option("maxFilesPerTrigger", files_per_batch)
    stream = manifest.json(f"{staging}/manifest")

    def load(batch: DataFrame, number: int) -> None:
        announced = stored(batch.select(KEY, "folder").distinct(), "announced")
        frames = staged_tables(spark, staging, announced, names)
        if not frames:
            return  # loaded and dropped before an interruption
        if subjects_of is not None and "recordings" in frames:
            frames["subjects"] = subjects_of(frames["recordings"])
        report = materialise(validate(frames))
        report.write.mode("overwrite").parquet(f"{store}/_reports/batch={number}")
        failed = named(report.where(F.col("status") == "fail").select(KEY).distinct(), KEY)
        if failed:
            raise ValidationFailed(f"records failed validation: {failed}; see {store}/_reports/batch={number}")
        log, error = tables.load_tables(spark, frames, store, orders, partition)
        rows: list[tuple[Any, ...]] = [(r["table"], r["rows_inserted"], r["duration_sec"], i) for i, r in enumerate(log)]
        if rows:
            spark.createDataFrame(rows, "table string, rows_inserted long, duration_sec double, seq int").write.mode(
                "overwrite"
            ).parquet(f"{store}/_log/batch={number}")
        if error is not None:
            raise error
        if not keep_staging:  # staged by record, see stage()
            for folder in [r["folder"] for r in announced.select("folder").distinct().collect()]:
                for name in names:
                    tables.drop_partitions(spark, f"{staging}/{folder}/{name}", announced.where(F.col("folder") == folder))

    return (
        stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def load_log(spark: SparkSession, store: str) -> DataFrame:
    """Load log over all batches, in first-seen order."""
    return spark.read.parquet(f"{store}/_log").select(
        (F.col("batch").cast("long") * 100 + F.col("seq")).alias("seq"), "table", "rows_inserted", "duration_sec"
    )

"""Table layout and idempotent maintenance of Parquet tables."""

from __future__ import annotations

import time
from collections.abc import Iterator, Mapping, Sequence
from typing import Any

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pulsegrid.operators.joins import without_match
from pulsegrid.plans.joins import rows_with_keys
from pulsegrid.session import scratch_scope, stored

# Tables in load order, with the key that an insert must not repeat.
LOAD_ORDER = ("subjects", "recordings", "signals", "annotations_apnea", "annotations_qrs")
TABLE_KEYS = {"subjects": "subject_id", "recordings": "recording_id"}
RECORD_TABLES = ("signals", "annotations_apnea", "annotations_qrs")
KEY = "recording_id"
#: Partition column and number of folders of a table whose records are too many for a folder each.
BUCKET = "bucket"
BUCKETS = 64


def bucket_of(key: str = KEY, buckets: int = BUCKETS) -> Column:
    """Bucket of a record: the same for every row of it."""
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _fs(spark, path)
    return fs.exists(where)


def read_table(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """The table, or None when nothing was written yet or all its files are gone."""
    finish_swap(spark, path)
    if not exists(spark, path):
        return None
    reader = spark.read.schema(schema) if schema is not None else spark.read
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if "UNABLE_TO_INFER_SCHEMA" in str(error):
            return None
        raise


def layout(df: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Range partitioned and sorted on the keys.

    Ranges balance the tasks whatever the size of a record, keep a record in few files and
    give row groups narrow time ranges that a scan can skip.
    """
    columns = [F.col(k) if isinstance(k, str) else k for k in (dict.fromkeys(keys) if all(isinstance(k, str) for k in keys) else keys)]
    return df.repartitionByRange(*columns).sortWithinPartitions(*columns)


def write_table(
    df: DataFrame,
    path: str,
    sort: Sequence[str | Column] = (KEY, "recorded_at"),
    partition: Sequence[str] = (KEY,),
    mode: str = "append",
) -> int:
    """Write a table in its layout; returns the rows written."""
    seen = Observation()
    # observed above the range exchange, whose sampling reads its input a second time
    out = (layout(df, sort) if sort else df).observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = out.write.mode(mode)
    if mode == "overwrite" and partition:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if partition:
        writer = writer.partitionBy(*partition)
    writer.parquet(path)
    return int(seen.get["rows"])


def first_per_key(rows: DataFrame, key: str, order: str | None) -> DataFrame:
    """One row per key: the first by ``order``, ties and rows without an order by their content."""
    rest = [c for c in rows.columns if c != key]
    if not rest:
        return rows.distinct()
    whole = F.struct(*rest)
    best = rows.groupBy(key).agg(
        F.min(whole).alias("_first") if order is None else F.min_by(whole, F.struct(F.col(order), *rest)).alias("_first")
    )
    return best.select(key, "_first.*").select(*rows.columns)


def insert_ignore(existing: DataFrame | None, rows: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """Rows that an insert with 'on conflict do nothing' would add."""
    fresh = first_per_key(rows, key, order)
    return fresh if existing is None else without_match(fresh, existing, [key])


def append_missing_records(existing: DataFrame | None, rows: DataFrame, key: str = KEY, listed: int = 1000) -> DataFrame:
    """Rows of records that have no row at all in the table.

    The records of ``rows`` are named in the filter on the table while they are at most
    ``listed``, so the scan is pruned to their folders and row groups; with more records the
    keys are joined.
    """
    if existing is None:
        return rows
    wanted = rows.select(key).distinct().limit(listed + 1).collect()
    if len(wanted) <= listed:
        existing = existing.where(F.col(key).isin([r[0] for r in wanted if r[0] is not None]))
    return rows_with_keys(rows, existing, [key], keep=False)


def replaced_records(existing: DataFrame, rows: DataFrame, key: str = KEY) -> DataFrame:
    """The table after the records of ``rows`` were deleted and loaded anew."""
    return rows_with_keys(existing, rows, [key], keep=False).unionByName(rows)


def delete_orphans(subjects: DataFrame, recordings: DataFrame, ids: DataFrame, key: str = "subject_id") -> DataFrame:
    """Subjects left after those of the list without any recording were dropped."""
    lost = ids.select(key).distinct().join(recordings.select(key).distinct(), key, "left_anti")
    return rows_with_keys(subjects, lost, [key], keep=False)


#: Characters that Spark escapes in the name of a partition folder, besides control characters.
_ESCAPED = frozenset('"#%\'*/:=?\\{[]^\x7f')


def partition_folder(column: str, value: str | None) -> str:
    """Name of the folder of a partition value, as Spark writes it."""
    if value is None or value == "":
        return f"{column}=__HIVE_DEFAULT_PARTITION__"
    return f"{column}=" + "".join(f"%{ord(c):02X}" if c in _ESCAPED or "\x01" <= c <= "\x1f" else c for c in value)


def drop_partitions(spark: SparkSession, path: str, values: Sequence[str] | DataFrame, column: str = KEY) -> None:
    """Delete the partition folders of the given values, a list or a table with the column.

    The folders are deleted by tasks; a folder that is gone already does no harm.
    """
    if not exists(spark, path):
        return
    if not isinstance(values, DataFrame):
        values = spark.createDataFrame([(v,) for v in values], f"{column} string")
    root = qualified(spark, path)

    def drop(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        system, inner = fs.FileSystem.from_uri(root)
        for batch in batches:
            for value in batch[column]:
                where = f"{inner}/{partition_folder(column, value)}"
                if system.get_file_info(where).type == fs.FileType.Directory:
                    system.delete_dir(where)
            yield batch

    values.select(F.col(column).cast("string")).distinct().mapInPandas(drop, f"{column} string").count()


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, as Arrow reads it: executors must not guess it."""
    fs, where = _fs(spark, path)
    full = where.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toString()
    return "file://" + full[len("file:") :] if full.startswith("file:/") and not full.startswith("file://") else full


def replace_records(spark: SparkSession, path: str, rows: DataFrame, ids: Sequence[str] = (), sort: Sequence[str] = (KEY, "recorded_at")) -> int:
    """Replace whole records on disk by dynamic partition overwrite.

    Running it twice leaves the same table. Ids without new rows are deleted, after the new
    rows were committed: an interruption leaves old rows, never a gap.
    """
    count = write_table(rows, path, sort, (KEY,), "overwrite")
    if ids:
        wanted = spark.createDataFrame([(i,) for i in ids], f"{KEY} string")
        drop_partitions(spark, path, wanted.join(rows.select(KEY).distinct(), KEY, "left_anti"))
    return count


def write_buckets(df: DataFrame, path: str, sort: Sequence[str] = (KEY, "recorded_at"), mode: str = "append", buckets: int = BUCKETS) -> int:
    """Write a table in a fixed number of folders, each with the whole records of one hash bucket."""
    return write_table(df.withColumn(BUCKET, bucket_of(buckets=buckets)), path, (BUCKET, *sort), (BUCKET,), mode)


def replace_in_buckets(
    spark: SparkSession, path: str, rows: DataFrame, ids: Sequence[str] = (), sort: Sequence[str] = (KEY, "recorded_at"), buckets: int = BUCKETS
) -> int:
    """Replace whole records of a table that ``write_buckets`` made; returns the rows written for them.

    The buckets of these records are written anew, with the rows of their other records, and take the place of the old ones in one
    commit. Ids without new rows are deleted. Running it twice leaves the same table.
    """
    with scratch_scope(spark):
        fresh = stored(rows.withColumn(BUCKET, bucket_of(buckets=buckets)), "fresh")
        gone = spark.createDataFrame([(i,) for i in ids], f"{KEY} string")
        keys = fresh.select(F.col(KEY).cast("string").alias(KEY)).unionByName(gone).distinct()
        touched = [r[0] for r in keys.select(bucket_of(buckets=buckets)).distinct().collect()]
        if exists(spark, path):
            old = spark.read.parquet(path).where(F.col(BUCKET).isin(touched))
            whole = old.join(keys.withColumnRenamed(KEY, "_key"), F.col(KEY).cast("string").eqNullSafe(F.col("_key")), "left_anti").unionByName(fresh)
        else:
            whole = fresh
        whole = stored(whole, "replaced")
        write_table(whole, path, (BUCKET, *sort), (BUCKET,), "overwrite")
        filled = {r[0] for r in whole.select(BUCKET).distinct().collect()}
        drop_partitions(spark, path, [str(b) for b in touched if b not in filled], BUCKET)
        return fresh.count()


def cleanup_records(spark: SparkSession, root: str, ids: Sequence[str]) -> None:
    """Delete the records from every table, then their subjects if nothing refers to them."""
    for name in RECORD_TABLES:
        drop_partitions(spark, f"{root}/{name}", ids)
    recordings = read_table(spark, f"{root}/recordings")
    subjects = read_table(spark, f"{root}/subjects")
    if recordings is None:
        return
    gone = recordings.where(F.col(KEY).isin(list(ids))).select("subject_id").distinct()
    kept = recordings.where(~F.col(KEY).isin(list(ids)))
    if subjects is not None:
        rewrite(spark, delete_orphans(subjects, kept, gone), f"{root}/subjects")
    rewrite(spark, kept, f"{root}/recordings")


def rewrite(spark: SparkSession, df: DataFrame, path: str) -> None:
    """Replace a small table that the rows are read from: write beside it, then swap.

    The former table stays until the new one is in its place; ``finish_swap`` completes a swap
    that was interrupted.
    """
    finish_swap(spark, path)
    df.write.mode("overwrite").parquet(f"{path}.next")
    fs, target = _fs(spark, path)
    if fs.exists(target):
        fs.rename(target, _fs(spark, f"{path}.old")[1])
    finish_swap(spark, path)


def finish_swap(spark: SparkSession, path: str) -> None:
    """Put a new table in its place if the former one was moved away, then drop the former one."""
    fs, target = _fs(spark, path)
    _, fresh = _fs(spark, f"{path}.next")
    _, old = _fs(spark, f"{path}.old")
    if not fs.exists(target):
        if fs.exists(_fs(spark, f"{path}.next/_SUCCESS")[1]):
            fs.rename(fresh, target)
        elif fs.exists(old):
            fs.rename(old, target)
    if fs.exists(target) and fs.exists(old):
        fs.delete(old, True)


def load_tables(
    spark: SparkSession,
    frames: Mapping[str, DataFrame],
    root: str,
    orders: Mapping[str, str] | None = None,
    partition: Sequence[str] = (KEY,),
) -> tuple[list[dict[str, Any]], Exception | None]:
    """Load the tables in order, one commit each, and log rows and seconds.

    Keys and records that are already there are skipped, so a load may be repeated after an
    interruption. On an error the failing table keeps its former state (the write commits
    as a whole), later tables are not loaded, and the error is returned with the log.
    """
    log: list[dict[str, Any]] = []
    for name in LOAD_ORDER:
        if name not in frames:
            continue
        started = time.perf_counter()
        try:
            existing = read_table(spark, f"{root}/{name}")
            if name in TABLE_KEYS:
                rows = insert_ignore(existing, frames[name], TABLE_KEYS[name], (orders or {}).get(name))
                count = write_table(rows, f"{root}/{name}", (), ())
            else:
                rows = append_missing_records(existing, frames[name])
                count = write_table(rows, f"{root}/{name}", partition=partition)
        except Exception as error:  # noqa: BLE001 - reported to the caller with the log
            return log, error
        log.append({"table": name, "rows_inserted": count, "duration_sec": time.perf_counter() - started})
    return log, None


def chunk_of(ts: str = "recorded_at", unit: str = "hour") -> Column:
    """Time chunk of a row as partition text."""
    return F.date_format(F.date_trunc(unit, F.col(ts)), "yyyy-MM-dd-HH" if unit == "hour" else "yyyy-MM-dd")


def chunk_counts(df: DataFrame, unit: str = "hour", keys: Sequence[str] = (KEY,)) -> DataFrame:
    """Rows per chunk."""
    return df.groupBy(*keys, chunk_of(unit=unit).alias("chunk")).agg(F.count(F.lit(1)).alias("n"))


def write_chunked(
    df: DataFrame, path: str, unit: str = "hour", mode: str = "overwrite", folders: Sequence[str] = (KEY, "chunk")
) -> int:
    """Table partitioned by record and time chunk (hours for signals, days for annotations).

    ``folders=("chunk",)`` keeps many short records together: fewer, larger files, in which the
    sort by record lets a scan skip row groups.
    """
    return write_table(df.withColumn("chunk", chunk_of(unit=unit)), path, (*folders, KEY, "recorded_at"), folders, mode)


def scan_chunks(spark: SparkSession, path: str, record: str, start: str, end: str, unit: str = "hour") -> DataFrame:
    """Rows of a record in [start, end) with the chunk predicate that prunes folders."""
    pattern = "yyyy-MM-dd-HH" if unit == "hour" else "yyyy-MM-dd"
    edge = lambda t: F.date_format(F.lit(t).cast("timestamp"), pattern)
    df = spark.read.parquet(path)
    kind = df.schema["recorded_at"].dataType
    return df.where(
        (F.col(KEY) == record) & (F.col("chunk") >= edge(start)) & (F.col("chunk") <= edge(end))
        & (F.col("recorded_at") >= F.lit(start).cast(kind)) & (F.col("recorded_at") < F.lit(end).cast(kind))
    )


def compact_layout(spark: SparkSession, source: str, target: str) -> int:
    """Rewrite signals by record, newest first, with strong compression.

    Records lie beside each other in files that follow the number of rows, not the number of records; a scan of a
    record skips the row groups of the others.
    """
    rows = spark.read.parquet(source)
    columns = [F.col(KEY), F.col("recorded_at").desc()]
    seen = Observation()
    out = layout(rows, columns).observe(seen, F.count(F.lit(1)).alias("rows"))
    out.write.mode("overwrite").option("compression", "zstd").parquet(target)
    return int(seen.get["rows"])


def stored_bytes(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """Bytes and files of a table; contents are not read."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    )
    return files.select("length").agg(
        F.coalesce(F.sum("length"), F.lit(0)).alias("n_bytes"), F.count(F.lit(1)).alias("n_files")
    )


def storage_report(spark: SparkSession, before: Mapping[str, str], after: Mapping[str, str]) -> DataFrame:
    """Bytes before and after, their ratio (NULL for nothing after) and files, per table and total."""
    parts = None
    for name in before:
        pre = stored_bytes(spark, before[name]).select(F.lit(name).alias("table"), F.col("n_bytes").alias("bytes_before"))
        post = stored_bytes(spark, after.get(name, before[name])).select(
            F.lit(name).alias("table"), F.col("n_bytes").alias("bytes_after"), F.col("n_files").alias("chunks")
        )
        row = pre.join(post, "table")
        parts = row if parts is None else parts.unionByName(row)
    total = parts.rollup("table").agg(
        F.sum("bytes_before").alias("bytes_before"), F.sum("bytes_after").alias("bytes_after"), F.sum("chunks").alias("chunks")
    )
    return total.select(
        F.coalesce("table", F.lit("total")).alias("table"), "bytes_before", "bytes_after", "chunks",
        F.when(F.col("bytes_after") > 0, F.col("bytes_before") / F.col("bytes_after")).alias("ratio"),
    )

"""Queries that run as Structured Streaming jobs over the given tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from pulsegrid.catalog import feeds, raw, streams
from pulsegrid.catalog.registry import query, rounded
from pulsegrid.catalog.stores import all_frames
from pulsegrid.operators import benchlog as bl
from pulsegrid.operators import validation as va
from pulsegrid.schema import EXTRA_CHANNELS
from pulsegrid.session import scratch_path, stored
from pulsegrid.streaming import checks, ingest, live, raw_source


@query(
    "st03_stream_bucket_stats",
    f"""SELECT {feeds.RECORD_SQL.format('user_id')} AS recording_id, date_trunc('day', ts)::TIMESTAMP AS bucket, round(avg(value), 6) AS avg_value,
       min(value) AS min_value, max(value) AS max_value, count(*) AS n FROM events GROUP BY 1, 2""",
)
def stream_bucket_stats(spark, sf):
    schema = feeds.table(spark, sf, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    rows = stream.select(
        feeds.record_name(F.col("user_id")).alias("recording_id"), F.col("ts").cast("timestamp").alias("recorded_at"),
        F.col("value").alias("ecg_value"),
    )
    target, checkpoint = scratch_path(spark, "live"), scratch_path(spark, "live-state")
    live.start_updates(live.stream_bucket_stats(rows, "1 day", "40 days"), target, checkpoint).awaitTermination()
    out = live.read_updates(spark, target)
    return rounded(out.withColumn("bucket", F.col("bucket").cast("timestamp_ntz")), "avg_value")


def announced_ids(frames):
    """Every record id that a table of the hand-over carries."""
    ids = [f.select("recording_id") for f in frames.values() if "recording_id" in f.columns]
    return reduce(lambda a, b: a.unionByName(b), ids).distinct()


def always(status):
    return lambda f: f["signals"].groupBy("recording_id").count().select("recording_id", F.lit(status).alias("status"))


@query(
    "st01_staged_ingest",
    f"""WITH {feeds.SIGNALS_SQL}, {feeds.LABELS_SQL}, {feeds.BEATS_SQL}, {feeds.RECORDINGS_SQL}, {feeds.SUBJECTS_SQL}
       SELECT 'signals' AS "table", count(*) AS rows_inserted FROM sig UNION ALL SELECT 'annotations_apnea', count(*) FROM lab
       UNION ALL SELECT 'annotations_qrs', count(*) FROM beat UNION ALL SELECT 'recordings', count(*) FROM rec
       UNION ALL SELECT 'subjects', count(*) FROM sub""",
)
def staged_ingest(spark, sf):
    """Stage all records, load them in micro-batches, run the load again, add up the log."""
    staging, store = scratch_path(spark, "staging"), scratch_path(spark, "store")
    frames = all_frames(spark, sf)
    folder = ingest.stage(frames, staging, ())
    ingest.announce(announced_ids(frames).repartition(2, "recording_id"), staging, folder)
    checkpoint = scratch_path(spark, "staging-state")
    for _ in range(2):
        ingest.staged_ingest(
            spark, staging, store, checkpoint, always("pass"), files_per_batch=4, partition=()
        ).awaitTermination()
    return bl.merge_load_logs(ingest.load_log(spark, store)).select("table", "rows_inserted")


@query(
    "st02_resume",
    f"""WITH {feeds.SIGNALS_SQL}, {feeds.LABELS_SQL}, {feeds.BEATS_SQL}, {feeds.RECORDINGS_SQL}, {feeds.SUBJECTS_SQL}
       SELECT 'signals' AS "table", recording_id AS "key", count(*) AS n FROM sig GROUP BY 2
       UNION ALL SELECT 'annotations_apnea', recording_id, count(*) FROM lab GROUP BY 2
       UNION ALL SELECT 'annotations_qrs', recording_id, count(*) FROM beat GROUP BY 2
       UNION ALL SELECT 'recordings', recording_id, count(*) FROM rec GROUP BY 2
       UNION ALL SELECT 'subjects', subject_id, count(*) FROM sub GROUP BY 2""",
)
def resume(spark, sf):
    """A load that breaks in its first batch and is resumed from the same checkpoint."""
    staging, store = scratch_path(spark, "staging"), scratch_path(spark, "store")
    frames = all_frames(spark, sf)
    ingest.announce(announced_ids(frames), staging, ingest.stage(frames, staging, ()))
    checkpoint = scratch_path(spark, "staging-state")
    broken = ingest.staged_ingest(spark, staging, store, checkpoint, always("fail"), partition=())
    try:
        broken.awaitTermination()
    except Exception as error:  # noqa: BLE001 - the first run is meant to stop
        if "failed validation" not in str(error):
            raise
    ingest.staged_ingest(spark, staging, store, checkpoint, always("pass"), partition=()).awaitTermination()
    counted = [
        spark.read.parquet(f"{store}/{name}")
        .groupBy(F.col("subject_id" if name == "subjects" else "recording_id").alias("key"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("table", F.lit(name))
        for name in frames
    ]
    return reduce(lambda a, b: a.unionByName(b), counted)


def fed(spark, rows, part, n, schema=None):
    """A stream of ``n`` micro-batches: the rows with part 0, 1, ..., written one after another."""
    folder = scratch_path(spark, "feed")
    held = stored(rows.withColumn("_part", part))
    for i in range(n):
        held.where(F.col("_part") == i).drop("_part").coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(folder)


@query("val01_stream_checks", f"WITH {streams.SIG}, {streams.META_SQL}, {streams.VSIG_SQL} SELECT * FROM vs")
def stream_checks(spark, sf):
    """The report of ``val01_validate_signals``, counted with state over three micro-batches."""
    signals = feeds.clean_signals(spark, sf).select("recording_id", "row_id", "sample_index", "recorded_at", *EXTRA_CHANNELS)
    bounds = signals.agg(F.max("row_id").alias("m")).first()["m"] or 0
    stream = fed(spark, signals, F.least(F.floor(3 * F.col("row_id") / (bounds + 1)), F.lit(2)), 3)
    target = scratch_path(spark, "checks")
    counted = checks.record_checks(stream, "row_id", extra=F.coalesce(*EXTRA_CHANNELS).isNotNull())
    checks.start(counted, target, scratch_path(spark, "checks-state")).awaitTermination()
    meta = streams.record_metadata(spark, sf)
    measured = checks.current_checks(spark, target)
    stamps = {c: F.col(c).cast("timestamp_ntz") for c in ("first_timestamp", "last_timestamp")}
    return streams.flat(va.signal_report(measured.withColumns(stamps), meta, streams.expectation(spark, sf, meta)))


@query("ext01_live_segments", streams.EXT01_SQL)
def live_segments(spark, sf):
    """The segments of ``ext01_flagged_segments`` from windows that come in the order of a hash, in three micro-batches."""
    scored = streams.scored_windows(spark, sf)
    late = scored.withColumn("window_start_at", F.timestamp_add("MINUTE", F.col("minute_index").cast("int"), F.lit("2000-01-01").cast("timestamp")))
    spread = F.pmod(F.xxhash64("recording_id", "minute_index"), F.lit(3))
    stream = fed(spark, late, spread, 3)
    target = scratch_path(spark, "segments")
    made = checks.live_segments(stream, "100000 days", "2000-01-01")
    checks.start(made, target, scratch_path(spark, "segments-state")).awaitTermination()
    return checks.current_segments(spark, target)


@query(
    "st01_raw_folder",
    f"""WITH {raw.RAW} SELECT recording_id, count(*) AS n, round(sum(round_even(value * 10, 0) / 100.0::DOUBLE), 4) AS main_sum,
       round(sum(CASE WHEN extra THEN round_even(value * 5, 0) / 50.0::DOUBLE END), 4) AS spo2_sum
       FROM ev JOIN rc USING (recording_id, number) WHERE sample_index < n - short GROUP BY 1""",
)
def raw_folder(spark, sf):
    """A raw folder as a stream of complete records, run twice; the second run finds nothing new."""
    root, ledger, target, state = raw.write_raw(spark, sf), *(scratch_path(spark, n) for n in ("ledger", "decoded", "decoded-state"))
    for _ in range(2):
        stream = raw_source.raw_stream(spark, root, ledger)
        raw_source.start_decoding(stream, target, state).awaitTermination()
    sums = spark.read.parquet(target).groupBy("recording_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("ecg_value").alias("main_sum"), F.sum("spo2").alias("spo2_sum")
    )
    return rounded(sums, "main_sum", "spo2_sum", digits=4)

"""Queries that write tables or files derived from the driver's tables and read them back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from pulsegrid.catalog import feeds
from pulsegrid.catalog.registry import query, rounded
from pulsegrid.catalog.scores import LATENCY, LOG, TIMES, load_log, timings
from pulsegrid.catalog.streams import WSUM_SQL, day_windows, label_rows
from pulsegrid.functions import text
from pulsegrid.operators import filters as fl
from pulsegrid.operators import metrics as me
from pulsegrid.operators import reports as rp
from pulsegrid.schema import CHANNELS, SIGNALS
from pulsegrid.session import scratch_path
from pulsegrid.sinks import exports, tables
from pulsegrid.sources import files, readers

SIG, LAB, BEAT, REC, SUB = (
    feeds.SIGNALS_SQL, feeds.LABELS_SQL, feeds.BEATS_SQL, feeds.RECORDINGS_SQL, feeds.SUBJECTS_SQL,
)


def signal_table(spark, sf):
    return feeds.clean_signals(spark, sf).select("recording_id", "sample_index", "recorded_at", *CHANNELS)


def all_frames(spark, sf):
    recordings = feeds.recordings(spark, sf).select("recording_id", "subject_id", "split", "row_id")
    subjects = feeds.subjects(spark, sf).select("subject_id", "notes")
    labels = label_rows(spark, sf).withColumnRenamed("label_at", "recorded_at").drop("minute_index")
    return {
        "subjects": subjects, "recordings": recordings, "signals": signal_table(spark, sf),
        "annotations_apnea": labels, "annotations_qrs": feeds.beats(spark, sf),
    }


@query(
    "snk01_load_tables",
    f"""WITH {SIG}, {LAB}, {BEAT}, {REC}, {SUB}, n AS (
         SELECT 'subjects' AS "table", count(DISTINCT subject_id) AS k FROM sub UNION ALL SELECT 'recordings', count(DISTINCT recording_id) FROM rec
         UNION ALL SELECT 'signals', count(*) FROM sig UNION ALL SELECT 'annotations_apnea', count(*) FROM lab
         UNION ALL SELECT 'annotations_qrs', count(*) FROM beat)
       SELECT "table", k AS first_load, 0::BIGINT AS second_load, k AS stored FROM n""",
)
def load_tables(spark, sf):
    """Rows of a load, of the same load again, and rows stored after both."""
    root = scratch_path(spark, "store")
    frames = all_frames(spark, sf)
    logs = []
    for _ in range(2):
        log, error = tables.load_tables(spark, frames, root, {"recordings": "row_id"}, partition=())
        if error:
            raise error
        logs.append({r["table"]: r["rows_inserted"] for r in log})
    stored = None
    for name in tables.LOAD_ORDER:
        part = spark.read.parquet(f"{root}/{name}").agg(F.count(F.lit(1)).alias("stored")).select(
            F.lit(name).alias("table"), F.lit(logs[0][name]).cast("long").alias("first_load"),
            F.lit(logs[1][name]).cast("long").alias("second_load"), "stored",
        )
        stored = part if stored is None else stored.unionByName(part)
    return stored


@query(
    "snk02_insert_ignore",
    f"""WITH {REC}, {SUB}, f AS (SELECT subject_id, 'Derived from ' || arg_min(recording_id, row_id) AS notes FROM rec GROUP BY 1)
       SELECT subject_id, notes FROM sub WHERE active
       UNION ALL SELECT subject_id, notes FROM f WHERE subject_id NOT IN (SELECT subject_id FROM sub WHERE active)""",
)
def insert_ignore(spark, sf):
    existing = feeds.subjects(spark, sf).where("active").select("subject_id", "notes")
    rows = feeds.recordings(spark, sf).select(
        "subject_id", F.concat(F.lit("Derived from "), "recording_id").alias("notes"), "row_id"
    )
    return existing.unionByName(tables.insert_ignore(existing, rows, "subject_id", "row_id").drop("row_id"))


@query(
    "snk03_append_missing_records",
    f"""WITH {SIG}, have AS (SELECT DISTINCT recording_id FROM sig WHERE ecg_value > 250)
       SELECT recording_id, row_id, ecg_value FROM sig WHERE recording_id NOT IN (SELECT recording_id FROM have)""",
)
def append_missing_records(spark, sf):
    signals = feeds.clean_signals(spark, sf).select("recording_id", "row_id", "ecg_value")
    return tables.append_missing_records(signals.where("ecg_value > 250"), signals)


@query(
    "snk04_replace_records",
    f"""WITH {SIG} SELECT recording_id, sample_index, recorded_at,
         CASE WHEN recording_id LIKE 'b%' THEN ecg_value * 2 ELSE ecg_value END AS ecg_value FROM sig""",
)
def replace_records(spark, sf):
    """Write all records, replace those of category b on disk twice, read everything back."""
    path = scratch_path(spark, "signals")
    signals = signal_table(spark, sf).select("recording_id", "sample_index", "recorded_at", "ecg_value")
    tables.write_buckets(signals, path)
    fresh = signals.where(text.category(F.col("recording_id")) == "b").withColumn("ecg_value", F.col("ecg_value") * 2)
    for _ in range(2):
        tables.replace_in_buckets(spark, path, fresh)
    return spark.read.parquet(path).select("recording_id", "sample_index", "recorded_at", "ecg_value")


@query(
    "snk04_replaced_records",
    f"""WITH {SIG} SELECT recording_id, row_id, CASE WHEN recording_id LIKE 'b%' THEN -row_id ELSE row_id END AS value FROM sig""",
)
def replaced_records(spark, sf):
    rows = feeds.raw_signals(spark, sf).select("recording_id", "row_id", F.col("row_id").alias("value"))
    fresh = rows.where(text.category(F.col("recording_id")) == "b").withColumn("value", -F.col("value"))
    return tables.replaced_records(rows, fresh)


@query(
    "snk05_delete_orphans",
    f"""WITH {REC}, {SUB} SELECT subject_id, notes FROM sub WHERE NOT (active AND subject_id NOT IN
       (SELECT subject_id FROM rec WHERE split = 'test'))""",
)
def delete_orphans(spark, sf):
    subjects = feeds.subjects(spark, sf)
    kept = feeds.recordings(spark, sf).where(F.col("split") == "test")
    return tables.delete_orphans(subjects, kept, subjects.where("active")).select("subject_id", "notes")


@query(
    "snk06_write_artifacts",
    f"""WITH {SIG} SELECT recording_id, sample_index, strftime(recorded_at, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS recorded_at,
       {', '.join(CHANNELS)} FROM sig""",
)
def write_artifacts(spark, sf):
    """The raw lines of the written artifacts, taken apart as JSON."""
    root = scratch_path(spark, "artifacts")
    exports.write_artifacts({"signals": signal_table(spark, sf)}, root)
    lines = spark.read.text(f"{root}/signals", recursiveFileLookup=True)
    cells = F.json_tuple("value", "recording_id", "sample_index", "recorded_at", *CHANNELS).alias(
        "id", "sample_index", "recorded_at", *CHANNELS
    )
    return lines.select(cells).select(
        F.col("id").alias("recording_id"), F.col("sample_index").cast("long"), "recorded_at",
        *[F.col(c).cast("double") for c in CHANNELS],
    )


def artifact_streams(spark, sf):
    """Signals, labels, beats and windows, as they go to artifacts."""
    windows = day_windows(spark, sf).select("recording_id", "minute_index", F.col("window_start_at").alias("recorded_at"), "sample_count", "apnea_label", "qrs_count")
    labels = label_rows(spark, sf).select("recording_id", "minute_index", F.col("label_at").alias("recorded_at"), "label")
    beats = feeds.beats(spark, sf).select("recording_id", "sample_index", "recorded_at")
    return {"signals": signal_table(spark, sf), "apnea": labels, "qrs": beats, "windows": windows}


@query(
    "snk06_write_all_streams",
    f"""WITH {WSUM_SQL}, a AS (
         SELECT 'signals' AS stream, recording_id, recorded_at, sample_index AS place FROM sig
         UNION ALL SELECT 'apnea', recording_id, recorded_at, minute_index FROM mlab
         UNION ALL SELECT 'qrs', recording_id, recorded_at, sample_index FROM beat
         UNION ALL SELECT 'windows', recording_id, TIMESTAMP '{feeds.BASE}' + to_seconds(minute_index * {feeds.WIDTH}), minute_index FROM wins)
       SELECT stream, recording_id, count(*) AS n, sum(place)::BIGINT AS places, strftime(min(recorded_at), '%Y-%m-%dT%H:%M:%S') AS first_at FROM a GROUP BY 1, 2""",
)
def write_all_streams(spark, sf):
    """All four streams written as artifacts; their lines read back and summed up per record."""
    root = scratch_path(spark, "artifacts")
    exports.write_artifacts(artifact_streams(spark, sf), root)
    out = None
    for stream, place in (("signals", "sample_index"), ("apnea", "minute_index"), ("qrs", "sample_index"), ("windows", "minute_index")):
        cells = F.json_tuple("value", "recording_id", place, "recorded_at").alias("id", "place", "at")
        part = spark.read.text(f"{root}/{stream}", recursiveFileLookup=True).select(cells).groupBy(F.lit(stream).alias("stream"), F.col("id").alias("recording_id")).agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.col("place").cast("long")).alias("places"), F.substring(F.min("at"), 1, 19).alias("first_at")
        )
        out = part if out is None else out.unionByName(part)
    return out


@query("src05_read_jsonl", f"WITH {SIG} SELECT recording_id, sample_index, recorded_at, {', '.join(CHANNELS)} FROM sig")
def read_jsonl(spark, sf):
    root = scratch_path(spark, "artifacts")
    exports.write_artifacts({"signals": signal_table(spark, sf)}, root)
    back = readers.read_jsonl(spark, f"{root}/signals", SIGNALS, recursive=True)
    return back.withColumn("recorded_at", F.col("recorded_at").cast("timestamp_ntz"))


@query("src08_discover_records", f"WITH {SIG}, {LAB}, {BEAT} SELECT recording_id FROM lab UNION SELECT recording_id FROM sig UNION SELECT recording_id FROM beat")
def discover_records(spark, sf):
    root = scratch_path(spark, "artifacts")
    exports.write_artifacts(
        {"signals": signal_table(spark, sf), "apnea": feeds.minute_labels(spark, sf), "qrs": feeds.beats(spark, sf)}, root
    )
    listed = files.list_files(spark, root, "*.txt")
    return files.discover_records(listed, packed=files.packed_records(spark, root, listed))


@query(
    "src01_read_headers",
    f"""WITH {SIG}, c AS (SELECT recording_id, count(*) AS n, bool_or(has_respiration) AS h FROM sig GROUP BY 1)
       SELECT recording_id AS record_name, 100 AS sampling_rate_hz, n AS num_samples,
              CASE WHEN h THEN 'ECG,Resp C,SpO2' ELSE 'ECG' END AS signals FROM c""",
)
def read_headers(spark, sf):
    """Header texts written for every record of the signals, read back."""
    root = scratch_path(spark, "headers")
    counts = feeds.raw_signals(spark, sf).groupBy("recording_id").agg(
        F.count(F.lit(1)).alias("n"), F.max("has_respiration").alias("h")
    )
    line = lambda file, name: F.concat(F.col("recording_id"), F.lit(f"{file}.dat 16 200 12 0 -12 -12 0 {name}"))
    body = F.concat_ws(
        "\n", F.lit("# header"), F.concat_ws(" ", "recording_id", F.when(F.col("h"), "3").otherwise("1"), F.lit("100.0"), F.col("n").cast("string")),
        line("", "ECG"), F.when(F.col("h"), line("r", "Resp C")), F.when(F.col("h"), line("r", "SpO2")),
    )
    exports.write_headers(counts.select(body.alias("value")), root)
    parsed = readers.read_headers(spark, root, separator=readers.HEADER_END)
    return parsed.select("record_name", "sampling_rate_hz", "num_samples", F.array_join("signals", ",").alias("signals"))


@query(
    "src04_read_samples",
    """SELECT round_even(value * 40, 0) / 200 AS value, count(*) AS n FROM events GROUP BY 1""",
)
def read_samples(spark, sf):
    """Values written as 16-bit files by the tasks (32-bit if 16 bits cannot hold one), read back and counted."""
    root = scratch_path(spark, "samples")
    values = feeds.table(spark, sf, "events").select((F.col("value") / 5).alias("value"))
    bits = exports.sample_bits(values, "value")
    exports.write_samples(values, "value", root, bits=bits).collect()
    back = readers.read_samples(spark, root, ["value"], range_bytes=10_000, bits=bits)
    return back.groupBy("value").agg(F.count(F.lit(1)).alias("n"))


@query(
    "snk07_write_csv_tables",
    f"""WITH {feeds.PREDICTIONS_SQL} SELECT recording_id, count(*) AS n_windows, round(avg(score), 4) AS mean_score FROM pred GROUP BY 1""",
)
def write_csv_tables(spark, sf):
    root = scratch_path(spark, "report")
    table = me.record_anomaly_pct(feeds.predictions(spark, sf)).select("recording_id", "n_windows", "mean_score")
    exports.write_csv_tables({"records": rounded(table, "mean_score", digits=4)}, root)
    return spark.read.schema("recording_id string, n_windows long, mean_score double").option("header", "true").csv(f"{root}/records")


def csv_again(spark, frame, name):
    """A report table written as CSV and read back with its own types."""
    root = scratch_path(spark, "report")
    exports.write_csv_tables({name: frame}, root)
    return spark.read.schema(frame.schema).option("header", "true").csv(f"{root}/{name}")


@query(
    "snk07_latency_csv",
    f"""WITH {TIMES}, tp AS (SELECT test_name, record_id, ms, CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 0 ELSE 1 END AS part FROM tm), {LATENCY}
       SELECT test_name, round(a.avg_ms, 4) AS first_avg_ms, round(b.avg_ms, 4) AS second_avg_ms, round(a.p95_ms, 4) AS first_p95_ms, round(b.p95_ms, 4) AS second_p95_ms
       FROM (SELECT * FROM ls WHERE part = 0) a FULL JOIN (SELECT * FROM ls WHERE part = 1) b USING (test_name)""",
)
def latency_csv(spark, sf):
    t, early = timings(spark, sf), F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    made = rp.latency_table({"first": t.where(early), "second": t.where(~early)})
    return csv_again(spark, rounded(made, *[c for c in made.columns if c != "test_name"], digits=4), "latency")


@query(
    "snk07_throughput_csv",
    f"""WITH {LOG} SELECT CASE WHEN seq % 2 = 0 THEN 'even' ELSE 'odd' END AS database, CAST(sum(rows_inserted) AS BIGINT) AS rows_inserted,
       round(sum(duration_sec), 4) AS duration_sec, round(sum(rows_inserted) / sum(duration_sec), 4) AS rows_per_sec FROM lg
       WHERE "table" IN ('signals', 'annotations_apnea', 'annotations_qrs') GROUP BY 1""",
)
def throughput_csv(spark, sf):
    log = load_log(spark, sf)
    made = rp.throughput_table({"even": log.where("seq % 2 = 0"), "odd": log.where("seq % 2 = 1")})
    return csv_again(spark, rounded(made, "duration_sec", "rows_per_sec", digits=4), "throughput")


@query("snk07_storage_csv")
def storage_csv(spark, sf):
    """Bytes of all record tables, plain and compacted: they differ from run to run, so there is no SQL."""
    plain, compact = scratch_path(spark, "plain"), scratch_path(spark, "compact")
    frames = all_frames(spark, sf)
    for name in tables.RECORD_TABLES:
        frames[name].write.option("compression", "none").parquet(f"{plain}/{name}")
        tables.compact_layout(spark, f"{plain}/{name}", f"{compact}/{name}")
    return csv_again(spark, rp.storage_table(spark, {"plain": plain, "compact": compact}), "storage")


@query(
    "snk07_predictions_csv",
    f"""WITH {feeds.PREDICTIONS_SQL} SELECT 'independent' AS protocol, 'length' AS method, split, row_number() OVER (PARTITION BY split ORDER BY row_id) - 1 AS "index",
       recording_id, y_true, y_pred, score FROM pred""",
)
def predictions_csv(spark, sf):
    made = rp.window_prediction_table(feeds.predictions(spark, sf), "independent", "length", "row_id")
    return csv_again(spark, made, "predictions")


@query(
    "snk08_versioned_cache",
    f"""WITH {feeds.WINDOWS_SQL} SELECT window_id, y, used.reused FROM win, (VALUES (FALSE), (TRUE)) used(reused)""",
)
def versioned_cache(spark, sf):
    """The same result built and then reused."""
    root = scratch_path(spark, "cache")
    windows = feeds.windows(spark, sf)
    ask = lambda: exports.versioned_cache(
        spark, root, windows, ["y", "recording_id", "window_start", "split"], lambda: windows.select("window_id", "y"), "v1", 16, "robust"
    )
    first, built = ask()
    second, reused = ask()
    return first.withColumn("reused", F.lit(built)).unionByName(second.withColumn("reused", F.lit(reused)))


@query(
    "snk09_compact_layout",
    f"""WITH {SIG} SELECT recording_id, sample_index, recorded_at, ecg_value FROM sig""",
)
def compact_layout(spark, sf):
    source, target = scratch_path(spark, "plain"), scratch_path(spark, "compact")
    signal_table(spark, sf).select("recording_id", "sample_index", "recorded_at", "ecg_value").write.parquet(source)
    tables.compact_layout(spark, source, target)
    return spark.read.parquet(target).select("recording_id", "sample_index", "recorded_at", "ecg_value")


@query(
    "snk09_storage_report",
    f"""WITH {SIG}, {LAB}, {BEAT}, n AS (SELECT 'signals' AS "table", count(*) AS stored FROM sig
         UNION ALL SELECT 'annotations_apnea', count(*) FROM lab UNION ALL SELECT 'annotations_qrs', count(*) FROM beat)
       SELECT "table", stored, TRUE AS has_bytes, TRUE AS ratio_holds, TRUE AS has_chunks FROM n
       UNION ALL SELECT 'total', sum(stored)::BIGINT, TRUE, TRUE, TRUE FROM n""",
)
def storage_report(spark, sf):
    """Rows, and what holds of the sizes: bytes differ from run to run."""
    before, after, counts = {}, {}, []
    for name in tables.RECORD_TABLES:
        before[name], after[name] = scratch_path(spark, "plain"), scratch_path(spark, "compact")
        all_frames(spark, sf)[name].write.option("compression", "none").parquet(before[name])
        tables.compact_layout(spark, before[name], after[name])
        counts.append(spark.read.parquet(after[name]).agg(F.count(F.lit(1)).alias("stored")).withColumn("table", F.lit(name)))
    rows = reduce(lambda a, b: a.unionByName(b), counts)
    rows = rows.rollup("table").agg(F.sum("stored").alias("stored")).withColumn("table", F.coalesce("table", F.lit("total")))
    ratio = F.abs(F.col("ratio") - F.col("bytes_before") / F.col("bytes_after")) < 1e-12
    report = tables.storage_report(spark, before, after)
    return rows.join(report, "table").select(
        "table", "stored", ((F.col("bytes_before") > 0) & (F.col("bytes_after") > 0)).alias("has_bytes"), ratio.alias("ratio_holds"),
        (F.col("chunks") > 0).alias("has_chunks"),
    )


@query("snk09_storage_bytes")
def storage_bytes(spark, sf):
    """Bytes before and after compaction, files and ratio of each record table and of all."""
    before, after = {}, {}
    for name in tables.RECORD_TABLES:
        before[name], after[name] = scratch_path(spark, "plain"), scratch_path(spark, "compact")
        all_frames(spark, sf)[name].write.option("compression", "none").parquet(before[name])
        tables.compact_layout(spark, before[name], after[name])
    return tables.storage_report(spark, before, after)


@query(
    "snk10_export",
    f"""WITH {REC}, {SUB} SELECT name, "mode", n FROM (VALUES ('recordings', 'schema'), ('recordings', 'data'), ('subjects', 'schema'),
         ('subjects', 'data')) m(name, "mode") JOIN (SELECT 'recordings' AS name, count(*) AS n FROM rec UNION ALL SELECT 'subjects', count(*) FROM sub)
         USING (name)""",
)
def export(spark, sf):
    root = scratch_path(spark, "export")
    given = {"recordings": feeds.recordings(spark, sf), "subjects": feeds.subjects(spark, sf)}
    manifest = exports.export(spark, given, root, "full").select("name", "mode")
    back = None
    for name in given:
        part = spark.read.parquet(f"{root}/{name}_data").agg(F.count(F.lit(1)).alias("n")).withColumn("name", F.lit(name))
        back = part if back is None else back.unionByName(part)
    return manifest.join(back, "name")


@query(
    "snk10_export_all",
    f"""WITH {SIG}, {LAB}, {BEAT}, {REC}, {SUB}, n AS (SELECT 'recordings' AS name, count(*) AS n FROM rec UNION ALL SELECT 'subjects', count(*) FROM sub
         UNION ALL SELECT 'signals', count(*) FROM sig UNION ALL SELECT 'annotations_apnea', count(*) FROM lab UNION ALL SELECT 'annotations_qrs', count(*) FROM beat)
       SELECT name, "mode", n FROM n, (VALUES ('schema'), ('data')) m("mode")""",
)
def export_all(spark, sf):
    """All five tables, schema and data, with the rows that the files hold."""
    root, given = scratch_path(spark, "export"), all_frames(spark, sf)
    manifest = exports.export(spark, given, root, "full").select("name", "mode")
    held = [spark.read.parquet(f"{root}/{name}_data").agg(F.count(F.lit(1)).alias("n")).withColumn("name", F.lit(name)) for name in given]
    return manifest.join(reduce(lambda a, b: a.unionByName(b), held), "name")


@query(
    "flt01_stored_range",
    f"""WITH {SIG} SELECT recorded_at, ecg_value, sample_index FROM sig
       WHERE recording_id = 'a01' AND recorded_at >= TIMESTAMP '2024-01-10 06:00:00' AND recorded_at < TIMESTAMP '2024-01-15 06:00:00'""",
)
def stored_range(spark, sf):
    """A range of the stored signal table: record and both time bounds reach the scan."""
    path = scratch_path(spark, "signals")
    tables.write_table(signal_table(spark, sf), path, partition=())
    return fl.range_query(spark.read.parquet(path), "a01", "2024-01-10 06:00:00", "5 days", ("recorded_at", "ecg_value", "sample_index"))


@query(
    "snk11_chunked_layout",
    f"""WITH {SIG} SELECT recording_id, strftime(date_trunc('hour', recorded_at), '%Y-%m-%d-%H') AS chunk, count(*) AS n FROM sig GROUP BY 1, 2""",
)
def chunked_layout(spark, sf):
    return tables.chunk_counts(feeds.clean_signals(spark, sf))


@query(
    "snk11_scan_chunks",
    f"""WITH {SIG} SELECT recording_id, sample_index, recorded_at, ecg_value, strftime(date_trunc('day', recorded_at), '%Y-%m-%d') AS chunk
       FROM sig WHERE recording_id = 'b01' AND recorded_at >= TIMESTAMP '2024-01-05 12:00:00' AND recorded_at < TIMESTAMP '2024-01-20 06:00:00'""",
)
def scan_chunks(spark, sf):
    """The whole table written in day chunks, one record's range read back from its folders."""
    path = scratch_path(spark, "chunks")
    tables.write_chunked(signal_table(spark, sf).select("recording_id", "sample_index", "recorded_at", "ecg_value"), path, "day", folders=("chunk",))
    found = tables.scan_chunks(spark, path, "b01", "2024-01-05 12:00:00", "2024-01-20 06:00:00", "day")
    return found.withColumn("chunk", F.col("chunk").cast("string"))

"""Queries over raw record files, which are written from the events and read back.

A record is a group of users. Its samples are the events in order of time, numbered from 0, at
5 or 10 samples a second; records of letters a and b have four more channels with their own
gain and zero, and every third of these has an extra file that is two samples short.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsegrid.catalog import feeds
from pulsegrid.catalog.feeds import record_name, table
from pulsegrid.catalog.registry import query, rounded
from pulsegrid.operators import extraction as ex
from pulsegrid.plans.ordered import with_ordinal
from pulsegrid.schema import BEATS, CHANNELS, EXTRA_CHANNELS
from pulsegrid.session import scratch_path
from pulsegrid.sinks import exports
from pulsegrid.sources import files, paired, readers

RECORDS = 40
#: Beats of one JSON array (the last has the rest): no row or file holds a whole hot record, and the number of files goes by the beats.
ARRAY_BEATS = 20_000
#: gain and zero of the four extra channels, and the main one's.
SCALES = ((20.0, 5), (40.0, -3), (10.0, 0), (50.0, 7))
MAIN = (100.0, 2)

RAW = f"""ev AS (SELECT {feeds.RECORD_SQL.format(f'(user_id % {RECORDS})')} AS recording_id, user_id % {RECORDS} AS number, value, event_type, event_id,
   row_number() OVER (PARTITION BY user_id % {RECORDS} ORDER BY ts, event_id) - 1 AS sample_index FROM events),
 rc AS (SELECT recording_id, number, count(*) AS n, number % 4 < 2 AS extra, CASE WHEN number % 2 = 0 THEN 10 ELSE 5 END AS rate,
   CASE WHEN number % 4 < 2 AND number % 3 = 0 THEN 2 ELSE 0 END AS short FROM ev GROUP BY 1, 2)"""


def samples(spark, sf):
    number = F.pmod(F.col("user_id"), F.lit(RECORDS))
    rows = with_ordinal(table(spark, sf, "events").withColumn("number", number), ["number"], ["ts", "event_id"], "sample_index")
    return rows.select(
        record_name(F.col("number")).alias("recording_id"), "number", F.col("sample_index").cast("long").alias("sample_index"), "value", "event_type", "event_id",
        (F.col("number") % 4 < 2).alias("extra"), F.when(F.col("number") % 2 == 0, 10).otherwise(5).alias("rate"),
        F.when((F.col("number") % 4 < 2) & (F.col("number") % 3 == 0), 2).otherwise(0).alias("short"),
    )


def record_rows(spark, sf):
    return samples(spark, sf).groupBy("recording_id", "number", "extra", "rate", "short").agg(F.count(F.lit(1)).alias("n"))


def header_files(records):
    """Base headers of all records and combined ones (``er``) of records with extra channels."""
    line = lambda suffix, scale, name: F.concat("recording_id", F.lit(f"{suffix}.dat 16 {scale[0]:g}({scale[1]})/mV 16 0 0 0 0 {name}"))
    first = lambda tag, k: F.concat("recording_id", F.lit(f"{tag} {k} "), F.col("rate").cast("string"), F.lit(" "), F.col("n").cast("string"))
    main = line("", MAIN, "ECG")
    names = ("Resp C", "Resp A", "Resp N", "SpO2")
    extra = [line("r", s, n) for s, n in zip(SCALES, names, strict=True)]
    base = records.select(F.concat("recording_id", F.lit(".hea")).alias("name"), F.concat_ws("\n", first("", 1), main).alias("body"))
    combined = records.where("extra").select(
        F.concat("recording_id", F.lit("er.hea")).alias("name"), F.concat_ws("\n", F.lit("# combined"), first("er", 5), main, *extra).alias("body")
    )
    return base.unionByName(combined)


def mark_files(records):
    """A label file for every record (``r`` for those with extra channels), a beat file for even numbers."""
    label = F.concat("recording_id", F.when(F.col("extra"), "r").otherwise(""), F.lit(".apn"))
    one = records.select(label.alias("name"), F.lit("label").alias("body"))
    return one.unionByName(records.where("number % 2 = 0").select(F.concat("recording_id", F.lit("er.qrs")).alias("name"), F.lit("beats").alias("body")))


def write_raw(spark, sf):
    root = scratch_path(spark, "raw")
    records = record_rows(spark, sf)
    exports.write_files(header_files(records).unionByName(mark_files(records)), root)
    rows = samples(spark, sf)
    units = lambda scale, v: (F.bround(v * (scale[0] / 10), 0) + scale[1]).cast("int")
    main = rows.select(F.concat("recording_id", F.lit(".dat")).alias("file"), "sample_index", units(MAIN, F.col("value")).alias("v"))
    exports.write_sample_files(main, root, ["v"])
    sizes = records.select("recording_id", "n")
    kept = rows.where("extra").join(sizes, "recording_id").where("sample_index < n - short")
    cells = [units(s, F.col("value")).alias(c) for s, c in zip(SCALES, EXTRA_CHANNELS, strict=True)]
    exports.write_sample_files(kept.select(F.concat("recording_id", F.lit("r.dat")).alias("file"), "sample_index", *cells), root, list(EXTRA_CHANNELS))
    return root


@query("src02_pick_headers", f"WITH {RAW} SELECT recording_id AS record_name, recording_id || CASE WHEN extra THEN 'er.hea' ELSE '.hea' END AS header_file FROM rc")
def pick_headers(spark, sf):
    root = scratch_path(spark, "headers")
    exports.write_files(header_files(record_rows(spark, sf)), root)
    return files.pick_headers(files.list_files(spark, root)).select("record_name", "header_file")


@query(
    "src03_availability_flags",
    f"""WITH {RAW} SELECT recording_id AS record_name, TRUE AS has_apnea_annotations, number % 2 = 0 AS has_qrs_annotations, extra AS has_respiration,
       CAST(rate AS INTEGER) AS sampling_rate_hz, n AS num_samples FROM rc""",
)
def availability_flags(spark, sf):
    root = scratch_path(spark, "headers")
    records = record_rows(spark, sf)
    exports.write_files(header_files(records).unionByName(mark_files(records)), root)
    meta = ex.read_metadata_from_headers(spark, root)
    return meta.select("record_name", "has_apnea_annotations", "has_qrs_annotations", "has_respiration", "sampling_rate_hz", "num_samples")


@query(
    "src06_read_json_array",
    f"""WITH {feeds.BEATS_SQL} SELECT recording_id, sample_index, recorded_at FROM beat""",
)
def read_json_array(spark, sf):
    """Files of one array each, with up to ``ARRAY_BEATS`` beats of records that follow each other."""
    root = scratch_path(spark, "arrays")
    row = F.struct("recording_id", "sample_index", F.date_format("recorded_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("recorded_at"))
    beats = with_ordinal(feeds.beats(spark, sf), [], ["recording_id", "sample_index", "recorded_at", "row_id"])
    part = F.floor(F.col("ordinal") / ARRAY_BEATS).cast("string").alias("part")
    arrays = beats.groupBy(part).agg(F.to_json(F.collect_list(row)).alias("body"))
    exports.write_files(arrays.withColumn("name", F.concat_ws("_", F.lit("qrs"), F.concat("part", F.lit(".json")))), root)
    back = readers.read_json_array(spark, root, BEATS)
    return back.select("recording_id", "sample_index", F.col("recorded_at").cast("timestamp_ntz").alias("recorded_at"))


@query(
    "src07_read_metadata",
    f"""WITH {RAW} SELECT recording_id AS record_name, n AS num_samples, CAST(rate AS INTEGER) AS sampling_rate_hz, extra AS has_respiration FROM rc""",
)
def read_metadata(spark, sf):
    """Objects keyed by record name, one file for each letter."""
    root = scratch_path(spark, "metadata")
    entry = F.struct(F.col("n").alias("num_samples"), F.col("rate").alias("sampling_rate_hz"), F.col("extra").alias("has_respiration"))
    letter = F.substring("recording_id", 1, 1)
    objects = record_rows(spark, sf).groupBy(letter.alias("name")).agg(
        F.to_json(F.map_from_entries(F.collect_list(F.struct("recording_id", entry)))).alias("body")
    )
    exports.write_files(objects, root)
    return readers.read_metadata(spark, root).select("record_name", "num_samples", "sampling_rate_hz", "has_respiration")


@query("src09_resolve_base", f"WITH {RAW} SELECT recording_id AS record_name, recording_id || CASE WHEN extra THEN 'r' ELSE '' END AS base FROM rc")
def resolve_base(spark, sf):
    root = scratch_path(spark, "marks")
    records = record_rows(spark, sf)
    exports.write_files(mark_files(records), root)
    bases = F.array(F.concat("recording_id", F.lit("er")), F.lit(None).cast("string"), F.concat("recording_id", F.lit("r")), F.col("recording_id"))
    return files.resolve_base(records.select(F.col("recording_id").alias("record_name"), bases.alias("bases")), files.list_files(spark, root), "apn", required=True)


@query(
    "src12_file_inventory",
    f"""WITH {RAW} SELECT 'apn' AS extension, count(*) AS n_files, 5 * count(*) AS n_bytes FROM rc
       UNION ALL SELECT 'qrs', count(*), 5 * count(*) FROM rc WHERE number % 2 = 0
       UNION ALL SELECT 'dat', count(*) + count(*) FILTER (extra), CAST(sum(2 * n + CASE WHEN extra THEN 8 * greatest(n - short, 0) ELSE 0 END) AS BIGINT) FROM rc
       UNION ALL SELECT 'hea', count(*) + count(*) FILTER (extra), NULL FROM rc""",
)
def file_inventory(spark, sf):
    counted = files.file_inventory(files.list_files(spark, write_raw(spark, sf)))
    return counted.withColumn("n_bytes", F.when(F.col("extension") != "hea", F.col("n_bytes")))


@query(
    "pl01_process_records",
    f"""WITH {RAW}, kept AS (SELECT ev.*, rate, extra, short, n FROM ev JOIN rc USING (recording_id, number) WHERE sample_index < n - short),
       la AS (SELECT recording_id, row_number() OVER (PARTITION BY recording_id ORDER BY sample_index) - 1 AS minute_index FROM ev WHERE event_type = 'error'),
       ws AS (SELECT recording_id, count(DISTINCT sample_index // (rate * 60)) AS window_rows, count(*) AS signal_rows,
                     round(sum((round_even(value * 10, 0)) / 100.0::DOUBLE), 4) AS main_sum,
                     round(sum(CASE WHEN extra THEN round_even(value * 5, 0) / 50.0::DOUBLE END), 4) AS spo2_sum FROM kept GROUP BY 1),
       an AS (SELECT recording_id, count(*) AS annotated FROM la JOIN (SELECT DISTINCT recording_id, sample_index // (rate * 60) AS minute_index FROM kept)
              USING (recording_id, minute_index) GROUP BY 1),
       c AS (SELECT recording_id, count(*) FILTER (event_type = 'error') AS apnea_events, count(*) FILTER (event_type = 'click') AS qrs_events FROM ev GROUP BY 1)
       SELECT recording_id, signal_rows, apnea_events, qrs_events, window_rows, coalesce(annotated, 0) AS annotated_window_rows, main_sum, spo2_sum,
              CASE WHEN short > 0 THEN 'fail' WHEN apnea_events = 0 OR coalesce(annotated, 0) = 0 OR (number % 2 = 0 AND qrs_events = 0) THEN 'warn'
                   ELSE 'pass' END AS status
       FROM rc JOIN ws USING (recording_id) JOIN c USING (recording_id) LEFT JOIN an USING (recording_id)""",
)
def process_records(spark, sf):
    """From raw files to windows, statistics and validation, one row for each record."""
    root = write_raw(spark, sf)
    meta = ex.read_metadata_from_headers(spark, root)
    marks = samples(spark, sf).where("event_type IN ('error', 'click')")
    notes = with_ordinal(marks.where("event_type = 'error'"), ["recording_id"], ["sample_index"]).select(
        "recording_id", "ordinal", "sample_index", F.lit("A").alias("aux_note"), F.lit("N").alias("symbol")
    )
    beats = marks.where("event_type = 'click'").select("recording_id", "sample_index", F.col("sample_index").alias(ex.POSITION))
    out = ex.process(ex.raw_streams(spark, root, meta), ex.label_stream(notes, meta), ex.beat_stream(beats, meta), meta)
    sums = out["signals"].groupBy("recording_id").agg(F.sum("ecg_value").alias("main_sum"), F.sum("spo2").alias("spo2_sum"))
    stats = out["stats"].select("recording_id", "signal_rows", "apnea_events", "qrs_events", "window_rows", "annotated_window_rows")
    return rounded(stats.join(sums, "recording_id").join(out["report"].select("recording_id", "status"), "recording_id"), "main_sum", "spo2_sum", digits=4)


@query(
    "jn09_paired_files",
    f"""WITH {RAW} SELECT recording_id, sample_index, round(round_even(value * 10, 0) / 100.0::DOUBLE, 6) AS ecg_value,
       CASE WHEN extra THEN round(round_even(value * 2, 0) / 20.0::DOUBLE, 6) END AS resp_c, CASE WHEN extra THEN round(round_even(value * 4, 0) / 40.0::DOUBLE, 6) END AS resp_a,
       CASE WHEN extra THEN round(round_even(value * 1, 0) / 10.0::DOUBLE, 6) END AS resp_n, CASE WHEN extra THEN round(round_even(value * 5, 0) / 50.0::DOUBLE, 6) END AS spo2
       FROM ev JOIN rc USING (recording_id, number) WHERE sample_index < n - short""",
)
def paired_files(spark, sf):
    """Main and extra sample files of all records, zipped by the data source."""
    root = write_raw(spark, sf)
    facts = ex.read_metadata_from_headers(spark, root).select(F.col("record_name").alias("recording_id"), "sampling_rate_hz", "has_respiration")
    read = paired.read_paired(spark, paired.work_orders(spark, root, facts), range_bytes=100_000)
    return rounded(read.select("recording_id", "sample_index", *CHANNELS), *CHANNELS)

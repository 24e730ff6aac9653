"""Queries over rows: projections, filters, bucket and channel aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsegrid.catalog import feeds
from pulsegrid.catalog.feeds import BASE, RATE, WIDTH, table
from pulsegrid.catalog.registry import in_order, query, r6, rounded
from pulsegrid.functions import clean, text, timeline
from pulsegrid.operators import aggregates as ag
from pulsegrid.operators import filters as fl
from pulsegrid.operators import reshape
from pulsegrid.plans.ordered import with_ordinal
from pulsegrid.schema import CHANNELS, DEVELOPMENT_RECORDS, EXTRA_CHANNELS

SIG, LAB, BEAT, REC, SUB = (
    feeds.SIGNALS_SQL, feeds.LABELS_SQL, feeds.BEATS_SQL, feeds.RECORDINGS_SQL, feeds.SUBJECTS_SQL,
)
DAY = 86_400

# ---------------------------------------------------------------- projections


@query(
    "prj01_synth_ts",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice,
              TIMESTAMP '2000-01-01' + to_microseconds(CAST(l_partkey * 10000 AS BIGINT)) AS at_100hz,
              TIMESTAMP '2000-01-01' + to_microseconds(CAST(l_partkey * 1000000 // 250 AS BIGINT)) AS at_250hz
       FROM lineitem""",
)
def synth_ts(spark, sf):
    index = F.col("l_partkey")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice",
        timeline.synth_ts(index, 100).alias("at_100hz"),
        timeline.synth_ts(index, 250).alias("at_250hz"),
    )


@query(
    "prj02_window_bounds",
    f"""WITH {feeds.RAW_SQL}, m AS (SELECT row_id, sample_index // {WIDTH} AS minute_index FROM raw)
       SELECT row_id, minute_index, minute_index * {WIDTH} AS sample_start_index,
              minute_index * {WIDTH} + {WIDTH - 1} AS sample_end_index,
              TIMESTAMP '{BASE}' + to_seconds(minute_index * {WIDTH}) AS window_start_at,
              TIMESTAMP '{BASE}' + to_seconds(minute_index * {WIDTH} + {WIDTH - 1}) AS window_end_at
       FROM m""",
)
def window_bounds(spark, sf):
    minute = timeline.minute_of(F.col("sample_index"), RATE, WIDTH)
    bounds = timeline.window_bounds(F.col("minute_index"), RATE, WIDTH, BASE)
    return (
        feeds.raw_signals(spark, sf)
        .select("row_id", minute.alias("minute_index"))
        .select("row_id", "minute_index", *[c.alias(n) for n, c in bounds.items()])
    )


_FAULTY = """CASE WHEN l_partkey % 97 = 3 THEN 'NaN'::DOUBLE WHEN l_partkey % 89 = 5 THEN 'Infinity'::DOUBLE
             WHEN l_partkey % 83 = 7 THEN '-Infinity'::DOUBLE WHEN l_partkey % 79 = 9 THEN NULL
             ELSE l_extendedprice END"""


@query(
    "prj03_clean_non_finite",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN isfinite(v) THEN v END AS v,
              coalesce(NOT isfinite(v), FALSE) AS v_replaced
       FROM (SELECT *, {_FAULTY} AS v FROM lineitem)""",
)
def clean_non_finite(spark, sf):
    p = F.col("l_partkey")
    v = (
        F.when(p % 97 == 3, F.lit(float("nan"))).when(p % 89 == 5, F.lit(float("inf")))
        .when(p % 83 == 7, F.lit(float("-inf"))).when(p % 79 == 9, F.lit(None)).otherwise(F.col("l_extendedprice"))
    )
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", v.alias("v"))
    return clean.clean_non_finite(rows, ["v"])


@query(
    "prj04_structural_nulls",
    f"""WITH {feeds.RAW_SQL} SELECT row_id, recording_id, ecg_value, """
    + ", ".join(f"CASE WHEN has_respiration THEN {c} END AS {c}" for c in EXTRA_CHANNELS)
    + " FROM raw",
)
def structural_nulls(spark, sf):
    rows = clean.structural_nulls(feeds.raw_signals(spark, sf), F.col("has_respiration"))
    return rows.select("row_id", "recording_id", *CHANNELS)


@query(
    "prj05_parse_label",
    r"""SELECT doc_id, coalesce(nullif(trim(text, ' ' || chr(9) || chr(10) || chr(13)), ''),
              nullif(trim(lang), ''), '') AS label
       FROM documents""",
)
def parse_label(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", text.parse_label(F.col("text"), F.col("lang")).alias("label")
    )


@query(
    "prj06_label_to_bool",
    f"WITH {LAB} SELECT row_id, label, lower(trim(label)) IN ('a', 'apnea', '1') AS is_apnea FROM lab",
)
def label_to_bool(spark, sf):
    return feeds.minute_labels(spark, sf).select(
        "row_id", "label", text.label_to_bool(F.col("label")).alias("is_apnea")
    )


@query(
    "prj07_categorise",
    f"""WITH {REC} SELECT row_id, recording_id, lower(substr(recording_id, 1, 1)) AS category,
              CASE WHEN recording_id LIKE 'x%' THEN 'test' ELSE 'learning' END AS split,
              CASE WHEN recording_id IN ('c05', 'c06') THEN 'subject_c05_c06'
                   ELSE 'subject_' || recording_id END AS subject_id FROM rec""",
)
def categorise(spark, sf):
    r = F.col("recording_id")
    return feeds.recordings(spark, sf).select(
        "row_id", "recording_id", text.category(r).alias("category"), text.dataset_split(r).alias("split"),
        text.subject_of(r).alias("subject_id"),
    )


@query(
    "prj08_length_seconds",
    """SELECT l_orderkey, l_linenumber, l_partkey,
              CAST(round_even(l_partkey / 2.0, 0) AS BIGINT) AS length_2hz,
              CAST(round_even(l_partkey::DOUBLE / 100, 0) AS BIGINT) AS length_100hz FROM lineitem""",
)
def length_seconds(spark, sf):
    n = F.col("l_partkey")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", timeline.length_seconds(n, 2).alias("length_2hz"),
        timeline.length_seconds(n, 100).alias("length_100hz"),
    )


@query(
    "prj09_normalise_ts",
    """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS naive,
              strftime(ts - INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS shifted,
              strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S') || '+00:00' AS zulu
       FROM events""",
)
def normalise_ts(spark, sf):
    stamp = lambda f: F.date_format("ts", f)
    return table(spark, sf, "events").select(
        "event_id",
        timeline.normalise_ts(stamp("yyyy-MM-dd HH:mm:ss.SSSSSS")).alias("naive"),
        timeline.normalise_ts(F.concat(stamp("yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00"))).alias("shifted"),
        timeline.normalise_ts(F.concat(stamp("yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))).alias("zulu"),
    )


@query(
    "prj11_safe_name",
    r"""SELECT p_partkey, trim(regexp_replace(p_name || ' (' || p_type || ')/' || p_brand, '[^A-Za-z0-9_.-]+', '_', 'g'), '_')
       AS safe FROM part""",
)
def safe_name(spark, sf):
    raw = F.concat("p_name", F.lit(" ("), "p_type", F.lit(")/"), "p_brand")
    return table(spark, sf, "part").select("p_partkey", text.safe_name(raw).alias("safe"))


@query(
    "prj12_format_bytes",
    """SELECT doc_id, CASE WHEN n < 1024 THEN printf('%.2f B', n) WHEN n < 1048576 THEN printf('%.2f KB', n / 1024)
              WHEN n < 1073741824 THEN printf('%.2f MB', n / 1048576) WHEN n < 1099511627776
              THEN printf('%.2f GB', n / 1073741824) ELSE printf('%.2f TB', n / 1099511627776) END AS size
       FROM (SELECT doc_id, CAST(n_chars AS DOUBLE) * CASE doc_id % 5 WHEN 0 THEN 1 WHEN 1 THEN 1024
             WHEN 2 THEN 1048576 WHEN 3 THEN 1073741824 ELSE 1099511627776 END AS n FROM documents)""",
)
def format_bytes(spark, sf):
    scale = F.pow(F.lit(1024.0), F.col("doc_id") % 5)
    return table(spark, sf, "documents").select("doc_id", text.format_bytes(F.col("n_chars") * scale).alias("size"))


# ---------------------------------------------------------------- filters


@query(
    "flt01_range_query",
    f"""WITH {SIG} SELECT recorded_at, ecg_value, row_id, row_number() OVER (ORDER BY recorded_at, row_id) - 1 AS place FROM sig
       WHERE recording_id = 'a01' AND recorded_at >= TIMESTAMP '2024-01-10 06:00:00' AND recorded_at < TIMESTAMP '2024-01-15 06:00:00'""",
)
def range_query(spark, sf):
    """One record and a half-open time range with literal bounds, in time order."""
    found = fl.range_query(
        feeds.clean_signals(spark, sf), "a01", "2024-01-10 06:00:00", "5 days", ("recorded_at", "ecg_value", "row_id"), tie="row_id"
    )
    return with_ordinal(found, [], ["recorded_at", "row_id"], "place")


@query(
    "flt01_ranges_per_record",
    f"""WITH {SIG}, s AS (SELECT recording_id, min(recorded_at) AS start_at FROM sig GROUP BY 1)
       SELECT recording_id, recorded_at, ecg_value FROM sig JOIN s USING (recording_id)
       WHERE recorded_at >= start_at AND recorded_at < start_at + INTERVAL 1 DAY""",
)
def ranges_per_record(spark, sf):
    signals = feeds.clean_signals(spark, sf).select("recording_id", "recorded_at", "ecg_value")
    starts = ag.earliest(signals, ["recording_id"])
    return fl.ranges_per_record(signals, starts, "1 day").select("recording_id", "recorded_at", "ecg_value")


@query(
    "flt02_select_records",
    f"""WITH {REC}, {SUB} SELECT row_id, recording_id, subject_id FROM rec
       WHERE subject_id IN (SELECT subject_id FROM sub WHERE active)""",
)
def select_records(spark, sf):
    wanted = feeds.subjects(spark, sf).where("active").join(
        feeds.recordings(spark, sf).select("subject_id").distinct(), "subject_id", "left_semi"
    )
    return fl.select_records(feeds.recordings(spark, sf), wanted, "subject_id").select(
        "row_id", "recording_id", "subject_id"
    )


@query(
    "set04_unknown_ids",
    f"""WITH {REC}, {SUB} SELECT DISTINCT subject_id FROM rec
       WHERE subject_id NOT IN (SELECT subject_id FROM sub WHERE active)""",
)
def unknown_ids(spark, sf):
    known = feeds.subjects(spark, sf).where("active")
    return fl.unknown_ids(feeds.recordings(spark, sf), known, "subject_id")


@query(
    "flt03_cap_samples",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice FROM lineitem
       WHERE l_partkey < least(l_suppkey * 20, CAST(l_quantity AS BIGINT) * 40)""",
)
def cap_samples(spark, sf):
    return fl.cap_samples(
        table(spark, sf, "lineitem"), F.col("l_suppkey") * 20, F.col("l_quantity").cast("long") * 40,
        index="l_partkey",
    ).select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice")


@query(
    "flt04_cap_annotations",
    f"""WITH {LAB} SELECT recording_id, minute_index, sample_index, label FROM (
         SELECT *, row_number() OVER (PARTITION BY recording_id ORDER BY row_id DESC) - 1 AS minute_index FROM lab)
       WHERE sample_index < {15 * DAY}""",
)
def cap_annotations(spark, sf):
    labels = feeds.minute_labels(spark, sf)
    capped = fl.cap_annotations(labels, F.lit(15 * DAY), ["recording_id"], [F.col("row_id").desc()])
    return capped.select("recording_id", "minute_index", "sample_index", "label")


@query(
    "flt05_control_normal",
    f"""WITH {feeds.WINDOWS_SQL} SELECT window_id, recording_id, y FROM win
       WHERE recording_id LIKE 'c%' AND y = 0""",
)
def control_normal(spark, sf):
    return fl.control_normal(feeds.windows(spark, sf)).select("window_id", "recording_id", "y")


@query("flt05_all_normal", f"WITH {feeds.WINDOWS_SQL} SELECT window_id, recording_id, y FROM win WHERE y = 0")
def all_normal(spark, sf):
    return fl.all_normal(feeds.windows(spark, sf)).select("window_id", "recording_id", "y")


_Q = "(SELECT count(*) FROM rec WHERE NOT ({0}))"
_CHECKS = {
    "split_set": "split IN ('learning', 'test')",
    "category_set": "record_category IN ('a', 'b', 'c')",
    "length_positive": "total > 0",
}


@query(
    "flt06_quality_rules",
    f"""WITH {REC}, {SUB}, k AS (SELECT recording_id, count(*) AS n FROM rec GROUP BY 1)
       SELECT 'recordings' AS table_name, u.rule, u.violations FROM (
         """
    + " UNION ALL ".join(f"SELECT '{n}' AS rule, {_Q.format(c)} AS violations" for n, c in _CHECKS.items())
    + """ UNION ALL SELECT 'subject_given', (SELECT count(*) FROM rec WHERE subject_id IS NULL)
         UNION ALL SELECT 'recording_unique', (SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM k)
         UNION ALL SELECT 'subject_day_unique', (SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM
                     (SELECT count(*) AS n FROM rec GROUP BY subject_id, recording_start_time))
         UNION ALL SELECT 'subject_exists', (SELECT count(*) FROM rec r WHERE NOT EXISTS (
                     SELECT 1 FROM sub s WHERE s.subject_id = r.subject_id AND s.active))) u""",
)
def quality_rules(spark, sf):
    checks = {n: F.expr(c) for n, c in _CHECKS.items()} | {"subject_given": F.col("subject_id").isNotNull()}
    return fl.quality_rules(
        feeds.recordings(spark, sf), "recordings", checks,
        unique={"recording_unique": ["recording_id"], "subject_day_unique": ["subject_id", "recording_start_time"]},
        foreign={"subject_exists": ("subject_id", feeds.subjects(spark, sf).where("active"), "subject_id")},
    )


@query(
    "flt07_development_member",
    f"""WITH {feeds.RAW_SQL} SELECT row_id, recording_id, recording_id IN {DEVELOPMENT_RECORDS} AS is_dev FROM raw""",
)
def development_member(spark, sf):
    member = fl.development_member(F.col("recording_id"))
    return feeds.raw_signals(spark, sf).select("row_id", "recording_id", member.alias("is_dev"))


# ---------------------------------------------------------------- aggregates


@query(
    "ag01_bucket_stats",
    f"""WITH {SIG} SELECT recording_id, time_bucket(INTERVAL 1 DAY, recorded_at)::TIMESTAMP AS bucket,
              round(avg(ecg_value), 6) AS avg_value, min(ecg_value) AS min_value, max(ecg_value) AS max_value
       FROM sig GROUP BY 1, 2""",
)
def bucket_stats(spark, sf):
    return rounded(ag.bucket_stats(feeds.clean_signals(spark, sf), DAY), "avg_value")


@query(
    "ag02_bucket_counts",
    f"WITH {BEAT} SELECT recording_id, date_trunc('day', recorded_at)::TIMESTAMP AS bucket, count(*) AS n FROM beat GROUP BY 1, 2",
)
def bucket_counts(spark, sf):
    return ag.bucket_counts(feeds.beats(spark, sf), DAY)


def stats_sql(keys: str, source: str, channels=CHANNELS, gate: bool = True) -> str:
    """Long channel statistics; closed channels give zeros and NULLs."""
    parts = []
    for c in channels:
        always = c == "ecg_value" or not gate
        ok = "TRUE" if always else "bool_or(has_respiration)"
        num = lambda e, ok=ok: f"CASE WHEN {ok} THEN {e} END"
        cnt = lambda e, ok=ok: f"CAST(CASE WHEN {ok} THEN {e} ELSE 0 END AS BIGINT)"
        parts.append(
            f"""SELECT {keys}, '{c}' AS channel, {ok} AS available, {cnt(f'count({c})')} AS "count",
            {cnt(f'count(*) - count({c})')} AS missing_count,
            {cnt(f'count(*) FILTER ({c}_replaced)')} AS non_finite_replaced,
            {num(f'min({c})')} AS "min", {num(f'max({c})')} AS "max",
            {num(f'avg({c})')} AS "mean", CASE WHEN count({c}) > 1 THEN {num(f'stddev_pop({c})')} END AS std
            FROM {source} GROUP BY {keys}"""
        )
    return " UNION ALL ".join(parts)


_STATS_OUT = """channel, available, "count", missing_count, non_finite_replaced, "min", "max",
 round("mean", 6) AS "mean", round(std, 6) AS std"""


@query(
    "ag04_channel_stats",
    f"""WITH {SIG}, d AS (SELECT *, time_bucket(INTERVAL 1 DAY, recorded_at)::TIMESTAMP AS bucket FROM sig),
       st AS ({stats_sql('recording_id, bucket', 'd')})
       SELECT recording_id, bucket, {_STATS_OUT} FROM st""",
)
def channel_stats(spark, sf):
    signals = feeds.clean_signals(spark, sf).withColumn("bucket", timeline.bucket(F.col("recorded_at"), DAY))
    stats = ag.channel_stats(signals, ["recording_id", "bucket"], has_extra="has_respiration")
    long = ag.modalities_long(stats, ["recording_id", "bucket"]).drop("normalized_mean")
    return rounded(long, "mean", "std")


@query(
    "ag06_record_summaries",
    f"""WITH {SIG}, st AS ({stats_sql('recording_id', 'sig')})
       SELECT recording_id, {_STATS_OUT} FROM st""",
)
def record_summaries(spark, sf):
    stats = ag.channel_stats(feeds.clean_signals(spark, sf), ["recording_id"], has_extra="has_respiration")
    return rounded(ag.modalities_long(stats, ["recording_id"]).drop("normalized_mean"), "mean", "std")


# ---------------------------------------------------------------- order, sets, shape


@query(
    "so01_order_by_time",
    f"""WITH {SIG} SELECT recording_id, recorded_at, ecg_value, row_number() OVER (ORDER BY recording_id, recorded_at, row_id) - 1 AS place
       FROM sig ORDER BY recording_id, recorded_at, row_id""",
)
def order_by_time(spark, sf):
    """Rows in order, with the place that each row has in the written result."""
    rows = feeds.clean_signals(spark, sf).select("recording_id", "recorded_at", "ecg_value", "row_id")
    return in_order(rows, ["recording_id", "recorded_at", "row_id"]).drop("row_id")


@query("so04_earliest", f"WITH {SIG} SELECT recording_id, min(recorded_at) AS start_at FROM sig GROUP BY 1")
def earliest(spark, sf):
    return ag.earliest(feeds.clean_signals(spark, sf), ["recording_id"])


@query(
    "set02_distinct_ids",
    f"WITH {feeds.RAW_SQL}, {LAB} SELECT recording_id FROM raw UNION SELECT recording_id FROM lab",
)
def distinct_ids(spark, sf):
    return reshape.distinct_ids(feeds.raw_signals(spark, sf), feeds.minute_labels(spark, sf))


@query(
    "ext03_to_long",
    f"""WITH {SIG} """
    + " UNION ALL ".join(f"SELECT row_id, '{c}' AS channel, {c} AS value FROM sig" for c in CHANNELS),
)
def to_long(spark, sf):
    return reshape.to_long(feeds.clean_signals(spark, sf), ["row_id"])


@query(
    "ext03_to_wide",
    f"WITH {SIG} SELECT recording_id, sample_index, row_id, {', '.join(CHANNELS)} FROM sig",
)
def to_wide(spark, sf):
    keys = ["recording_id", "sample_index", "row_id"]
    return reshape.to_wide(reshape.to_long(feeds.clean_signals(spark, sf), keys), keys)


@query(
    "src11_preview",
    f"""WITH {SIG} SELECT recording_id, sample_index, row_id, """
    + ", ".join(f"CASE WHEN {c} IS NULL THEN NULL ELSE printf('%.6f', {c}) END AS {c}" for c in CHANNELS)
    + """ FROM sig QUALIFY row_number() OVER (PARTITION BY recording_id ORDER BY sample_index, row_id) <= 5""",
)
def preview(spark, sf):
    return reshape.preview(
        feeds.clean_signals(spark, sf), 5, ["recording_id"], ["sample_index", "row_id"], CHANNELS
    )

"""Queries that join streams of a recording, number them and validate them."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsegrid.catalog import feeds
from pulsegrid.catalog.feeds import BASE, RATE, WIDTH, table
from pulsegrid.catalog.registry import query, r6, rounded
from pulsegrid.catalog.rows import stats_sql
from pulsegrid.functions import text, timeline
from pulsegrid.operators import aggregates as ag
from pulsegrid.operators import joins as jn
from pulsegrid.operators import sequence as sq
from pulsegrid.operators import validation as va
from pulsegrid.schema import CHANNELS, EXTRA_CHANNELS

SIG, LAB, BEAT, REC, SUB = (
    feeds.SIGNALS_SQL, feeds.LABELS_SQL, feeds.BEATS_SQL, feeds.RECORDINGS_SQL, feeds.SUBJECTS_SQL,
)
DAY = 86_400
HOUR = 3_600


def label_rows(spark, sf):
    """Labels as the interval side: own time column, ordinal minute, boolean."""
    return feeds.minute_labels(spark, sf).select(
        "recording_id", F.col("recorded_at").alias("label_at"), "row_id", text.strip(F.col("label")).alias("label"),
        text.label_to_bool(F.col("label")).alias("is_apnea"),
        timeline.minute_of(F.col("sample_index"), RATE, WIDTH).alias("minute_index"),
    )


# the label table with its window number; several labels may share a window
MIN_SQL = f"""mlab AS (SELECT recording_id, recorded_at, row_id, trim(label) AS label,
    lower(trim(label)) IN ('a', 'apnea', '1') AS is_apnea, sample_index // {WIDTH} AS minute_index FROM lab)"""


@query(
    "jn01_interval_join",
    f"""WITH {SIG}, {LAB} SELECT l.recording_id, l.row_id AS label_id, s.row_id AS sample_id, s.ecg_value
       FROM lab l JOIN sig s ON s.recording_id = l.recording_id AND s.recorded_at >= l.recorded_at
            AND s.recorded_at < l.recorded_at + INTERVAL 1 HOUR""",
)
def interval_join(spark, sf):
    labels = label_rows(spark, sf).select("recording_id", "label_at", F.col("row_id").alias("label_id"))
    samples = feeds.clean_signals(spark, sf).select(
        "recording_id", "recorded_at", F.col("row_id").alias("sample_id"), "ecg_value"
    )
    return ag.interval_join(labels, samples, HOUR).select("recording_id", "label_id", "sample_id", "ecg_value")


@query(
    "ag03_label_signal_stats",
    f"""WITH {SIG}, {LAB}, {MIN_SQL}
       SELECT l.recording_id, l.minute_index, l.label, l.is_apnea, count(*) AS n, round(avg(s.ecg_value), 6) AS avg_value
       FROM mlab l JOIN sig s ON s.recording_id = l.recording_id AND s.recorded_at >= l.recorded_at
            AND s.recorded_at < l.recorded_at + INTERVAL 1 DAY GROUP BY 1, 2, 3, 4""",
)
def label_signal_stats(spark, sf):
    samples = feeds.clean_signals(spark, sf).select("recording_id", "recorded_at", "ecg_value")
    by = ("recording_id", "minute_index", "label", "is_apnea")
    return rounded(ag.label_signal_stats(label_rows(spark, sf), samples, DAY, by), "avg_value")


WSUM_SQL = f"""{SIG}, {LAB}, {BEAT}, {MIN_SQL},
  d AS (SELECT *, sample_index // {WIDTH} AS minute_index FROM sig),
  wins AS (SELECT recording_id, minute_index, count(*) AS sample_count FROM d GROUP BY 1, 2),
  lastlab AS (SELECT recording_id, minute_index, arg_max(label, row_id) AS apnea_label,
                     arg_max(is_apnea, row_id) AS is_apnea FROM mlab GROUP BY 1, 2),
  beatn AS (SELECT recording_id, sample_index // {WIDTH} AS minute_index, count(*) AS qrs_count FROM beat GROUP BY 1, 2),
  wst AS ({stats_sql('recording_id, minute_index', 'd')}),
  rst AS ({stats_sql('recording_id', 'sig')})"""


@query(
    "jn02_attach_labels",
    f"""WITH {WSUM_SQL} SELECT recording_id, minute_index, sample_count, apnea_label, is_apnea
       FROM wins LEFT JOIN lastlab USING (recording_id, minute_index)""",
)
def attach_labels(spark, sf):
    parts = ag.window_partials(feeds.clean_signals(spark, sf), CHANNELS, RATE, WIDTH)
    slim = parts.select("recording_id", "minute_index", "sample_count")
    return ag.attach_labels(slim, label_rows(spark, sf), order="row_id")


@query(
    "jn03_attach_event_counts",
    f"""WITH {WSUM_SQL} SELECT recording_id, minute_index, sample_count, coalesce(qrs_count, 0) AS qrs_count
       FROM wins LEFT JOIN beatn USING (recording_id, minute_index)""",
)
def attach_event_counts(spark, sf):
    parts = ag.window_partials(feeds.clean_signals(spark, sf), CHANNELS, RATE, WIDTH)
    slim = parts.select("recording_id", "minute_index", "sample_count")
    return ag.attach_event_counts(slim, feeds.beats(spark, sf), RATE, WIDTH)


@query(
    "jn04_attach_record_stats",
    f"""WITH {WSUM_SQL} SELECT w.recording_id, w.minute_index, round(r.mean, 6) AS record_mean, round(r.std, 6) AS record_std
       FROM wins w LEFT JOIN (SELECT * FROM rst WHERE channel = 'ecg_value') r USING (recording_id)""",
)
def attach_record_stats(spark, sf):
    parts = ag.window_partials(feeds.clean_signals(spark, sf), CHANNELS, RATE, WIDTH)
    stats = ag.record_stats_from_windows(parts, ["ecg_value"]).select(
        "recording_id", F.col("ecg_value__mean").alias("record_mean"), F.col("ecg_value__std").alias("record_std")
    )
    slim = parts.select("recording_id", "minute_index")
    return rounded(ag.attach_record_stats(slim, stats, ["record_mean", "record_std"]), "record_mean", "record_std")


@query(
    "prj10_normalised_mean",
    f"""WITH {WSUM_SQL} SELECT w.recording_id, w.minute_index, w.channel,
              round(CASE WHEN r.std <> 0 THEN (w.mean - r.mean) / r.std END, 6) AS normalized_mean
       FROM wst w LEFT JOIN rst r USING (recording_id, channel)""",
)
def normalised_mean(spark, sf):
    signals = feeds.clean_signals(spark, sf)
    long = ag.modalities_long(day_windows(spark, sf, signals), ["recording_id", "minute_index"])
    return rounded(long.select("recording_id", "minute_index", "channel", "normalized_mean"), "normalized_mean")


def day_windows(spark, sf, signals=None):
    signals = feeds.clean_signals(spark, sf) if signals is None else signals
    return ag.window_summaries(
        signals, label_rows(spark, sf), feeds.beats(spark, sf), CHANNELS, RATE, WIDTH, BASE, label_order="row_id"
    )


@query(
    "ag05_window_summaries",
    f"""WITH {WSUM_SQL}
       SELECT w.recording_id, w.minute_index, TIMESTAMP '{BASE}' + to_seconds(w.minute_index * {WIDTH}) AS window_start_at,
              TIMESTAMP '{BASE}' + to_seconds(w.minute_index * {WIDTH} + {WIDTH - 1}) AS window_end_at,
              w.minute_index * {WIDTH} AS sample_start_index, w.minute_index * {WIDTH} + {WIDTH - 1} AS sample_end_index,
              sample_count, apnea_label, is_apnea, coalesce(qrs_count, 0) AS qrs_count,
              s.channel, s.available, s.count, s.missing_count, s.non_finite_replaced, s.min, s.max,
              round(s.mean, 6) AS mean, round(s.std, 6) AS std,
              round(CASE WHEN r.std <> 0 THEN (s.mean - r.mean) / r.std END, 6) AS normalized_mean
       FROM wins w LEFT JOIN lastlab USING (recording_id, minute_index) LEFT JOIN beatn USING (recording_id, minute_index)
       JOIN wst s USING (recording_id, minute_index) JOIN rst r ON r.recording_id = w.recording_id AND r.channel = s.channel""",
)
def window_summaries(spark, sf):
    windows = day_windows(spark, sf)
    keys = [c for c in windows.columns if c != "modalities"]
    return rounded(ag.modalities_long(windows, keys), "mean", "std", "normalized_mean")


@query(
    "ag11_assemble_windows",
    f"""WITH {SIG}, d AS (SELECT *, sample_index // {WIDTH} AS minute_index FROM sig),
       f AS (SELECT recording_id, minute_index FROM d GROUP BY 1, 2 HAVING count(*) = 3),
       l AS (SELECT recording_id, count(*) AS k FROM d GROUP BY 1)
       SELECT d.recording_id, d.minute_index, CAST(row_number() OVER (PARTITION BY d.recording_id, d.minute_index
              ORDER BY sample_index, row_id) - 1 AS INT) AS pos, ecg_value,
              CASE WHEN d.recording_id LIKE 'x%' THEN 'test' ELSE 'learning' END AS split
       FROM d JOIN f USING (recording_id, minute_index)""",
)
def assemble_windows(spark, sf):
    built = ag.assemble_windows(
        feeds.clean_signals(spark, sf), 3, RATE, WIDTH, order=("sample_index", "row_id")
    )
    return built.select(
        "recording_id", "minute_index", F.posexplode("ecg").alias("pos", "ecg_value"),
        text.dataset_split(F.col("recording_id")).alias("split"),
    )


@query(
    "jn05_fk_orphans",
    f"""WITH {REC}, {SUB} SELECT row_id, recording_id, subject_id FROM rec WHERE subject_id NOT IN
       (SELECT subject_id FROM sub WHERE active)""",
)
def fk_orphans(spark, sf):
    parents = feeds.subjects(spark, sf).where("active")
    return jn.fk_orphans(feeds.recordings(spark, sf), parents, "subject_id", "subject_id").select(
        "row_id", "recording_id", "subject_id"
    )


@query(
    "jn06_record_exists",
    f"WITH {feeds.RAW_SQL}, {BEAT} SELECT DISTINCT recording_id FROM raw WHERE recording_id IN (SELECT recording_id FROM beat)",
)
def record_exists(spark, sf):
    return jn.record_exists(feeds.raw_signals(spark, sf), feeds.beats(spark, sf))


@query(
    "jn07_without_match",
    f"""WITH {REC}, {SUB} SELECT subject_id, notes FROM sub s
       WHERE NOT EXISTS (SELECT 1 FROM rec r WHERE r.subject_id = s.subject_id AND r.split = 'test')""",
)
def without_match(spark, sf):
    tests = feeds.recordings(spark, sf).where(F.col("split") == "test")
    return jn.without_match(feeds.subjects(spark, sf), tests, ["subject_id"]).select("subject_id", "notes")


@query(
    "jn09_align_channels",
    f"""WITH {SIG}, main AS (SELECT recording_id, sample_index, row_id, ecg_value FROM sig),
       extra AS (SELECT recording_id, row_id, spo2, resp_c FROM raw WHERE has_respiration AND sample_index < {20 * DAY})
       SELECT m.recording_id, m.row_id, m.ecg_value, e.resp_c, e.spo2 FROM main m LEFT JOIN extra e USING (recording_id, row_id)
       WHERE e.row_id IS NOT NULL OR m.recording_id NOT IN (SELECT recording_id FROM extra)""",
)
def align_channels(spark, sf):
    main = feeds.clean_signals(spark, sf).select("recording_id", "row_id", "ecg_value")
    extra = feeds.raw_signals(spark, sf).where(F.col("has_respiration") & (F.col("sample_index") < 20 * DAY))
    return jn.align_channels(main, extra, ["recording_id", "row_id"], ["resp_c", "spo2"])


# ---------------------------------------------------------------- order inside a record


@query(
    "wn01_index_gaps",
    """SELECT * FROM (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice,
         lag(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey, l_linenumber, l_extendedprice)
           AS previous_index FROM lineitem) WHERE l_linenumber <> previous_index + 1""",
)
def index_gaps(spark, sf):
    order = ["l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"]
    rows = table(spark, sf, "lineitem").select("l_orderkey", *order)
    return sq.index_gaps(rows, ["l_orderkey"], order, "l_linenumber")


@query(
    "wn02_non_increasing_ts",
    f"""WITH {feeds.RAW_SQL} SELECT * FROM (SELECT recording_id, row_id, d AS recorded_at,
         lag(d) OVER (PARTITION BY recording_id ORDER BY row_id) AS previous_ts
         FROM (SELECT *, date_trunc('day', recorded_at)::TIMESTAMP AS d FROM raw)) WHERE recorded_at <= previous_ts""",
)
def non_increasing_ts(spark, sf):
    rows = feeds.raw_signals(spark, sf).select(
        "recording_id", "row_id", timeline.bucket(F.col("recorded_at"), DAY).alias("recorded_at")
    )
    return sq.non_increasing_ts(rows, ["recording_id"], ["row_id"])


_FALLS = "row_id, recorded_at, sample_index"


@query(
    "wn03_non_monotonic",
    f"""WITH {LAB} SELECT recording_id, {_FALLS}, coalesce(recorded_at < pt, FALSE) AS recorded_at_falls,
              coalesce(label_number < pl, FALSE) AS label_number_falls, label_number
       FROM (SELECT *, lag(recorded_at) OVER w AS pt, lag(label_number) OVER w AS pl
             FROM (SELECT *, length(label) AS label_number FROM lab) WINDOW w AS (PARTITION BY recording_id ORDER BY row_id))
       WHERE recorded_at < pt OR label_number < pl""",
)
def non_monotonic(spark, sf):
    rows = feeds.minute_labels(spark, sf).select(
        "recording_id", "row_id", "recorded_at", "sample_index", F.length("label").cast("long").alias("label_number")
    )
    return sq.non_monotonic(rows, ["recording_id"], ["row_id"], ["recorded_at", "label_number"])


@query(
    "wn04_first_last_ts",
    f"""WITH {feeds.RAW_SQL} SELECT recording_id, arg_min(recorded_at, row_id) AS first_at,
       arg_max(recorded_at, row_id) AS last_at FROM raw GROUP BY 1""",
)
def first_last_ts(spark, sf):
    return sq.first_last_ts(feeds.raw_signals(spark, sf), ["recording_id"], "row_id")


@query(
    "wn05_ordinal_minute",
    f"""WITH {LAB} SELECT recording_id, row_id, label,
       row_number() OVER (PARTITION BY recording_id ORDER BY recorded_at, row_id) - 1 AS minute_index FROM lab""",
)
def ordinal_minute(spark, sf):
    labels = feeds.minute_labels(spark, sf).select("recording_id", "row_id", "label", "recorded_at")
    return sq.ordinal_minute(labels, ["recording_id"], ["recorded_at", "row_id"]).drop("recorded_at")


@query(
    "wn06_last_wins",
    f"""WITH {LAB}, {MIN_SQL} SELECT recording_id, minute_index, row_id, label, is_apnea FROM mlab
       QUALIFY row_number() OVER (PARTITION BY recording_id, minute_index ORDER BY row_id DESC) = 1""",
)
def last_wins(spark, sf):
    return sq.last_wins(label_rows(spark, sf).drop("label_at"), ["recording_id", "minute_index"], "row_id")


@query(
    "wn07_first_seen_subject",
    f"""WITH {REC} SELECT subject_id, 'Derived from ' || recording_id AS notes FROM rec
       QUALIFY row_number() OVER (PARTITION BY subject_id ORDER BY row_id) = 1""",
)
def first_seen_subject(spark, sf):
    return sq.first_seen_subject(feeds.recordings(spark, sf), "row_id")


EXT01_SQL = f"""WITH {WSUM_SQL}, f AS (SELECT recording_id, minute_index, max(ecg_value) AS score FROM d GROUP BY 1, 2
         HAVING max(ecg_value) > 80), g AS (SELECT *, minute_index - row_number() OVER
         (PARTITION BY recording_id ORDER BY minute_index) AS grp FROM f)
       SELECT recording_id, min(minute_index) AS start_minute, max(minute_index) AS end_minute, count(*) AS length,
              max(score) AS max_score FROM g GROUP BY recording_id, grp"""


def scored_windows(spark, sf):
    parts = ag.window_partials(feeds.clean_signals(spark, sf), ["ecg_value"], RATE, WIDTH)
    return parts.select(
        "recording_id", "minute_index", F.col("ecg_value__max").alias("score"),
        (F.col("ecg_value__max") > 80).cast("int").alias("y_pred"),
    )


@query("ext01_flagged_segments", EXT01_SQL)
def flagged_segments(spark, sf):
    return sq.flagged_segments(scored_windows(spark, sf))


# ---------------------------------------------------------------- validation


def record_metadata(spark, sf):
    """Expectations per record, from the beat and signal streams themselves."""
    raw = feeds.raw_signals(spark, sf)
    return raw.groupBy("recording_id").agg(
        F.max("has_respiration").alias("has_respiration"),
        F.count(F.lit(1)).alias("num_samples"),
        (F.max("row_id") % 3 > 0).alias("has_apnea_annotations"),
        (F.max("row_id") % 5 > 0).alias("has_qrs_annotations"),
    )


META_SQL = """meta AS (SELECT recording_id, bool_or(has_respiration) AS has_respiration, count(*) AS num_samples,
   max(row_id) % 3 > 0 AS has_apnea_annotations, max(row_id) % 5 > 0 AS has_qrs_annotations FROM raw GROUP BY 1),
 summ AS (SELECT recording_id, num_samples - 1 AS expected_samples FROM meta WHERE num_samples % 2 = 0),
 expe AS (SELECT recording_id, coalesce(expected_samples, num_samples) AS expected_row_count
          FROM meta LEFT JOIN summ USING (recording_id))"""


def expectation(spark, sf, meta):
    summary = meta.where(F.col("num_samples") % 2 == 0).select(
        "recording_id", (F.col("num_samples") - 1).alias("expected_samples")
    )
    return va.expected_rows(meta, summary)


def flat(df):
    """Message arrays as text, so that results compare as plain values."""
    return df.withColumn("issues", F.concat_ws("; ", "issues")).withColumn("warnings", F.concat_ws("; ", "warnings"))


@query("val05_expected_rows", f"WITH {feeds.RAW_SQL}, {META_SQL} SELECT * FROM expe")
def expected_rows(spark, sf):
    return expectation(spark, sf, record_metadata(spark, sf))


VSIG_SQL = f"""vsrc AS (SELECT *, lag(sample_index) OVER w AS pi, lag(recorded_at) OVER w AS pt FROM sig
     WINDOW w AS (PARTITION BY recording_id ORDER BY row_id)),
 vm AS (SELECT recording_id, count(*) AS row_count, count(*) FILTER (sample_index <> pi + 1) AS gaps,
     count(*) FILTER (recorded_at <= pt) AS tf,
     bool_or(coalesce({', '.join(EXTRA_CHANNELS)}) IS NOT NULL) AS seen,
     arg_min(recorded_at, row_id) AS first_timestamp, arg_max(recorded_at, row_id) AS last_timestamp FROM vsrc GROUP BY 1),
 vs AS (SELECT recording_id, row_count, expected_row_count, first_timestamp, last_timestamp,
   concat_ws('; ', CASE WHEN gaps > 0 THEN 'sample_index gaps: ' || gaps END,
     CASE WHEN tf > 0 THEN 'non-increasing timestamps: ' || tf END,
     CASE WHEN row_count <> expected_row_count THEN 'signal row count mismatch: expected ' || expected_row_count
          || ', found ' || row_count END,
     CASE WHEN NOT has_respiration AND seen THEN 'single-channel record contains extra channel values' END) AS issues,
   concat_ws('; ', CASE WHEN has_respiration AND NOT seen THEN 'extra channels announced but all values are NULL' END)
     AS warnings
   FROM meta JOIN expe USING (recording_id) JOIN vm USING (recording_id))"""


def signal_report(spark, sf, meta):
    return va.validate_signals(feeds.clean_signals(spark, sf), meta, expectation(spark, sf, meta), "row_id")


@query("val01_validate_signals", f"WITH {SIG}, {META_SQL}, {VSIG_SQL} SELECT * FROM vs")
def validate_signals(spark, sf):
    return flat(signal_report(spark, sf, record_metadata(spark, sf)))


def vann_sql(name: str, source: str, want: str, index: str) -> str:
    return f"""{name} AS (SELECT m.recording_id, coalesce(row_count, 0) AS row_count, first_timestamp, last_timestamp,
      concat_ws('; ', CASE WHEN tf > 0 THEN 'non-monotonic timestamps: ' || tf END,
                CASE WHEN xf > 0 THEN 'non-monotonic {index}: ' || xf END) AS issues,
      concat_ws('; ', CASE WHEN {want} AND row_count IS NULL THEN 'annotations expected but empty' END) AS warnings
      FROM meta m LEFT JOIN (SELECT recording_id, count(*) AS row_count, count(*) FILTER (recorded_at < pt) AS tf,
          count(*) FILTER ({index} < px) AS xf, arg_min(recorded_at, row_id) AS first_timestamp,
          arg_max(recorded_at, row_id) AS last_timestamp
        FROM (SELECT *, lag(recorded_at) OVER w AS pt, lag({index}) OVER w AS px FROM {source}
              WINDOW w AS (PARTITION BY recording_id ORDER BY row_id)) GROUP BY 1) q USING (recording_id))"""


VLAB_SQL = vann_sql("va", "(SELECT * FROM mlab)", "has_apnea_annotations", "minute_index")
VBEAT_SQL = vann_sql("vb", "(SELECT * FROM beat)", "has_qrs_annotations", "sample_index")


def annotation_reports(spark, sf, meta):
    labels = label_rows(spark, sf).withColumnRenamed("label_at", "recorded_at")
    return (
        va.validate_annotations(labels, meta, "has_apnea_annotations", "minute_index", "row_id"),
        va.validate_annotations(feeds.beats(spark, sf), meta, "has_qrs_annotations", "sample_index", "row_id"),
    )


@query(
    "val02_validate_annotations",
    f"""WITH {SIG}, {LAB}, {MIN_SQL}, {BEAT}, {META_SQL}, {VLAB_SQL}, {VBEAT_SQL}
       SELECT 'apnea' AS section, * FROM va UNION ALL SELECT 'qrs', * FROM vb""",
)
def validate_annotations(spark, sf):
    a, b = annotation_reports(spark, sf, record_metadata(spark, sf))
    return flat(a.withColumn("section", F.lit("apnea")).unionByName(b.withColumn("section", F.lit("qrs"))))


VWIN_SQL = f"""wexp AS (SELECT recording_id, k + CASE WHEN num_samples % 3 = 0 THEN 1 ELSE 0 END AS want FROM meta
     JOIN (SELECT recording_id, count(DISTINCT sample_index // {WIDTH}) AS k FROM raw GROUP BY 1) USING (recording_id)),
 vw AS (SELECT m.recording_id, n AS row_count, want AS expected_row_count,
   nl AS labeled_windows, concat_ws('; ', CASE WHEN n <> want THEN
      'window row count mismatch: expected ' || want || ', found ' || n END,
      CASE WHEN NOT has_apnea_annotations AND nl > 0 THEN 'unlabelled record contains labels in windows' END) AS issues,
   concat_ws('; ', CASE WHEN has_apnea_annotations AND nl = 0 THEN 'labelled record has no labeled windows' END) AS warnings
   FROM meta m JOIN wexp USING (recording_id) JOIN (
     SELECT recording_id, count(*) AS n, count(apnea_label) AS nl FROM wins LEFT JOIN lastlab USING (recording_id, minute_index)
     GROUP BY 1) USING (recording_id))"""


def window_expectation(spark, sf, meta):
    """Sample counts that day windows of this sparse stream are tested against: right for two records of three."""
    days = feeds.raw_signals(spark, sf).select("recording_id", (F.floor(F.col("sample_index") / WIDTH)).alias("d")).distinct()
    count = days.groupBy("recording_id").agg(F.count(F.lit(1)).alias("k"))
    off = (F.col("num_samples") % 3 == 0).cast("long")
    return meta.join(count, "recording_id").select("recording_id", ((F.col("k") + off) * WIDTH).alias("expected_row_count"))


def window_report(spark, sf, meta):
    return va.validate_windows(day_windows(spark, sf), meta, window_expectation(spark, sf, meta), rate=RATE, width=WIDTH)


@query("val03_validate_windows", f"WITH {WSUM_SQL}, {META_SQL}, {VWIN_SQL} SELECT * FROM vw")
def validate_windows(spark, sf):
    return flat(window_report(spark, sf, record_metadata(spark, sf)))


STATUS_SQL = f"""{WSUM_SQL}, {META_SQL}, {VSIG_SQL}, {VLAB_SQL}, {VBEAT_SQL}, {VWIN_SQL},
 st AS (SELECT recording_id, CASE WHEN vs.issues <> '' OR va.issues <> '' OR vb.issues <> '' OR vw.issues <> '' THEN 'fail'
               WHEN vs.warnings <> '' OR va.warnings <> '' OR vb.warnings <> '' OR vw.warnings <> '' THEN 'warn' ELSE 'pass' END AS status
        FROM vs JOIN va USING (recording_id) JOIN vb USING (recording_id) JOIN vw USING (recording_id))"""


def reports(spark, sf):
    """Status of each record over all four sections."""
    meta = record_metadata(spark, sf)
    a, b = annotation_reports(spark, sf, meta)
    sections = {"signals": signal_report(spark, sf, meta), "apnea": a, "qrs": b, "windows": window_report(spark, sf, meta)}
    return va.classify(sections).select("recording_id", "status")


@query("val04_classify", f"WITH {STATUS_SQL} SELECT * FROM st")
def classify(spark, sf):
    return reports(spark, sf)


@query(
    "ag27_status_counts",
    f"""WITH {STATUS_SQL} SELECT u.status, (SELECT count(*) FROM st WHERE st.status = u.status) AS n
       FROM (VALUES ('pass'), ('warn'), ('fail')) u(status)""",
)
def status_counts(spark, sf):
    return va.status_counts(reports(spark, sf))


@query(
    "val06_merge_reports",
    """WITH f AS (SELECT o_orderkey, o_orderstatus FROM orders WHERE o_totalprice > 200000),
            s AS (SELECT o_orderkey, 'stored-' || o_orderpriority AS o_orderstatus FROM orders)
       SELECT o_orderkey, coalesce(f.o_orderstatus, s.o_orderstatus) AS status, NULL::VARCHAR AS path,
              coalesce(f.o_orderstatus, s.o_orderstatus) AS source_path, FALSE AS artifact_retained,
              CASE WHEN f.o_orderkey IS NOT NULL THEN 'fresh' ELSE 'stored' END AS origin
       FROM f FULL JOIN s USING (o_orderkey)""",
)
def merge_reports(spark, sf):
    o = table(spark, sf, "orders")
    status = F.col("o_orderstatus")
    fresh = o.where("o_totalprice > 200000").select("o_orderkey", status.alias("status"), status.alias("path"))
    old = F.concat(F.lit("stored-"), F.col("o_orderpriority"))
    stored = o.select("o_orderkey", old.alias("status"), old.alias("path"))
    return va.merge_reports(fresh, stored, ["status", "path"], "o_orderkey", retained=False, path="path")


STATS_SQL = f"""{WSUM_SQL}, xs AS (
  SELECT recording_id, coalesce(signal_rows, 0) AS signal_rows, signal_start_at, signal_end_at, coalesce(bad, 0) AS non_finite_values_replaced,
         coalesce(a.n, 0) AS apnea_events, a.f AS apnea_start_at, a.l AS apnea_end_at,
         coalesce(q.n, 0) AS qrs_events, q.f AS qrs_start_at, q.l AS qrs_end_at,
         coalesce(window_rows, 0) AS window_rows, coalesce(annotated_window_rows, 0) AS annotated_window_rows
  FROM (SELECT recording_id, count(*) AS signal_rows, arg_min(recorded_at, row_id) AS signal_start_at,
          arg_max(recorded_at, row_id) AS signal_end_at,
          CAST(sum({' + '.join(f'CAST({c}_replaced AS BIGINT)' for c in CHANNELS)}) AS BIGINT) AS bad FROM sig GROUP BY 1)
  FULL JOIN (SELECT recording_id, count(*) AS n, arg_min(recorded_at, row_id) AS f, arg_max(recorded_at, row_id) AS l
        FROM mlab GROUP BY 1) a USING (recording_id)
  FULL JOIN (SELECT recording_id, count(*) AS n, arg_min(recorded_at, row_id) AS f, arg_max(recorded_at, row_id) AS l
        FROM beat GROUP BY 1) q USING (recording_id)
  FULL JOIN (SELECT recording_id, count(*) AS window_rows, count(apnea_label) AS annotated_window_rows
        FROM wins LEFT JOIN lastlab USING (recording_id, minute_index) GROUP BY 1) w USING (recording_id))"""


def stats(spark, sf):
    signals = feeds.clean_signals(spark, sf)
    labels = label_rows(spark, sf)
    parts = ag.window_partials(signals, ["ecg_value"], RATE, WIDTH).select("recording_id", "minute_index")
    return va.extraction_stats(
        signals, labels.withColumnRenamed("label_at", "recorded_at"), feeds.beats(spark, sf),
        ag.attach_labels(parts, labels, order="row_id"), [f"{c}_replaced" for c in CHANNELS], signal_order="row_id",
    )


@query("ag07_extraction_stats", f"WITH {STATS_SQL} SELECT * FROM xs")
def extraction_stats(spark, sf):
    return stats(spark, sf)


@query(
    "ag08_transformation_totals",
    f"WITH {STATS_SQL} SELECT count(*) AS record_count, "
    + ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in va.TOTALS) + " FROM xs",
)
def transformation_totals(spark, sf):
    return va.transformation_totals(stats(spark, sf))

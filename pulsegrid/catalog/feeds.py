"""Roles of the engine's tables played by the driver's tables, in Spark and in SQL.

Both forms spell the same mapping: ``events`` gives signals, minute labels, beats and
timing samples, ``embeddings`` gives signal windows, ``labels`` with ``documents`` gives
window predictions, ``customer`` with ``orders`` gives subjects and recordings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.functions import clean, text, timeline
from pulsegrid.schema import CHANNELS, EXTRA_CHANNELS

BASE = "2024-01-01 00:00:00"
RATE = 1
WIDTH = 86_400  # seconds per window on the sparse events table
STEPS = 16  # bins per embedding


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def record_name(number: Column) -> Column:
    letter = F.substring(F.lit("abcx"), (F.pmod(number, F.lit(4)) + 1).cast("int"), F.lit(1))
    return F.concat(letter, F.format_string("%02d", timeline.floor_div(number, 4)))


RECORD_SQL = "substr('abcx', CAST(1 + {0} % 4 AS INT), 1) || printf('%02d', CAST({0} // 4 AS BIGINT))"

# ---------------------------------------------------------------- signals from events


def raw_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide signal rows with faults injected at fixed event ids."""
    ev = table(spark, sf_dir, "events")
    faulty = (
        F.when(F.col("event_id") % 97 == 3, F.lit(float("nan")))
        .when(F.col("event_id") % 89 == 5, F.lit(float("inf")))
        .when(F.col("event_id") % 83 == 7, F.lit(float("-inf")))
        .otherwise(F.col("value"))
    )
    kinds = dict(zip(EXTRA_CHANNELS, ("click", "view", "purchase", "signup"), strict=True))
    return ev.select(
        record_name(F.col("user_id")).alias("recording_id"),
        timeline.sample_index(F.col("ts"), RATE, BASE).alias("sample_index"),
        F.col("ts").alias("recorded_at"),
        F.col("event_id").alias("row_id"),
        faulty.alias("ecg_value"),
        *[F.when(F.col("event_type") == kind, faulty).alias(name) for name, kind in kinds.items()],
        (F.pmod(F.col("user_id"), F.lit(4)) < 2).alias("has_respiration"),
    )


def clean_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_signals(spark, sf_dir)
    return clean.clean_non_finite(clean.structural_nulls(raw, F.col("has_respiration")))


def _case(column: str) -> str:
    return (
        f"CASE WHEN event_id % 97 = 3 THEN 'NaN'::DOUBLE WHEN event_id % 89 = 5 THEN 'Infinity'::DOUBLE "
        f"WHEN event_id % 83 = 7 THEN '-Infinity'::DOUBLE ELSE {column} END"
    )


RAW_SQL = f"""raw AS (
  SELECT {RECORD_SQL.format('user_id')} AS recording_id,
         (epoch_us(ts) - epoch_us(TIMESTAMP '{BASE}')) // 1000000 AS sample_index,
         ts AS recorded_at, event_id AS row_id, v AS ecg_value,
         CASE WHEN event_type = 'click' THEN v END AS resp_c,
         CASE WHEN event_type = 'view' THEN v END AS resp_a,
         CASE WHEN event_type = 'purchase' THEN v END AS resp_n,
         CASE WHEN event_type = 'signup' THEN v END AS spo2,
         user_id % 4 < 2 AS has_respiration
  FROM (SELECT *, {_case('value')} AS v FROM events))"""

_keep = lambda c, f: f"CASE WHEN {f}isfinite({c}) THEN {c} END AS {c}"
_flag = lambda c, f: f"coalesce({f}NOT isfinite({c}), FALSE) AS {c}_replaced"
SIGNALS_SQL = (
    RAW_SQL
    + """, sig AS (
  SELECT recording_id, sample_index, recorded_at, row_id, has_respiration, """
    + ", ".join(
        part
        for c in CHANNELS
        for gate in ["" if c == "ecg_value" else "has_respiration AND "]
        for part in (_keep(c, gate), _flag(c, gate))
    )
    + """
  FROM raw)"""
)

# ---------------------------------------------------------------- minute labels and beats


def minute_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label rows: the error events, text by a fixed rule on the event id."""
    ev = table(spark, sf_dir, "events").where(F.col("event_type") == "error")
    texts = F.array(*[F.lit(t) for t in ("A", "N", " a ", "apnea", "1", "")])
    return ev.select(
        record_name(F.col("user_id")).alias("recording_id"),
        F.col("ts").alias("recorded_at"),
        timeline.sample_index(F.col("ts"), RATE, BASE).alias("sample_index"),
        F.col("event_id").alias("row_id"),
        F.get(texts, (F.col("event_id") % 6).cast("int")).alias("label"),
    )


LABELS_SQL = f"""lab AS (
  SELECT {RECORD_SQL.format('user_id')} AS recording_id, ts AS recorded_at,
         (epoch_us(ts) - epoch_us(TIMESTAMP '{BASE}')) // 1000000 AS sample_index, event_id AS row_id,
         CASE event_id % 6 WHEN 0 THEN 'A' WHEN 1 THEN 'N' WHEN 2 THEN ' a ' WHEN 3 THEN 'apnea'
              WHEN 4 THEN '1' ELSE '' END AS label
  FROM events WHERE event_type = 'error')"""


def beats(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").where(F.col("event_type") == "click")
    return ev.select(
        record_name(F.col("user_id")).alias("recording_id"),
        timeline.sample_index(F.col("ts"), RATE, BASE).alias("sample_index"),
        F.col("ts").alias("recorded_at"),
        F.col("event_id").alias("row_id"),
    )


BEATS_SQL = f"""beat AS (
  SELECT {RECORD_SQL.format('user_id')} AS recording_id,
         (epoch_us(ts) - epoch_us(TIMESTAMP '{BASE}')) // 1000000 AS sample_index,
         ts AS recorded_at, event_id AS row_id
  FROM events WHERE event_type = 'click')"""

# ---------------------------------------------------------------- subjects and recordings


def recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as recordings; the customer is the subject."""
    o = table(spark, sf_dir, "orders")
    name = record_name(F.col("o_orderkey"))
    return o.select(
        F.col("o_orderkey").alias("row_id"),
        name.alias("recording_id"),
        F.concat(F.lit("subject_"), F.col("o_custkey").cast("string")).alias("subject_id"),
        F.when(F.col("o_orderstatus") == "O", "test").when(F.col("o_orderstatus") == "F", "learning")
        .otherwise("other").alias("split"),
        text.category(name).alias("record_category"),
        F.col("o_orderdate").alias("recording_start_time"),
        F.col("o_totalprice").alias("total"),
    )


RECORDINGS_SQL = f"""rec AS (
  SELECT o_orderkey AS row_id, {RECORD_SQL.format('o_orderkey')} AS recording_id,
         'subject_' || o_custkey AS subject_id,
         CASE o_orderstatus WHEN 'O' THEN 'test' WHEN 'F' THEN 'learning' ELSE 'other' END AS split,
         substr('abcx', CAST(1 + o_orderkey % 4 AS INT), 1) AS record_category,
         o_orderdate AS recording_start_time, o_totalprice AS total
  FROM orders)"""


def subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.concat(F.lit("subject_"), F.col("c_custkey").cast("string")).alias("subject_id"),
        F.col("c_name").alias("notes"),
        (F.col("c_acctbal") > 0).alias("active"),
    )


SUBJECTS_SQL = """sub AS (
  SELECT 'subject_' || c_custkey AS subject_id, c_name AS notes, c_acctbal > 0 AS active FROM customer)"""

# ---------------------------------------------------------------- windows from embeddings


def windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signal windows: one embedding is one window of samples."""
    e = table(spark, sf_dir, "embeddings")
    number = F.pmod(F.col("vec_id"), F.lit(40))
    rec = record_name(number)
    return e.select(
        F.col("vec_id").alias("window_id"),
        rec.alias("recording_id"),
        timeline.synth_ts(timeline.floor_div(F.col("vec_id"), 40) * 60, 1, BASE).alias("window_start"),
        (F.col("label") % 2).alias("y"),
        F.transform(F.col("embedding"), lambda v: v.cast("double")).alias("ecg"),
        text.dataset_split(rec).alias("split"),
    )


WINDOWS_SQL = f"""win AS (
  SELECT *, CASE WHEN substr(recording_id, 1, 1) = 'x' THEN 'test' ELSE 'learning' END AS split
  FROM (SELECT vec_id AS window_id, {RECORD_SQL.format('(vec_id % 40)')} AS recording_id,
               TIMESTAMP '{BASE}' + to_minutes(CAST(vec_id // 40 AS BIGINT)) AS window_start,
               label % 2 AS y, embedding AS ecg FROM embeddings)),
smp AS (
  SELECT window_id, recording_id, y, split, pos, v
  FROM (SELECT window_id, recording_id, y, split, unnest(ecg)::DOUBLE AS v,
               generate_subscripts(ecg, 1) - 1 AS pos FROM win))"""

# ---------------------------------------------------------------- predictions from labels and documents


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One prediction per labelled document: score is the length, flag is length over 2000."""
    lab = table(spark, sf_dir, "labels")
    doc = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return lab.join(doc, "doc_id").select(
        F.col("doc_id").alias("row_id"),
        F.concat_ws("|", "source", "lang").alias("recording_id"),
        F.col("toxic").alias("y_true"),
        (F.col("n_chars") > 2000).cast("int").alias("y_pred"),
        F.col("n_chars").cast("double").alias("score"),
        F.when(F.col("quality") == 1, "val").otherwise("test").alias("split"),
    )


PREDICTIONS_SQL = """pred AS (
  SELECT l.doc_id AS row_id, d.source || '|' || d.lang AS recording_id, l.toxic AS y_true,
         CASE WHEN d.n_chars > 2000 THEN 1 ELSE 0 END AS y_pred, d.n_chars::DOUBLE AS score,
         CASE WHEN l.quality = 1 THEN 'val' ELSE 'test' END AS split
  FROM labels l JOIN documents d USING (doc_id))"""

"""From raw files and annotation rows to cleaned, validated streams of records."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.functions import clean, text, timeline
from pulsegrid.operators import aggregates as ag
from pulsegrid.operators import filters as fl
from pulsegrid.operators import sequence as sq
from pulsegrid.operators import validation as va
from pulsegrid.plans.joins import join_lookup
from pulsegrid.schema import BASE_TIME, CHANNELS, WINDOW_SECONDS
from pulsegrid.session import materialise, named, stored
from pulsegrid.sources import files, paired, readers

KEY = "recording_id"
POSITION = "file_position"


def read_metadata_from_headers(spark: SparkSession, raw_dir: str, provenance: dict[str, str] | None = None) -> DataFrame:
    """Metadata row of every record found in a raw folder."""
    listed = files.list_files(spark, raw_dir)
    picked = files.pick_headers(listed)
    headers = readers.read_headers(spark, raw_dir, "*.hea")
    return files.recordings_from_headers(picked, headers, listed, provenance)


def raw_streams(spark: SparkSession, raw_dir: str, metadata: DataFrame, max_samples: int | None = None) -> DataFrame:
    """Main and extra channels of all records on one sample index, with synthetic time.

    Values are in the units that the headers give for each channel; every row carries the rate
    of its record. Both files of a record are read by one task range by range, no sample is shuffled.
    """
    facts = metadata.select(
        F.col("record_name").alias(KEY), "sampling_rate_hz", "has_respiration"
    )
    listed = files.list_files(spark, raw_dir, "*.dat")
    require_metadata(listed.select(F.regexp_replace(F.lower(files.stem(F.col("name"))), "r$", "").alias(KEY)), facts, "samples")
    placed = paired.read_paired(spark, paired.work_orders(spark, raw_dir, facts), high=max_samples)
    stamped = placed.withColumn("recorded_at", timeline.synth_ts(F.col("sample_index"), F.col("sampling_rate_hz")))
    return clean.clean_non_finite(clean.structural_nulls(stamped, F.col("has_respiration")))


def label_stream(annotations: DataFrame, metadata: DataFrame, max_samples: int | None = None) -> DataFrame:
    """Label rows from annotation rows (recording_id, ordinal, sample_index, aux_note, symbol).

    The minute is the place of the label in its record, also after labels past the cap were
    dropped; the time comes from the sample the label sits on.
    """
    rates = metadata.select(F.col("record_name").alias(KEY), "sampling_rate_hz")
    require_metadata(annotations, rates, "labels")
    label = text.parse_label(F.col("aux_note"), F.col("symbol"))
    cap = None if max_samples is None else F.lit(max_samples)
    numbered = fl.cap_annotations(annotations, cap, [KEY], ["ordinal"])
    placed = join_lookup(numbered, rates, [KEY], "inner", computed=True)
    return placed.select(
        KEY, F.col("minute_index").cast("int").alias("minute_index"), "ordinal",
        timeline.synth_ts(F.col("sample_index"), F.col("sampling_rate_hz")).alias("recorded_at"),
        label.alias("label"), text.label_to_bool(label).alias("is_apnea"),
    )


def beat_stream(annotations: DataFrame, metadata: DataFrame, max_samples: int | None = None) -> DataFrame:
    """Beat rows (recording_id, sample_index, recorded_at, rate, file position if given) below the cap."""
    rates = metadata.select(F.col("record_name").alias(KEY), "sampling_rate_hz")
    require_metadata(annotations, rates, "beats")
    kept = annotations if max_samples is None else annotations.where(F.col("sample_index") < max_samples)
    placed = join_lookup(kept, rates, [KEY], "inner", computed=True)
    return placed.select(
        KEY, "sample_index", timeline.synth_ts(F.col("sample_index"), F.col("sampling_rate_hz")).alias("recorded_at"),
        "sampling_rate_hz", *[c for c in (POSITION,) if c in annotations.columns],
    )


def require_metadata(rows: DataFrame, metadata: DataFrame, what: str) -> None:
    """Raise if rows belong to records without a metadata row; they must not get lost in a join."""
    lost = rows.select(KEY).distinct().join(metadata.select(KEY), KEY, "left_anti")
    missing = named(materialise(lost), KEY)
    if missing:
        raise ValueError(f"{what} of records without metadata: {missing}")


def recording_rows(metadata: DataFrame) -> DataFrame:
    """Rows of the recordings table."""
    return metadata.select(
        F.col("record_name").alias(KEY), "subject_id", "split", F.col("category").alias("record_category"),
        "has_respiration", F.col("has_apnea_annotations").alias("has_apnea_labels"), "source_record_name",
        "sampling_rate_hz", "length_seconds", F.lit(BASE_TIME).cast("timestamp").alias("recording_start_time"),
    )


def process(
    signals: DataFrame, labels: DataFrame, beats: DataFrame, metadata: DataFrame, rate: int | str = "sampling_rate_hz",
    max_samples: int | None = None, width: int = WINDOW_SECONDS,
) -> Mapping[str, DataFrame]:
    """Windows, extraction statistics, validation report and tables of a set of records.

    ``rate`` is the column of samples, beats and metadata with each record's rate, or one rate.
    Order is checked in file order where a stream has a column ``file_position``, else samples
    and beats in the order of their index.
    """
    place = lambda df: POSITION if POSITION in df.columns else "sample_index"
    signals = stored(signals, "signals")
    windows = stored(ag.window_summaries(signals, labels, beats, CHANNELS, rate, width, BASE_TIME), "windows")
    facts = metadata.withColumnRenamed("record_name", KEY)
    expected = va.expected_rows(facts, None, max_samples)
    report = va.classify({
        "signals": va.validate_signals(signals, facts, expected, place(signals)),
        "apnea": va.validate_annotations(labels, facts, "has_apnea_annotations", "minute_index", "ordinal"),
        "qrs": va.validate_annotations(beats, facts, "has_qrs_annotations", "sample_index", place(beats)),
        "windows": va.validate_windows(windows, facts, expected, "minute_index", rate, width),
    })
    stats = va.extraction_stats(
        signals, labels.withColumn("row_id", F.col("ordinal")), beats.withColumn("row_id", F.col("sample_index")), windows,
        [f"{c}_replaced" for c in CHANNELS],
    )
    recordings = recording_rows(metadata)
    return {
        "subjects": sq.first_seen_subject(recordings, KEY),
        "recordings": recordings,
        "signals": signals.select(KEY, "sample_index", "recorded_at", *CHANNELS),
        "annotations_apnea": labels.select(KEY, "minute_index", "recorded_at", "label", "is_apnea"),
        "annotations_qrs": beats.select(KEY, "sample_index", "recorded_at"),
        "windows": windows,
        "stats": stats,
        "report": report,
    }

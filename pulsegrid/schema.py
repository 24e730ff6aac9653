"""Fixed table schemas and domain defaults."""

from __future__ import annotations

from pyspark.sql import types as T

# The sampling model and the channel names of the signal table.
SAMPLING_RATE_HZ = 100
WINDOW_SECONDS = 60
BASE_TIME = "2000-01-01 00:00:00"
MAIN_CHANNEL = "ecg_value"
EXTRA_CHANNELS = ("resp_c", "resp_a", "resp_n", "spo2")
CHANNELS = (MAIN_CHANNEL, *EXTRA_CHANNELS)

# The 35 recordings of the subject-independent development set.
DEVELOPMENT_RECORDS = (
    "a01", "a03", "a04", "a06", "a07", "a11", "a12", "a14", "a15", "a16", "a17",
    "b01", "b05",
    "c02", "c04", "c06", "c07", "c09", "c10",
    "x01", "x03", "x06", "x09", "x11", "x12", "x15", "x18", "x19", "x23", "x24",
    "x27", "x28", "x29", "x30", "x34",
)

# Morphology features in tensor order with their loss weights.
FEATURES = ("mean", "std", "min", "max", "range", "slope", "energy")
FEATURE_WEIGHTS = (0.10, 0.25, 0.10, 0.10, 0.25, 0.05, 0.15)

SIGNALS = T.StructType(
    [
        T.StructField("recording_id", T.StringType(), False),
        T.StructField("sample_index", T.LongType(), False),
        T.StructField("recorded_at", T.TimestampType(), False),
        *[T.StructField(name, T.DoubleType()) for name in CHANNELS],
    ]
)
BEATS = T.StructType(
    [
        T.StructField("recording_id", T.StringType(), False),
        T.StructField("sample_index", T.LongType(), False),
        T.StructField("recorded_at", T.TimestampType(), False),
    ]
)
METADATA_ENTRY = T.StructType(
    [
        T.StructField("record_name", T.StringType()),
        T.StructField("subject_id", T.StringType()),
        T.StructField("source_record_name", T.StringType()),
        T.StructField("split", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("sampling_rate_hz", T.IntegerType()),
        T.StructField("num_samples", T.LongType()),
        T.StructField("length_seconds", T.IntegerType()),
        T.StructField("signals", T.ArrayType(T.StringType())),
        T.StructField("has_respiration", T.BooleanType()),
        T.StructField("has_apnea_annotations", T.BooleanType()),
        T.StructField("has_qrs_annotations", T.BooleanType()),
        T.StructField("selected_header_file", T.StringType()),
        T.StructField("artificial_start_time", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("source_url", T.StringType()),
        T.StructField("doi", T.StringType()),
        T.StructField("license", T.StringType()),
    ]
)
CHANNEL_STATS = T.StructType(
    [
        T.StructField("available", T.BooleanType()),
        T.StructField("count", T.LongType()),
        T.StructField("missing_count", T.LongType()),
        T.StructField("non_finite_replaced", T.LongType()),
        T.StructField("min", T.DoubleType()),
        T.StructField("max", T.DoubleType()),
        T.StructField("mean", T.DoubleType()),
        T.StructField("std", T.DoubleType()),
        T.StructField("normalized_mean", T.DoubleType()),
    ]
)
WINDOWS = T.StructType(
    [
        T.StructField("recording_id", T.StringType(), False),
        T.StructField("minute_index", T.LongType(), False),
        T.StructField("window_start_at", T.TimestampType()),
        T.StructField("window_end_at", T.TimestampType()),
        T.StructField("sample_start_index", T.LongType()),
        T.StructField("sample_end_index", T.LongType()),
        T.StructField("sample_count", T.LongType()),
        T.StructField("apnea_label", T.StringType()),
        T.StructField("is_apnea", T.BooleanType()),
        T.StructField("qrs_count", T.LongType()),
        T.StructField("modalities", T.MapType(T.StringType(), CHANNEL_STATS)),
    ]
)

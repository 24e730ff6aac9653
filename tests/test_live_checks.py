"""Order checks and segments across micro-batches equal their batch forms."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid.operators import sequence as sq
from pulsegrid.operators import validation as va
from pulsegrid.schema import EXTRA_CHANNELS
from pulsegrid.streaming import checks

SIGNALS = "recording_id string, place long, sample_index long, recorded_at timestamp, spo2 double"


def fed(spark, folder, parts, schema):
    """A stream whose micro-batches are the given lists of rows, in order."""
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def faulty_rows(seed):
    import datetime as dt

    draw = random.Random(seed)
    rows = []
    for record in ("a01", "a02", "c05"):
        index, at = 0, 0
        for place in range(120):
            index += draw.choice([1] * 8 + [2, 0, -3])
            at += draw.choice([10] * 8 + [0, -5])
            missing = draw.random() < 0.05
            rows.append((record, place, None if missing else index, None if draw.random() < 0.05 else dt.datetime(2000, 1, 1) + dt.timedelta(seconds=at), 1.0 if record == "a01" and place == 60 else None))
    return rows


@pytest.mark.parametrize("cuts", [[], [1, 2, 50], [40, 80]])
def test_reports_equal_the_batch_for_any_cut(spark, tmp_path, cuts):
    rows = faulty_rows(len(cuts))
    bounds = [0, *cuts, 10**9]
    parts = [[r for r in rows if low <= r[1] < high] for low, high in zip(bounds, bounds[1:])]
    draw = random.Random(9)
    stream = fed(spark, f"{tmp_path}/in", [draw.sample(p, len(p)) for p in parts], SIGNALS)
    checks.start(checks.record_checks(stream, "place", extra=F.col("spo2").isNotNull()), f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    measured = checks.current_checks(spark, f"{tmp_path}/out")
    batch = spark.createDataFrame(rows, SIGNALS)
    meta = spark.createDataFrame([("a01", True), ("a02", False), ("c05", False), ("x01", False)], "recording_id string, has_respiration boolean").withColumn("wanted", F.lit(True))
    expected = meta.select("recording_id", F.lit(120).cast("long").alias("expected_row_count"))
    full = batch.withColumns({c: F.lit(None).cast("double") for c in EXTRA_CHANNELS if c != "spo2"})
    want = va.validate_signals(full, meta, expected, "place", block=7)
    assert sorted(map(str, va.signal_report(measured, meta, expected).collect())) == sorted(map(str, want.collect()))
    marks = va.annotation_report(
        measured.select("recording_id", "row_count", F.col("time_falls").alias("time_faults"), F.col("index_falls").alias("index_faults"), "first_timestamp", "last_timestamp"),
        meta, "wanted", "sample_index",
    )
    want = va.validate_annotations(batch, meta, "wanted", "sample_index", "place")
    assert sorted(map(str, marks.collect())) == sorted(map(str, want.collect()))


def test_a_record_ends_after_idle_time(spark, tmp_path):
    import time

    rows = [r for r in faulty_rows(3) if r[0] == "a02"]
    stream = fed(spark, f"{tmp_path}/in", [rows[:60]], SIGNALS)
    live = checks.start(checks.record_checks(stream, "place", idle_ms=500), f"{tmp_path}/out", f"{tmp_path}/state", every="1 second")
    try:
        for _ in range(60):
            time.sleep(1)
            if list(tmp_path.glob("out/batch=1/_SUCCESS")) and checks.current_checks(spark, f"{tmp_path}/out").first()["ended"]:
                break
    finally:
        live.stop()
    found = checks.current_checks(spark, f"{tmp_path}/out").collect()
    assert [(r["recording_id"], r["row_count"], r["ended"]) for r in found] == [("a02", 60, True)]


WINDOWS = "recording_id string, minute_index long, window_start_at timestamp, y_pred int, score double"


@pytest.mark.parametrize("seed", [1, 2])
def test_segments_equal_the_batch_after_any_arrival_order(spark, tmp_path, seed):
    import datetime as dt

    draw = random.Random(seed)
    rows = [
        (r, m, dt.datetime(2000, 1, 1) + dt.timedelta(minutes=m), int(draw.random() < 0.6), round(draw.random(), 3))
        for r in ("a01", "b02") for m in range(60)
    ]
    shuffled = draw.sample(rows, len(rows))
    parts = [shuffled[i : i + 25] + rows[:3] for i in range(0, len(rows), 25)]  # repeats do no harm
    stream = fed(spark, f"{tmp_path}/in", parts, WINDOWS)
    checks.start(checks.live_segments(stream, "2 hours", "2000-01-01"), f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    got = checks.current_segments(spark, f"{tmp_path}/out")
    want = sq.flagged_segments(spark.createDataFrame(rows, WINDOWS))
    columns = ["recording_id", "start_minute", "end_minute", "length", "max_score"]
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, want.select(columns).collect()))
    assert spark.read.parquet(f"{tmp_path}/out").where("change = -1").count() > 0


def test_watermark_closes_segments_and_drops_late_windows(spark, tmp_path):
    import datetime as dt

    row = lambda m: ("a01", m, dt.datetime(2000, 1, 1) + dt.timedelta(minutes=m), 1, 0.5)
    stream = fed(spark, f"{tmp_path}/in", [[row(0), row(1)], [row(100)], [row(200)], [row(2), row(199)]], WINDOWS)
    checks.start(checks.live_segments(stream, "10 minutes", "2000-01-01"), f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    got = {(r["start_minute"], r["end_minute"]) for r in checks.current_segments(spark, f"{tmp_path}/out").collect()}
    assert got == {(0, 1), (100, 100), (199, 200)}  # minute 2 came too late


def test_merging_of_intervals():
    draw = random.Random(0)
    for _ in range(200):
        minutes = draw.sample(range(40), draw.randrange(1, 30))
        scores = {m: draw.random() for m in minutes}
        half = len(minutes) // 2
        held = merged = tuple(np.array([], dtype=t) for t in (np.int64, np.int64, float))
        for part in (minutes[:half], minutes[half:]):
            if part:
                merged = checks.merged(*(np.concatenate(x) for x in zip(held, (np.array(part), np.array(part), np.array([scores[m] for m in part])))))
                held = merged
        runs = []
        for m in sorted(minutes):
            if runs and runs[-1][1] == m - 1:
                runs[-1] = (runs[-1][0], m, max(runs[-1][2], scores[m]))
            else:
                runs.append((m, m, scores[m]))
        assert list(zip(*(x.tolist() for x in merged))) == runs

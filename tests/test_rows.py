"""Column rules, filters and the window table against plain Python."""

import datetime as dt
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulsegrid.functions import clean, text, timeline
from pulsegrid.operators import aggregates as ag
from pulsegrid.operators import filters as fl
from pulsegrid.operators import joins as jn
from pulsegrid.operators import reshape
from pulsegrid.operators import validation as va
from pulsegrid.schema import CHANNELS

NAN, INF = float("nan"), float("inf")


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_synth_ts(spark):
    assert one(spark, timeline.synth_ts(F.lit(123), 100)) == dt.datetime(2000, 1, 1, 0, 0, 1, 230000)
    assert one(spark, timeline.synth_ts(F.lit(1), 3)) == dt.datetime(2000, 1, 1, 0, 0, 0, 333333)
    assert one(spark, timeline.sample_index(F.lit("2000-01-01 00:00:01.239"), 100)) == 123


def test_length_is_half_to_even(spark):
    df = spark.createDataFrame([(n,) for n in range(0, 40)], "n long")
    got = {r["n"]: r["s"] for r in df.select("n", timeline.length_seconds(F.col("n"), 2).alias("s")).collect()}
    assert got == {n: round(n / 2) for n in range(40)}


def test_normalise_ts(spark):
    texts = ["2024-01-02T03:04:05Z", "2024-01-02T03:04:05.25+02:00", "2024-01-02 03:04:05", " 2024-01-02T03:04:05.000001 "]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(timeline.normalise_ts(F.col("t"))).collect()]

    def expected(t):
        v = dt.datetime.fromisoformat(t.strip().replace("Z", "+00:00"))
        v = v.replace(tzinfo=dt.timezone.utc) if v.tzinfo is None else v.astimezone(dt.timezone.utc)
        return v.isoformat()

    assert got == [expected(t) for t in texts]


def test_labels(spark):
    rows = [("A", "x"), (" ", "N "), (None, None), ("apnea", ""), ("1", None), ("N", "A"), ("a\t", None)]
    df = spark.createDataFrame(rows, "aux string, sym string")
    out = df.select(text.parse_label(F.col("aux"), F.col("sym")).alias("l")).withColumn("b", text.label_to_bool(F.col("l")))
    assert [tuple(r) for r in out.collect()] == [
        ("A", True), ("N", False), ("", False), ("apnea", True), ("1", True), ("N", False), ("a", True),
    ]


def test_names_and_sizes(spark):
    rows = [("c05",), ("c06",), ("x01",), ("A12",)]
    df = spark.createDataFrame(rows, "r string")
    r = F.col("r")
    got = [tuple(x) for x in df.select(text.subject_of(r), text.dataset_split(r), text.category(r)).collect()]
    assert got == [("subject_c05_c06", "learning", "c"), ("subject_c05_c06", "learning", "c"),
                   ("subject_x01", "test", "x"), ("subject_A12", "learning", "a")]
    assert one(spark, text.safe_name(F.lit("  MSE + Trend (v2)/x "))) == "MSE_Trend_v2_x"
    sizes = [0, 1023, 1024, 1536, 1024**2, 1024**4 * 5000]
    assert [one(spark, text.format_bytes(F.lit(s))) for s in sizes] == [
        "0.00 B", "1023.00 B", "1.00 KB", "1.50 KB", "1.00 MB", "5000.00 TB"]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.one_of(st.none(), st.floats(allow_nan=True, allow_infinity=True)), min_size=1, max_size=40))
def test_clean_non_finite(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = {r["i"]: (r["v"], r["v_replaced"]) for r in clean.clean_non_finite(df, ["v"]).collect()}
    for i, v in enumerate(values):
        bad = v is not None and not math.isfinite(v)
        assert got[i] == (None if bad else v, bad)


def test_structural_nulls(spark):
    df = spark.createDataFrame([(1.0, 2.0, True, 4), (1.0, 2.0, False, 4), (1.0, 2.0, True, 3), (1.0, 2.0, None, 4)],
                               "ecg_value double, resp_c double, h boolean, n int")
    out = clean.structural_nulls(df, F.col("h"), F.col("n"), ["resp_c"]).collect()
    assert [r["resp_c"] for r in out] == [2.0, None, None, None]
    assert all(r["ecg_value"] == 1.0 for r in out)


def test_select_records_reports_unknown(spark):
    df = spark.createDataFrame([("a01",), ("b01",)], "recording_id string")
    ids = spark.createDataFrame([("a01",), ("z99",)], "recording_id string")
    with pytest.raises(ValueError, match="z99"):
        fl.select_records(df, ids)
    assert fl.select_records(df, ids.where("recording_id = 'a01'")).count() == 1
    assert fl.select_records(df).count() == 2


def test_cap_annotations_keeps_numbers(spark):
    df = spark.createDataFrame([("a", 0, 100), ("a", 1, 900), ("a", 2, 200)], "recording_id string, o int, sample_index long")
    out = fl.cap_annotations(df, F.lit(500), ["recording_id"], ["o"]).collect()
    assert sorted(r["minute_index"] for r in out) == [0, 2]


def test_control_normal_empty_raises(spark):
    df = spark.createDataFrame([("a01", 0)], "recording_id string, y int")
    with pytest.raises(ValueError):
        fl.control_normal(df, check=True)
    assert fl.all_normal(df, check=True).count() == 1


def test_quality_rules(spark):
    parent = spark.createDataFrame([("s1",)], "subject_id string")
    df = spark.createDataFrame(
        [("r1", "s1", "test", 100), ("r1", "s2", "bad", 0), ("r2", None, None, None)],
        "recording_id string, subject_id string, split string, rate int",
    )
    out = fl.quality_rules(
        df, "recordings", {"split": F.col("split").isin("learning", "test"), "rate": F.col("rate") > 0,
                           "subject": F.col("subject_id").isNotNull()},
        {"pk": ["recording_id"]}, {"fk": ("subject_id", parent, "subject_id")},
    )
    assert {r["rule"]: r["violations"] for r in out.collect()} == {"split": 1, "rate": 1, "subject": 1, "pk": 1, "fk": 1}


def test_align_channels(spark):
    main = spark.createDataFrame([("a", i, 1.0) for i in range(5)] + [("b", i, 2.0) for i in range(3)],
                                 "recording_id string, sample_index long, ecg_value double")
    extra = spark.createDataFrame([("a", i, 7.0) for i in range(3)], "recording_id string, sample_index long, spo2 double")
    out = jn.align_channels(main, extra, channels=["spo2"]).collect()
    assert sorted((r["recording_id"], r["sample_index"], r["spo2"]) for r in out) == [
        ("a", 0, 7.0), ("a", 1, 7.0), ("a", 2, 7.0), ("b", 0, None), ("b", 1, None), ("b", 2, None)]
    assert jn.align_channels(main, None, channels=["spo2"]).where("spo2 is null").count() == 8


def test_long_wide_round_trip(spark):
    rows = [(i, *[float(i * 10 + k) if (i + k) % 3 else None for k in range(5)]) for i in range(10)]
    df = spark.createDataFrame(rows, "id int, " + ", ".join(f"{c} double" for c in CHANNELS))
    back = reshape.to_wide(reshape.to_long(df, ["id"]), ["id"])
    assert sorted(map(tuple, back.collect())) == rows


def test_range_query_reaches_scan(spark, tmp_path):
    base = dt.datetime(2024, 1, 1)
    rows = [(r, base + dt.timedelta(minutes=i), float(i)) for r in ("a", "b") for i in range(200)]
    df = spark.createDataFrame(rows, "recording_id string, recorded_at timestamp_ntz, ecg_value double")
    df.write.parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    out = fl.range_query(stored, "a", "2024-01-01 00:30:00", "1 hour")
    assert [r["ecg_value"] for r in out.collect()] == [float(i) for i in range(30, 90)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(recording_id,a)" in plan and "GreaterThanOrEqual(recorded_at" in plan and "LessThan(recorded_at" in plan


# ---------------------------------------------------------------- window table


RATE, WIDTH = 2, 5  # ten samples a window


@pytest.fixture(scope="module")
def fixture(spark):
    """Three records: all channels with faults and a missing window, single channel, constant without labels."""
    rows = []

    def add(rec, i, main, extra):
        rows.append((rec, i, main, *[extra] * 4, rec == "a01"))

    for i in range(37):
        if 10 <= i < 20:
            continue
        main = {3: NAN, 4: INF, 5: -INF, 6: None}.get(i, float(i % 7))
        add("a01", i, main, None if i >= 30 else float(i) / 2)
    for i in range(21):
        add("b01", i, float(i * i), None)
    for i in range(10):
        add("x01", i, 5.0, None)
    schema = "recording_id string, sample_index long, ecg_value double, resp_c double, resp_a double, resp_n double, spo2 double, has_respiration boolean"
    df = spark.createDataFrame(rows, schema).withColumn("recorded_at", timeline.synth_ts(F.col("sample_index"), RATE))
    signals = clean.clean_non_finite(clean.structural_nulls(df, F.col("has_respiration")))
    labels = spark.createDataFrame(
        [("a01", 0, "A", True, 0), ("a01", 0, "N", False, 1), ("a01", 1, "A", True, 2), ("a01", 3, "apnea", True, 3), ("b01", 2, "N", False, 0)],
        "recording_id string, minute_index int, label string, is_apnea boolean, ordinal int",
    )
    beats = spark.createDataFrame(
        [("a01", 0), ("a01", 9), ("a01", 12), ("a01", 999), ("b01", 20)], "recording_id string, sample_index long"
    )
    return rows, signals.cache(), labels, beats


def test_window_summaries(spark, fixture):
    rows, signals, labels, beats = fixture
    out = ag.window_summaries(signals, labels, beats, CHANNELS, RATE, WIDTH).collect()
    got = {(r["recording_id"], r["minute_index"]): r for r in out}
    groups, whole = {}, {}
    for rec, i, *vals, has in rows:
        groups.setdefault((rec, i // 10), []).append((vals, has))
        whole.setdefault(rec, []).append((vals, has))
    assert set(got) == set(groups)

    def stats(cells, k):
        raw = [v[k] for v, _ in cells]
        good = [x for x in raw if x is not None and math.isfinite(x)]
        mean = sum(good) / len(good) if good else None
        std = math.sqrt(sum((x - mean) ** 2 for x in good) / len(good)) if len(good) > 1 else None
        return good, sum(x is not None and not math.isfinite(x) for x in raw), mean, std

    for key, cells in groups.items():
        r = got[key]
        assert r["sample_count"] == len(cells)
        assert r["sample_start_index"] == key[1] * 10 and r["sample_end_index"] == key[1] * 10 + 9
        assert r["window_start_at"] == dt.datetime(2000, 1, 1) + dt.timedelta(seconds=key[1] * 5)
        for k, name in enumerate(CHANNELS):
            m = r["modalities"][name]
            if k and not cells[0][1]:
                assert tuple(m) == (False, 0, 0, 0, None, None, None, None, None)
                continue
            good, replaced, mean, std = stats(cells, k)
            assert (m["available"], m["count"], m["missing_count"], m["non_finite_replaced"]) == (
                True, len(good), len(cells) - len(good), replaced)
            assert m["min"] == (min(good) if good else None) and m["max"] == (max(good) if good else None)
            assert m["mean"] == (pytest.approx(mean) if good else None)
            assert m["std"] == (pytest.approx(std) if std is not None else None)
            _, _, rmean, rstd = stats(whole[key[0]], k)
            if mean is None or not rstd:
                assert m["normalized_mean"] is None
            else:
                assert m["normalized_mean"] == pytest.approx((mean - rmean) / rstd)
    assert got["a01", 0]["apnea_label"] == "N" and got["a01", 3]["apnea_label"] == "apnea"
    assert ("a01", 1) not in got and got["a01", 2]["apnea_label"] is None
    assert [got[k]["qrs_count"] for k in (("a01", 0), ("a01", 2), ("b01", 2), ("x01", 0))] == [2, 0, 1, 0]


def test_assemble_windows(spark, fixture):
    _, signals, _, _ = fixture
    doubled = signals.unionByName(signals.where("recording_id = 'x01'"))
    out = ag.assemble_windows(doubled.where("recording_id <> 'a01'"), 10, RATE, WIDTH).collect()
    assert sorted((r["recording_id"], r["minute_index"], len(r["ecg"])) for r in out) == [("b01", 0, 10), ("b01", 1, 10)]
    assert next(r for r in out if r["minute_index"] == 1)["ecg"] == [float(i * i) for i in range(10, 20)]


def test_validation(spark, fixture):
    rows, signals, labels, beats = fixture
    windows = ag.window_summaries(signals, labels, beats, CHANNELS, RATE, WIDTH)
    meta = spark.createDataFrame(
        [("a01", True, True, True, 37), ("b01", False, False, True, 21), ("x01", True, True, False, 10), ("z01", False, False, False, 5)],
        "recording_id string, has_respiration boolean, has_apnea_annotations boolean, has_qrs_annotations boolean, num_samples long",
    )
    expected = va.expected_rows(meta, None)
    sections = {
        "signals": va.validate_signals(signals, meta, expected, "sample_index"),
        "apnea": va.validate_annotations(labels.withColumn("recorded_at", F.col("ordinal")), meta, "has_apnea_annotations", "minute_index", "ordinal"),
        "qrs": va.validate_annotations(beats.withColumn("recorded_at", F.col("sample_index")), meta, "has_qrs_annotations", "sample_index", "sample_index"),
        "windows": va.validate_windows(windows, meta, expected, rate=RATE, width=WIDTH),
    }
    out = {r["recording_id"]: r for r in va.classify(sections).collect()}
    assert out["a01"]["signals"]["issues"] == ["sample_index gaps: 1", "signal row count mismatch: expected 37, found 27"]
    assert out["a01"]["windows"]["issues"] == ["window row count mismatch: expected 4, found 3"]
    assert out["b01"]["windows"]["issues"] == ["unlabelled record contains labels in windows"]
    assert out["b01"]["signals"]["issues"] == [] and out["b01"]["windows"]["expected_row_count"] == 3
    assert out["x01"]["signals"]["warnings"] == ["extra channels announced but all values are NULL"]
    assert "annotations expected but empty" in out["x01"]["apnea"]["warnings"]
    assert "labelled record has no labeled windows" in out["x01"]["windows"]["warnings"]
    assert out["z01"]["signals"]["issues"] == ["missing signals"]
    assert {k: r["status"] for k, r in out.items()} == {"a01": "fail", "b01": "fail", "x01": "warn", "z01": "fail"}
    counts = {r["status"]: r["n"] for r in va.status_counts(va.classify(sections)).collect()}
    assert sum(counts.values()) == 4 and set(counts) == {"pass", "warn", "fail"}
    absent = va.validate_annotations(
        labels.withColumn("recorded_at", F.col("ordinal")), meta, "has_apnea_annotations", "minute_index", "ordinal",
        present=labels.where("recording_id <> 'x01'"),
    )
    assert {r["recording_id"]: r["issues"] for r in absent.collect()}["x01"] == ["missing required annotations"]

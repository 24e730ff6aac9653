"""Files, tables, extraction and streaming loads."""

import datetime as dt
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid import schema
from pulsegrid.catalog import feeds  # noqa: F401 - sets nothing, checks the import
from pulsegrid.operators import benchlog as bl
from pulsegrid.operators import extraction as ex
from pulsegrid.sinks import exports, tables
from pulsegrid.sources import files, readers
from pulsegrid.streaming import ingest, live

RATE = 10


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    """Two recordings with a label file each: a01 with extra channels, c05 without; x03 cannot be parsed."""
    root = tmp_path_factory.mktemp("raw")
    n = 1250
    t = np.arange(n)
    main = (100 * np.sin(t / 7)).astype("<i2")
    (root / "a01.dat").write_bytes(main.tobytes())
    extra = np.stack([(t[:1210] * k) % 300 for k in (1, 2, 3, 4)], axis=1).astype("<i2")
    (root / "a01r.dat").write_bytes(extra.tobytes())
    (root / "c05.dat").write_bytes((main[:600] * 2).tobytes())
    (root / "a01.hea").write_text(f"# note\n\na01 1 {RATE} {n}\na01.dat 16 200 12 0 -12 -12 0 ECG\n")
    (root / "a01er.hea").write_text(
        f"a01er 5 {RATE}.0 {n} \r\na01.dat 16 200 12 0 -12 -12 0 ECG\r\n"
        + "".join(f"a01r.dat 16 20 16 0 0 0 0 {c}\r\n" for c in ("Resp C", "Resp A", "Resp N", "SpO2"))
    )
    (root / "C05.hea").write_text(f"c05 1 {RATE} 600\nc05.dat 16\n")
    (root / "x03.hea").write_text("# nothing here\nx03 1 fast 600\n")
    (root / "notes.txt").write_text("one\ntwo\nthree\n")
    for name in ("a01.apn", "c05r.apn", "c05er.qrs", "a01.qrs"):
        (root / name).write_bytes(b"\0")
    return str(root)


def test_headers(spark, raw):
    got = {r["path"].rsplit("/", 1)[-1]: r for r in readers.read_headers(spark, raw, "*.hea").collect()}
    r = got["a01er.hea"]
    assert (r["sampling_rate_hz"], r["num_samples"], r["signals"]) == (10, 1250, ["ECG", "Resp C", "Resp A", "Resp N", "SpO2"])
    assert got["C05.hea"]["signals"] == ["16"] and got["a01.hea"]["num_samples"] == 1250
    assert got["x03.hea"]["sampling_rate_hz"] is None and got["x03.hea"]["num_samples"] is None


def test_picking_and_flags(spark, raw):
    listed = files.list_files(spark, raw)
    picked = {r["record_name"]: r["header_file"] for r in files.pick_headers(listed).collect()}
    assert picked == {"a01": "a01er.hea", "c05": "C05.hea", "x03": "x03.hea"}
    meta = {r["record_name"]: r for r in ex.read_metadata_from_headers(spark, raw, {"source": "here"}).collect()}
    assert set(meta) == {"a01", "c05"}
    a, c = meta["a01"], meta["c05"]
    assert (a["has_respiration"], a["has_apnea_annotations"], a["has_qrs_annotations"]) == (True, True, True)
    assert (c["has_respiration"], c["has_apnea_annotations"], c["has_qrs_annotations"]) == (False, True, True)
    assert (a["length_seconds"], c["subject_id"], c["split"], a["source"]) == (125, "subject_c05_c06", "learning", "here")
    inventory = {r["extension"]: r["n_files"] for r in files.file_inventory(listed).collect()}
    assert inventory == {"dat": 3, "hea": 4, "txt": 1, "apn": 2, "qrs": 2}
    headers = readers.read_headers(spark, raw, "*.hea")
    summary = files.inventory_summary(listed, headers.join(files.pick_headers(listed), "path")).first()
    assert (summary["n_records"], summary["total_samples"], summary["warning"]) == (3, 1850, None)


def test_resolve_base(spark, raw):
    listed = files.list_files(spark, raw)
    wanted = spark.createDataFrame([("a01", ["zz", "a01", "a01er"]), ("c05", [None, "c05er", "c05r"])], "record_name string, bases array<string>")
    got = {r["record_name"]: r["base"] for r in files.resolve_base(wanted, listed, "apn").collect()}
    assert got == {"a01": "a01", "c05": "c05r"}
    with pytest.raises(FileNotFoundError, match="c05"):
        files.resolve_base(wanted, listed, "hea", required=True)


def test_samples_in_ranges(spark, raw):
    whole = np.frombuffer(open(f"{raw}/a01r.dat", "rb").read(), dtype="<i2").reshape(-1, 4) / 200
    df = readers.read_samples(spark, raw, schema.EXTRA_CHANNELS, "a01r.dat", range_bytes=800)
    assert df.rdd.getNumPartitions() > 1
    out = df.orderBy("sample_index").collect()
    assert [r["sample_index"] for r in out] == list(range(1210))
    assert np.allclose([[r[c] for c in schema.EXTRA_CHANNELS] for r in out], whole)
    assert readers.read_samples(spark, raw, ["v"], "a01.dat", max_samples=33).count() == 33


def test_channels_have_their_own_units(spark, tmp_path):
    raw = np.array([[100, -50], [0, 7], [-32768, 32767]], dtype="<i2")
    (tmp_path / "b01r.dat").write_bytes(raw.tobytes())
    (tmp_path / "b01r.hea").write_text("b01r 2 100 3\nb01r.dat 16 20(5)/mmHg 16 9 0 0 0 Resp C\nb01r.dat 16 0.5 16 -3 0 0 0 SpO2\n")
    calibration = readers.calibrations(readers.read_headers(spark, str(tmp_path), "*.hea"))
    assert [tuple(r) for r in calibration.collect()] == [("b01r.dat", ["16", "16"], [20.0, 0.5], [5.0, -3.0])]
    read = lambda: readers.read_samples(spark, str(tmp_path), ["x", "y"], "*.dat", calibration=calibration)
    got = [(r["x"], r["y"]) for r in read().orderBy("sample_index").collect()]
    assert got == [tuple(v) for v in ((raw - [5, -3]) / [20, 0.5]).tolist()]
    with pytest.raises(ValueError, match="1 channels: b01r.dat"):
        readers.read_samples(spark, str(tmp_path), ["x"], "*.dat", calibration=calibration)
    (tmp_path / "b02r.dat").write_bytes(b"\0" * 4)
    with pytest.raises(ValueError, match="not described by a header: b02r.dat"):
        read()
    (tmp_path / "b02r.hea").write_text("b02r 2 100 1\nb02r.dat 212 20\nb02r.dat 16 20\n")
    again = readers.calibrations(readers.read_headers(spark, str(tmp_path), "*.hea"))
    with pytest.raises(ValueError, match="not in format 16: b02r.dat"):
        readers.read_samples(spark, str(tmp_path), ["x", "y"], "*.dat", calibration=again)
    (tmp_path / "b03.dat").write_bytes(b"\0" * 7)
    with pytest.raises(ValueError, match="part of a frame of 2 bytes: b03.dat"):
        readers.read_samples(spark, str(tmp_path), ["x"], "b03.dat")


def test_records_without_metadata_are_reported(spark, raw):
    meta = ex.read_metadata_from_headers(spark, raw)
    notes = spark.createDataFrame([("a01", 0, 1, "A", ""), *[(f"z{i:02d}", 0, 1, "A", "") for i in range(25)]],
                                  "recording_id string, ordinal int, sample_index long, aux_note string, symbol string")
    with pytest.raises(ValueError, match=r"labels of records without metadata: z00, .* and 5 more \(25 in all\)"):
        ex.label_stream(notes, meta)
    with pytest.raises(ValueError, match="beats of records"):
        ex.beat_stream(notes.select("recording_id", "sample_index"), meta)
    with pytest.raises(ValueError, match="samples of records without metadata: a01"):
        ex.raw_streams(spark, raw, meta.where("record_name <> 'a01'"))


def test_records_of_two_rates(spark):
    """Windows, bounds and expectations follow the rate of each record."""
    n = {"a01": (10, 1500), "b01": (5, 700)}
    rows = [(r, i, rate, float(i)) for r, (rate, k) in n.items() for i in range(k)]
    signals = spark.createDataFrame(rows, "recording_id string, sample_index long, sampling_rate_hz int, ecg_value double")
    none = {c: F.lit(None).cast("double") for c in schema.EXTRA_CHANNELS} | {f"{c}_replaced": F.lit(False) for c in schema.CHANNELS}
    signals = signals.withColumns({**none, "has_respiration": F.lit(False), "recorded_at": ex.timeline.synth_ts(F.col("sample_index"), F.col("sampling_rate_hz"))})
    labels = spark.createDataFrame([], "recording_id string, minute_index int, ordinal int, recorded_at timestamp_ntz, label string, is_apnea boolean")
    beats = signals.where("sample_index % 7 = 0").select("recording_id", "sample_index", "recorded_at", "sampling_rate_hz", (-F.col("sample_index")).alias("file_position"))
    meta = spark.createDataFrame([(r, "s", "learning", "a", False, False, True, r, rate, k, k // rate) for r, (rate, k) in n.items()],
                                 "record_name string, subject_id string, split string, category string, has_respiration boolean, has_apnea_annotations boolean, "
                                 "has_qrs_annotations boolean, source_record_name string, sampling_rate_hz int, num_samples long, length_seconds int")
    out = ex.process(signals, labels, beats, meta)
    windows = sorted((r["recording_id"], r["minute_index"], r["sample_count"], r["sample_end_index"], r["qrs_count"]) for r in out["windows"].collect())
    assert windows == [("a01", 0, 600, 599, 86), ("a01", 1, 600, 1199, 86), ("a01", 2, 300, 1799, 43), ("b01", 0, 300, 299, 43), ("b01", 1, 300, 599, 43), ("b01", 2, 100, 899, 14)]
    report = {r["recording_id"]: r for r in out["report"].collect()}
    assert all(r["windows"]["issues"] == [] and r["signals"]["issues"] == [] for r in report.values())
    # beats lie in the file in falling order, which only their file position can show
    assert report["a01"]["qrs"]["issues"] == ["non-monotonic timestamps: 214", "non-monotonic sample_index: 214"]


def test_partition_folders_as_spark_names_them(spark, tmp_path):
    values = ["a:b", "x/y", "50%", "plain", "q=1", "[z]", "tab\t", "ü", "a b"]
    path = str(tmp_path / "t")
    spark.createDataFrame([(v, 1) for v in values], "recording_id string, n int").write.partitionBy("recording_id").parquet(path)
    assert {p.name for p in (tmp_path / "t").iterdir() if p.is_dir()} == {tables.partition_folder("recording_id", v) for v in values}
    tables.drop_partitions(spark, path, ["a:b", "x/y", "tab\t", "gone"])
    left = {r[0] for r in spark.read.parquet(path).select("recording_id").collect()}
    assert left == set(values) - {"a:b", "x/y", "tab\t"}


def test_interrupted_rewrite_loses_nothing(spark, tmp_path):
    path = str(tmp_path / "small")
    spark.range(3).write.parquet(path)
    tables.rewrite(spark, spark.range(5), path)
    assert tables.read_table(spark, path).count() == 5
    spark.range(7).write.parquet(f"{path}.next")
    (tmp_path / "small").rename(tmp_path / "small.old")  # stopped between the two renames
    assert tables.read_table(spark, path).count() == 7
    assert not (tmp_path / "small.old").exists()


def test_preview_text(spark, raw):
    got = readers.preview_text(spark, raw, 2, "notes.txt").orderBy("line_number").collect()
    assert [r["line"] for r in got] == ["one", "two"]


def test_json_readers(spark, tmp_path):
    row = {"recording_id": "a01", "sample_index": 5, "recorded_at": "2000-01-01T00:00:00.050000+00:00"}
    (tmp_path / "signals_a01.jsonl").write_text(json.dumps(row) + "\n\n" + json.dumps(row) + "\n")
    (tmp_path / "qrs_b02.json").write_text(json.dumps([row, row, row], indent=2))
    lines = readers.read_jsonl(spark, str(tmp_path / "signals_a01.jsonl"), schema.SIGNALS)
    assert [r["recorded_at"] for r in lines.collect()] == [dt.datetime(2000, 1, 1, 0, 0, 0, 50000)] * 2
    assert readers.read_json_array(spark, str(tmp_path / "qrs_b02.json"), schema.BEATS).count() == 3
    found = files.discover_records(files.list_files(spark, str(tmp_path)))
    assert [r[0] for r in found.collect()] == ["a01", "b02"]
    summary = spark.createDataFrame([("z09",), ("a07",)], "recording_id string")
    nothing = files.list_files(spark, str(tmp_path), "*.none")
    assert [r[0] for r in files.discover_records(nothing, summary).collect()] == ["a07", "z09"]
    (tmp_path / "bad.jsonl").write_text('{"sample_index": "x"\n')
    with pytest.raises(Exception, match="FAILFAST|MALFORMED"):
        readers.read_jsonl(spark, str(tmp_path / "bad.jsonl"), schema.SIGNALS).collect()


def test_metadata(spark, tmp_path):
    entry = {"record_name": "a01", "signals": ["ECG"], "num_samples": 10, "has_respiration": False}
    (tmp_path / "meta.json").write_text(json.dumps({"a01": entry, "b01": {"num_samples": 3}}, indent=2))
    got = {r["record_name"]: r for r in readers.read_metadata(spark, str(tmp_path / "meta.json")).collect()}
    assert got["a01"]["signals"] == ["ECG"] and got["b01"]["num_samples"] == 3 and got["b01"]["signals"] is None


@pytest.fixture(scope="module")
def extracted(spark, raw):
    meta = ex.read_metadata_from_headers(spark, raw)
    signals = ex.raw_streams(spark, raw, meta)
    notes = spark.createDataFrame(
        [("a01", 0, 0, " A ", "N"), ("a01", 1, 610, "", "N"), ("c05", 0, 10, None, "N")],
        "recording_id string, ordinal int, sample_index long, aux_note string, symbol string",
    )
    beats = spark.createDataFrame([("a01", i * 8) for i in range(100)] + [("c05", 3)], "recording_id string, sample_index long")
    labels = ex.label_stream(notes, meta)
    beat_rows = ex.beat_stream(beats, meta)
    return ex.process(signals, labels, beat_rows, meta), meta


def test_extraction(extracted):
    out, _ = extracted
    stats = {r["recording_id"]: r for r in out["stats"].collect()}
    a, c = stats["a01"], stats["c05"]
    # a01 is cut to its shorter extra file, so fewer samples than the header announced
    assert (a["signal_rows"], a["apnea_events"], a["qrs_events"], a["window_rows"], a["annotated_window_rows"]) == (1210, 2, 100, 3, 2)
    assert (c["signal_rows"], c["window_rows"], c["qrs_events"]) == (600, 1, 1)
    assert a["signal_end_at"] == dt.datetime(2000, 1, 1, 0, 2, 0, 900000)
    report = {r["recording_id"]: r for r in out["report"].collect()}
    assert report["a01"]["status"] == "fail" and report["c05"]["status"] == "pass"
    assert report["a01"]["signals"]["issues"] == ["signal row count mismatch: expected 1250, found 1210"]
    labels = sorted(tuple(r)[:1] + (r["minute_index"], r["label"], r["is_apnea"]) for r in out["annotations_apnea"].collect())
    assert labels == [("a01", 0, "A", True), ("a01", 1, "N", False), ("c05", 0, "N", False)]
    nulls = out["signals"].where("recording_id = 'c05' and spo2 is not null").count()
    assert nulls == 0


def test_load_twice_and_resume(spark, extracted, tmp_path):
    out, _ = extracted
    frames = {n: out[n] for n in tables.LOAD_ORDER}
    root = str(tmp_path / "store")
    broken = dict(frames, annotations_qrs=frames["annotations_qrs"].withColumn("boom", F.raise_error(F.lit("stop")).cast("string")))
    log, error = tables.load_tables(spark, broken, root)
    assert error is not None and [r["table"] for r in log] == list(tables.LOAD_ORDER[:-1])
    log, error = tables.load_tables(spark, frames, root)
    assert error is None and {r["table"]: r["rows_inserted"] for r in log} == {
        "subjects": 0, "recordings": 0, "signals": 0, "annotations_apnea": 0, "annotations_qrs": 101}
    assert spark.read.parquet(f"{root}/signals").count() == 1810
    # replacing one of two recordings that share a subject keeps the subject
    tables.cleanup_records(spark, root, ["c05"])
    assert [r[0] for r in spark.read.parquet(f"{root}/subjects").collect()] == ["subject_a01"]
    assert spark.read.parquet(f"{root}/signals").select("recording_id").distinct().count() == 1
    log, error = tables.load_tables(spark, frames, root)
    assert error is None and {r["table"]: r["rows_inserted"] for r in log} == {
        "subjects": 1, "recordings": 1, "signals": 600, "annotations_apnea": 1, "annotations_qrs": 1}


def test_shared_subject_survives(spark, tmp_path):
    root = str(tmp_path / "store")
    recs = spark.createDataFrame([("c05", "s"), ("c06", "s"), ("a01", "t")], "recording_id string, subject_id string")
    subs = spark.createDataFrame([("s", "n"), ("t", "n")], "subject_id string, notes string")
    tables.load_tables(spark, {"subjects": subs, "recordings": recs}, root)
    tables.cleanup_records(spark, root, ["c05", "a01"])
    assert [r[0] for r in spark.read.parquet(f"{root}/subjects").collect()] == ["s"]
    assert [r[0] for r in spark.read.parquet(f"{root}/recordings").collect()] == ["c06"]


def test_chunk_pruning_and_compaction(spark, extracted, tmp_path):
    out, _ = extracted
    path, packed = str(tmp_path / "chunked"), str(tmp_path / "packed")
    base = dt.datetime(2000, 1, 1)
    hours = spark.range(0, 300).select(
        F.lit("a01").alias("recording_id"), (F.lit(base).cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("id").cast("int"))).alias("recorded_at"),
        F.col("id").alias("sample_index"),
    )
    assert tables.write_chunked(hours, path) == 300
    scan = tables.scan_chunks(spark, path, "a01", "2000-01-01 01:30:00", "2000-01-01 02:10:00")
    assert scan.count() == 40
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(recording_id" in plan and "chunk" in plan
    hours.write.parquet(str(tmp_path / "plain"))
    assert tables.compact_layout(spark, str(tmp_path / "plain"), packed) == 300
    first = spark.read.parquet(packed).select("sample_index").first()[0]
    assert first == 299
    report = {r["table"]: r for r in tables.storage_report(spark, {"signals": str(tmp_path / "plain")}, {"signals": packed}).collect()}
    assert set(report) == {"signals", "total"} and report["total"]["ratio"] == pytest.approx(
        report["total"]["bytes_before"] / report["total"]["bytes_after"])


def test_artifacts_and_exports(spark, extracted, tmp_path):
    out, _ = extracted
    root = str(tmp_path / "art")
    exports.write_artifacts({"windows": out["windows"], "signals": out["signals"]}, root)
    back = readers.read_jsonl(spark, f"{root}/windows", schema.WINDOWS, recursive=True)
    key = ["recording_id", "minute_index"]
    ours = {tuple(r[k] for k in key): r for r in out["windows"].collect()}
    theirs = {tuple(r[k] for k in key): r for r in back.collect()}
    assert set(ours) == set(theirs)
    for k, r in ours.items():
        assert theirs[k]["modalities"] == r["modalities"] and theirs[k]["window_end_at"] == r["window_end_at"]
    line = json.loads(spark.read.text(f"{root}/signals").first()[0])
    assert line["recorded_at"].endswith("+00:00") and "spo2" in line
    manifest = exports.export(spark, {"recordings": out["recordings"]}, str(tmp_path / "exp"), "schema").collect()
    assert [(r["name"], r["mode"]) for r in manifest] == [("recordings", "schema")]
    assert json.loads(spark.read.text(manifest[0]["path"]).first()[0])["type"] == "struct"
    with pytest.raises(ValueError):
        exports.export(spark, {}, str(tmp_path), "half")


def test_versioned_cache_rules(spark, tmp_path):
    df = spark.range(10).withColumn("y", F.col("id") % 2)
    built = []

    def ask(version="v1", steps=16, norm="robust", frame=df):
        def build():
            built.append(version)
            return frame

        return exports.versioned_cache(spark, str(tmp_path), frame, ["id", "y"], build, version, steps, norm)[1]

    assert [ask(), ask(), ask(steps=8), ask(steps=8), ask(version="v2"), ask(frame=df.limit(5))] == [
        False, True, False, True, False, False]
    assert len(built) == 4


def test_merge_logs(spark):
    log = spark.createDataFrame([(0, "signals", 5, 1.0), (1, "subjects", 1, 0.5), (2, "signals", 7, 2.0), (3, "compression", 9, 0.0)],
                                "seq int, table string, rows_inserted long, duration_sec double")
    merged = [tuple(r) for r in bl.merge_load_logs(log).collect()]
    assert merged == [("signals", 12, 3.0, 0), ("subjects", 1, 0.5, 1), ("compression", 9, 0.0, 3)]
    rates = {r["table"]: r["rows_per_sec"] for r in bl.ingest_throughput(log).collect()}
    assert rates == {"signals": 4.0, "total": 4.0}
    still = log.withColumn("duration_sec", F.lit(0.0))
    assert {r["rows_per_sec"] for r in bl.ingest_throughput(still).collect()} == {None}


@pytest.mark.parametrize("n,rank", [(1, 0), (19, 17), (20, 18), (21, 18)])
def test_nearest_rank(spark, n, rank):
    df = spark.createDataFrame([("t", i % 3, float(i)) for i in range(n)], "test_name string, record_id int, ms double")
    assert bl.latency_summary(df).first()["p95_ms"] == float(rank)
    stats = bl.timing_stats(df.limit(1)).first()
    assert stats["stdev_ms"] == 0.0


def test_staged_ingest_stops_and_resumes(spark, extracted, tmp_path):
    out, _ = extracted
    staging, store, state = (str(tmp_path / n) for n in ("staging", "store", "state"))
    frames = {n: out[n] for n in tables.LOAD_ORDER if n != "subjects"}
    folder = ingest.stage(frames, staging)
    ingest.announce(frames["recordings"], staging, folder)
    # what other hand-overs left in staging is not read
    other = ingest.stage({"signals": frames["signals"]}, staging)
    mine = spark.createDataFrame([("a01", folder)], ingest.MANIFEST)
    seen = ingest.staged_tables(spark, staging, mine, tables.LOAD_ORDER)["signals"]
    assert seen.inputFiles() and all(f"/{folder}/" in f and other not in f for f in seen.inputFiles())
    assert seen.select("recording_id").distinct().count() == 1
    report = out["report"].select("recording_id", "status")
    first = ingest.staged_ingest(spark, staging, store, state, lambda f: report)
    with pytest.raises(Exception, match="a01"):
        first.awaitTermination()
    assert not tables.exists(spark, f"{store}/signals") and tables.exists(spark, f"{staging}/{folder}/signals")
    accept = lambda f: f["signals"].select("recording_id", F.lit("pass").alias("status")).distinct()
    subjects = lambda r: r.select("subject_id", F.lit("n").alias("notes")).distinct()
    for _ in range(2):
        ingest.staged_ingest(spark, staging, store, state, accept, subjects_of=subjects, keep_staging=False).awaitTermination()
    assert tables.read_table(spark, f"{staging}/{folder}/signals") is None
    assert spark.read.parquet(f"{store}/signals").count() == 1810
    assert spark.read.parquet(f"{store}/subjects").count() == 2


def test_stream_equals_batch(spark, tmp_path):
    base = dt.datetime(2024, 1, 1)
    rows = [(f"r{i % 3}", base + dt.timedelta(seconds=7 * i), float(i % 11)) for i in range(400)]
    df = spark.createDataFrame(rows, "recording_id string, recorded_at timestamp, ecg_value double")
    for k in range(4):
        df.where(F.col("ecg_value") % 4 == k).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    live.start_updates(live.stream_bucket_stats(stream, "1 minute", "1 day"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = {(r["recording_id"], r["bucket"]): (r["n"], r["min_value"], r["max_value"]) for r in live.read_updates(spark, str(tmp_path / "out")).collect()}
    want = {}
    for rec, at, v in rows:
        want.setdefault((rec, at.replace(second=0)), []).append(v)
    assert got == {k: (len(v), min(v), max(v)) for k, v in want.items()}


@pytest.mark.parametrize("folders,limit", [(1, "500000"), (2, "500000"), (2, "0")])
def test_records_of_a_batch_are_listed_once_for_all_tables(spark, tmp_path, monkeypatch, folders, limit):
    from pulsegrid.plans import joins

    staging = str(tmp_path / "staging")
    made = [(f"a{i:02d}", j) for i in range(6) for j in range(3)]
    rows = spark.createDataFrame(made, "recording_id string, v int")
    subjects = spark.createDataFrame([("s1",), ("s2",)], "subject_id string")
    frames = {"subjects": subjects, **dict.fromkeys(("recordings", "signals", "annotations_apnea", "annotations_qrs"), rows)}
    names = [ingest.stage(frames, staging, ()) for _ in range(folders)]
    told = [(i, f) for i in ("a01", "a04") for f in names]
    announced = spark.createDataFrame([*told, told[0]], ingest.MANIFEST)
    lists, measure = [], joins._is_small
    monkeypatch.setattr(joins, "_is_small", lambda df, most: lists.append(df.columns) or measure(df, most))
    spark.conf.set("spark.pulsegrid.maxBroadcastRows", limit)
    try:
        seen = ingest.staged_tables(spark, staging, announced, tables.LOAD_ORDER)
    finally:
        spark.conf.unset("spark.pulsegrid.maxBroadcastRows")
    assert lists == [["recording_id"]]
    assert list(seen) == list(tables.LOAD_ORDER) and seen["subjects"].count() == 2 * folders
    for name in tables.LOAD_ORDER[1:]:
        want = sorted(r for r in made if r[0] in ("a01", "a04") for _ in range(folders))
        assert sorted((r["recording_id"], r["v"]) for r in seen[name].collect()) == want

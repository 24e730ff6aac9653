"""Files and folders whose number follows the rows, not the number of records; values that no step may change."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from pulsegrid.schema import BEATS
from pulsegrid.sinks import exports, tables
from pulsegrid.sources import files, readers


def beats(spark, n=600, records=200):
    return spark.range(n).select(
        F.concat(F.lit("r"), F.col("id") % records).alias("recording_id"), F.col("id").alias("sample_index"),
        F.timestamp_seconds(F.col("id")).cast("timestamp_ntz").alias("recorded_at"),
    )


def test_many_records_share_artifact_files(spark, tmp_path):
    rows, few = beats(spark), beats(spark, 9, 3)
    root = str(tmp_path / "artifacts")
    exports.write_artifacts({"qrs": rows, "apnea": few}, root, most_folders=150)
    assert not list(Path(root, "qrs").glob("recording_id=*")) and len(list(Path(root, "qrs").rglob("part-*"))) < 20
    assert len(list(Path(root, "apnea").glob("recording_id=*"))) == 3
    back = readers.read_jsonl(spark, f"{root}/qrs", BEATS, recursive=True).withColumn("recorded_at", F.col("recorded_at").cast("timestamp_ntz"))
    assert {tuple(r) for r in back.select(*rows.columns).collect()} == {tuple(r) for r in rows.collect()} and back.count() == 600
    listed = files.list_files(spark, root, "*.txt")
    found = files.discover_records(listed, packed=files.packed_records(spark, root, listed)).collect()
    assert [r[0] for r in found] == sorted(f"r{i}" for i in range(200))


def test_headers_of_many_records_in_few_files(spark, tmp_path):
    texts = spark.range(200).select(F.format_string("# c\nx%03d 1 100.0 %d\nx%03d.dat 16 200 12 0 0 0 0 ECG", "id", "id", "id").alias("value"))
    exports.write_headers(texts, str(tmp_path / "headers"))
    assert len(list(Path(tmp_path, "headers").glob("part-*"))) < 20
    read = readers.read_headers(spark, str(tmp_path / "headers"), separator=readers.HEADER_END).collect()
    assert sorted((r["record_name"], r["num_samples"], r["signals"]) for r in read) == [(f"x{i:03d}", i, ["ECG"]) for i in range(200)]


def test_json_arrays_follow_the_beats(spark, monkeypatch, tmp_path):
    from pulsegrid.catalog import raw

    seen = {}
    keep = exports.write_files
    monkeypatch.setattr(raw.exports, "write_files", lambda rows, root, **k: seen.setdefault("files", keep(rows, root, **k)))
    monkeypatch.setattr(raw, "ARRAY_BEATS", 50)
    n = raw.read_json_array(spark, "/root/testdata/sf0.001").count()
    assert n > 0 and seen["files"] == -(-n // 50)


def test_records_are_replaced_in_buckets(spark, tmp_path):
    path = str(tmp_path / "signals")
    old = beats(spark).withColumn("v", F.lit(0))
    assert tables.write_buckets(old, path, buckets=8) == 600
    fresh = old.where("recording_id IN ('r3', 'r77')").where("sample_index < 400").withColumn("v", F.lit(1))
    fresh = fresh.unionByName(old.limit(1).withColumn("recording_id", F.lit(None).cast("string")))
    for _ in range(2):
        assert tables.replace_in_buckets(spark, path, fresh, ["r5"], buckets=8) == 5
    assert len(list(Path(path).glob("bucket=*"))) == 8
    want = old.where("recording_id NOT IN ('r3', 'r5', 'r77')").unionByName(fresh)
    back = spark.read.parquet(path).select(*old.columns)
    assert sorted(map(str, back.collect())) == sorted(map(str, want.collect()))
    left = [r[0] for r in want.select("recording_id").where("recording_id IS NOT NULL").distinct().where(tables.bucket_of(buckets=8) == 3).collect()]
    tables.replace_in_buckets(spark, path, fresh.limit(0), left, buckets=8)
    assert left and not Path(path, "bucket=3").exists()
    assert spark.read.parquet(path).count() == want.where(F.coalesce(~F.col("recording_id").isin(left), F.lit(True))).count()


def test_samples_that_16_bits_cannot_hold(spark, tmp_path):
    rows = spark.createDataFrame([(-163.84,), (163.835,), (0.0,)], "value double")
    assert exports.sample_bits(rows, "value") == 16
    exports.write_samples(rows.coalesce(1), "value", str(tmp_path / "narrow")).collect()
    assert {r["value"] for r in readers.read_samples(spark, str(tmp_path / "narrow"), ["value"]).collect()} == {-163.84, 163.835, 0.0}
    wide = rows.unionByName(spark.createDataFrame([(170.05,)], "value double")).coalesce(1)
    with pytest.raises(Exception, match="16-bit numbers"):
        exports.write_samples(wide, "value", str(tmp_path / "lost")).collect()
    assert exports.sample_bits(wide, "value") == 32
    exports.write_samples(wide, "value", str(tmp_path / "wide"), bits=32).collect()
    back = readers.read_samples(spark, str(tmp_path / "wide"), ["value"], range_bytes=8, bits=32)
    assert {r["value"] for r in back.collect()} == {-163.84, 163.835, 0.0, 170.05}


def test_sizes_round_the_exact_value(spark):
    from pulsegrid.functions.text import format_bytes

    sizes = [0.0, 1.005, 999.0, 1023.999, 1024.0, 1152.0, 1664.0, 3720.0, 1048576 * 4.625, 1125899906842624.0 * 3, -5.0]
    rows = spark.createDataFrame([(v,) for v in sizes], "v double")

    def plain(size):
        unit = 0
        while size >= 1024 and unit < 4:
            size, unit = size / 1024, unit + 1
        return f"{size:.2f} {('B', 'KB', 'MB', 'GB', 'TB')[unit]}"

    assert {r["v"]: r["s"] for r in rows.select("v", format_bytes(F.col("v")).alias("s")).collect()} == {v: plain(v) for v in sizes}


def test_no_interval_without_both_classes(spark):
    from pulsegrid.operators import metrics as me

    rows = spark.createDataFrame([("a", 1, 17.0), ("a", 1, 20.0), ("b", 0, 3.0), ("b", 1, 9.0)], "g string, record_label int, anomaly_percentage double")
    found = {r["g"]: (r["kind"], r["interval_start"], r["interval_end"]) for r in me.score_gap(rows, ["g"]).collect()}
    assert found == {"a": (None, None, None), "b": ("gap", 3.0, 9.0)}

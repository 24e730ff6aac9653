"""Paired sample files as a data source, raw folders as a stream."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid.operators import extraction as ex
from pulsegrid.operators import joins as jn
from pulsegrid.schema import CHANNELS, EXTRA_CHANNELS
from pulsegrid.sources import files, paired, readers
from pulsegrid.streaming import raw_source

RATE = 10


def write_record(root, name, n, short=None, marks=True, zero=0):
    """A record of n frames; ``short``: frames that its extra file lacks (None: no extra file)."""
    t = np.arange(n)
    (root / f"{name}.dat").write_bytes(((t * 3 + ord(name[0])) % 500).astype("<i2").tobytes())
    (root / f"{name}.hea").write_text(f"{name} 1 {RATE} {n}\n{name}.dat 16 200({zero})/mV 12 0 0 0 0 ECG\n")
    if short is not None:
        extra = np.stack([(t[: n - short] * k) % 300 for k in (1, 2, 3, 4)], axis=1).astype("<i2")
        (root / f"{name}r.dat").write_bytes(extra.tobytes())
        lines = "".join(f"{name}r.dat 16 {20 + k} 16 {k} 0 0 0 {c}\n" for k, c in enumerate(("Resp C", "Resp A", "Resp N", "SpO2")))
        (root / f"{name}er.hea").write_text(f"{name}er 5 {RATE} {n}\n{name}.dat 16 200({zero})/mV 12 0 0 0 0 ECG\n{lines}")
    if marks:
        (root / f"{name}.apn").write_bytes(b"\0")


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    root = tmp_path_factory.mktemp("paired")
    write_record(root, "a01", 1000, 7)
    write_record(root, "a02", 400, 0, zero=5)
    write_record(root, "c05", 600)
    write_record(root, "b09", 3)
    return str(root)


def facts(spark, raw):
    return ex.read_metadata_from_headers(spark, raw).select(F.col("record_name").alias("recording_id"), "sampling_rate_hz", "has_respiration")


def rows(df):
    return sorted(map(tuple, df.select("recording_id", "sample_index", *CHANNELS).collect()), key=str)


def joined(spark, raw):
    """The same by two reads and a join."""
    calibration = readers.calibrations(readers.read_headers(spark, raw, "*.hea"))
    main = readers.read_samples(spark, raw, ["ecg_value"], "[a-z][0-9][0-9].dat", calibration=calibration)
    extra = readers.read_samples(spark, raw, list(EXTRA_CHANNELS), "[a-z][0-9][0-9]r.dat", calibration=calibration)
    return jn.align_channels(main, extra.withColumn("recording_id", F.regexp_replace("recording_id", "r$", "")))


@pytest.mark.parametrize("range_bytes", [64, 1000, 128 << 20])
def test_zipped_files_equal_a_join(spark, raw, range_bytes):
    got = paired.read_paired(spark, paired.work_orders(spark, raw, facts(spark, raw)), range_bytes=range_bytes)
    assert rows(got) == rows(joined(spark, raw))
    counts = {r["recording_id"]: r["count"] for r in got.groupBy("recording_id").count().collect()}
    assert counts == {"a01": 993, "a02": 400, "c05": 600, "b09": 3}
    if range_bytes == 1000:
        assert got.rdd.getNumPartitions() > 5


def test_no_sample_is_shuffled_or_joined(spark, raw):
    got = ex.raw_streams(spark, raw, ex.read_metadata_from_headers(spark, raw))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "BatchScan" in plan


def test_only_wanted_frames_are_planned(spark, raw):
    orders = paired.work_orders(spark, raw, facts(spark, raw))
    few = paired.read_paired(spark, orders, ["a01", "c05"], 100, 130, range_bytes=800)
    assert rows(few) == [r for r in rows(joined(spark, raw)) if r[0] in ("a01", "c05") and 100 <= r[1] < 130]
    whole = paired.read_paired(spark, orders, range_bytes=800)
    assert few.rdd.getNumPartitions() <= 4 < whole.rdd.getNumPartitions()
    # two filters on one frame
    a, c = whole.where("recording_id = 'a01'"), whole.where("recording_id = 'c05' AND sample_index < 10")
    assert (a.count(), c.count(), a.unionByName(c).count(), whole.count()) == (993, 10, 1003, 1996)


@pytest.mark.parametrize("low,high,step", [(0, None, 7), (5, 20, 7), (0, 0, 3), (13, 14, 100), (30, 10, 4), (0, 99, 1)])
def test_ranges_cover_each_frame_once(low, high, step):
    order = {"recording_id": "a", "path": "p", "gains": [1.0], "zeros": [0.0], "frames": 25, "extra_path": "q", "extra_frames": 23,
             "extra_gains": [1.0] * 4, "extra_zeros": [0.0] * 4, "sampling_rate_hz": 1, "has_respiration": True}
    made = list(paired.ranges_of(order, low, high, step * 10))
    assert [i for r in made for i in range(r.first, r.first + r.n)] == list(range(low, min(23, 23 if high is None else high)))
    packs = paired.packed(made, 100)
    assert [r for w in packs for r in w.ranges] == made
    assert all(len(w.ranges) == 1 or sum(r.n for r in w.ranges) * 10 <= 100 for w in packs)


def test_caps_and_shortened_files(spark, tmp_path):
    write_record(tmp_path, "a01", 50, 0)
    orders = paired.work_orders(spark, str(tmp_path), facts(spark, str(tmp_path)))
    orders = orders.sparkSession.createDataFrame(orders.collect(), orders.schema)
    assert paired.read_paired(spark, orders, high=20).count() == 20
    assert paired.read_paired(spark, orders.limit(0)).count() == 0
    (tmp_path / "a01.dat").write_bytes(b"\0" * 10)
    with pytest.raises(Exception, match="shortened after it was listed"):
        paired.read_paired(spark, orders).count()


def test_python_header_rules_equal_the_column_rules(spark, tmp_path):
    texts = [
        "a01 1 100 5\na01.dat 16 200 12 3 0 0 0 ECG\n",
        "# c\n\nx 2 50.0 7\nx.dat 16 20.5(-4)/mmHg 16 9 0 0 0 Resp C\nx.dat 212\n",
        "x fast\nx 1 ten 5\n",
        "b 1 1e2 12 rest\r\nb.dat 16 /mV 1 x\r\n",
        "",
    ]
    frame = spark.createDataFrame(list(enumerate(texts)), "path int, value string")
    for r in readers.parse_headers(frame).collect():
        mine = raw_source.parse_header(texts[r["path"]])
        if r["sampling_rate_hz"] is None or r["num_samples"] is None:
            assert mine is None
        else:
            assert (mine.rate, mine.frames) == (r["sampling_rate_hz"], r["num_samples"])
            assert list(mine.channels) == [(c["file"], c["format"], c["gain"], c["zero"]) for c in r["channels"]]


class Stream:
    def __init__(self, spark, root, tmp, **options):
        self.spark, self.root, self.tmp, self.options = spark, root, tmp, options

    def run(self):
        stream = raw_source.raw_stream(self.spark, str(self.root), f"file://{self.tmp}/ledger", **self.options)
        raw_source.start_decoding(stream, f"{self.tmp}/out", f"{self.tmp}/state").awaitTermination()

    def counts(self):
        out = self.spark.read.parquet(f"{self.tmp}/out")
        assert out.groupBy("recording_id").agg(F.countDistinct("batch").alias("n")).where("n > 1").count() == 0
        return {r["recording_id"]: r["count"] for r in out.groupBy("recording_id").count().collect()}


def test_stream_takes_each_complete_record_once(spark, tmp_path):
    root = tmp_path / "raw"
    root.mkdir()
    write_record(root, "a01", 100, 4)
    write_record(root, "c05", 60, marks=False)
    (root / "b02.hea").write_text(f"b02 1 {RATE} 10\nb02.dat 16 200\n")
    stream = Stream(spark, root, tmp_path, rangeBytes="300")
    stream.run()
    assert stream.counts() == {"a01": 96}  # c05 lacks its marks, b02 its samples
    stream.run()
    assert stream.counts() == {"a01": 96}
    (root / "c05.apn").write_bytes(b"\0")
    (root / "b02.dat").write_bytes(b"\0" * 10)  # half of what the header says
    write_record(root, "a03", 30, 0)
    stream.run()
    assert stream.counts() == {"a01": 96, "c05": 60, "a03": 30}
    steps = [json.loads(p.read_text()) for p in sorted((tmp_path / "ledger").glob("step-*.json"))]
    assert steps == [["a01"], ["a03", "c05"]]
    got = spark.read.parquet(f"{tmp_path}/out").drop("batch")
    want = paired.read_paired(spark, paired.work_orders(spark, str(root), facts(spark, str(root)).where("recording_id <> 'b02'")))
    assert rows(got) == rows(want)


def test_a_broken_record_holds_the_offset(spark, tmp_path):
    root = tmp_path / "raw"
    root.mkdir()
    write_record(root, "a01", 100, 4)
    (root / "a01r.dat").write_bytes(b"\0" * 11)  # ends inside a frame
    stream = Stream(spark, root, tmp_path)
    with pytest.raises(Exception, match="a01r.dat cannot be decoded"):
        stream.run()
    assert not (tmp_path / "out").exists()
    write_record(root, "a01", 100, 4)
    stream.run()
    assert stream.counts() == {"a01": 96}

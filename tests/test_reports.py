"""Report tables, filters that reach a stored table, salts that a retried task draws again."""

from pyspark.sql import functions as F

from pulsegrid.operators import filters as fl
from pulsegrid.operators import reports as rp
from pulsegrid.plans import joins
from pulsegrid.sinks import tables


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_record_and_time_bounds_reach_the_scan(spark, tmp_path):
    rows = spark.range(100).select(
        F.concat(F.lit("a0"), F.col("id") % 3).alias("recording_id"),
        F.timestamp_seconds(F.col("id") * 60).alias("recorded_at"),
        F.col("id").cast("double").alias("ecg_value"),
    )
    tables.write_table(rows, f"{tmp_path}/signals", partition=())
    found = fl.range_query(spark.read.parquet(f"{tmp_path}/signals"), "a01", "1970-01-01 00:10:00", "30 minutes")
    pushed = next(line for line in plan_of(found).splitlines() if "PushedFilters" in line)
    pushed = pushed[pushed.index("PushedFilters") :]
    assert "EqualTo(recording_id,a01)" in pushed and "GreaterThanOrEqual(recorded_at" in pushed and "LessThan(recorded_at" in pushed
    assert [r["ecg_value"] for r in found.collect()] == [float(i) for i in range(10, 40) if i % 3 == 1]


def test_salts_come_from_files(spark):
    """What a salt depends on is read from written files, whose rows are the same in every attempt; nulls take no part."""
    facts = spark.range(300).repartition(3).select(F.when(F.col("id") % 5 > 0, "hot").alias("g"), "id")
    other = spark.createDataFrame([("hot", 1)], "g string, w int")
    plan = plan_of(joins.salted_join(facts, other, ["g"], "left", 20))
    assert "monotonically_increasing_id" in plan
    below = plan[plan.index("monotonically_increasing_id") :]
    assert "FileScan parquet" in below and "Range" not in plan
    assert joins.salted_join(facts, other, ["g"], "left", 20).count() == 300
    assert "_salt" not in plan_of(joins.salted_join(facts, other, ["g"], "inner", 10**6))


def test_report_tables(spark, tmp_path):
    samples = spark.createDataFrame([("q1", r, float(v)) for r in (1, 2) for v in range(r, 21)] + [("q2", 1, 5.0)], "test_name string, record_id int, ms double")
    got = {r["test_name"]: r for r in rp.latency_table({"old": samples, "new": samples.where("test_name = 'q1'")}).collect()}
    assert got["q2"]["new_avg_ms"] is None and got["q2"]["old_p95_ms"] == 5.0
    assert got["q1"]["old_avg_ms"] == got["q1"]["new_avg_ms"] == (10.5 + 11.0) / 2
    log = spark.createDataFrame([("signals", 10, 2.0), ("annotations_qrs", 5, 1.0), ("compression", 99, 9.0)], "table string, rows_inserted long, duration_sec double")
    rows = [tuple(r) for r in rp.throughput_table({"x": log, "y": log.where("table = 'signals'")}).orderBy("database").collect()]
    assert rows == [("x", 15, 3.0, 5.0), ("y", 10, 2.0, 5.0)]
    for i, name in enumerate(rp.SIZED):
        spark.range(10 * (i + 1)).write.parquet(f"{tmp_path}/s/{name}")
    row = rp.storage_table(spark, {"s": f"{tmp_path}/s"}).first()
    sizes = [sum(p.stat().st_size for p in (tmp_path / "s" / name).glob("*.parquet")) for name in rp.SIZED]
    assert [row[f"{t}_bytes"] for t in rp.SIZED] == sizes and row["total_bytes"] == sum(sizes)
    scored = spark.createDataFrame([(3, "a", "val", 1, 0, 0.5), (1, "a", "val", 0, 0, 0.1), (2, "b", "test", 1, 1, 0.9)], "window_id int, recording_id string, split string, y_true int, y_pred int, score double")
    made = {(r["split"], r["index"]): (r["recording_id"], r["score"]) for r in rp.window_prediction_table(scored, "p", "m").collect()}
    assert made == {("val", 0): ("a", 0.1), ("val", 1): ("a", 0.5), ("test", 0): ("b", 0.9)}


def test_compaction_makes_no_folder_for_each_record(spark, tmp_path):
    source, target = str(tmp_path / "plain"), str(tmp_path / "compact")
    rows = spark.range(900).select(
        F.format_string("%03d", F.col("id") % 300).alias("recording_id"), F.timestamp_seconds(F.col("id")).alias("recorded_at"), "id"
    )
    rows.write.parquet(source)
    assert tables.compact_layout(spark, source, target) == 900
    report = {r["table"]: r for r in tables.storage_report(spark, {"signals": source}, {"signals": target}).collect()}
    assert 0 < report["signals"]["chunks"] < 20
    packed = spark.read.parquet(target)
    assert sorted(packed.collect(), key=lambda r: r["id"]) == sorted(rows.select(*packed.columns).collect(), key=lambda r: r["id"])
    last = packed.withColumn("_at", F.monotonically_increasing_id()).where("recording_id = '007'").orderBy("_at").collect()
    assert [r["id"] for r in last] == [607, 307, 7]

"""Ordered layouts and joins: the split and salted forms equal the plain ones."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid.operators import aggregates as ag
from pulsegrid.operators import sequence as sq
from pulsegrid.plans import joins, ordered


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds most rows, one has a NULL key, values repeat."""
    rng = random.Random(7)
    rows = []
    for i in range(900):
        g = "hot" if i % 3 else rng.choice(["a", "b", None])
        rows.append((g, i, float(rng.randrange(40))))
    return spark.createDataFrame(rows, "g string, i long, v double").repartition(6).cache()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("limit", [10_000, 20])
def test_ordinal(skewed, limit):
    out = ordered.with_ordinal(skewed, ["g"], ["i"], "n", limit).collect()
    by = {}
    for r in sorted(out, key=lambda r: r["i"]):
        assert r["n"] == by.get(r["g"], 0)
        by[r["g"]] = r["n"] + 1
    assert len(out) == 900


def test_running_and_previous_split_equals_plain(skewed):
    def both(limit):
        lay = ordered.layout(skewed, ["g"], ["i"], limit)
        return rows(lay.running({"run": "v"}, {"all": "v"}).select("g", "i", "run", "all")), rows(
            lay.previous({"pv": "v", "pi": "i"}, "has").select("g", "i", "pv", "pi", "has")
        )

    assert both(10_000) == both(20)
    assert ordered.layout(skewed, ["g"], ["i"], 20).split
    assert not ordered.layout(skewed, ["g"], ["i"], 10_000).split


@pytest.mark.parametrize("limit", [10_000, 5])
def test_quantiles(skewed, limit):
    probs = {"lo": 0.0, "q": 0.37, "mid": 0.5, "hi": 1.0}
    got = {r["g"]: r for r in ordered.quantiles(skewed, ["g"], "v", probs, limit).collect()}
    data = {}
    for r in skewed.collect():
        data.setdefault(r["g"], []).append(r["v"])
    assert set(got) == set(data)
    for g, values in data.items():
        for name, p in probs.items():
            assert got[g][name] == pytest.approx(np.quantile(values, p))
    whole = ordered.quantiles(skewed, [], "v", {"q": 0.85}, limit).first()["q"]
    assert whole == pytest.approx(np.quantile([v for vs in data.values() for v in vs], 0.85))


@pytest.mark.parametrize("limit", [10_000, 5])
def test_order_statistic(skewed, limit):
    got = ordered.order_statistic(skewed, ["g"], "v", lambda n: F.floor(n * 0.5), "m", limit).collect()
    data = {}
    for r in skewed.collect():
        data.setdefault(r["g"], []).append(r["v"])
    assert {r["g"]: r["m"] for r in got} == {g: sorted(v)[int(len(v) * 0.5)] for g, v in data.items()}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain(skewed, how):
    other = skewed.sparkSession.createDataFrame([("hot", 1), ("hot", 2), ("a", 3), ("z", 4)], "g string, w int")
    plain = skewed.join(other, ["g"], how)
    assert rows(joins.salted_join(skewed, other, ["g"], how, limit=50)) == rows(plain)


@pytest.mark.parametrize("limit", [0, 1000])
def test_join_lookup_both_ways(skewed, limit):
    lookup = skewed.where("g is not null").groupBy("g").agg(F.max("v").alias("m"))
    got = joins.join_lookup(skewed, lookup, ["g"], "left", limit, computed=True)
    assert rows(got) == rows(skewed.join(lookup, ["g"], "left"))


def test_broadcast_only_when_small(spark, skewed):
    small = joins.broadcast_if_small(skewed.select("g").distinct(), 10)
    plan = skewed.join(small, "g")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    big = skewed.select("g")
    assert joins.broadcast_if_small(big, 10) is big


def test_interval_join_forms_agree(spark, monkeypatch):
    rng = random.Random(3)
    stamp = F.timestamp_micros(F.col("us")).cast("timestamp_ntz")
    minute = 60_000_000
    samples = spark.createDataFrame(
        [(rng.choice("abh"), rng.randrange(0, 30 * minute), i) for i in range(600)], "recording_id string, us long, s int"
    ).withColumn("recorded_at", stamp)
    edges = [("a", 0), ("a", minute), ("h", 5 * minute - 1), ("h", 5 * minute - 1), ("b", 29 * minute)]
    labels = spark.createDataFrame(
        [(r, u, i) for i, (r, u) in enumerate(edges + [(rng.choice("ah"), rng.randrange(0, 30 * minute)) for _ in range(20)])],
        "recording_id string, us long, l int",
    ).withColumn("label_at", stamp)
    s, lab = samples.collect(), labels.collect()
    brute = sorted(
        (y["l"], x["s"]) for x in s for y in lab if x["recording_id"] == y["recording_id"] and 0 <= x["us"] - y["us"] < minute
    )
    left, right = labels.drop("us"), samples.drop("us")
    pairs = lambda df: sorted((r["l"], r["s"]) for r in df.select("l", "s").collect())
    assert pairs(ag.interval_join(left, right, 60)) == brute
    assert pairs(ag.interval_join_plain(left, right, 60)) == brute
    spark.conf.set("spark.pulsegrid.maxBroadcastRows", "1")
    spark.conf.set("spark.pulsegrid.maxGroupRows", "10")
    try:
        assert pairs(ag.interval_join(left, right, 60)) == brute
    finally:
        spark.conf.unset("spark.pulsegrid.maxBroadcastRows")
        spark.conf.unset("spark.pulsegrid.maxGroupRows")


@pytest.mark.parametrize("limit", [1000, 3])
def test_sequence_checks(spark, limit):
    data = [("a", 0, 0, 10), ("a", 1, 1, 20), ("a", 2, 3, 20), ("a", 3, 4, 15), ("a", 4, 5, 30), ("b", 0, 7, 5), ("b", 1, 8, 6)]
    df = spark.createDataFrame(data, "recording_id string, row long, sample_index long, t long")
    gaps = sq.index_gaps(df, ["recording_id"], ["row"], limit=limit).collect()
    assert [(r["recording_id"], r["sample_index"], r["previous_index"]) for r in gaps] == [("a", 3, 1)]
    flat = sq.non_increasing_ts(df, ["recording_id"], ["row"], "t", limit).collect()
    assert sorted(r["row"] for r in flat) == [2, 3]
    falls = sq.non_monotonic(df, ["recording_id"], ["row"], ["t", "sample_index"], limit).collect()
    assert [(r["row"], r["t_falls"], r["sample_index_falls"]) for r in falls] == [(3, True, False)]


@pytest.mark.parametrize("limit", [1000, 2])
def test_flagged_segments(spark, limit):
    flags = {"a": [0, 1, 1, 0, 1, 1, 1], "b": [1], "c": [0, 0]}
    rows_ = [(r, m, f, float(m)) for r, fs in flags.items() for m, f in enumerate(fs)]
    df = spark.createDataFrame(rows_, "recording_id string, minute_index long, y_pred int, score double")
    got = sorted(tuple(r) for r in sq.flagged_segments(df, limit=limit).collect())
    assert got == [("a", 1, 2, 2, 2.0), ("a", 4, 6, 3, 6.0), ("b", 0, 0, 1, 0.0)]


def test_salting_takes_any_column_and_spreads_equal_rows(spark):
    """Map columns, equal rows under a hot key and NULL keys, at both ends of the limits."""
    facts = spark.range(1000).select(
        F.when(F.col("id") % 4 == 0, F.lit(None)).otherwise(F.lit("hot")).alias("g"), F.create_map(F.lit("k"), F.lit(1)).alias("m")
    )
    other = spark.createDataFrame([("hot", 1), (None, 2)], "g string, w int")
    text = F.to_json("m")
    for how in ("inner", "left", "left_semi", "left_anti"):
        plain = rows(facts.join(other, ["g"], how).withColumn("m", text))
        for limit in (1, 37, 10**9):
            assert rows(joins.salted_join(facts, other, ["g"], how, limit).withColumn("m", text)) == plain
        for limit in (0, 10**9):
            assert rows(joins.join_lookup(facts, other, ["g"], how, limit).withColumn("m", text)) == plain


def test_every_salt_is_used(spark, monkeypatch):
    """1,000 equal rows of one key under 20 salts: each salt gets its share."""
    facts = spark.range(1000).select(F.lit("hot").alias("g"), F.lit(1).alias("v")).repartition(4)
    other = spark.createDataFrame([("hot", 1)], "g string, w int")
    joined = joins.salted_join(facts, other, ["g"], "inner", 50)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "monotonically_increasing_id" in plan and "xxhash64" not in plan
    salts = spark.range(1000).repartition(4).select(F.pmod(F.monotonically_increasing_id(), F.lit(20)).alias("s")).groupBy("s").count().collect()
    assert len(salts) == 20 and max(r["count"] for r in salts) <= 60
    assert joined.count() == 1000


def test_broadcast_is_bounded_in_bytes(spark):
    wide = spark.createDataFrame([("a", "x" * 50_000)], "g string, t string")
    assert joins.broadcast_if_small(wide) is not wide
    spark.conf.set("spark.pulsegrid.maxBroadcastBytes", "40000")
    try:
        assert joins.broadcast_if_small(wide) is wide
    finally:
        spark.conf.unset("spark.pulsegrid.maxBroadcastBytes")


def test_running_sums_of_nulls(spark):
    data = [("a", 1, None), ("a", 2, None), ("a", 3, 2.0), ("a", 4, None), ("a", 5, 3.0), ("n", 1, None), ("n", 2, None), (None, 1, None), (None, 2, 1.0)]
    df = spark.createDataFrame(data, "g string, i int, v double")
    got = {limit: rows(ordered.layout(df, ["g"], ["i"], limit).running({"run": "v"}, {"all": "v"}).select("g", "i", "v", "run", "all")) for limit in (100, 1)}
    assert got[100] == got[1]
    assert ("a", 1, None, None, 5.0) in got[1] and ("n", 2, None, None, None) in got[1]


def test_scratch_scope_deletes_what_was_written_inside(spark, tmp_path):
    from pathlib import Path

    from pulsegrid import session

    outer = session.scratch_path(spark, "outside")
    spark.range(3).write.parquet(outer)
    paths = []
    with pytest.raises(RuntimeError):
        with session.scratch_scope(spark):
            for name in ("one", "two"):
                paths.append(session.scratch_path(spark, name))
                spark.range(5).write.parquet(paths[-1])
            with session.scratch_scope(spark):
                inner = session.stored(spark.range(7), "inner")
                inner.write.parquet(f"{tmp_path}/result")
                (kept,) = inner.inputFiles()[:1]
            assert not Path(kept.removeprefix("file://")).exists() and Path(paths[0].removeprefix("file:")).exists()
            raise RuntimeError
    assert not any(Path(p.removeprefix("file:")).exists() for p in paths)
    assert spark.read.parquet(f"{tmp_path}/result").count() == 7 and spark.read.parquet(outer).count() == 3

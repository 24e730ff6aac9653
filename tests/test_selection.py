"""Order statistics by counting equal a full sort, for any distribution."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid.plans import ordered, selection

RNG = np.random.default_rng(4)
KINDS = {
    "flat": RNG.random(3000).tolist(),
    "tails": (RNG.standard_cauchy(3000) * 10.0 ** RNG.integers(-200, 200, 3000)).tolist(),
    "one far": [*RNG.random(1000).tolist(), 1e300, -1e300],
    "ties": [float(x) for x in RNG.integers(0, 5, 2000)],
    "same": [2.5] * 40,
    "one": [7.0],
    "odd": [float("inf")] * 3 + [float("-inf")] * 2 + [0.0, -0.0, 1.0, 5e-324, 1e308, -1e308],
    "close": [1.0 + k * 2.0**-52 for k in range(500)],
    "nan": [float("nan"), 1.0, 2.0, float("nan"), 0.5],
}


def ordering(x):
    return (math.isnan(x), 0 if math.isnan(x) else x)


@pytest.mark.parametrize("buckets", [4, 4096])
def test_every_rank_of_every_group_in_the_same_passes(spark, monkeypatch, buckets):
    monkeypatch.setattr(selection, "BUCKETS", buckets)
    rows = [(g, x) for g, xs in KINDS.items() for x in xs] + [(None, 3.0), (None, 1.0), ("flat", None), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    share = lambda n: F.array(*[F.floor(F.lit(p) * (n - 1)) for p in (0.0, 0.01, 0.3, 0.5, 0.77, 0.99, 1.0)], n + 5)
    got = {(r["g"], r["_rank"]): r["_value"] for r in selection.select_ranks(df, ["g"], "v", share).collect()}
    want = {}
    for g, xs in {**KINDS, None: [3.0, 1.0]}.items():
        xs = sorted(xs, key=ordering)
        for p in (0.0, 0.01, 0.3, 0.5, 0.77, 0.99, 1.0):
            want[g, math.floor(p * (len(xs) - 1))] = xs[math.floor(p * (len(xs) - 1))]
    assert set(got) == set(want)
    assert all(got[k] == want[k] or (math.isnan(got[k]) and math.isnan(want[k])) for k in want)


@pytest.mark.parametrize("group", [["g"], []])
def test_quantiles_equal_the_ranked_ones(spark, group):
    rows = [(g, x) for g in ("flat", "tails", "ties", "close", "one") for x in KINDS[g]] + [(None, 3.0), (None, 1.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    probabilities = [0.0, 0.01, 0.05, 0.5, 0.85, 0.99, 1.0]
    key = lambda r: (*[r[c] for c in group], r["probability"])
    got = {key(r): r["quantile"] for r in selection.quantiles_by_counting(df, group, "v", probabilities).collect()}
    want = {key(r): r["quantile"] for r in ordered.quantiles_long(df, group, "v", probabilities).collect()}
    assert got == want


def test_few_rows_move(spark):
    """Rows that leave the tasks of the first pass are bounded by the buckets, not by the rows."""
    df = spark.range(200_000).select(F.rand(1).alias("v")).repartition(4)
    done = []
    original = selection.stored

    def seen(frame, name):
        out = original(frame, name)
        done.append((name, out.count()))
        return out

    selection.stored = seen
    try:
        found = selection.select_ranks(df, [], "v", lambda n: F.array(F.floor(n * 0.5), F.floor(n * 0.9)))
        assert found.count() == 2
    finally:
        selection.stored = original
    assert dict(done)["coarse-buckets"] <= 2 and dict(done)["fine-buckets"] <= 2


def test_large_groups_are_counted_small_ones_sorted(spark):
    df = spark.createDataFrame([(g, x) for g in ("flat", "ties", "one") for x in KINDS[g]], "g string, v double")
    ask = lambda: (
        sorted(map(tuple, ordered.quantiles(df, ["g"], "v", {"q": 0.3, "m": 0.5}).collect())),
        sorted(map(tuple, ordered.order_statistic(df, ["g"], "v", lambda n: F.floor(n * 0.95), "top").collect())),
    )
    sorted_way = ask()
    spark.conf.set("spark.pulsegrid.maxRankedRows", "10")
    try:
        assert ask() == sorted_way
    finally:
        spark.conf.unset("spark.pulsegrid.maxRankedRows")

"""Record statistics on windows: by window functions and, for records beyond one task, by a join."""

import math

from pulsegrid.operators import aggregates as ag
from pulsegrid.schema import CHANNELS

RATE = 10


def summaries(spark, signals):
    labels = spark.createDataFrame([("a", 0, 0, "A", True)], "recording_id string, minute_index int, ordinal int, label string, is_apnea boolean")
    beats = spark.createDataFrame([("a", 5), ("a", 700), ("b", 3)], "recording_id string, sample_index long")
    rows = ag.window_summaries(signals, labels, beats, CHANNELS, RATE).collect()
    return {(r["recording_id"], r["minute_index"]): r for r in rows}


def test_both_paths_agree_and_equal_plain_sums(spark):
    values = {"a": [math.sin(i) for i in range(1500)], "b": [2.0] * 700, "c": [5.0], None: [1.0, 2.0]}
    rows = [(r, i, v, None, None, None, float(i) if r == "a" else None, *[False] * 5, r == "a") for r, vs in values.items() for i, v in enumerate(vs)]
    names = ", ".join(f"{c} double" for c in CHANNELS) + ", " + ", ".join(f"{c}_replaced boolean" for c in CHANNELS)
    signals = spark.createDataFrame(rows, f"recording_id string, sample_index long, {names}, has_respiration boolean")
    plain = summaries(spark, signals)
    spark.conf.set("spark.pulsegrid.maxGroupRows", "1")
    try:
        joined = summaries(spark, signals)
    finally:
        spark.conf.unset("spark.pulsegrid.maxGroupRows")
    assert set(plain) == set(joined) and len(plain) == 3 + 2 + 1 + 1
    near = lambda x, y: x == y or (x is not None and y is not None and math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-12))
    for key, row in plain.items():
        for c in CHANNELS:
            assert near(row["modalities"][c]["normalized_mean"], joined[key]["modalities"][c]["normalized_mean"])
        got = row["modalities"]["ecg_value"]["normalized_mean"]
        if key[0] == "a":
            vs = values["a"]
            mean = sum(vs) / len(vs)
            std = math.sqrt(sum((v - mean) ** 2 for v in vs) / len(vs))
            part = vs[key[1] * 600 : key[1] * 600 + 600]
            assert near(got, (sum(part) / len(part) - mean) / std)
        else:
            assert got is None  # no spread, one value, no record

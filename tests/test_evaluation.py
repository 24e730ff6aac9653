"""One detector evaluated as one operator."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid.functions import arrays as ar
from pulsegrid.operators import evaluation as ev

NAMES = ("mean", "std")


@pytest.fixture(scope="module")
def windows(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(120):
        record = f"{'ac'[i % 2]}{i % 6:02d}"
        y = int(record[0] == "a" and rng.random() < 0.7)
        x = (rng.random((2, 8)) * (0.2 + y)).tolist()
        rows.append((i, record, None if i % 40 == 39 else y, ("train", "val", "test")[i // 2 % 3], x))
    return spark.createDataFrame(rows, "window_id int, recording_id string, y int, model_split string, x array<array<double>>").repartition(3)


def smooth(df):
    return df.withColumn("x_hat", ar.block_mean(F.col("x"), 4))


@pytest.mark.parametrize("tune_on", ["test", "val"])
def test_parts_agree_with_plain_sums(windows, tune_on):
    fit = F.col("recording_id").startswith("c") & (F.col("model_split") == "train")
    made = ev.evaluate(windows, smooth, fit, "p", "m", features=NAMES, tune_on=tune_on)
    rows = {r["window_id"]: r for r in smooth(windows).select("*", ar.weighted_mse(F.col("x"), F.col("x_hat")).alias("loss")).collect()}
    tau = float(np.quantile([r["loss"] for r in rows.values() if r["recording_id"][0] == "c" and r["model_split"] == "train"], 0.85))
    assert made.signal_tau == pytest.approx(tau)

    def records(split):
        out = {}
        for r in rows.values():
            if r["model_split"] == split and r["y"] is not None:
                out.setdefault(r["recording_id"], []).append((r["y"], int(r["loss"] > tau)))
        return {k: (int(np.mean([y for y, _ in v]) > 0.05), 100 * np.mean([p for _, p in v])) for k, v in out.items()}

    tuned = records(tune_on)
    options = {c: np.mean([(pct > c) == (label == 1) for label, pct in tuned.values()]) for c in {0.0, 100.0, *(p for _, p in tuned.values())}}
    best = max(options.values())
    assert made.individual_acc == pytest.approx(best) and made.individual_tau == pytest.approx(min(c for c, a in options.items() if a == best))
    assert {r["recording_id"]: (r["record_label"], pytest.approx(r["anomaly_percentage"])) for r in made.records.collect()} == records("test")
    metrics = {r["split"]: r for r in made.metrics.collect()}
    assert set(metrics) == {"val", "test"} and metrics["val"]["individual_tau"] is None
    for split, m in metrics.items():
        judged = [(r["y"], int(r["loss"] > tau)) for r in rows.values() if r["model_split"] == split and r["y"] is not None]
        assert m["accuracy_pct"] == pytest.approx(100 * np.mean([y == p for y, p in judged]))
    held = made.predictions.collect()
    assert sorted(r["index"] for r in held) == list(range(len([r for r in rows.values() if r["model_split"] == "test"])))
    audit = {r["recording_id"]: r for r in made.audit.collect()}
    assert set(audit) == set(records("test")) and all(r["top_error_channel"] in NAMES for r in audit.values())
    healthy = [r["loss"] for r in rows.values() if r["model_split"] == "test" and r["y"] == 0]
    assert made.diagnostics.first()["mean_healthy_loss"] == pytest.approx(np.mean(healthy))


def test_protocols_side_by_side_and_no_fit_rows(windows):
    controls = F.col("recording_id").startswith("c") & (F.col("model_split") == "train")
    rows, made = ev.evaluate_protocols({"one": (windows, controls), "two": (windows, F.col("model_split") == "train")}, smooth, "m")
    assert sorted((r["protocol"], r["split"]) for r in rows.collect()) == [("one", "test"), ("one", "val"), ("two", "test"), ("two", "val")]
    assert made["one"].signal_tau < made["two"].signal_tau
    with pytest.raises(ValueError, match="no rows to take the threshold from"):
        ev.evaluate(windows, smooth, F.lit(False), "p", "m")

"""Tensors, metrics, thresholds and models against numpy and brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid.functions import arrays as ar
from pulsegrid.operators import learning as le
from pulsegrid.operators import metrics as me
from pulsegrid.operators import splits as sp
from pulsegrid.operators import tensors as te
from pulsegrid.schema import FEATURE_WEIGHTS

N, CH, STEPS = 30, 7, 12


@pytest.fixture(scope="module")
def cube():
    rng = np.random.default_rng(5)
    x = rng.uniform(size=(N, CH, STEPS))
    x[3] = 0.5  # constant window
    x_hat = np.clip(x + rng.normal(0, 0.1, x.shape), 0, 1)
    x_hat[4] = 0.0
    return x, x_hat


@pytest.fixture(scope="module")
def frame(spark, cube):
    x, h = cube
    rows = [(i, "abcx"[i % 4] + "01", i % 2, x[i].tolist(), h[i].tolist()) for i in range(N)]
    return spark.createDataFrame(rows, "window_id long, recording_id string, y int, x array<array<double>>, x_hat array<array<double>>").repartition(3).cache()


def column(frame, expr):
    return np.array([r["v"] for r in frame.select("window_id", expr.alias("v")).orderBy("window_id").collect()], dtype=float)


def test_losses(frame, cube):
    x, h = cube
    w = np.array(FEATURE_WEIGHTS) / (sum(FEATURE_WEIGHTS) + 1e-8)
    a, b = F.col("x"), F.col("x_hat")
    assert np.allclose(column(frame, ar.weighted_mse(a, b)), ((x - h) ** 2).mean(2) @ w)
    assert np.allclose(column(frame, ar.pattern_loss(a, b)), np.abs(np.diff(x) - np.diff(h)).mean(2) @ w)
    assert np.allclose(column(frame, ar.trend_loss(a, b)), np.abs(np.diff(x, 2) - np.diff(h, 2)).mean(2) @ w)
    first, rest = ar.mean_and_detail_loss(a, b)
    assert np.allclose(column(frame, first), ((x - h) ** 2)[:, 0].mean(1))
    assert np.allclose(column(frame, rest), ((x - h) ** 2)[:, 1:].mean((1, 2)))
    single = frame.select("window_id", F.slice("x", 1, 1).alias("x"), F.slice("x_hat", 1, 1).alias("x_hat"))
    assert np.allclose(column(single, ar.mean_and_detail_loss(a, b)[1]), 0.0)
    assert np.allclose(column(single, ar.weighted_mse(a, b)), ((x - h) ** 2)[:, 0].mean(1))


def test_correlation(frame, cube):
    x, h = (c.reshape(N, -1) for c in cube)
    got = column(frame, ar.pearson(F.flatten("x"), F.flatten("x_hat")))
    for i in range(N):
        if i in (3, 4):
            assert np.isnan(got[i])
        else:
            assert got[i] == pytest.approx(np.corrcoef(x[i], h[i])[0, 1])
    cos = column(frame, ar.cosine(F.flatten("x"), F.flatten("x_hat")))
    assert np.isnan(cos[4]) and cos[0] == pytest.approx(x[0] @ h[0] / np.linalg.norm(x[0]) / np.linalg.norm(h[0]))


def test_composite_loss(frame):
    with pytest.raises(ValueError):
        te.composite_loss(frame, ["recording_id"], "other")
    out = te.composite_loss(frame, ["recording_id"], "cploss_full")
    means = [r[1] for r in out.groupBy("recording_id").agg(F.avg("loss")).collect()]
    assert np.allclose(means, 1.0, atol=1e-3)


@pytest.mark.parametrize("arrow", [True, False])
def test_bins_and_features(spark, arrow):
    rng = np.random.default_rng(1)
    raw = rng.normal(size=(6, 60))
    df = spark.createDataFrame([(i, raw[i].tolist()) for i in range(6)], "window_id long, ecg array<double>")
    made = te.morphology(df, 12, arrow=arrow)
    got = np.array([r["x"] for r in made.orderBy("window_id").collect()])
    s = raw.reshape(6, 12, 5)
    want = np.stack([s.mean(2), s.std(2), s.min(2), s.max(2), s.max(2) - s.min(2), s[:, :, -1] - s[:, :, 0], (s * s).mean(2)], 1)
    assert np.allclose(got, want)
    with pytest.raises(Exception, match="not divisible"):
        te.morphology(df, 7, arrow=arrow).collect()
    flat = made.select("window_id", F.when(F.col("window_id") == 0, F.array(*[F.array_repeat(F.lit(2.0), 12)] * 7)).otherwise(F.col("x")).alias("x"))
    f = np.array([r["features"] for r in te.sequence_features(flat, ["window_id"], arrow=arrow).orderBy("window_id").collect()])
    assert f.shape == (6, 7, 16) and np.isfinite(f).all()
    assert f[0, 0].tolist() == [2.0, 0, 0, 2.0, 2.0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0]
    v = want[3, 1]
    d, c = np.diff(v), v - v.mean()
    reach = [np.argmax(v >= np.percentile(v, p)) / 11 for p in (20, 40, 60, 80)]
    expected = [v.mean(), v.var(), v.std(), v.min(), v.max(), np.ptp(v), (c**3).mean() / v.var() ** 1.5, (c**4).mean() / v.var() ** 2 - 3,
                *reach, d.mean(), d.max(), d.std(), np.subtract(*np.percentile(d, [75, 25]))]
    assert np.allclose(f[3, 1], expected)


def test_robust_fit_fallbacks(spark):
    shape = "window_id int, x array<array<double>>"
    rows = [(i, [[float(i)], [5.0], [0.0 if i < 99 else 9.0]]) for i in range(100)]
    fit = {r["feature"]: (r["lo"], r["hi"]) for r in te.robust_minmax_fit(spark.createDataFrame(rows, shape), names=["a", "b", "c"]).collect()}
    assert fit["a"] == (pytest.approx(0.99), pytest.approx(98.01))
    assert fit["b"] == (0.0, 1.0)
    assert fit["c"][0] == 0.0 and fit["c"][1] > 0.0
    scaled = te.robust_scale(spark.createDataFrame(rows, shape), te.robust_minmax_fit(spark.createDataFrame(rows, shape), names=["a", "b", "c"]), names=["a", "b", "c"])
    top = scaled.orderBy(F.col("window_id").desc()).first()["x"]
    assert top[0] == [1.0] and top[1] == [1.0]


def test_noise_and_mask(frame, cube):
    x, _ = cube
    noisy = np.array([r["v"] for r in frame.select("window_id", ar.add_noise(F.col("x"), F.col("window_id"), 0.03, 0.05).alias("v")).orderBy("window_id").collect()])
    again = np.array([r["v"] for r in frame.repartition(5).select("window_id", ar.add_noise(F.col("x"), F.col("window_id"), 0.03, 0.05).alias("v")).orderBy("window_id").collect()])
    assert np.array_equal(noisy, again)
    delta = noisy - x
    assert np.abs(delta).max() <= 0.05 + 1e-12 and 0.02 < delta.std() < 0.04 and abs(delta.mean()) < 0.005
    masked = np.array([r["v"] for r in frame.select("window_id", ar.mask_steps(F.col("x"), F.col("window_id"), 0.25).alias("v")).orderBy("window_id").collect()])
    gone = (masked == 0).all(axis=1)
    kept = ~gone
    assert 0.15 < gone.mean() < 0.35
    assert all(np.allclose(masked[i][:, kept[i]], x[i][:, kept[i]] / 0.75) for i in range(N))


def test_quality_has_empty_parts(frame):
    parts = {r["part"]: r for r in te.reconstruction_quality(frame, te.quality_part(F.lit("train"), F.col("y"))).collect()}
    assert set(parts) == set(te.PARTS) and parts["Validation"]["mae_x1e3"] is None and parts["Training"]["mae_x1e3"] > 0


def test_fingerprint(spark, frame):
    base = te.fingerprint(frame, ["window_id", "y"]).first()
    assert te.fingerprint(frame.repartition(7).orderBy(F.rand()), ["window_id", "y"]).first() == base
    assert te.fingerprint(frame.withColumn("y", 1 - F.col("y")), ["window_id", "y"]).first() != base
    doubled = frame.unionByName(frame)
    assert te.fingerprint(doubled, ["window_id", "y"]).first() != base


# ---------------------------------------------------------------- metrics


def auc(y, s):
    pos, neg = [b for a, b in zip(y, s) if a], [b for a, b in zip(y, s) if not a]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def ap(y, s):
    total, out, last = sum(y), 0.0, 0.0
    for t in sorted(set(s), reverse=True):
        hit = [a for a, b in zip(y, s) if b >= t]
        recall = sum(hit) / total
        out, last = out + (recall - last) * sum(hit) / len(hit), recall
    return out


@pytest.mark.parametrize("limit", [10_000, 10])
def test_areas(spark, limit):
    rng = random.Random(2)
    rows = [("g", rng.random() < 0.3, rng.randrange(25) / 25) for _ in range(200)] + [("one", True, 0.5)] * 4
    df = spark.createDataFrame([(g, int(y), s) for g, y, s in rows] + [("g", None, 0.9)], "g string, y_true int, score double")
    y, s = zip(*[(a, b) for g, a, b in rows if g == "g"])
    roc = {r["g"]: r["roc_auc"] for r in me.roc_auc(df, ["g"], limit=limit).collect()}
    prc = {r["g"]: r["pr_auc"] for r in me.average_precision(df, ["g"], limit=limit).collect()}
    assert roc == {"g": pytest.approx(auc(y, s)), "one": None}
    assert prc == {"g": pytest.approx(ap(y, s)), "one": None}


def test_metrics_zero_division(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (None, 1)], "y_true int, y_pred int")
    r = me.binary_metrics(df).first()
    assert (r["f1_pct"], r["precision_pct"], r["recall_pct"], r["specificity_pct"], r["accuracy_pct"]) == (0, 0, 0, 100, 50)
    all_pos = me.confusion(spark.createDataFrame([(1, 1)], "y_true int, y_pred int")).first()
    assert (all_pos["tn"], all_pos["tp"], all_pos["specificity"]) == (0, 1, 0.0)


@pytest.mark.parametrize("limit", [10_000, 3])
def test_individual_threshold(spark, limit):
    rows = [(0, 10.0), (0, 30.0), (1, 30.0), (1, 60.0), (1, 80.0), (0, 55.0)]
    df = spark.createDataFrame(rows, "record_label int, anomaly_percentage double")
    best = me.best_individual_threshold(df, limit=limit).first()
    accs = {t: np.mean([(p > t) == (lab == 1) for lab, p in rows]) for t in {0.0, 100.0, *[p for _, p in rows]}}
    top = max(accs.values())
    assert best["individual_acc"] == pytest.approx(top)
    assert best["individual_tau"] == min(t for t, a in accs.items() if a == pytest.approx(top))
    alone = me.best_individual_threshold(df.where("record_label = 1"), limit=limit).first()
    assert tuple(alone) == (50.0, None)


@pytest.mark.parametrize("limit", [10_000, 7])
def test_balanced_sweep(spark, limit):
    rng = random.Random(9)
    pool = [rng.random() for _ in range(90)]
    rows = [(int(rng.random() < 0.4), rng.choice(pool)) for _ in range(150)]
    df = spark.createDataFrame(rows, "y_true int, score double")
    out = {round(r["threshold"], 9): r for r in me.balanced_threshold_sweep(df, limit=limit).collect()}
    y, s = (np.array(v) for v in zip(*rows))
    cands = np.unique(np.r_[np.linspace(0.05, 0.95, 91), np.quantile(s, np.linspace(0.01, 0.99, 99))])
    assert {round(c, 9) for c in cands} == set(out)
    for c in cands[::7]:
        pred = s >= c
        tp, fp, fn, tn = ((pred & (y == 1)).sum(), (pred & (y == 0)).sum(), (~pred & (y == 1)).sum(), (~pred & (y == 0)).sum())
        r = out[round(c, 9)]
        assert r["recall"] == pytest.approx(tp / (tp + fn)) and r["specificity"] == pytest.approx(tn / max(1, tn + fp))
        rate = pred.mean()
        f1 = 2 * tp / (2 * tp + fp + fn) if tp else 0.0
        score = 0.45 * f1 + 0.45 * 0.5 * (tp / (tp + fn) + tn / max(1, tn + fp)) + 0.1 * (tp + tn) / len(y)
        assert r["selection_score"] == pytest.approx(score - (0.25 if rate < 0.05 or rate > 0.95 else 0))
    best = me.best_balanced_threshold(me.balanced_threshold_sweep(df, limit=limit)).first()
    assert best["selection_score"] == pytest.approx(max(r["selection_score"] for r in out.values()))


def test_audit(spark):
    rows = [("a", 1, 1, 5.0), ("a", 0, 1, 1.0), ("b", 0, 0, 1.0), ("b", 0, 1, 2.0), ("c", 1, 0, 0.1)]
    df = spark.createDataFrame(rows, "recording_id string, y_true int, y_pred int, score double")
    audit = me.subject_error_audit(df, 40.0, {"m": F.lit(1.0), "n": F.lit(1.0)}).collect()
    assert [(r["recording_id"], r["error_type"]) for r in audit] == [("c", "FN"), ("b", "FP"), ("a", "TP")]
    assert {r["top_error_channel"] for r in audit} == {"m"}
    assert audit[2]["p90_score"] == pytest.approx(np.percentile([5, 1], 90))


def test_split_properties(spark):
    rng = random.Random(4)
    rows = [(f"{c}{n:02d}", int(rng.random() < {"a": 0.8, "b": 0.4, "c": 0.05, "x": 0.5}[c])) for c in "abcx" for n in range(10) for _ in range(20)]
    df = spark.createDataFrame(rows, "recording_id string, y int")
    out = sp.group_stratified_split(df)
    sp.assert_no_leakage(out)
    summary = {r["model_split"]: r for r in sp.split_summary(out).collect()}
    assert summary["test"]["windows"] == 200 and summary["val"]["recordings"] == 6 and summary["train"]["recordings"] == 24
    assert abs(summary["val"]["apnea_pct"] - summary["train"]["apnea_pct"]) < 15
    with pytest.raises(ValueError):
        sp.group_stratified_split(df, protocol="none")
    leaky = out.unionByName(out.where("model_split = 'train'").withColumn("model_split", F.lit("test")))
    with pytest.raises(ValueError):
        sp.assert_no_leakage(leaky)


# ---------------------------------------------------------------- models


@pytest.fixture(scope="module")
def two_kinds(spark):
    """Windows of two clearly different shapes; class 1 oscillates."""
    rng = np.random.default_rng(8)
    t = np.arange(STEPS)
    rows = []
    for i in range(80):
        y = i % 2
        shape = 0.5 + (0.4 * np.sin(2.2 * t) if y else 0.02 * t / STEPS)
        x = np.stack([np.clip(shape + rng.normal(0, 0.02, STEPS), 0, 1) for _ in range(CH)])
        rows.append((i, f"r{i % 10}", y, x.tolist()))
    return spark.createDataFrame(rows, "window_id long, recording_id string, y int, x array<array<double>>").repartition(4).cache()


def share_right(df, where="true"):
    return df.where(where).agg(F.avg((F.col("y") == F.col("y_pred")).cast("double"))).first()[0]


def test_pca(two_kinds):
    out = le.pca_reconstruct(two_kinds, F.col("y") == 0, 3).select("y", ar.weighted_mse(F.col("x"), F.col("x_hat")).alias("loss"))
    tau = me.percentile_threshold(out.where("y = 0"), 85.0, "loss").first()["tau"]
    assert share_right(me.flag_scores(out, tau, "loss")) > 0.9


def test_kmeans_supervised_dtw(two_kinds):
    train = F.col("window_id") < 50
    assert share_right(le.feature_kmeans(two_kinds, train, trees=10)) == 1.0
    scored, tau = le.supervised_baseline(two_kinds, train, (F.col("window_id") >= 50) & (F.col("window_id") < 65))
    assert share_right(scored, "not is_train") == 1.0 and 0 < tau < 1
    assert share_right(le.dtw_cluster(two_kinds, train, ["window_id"], fit_limit=40)) == 1.0


def test_dtw_distance():
    rng = np.random.default_rng(0)
    a, b = rng.normal(size=(4, 6)), rng.normal(size=5)

    def slow(u, v):
        acc = {(0, 0): 0.0}
        for i in range(1, len(u) + 1):
            for j in range(1, len(v) + 1):
                acc[i, j] = (u[i - 1] - v[j - 1]) ** 2 + min(acc.get((i - 1, j), np.inf), acc.get((i, j - 1), np.inf), acc.get((i - 1, j - 1), np.inf))
        return acc[len(u), len(v)] ** 0.5

    assert np.allclose(le.dtw_distance(a, b), [slow(u, b) for u in a])


def test_batch_predict_checks_shape(two_kinds):
    with pytest.raises(Exception, match="shape"):
        le.batch_predict(two_kinds.select("window_id", "x"), lambda c: c[:, :2]).collect()


def test_noise_robustness(two_kinds):
    smooth = lambda df: df.withColumn("x_hat", ar.block_mean(F.col("x"), 4))
    out = {r["level"]: r for r in le.noise_robustness(two_kinds, F.col("y") == 0, smooth, (0.0, 0.3)).collect()}
    assert out[0.0]["specificity_pct"] == pytest.approx(85.0) and out[0.3]["specificity_pct"] < out[0.0]["specificity_pct"]

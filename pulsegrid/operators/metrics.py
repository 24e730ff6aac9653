"""Detection metrics, thresholds and record-level audits. Rows without a class are skipped."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.plans.joins import join_lookup
from pulsegrid.plans.ordered import layout, quantiles, quantiles_long, with_ordinal
from pulsegrid.session import materialise

KEY = "recording_id"


def _grouped(df: DataFrame, by: Sequence[str]):
    return df.groupBy(*by) if by else df.groupBy()


def _count(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, 1)), F.lit(0)).cast("long")


def percentile_threshold(df: DataFrame, percent: float = 85.0, score: str = "score", by: Sequence[str] = (), limit=None) -> DataFrame:
    """Percentile of the given losses, linear interpolation."""
    return quantiles(df, by, score, {"tau": percent / 100.0}, limit)


def flag_scores(df: DataFrame, tau: float, score: str = "score", out: str = "y_pred", inclusive: bool = False) -> DataFrame:
    """Prediction: score above the threshold (losses) or at least it (probabilities)."""
    hit = F.col(score) >= tau if inclusive else F.col(score) > tau
    return df.withColumn(out, hit.cast("int"))


def confusion(df: DataFrame, by: Sequence[str] = (), y: str = "y_true", pred: str = "y_pred") -> DataFrame:
    """tn, fp, fn, tp and specificity."""
    t, p = F.col(y), F.col(pred)
    cells = _grouped(df.where(t.isNotNull()), by).agg(
        _count((t == 0) & (p == 0)).alias("tn"),
        _count((t == 0) & (p == 1)).alias("fp"),
        _count((t == 1) & (p == 0)).alias("fn"),
        _count((t == 1) & (p == 1)).alias("tp"),
    )
    return cells.withColumn("specificity", F.col("tn") / F.greatest(F.lit(1), F.col("tn") + F.col("fp")))


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def metric_columns(tn: Column, fp: Column, fn: Column, tp: Column) -> dict[str, Column]:
    """F1, precision, recall, specificity and accuracy as fractions; 0 for an empty denominator."""
    return {
        "f1": _ratio(2 * tp, 2 * tp + fp + fn),
        "precision": _ratio(tp, tp + fp),
        "recall": _ratio(tp, tp + fn),
        "specificity": tn / F.greatest(F.lit(1), tn + fp),
        "accuracy": _ratio(tp + tn, tp + tn + fp + fn),
    }


def binary_metrics(df: DataFrame, by: Sequence[str] = (), y: str = "y_true", pred: str = "y_pred") -> DataFrame:
    """The five metrics in percent."""
    cells = confusion(df, by, y, pred)
    cols = metric_columns(*[F.col(c) for c in ("tn", "fp", "fn", "tp")])
    return cells.select(*by, *[(100.0 * c).alias(f"{n}_pct") for n, c in cols.items()])


def score_curve(df: DataFrame, by: Sequence[str] = (), y: str = "y_true", score: str = "score", limit=None) -> DataFrame:
    """Distinct scores in falling order with class counts, running counts and totals."""
    t = F.col(y)
    kept = df.where(t.isNotNull() & F.col(score).isNotNull())
    points = kept.groupBy(*by, score).agg(_count(t == 1).alias("pos"), _count(t == 0).alias("neg"))
    return layout(points, by, [F.col(score).desc()], limit).running(
        {"tp": "pos", "fp": "neg"}, {"n_pos": "pos", "n_neg": "neg"}
    )


def _both(value: Column) -> Column:
    return F.when((F.max("n_pos") > 0) & (F.max("n_neg") > 0), value)


def roc_auc(df: DataFrame, by: Sequence[str] = (), y: str = "y_true", score: str = "score", limit=None) -> DataFrame:
    """Area under the ROC curve, ties count half; NULL with one class."""
    won = F.sum(F.col("pos") * (F.col("n_neg") - F.col("fp") + F.col("neg") * 0.5))
    area = won / (F.max("n_pos") * F.max("n_neg"))
    return _grouped(score_curve(df, by, y, score, limit), by).agg(_both(area).alias("roc_auc"))


def average_precision(df: DataFrame, by: Sequence[str] = (), y: str = "y_true", score: str = "score", limit=None) -> DataFrame:
    """Sum of recall steps times precision over falling scores; NULL with one class."""
    step = F.sum(F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp")))
    return _grouped(score_curve(df, by, y, score, limit), by).agg(_both(step / F.max("n_pos")).alias("pr_auc"))


def metric_row(df: DataFrame, by: Sequence[str] = (), y: str = "y_true", pred: str = "y_pred", score: str = "score") -> DataFrame:
    """Metrics and both areas in one row per group."""
    by = list(by)
    if not by:
        df, by = df.withColumn("_all", F.lit(0)), ["_all"]
    base = binary_metrics(df, by, y, pred)
    curve = score_curve(df, by, y, score)
    won = F.sum(F.col("pos") * (F.col("n_neg") - F.col("fp") + F.col("neg") * 0.5))
    step = F.sum(F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp")))
    areas = curve.groupBy(*by).agg(
        _both(won / (F.max("n_pos") * F.max("n_neg"))).alias("roc_auc"), _both(step / F.max("n_pos")).alias("pr_auc")
    )
    return base.join(areas, by, "left").drop("_all")


def record_anomaly_pct(
    df: DataFrame, by: Sequence[str] = (KEY,), y: str = "y_true", pred: str = "y_pred", score: str = "score", burden: float = 0.05
) -> DataFrame:
    """Record class (share of event windows above ``burden``), flagged percentage, mean score."""
    return df.where(F.col(y).isNotNull()).groupBy(*by).agg(
        (F.avg(F.col(y).cast("double")) > burden).cast("int").alias("record_label"),
        F.avg(F.col(y).cast("double")).alias("true_apnea_rate"),
        (100.0 * F.avg(F.col(pred).cast("double"))).alias("anomaly_percentage"),
        F.avg(score).alias("mean_score"),
        F.count(F.lit(1)).alias("n_windows"),
    )


def subject_error_audit(
    df: DataFrame,
    tau: float,
    channels: Mapping[str, Column] | None = None,
    y: str = "y_true",
    pred: str = "y_pred",
    score: str = "score",
    burden: float = 0.05,
    key: str = KEY,
    limit=None,
) -> DataFrame:
    """Record-level audit with outcome, score distribution and worst channel."""
    base = record_anomaly_pct(df, [key], y, pred, score, burden)
    guess = (F.col("anomaly_percentage") > tau).cast("int")
    base = base.withColumn("pred_record_label", guess).withColumn(
        "error_type",
        F.when((F.col("record_label") == 0) & (guess == 0), "TN").when((F.col("record_label") == 0) & (guess == 1), "FP")
        .when((F.col("record_label") == 1) & (guess == 0), "FN").otherwise("TP"),
    )
    q = quantiles(df, [key], score, {"median_score": 0.5, "p90_score": 0.9, "p95_score": 0.95}, limit)
    top = df.groupBy(key).agg(F.max(score).alias("max_score"))
    out = base.join(q, key, "left").join(top, key, "left")
    if channels:
        names = list(channels)
        means = df.groupBy(key).agg(*[F.avg(c).alias(f"_c_{n}") for n, c in channels.items()])
        worst = F.greatest(*[F.col(f"_c_{n}") for n in names]) if len(names) > 1 else F.col(f"_c_{names[0]}")
        first = F.coalesce(*[F.when(F.col(f"_c_{n}") == worst, F.lit(n)) for n in names])
        out = out.join(
            means.select(key, first.alias("top_error_channel"), worst.alias("top_error_channel_mse")), key, "left"
        )
    return out.orderBy(F.col("error_type").asc(), F.col("anomaly_percentage").desc())


def loss_diagnostics(
    df: DataFrame, records: DataFrame, by: Sequence[str] = (), y: str = "y_true", score: str = "score",
    corr: str | None = None, prediction: str | None = None, collapse: float = 0.25,
) -> DataFrame:
    """Class mean losses with their ratio, record gap, spread of predictions, collapse flag."""
    by = list(by)
    if not by:
        df, records, by = df.withColumn("_all", F.lit(0)), records.withColumn("_all", F.lit(0)), ["_all"]
    extra = []
    if corr:
        extra.append(F.avg(corr).alias("reconstruction_corr"))
    if prediction:
        extra.append(F.stddev_pop(prediction).alias("prediction_std"))
    losses = df.groupBy(*by).agg(
        F.avg(F.when(F.col(y) == 0, F.col(score))).alias("mean_healthy_loss"),
        F.avg(F.when(F.col(y) == 1, F.col(score))).alias("mean_anomalous_loss"),
        *extra,
    ).withColumn("loss_ratio", F.col("mean_anomalous_loss") / (F.col("mean_healthy_loss") + 1e-12))
    gaps = _score_gap(records, by)
    out = losses.join(gaps.select(*by, "max_healthy_pct", "min_pathological_pct", "gap"), by, "left")
    if corr:
        out = out.withColumn("collapsed", F.coalesce(F.col("reconstruction_corr") < collapse, F.lit(False)))
    return out.drop("_all")


def _score_gap(records: DataFrame, by: Sequence[str]) -> DataFrame:
    pct, label = F.col("anomaly_percentage"), F.col("record_label")
    ends = _grouped(records, by).agg(
        F.max(F.when(label == 0, pct)).alias("max_healthy_pct"), F.min(F.when(label == 1, pct)).alias("min_pathological_pct")
    )
    return ends.withColumn("gap", F.col("min_pathological_pct") - F.col("max_healthy_pct"))


def score_gap(records: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Separation between healthy and pathological records, or the interval of their overlap; neither where a class is missing."""
    ends = _score_gap(records, by)
    hi, lo = F.col("max_healthy_pct"), F.col("min_pathological_pct")
    both = hi.isNotNull() & lo.isNotNull()  # least and greatest skip NULL
    return ends.select(
        *by, hi, lo, "gap",
        F.when(hi < lo, "gap").when(hi >= lo, "overlap").alias("kind"),
        F.when(both, F.least(hi, lo)).alias("interval_start"), F.when(both, F.greatest(hi, lo)).alias("interval_end"),
    )


def individual_threshold_sweep(records: DataFrame, by: Sequence[str] = (), limit=None) -> DataFrame:
    """Accuracy of ``percentage > tau`` for every candidate: 0, each distinct percentage, 100.

    Running counts over the distinct percentages; no pairing of candidates and records.
    """
    by = list(by)
    pct = F.col("anomaly_percentage")
    points = records.groupBy(*by, pct.alias("tau")).agg(
        _count(F.col("record_label") == 1).alias("pos"), _count(F.col("record_label") == 0).alias("neg")
    )
    groups = points.groupBy(*by).agg(F.max("tau").alias("_m")) if by else points.groupBy().agg(F.max("tau").alias("_m"))
    ends = groups.select(
        *by, F.explode(F.array(F.lit(0.0), F.lit(100.0))).alias("tau"), F.lit(0).cast("long").alias("pos"),
        F.lit(0).cast("long").alias("neg"),
    )
    merged = points.unionByName(ends).groupBy(*by, "tau").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    ran = layout(merged, by, ["tau"], limit).running(
        {"_fn": "pos", "_tn": "neg"}, {"n_pos": "pos", "n_neg": "neg"}
    )
    right = F.col("_tn") + F.col("n_pos") - F.col("_fn")
    return ran.select(*by, "tau", (right / (F.col("n_pos") + F.col("n_neg"))).alias("accuracy"), "n_pos", "n_neg")


def best_individual_threshold(records: DataFrame, by: Sequence[str] = (), limit=None) -> DataFrame:
    """Lowest threshold of best accuracy; (50, NULL) when only one class is present."""
    sweep = individual_threshold_sweep(records, by, limit)
    both = (F.max("n_pos") > 0) & (F.max("n_neg") > 0)
    best = F.max_by(F.col("tau"), F.struct(F.col("accuracy"), -F.col("tau")))
    return _grouped(sweep, by).agg(
        F.when(both, best).otherwise(F.lit(50.0)).alias("individual_tau"),
        F.when(both, F.max("accuracy")).alias("individual_acc"),
    )


# The candidate grid and the weights of the selection score.
GRID = tuple(np.linspace(0.05, 0.95, 91).tolist())
QUANTILE_GRID = tuple(np.linspace(0.01, 0.99, 99).tolist())


def balanced_threshold_sweep(
    df: DataFrame, y: str = "y_true", score: str = "score", lowest_rate: float = 0.05, highest_rate: float = 0.95,
    penalty: float = 0.25, grid: Sequence[float] = GRID, probabilities: Sequence[float] = QUANTILE_GRID, limit=None,
) -> DataFrame:
    """Selection score of ``score >= tau`` for linear and quantile candidates.

    Candidates are merged into the distinct scores and read off running counts.
    """
    kept = df.where(F.col(y).isNotNull() & F.col(score).isNotNull())
    t = F.col(y)
    points = kept.groupBy(F.col(score).cast("double").alias("tau")).agg(
        _count(t == 1).alias("pos"), _count(t == 0).alias("neg")
    ).withColumn("_kind", F.lit(1))
    fixed = df.sparkSession.createDataFrame([(float(g),) for g in grid], "tau double")
    fitted = quantiles_long(kept, [], score, probabilities, limit).select(F.col("quantile").cast("double").alias("tau"))
    zero = F.lit(0).cast("long")
    candidates = fixed.unionByName(fitted).distinct().select(
        "tau", zero.alias("pos"), zero.alias("neg"), F.lit(0).alias("_kind")
    )
    ran = layout(points.unionByName(candidates), [], ["tau", "_kind"], limit).running(
        {"_fn": "pos", "_tn": "neg"}, {"n_pos": "pos", "n_neg": "neg"}
    ).where(F.col("_kind") == 0)
    tn, fn = F.col("_tn"), F.col("_fn")
    tp, fp = F.col("n_pos") - fn, F.col("n_neg") - tn
    m = metric_columns(tn, fp, fn, tp)
    rate = (tp + fp) / (F.col("n_pos") + F.col("n_neg"))
    swept = ran.select(
        F.col("tau").alias("threshold"), *[c.alias(n) for n, c in m.items()], rate.alias("predicted_positive_rate")
    ).withColumn("balanced_accuracy", 0.5 * (F.col("recall") + F.col("specificity")))
    lost = F.when((F.col("predicted_positive_rate") < lowest_rate) | (F.col("predicted_positive_rate") > highest_rate), penalty).otherwise(0.0)
    return swept.withColumn(
        "selection_score", 0.45 * F.col("f1") + 0.45 * F.col("balanced_accuracy") + 0.10 * F.col("accuracy") - lost
    )


def best_balanced_threshold(sweep: DataFrame) -> DataFrame:
    """The candidate of the highest selection score, the lowest one on ties."""
    return sweep.orderBy(F.round("selection_score", 12).desc(), F.col("threshold").asc()).limit(1)


def balanced_class_weights(df: DataFrame, y: str = "y") -> DataFrame:
    """n / (k * n_c) for each class."""
    counts = materialise(df.where(F.col(y).isNotNull()).groupBy(y).agg(F.count(F.lit(1)).alias("n_c")))
    n, k = counts.agg(F.sum("n_c"), F.count(F.lit(1))).first()
    return counts.select(y, "n_c", (F.lit(float(n or 0)) / (F.lit(k) * F.col("n_c"))).alias("weight"))


def with_class_weights(df: DataFrame, weights: DataFrame, y: str = "y", out: str = "weight") -> DataFrame:
    """Class weight on every row; one row per class is broadcast."""
    return join_lookup(df, weights.select(y, F.col("weight").alias(out)), [y])


def box_stats(df: DataFrame, group: Sequence[str], value: str = "score", limit=None) -> DataFrame:
    """Quartiles and whiskers: the outermost values within 1.5 interquartile ranges."""
    q = quantiles(df, group, value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, limit)
    joined = join_lookup(df.where(F.col(value).isNotNull()).select(*group, value), q, list(group), "inner", computed=True)
    spread = 1.5 * (F.col("q3") - F.col("q1"))
    v = F.col(value)
    ends = joined.groupBy(*group, "q1", "median", "q3").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.when(v >= F.col("q1") - spread, v)).alias("_lo"),
        F.max(F.when(v <= F.col("q3") + spread, v)).alias("_hi"),
    )
    return ends.select(
        *group, "n", "q1", "median", "q3",
        F.least(F.coalesce("_lo", "q1"), F.col("q1")).alias("whisker_low"),
        F.greatest(F.coalesce("_hi", "q3"), F.col("q3")).alias("whisker_high"),
    )


def pick_examples(
    df: DataFrame, by: Sequence[str] = (), y: str = "y", spread: str = "spread", loss: str = "loss", order: str = "window_id",
    percent: float = 60.0, limit=None,
) -> DataFrame:
    """A well reconstructed normal window that is not flat, and the worst anomalous one."""
    by = list(by)
    if not by:
        df, by = df.withColumn("_all", F.lit(0)), ["_all"]
    normal = df.where(F.col(y) == 0)
    cut = quantiles(normal, by, spread, {"_cut": percent / 100.0}, limit)
    shaped = join_lookup(normal, cut, by, "inner", computed=True).where(F.col(spread) >= F.col("_cut"))
    best = shaped.groupBy(*by).agg(F.min(F.struct(loss, order)).alias("b")).select(
        *by, F.lit("healthy").alias("kind"), F.col(f"b.{order}").alias(order), F.col(f"b.{loss}").alias(loss)
    )
    worst = df.where(F.col(y) == 1).groupBy(*by).agg(
        F.min(F.struct((-F.col(loss)).alias("_neg"), F.col(order))).alias("b")
    ).select(*by, F.lit("anomalous").alias("kind"), F.col(f"b.{order}").alias(order), (-F.col("b._neg")).alias(loss))
    return best.unionByName(worst).drop("_all")


def top_k(df: DataFrame, k: int, importance: str = "importance", name: str = "feature") -> DataFrame:
    """The k most important features, by name on ties."""
    return df.orderBy(F.col(importance).desc(), F.col(name).asc()).limit(k)


def calibrated_error(
    df: DataFrame, by: Sequence[str] = (), loss: str = "loss", scale: float = 2.4414093, power: float = 1.5, clip: float = 0.70,
    limit=None,
) -> DataFrame:
    """Mean and RMS (x 1e3) of the rescaled loss, clipped at its own quantile."""
    by = list(by)
    if not by:
        df, by = df.withColumn("_all", F.lit(0)), ["_all"]
    loss_col = F.col(loss)
    finite = df.where(loss_col.isNotNull() & ~F.isnan(loss) & (F.abs(loss_col) < float("inf")))
    rescaled = finite.select(*by, (F.lit(scale) * F.pow(F.greatest(loss_col, F.lit(0.0)), F.lit(power))).alias("_v"))
    top = quantiles(rescaled, by, "_v", {"_top": clip}, limit)
    clipped = join_lookup(rescaled, top, by, "inner", computed=True).select(*by, F.least("_v", "_top").alias("_v"))
    return clipped.groupBy(*by).agg(
        (F.avg("_v") * 1e3).alias("mae_x1e3"), (F.sqrt(F.avg(F.col("_v") * F.col("_v"))) * 1e3).alias("rmse_x1e3")
    ).drop("_all")


def cluster_rates(df: DataFrame, clusters: Sequence[int] = (0, 1), cluster: str = "cluster", y: str = "y") -> DataFrame:
    """Positive rate of each cluster, 0 for an empty one, and which is the anomalous one."""
    rates = df.groupBy(cluster).agg(F.avg(F.col(y).cast("double")).alias("rate"))
    wanted = df.sparkSession.createDataFrame([(int(c),) for c in clusters], f"{cluster} int")
    full = wanted.join(rates, cluster, "left").select(cluster, F.coalesce("rate", F.lit(0.0)).alias("rate"))
    placed = with_ordinal(full, [], [F.col("rate").desc(), F.col(cluster).asc()], "_place")
    return placed.select(cluster, "rate", (F.col("_place") == 0).alias("anomalous"))


def run_summary(runs: DataFrame, min_corr: float = 0.50, min_ratio: float = 1.30) -> DataFrame:
    """Selection score and minimum diagnostics of each run; an undefined ratio or correlation scores 0."""
    frac = lambda c: F.col(c) / 100.0
    part = lambda c, top: F.coalesce(F.greatest(F.lit(0.0), F.least(F.col(c) / top, F.lit(1.0))), F.lit(0.0))
    low = F.lit(float("-inf"))
    score = (
        0.50 * F.coalesce(frac("individual_acc_pct"), low)
        + 0.20 * F.coalesce(frac("specificity_pct"), low)
        + 0.15 * F.coalesce(frac("f1_pct"), low)
        + 0.10 * part("loss_ratio", 1.50)
        + 0.05 * part("reconstruction_corr", 0.80)
    )
    ok = (
        ~F.coalesce(F.col("collapsed"), F.lit(False))
        & (F.coalesce("reconstruction_corr", low) >= min_corr)
        & (F.coalesce("loss_ratio", low) >= min_ratio)
    )
    return runs.withColumn("balanced_selection_score", score).withColumn("passes_minimum_diagnostics", ok)


def ablation_table(runs: DataFrame) -> DataFrame:
    """Loss mode, validation loss, error and headline metrics of each run."""
    return runs.select("variant", "best_val_loss", "test_mae_x1e3", "f1_pct", "individual_acc_pct")


def select_final(runs: DataFrame, mode: str | None = None, mode_col: str = "loss_mode", order: str = "variant") -> DataFrame:
    """The run of the fixed mode if there is one, else the best selection score."""
    keys = [F.col("balanced_selection_score").desc(), F.col(order).asc()]
    if mode is not None:
        keys.insert(0, (F.col(mode_col) == F.lit(mode)).cast("int").desc())
    return runs.orderBy(*keys).limit(1)

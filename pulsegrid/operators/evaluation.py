"""Evaluation of one detector as one operator, under any number of protocols."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions import arrays as ar
from pulsegrid.operators import metrics as me
from pulsegrid.operators import reports as rp
from pulsegrid.session import stored

KEY = "recording_id"


@dataclass(frozen=True)
class Evaluation:
    """Everything that one evaluation gives; the frames read one written table of window losses."""

    signal_tau: float
    individual_tau: float
    individual_acc: float | None
    metrics: DataFrame  # one row each for validation and test windows
    predictions: DataFrame  # test windows
    records: DataFrame  # test records: class, flagged percentage, mean score
    audit: DataFrame  # test records: outcome, score distribution, worst channel
    diagnostics: DataFrame  # one row: losses by class, record gap


def evaluate(
    windows: DataFrame,
    reconstruct: Callable[[DataFrame], DataFrame],
    fit_rows: Column,
    protocol: str,
    method: str,
    percent: float = 85.0,
    features: Sequence[str] = (),
    tune_on: str = "test",
) -> Evaluation:
    """Losses, thresholds, flags, metrics, record tables and diagnostics of a reconstruction.

    ``windows`` has window_id, recording_id, y, model_split (train, val, test) and x; ``reconstruct`` adds x_hat. A window is flagged if its
    loss is over the ``percent`` percentile of the loss of ``fit_rows``; a record if the percentage of its flagged windows is over the
    threshold that tells the records of ``tune_on`` (test or val) apart best. Windows without a class are scored, not judged. Raises
    if there is no row to take the threshold from. Windows are reconstructed once.
    """
    names = list(features)
    made = reconstruct(windows.withColumn("_fit", F.coalesce(fit_rows, F.lit(False)))).select(
        "window_id", KEY, F.col("y").alias("y_true"), F.col("model_split").alias("split"), "_fit",
        ar.weighted_mse(F.col("x"), F.col("x_hat")).alias("score"),
        *[F.get(ar.channel_mse(F.col("x"), F.col("x_hat")), F.lit(i)).alias(f"mse_{n}") for i, n in enumerate(names)],
    )
    scored = stored(made.where(F.col("_fit") | F.col("split").isin("val", "test")), "window-losses")
    tau = me.percentile_threshold(scored.where("_fit"), percent).first()
    if tau is None or tau["tau"] is None:
        raise ValueError("no rows to take the threshold from")
    flagged = me.flag_scores(scored.where(F.col("split").isin("val", "test")), tau["tau"]).drop("_fit")
    test = flagged.where("split = 'test'")
    best = me.best_individual_threshold(me.record_anomaly_pct(flagged.where(F.col("split") == tune_on))).first()
    individual_tau, individual_acc = (best["individual_tau"], best["individual_acc"]) if best else (50.0, None)
    records = me.record_anomaly_pct(test)
    on_test = lambda v: F.when(F.col("split") == "test", F.lit(v).cast("double"))
    metrics = me.metric_row(flagged, ["split"]).select(
        F.lit(protocol).alias("protocol"), F.lit(method).alias("method"), "*", F.lit(float(tau["tau"])).alias("signal_tau"),
        on_test(individual_tau).alias("individual_tau"), on_test(individual_acc).alias("individual_acc"),
    )
    return Evaluation(
        float(tau["tau"]), float(individual_tau), individual_acc, metrics,
        rp.window_prediction_table(test, protocol, method), records,
        me.subject_error_audit(test, individual_tau, {n: F.col(f"mse_{n}") for n in names} or None),
        me.loss_diagnostics(test, records),
    )


def evaluate_protocols(
    protocols: Mapping[str, tuple[DataFrame, Column]], reconstruct: Callable[[DataFrame], DataFrame], method: str, **settings
) -> tuple[DataFrame, dict[str, Evaluation]]:
    """The metric rows of all protocols and each protocol's evaluation; a protocol is its windows and the rows of its threshold."""
    made = {name: evaluate(windows, reconstruct, fit, name, method, **settings) for name, (windows, fit) in protocols.items()}
    return reduce(lambda a, b: a.unionByName(b), [e.metrics for e in made.values()]), made

"""Window tensors: scan, morphology bins, robust scaling, losses, quality of reconstruction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions import arrays as ar
from pulsegrid.functions import batches
from pulsegrid.plans.joins import join_lookup
from pulsegrid.plans.ordered import quantiles
from pulsegrid.schema import FEATURES
from pulsegrid.session import stored


def scan_windows(df: DataFrame, samples: int, array: str = "ecg", order: Sequence[str] = ("recording_id", "window_start")) -> DataFrame:
    """Windows in (record, start) order; an array of another length raises."""
    wrong = F.raise_error(F.concat(F.lit("invalid window length: "), F.size(array).cast("string")))
    checked = F.when(F.size(array) == samples, F.col(array)).otherwise(wrong)
    return df.withColumn(array, checked).orderBy(*order)


def morphology(df: DataFrame, steps: int = 100, array: str = "ecg", out: str = "x", arrow: bool = True) -> DataFrame:
    """Add the feature tensor of each window, in Arrow batches or as a plain expression."""
    make = batches.morphology_bins if arrow else ar.morphology_bins
    return df.withColumn(out, make(F.col(array), steps))


def sequence_features(
    df: DataFrame, keys: Sequence[str], tensor: str = "x", out: str = "features", arrow: bool = True
) -> DataFrame:
    """Sixteen features per channel of every window as an array of arrays, beside the keys."""
    if arrow:
        return batches.map_tensor(df, keys, tensor, out, batches.sequence_features)
    return df.select(*keys, F.transform(F.col(tensor), ar.sequence_features).alias(out))


def tensor_long(df: DataFrame, keys: Sequence[str], tensor: str = "x", names: Sequence[str] = FEATURES) -> DataFrame:
    """One row per window, step and feature."""
    labels = F.array(*[F.lit(n) for n in names])
    per = df.select(*keys, F.posexplode(tensor).alias("_c", "_steps"))
    return per.select(
        *keys, F.get(labels, F.col("_c")).alias("feature"), F.posexplode("_steps").alias("step", "value")
    )


def robust_minmax_fit(
    df: DataFrame, tensor: str = "x", lower: float = 1.0, upper: float = 99.0, names: Sequence[str] = FEATURES, limit=None
) -> DataFrame:
    """Bounds per feature: quantiles, else min and max, else 0 and 1."""
    finite = tensor_long(df, [], tensor, names).where(
        F.col("value").isNotNull() & ~F.isnan("value")
    )
    q = quantiles(finite, ["feature"], "value", {"q_lo": lower / 100.0, "q_hi": upper / 100.0}, limit)
    ends = finite.groupBy("feature").agg(F.min("value").alias("v_lo"), F.max("value").alias("v_hi"))
    good = lambda a, b: (F.abs(F.col(a)) < float("inf")) & (F.abs(F.col(b)) < float("inf")) & (F.col(b) > F.col(a))
    first, second = F.coalesce(good("q_lo", "q_hi"), F.lit(False)), F.coalesce(good("v_lo", "v_hi"), F.lit(False))
    return ends.join(q, "feature").select(
        "feature",
        F.when(first, F.col("q_lo")).when(second, F.col("v_lo")).otherwise(F.lit(0.0)).alias("lo"),
        F.when(first, F.col("q_hi")).when(second, F.col("v_hi")).otherwise(F.lit(1.0)).alias("hi"),
    )


def robust_scale(df: DataFrame, fit: DataFrame, tensor: str = "x", names: Sequence[str] = FEATURES) -> DataFrame:
    """Scale with fitted bounds; the bounds (one pair per feature) come to the driver."""
    bounds = {r["feature"]: (r["lo"], r["hi"]) for r in fit.select("feature", "lo", "hi").collect()}
    if not bounds:
        raise ValueError("no rows to fit the bounds on")
    pairs = [bounds.get(n, (0.0, 1.0)) for n in names]
    return df.withColumn(tensor, ar.robust_scale(F.col(tensor), [p[0] for p in pairs], [p[1] for p in pairs]))


def model_input(
    windows: DataFrame, fit_rows: Column, steps: int = 100, array: str = "ecg", lower: float = 1.0, upper: float = 99.0
) -> DataFrame:
    """Morphology tensor scaled with bounds fitted on the rows for which ``fit_rows`` holds.

    The bins are computed once and written; bounds and everything after read them.
    """
    binned = stored(morphology(windows, steps, array), "bins")
    return robust_scale(binned, robust_minmax_fit(binned.where(fit_rows), lower=lower, upper=upper))


def feature_profile(
    df: DataFrame, group: Sequence[str], tensor: str = "x", names: Sequence[str] = FEATURES, limit=None
) -> DataFrame:
    """Range, percentiles and saturation of each feature per group."""
    long = tensor_long(df, group, tensor, names)
    keys = [*group, "feature"]
    q = quantiles(long, keys, "value", {"p01": 0.01, "p05": 0.05, "p50": 0.5, "p95": 0.95, "p99": 0.99}, limit)
    share = lambda c: F.avg(F.when(c, 1.0).otherwise(0.0))
    ends = long.groupBy(*keys).agg(
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        share(F.col("value") <= 1e-6).alias("frac_at_0"),
        share(F.col("value") >= 1.0 - 1e-6).alias("frac_at_1"),
    )
    return ends.join(q, keys)


# Weights of (mse, pattern, trend) in each loss mode.
LOSS_MODES = {
    "mse_only": None,
    "mse_plus_pattern": (0.5, 0.5, 0.0),
    "mse_plus_trend": (0.5, 0.0, 0.5),
    "cploss_full": (0.3, 0.3, 0.4),
}


def composite_loss(df: DataFrame, batch: Sequence[str], mode: str = "cploss_full", x: str = "x", x_hat: str = "x_hat") -> DataFrame:
    """Loss of each window; parts are divided by their batch mean."""
    if mode not in LOSS_MODES:
        raise ValueError(f"unknown loss mode: {mode}")
    parts = {"mse": ar.weighted_mse, "pattern": ar.pattern_loss, "trend": ar.trend_loss}
    scored = df.select("*", *[f(F.col(x), F.col(x_hat)).alias(f"_{n}") for n, f in parts.items()])
    shares = LOSS_MODES[mode]
    if shares is None:
        return scored.withColumn("loss", F.col("_mse")).drop(*[f"_{n}" for n in parts])
    means = scored.groupBy(*batch).agg(*[F.avg(f"_{n}").alias(f"_m_{n}") for n in parts])
    joined = join_lookup(scored, means, list(batch), computed=True)
    loss = sum(
        (F.lit(w) * F.col(f"_{n}") / (F.col(f"_m_{n}") + 1e-6) for w, n in zip(shares, parts, strict=True) if w), F.lit(0.0)
    )
    return joined.withColumn("loss", loss).drop(*[f"_{n}" for n in parts], *[f"_m_{n}" for n in parts])


PARTS = ("Training", "Validation", "Test (Healthy)", "Test (Anomalous)")


def quality_part(split: Column, y: Column) -> Column:
    """Part of a window in the quality table: normal training, validation, test by class."""
    return (
        F.when((split == "train") & (y == 0), PARTS[0]).when(split == "val", PARTS[1])
        .when((split == "test") & (y == 0), PARTS[2]).when((split == "test") & (y == 1), PARTS[3])
    )


def reconstruction_quality(
    df: DataFrame, part: Column, x: str = "x", x_hat: str = "x_hat", parts: Sequence[str] = PARTS
) -> DataFrame:
    """MAE, RMSE (x 1e3), correlation and cosine per part; an empty part is a row of NULLs."""
    a, b = F.flatten(F.col(x)), F.flatten(F.col(x_hat))
    flat = df.select(part.alias("part"), a.alias("a"), b.alias("b")).where(F.col("part").isNotNull())
    sums = flat.select(
        "part",
        F.size("a").alias("n"),
        ar.total(F.zip_with("a", "b", lambda u, v: F.abs(u - v))).alias("abs"),
        ar.total(F.zip_with("a", "b", lambda u, v: (u - v) * (u - v))).alias("sq"),
        ar.pearson(F.col("a"), F.col("b")).alias("pearson"),
        ar.cosine(F.col("a"), F.col("b")).alias("cosine"),
    )
    got = sums.groupBy("part").agg(
        (F.sum("abs") / F.sum("n") * 1e3).alias("mae_x1e3"),
        (F.sqrt(F.sum("sq") / F.sum("n")) * 1e3).alias("rmse_x1e3"),
        F.avg("pearson").alias("pearson"),
        F.avg("cosine").alias("cosine"),
    )
    wanted = df.sparkSession.createDataFrame([(p,) for p in parts], "part string")
    return wanted.join(got, "part", "left")


def error_reference(df: DataFrame, channel: int, x: str = "x", x_hat: str = "x_hat") -> DataFrame:
    """Mean absolute error of a channel and mean plus two standard deviations."""
    errors = df.select(
        F.explode(
            F.zip_with(F.get(F.col(x), F.lit(channel)), F.get(F.col(x_hat), F.lit(channel)), lambda u, v: F.abs(u - v))
        ).alias("e")
    )
    return errors.agg(F.avg("e").alias("mean_error"), (F.avg("e") + 2 * F.stddev_pop("e")).alias("high_error"))


def fingerprint(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Content hash of a table that does not depend on row order.

    Each row is hashed; the sum of the first 15 hex digits and the row count identify the
    set of rows including repeats.
    """
    row = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in columns])
    head = F.conv(F.substring(F.sha2(row, 256), 1, 15), 16, 10).cast("decimal(20,0)")
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(head).cast("decimal(38,0)").cast("string").alias("digest")
    )

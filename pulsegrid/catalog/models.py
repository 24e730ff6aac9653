"""Queries that fit or apply a model.

What a fit returns depends on the library's optimiser. Each fitted model has two queries: one returns its results for every
window and has no SQL (a brute-force version in the tests stands for it), the other returns facts that SQL can state: which
windows are judged, and that the outputs keep the rules they must keep.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsegrid.catalog.registry import query, r6, rounded
from pulsegrid.catalog.scores import SPLIT, TENSOR, fitted_threshold, is_fit_row, tensor_windows
from pulsegrid.functions import arrays as ar
from pulsegrid.operators import learning as le
from pulsegrid.operators import metrics as me
from pulsegrid.session import stored

IS_FIT = "recording_id LIKE 'c%' AND y = 0 AND window_id IN (SELECT window_id FROM spl WHERE model_split = 'train')"


def is_train():
    return F.col("model_split") == "train"


@query("ml02_batch_predict", f"WITH {TENSOR} SELECT window_id, feature, step, round(a * 0.5 + 0.25, 6) AS value FROM t")
def batch_predict(spark, sf):
    from pulsegrid.operators.tensors import tensor_long

    made = le.batch_predict(tensor_windows(spark, sf).select("window_id", "x"), lambda cube: cube * 0.5 + 0.25)
    return rounded(tensor_long(made, ["window_id"], "x_hat"), "value")


def squared_error(df):
    return ar.total(F.zip_with(F.flatten("x"), F.flatten("x_hat"), lambda a, b: (a - b) * (a - b)))


@query(
    "ml03_pca_reconstruct",
    f"""WITH {TENSOR}, mean AS (SELECT ch, step, avg(a) AS m FROM t WHERE {IS_FIT} GROUP BY 1, 2)
       SELECT window_id, round(sum((a - m) * (a - m)), 6) AS centred, TRUE AS never_rises, TRUE AS never_exceeds_centred
       FROM t JOIN mean USING (ch, step) GROUP BY 1""",
)
def pca_reconstruct(spark, sf):
    """Error around the mean of the fit rows; more components never raise a window's error."""
    x = tensor_windows(spark, sf).select("window_id", "recording_id", "y", "model_split", "x")
    out = x.select("window_id")
    for k in (1, 4, 16):
        made = le.pca_reconstruct(x, is_fit_row(), k)
        out = out.join(made.select("window_id", squared_error(made).alias(f"e{k}")), "window_id")
    mean = le.mean_reconstruct(x, is_fit_row())
    out = out.join(mean.select("window_id", squared_error(mean).alias("e0")), "window_id")
    falls = (F.col("e1") >= F.col("e4") - 1e-9) & (F.col("e4") >= F.col("e16") - 1e-9)
    return out.select("window_id", r6("e0").alias("centred"), falls.alias("never_rises"), (F.col("e1") <= F.col("e0") + 1e-9).alias("never_exceeds_centred"))


@query(
    "ml03_detect_with_pca",
    f"""WITH {SPLIT} SELECT model_split, count(*) AS n, sum(y)::BIGINT AS positives, TRUE AS counts_agree
       FROM spl WHERE model_split IN ('val', 'test') GROUP BY 1""",
)
def detect_with_pca(spark, sf):
    """Reconstruct, threshold on the training controls, metrics of validation and test windows."""
    x = tensor_windows(spark, sf).select("recording_id", "y", "model_split", "x")
    made = le.pca_reconstruct(x, is_fit_row())
    scored = made.select("recording_id", "y", "model_split", ar.weighted_mse(F.col("x"), F.col("x_hat")).alias("loss"))
    tau = fitted_threshold(scored)
    flagged = me.flag_scores(scored.where(F.col("model_split").isin("val", "test")), tau, "loss")
    m = me.metric_row(flagged, ["model_split"], "y", "y_pred", "loss")
    right = F.avg((F.col("y") == F.col("y_pred")).cast("double"))
    n = flagged.groupBy("model_split").agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").cast("long").alias("positives"), right.alias("right"),
        F.bool_and((F.col("loss") > tau) == (F.col("y_pred") == 1)).alias("by_tau"),
    )
    agree = F.col("by_tau") & (F.abs(F.col("accuracy_pct") - 100.0 * F.col("right")) < 1e-9)
    return n.join(m, "model_split").select("model_split", "n", "positives", agree.alias("counts_agree"))


@query("ml03_window_losses")
def window_losses(spark, sf):
    """Loss of every window after reconstruction from 16 components, and whether it is over the threshold."""
    x = tensor_windows(spark, sf).select("window_id", "recording_id", "y", "model_split", "x")
    scored = stored(le.pca_reconstruct(x, is_fit_row()).select("window_id", "recording_id", "y", "model_split", ar.weighted_mse(F.col("x"), F.col("x_hat")).alias("loss")), "losses")
    return rounded(me.flag_scores(scored, fitted_threshold(scored), "loss").select("window_id", "model_split", "y", "loss", "y_pred"), "loss")


@query("ml03_detector_metrics")
def detector_metrics(spark, sf):
    """Metrics of that detector on validation and test windows."""
    judged = window_losses(spark, sf).where(F.col("model_split").isin("val", "test"))
    return me.metric_row(judged, ["model_split"], "y", "y_pred", "loss")


@query("ml04_window_clusters")
def window_clusters(spark, sf):
    """Cluster, flag and score of every window."""
    found = le.feature_kmeans(tensor_windows(spark, sf), is_train())
    return rounded(found.select("window_id", "y", "is_train", "cluster", "y_pred", "score"), "score")


@query("ml05_window_predictions")
def window_predictions(spark, sf):
    """Score of every window, the threshold chosen on validation windows, and the flag."""
    scored, tau = le.supervised_baseline(tensor_windows(spark, sf), is_train(), F.col("model_split") == "val")
    return rounded(scored.select("window_id", "y", "is_train", "is_val", "score", F.lit(float(tau)).alias("tau"), "y_pred"), "score")


@query("ml06_window_clusters")
def dtw_window_clusters(spark, sf):
    """DTW cluster, distance to its centre and flag of every window."""
    found = le.dtw_cluster(tensor_windows(spark, sf), is_train(), ["window_id"])
    return rounded(found.select("window_id", "y", "is_train", "cluster", "distance", "y_pred"), "distance")


def facts(scored, keys, agrees):
    return scored.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum("y").cast("long").alias("positives"), F.bool_and(agrees).alias("consistent"))


@query(
    "ml04_feature_kmeans",
    f"""WITH {SPLIT} SELECT model_split = 'train' AS is_train, count(*) AS n, sum(y)::BIGINT AS positives, TRUE AS consistent
       FROM spl GROUP BY 1""",
)
def feature_kmeans(spark, sf):
    """Every window is flagged if it is nearer to the anomalous centre."""
    scored = le.feature_kmeans(tensor_windows(spark, sf), is_train())
    return facts(scored, ["is_train"], (F.col("score") > 0) == (F.col("y_pred") == 1))


@query(
    "ml05_supervised_baseline",
    f"""WITH {SPLIT} SELECT model_split = 'train' AS is_train, model_split = 'val' AS is_val, count(*) AS n, sum(y)::BIGINT AS positives,
       TRUE AS consistent FROM spl GROUP BY 1, 2""",
)
def supervised_baseline(spark, sf):
    scored, tau = le.supervised_baseline(tensor_windows(spark, sf), is_train(), F.col("model_split") == "val")
    fine = ((F.col("score") >= tau) == (F.col("y_pred") == 1)) & F.col("score").between(0.0, 1.0)
    return facts(scored, ["is_train", "is_val"], fine)


@query(
    "ml06_dtw_cluster",
    f"""WITH {SPLIT} SELECT model_split = 'train' AS is_train, count(*) AS n, sum(y)::BIGINT AS positives, TRUE AS consistent
       FROM spl GROUP BY 1""",
)
def dtw_cluster(spark, sf):
    """Every window is flagged if its cluster is the one that is richer in events on training rows."""
    out = le.dtw_cluster(tensor_windows(spark, sf), is_train(), ["window_id"])
    rates = out.where("is_train").groupBy("cluster").agg(F.avg(F.col("y").cast("double")).alias("rate"), F.max("y_pred").alias("flag"))
    richer = rates.agg(F.max_by("flag", F.struct("rate", -F.col("cluster"))).alias("flag"), F.sum("flag").alias("flags")).first()
    right = F.lit(richer["flag"] == 1 and richer["flags"] == 1)
    return facts(out, ["is_train"], right & (F.col("distance") >= 0) & (F.col("y_pred") == F.col("score").cast("int")))


@query(
    "ml06_dtw_distance",
    f"""WITH RECURSIVE {TENSOR}, s AS (SELECT window_id, list(a ORDER BY step) AS v FROM t WHERE ch = 0 GROUP BY 1),
       p AS (SELECT s.window_id, s.v, r.window_id AS reference, r.v AS b FROM s, s r WHERE r.window_id IN (0, 1)),
       d AS (SELECT window_id, reference, v, b, 0 AS k, [0.0::DOUBLE{", 'inf'::DOUBLE" * 16}] AS up,
                    ['inf'::DOUBLE] AS cur FROM p
         UNION ALL
         SELECT window_id, reference, v, b, k + 1, CASE WHEN k % 16 = 15 THEN made ELSE up END, CASE WHEN k % 16 = 15 THEN ['inf'::DOUBLE] ELSE made END
         FROM (SELECT *, list_append(cur, least(up[k % 16 + 2], up[k % 16 + 1], cur[k % 16 + 1])
                 + (v[k // 16 + 1] - b[k % 16 + 1]) * (v[k // 16 + 1] - b[k % 16 + 1])) AS made FROM d WHERE k < 256))
       SELECT window_id, reference, round(sqrt(up[17]), 6) AS distance FROM d WHERE k = 256""",
)
def dtw_distance(spark, sf):
    """Warping distance of every window's first channel to two fixed windows."""
    rows = stored(tensor_windows(spark, sf).select("window_id", F.element_at("x", 1).alias("sequence")), "sequences")
    out = None
    for reference in (0, 1):
        fixed = rows.where(F.col("window_id") == reference).first()["sequence"]
        part = le.nearest_by_dtw(rows, [fixed]).select("window_id", F.lit(reference).cast("long").alias("reference"), "distance")
        out = part if out is None else out.unionByName(part)
    return rounded(out, "distance")


def uniform_sql(seed: int, *keys: str) -> str:
    parts = " || '|' || ".join([f"'{seed}'", *(f"CAST({k} AS VARCHAR)" for k in keys)])
    return f"((CAST('0x' || substr(md5({parts}), 1, 12) AS BIGINT) + 0.5::DOUBLE) / 281474976710656.0::DOUBLE)"


GAUSS = f"(sqrt(-2.0 * ln({uniform_sql(42, 'window_id', 'ch', 'step')})) * cos({uniform_sql(43, 'window_id', 'ch', 'step')} * 2.0 * pi()))"


@query(
    "ar14_add_noise",
    f"""WITH {TENSOR} SELECT window_id, CAST(ch * 16 + step AS INTEGER) AS pos,
       round(greatest(0.0::DOUBLE, least(1.0::DOUBLE, a + greatest(-0.1::DOUBLE, least(0.1::DOUBLE, {GAUSS} * 0.03::DOUBLE)))), 6) AS value FROM t""",
)
def add_noise(spark, sf):
    x = tensor_windows(spark, sf)
    noisy = ar.add_noise(F.col("x"), F.col("window_id"))
    return rounded(x.select("window_id", F.posexplode(F.flatten(noisy)).alias("pos", "value")), "value")


@query(
    "ar15_mask_steps",
    f"""WITH {TENSOR} SELECT window_id, CAST(ch * 16 + step AS INTEGER) AS pos,
       round(CASE WHEN {uniform_sql(42, 'window_id', 'step')} < 0.25 THEN 0.0 ELSE a / 0.75::DOUBLE END, 6) AS value FROM t""",
)
def mask_steps(spark, sf):
    x = tensor_windows(spark, sf)
    masked = ar.mask_steps(F.col("x"), F.col("window_id"))
    return rounded(x.select("window_id", F.posexplode(F.flatten(masked)).alias("pos", "value")), "value")


@query(
    "ext02_noise_robustness",
    f"""WITH {TENSOR}, lv AS (SELECT unnest([0.0::DOUBLE, 0.01::DOUBLE, 0.03::DOUBLE, 0.1::DOUBLE]) AS level),
       tau AS (SELECT quantile_cont(loss, 0.85) AS tau FROM loss WHERE {IS_FIT}),
       nz AS (SELECT level, window_id, y, ch, step, CASE WHEN level = 0 THEN a ELSE greatest(0.0::DOUBLE, least(1.0::DOUBLE,
                 a + greatest(-1.0::DOUBLE, least(1.0::DOUBLE, {GAUSS} * level)))) END AS n
              FROM t, lv WHERE window_id IN (SELECT window_id FROM spl WHERE model_split IN ('val', 'test'))),
       nb AS (SELECT *, avg(n) OVER (PARTITION BY level, window_id, ch, step // 4) AS m FROM nz),
       nl AS (SELECT level, window_id, y, sum(mse * w) AS loss FROM (SELECT level, window_id, y, ch, avg((n - m) * (n - m)) AS mse FROM nb GROUP BY ALL)
              JOIN w USING (ch) GROUP BY ALL)
       SELECT level, round(100.0 * avg(CASE WHEN (loss > tau) = (y = 1) THEN 1.0 ELSE 0.0 END), 6) AS accuracy_pct,
              round(100.0 * avg(CASE WHEN loss <= tau THEN 1.0 ELSE 0.0 END) FILTER (y = 0), 6) AS specificity_pct,
              round(100.0 * avg(CASE WHEN loss > tau THEN 1.0 ELSE 0.0 END) FILTER (y = 1), 6) AS recall_pct FROM nl, tau GROUP BY 1""",
)
def noise_robustness(spark, sf):
    x = tensor_windows(spark, sf).select("window_id", "recording_id", "y", "model_split", "x")
    smooth = lambda df: df.withColumn("x_hat", ar.block_mean(F.col("x"), 4))
    made = le.noise_robustness(x, is_fit_row(), smooth, judged=F.col("model_split").isin("val", "test"))
    return rounded(made.select("level", "accuracy_pct", "specificity_pct", "recall_pct"), "accuracy_pct", "specificity_pct", "recall_pct")

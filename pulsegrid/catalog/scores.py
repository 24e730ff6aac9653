"""Queries over window tensors, splits, scores, thresholds and logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsegrid.catalog import feeds
from pulsegrid.catalog.feeds import STEPS, table
from pulsegrid.catalog.registry import in_order, query, r6, rounded
from pulsegrid.functions import arrays as ar
from pulsegrid.operators import benchlog as bl
from pulsegrid.operators import evaluation as ev
from pulsegrid.operators import filters as fl
from pulsegrid.operators import joins as jn
from pulsegrid.operators import metrics as me
from pulsegrid.operators import reshape
from pulsegrid.operators import sequence as sq
from pulsegrid.operators import splits as sp
from pulsegrid.operators import tensors as te
from pulsegrid.schema import DEVELOPMENT_RECORDS, FEATURE_WEIGHTS, FEATURES

WIN, PRED = feeds.WINDOWS_SQL, feeds.PREDICTIONS_SQL

# ---------------------------------------------------------------- scan, split


@query("src10_scan_windows", f"WITH {WIN} SELECT window_id, recording_id, window_start, y, split, len(ecg) AS n_samples FROM win")
def scan_windows(spark, sf):
    scanned = te.scan_windows(feeds.windows(spark, sf), 64)
    return scanned.select("window_id", "recording_id", "window_start", "y", "split", F.size("ecg").alias("n_samples"))


def split_sql(test: str) -> str:
    return f"""{WIN}, fo AS (SELECT recording_id, (row_number() OVER (ORDER BY round(rate, 9), md5('42|' || recording_id), recording_id)
        - 1) % 5 AS fold FROM (SELECT recording_id, avg(y::DOUBLE) AS rate FROM win WHERE NOT ({test}) GROUP BY 1)),
  spl AS (SELECT win.*, CASE WHEN {test} THEN 'test' WHEN fold = 0 THEN 'val' WHEN fold IS NOT NULL THEN 'train' ELSE 'unused' END
        AS model_split FROM win LEFT JOIN fo USING (recording_id))"""


SPLIT = split_sql("recording_id LIKE 'x%'")
SPLIT_DEV = split_sql(f"recording_id NOT IN {DEVELOPMENT_RECORDS}")


def split_windows(spark, sf, protocol="official"):
    return sp.group_stratified_split(feeds.windows(spark, sf), protocol=protocol)


@query(
    "wn11_group_stratified_split",
    f"WITH {SPLIT} SELECT window_id, recording_id, y, model_split FROM spl",
)
def group_stratified_split(spark, sf):
    return split_windows(spark, sf).select("window_id", "recording_id", "y", "model_split")


@query(
    "wn11_subject_independent_split",
    f"WITH {SPLIT_DEV} SELECT window_id, recording_id, y, model_split FROM spl",
)
def subject_independent_split(spark, sf):
    return split_windows(spark, sf, "subject_independent").select("window_id", "recording_id", "y", "model_split")


@query(
    "prj13_split_assignments",
    f"WITH {SPLIT} SELECT recording_id, window_start, y, split AS dataset_split, model_split FROM spl",
)
def split_assignments(spark, sf):
    return sp.split_assignments(split_windows(spark, sf))


@query(
    "ag10_split_summary",
    f"""WITH {SPLIT} SELECT model_split, count(*) AS windows, count(DISTINCT recording_id) AS recordings,
       count(*) FILTER (y = 0) AS normal_windows, count(*) FILTER (y = 1) AS apnea_windows,
       round(100.0 * (count(*) FILTER (y = 1)) / count(*)::DOUBLE, 6) AS apnea_pct FROM spl GROUP BY 1""",
)
def split_summary(spark, sf):
    return rounded(sp.split_summary(split_windows(spark, sf)), "apnea_pct")


@query(
    "set03_split_leakage",
    f"""WITH {SPLIT}, r AS (SELECT DISTINCT model_split AS s, recording_id FROM spl)
       SELECT u.a || '_' || u.b || '_overlap' AS pair, (SELECT count(*) FROM r x JOIN r z USING (recording_id)
         WHERE x.s = u.a AND z.s = u.b) AS n
       FROM (VALUES ('train', 'val'), ('train', 'test'), ('val', 'test')) u(a, b)""",
)
def split_leakage(spark, sf):
    return sp.split_leakage(split_windows(spark, sf))


@query(
    "ag09_dataset_sanity",
    f"""WITH {WIN}, n AS (SELECT *, len(ecg) AS n_samples FROM win)
       SELECT 'total_windows' AS "check", NULL::VARCHAR AS "key", count(*) AS n, NULL::BIGINT AS records FROM n
       UNION ALL SELECT 'min_samples', NULL, min(n_samples), NULL FROM n UNION ALL SELECT 'max_samples', NULL, max(n_samples), NULL FROM n
       UNION ALL SELECT 'class', y::VARCHAR, count(*), NULL FROM n GROUP BY y
       UNION ALL SELECT 'split', split, count(*), count(DISTINCT recording_id) FROM n GROUP BY split""",
)
def dataset_sanity(spark, sf):
    return sp.dataset_sanity(feeds.windows(spark, sf).withColumn("n_samples", F.size("ecg")))


@query(
    "ag26_fingerprint",
    f"""WITH {WIN} SELECT count(*) AS n_rows, CAST(sum(CAST(('0x' || substr(sha256(concat_ws('|', y::VARCHAR, recording_id,
       strftime(window_start, '%Y-%m-%d %H:%M:%S'), split)), 1, 15))::UBIGINT AS HUGEINT)) AS VARCHAR) AS digest FROM win""",
)
def fingerprint(spark, sf):
    return te.fingerprint(feeds.windows(spark, sf), ["y", "recording_id", "window_start", "split"])


# ---------------------------------------------------------------- tensors

BINS = f"""{SPLIT}, bins AS (
  SELECT window_id, recording_id, y, split, CAST(pos // 4 AS INT) AS step, avg(v) AS "mean", stddev_pop(v) AS "std", min(v) AS "min",
         max(v) AS "max", max(v) - min(v) AS "range", arg_max(v, pos) - arg_min(v, pos) AS slope, avg(v * v) AS energy
  FROM smp GROUP BY ALL),
bl AS (""" + " UNION ALL ".join(
    f"""SELECT window_id, recording_id, y, split, step, '{f}' AS feature, {i} AS ch, "{f}" AS value FROM bins"""
    for i, f in enumerate(FEATURES)
) + ")"

FIT = f"""{BINS}, q AS (SELECT feature, quantile_cont(value, 0.01) AS qlo, quantile_cont(value, 0.99) AS qhi, min(value) AS vlo,
   max(value) AS vhi FROM bl WHERE recording_id LIKE 'c%' AND y = 0
     AND window_id IN (SELECT window_id FROM spl WHERE model_split = 'train') GROUP BY 1),
 fit AS (SELECT feature, CASE WHEN qhi > qlo THEN qlo WHEN vhi > vlo THEN vlo ELSE 0 END AS lo,
                CASE WHEN qhi > qlo THEN qhi WHEN vhi > vlo THEN vhi ELSE 1 END AS hi FROM q)"""

# x is the scaled tensor, x_hat every value replaced by the mean of its block of four steps
TENSOR = f"""{FIT}, x AS (SELECT bl.*, greatest(0.0::DOUBLE, least(1.0::DOUBLE, (value - lo) / (hi - lo + 1e-8::DOUBLE))) AS a FROM bl JOIN fit USING (feature)),
 t AS (SELECT *, avg(a) OVER (PARTITION BY window_id, ch, step // 4) AS b FROM x),
 cm AS (SELECT window_id, recording_id, y, split, ch, feature, avg((a - b) * (a - b)) AS mse FROM t GROUP BY ALL),
 w AS (SELECT unnest([{', '.join(f'{v}::DOUBLE' for v in FEATURE_WEIGHTS)}]) / (1.0::DOUBLE + 1e-8::DOUBLE) AS w, generate_subscripts([1,2,3,4,5,6,7], 1) - 1 AS ch),
 loss AS (SELECT window_id, recording_id, y, split, sum(mse * w) AS loss, max(CASE WHEN ch = 0 THEN mse END) AS mean_loss,
                 avg(CASE WHEN ch > 0 THEN mse END) AS detail_loss FROM cm JOIN w USING (ch) GROUP BY ALL)"""


def is_control():
    return F.col("recording_id").startswith("c") & (F.col("y") == 0)


def is_fit_row():
    """Training windows of controls: all that bounds, components and thresholds may see."""
    return is_control() & (F.col("model_split") == "train")


def tensor_windows(spark, sf):
    return te.model_input(split_windows(spark, sf), is_fit_row(), STEPS)


def reconstructed(spark, sf):
    return tensor_windows(spark, sf).withColumn("x_hat", ar.block_mean(F.col("x"), 4))


def losses(spark, sf):
    x = reconstructed(spark, sf)
    mean_loss, detail_loss = ar.mean_and_detail_loss(F.col("x"), F.col("x_hat"))
    return x.select(
        "window_id", "recording_id", "y", "split", "model_split", ar.weighted_mse(F.col("x"), F.col("x_hat")).alias("loss"),
        mean_loss.alias("mean_loss"), detail_loss.alias("detail_loss"), "x", "x_hat",
    )


@query("ar01_morphology_bins", f"WITH {BINS} SELECT window_id, step, feature, round(value, 6) + 0.0 AS value FROM bl")
def morphology_bins(spark, sf):
    bins = te.morphology(feeds.windows(spark, sf), STEPS)
    return rounded(te.tensor_long(bins, ["window_id"]), "value")


@query("ag14_robust_minmax_fit", f"WITH {FIT} SELECT feature, round(lo, 6) AS lo, round(hi, 6) AS hi FROM fit")
def robust_minmax_fit(spark, sf):
    bins = te.morphology(split_windows(spark, sf).where(is_fit_row()), STEPS)
    return rounded(te.robust_minmax_fit(bins), "lo", "hi")


@query("ar02_robust_scale", f"WITH {TENSOR} SELECT window_id, step, feature, round(a, 6) AS value FROM t")
def robust_scale(spark, sf):
    return rounded(te.tensor_long(tensor_windows(spark, sf), ["window_id"]), "value")


@query("jn10_zip_reconstruction", f"WITH {TENSOR} SELECT window_id, CAST(ch * 16 + step AS INTEGER) AS pos, round(a, 6) AS x, round(b, 6) AS x_hat FROM t")
def zip_reconstruction(spark, sf):
    x = reconstructed(spark, sf).select("window_id", F.flatten("x").alias("x"), F.flatten("x_hat").alias("x_hat"))
    return rounded(jn.zip_reconstruction(x, ["window_id"]), "x", "x_hat")


@query("ar03_weighted_mse", f"WITH {TENSOR} SELECT window_id, round(loss, 8) AS loss FROM loss")
def weighted_mse(spark, sf):
    return rounded(losses(spark, sf).select("window_id", "loss"), "loss", digits=8)


@query(
    "ar04_mean_and_detail_loss",
    f"WITH {TENSOR} SELECT window_id, round(mean_loss, 8) AS mean_loss, round(detail_loss, 8) AS detail_loss FROM loss",
)
def mean_and_detail_loss(spark, sf):
    return rounded(losses(spark, sf).select("window_id", "mean_loss", "detail_loss"), "mean_loss", "detail_loss", digits=8)


@query("ar05_channel_mse", f"WITH {TENSOR} SELECT window_id, feature, round(mse, 8) AS mse FROM cm")
def channel_mse(spark, sf):
    per = reconstructed(spark, sf).select("window_id", ar.channel_mse(F.col("x"), F.col("x_hat")).alias("m"))
    names = F.array(*[F.lit(f) for f in FEATURES])
    long = per.select("window_id", F.posexplode("m").alias("c", "mse"))
    return rounded(long.select("window_id", F.get(names, F.col("c")).alias("feature"), "mse"), "mse", digits=8)


DIFFS = f"""{TENSOR}, d1 AS (SELECT *, a - lag(a) OVER o AS da, b - lag(b) OVER o AS db FROM t
     WINDOW o AS (PARTITION BY window_id, ch ORDER BY step)),
  d2 AS (SELECT *, da - lag(da) OVER o AS dda, db - lag(db) OVER o AS ddb FROM d1 WINDOW o AS (PARTITION BY window_id, ch ORDER BY step)),
  pc AS (SELECT window_id, ch, avg(abs(da - db)) AS p, avg(abs(dda - ddb)) AS r FROM d2 GROUP BY ALL),
  pt AS (SELECT window_id, sum(p * w) AS pattern, sum(r * w) AS trend FROM pc JOIN w USING (ch) GROUP BY 1)"""


@query("ar06_pattern_loss", f"WITH {DIFFS} SELECT window_id, round(pattern, 8) AS loss FROM pt")
def pattern_loss(spark, sf):
    x = reconstructed(spark, sf)
    return rounded(x.select("window_id", ar.pattern_loss(F.col("x"), F.col("x_hat")).alias("loss")), "loss", digits=8)


@query("ar07_trend_loss", f"WITH {DIFFS} SELECT window_id, round(trend, 8) AS loss FROM pt")
def trend_loss(spark, sf):
    x = reconstructed(spark, sf)
    return rounded(x.select("window_id", ar.trend_loss(F.col("x"), F.col("x_hat")).alias("loss")), "loss", digits=8)


def _composite(mode, expr):
    @query(
        f"ar08_composite_loss_{mode}",
        f"""WITH {DIFFS}, c AS (SELECT window_id, recording_id, loss AS m, pattern AS p, trend AS r FROM loss JOIN pt USING (window_id)),
         b AS (SELECT recording_id, avg(m) + 1e-6 AS bm, avg(p) + 1e-6 AS bp, avg(r) + 1e-6 AS br FROM c GROUP BY 1)
         SELECT window_id, round({expr}, 6) AS loss FROM c JOIN b USING (recording_id)""",
    )
    def composite_loss(spark, sf):
        x = reconstructed(spark, sf).select("window_id", "recording_id", "x", "x_hat")
        return rounded(te.composite_loss(x, ["recording_id"], mode).select("window_id", "loss"), "loss")


for _mode, _expr in {
    "mse_only": "m",
    "mse_plus_pattern": "0.5 * m / bm + 0.5 * p / bp",
    "mse_plus_trend": "0.5 * m / bm + 0.5 * r / br",
    "cploss_full": "0.3 * m / bm + 0.3 * p / bp + 0.4 * r / br",
}.items():
    _composite(_mode, _expr)

CORR = f"""{TENSOR}, fl AS (SELECT window_id, sum(a * b) AS ab, sqrt(sum(a * a)) * sqrt(sum(b * b)) AS n2,
    sum((a - ma) * (b - mb)) AS cab, sqrt(sum((a - ma) * (a - ma))) * sqrt(sum((b - mb) * (b - mb))) AS cn,
    sum(abs(a - b)) AS ae, sum((a - b) * (a - b)) AS se, count(*) AS n
    FROM (SELECT *, avg(a) OVER (PARTITION BY window_id) AS ma, avg(b) OVER (PARTITION BY window_id) AS mb FROM t) GROUP BY 1),
  cr AS (SELECT *, CASE WHEN cn > 1e-12 THEN cab / cn END AS pearson, CASE WHEN n2 > 1e-12 THEN ab / n2 END AS cosine FROM fl)"""


@query("ar09_window_pearson", f"WITH {CORR} SELECT recording_id, round(avg(pearson), 6) AS pearson FROM cr JOIN loss USING (window_id) GROUP BY 1")
def window_pearson(spark, sf):
    x = reconstructed(spark, sf).select(
        "recording_id", ar.pearson(F.flatten("x"), F.flatten("x_hat")).alias("p")
    )
    return rounded(x.groupBy("recording_id").agg(F.avg("p").alias("pearson")), "pearson")


@query("ar10_window_cosine", f"WITH {CORR} SELECT recording_id, round(avg(cosine), 6) AS cosine FROM cr JOIN loss USING (window_id) GROUP BY 1")
def window_cosine(spark, sf):
    x = reconstructed(spark, sf).select("recording_id", ar.cosine(F.flatten("x"), F.flatten("x_hat")).alias("p"))
    return rounded(x.groupBy("recording_id").agg(F.avg("p").alias("cosine")), "cosine")


@query(
    "ar11_reconstruction_quality",
    f"""WITH {CORR}, pp AS (SELECT CASE WHEN model_split = 'train' AND y = 0 THEN 'Training' WHEN model_split = 'val' THEN 'Validation'
         WHEN model_split = 'test' AND y = 0 THEN 'Test (Healthy)' WHEN model_split = 'test' AND y = 1 THEN 'Test (Anomalous)' END AS part, cr.*
         FROM cr JOIN spl USING (window_id))
       SELECT part, round(sum(ae) / sum(n) * 1e3, 6) AS mae_x1e3, round(sqrt(sum(se) / sum(n)) * 1e3, 6) AS rmse_x1e3,
              round(avg(pearson), 6) AS pearson, round(avg(cosine), 6) AS cosine FROM pp WHERE part IS NOT NULL GROUP BY 1""",
)
def reconstruction_quality(spark, sf):
    x = reconstructed(spark, sf)
    q = te.reconstruction_quality(x, te.quality_part(F.col("model_split"), F.col("y")))
    return rounded(q, "mae_x1e3", "rmse_x1e3", "pearson", "cosine")


@query(
    "ag12_feature_profile",
    f"""WITH {TENSOR} SELECT split, y, feature, round(min(a), 6) AS "min", round(quantile_cont(a, 0.01), 6) AS p01,
       round(quantile_cont(a, 0.05), 6) AS p05, round(quantile_cont(a, 0.5), 6) AS p50, round(quantile_cont(a, 0.95), 6) AS p95,
       round(quantile_cont(a, 0.99), 6) AS p99, round(max(a), 6) AS "max", round(avg(CASE WHEN a <= 1e-6 THEN 1.0 ELSE 0.0 END), 6) AS frac_at_0,
       round(avg(CASE WHEN a >= 1.0 - 1e-6 THEN 1.0 ELSE 0.0 END), 6) AS frac_at_1 FROM t GROUP BY 1, 2, 3""",
)
def feature_profile(spark, sf):
    p = te.feature_profile(tensor_windows(spark, sf), ["split", "y"])
    return rounded(p, "min", "p01", "p05", "p50", "p95", "p99", "max", "frac_at_0", "frac_at_1")


SEQ_SQL = f"""WITH {TENSOR}, m AS (SELECT window_id, feature, avg(a) AS mu, quantile_cont(a, [0.2, 0.4, 0.6, 0.8]) AS ps FROM t GROUP BY 1, 2),
  s AS (SELECT t.window_id, t.feature, t.step, t.a, a - mu AS c, ps, a - lag(a) OVER (PARTITION BY t.window_id, t.feature ORDER BY step) AS d
        FROM t JOIN m USING (window_id, feature)),
  f AS (SELECT window_id, feature, avg(a) AS mu, avg(c * c) AS var, min(a) AS lo, max(a) AS hi, avg(c * c * c) AS m3, avg(c * c * c * c) AS m4,
        min(CASE WHEN a >= ps[1] THEN step END) / 15.0::DOUBLE AS r20, min(CASE WHEN a >= ps[2] THEN step END) / 15.0::DOUBLE AS r40,
        min(CASE WHEN a >= ps[3] THEN step END) / 15.0::DOUBLE AS r60, min(CASE WHEN a >= ps[4] THEN step END) / 15.0::DOUBLE AS r80,
        avg(d) AS dm, max(d) AS dx, stddev_pop(d) AS ds, quantile_cont(d, 0.75) - quantile_cont(d, 0.25) AS di FROM s GROUP BY 1, 2)
  SELECT window_id, feature, {{cells}} FROM f"""
_CELLS = {
    "mean": "mu", "var": "var", "std": "sqrt(var)", "min": "lo", "max": "hi", "range": "hi - lo",
    "skew": "CASE WHEN var > 0 THEN m3 / pow(var, 1.5) ELSE 0 END", "kurtosis": "CASE WHEN var > 0 THEN m4 / (var * var) - 3 ELSE 0 END",
    "reach_p20": "r20", "reach_p40": "r40", "reach_p60": "r60", "reach_p80": "r80",
    "diff_mean": "dm", "diff_max": "dx", "diff_std": "ds", "diff_iqr": "di",
}


@query("ar13_sequence_features", SEQ_SQL.format(cells=", ".join(f'round({e}, 5) + 0.0 AS "{n}"' for n, e in _CELLS.items())))
def sequence_features(spark, sf):
    featured = te.sequence_features(tensor_windows(spark, sf), ["window_id"]).select("window_id", F.posexplode("features").alias("c", "f"))
    names = F.array(*[F.lit(f) for f in FEATURES])
    out = featured.select("window_id", F.get(names, F.col("c")).alias("feature"), "f")
    return out.select(
        "window_id", "feature", *[r6(F.get("f", F.lit(i)), 5).alias(n) for i, n in enumerate(ar.SEQUENCE_FEATURES)]
    )


@query(
    "wn12_scale_by_max",
    f"""WITH {TENSOR}, e AS (SELECT window_id, step, sum((a - b) * (a - b) * w) AS err FROM t JOIN w USING (ch) GROUP BY 1, 2)
       SELECT window_id, step, round(err / (max(err) OVER (PARTITION BY window_id) + 1e-8), 6) AS err FROM e""",
)
def scale_by_max(spark, sf):
    scaled = ar.scale_by_max(ar.step_error(F.col("x"), F.col("x_hat")))
    return rounded(reconstructed(spark, sf).select("window_id", F.posexplode(scaled).alias("step", "err")), "err")


@query(
    "ag30_error_reference",
    f"""WITH {TENSOR} SELECT round(avg(abs(a - b)), 6) AS mean_error, round(avg(abs(a - b)) + 2 * stddev_pop(abs(a - b)), 6) AS high_error
       FROM t WHERE feature = 'std' AND recording_id LIKE 'c%' AND y = 0 AND window_id IN (SELECT window_id FROM spl WHERE model_split = 'train')""",
)
def error_reference(spark, sf):
    return rounded(te.error_reference(reconstructed(spark, sf).where(is_fit_row()), 1), "mean_error", "high_error")


@query(
    "ml01_score_and_flag",
    f"""WITH {TENSOR}, ls AS (SELECT loss.*, model_split FROM loss JOIN spl USING (window_id)),
       tau AS (SELECT quantile_cont(loss, 0.85) AS tau FROM ls WHERE recording_id LIKE 'c%' AND y = 0 AND model_split = 'train')
       SELECT window_id, y, model_split, round(loss, 8) AS loss, CASE WHEN loss > tau THEN 1 ELSE 0 END AS y_pred FROM ls, tau
       WHERE model_split IN ('val', 'test')""",
)
def score_and_flag(spark, sf):
    """Flags of validation and test windows; the threshold is that of the training controls."""
    scored = losses(spark, sf).select("window_id", "recording_id", "y", "model_split", "loss")
    tau = fitted_threshold(scored)
    flagged = me.flag_scores(scored.where(F.col("model_split").isin("val", "test")), tau, "loss")
    return rounded(flagged.select("window_id", "y", "model_split", "loss", "y_pred"), "loss", digits=8)


def fitted_threshold(scored, percent=85.0):
    """Percentile of the loss of the training controls; without any there is no threshold."""
    tau = me.percentile_threshold(scored.where(is_fit_row()), percent, "loss").first()
    if tau is None or tau["tau"] is None:
        raise ValueError("no control windows in the training split to take the threshold from")
    return tau["tau"]


PROTOCOLS = {"official": SPLIT, "subject_independent": SPLIT_DEV}


def evaluation_sql(name: str) -> str:
    return f"""SELECT * FROM (WITH {TENSOR.replace(SPLIT, PROTOCOLS[name])}, ls AS (SELECT loss.*, model_split FROM loss JOIN spl USING (window_id)),
       tau AS (SELECT quantile_cont(loss, 0.85) AS tau FROM ls WHERE recording_id LIKE 'c%' AND y = 0 AND model_split = 'train'),
       fl AS (SELECT recording_id, y, model_split AS split, loss, CASE WHEN loss > tau THEN 1 ELSE 0 END AS p, tau FROM ls, tau WHERE model_split IN ('val', 'test')),
       cf AS (SELECT split, min(tau) AS tau, count(*) FILTER (y = 0 AND p = 0) AS tn, count(*) FILTER (y = 0 AND p = 1) AS fp, count(*) FILTER (y = 1 AND p = 0) AS fn,
                count(*) FILTER (y = 1 AND p = 1) AS tp FROM fl GROUP BY 1),
       auc AS (SELECT a.split, avg(CASE WHEN a.loss > b.loss THEN 1.0 WHEN a.loss = b.loss THEN 0.5 ELSE 0.0 END) AS roc_auc
               FROM fl a JOIN fl b ON a.split = b.split AND a.y = 1 AND b.y = 0 GROUP BY 1),
       rec AS (SELECT recording_id, CASE WHEN avg(y) > 0.05 THEN 1 ELSE 0 END AS label, 100.0::DOUBLE * avg(p) AS pct FROM fl WHERE split = 'test' GROUP BY 1),
       can AS (SELECT pct AS c FROM rec UNION SELECT 0.0 UNION SELECT 100.0),
       acc AS (SELECT c, avg(CASE WHEN (pct > c) = (label = 1) THEN 1.0 ELSE 0.0 END) AS acc FROM can, rec GROUP BY 1),
       bst AS (SELECT CASE WHEN (SELECT count(DISTINCT label) FROM rec) = 2 THEN arg_max(c, acc - c * 1e-9) ELSE 50.0 END AS individual_tau,
                      CASE WHEN (SELECT count(DISTINCT label) FROM rec) = 2 THEN max(acc) END AS individual_acc FROM acc)
       SELECT '{name}' AS protocol, 'block mean' AS method, split, round(100.0 * 2 * tp / greatest(1, 2 * tp + fp + fn), 6) AS f1_pct,
              round(100.0 * tp / greatest(1, tp + fn), 6) AS recall_pct, round(100.0 * tn / greatest(1, tn + fp), 6) AS specificity_pct,
              round(100.0 * (tp + tn) / (tp + tn + fp + fn), 6) AS accuracy_pct, round(roc_auc, 6) AS roc_auc, round(tau, 8) AS signal_tau,
              CASE WHEN split = 'test' THEN round(individual_tau, 6) END AS individual_tau, CASE WHEN split = 'test' THEN round(individual_acc, 6) END AS individual_acc
       FROM cf LEFT JOIN auc USING (split), bst)"""


@query("ml01_evaluation", " UNION ALL ".join(evaluation_sql(name) for name in PROTOCOLS))
def evaluation(spark, sf):
    """One detector under both protocols: thresholds, window metrics and record accuracy."""
    protocols = {name: (te.model_input(split_windows(spark, sf, name), is_fit_row(), STEPS), is_fit_row()) for name in PROTOCOLS}
    smooth = lambda df: df.withColumn("x_hat", ar.block_mean(F.col("x"), 4))
    rows, _ = ev.evaluate_protocols(protocols, smooth, "block mean", features=FEATURES)
    shown = rows.drop("precision_pct", "pr_auc")
    numbers = [c for c in shown.columns if c not in ("protocol", "method", "split", "signal_tau")]
    return rounded(rounded(shown, *numbers), "signal_tau", digits=8)


@query(
    "wn08_pick_examples",
    f"""WITH {TENSOR}, st AS (SELECT window_id, stddev_pop(a) AS spread FROM t GROUP BY 1), j AS (SELECT * FROM loss JOIN st USING (window_id)),
       c AS (SELECT split, quantile_cont(spread, 0.6) AS cut FROM j WHERE y = 0 GROUP BY 1),
       h AS (SELECT split, 'healthy' AS kind, window_id, loss, row_number() OVER (PARTITION BY split ORDER BY loss, window_id) AS rn
             FROM j JOIN c USING (split) WHERE y = 0 AND spread >= cut),
       a AS (SELECT split, 'anomalous' AS kind, window_id, loss, row_number() OVER (PARTITION BY split ORDER BY loss DESC, window_id) AS rn
             FROM j WHERE y = 1)
       SELECT split, kind, window_id, round(loss, 8) AS loss FROM (SELECT * FROM h UNION ALL SELECT * FROM a) WHERE rn = 1""",
)
def pick_examples(spark, sf):
    scored = losses(spark, sf).select(
        "window_id", "split", "y", "loss", ar.std(F.flatten("x")).alias("spread")
    )
    return rounded(me.pick_examples(scored, ["split"]), "loss", digits=8)


@query(
    "so03_head",
    f"""WITH {WIN} SELECT window_id, recording_id, y FROM win
       QUALIFY row_number() OVER (PARTITION BY split, y ORDER BY window_id) <= 50""",
)
def head(spark, sf):
    kept = reshape.head_per_group(feeds.windows(spark, sf), 50, ["split", "y"], ["window_id"])
    return kept.select("window_id", "recording_id", "y")


@query(
    "ml07_cluster_to_class",
    f"""WITH {WIN}, k AS (SELECT CAST(window_id % 3 AS INT) AS cluster, avg(y::DOUBLE) AS rate FROM win GROUP BY 1),
       f AS (SELECT c.cluster, coalesce(rate, 0) AS rate FROM (VALUES (0), (1), (2), (3)) c(cluster) LEFT JOIN k USING (cluster))
       SELECT cluster, round(rate, 6) AS rate, row_number() OVER (ORDER BY rate DESC, cluster) = 1 AS anomalous FROM f""",
)
def cluster_to_class(spark, sf):
    clustered = feeds.windows(spark, sf).withColumn("cluster", (F.col("window_id") % 3).cast("int"))
    return rounded(me.cluster_rates(clustered, (0, 1, 2, 3)), "rate")


# ---------------------------------------------------------------- scores and metrics


@query(
    "ag13_percentile_threshold",
    f"""WITH {feeds.SIGNALS_SQL} SELECT recording_id, round(quantile_cont(ecg_value, 0.85), 6) AS tau FROM sig
        WHERE ecg_value IS NOT NULL GROUP BY 1""",
)
def percentile_threshold(spark, sf):
    return rounded(me.percentile_threshold(feeds.clean_signals(spark, sf), 85.0, "ecg_value", ["recording_id"]), "tau")


RECS = f"""{PRED}, rp AS (SELECT recording_id, CASE WHEN avg(y_true::DOUBLE) > 0.05 THEN 1 ELSE 0 END AS record_label,
   avg(y_true::DOUBLE) AS true_apnea_rate, 100.0::DOUBLE * avg(y_pred::DOUBLE) AS anomaly_percentage, avg(score) AS mean_score,
   count(*) AS n_windows FROM pred GROUP BY 1)"""


def records(spark, sf):
    return me.record_anomaly_pct(feeds.predictions(spark, sf))


@query(
    "ag15_record_anomaly_pct",
    f"""WITH {RECS} SELECT recording_id, record_label, round(true_apnea_rate, 6) AS true_apnea_rate,
       round(anomaly_percentage, 6) AS anomaly_percentage, round(mean_score, 6) AS mean_score, n_windows FROM rp""",
)
def record_anomaly_pct(spark, sf):
    return rounded(records(spark, sf), "true_apnea_rate", "anomaly_percentage", "mean_score")


AUDIT = f"""{RECS}, q AS (SELECT recording_id, quantile_cont(score, 0.5) AS median_score, quantile_cont(score, 0.9) AS p90_score,
    quantile_cont(score, 0.95) AS p95_score, max(score) AS max_score, avg(score) AS c1, avg(row_id * 4.0::DOUBLE) AS c2 FROM pred GROUP BY 1)
  SELECT recording_id, record_label, CASE WHEN anomaly_percentage > 40 THEN 1 ELSE 0 END AS pred_record_label,
    CASE WHEN record_label = 0 THEN CASE WHEN anomaly_percentage > 40 THEN 'FP' ELSE 'TN' END
         ELSE CASE WHEN anomaly_percentage > 40 THEN 'TP' ELSE 'FN' END END AS error_type,
    n_windows, round(true_apnea_rate, 6) AS true_apnea_rate, round(anomaly_percentage, 6) AS anomaly_percentage,
    round(mean_score, 6) AS mean_score, round(median_score, 6) AS median_score, round(p90_score, 6) AS p90_score,
    round(p95_score, 6) AS p95_score, max_score, CASE WHEN c1 >= c2 THEN 'length' ELSE 'place' END AS top_error_channel,
    round(greatest(c1, c2), 6) AS top_error_channel_mse FROM rp JOIN q USING (recording_id)"""


@query("ag16_subject_error_audit", f"WITH {AUDIT} ORDER BY error_type, anomaly_percentage DESC")
def subject_error_audit(spark, sf):
    channels = {"length": F.col("score"), "place": F.col("row_id") * F.lit(4.0)}
    audit = me.subject_error_audit(feeds.predictions(spark, sf), 40.0, channels)
    return rounded(audit, "true_apnea_rate", "anomaly_percentage", "mean_score", "median_score", "p90_score", "p95_score",
                   "top_error_channel_mse")


@query(
    "so02_mixed_order",
    f"""WITH au AS (WITH {AUDIT}) SELECT recording_id, error_type, anomaly_percentage,
       row_number() OVER (ORDER BY error_type, anomaly_percentage DESC, recording_id) - 1 AS place FROM au""",
)
def mixed_order(spark, sf):
    rows = subject_error_audit(spark, sf).select("recording_id", "error_type", "anomaly_percentage")
    return in_order(rows, ["error_type", F.col("anomaly_percentage").desc(), "recording_id"])


CONF = """SELECT {by} count(*) FILTER (y_true = 0 AND y_pred = 0) AS tn, count(*) FILTER (y_true = 0 AND y_pred = 1) AS fp,
   count(*) FILTER (y_true = 1 AND y_pred = 0) AS fn, count(*) FILTER (y_true = 1 AND y_pred = 1) AS tp FROM pred {group}"""
CONF_BY = CONF.format(by="split,", group="GROUP BY split")


@query("ag17_confusion", f"WITH {PRED}, c AS ({CONF_BY}) SELECT *, round(tn / greatest(1, tn + fp), 6) AS specificity FROM c")
def confusion(spark, sf):
    return rounded(me.confusion(feeds.predictions(spark, sf), ["split"]), "specificity")


METRICS = """round(CASE WHEN 2*tp+fp+fn > 0 THEN 200.0::DOUBLE * tp / (2*tp+fp+fn) ELSE 0 END, 6) AS f1_pct,
   round(CASE WHEN tp+fp > 0 THEN 100.0::DOUBLE * tp / (tp+fp) ELSE 0 END, 6) AS precision_pct,
   round(CASE WHEN tp+fn > 0 THEN 100.0::DOUBLE * tp / (tp+fn) ELSE 0 END, 6) AS recall_pct,
   round(100.0::DOUBLE * tn / greatest(1, tn+fp), 6) AS specificity_pct,
   round(100.0::DOUBLE * (tp+tn) / (tp+tn+fp+fn), 6) AS accuracy_pct"""
PCTS = ("f1_pct", "precision_pct", "recall_pct", "specificity_pct", "accuracy_pct")


@query("ag18_binary_metrics", f"WITH {PRED}, c AS ({CONF_BY}) SELECT split, {METRICS} FROM c")
def binary_metrics(spark, sf):
    return rounded(me.binary_metrics(feeds.predictions(spark, sf), ["split"]), *PCTS)


CURVE = """cv AS (SELECT *, sum(pos) OVER o AS tp, sum(neg) OVER o AS fp, sum(pos) OVER (PARTITION BY split) AS np, sum(neg) OVER (PARTITION BY split) AS nn
   FROM (SELECT split, score, count(*) FILTER (y_true = 1) AS pos, count(*) FILTER (y_true = 0) AS neg FROM pred GROUP BY 1, 2)
   WINDOW o AS (PARTITION BY split ORDER BY score DESC)),
 ar AS (SELECT split, CASE WHEN max(np) > 0 AND max(nn) > 0 THEN sum(pos * (nn - fp + 0.5::DOUBLE * neg)) / max(np * nn)::DOUBLE END AS roc_auc,
   CASE WHEN max(np) > 0 AND max(nn) > 0 THEN sum(pos * tp / (tp + fp)::DOUBLE) / max(np)::DOUBLE END AS pr_auc FROM cv GROUP BY 1)"""


@query("ag19_roc_auc", f"WITH {PRED}, {CURVE} SELECT split, round(roc_auc, 6) AS roc_auc FROM ar")
def roc_auc(spark, sf):
    return rounded(me.roc_auc(feeds.predictions(spark, sf), ["split"]), "roc_auc")


@query("ag20_average_precision", f"WITH {PRED}, {CURVE} SELECT split, round(pr_auc, 6) AS pr_auc FROM ar")
def average_precision(spark, sf):
    return rounded(me.average_precision(feeds.predictions(spark, sf), ["split"]), "pr_auc")


@query(
    "set01_metric_tables",
    f"""WITH {PRED}, {CURVE}, c AS ({CONF_BY}) SELECT 'model' AS method, split, {METRICS}, round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc
       FROM c JOIN ar USING (split) UNION ALL SELECT 'plain', split, {METRICS}, NULL, NULL FROM c""",
)
def metric_tables(spark, sf):
    p = feeds.predictions(spark, sf)
    full = me.metric_row(p, ["split"]).withColumn("method", F.lit("model"))
    plain = me.binary_metrics(p, ["split"]).withColumn("method", F.lit("plain"))
    return rounded(reshape.union_tables(full, plain), *PCTS, "roc_auc", "pr_auc")


DIAG = """dg AS (SELECT avg(CASE WHEN y_true = 0 THEN score END) AS mean_healthy_loss, avg(CASE WHEN y_true = 1 THEN score END) AS mean_anomalous_loss,
   stddev_pop(score) AS prediction_std, avg(score / 10000) AS reconstruction_corr FROM pred),
 gp AS (SELECT max(CASE WHEN record_label = 0 THEN anomaly_percentage END) AS max_healthy_pct,
   min(CASE WHEN record_label = 1 THEN anomaly_percentage END) AS min_pathological_pct FROM rp)"""


@query(
    "ag21_loss_diagnostics",
    f"""WITH {RECS}, {DIAG} SELECT round(mean_healthy_loss, 6) AS mean_healthy_loss, round(mean_anomalous_loss, 6) AS mean_anomalous_loss,
       round(mean_anomalous_loss / (mean_healthy_loss + 1e-12), 6) AS loss_ratio, round(prediction_std, 6) AS prediction_std,
       round(reconstruction_corr, 6) AS reconstruction_corr, reconstruction_corr < 0.25 AS collapsed,
       round(max_healthy_pct, 6) AS max_healthy_pct, round(min_pathological_pct, 6) AS min_pathological_pct,
       round(min_pathological_pct - max_healthy_pct, 6) AS gap FROM dg, gp""",
)
def loss_diagnostics(spark, sf):
    p = feeds.predictions(spark, sf).withColumn("corr", F.col("score") / 10000)
    d = me.loss_diagnostics(p, me.record_anomaly_pct(p), corr="corr", prediction="score")
    return rounded(d, "mean_healthy_loss", "mean_anomalous_loss", "loss_ratio", "prediction_std", "reconstruction_corr",
                   "max_healthy_pct", "min_pathological_pct", "gap")


@query(
    "ag31_score_gap",
    f"""WITH {RECS}, {DIAG} SELECT round(max_healthy_pct, 6) AS max_healthy_pct, round(min_pathological_pct, 6) AS min_pathological_pct,
       round(min_pathological_pct - max_healthy_pct, 6) AS gap, CASE WHEN max_healthy_pct < min_pathological_pct THEN 'gap' ELSE 'overlap' END AS kind,
       round(least(max_healthy_pct, min_pathological_pct), 6) AS interval_start,
       round(greatest(max_healthy_pct, min_pathological_pct), 6) AS interval_end FROM gp""",
)
def score_gap(spark, sf):
    return rounded(me.score_gap(records(spark, sf)), "max_healthy_pct", "min_pathological_pct", "gap", "interval_start", "interval_end")


@query(
    "ag28_balanced_class_weights",
    "SELECT toxic, count(*) AS n_c, round((SELECT count(*) FROM labels) / (2.0::DOUBLE * count(*)), 6) AS weight FROM labels GROUP BY 1",
)
def balanced_class_weights(spark, sf):
    return rounded(me.balanced_class_weights(table(spark, sf, "labels"), "toxic"), "weight")


BOX = """q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3
   FROM events GROUP BY 1)"""


@query(
    "ag29_box_stats",
    f"""WITH {BOX} SELECT event_type, count(*) AS n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       round(least(q1, min(CASE WHEN value >= q1 - 1.5 * (q3 - q1) THEN value END)), 6) AS whisker_low,
       round(greatest(q3, max(CASE WHEN value <= q3 + 1.5 * (q3 - q1) THEN value END)), 6) AS whisker_high
       FROM events JOIN q USING (event_type) GROUP BY event_type, q1, median, q3""",
)
def box_stats(spark, sf):
    return rounded(me.box_stats(table(spark, sf, "events"), ["event_type"], "value"), "q1", "median", "q3", "whisker_low", "whisker_high")


SWEEP = f"""{RECS}, cand AS (SELECT anomaly_percentage AS tau FROM rp UNION SELECT 0 UNION SELECT 100),
  sw AS (SELECT tau, avg(CASE WHEN (anomaly_percentage > tau) = (record_label = 1) THEN 1.0::DOUBLE ELSE 0 END) AS accuracy
         FROM cand, rp GROUP BY 1)"""


@query("wn09_individual_threshold_sweep", f"WITH {SWEEP} SELECT round(tau, 6) AS tau, round(accuracy, 6) AS accuracy FROM sw")
def individual_threshold_sweep(spark, sf):
    return rounded(me.individual_threshold_sweep(records(spark, sf)).select("tau", "accuracy"), "tau", "accuracy")


@query(
    "wn09_best_individual_threshold",
    f"""WITH {SWEEP} SELECT round(tau, 6) AS individual_tau, round(accuracy, 6) AS individual_acc FROM sw
       ORDER BY round(accuracy, 9) DESC, tau LIMIT 1""",
)
def best_individual_threshold(spark, sf):
    return rounded(me.best_individual_threshold(records(spark, sf)), "individual_tau", "individual_acc")


_GRID_SQL = ", ".join(f"{v!r}::DOUBLE" for v in me.GRID)
_PROB_SQL = ", ".join(repr(v) for v in me.QUANTILE_GRID)
BALANCED = f"""{PRED}, sc AS (SELECT *, score / 20000 AS s FROM pred), cand AS (
    SELECT unnest([{_GRID_SQL}]) AS tau UNION SELECT unnest(quantile_cont(s, [{_PROB_SQL}])) FROM sc),
  c AS (SELECT tau, count(*) FILTER (y_true = 0 AND s < tau) AS tn, count(*) FILTER (y_true = 0 AND s >= tau) AS fp,
        count(*) FILTER (y_true = 1 AND s < tau) AS fn, count(*) FILTER (y_true = 1 AND s >= tau) AS tp FROM sc, cand GROUP BY 1),
  m AS (SELECT tau, CASE WHEN 2*tp+fp+fn > 0 THEN 2.0::DOUBLE*tp/(2*tp+fp+fn) ELSE 0 END AS f1, CASE WHEN tp+fp > 0 THEN tp::DOUBLE/(tp+fp) ELSE 0 END AS precision,
        CASE WHEN tp+fn > 0 THEN tp::DOUBLE/(tp+fn) ELSE 0 END AS recall, tn::DOUBLE/greatest(1, tn+fp) AS specificity,
        (tp+tn)::DOUBLE/(tp+tn+fp+fn) AS accuracy, (tp+fp)::DOUBLE/(tp+tn+fp+fn) AS rate FROM c),
  sw AS (SELECT *, 0.45*f1 + 0.45*0.5*(recall+specificity) + 0.10*accuracy - CASE WHEN rate < 0.05 OR rate > 0.95 THEN 0.25 ELSE 0 END AS sel FROM m)"""
_BAL_COLS = ("threshold", "f1", "precision", "recall", "specificity", "accuracy", "predicted_positive_rate", "balanced_accuracy", "selection_score")
_BAL_OUT = """round(tau, 6) AS threshold, round(f1, 6) AS f1, round(precision, 6) AS "precision", round(recall, 6) AS recall,
   round(specificity, 6) AS specificity, round(accuracy, 6) AS accuracy, round(rate, 6) AS predicted_positive_rate,
   round(0.5 * (recall + specificity), 6) AS balanced_accuracy, round(sel, 6) AS selection_score"""


def balanced(spark, sf):
    return me.balanced_threshold_sweep(feeds.predictions(spark, sf).withColumn("score", F.col("score") / 20000))


@query("wn10_balanced_threshold_sweep", f"WITH {BALANCED} SELECT {_BAL_OUT} FROM sw")
def balanced_threshold_sweep(spark, sf):
    return rounded(balanced(spark, sf), *_BAL_COLS)


@query("wn10_best_balanced_threshold", f"WITH {BALANCED} SELECT {_BAL_OUT} FROM sw ORDER BY round(sel, 12) DESC, tau LIMIT 1")
def best_balanced_threshold(spark, sf):
    return rounded(me.best_balanced_threshold(balanced(spark, sf)), *_BAL_COLS)


CAL = """v AS (SELECT event_type, 2.4414093::DOUBLE * pow(greatest(value / 100, 0), 1.5) AS v FROM events),
  c AS (SELECT event_type, quantile_cont(v, 0.7) AS top FROM v GROUP BY 1)"""


@query(
    "ar12_calibrated_error",
    f"""WITH {CAL} SELECT event_type, round(avg(least(v, top)) * 1e3, 5) AS mae_x1e3,
       round(sqrt(avg(least(v, top) * least(v, top))) * 1e3, 5) AS rmse_x1e3 FROM v JOIN c USING (event_type) GROUP BY 1""",
)
def calibrated_error(spark, sf):
    e = table(spark, sf, "events").withColumn("loss", F.col("value") / 100)
    return rounded(me.calibrated_error(e, ["event_type"]), "mae_x1e3", "rmse_x1e3", digits=5)


@query(
    "wn13_top_k_features",
    f"""WITH {BINS} SELECT feature, round(stddev_pop(value), 6) AS importance FROM bl GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3""",
)
def top_k_features(spark, sf):
    long = te.tensor_long(te.morphology(feeds.windows(spark, sf), STEPS), [])
    return rounded(me.top_k(long.groupBy("feature").agg(F.stddev_pop("value").alias("importance")), 3), "importance")


# ---------------------------------------------------------------- logs

LOG = """lg AS (SELECT event_id AS seq, CASE event_type WHEN 'click' THEN 'signals' WHEN 'view' THEN 'annotations_apnea' WHEN 'purchase' THEN
   'annotations_qrs' WHEN 'signup' THEN 'compression' ELSE 'subjects' END AS "table", event_id AS rows_inserted, value AS duration_sec,
   ts AS start_time, ts + INTERVAL 1 HOUR AS end_time FROM events)"""


def load_log(spark, sf):
    e = table(spark, sf, "events")
    names = {"click": "signals", "view": "annotations_apnea", "purchase": "annotations_qrs", "signup": "compression", "error": "subjects"}
    mapping = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    return e.select(
        F.col("event_id").alias("seq"), F.try_element_at(mapping, F.col("event_type")).alias("table"),
        F.col("event_id").alias("rows_inserted"), F.col("value").alias("duration_sec"), F.col("ts").alias("start_time"),
        (F.col("ts") + F.expr("interval 1 hour")).alias("end_time"),
    )


@query(
    "ag22_ingest_throughput",
    f"""WITH {LOG} SELECT coalesce("table", 'total') AS "table", CAST(sum(rows_inserted) AS BIGINT) AS rows_inserted,
       round(sum(duration_sec), 4) AS duration_sec, round(sum(rows_inserted) / sum(duration_sec), 4) AS rows_per_sec FROM lg
       WHERE "table" IN ('signals', 'annotations_apnea', 'annotations_qrs') GROUP BY ROLLUP ("table")""",
)
def ingest_throughput(spark, sf):
    return rounded(bl.ingest_throughput(load_log(spark, sf)), "duration_sec", "rows_per_sec", digits=4)


@query(
    "ag22_compression_entry",
    f"""WITH {LOG} SELECT "table", CAST(sum(rows_inserted) AS BIGINT) AS rows_inserted, round(sum(duration_sec), 4) AS duration_sec
       FROM lg WHERE "table" = 'compression' GROUP BY 1""",
)
def compression_entry(spark, sf):
    return rounded(bl.compression_entry(load_log(spark, sf)), "duration_sec", digits=4)


@query(
    "ag23_merge_load_logs",
    f"""WITH {LOG} SELECT "table", CAST(sum(rows_inserted) AS BIGINT) AS rows_inserted, round(sum(duration_sec), 4) AS duration_sec,
       min(seq) AS first_seen FROM lg GROUP BY 1 ORDER BY first_seen""",
)
def merge_load_logs(spark, sf):
    return rounded(bl.merge_load_logs(load_log(spark, sf)), "duration_sec", digits=4)


@query("ag23_load_span", f"WITH {LOG} SELECT arg_min(start_time, seq) AS start_time, arg_max(end_time, seq) AS end_time FROM lg")
def load_span(spark, sf):
    return bl.load_span(load_log(spark, sf))


def timings(spark, sf):
    return table(spark, sf, "events").select(
        F.col("event_type").alias("test_name"), F.col("user_id").alias("record_id"), F.col("value").alias("ms"), "ts"
    )


TIMES = "tm AS (SELECT event_type AS test_name, user_id AS record_id, value AS ms, ts FROM events)"


@query(
    "ag24_timing_stats",
    f"""WITH {TIMES} SELECT test_name, record_id, count(*) AS iterations, min(ms) AS min_ms, max(ms) AS max_ms, round(avg(ms), 6) AS avg_ms,
       round(stddev_pop(ms), 6) AS stdev_ms, round(sum(ms), 6) AS total_ms FROM tm GROUP BY 1, 2""",
)
def timing_stats(spark, sf):
    return rounded(bl.timing_stats(timings(spark, sf)), "avg_ms", "stdev_ms", "total_ms")


LATENCY = """lt AS (SELECT test_name, part, avg(m) AS avg_ms FROM (SELECT test_name, part, record_id, avg(ms) AS m FROM tp GROUP BY 1, 2, 3) GROUP BY 1, 2),
  pc AS (SELECT test_name, part, list(ms ORDER BY ms)[CAST(greatest(floor(count(*) * 0.95::DOUBLE) - 1, 0) AS BIGINT) + 1] AS p95_ms FROM tp GROUP BY 1, 2),
  ls AS (SELECT * FROM lt JOIN pc USING (test_name, part))"""


@query(
    "ag25_latency_summary",
    f"WITH {TIMES}, tp AS (SELECT *, 0 AS part FROM tm), {LATENCY} SELECT test_name, round(avg_ms, 6) AS avg_ms, p95_ms FROM ls",
)
def latency_summary(spark, sf):
    return rounded(bl.latency_summary(timings(spark, sf)), "avg_ms")


@query(
    "jn08_compare_runs",
    f"""WITH {TIMES}, tp AS (SELECT CASE WHEN test_name = 'view' AND ts < TIMESTAMP '2024-01-16' THEN 'old view' WHEN test_name = 'click' AND ts >= TIMESTAMP '2024-01-16'
           THEN 'new click' ELSE test_name END AS test_name, record_id, ms, CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 0 ELSE 1 END AS part FROM tm), {LATENCY}
       SELECT test_name, round(a.avg_ms, 6) AS first_avg_ms, a.p95_ms AS first_p95_ms, round(b.avg_ms, 6) AS second_avg_ms, b.p95_ms AS second_p95_ms
       FROM (SELECT * FROM ls WHERE part = 0) a FULL JOIN (SELECT * FROM ls WHERE part = 1) b USING (test_name)""",
)
def compare_runs(spark, sf):
    """Two runs over all timings; a test that was renamed between them has no partner."""
    t, name = timings(spark, sf), F.col("test_name")
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    first = bl.latency_summary(t.where(early).withColumn("test_name", F.when(name == "view", "old view").otherwise(name)))
    second = bl.latency_summary(t.where(~early).withColumn("test_name", F.when(name == "click", "new click").otherwise(name)))
    both = jn.compare_runs(first, second, "test_name", ("first", "second"), ["avg_ms", "p95_ms"])
    return rounded(both, "first_avg_ms", "second_avg_ms")


# ---------------------------------------------------------------- run tables

RUNS = """p AS (SELECT *, split_part(recording_id, '|', 2) AS variant FROM pred), cc AS (SELECT variant,
    count(*) FILTER (y_true = 0 AND y_pred = 0) AS tn, count(*) FILTER (y_true = 0 AND y_pred = 1) AS fp,
    count(*) FILTER (y_true = 1 AND y_pred = 0) AS fn, count(*) FILTER (y_true = 1 AND y_pred = 1) AS tp,
    avg(CASE WHEN y_true = 1 THEN score END) / (avg(CASE WHEN y_true = 0 THEN score END) + 1e-12) AS loss_ratio,
    avg(score) / 4000 AS reconstruction_corr, min(score) / 100 AS best_val_loss, avg(score) AS test_mae_x1e3 FROM p GROUP BY 1),
  rn AS (SELECT variant, 'mode_' || variant AS loss_mode, CASE WHEN 2*tp+fp+fn > 0 THEN 200.0::DOUBLE * tp / (2*tp+fp+fn) ELSE 0 END AS f1_pct,
    100.0::DOUBLE * tn / greatest(1, tn+fp) AS specificity_pct, 100.0::DOUBLE * (tp+tn) / (tp+tn+fp+fn) AS individual_acc_pct,
    loss_ratio, reconstruction_corr, reconstruction_corr < 0.25 AS collapsed, best_val_loss, test_mae_x1e3 FROM cc),
  rs AS (SELECT *, 0.5 * individual_acc_pct / 100 + 0.2 * specificity_pct / 100 + 0.15 * f1_pct / 100
    + 0.1 * coalesce(greatest(0, least(loss_ratio / 1.5, 1)), 0) + 0.05 * coalesce(greatest(0, least(reconstruction_corr / 0.8, 1)), 0)
      AS balanced_selection_score, NOT collapsed AND reconstruction_corr >= 0.5 AND coalesce(loss_ratio, -1) >= 1.3 AS passes_minimum_diagnostics FROM rn)"""
_RUN_NUM = ("f1_pct", "specificity_pct", "individual_acc_pct", "loss_ratio", "reconstruction_corr", "best_val_loss", "test_mae_x1e3")


def runs(spark, sf):
    """One run per language of the predictions: metrics, loss ratio and a stand-in correlation."""
    p = feeds.predictions(spark, sf).withColumn("variant", F.split("recording_id", r"\|").getItem(1))
    m = me.binary_metrics(p, ["variant"]).withColumnRenamed("accuracy_pct", "individual_acc_pct")
    y, s = F.col("y_true"), F.col("score")
    d = p.groupBy("variant").agg(
        (F.avg(F.when(y == 1, s)) / (F.avg(F.when(y == 0, s)) + 1e-12)).alias("loss_ratio"),
        (F.avg(s) / 4000).alias("reconstruction_corr"), (F.min(s) / 100).alias("best_val_loss"), F.avg(s).alias("test_mae_x1e3"),
    )
    joined = m.join(d, "variant").withColumn("collapsed", F.col("reconstruction_corr") < 0.25)
    return me.run_summary(joined.withColumn("loss_mode", F.concat(F.lit("mode_"), "variant")))


_RUN_OUT = ", ".join(f"round({c}, 6) AS {c}" for c in (*_RUN_NUM, "balanced_selection_score"))


@query("ml08_run_summary", f"WITH {PRED}, {RUNS} SELECT variant, loss_mode, {_RUN_OUT}, collapsed, passes_minimum_diagnostics FROM rs")
def run_summary(spark, sf):
    out = rounded(runs(spark, sf), *_RUN_NUM, "balanced_selection_score")
    return out.select("variant", "loss_mode", *_RUN_NUM, "balanced_selection_score", "collapsed", "passes_minimum_diagnostics")


@query(
    "ml09_ablation_table",
    f"""WITH {PRED}, {RUNS} SELECT variant, round(best_val_loss, 6) AS best_val_loss, round(test_mae_x1e3, 6) AS test_mae_x1e3,
       round(f1_pct, 6) AS f1_pct, round(individual_acc_pct, 6) AS individual_acc_pct FROM rs""",
)
def ablation_table(spark, sf):
    return rounded(me.ablation_table(runs(spark, sf)), "best_val_loss", "test_mae_x1e3", "f1_pct", "individual_acc_pct")


@query(
    "ml09_select_final",
    f"""WITH {PRED}, {RUNS} (SELECT 'fixed' AS how, variant, round(balanced_selection_score, 6) AS score FROM rs
       ORDER BY loss_mode = 'mode_en' DESC, balanced_selection_score DESC, variant LIMIT 1)
       UNION ALL (SELECT 'best', variant, round(balanced_selection_score, 6) FROM rs ORDER BY balanced_selection_score DESC, variant LIMIT 1)""",
)
def select_final(spark, sf):
    r = runs(spark, sf)
    pick = lambda how, mode: me.select_final(r, mode).select(
        F.lit(how).alias("how"), "variant", r6("balanced_selection_score").alias("score")
    )
    return pick("fixed", "mode_en").unionByName(pick("best", None))

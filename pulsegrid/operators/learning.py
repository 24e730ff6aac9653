"""Reconstruction, clustering and supervised baselines on Spark."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, Imputer, StandardScaler, VectorAssembler, VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.functions import arrays as ar
from pulsegrid.functions.batches import sequences
from pulsegrid.operators import metrics as me
from pulsegrid.operators.reshape import head
from pulsegrid.operators.tensors import sequence_features
from pulsegrid.session import materialise, stored


def batch_predict(df: DataFrame, fn: Callable[[np.ndarray], np.ndarray], x: str = "x", out: str = "x_hat") -> DataFrame:
    """Apply a reconstruction function to Arrow batches of windows.

    ``fn`` takes and returns an array (windows, steps, channels); the tensor column is
    channel-major.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(T.ArrayType(T.DoubleType())))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch) == 0:
                continue
            cube = np.stack([np.stack([np.asarray(c, dtype="float64") for c in t]) for t in batch[x]])
            made = np.asarray(fn(cube.transpose(0, 2, 1)), dtype="float64").transpose(0, 2, 1)
            if made.shape != cube.shape:
                raise ValueError(f"reconstruction has shape {made.shape}, expected {cube.shape}")
            yield batch.assign(**{out: [[list(c) for c in w] for w in made]})

    return df.mapInPandas(run, schema)


def pca_reconstruct(df: DataFrame, fit_rows: Column, k: int = 16, x: str = "x", out: str = "x_hat") -> DataFrame:
    """Reconstruct windows from k principal components fitted on the given rows.

    The components (features x k numbers) come to the driver and go back as literals of the
    plan; windows stay distributed.
    """
    flat = df.withColumn("_v", array_to_vector(F.flatten(F.col(x))))
    fit = flat.where(fit_rows)
    model = PCA(k=k, inputCol="_v", outputCol="_p").fit(fit)
    centre = fit.select(F.posexplode(F.flatten(F.col(x))).alias("pos", "v")).groupBy("pos").agg(F.avg("v").alias("m"))
    mean = np.array([r["m"] for r in centre.orderBy("pos").collect()])
    parts = model.pc.toArray()
    projector = parts @ parts.T

    def rebuild(cube: np.ndarray) -> np.ndarray:
        n, steps, channels = cube.shape
        rows = cube.transpose(0, 2, 1).reshape(n, channels * steps)
        made = (rows - mean) @ projector + mean
        return made.reshape(n, channels, steps).transpose(0, 2, 1)

    return batch_predict(df, rebuild, x, out)


def mean_reconstruct(df: DataFrame, fit_rows: Column, x: str = "x", out: str = "x_hat") -> DataFrame:
    """Every window replaced by the mean of the fit rows (no component at all)."""
    centre = df.where(fit_rows).select(F.posexplode(F.flatten(F.col(x))).alias("pos", "v")).groupBy("pos").agg(F.avg("v").alias("m"))
    mean = np.array([r["m"] for r in centre.orderBy("pos").collect()])

    def rebuild(cube: np.ndarray) -> np.ndarray:
        n, steps, channels = cube.shape
        return np.broadcast_to(mean.reshape(channels, steps).T, (n, steps, channels))

    return batch_predict(df, rebuild, x, out)


def feature_kmeans(
    df: DataFrame, train: Column, x: str = "x", y: str = "y", top: int = 40, trees: int = 100, seed: int = 42, keys: Sequence[str] = ("window_id", "recording_id")
) -> DataFrame:
    """Cluster windows on the most important features; the cluster richer in events is anomalous.

    Median imputing, scaling, importances and clusters are all fitted on the training rows.
    """
    tagged = df.select(*keys, y, train.alias("_train"), x)
    featured = sequence_features(tagged, [*keys, y, "_train"], x, "_f").select(
        *keys, y, "_train", F.flatten("_f").alias("_features")
    )
    featured = materialise(featured)
    width = len(featured.select("_features").first()["_features"])
    names = [f"f{i}" for i in range(width)]
    wide = featured.select(*keys, y, "_train", *[F.get("_features", F.lit(i)).alias(n) for i, n in enumerate(names)])
    fit_rows = wide.where("_train")
    imputer = Imputer(strategy="median", inputCols=names, outputCols=names).fit(fit_rows)
    vectors = VectorAssembler(inputCols=names, outputCol="_raw").transform(imputer.transform(wide))
    scaler = StandardScaler(withMean=True, withStd=True, inputCol="_raw", outputCol="_scaled").fit(vectors.where("_train"))
    scaled = scaler.transform(vectors).select(*keys, y, "_train", "_scaled")
    weights = me.balanced_class_weights(scaled.where("_train"), y)
    weighted = me.with_class_weights(scaled.where("_train"), weights, y, "_w")
    forest = RandomForestClassifier(
        featuresCol="_scaled", labelCol=y, weightCol="_w", numTrees=trees, seed=seed
    ).fit(weighted)
    importance = forest.featureImportances.toArray()
    chosen = sorted(np.argsort(-importance, kind="stable")[: max(1, min(top, width))].tolist())
    sliced = VectorSlicer(inputCol="_scaled", outputCol="_top", indices=chosen).transform(scaled)
    kmeans = KMeans(k=2, seed=seed, featuresCol="_top", predictionCol="cluster").fit(sliced.where("_train"))
    clustered = kmeans.transform(sliced)
    rates = me.cluster_rates(clustered.where("_train"), (0, 1), "cluster", y)
    anomalous = rates.where("anomalous").first()["cluster"]
    centres = kmeans.clusterCenters()

    def distance(c: int) -> Column:
        point = F.array(*[F.lit(float(v)) for v in centres[c]])
        return F.sqrt(ar.total(F.zip_with(vector_to_array("_top"), point, lambda a, b: (a - b) * (a - b))))

    return clustered.select(
        *keys, y, "_train", "cluster", (F.col("cluster") == anomalous).cast("int").alias("y_pred"),
        (distance(1 - anomalous) - distance(anomalous)).alias("score"),
    ).withColumnRenamed("_train", "is_train")


def supervised_baseline(
    df: DataFrame, train: Column, val: Column, x: str = "x", y: str = "y", keys: Sequence[str] = ("window_id", "recording_id"), **sweep
) -> tuple[DataFrame, float]:
    """Class-weighted classifier; the threshold is chosen on the validation rows only."""
    rows = df.select(*keys, y, train.alias("is_train"), val.alias("is_val"), F.flatten(F.col(x)).alias("_a"))
    weights = me.balanced_class_weights(rows.where("is_train"), y)
    fit = me.with_class_weights(rows.where("is_train"), weights, y, "_w").withColumn("_v", array_to_vector("_a"))
    model = LogisticRegression(featuresCol="_v", labelCol=y, weightCol="_w", regParam=0.01, maxIter=50).fit(fit)
    # scored from the coefficients: a fitted model that keeps its summary cannot be sent to
    # tasks in a session that has observed a write
    line = ar.dot(F.col("_a"), F.array(*[F.lit(float(c)) for c in model.coefficients])) + float(model.intercept)
    scored = rows.select(*keys, y, "is_train", "is_val", (1.0 / (1.0 + F.exp(-line))).alias("score"))
    table = me.balanced_threshold_sweep(scored.where("is_val"), y, "score", **sweep)
    tau = me.best_balanced_threshold(table).first()["threshold"]
    return me.flag_scores(scored, tau, "score", inclusive=True), tau


def dtw_distance(a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
    """Dynamic time warping distance of each row of ``a`` to the sequence ``b``.

    Two rows of the table are kept, with the windows of a batch along the last axis: memory is
    2 x (steps + 1) numbers for each window. ``limit`` gives a squared distance for each window: one
    whose whole table row is over it is abandoned (its distance is infinite).
    """
    n, m = a.shape[1], len(b)
    steps = np.ascontiguousarray(a.T)
    above = np.full((m + 1, len(a)), np.inf)
    above[0] = 0.0
    row = np.empty_like(above)
    alive = None if limit is None else np.arange(len(a))
    for i in range(n):
        row[0] = np.inf
        for j in range(m):
            np.minimum(above[j + 1], above[j], out=row[j + 1])
            np.minimum(row[j + 1], row[j], out=row[j + 1])
            row[j + 1] += (steps[i] - b[j]) ** 2
        above, row = row, above
        if alive is not None and i % 8 == 7:
            keep = above[1:].min(axis=0) <= limit[alive]
            if not keep.all():
                alive, steps, above = alive[keep], steps[:, keep], np.ascontiguousarray(above[:, keep])
                row = np.empty_like(above)
    if alive is None:
        return np.sqrt(above[m])
    out = np.full(len(a), np.inf)
    out[alive] = np.sqrt(above[m])
    return out


def dtw_lower_bound(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distance that the warping distance of each row of ``a`` to ``b`` cannot be under.

    Every step has a partner inside the envelope [min b, max b]; first and last steps are partners of each other.
    """
    outside = np.maximum(a - b.max(), 0) + np.maximum(b.min() - a, 0)
    squares = outside**2
    ends = (a[:, 0] - b[0]) ** 2
    if a.shape[1] > 1 or len(b) > 1:
        ends = ends + (a[:, -1] - b[-1]) ** 2
    inner = squares[:, 1:-1].sum(axis=1) if a.shape[1] > 2 else 0.0
    return np.maximum(squares.sum(axis=1), ends + inner)


def nearest_centre(a: np.ndarray, centres: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centre (the first of equals) and its distance for each row, and how many pairs were left out.

    Centres are tried in the order of their lower bounds; a pair is left out if the bound is over the best distance so far, and given
    up early if its table is.
    """
    bounds = np.stack([dtw_lower_bound(a, c) for c in centres], axis=1)
    order = np.argsort(bounds, axis=1, kind="stable")
    best = np.full(len(a), np.inf)
    at = np.zeros(len(a), dtype=np.int64)
    skipped = 0
    for turn in range(len(centres)):
        for c in range(len(centres)):
            rows = np.flatnonzero(order[:, turn] == c)
            open_rows = rows[bounds[rows, c] <= best[rows] ** 2 * (1 + 1e-12)]
            skipped += len(rows) - len(open_rows)
            if not len(open_rows):
                continue
            found = dtw_distance(a[open_rows], centres[c], best[open_rows] ** 2 * (1 + 1e-12))
            better = (found < best[open_rows]) | ((found == best[open_rows]) & (c < at[open_rows]))
            best[open_rows[better]], at[open_rows[better]] = found[better], c
    return at, best, skipped


def dtw_alignment(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sum and number of the steps of all rows aligned with each step of ``b``, and each row's squared distance.

    The whole table is kept, so callers pass a bounded number of rows; diagonal steps are taken first where several are best.
    """
    n, s, m = len(a), a.shape[1], len(b)
    table = np.full((s + 1, m + 1, n), np.inf)
    table[0, 0] = 0.0
    for i in range(1, s + 1):
        for j in range(1, m + 1):
            before = np.minimum(np.minimum(table[i - 1, j - 1], table[i - 1, j]), table[i, j - 1])
            table[i, j] = before + (a[:, i - 1] - b[j - 1]) ** 2
    sums, counts = np.zeros(m), np.zeros(m, dtype=np.int64)
    rows = np.arange(n)
    i, j = np.full(n, s), np.full(n, m)
    while len(rows):
        np.add.at(sums, j - 1, a[rows, i - 1])
        np.add.at(counts, j - 1, 1)
        options = np.stack([table[i - 1, j - 1, rows], table[i - 1, j, rows], table[i, j - 1, rows]])
        step = options.argmin(axis=0)
        i, j = i - (step != 2), j - (step != 1)
        going = (i > 0) & (j > 0)
        rows, i, j = rows[going], i[going], j[going]
    return sums, counts, table[s, m]


def nearest_by_dtw(df: DataFrame, centres: Sequence[Sequence[float]], sequence: str = "sequence") -> DataFrame:
    """Add the nearest centre by DTW and its distance; centres are a few short sequences."""
    fixed = [np.asarray(c, dtype="float64") for c in centres]

    @F.arrow_udf("struct<cluster: int, distance: double>")
    def nearest(s: pa.Array) -> pa.Array:
        at, distance = np.empty(0), np.empty(0)
        if len(s):
            at, distance, _ = nearest_centre(sequences(s), fixed)
        return pa.StructArray.from_arrays([pa.array(at.astype("int32")), pa.array(distance, from_pandas=True)], names=["cluster", "distance"])

    return df.withColumn("_n", nearest(F.col(sequence))).select("*", "_n.cluster", "_n.distance").drop("_n")


#: Windows whose warping tables are held at once.
_TABLES = 64


def dtw_round(df: DataFrame, centres: Sequence[Sequence[float]], sequence: str = "sequence") -> tuple[list[list[float]], float, float]:
    """One round of barycentre averaging: new centres, inertia of the old ones, share of pairs left out by bounds.

    A task adds up its own windows (steps x centres numbers), so nothing else is moved. A centre without windows stays as it is.
    """
    fixed = [np.asarray(c, dtype="float64") for c in centres]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(len(c)) for c in fixed]
        counts = [np.zeros(len(c), dtype=np.int64) for c in fixed]
        inertia, skipped, pairs = 0.0, 0, 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            rows = sequences(batch.column(sequence))
            at, _, left_out = nearest_centre(rows, fixed)
            skipped, pairs = skipped + left_out, pairs + len(rows) * len(fixed)
            for c in range(len(fixed)):
                mine = rows[at == c]
                for low in range(0, len(mine), _TABLES):
                    total, number, squared = dtw_alignment(mine[low : low + _TABLES], fixed[c])
                    sums[c] += total
                    counts[c] += number
                    inertia += float(squared.sum())
        cells = [(c, t, float(sums[c][t]), int(counts[c][t]), 0.0) for c in range(len(fixed)) for t in range(len(fixed[c]))]
        columns = zip(*cells, (-1, 0, float(skipped), pairs, inertia), strict=True)
        kinds = (pa.int32(), pa.int32(), pa.float64(), pa.int64(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["cluster", "t", "total", "n", "inertia"])

    made = df.select(sequence).mapInArrow(run, "cluster int, t int, total double, n long, inertia double")
    found = made.groupBy("cluster", "t").agg(F.sum("total").alias("total"), F.sum("n").alias("n"), F.sum("inertia").alias("inertia"))
    fresh, inertia, skipped = [list(map(float, c)) for c in fixed], 0.0, 0.0
    for r in found.collect():
        if r["cluster"] < 0:
            inertia, skipped = r["inertia"], r["total"] / max(1, r["n"])
        elif r["n"]:
            fresh[r["cluster"]][r["t"]] = r["total"] / r["n"]
    return fresh, inertia, skipped


def fit_dtw_centres(df: DataFrame, centres: Sequence[Sequence[float]], rounds: int = 10, sequence: str = "sequence") -> tuple[list[list[float]], list[float], list[float]]:
    """Centres after barycentre averaging, the inertia before every round and the share of pairs that bounds left out.

    Inertia never rises: windows go to their nearest centre, and the mean of what is aligned with a step is the best value of this step
    for that alignment.
    """
    current, inertias, shares = [list(map(float, c)) for c in centres], [], []
    for _ in range(rounds):
        fresh, inertia, share = dtw_round(df, current, sequence)
        inertias.append(inertia)
        shares.append(share)
        if np.allclose(np.concatenate(fresh), np.concatenate(current), atol=1e-9):
            break
        current = fresh
    return current, inertias, shares


def dtw_cluster(
    df: DataFrame, train: Column, order: Sequence[str], x: str = "x", y: str = "y", fit_limit: int | None = None, rounds: int = 10,
    keys: Sequence[str] = ("window_id", "recording_id"),
) -> DataFrame:
    """Two DTW clusters of channel 0: centres from the training windows, all windows assigned.

    Centres begin as two windows far from each other and are refined by barycentre averaging over all training
    windows; ``fit_limit`` takes only the first ones in order.
    """
    rows = stored(
        df.select(*keys, y, train.alias("is_train"), *[c for c in order if c not in keys], F.element_at(x, 1).alias("sequence")), "dtw-rows"
    )
    fit_rows = rows.where("is_train")
    sample = fit_rows if fit_limit is None else stored(head(fit_rows, fit_limit, list(order)), "dtw-fit")
    centre = sample.select(F.posexplode("sequence").alias("t", "v")).groupBy("t").agg(F.avg("v").alias("m"))
    mean = [r["m"] for r in centre.orderBy("t").collect()]
    if not mean:
        raise ValueError("no training windows to fit clusters on")
    distant = nearest_by_dtw(sample, [mean]).orderBy(F.col("distance").desc(), *order).first()
    far = nearest_by_dtw(sample, [list(distant["sequence"])]).orderBy(F.col("distance").desc(), *order).first()
    centres, _, _ = fit_dtw_centres(sample, [list(distant["sequence"]), list(far["sequence"])], rounds)
    rates = me.cluster_rates(nearest_by_dtw(sample, centres), (0, 1), "cluster", y)
    anomalous = rates.where("anomalous").first()["cluster"]
    out = nearest_by_dtw(rows, centres)
    hit = (F.col("cluster") == anomalous).cast("int")
    return out.select(*keys, y, "is_train", "cluster", "distance", hit.alias("y_pred"), hit.cast("double").alias("score"))


def noise_robustness(
    df: DataFrame, fit_rows: Column, reconstruct: Callable[[DataFrame], DataFrame], levels: Sequence[float] = (0.0, 0.01, 0.03, 0.1),
    window: str = "window_id", x: str = "x", y: str = "y", percent: float = 85.0, seed: int = 42, judged: Column | None = None,
) -> DataFrame:
    """Metrics of the detector under noise of several levels; the threshold is that of clean input.

    ``judged`` names the rows that are measured (default: all). The level list is unrolled inside the row, so the windows are read once.
    """
    clean = reconstruct(df.where(fit_rows)).select(ar.weighted_mse(F.col(x), F.col("x_hat")).alias("loss"))
    tau = me.percentile_threshold(clean, percent, "loss").first()["tau"]
    tensor = F.col(x)
    variants = F.array(*[
        F.struct(
            F.lit(float(level)).alias("level"),
            (tensor if level == 0 else ar.add_noise(tensor, F.col(window), level, 1.0, seed)).alias("noisy"),
        )
        for level in levels
    ])
    noisy = (df if judged is None else df.where(judged)).select(window, y, F.inline(variants)).withColumnRenamed("noisy", x)
    scored = reconstruct(noisy).select("level", y, ar.weighted_mse(F.col(x), F.col("x_hat")).alias("loss"))
    return me.binary_metrics(me.flag_scores(scored, tau, "loss"), ["level"], y)

"""Results of the fitted models against plain versions on small fixtures."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_scores import two_kinds  # noqa: F401 - fixture

from pulsegrid.catalog import load_all
from pulsegrid.functions import arrays as ar
from pulsegrid.operators import learning as le

SF = "/root/testdata/sf0.001"


def slow_dtw(u, v):
    """Squared distance and the cost table."""
    acc = np.full((len(u) + 1, len(v) + 1), np.inf)
    acc[0, 0] = 0.0
    for i in range(1, len(u) + 1):
        for j in range(1, len(v) + 1):
            acc[i, j] = (u[i - 1] - v[j - 1]) ** 2 + min(acc[i - 1, j - 1], acc[i - 1, j], acc[i, j - 1])
    return acc


def sequences(n, steps, seed=0):
    rng = np.random.default_rng(seed)
    t = np.arange(steps)
    kind = np.arange(n) % 2
    return np.stack([np.sin((0.5 + k) * (t + rng.uniform(-1, 1))) * (1 + k) + rng.normal(0, 0.1, steps) for k in kind]), kind


@pytest.mark.parametrize("steps,other", [(1, 1), (2, 5), (12, 12), (20, 9)])
def test_bounds_pruning_and_early_abandoning_change_nothing(steps, other):
    a, _ = sequences(60, steps, steps)
    centres = list(sequences(5, other, 77)[0]) + [np.full(other, 3.0)]
    true = np.array([[slow_dtw(u, c)[-1, -1] for c in centres] for u in a])
    bounds = np.stack([le.dtw_lower_bound(a, c) for c in centres], axis=1)
    assert (bounds <= true + 1e-9).all()
    at, distance, skipped = le.nearest_centre(a, centres)
    assert np.allclose(distance**2, true.min(axis=1)) and (at == true.argmin(axis=1)).all()
    assert 0 <= skipped <= true.size - len(a)
    limit = true[:, 0] * 0.9
    assert np.isinf(le.dtw_distance(a, centres[0], limit)[limit > 0]).sum() == 0 or np.allclose(
        [d for d in le.dtw_distance(a, centres[0], limit) if np.isfinite(d)], [t for d, t in zip(le.dtw_distance(a, centres[0], limit), np.sqrt(true[:, 0])) if np.isfinite(d)]
    )
    assert np.allclose(le.dtw_distance(a, centres[0], true[:, 0] + 1e-9), np.sqrt(true[:, 0]))
    assert le.nearest_centre(a, [centres[0], centres[0]])[0].max() == 0  # the first of equals


def plain_sums(a, b):
    sums, counts = np.zeros(len(b)), np.zeros(len(b), int)
    for u in a:
        acc = slow_dtw(u, b)
        i, j = len(u), len(b)
        while i and j:
            sums[j - 1] += u[i - 1]
            counts[j - 1] += 1
            step = int(np.argmin([acc[i - 1, j - 1], acc[i - 1, j], acc[i, j - 1]]))
            i, j = i - (step != 2), j - (step != 1)
    return sums, counts


def test_alignment_sums():
    a, _ = sequences(25, 10)
    b = sequences(1, 7, 5)[0][0]
    sums, counts, squared = le.dtw_alignment(a, b)
    want = plain_sums(a, b)
    assert np.allclose(sums, want[0]) and (counts == want[1]).all()
    assert np.allclose(squared, [slow_dtw(u, b)[-1, -1] for u in a])


def test_barycentre_rounds_equal_a_plain_version_and_inertia_never_rises(spark):
    a, kind = sequences(40, 12, 3)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(a)], "i int, sequence array<double>").repartition(5)
    start = [a[0].tolist(), a[1].tolist()]
    centres, inertias, shares = le.fit_dtw_centres(df, start, rounds=6)
    assert len(inertias) > 1 and all(x >= y - 1e-9 for x, y in zip(inertias, inertias[1:]))
    assert all(0 <= s < 0.5 for s in shares)
    plain, wanted = [np.array(c) for c in start], []
    for _ in range(len(inertias)):
        true = np.array([[slow_dtw(u, c)[-1, -1] for c in plain] for u in a])
        at = true.argmin(axis=1)
        wanted.append(true.min(axis=1).sum())
        plain = [np.divide(*plain_sums(a[at == c], plain[c])) if (at == c).any() else plain[c] for c in range(2)]
    assert np.allclose(inertias, wanted)
    final = np.array([[slow_dtw(u, c)[-1, -1] for c in centres] for u in a]).argmin(axis=1)
    got = {r["i"]: r["cluster"] for r in le.nearest_by_dtw(df, centres).collect()}
    assert [got[i] for i in range(40)] == final.tolist() and len(set(zip(kind.tolist(), final.tolist()))) == 2


def test_pca_losses_equal_numpy(spark, two_kinds):  # noqa: F811
    rows = two_kinds.orderBy("window_id").collect()
    flat = np.array([np.concatenate(r["x"]) for r in rows])
    fit = flat[[r["y"] == 0 for r in rows]]
    mean = fit.mean(axis=0)
    parts = np.linalg.svd(fit - mean, full_matrices=False)[2][:3]
    made = (flat - mean) @ parts.T @ parts + mean
    shape = np.array(rows[0]["x"]).shape
    weights = np.array([w.item() if hasattr(w, "item") else w for w in __import__("pulsegrid.schema", fromlist=["x"]).FEATURE_WEIGHTS])
    want = ((flat - made) ** 2).reshape(len(rows), *shape).mean(axis=2) @ weights[: shape[0]]
    got = le.pca_reconstruct(two_kinds, F.col("y") == 0, 3).select("window_id", ar.weighted_mse(F.col("x"), F.col("x_hat")).alias("loss")).orderBy("window_id").collect()
    assert np.allclose([r["loss"] for r in got], want, rtol=1e-6, atol=1e-9)


def test_flags_follow_from_scores(two_kinds):  # noqa: F811
    train = F.col("window_id") < 50
    scored, tau = le.supervised_baseline(two_kinds, train, (F.col("window_id") >= 50) & (F.col("window_id") < 65))
    for r in scored.collect():
        assert r["y_pred"] == int(r["score"] >= tau) == r["y"]
    for r in le.feature_kmeans(two_kinds, train, trees=10).collect():
        assert r["y_pred"] == int(r["score"] > 0) == r["y"]


@pytest.mark.parametrize("name", ["ml03_window_losses", "ml03_detector_metrics", "ml04_window_clusters", "ml05_window_predictions", "ml06_window_clusters", "snk09_storage_bytes"])
def test_result_queries_cover_their_rows(spark, name):
    queries, sql = load_all()
    rows = queries[name](spark, SF).collect()
    assert name not in sql and rows
    if name.endswith(("losses", "clusters", "predictions")):
        ids = [r["window_id"] for r in rows]
        assert len(ids) == len(set(ids)) == spark.read.parquet(f"{SF}/embeddings.parquet").count()
    if name == "snk09_storage_bytes":
        total = [r for r in rows if r["table"] == "total"][0]
        parts = [r for r in rows if r["table"] != "total"]
        assert total["bytes_before"] == sum(r["bytes_before"] for r in parts) and total["ratio"] == pytest.approx(total["bytes_before"] / total["bytes_after"])


@pytest.fixture
def one_batch():
    """10,000 windows, and the most memory that Python and numpy take for a call on them."""
    import tracemalloc

    def most(call):
        tracemalloc.start()
        try:
            made = call()
            return made, tracemalloc.get_traced_memory()[1] / 2**20
        finally:
            tracemalloc.stop()

    return np.random.default_rng(0).normal(size=(10_000, 7, 16)), most


def handed_over(monkeypatch, made):
    """The function that a map over Arrow batches is given; ``made`` stands for its result."""
    found = []
    monkeypatch.setattr(type(made), "mapInArrow", lambda self, fn, schema: found.append(fn) or made)
    return found


def test_a_barycentre_round_takes_no_object_for_each_window(spark, monkeypatch, one_batch):
    """One round over 10,000 sequences of 16 steps (1.2 MB) takes a few times their bytes."""
    cube, most = one_batch
    df = spark.createDataFrame([(0, [0.0])], "window_id long, sequence array<double>")
    found = handed_over(monkeypatch, spark.createDataFrame([], "cluster int, t int, total double, n long, inertia double"))
    centres = [cube[0, 0].tolist(), cube[1, 0].tolist()]
    le.dtw_round(df, centres)
    import pyarrow as pa

    flat = pa.ListArray.from_arrays(np.arange(0, 160_001, 16, dtype="int32"), np.ascontiguousarray(cube[:, 0]).reshape(-1))
    made, peak = most(lambda: list(found[0](iter([pa.RecordBatch.from_arrays([flat], names=["sequence"])]))))
    at, _, _ = le.nearest_centre(cube[:, 0], [np.array(c) for c in centres])
    assert made[0].num_rows == 33 and sum(made[0].column("n").to_pylist()[:16]) >= 16 * int((at == 0).sum())
    assert peak < 20


def test_tensors_through_arrow_keep_numbers_and_refuse_other_shapes():
    import pyarrow as pa

    from pulsegrid.functions import batches

    cube = np.arange(24.0).reshape(2, 3, 4)
    cube[0, 1, 2] = np.nan
    column = batches.tensor_lists(cube)
    assert column.to_pylist()[0][1] == [4.0, 5.0, None, 7.0]
    assert np.array_equal(batches.sequences(column.flatten()), cube.reshape(6, 4), equal_nan=True)
    assert np.array_equal(batches.sequences(column.slice(1).flatten()), cube[1])
    for bad in ([[1.0], [1.0, 2.0]], [[1.0], None]):
        with pytest.raises(ValueError, match="one length"):
            batches.sequences(pa.array(bad, pa.list_(pa.float64())))


def test_sequence_features_take_no_object_for_each_window(spark, monkeypatch, one_batch):
    """The features of 10,000 tensors of 7 x 16 numbers (9 MB in, 9 MB out) take few times the bytes of a part of them."""
    import pyarrow as pa

    from pulsegrid.functions import batches
    from pulsegrid.operators import tensors as te

    cube, most = one_batch
    df = spark.createDataFrame([(0, [[0.0]])], "window_id long, x array<array<double>>")
    found = handed_over(monkeypatch, df)
    te.sequence_features(df, ["window_id"])
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(10_000)), batches.tensor_lists(cube)], names=["window_id", "x"])
    made, peak = most(lambda: list(found[0](iter([batch.slice(0, 0), batch]))))
    assert np.concatenate([b.column("window_id") for b in made]).tolist() == list(range(10_000))
    assert np.array_equal(np.concatenate([batches.tensors(b.column("features")) for b in made]), batches.sequence_features(cube))
    assert peak < 20


def test_sequence_features_of_many_parts_keep_keys_and_numbers(spark):
    """Several Arrow batches and parts of one task; keys travel along, null keys too, and other shapes raise."""
    from pulsegrid.functions import batches
    from pulsegrid.operators import tensors as te

    n = 12_500
    places = [F.transform(F.sequence(F.lit(0), F.lit(3)), lambda t, c=c: F.sin(F.col("id") * (c + 1) + t * t)) for c in range(2)]
    keys = ["id", F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("name"), F.timestamp_seconds("id").alias("at")]
    df = spark.range(n, numPartitions=1).select(*keys, F.array(*places).alias("x"))
    got = te.sequence_features(df, ["id", "name", "at"]).orderBy("id").collect()
    rows = df.orderBy("id").collect()
    assert [r[:3] for r in got] == [r[:3] for r in rows] and len(got) == n
    assert np.array_equal([r["features"] for r in got], batches.sequence_features(np.array([r["x"] for r in rows])))
    for wrong in ("null", "array(array(1D, 2D))", "array(array(1D, 2D), array(1D))", "array(array(1D, 2D), null)"):
        bad = spark.range(2, numPartitions=1).selectExpr("id", f"if(id = 0, array(array(1D, 2D), array(1D, 2D)), {wrong}) AS x")
        with pytest.raises(Exception, match="of one (shape|length) expected"):
            te.sequence_features(bad, ["id"]).collect()

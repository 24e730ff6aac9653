import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid.llm import multiindex
from pulsegrid.llm.components import forest

KIND = "vec_id long, embedding array<double>, label int"


def brute(rows, threshold=0.93):
    def fine(r):
        v = r[1]
        return r[2] is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    def cosine(a, b):
        a, b = np.array(a, float), np.array(b, float)
        a, b = a / np.abs(a).max(), b / np.abs(b).max()
        return a @ b / np.linalg.norm(a) / np.linalg.norm(b)

    n = len(rows)
    linked = [[j for j in range(n) if i != j and fine(rows[i]) and fine(rows[j]) and rows[i][2] == rows[j][2]
               and len(rows[i][1]) == len(rows[j][1]) and cosine(rows[i][1], rows[j][1]) >= threshold] for i in range(n)]
    seen = [-1] * n
    for i in range(n):
        todo = [i] if seen[i] < 0 else []
        while todo:
            k = todo.pop()
            if seen[k] < 0:
                seen[k] = i
                todo += linked[k]
    smallest = {c: min((rows[k][0] for k in range(n) if seen[k] == c and rows[k][0] is not None), default=None) for c in set(seen)}
    return sorted(((rows[i][0], len(linked[i]), smallest[seen[i]], rows[i][0] == smallest[seen[i]]) for i in range(n)), key=str)


def clustered(n, dim=16, seed=1):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n // 4, dim))
    return [(i, (base[rng.integers(len(base))] + rng.normal(size=dim) * 0.2).tolist(), int(rng.integers(3))) for i in range(n)]


@pytest.mark.parametrize("chunk", [4096, 7])
def test_equals_brute_force(spark, monkeypatch, chunk):
    """Also with every cell cut into chunks and its queries dealt over salts."""
    monkeypatch.setattr(multiindex, "CHUNK", chunk)
    monkeypatch.setattr(multiindex, "QUERIES", 2 * chunk)
    monkeypatch.setattr(multiindex, "CELL", 16)
    rows = clustered(600)
    rows += [(1000 + i, rows[5][1], rows[5][2]) for i in range(40)]  # a hot group of copies
    got = multiindex.near_vectors(spark.createDataFrame(rows, KIND))
    want = brute(rows)
    found = {r.vec_id: r for r in got.collect()}
    assert len(found) == len(rows)
    assert all(found[i].n_links <= n for i, n, _, _ in want)
    assert sum(found[i].n_links for i, n, _, _ in want) >= 0.99 * sum(n for _, n, _, _ in want)
    assert sum(found[i].component_id == c for i, _, c, _ in want) >= 0.99 * len(want)


def test_odd_rows(spark):
    a = [1.0, 2.0, 3.0]
    rows = [(5, a, 1), (4, [2.0, 4.0, 6.0], 1), (3, a, 2), (2, a, None), (9, None, 1), (8, [0.0, 0.0, 0.0], 1), (7, [1.0, None, 3.0], 1), (6, [1.0, float("nan"), 3.0], 1),
            (10, [1.0, float("inf"), 3.0], 1), (5, a, 1), (None, a, 1), (None, [-1.0, 0.0, 0.0], 1), (11, [], 1), (12, [1.0, 2.0], 1), (13, [5.0], 1), (14, [1e300, 2e300, 3e300], 1),
            (15, [1e-300, 2e-300, 3e-300], 1), (16, [1.0, 2.0, 4.2], 1)]
    df = spark.createDataFrame(rows, KIND).withColumns({"cell": F.lit("x"), "rep": F.lit(1)})
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in multiindex.near_vectors(df).collect()), key=str)
    assert [x[:3] for x in got] == [x[:3] for x in brute(rows)]
    assert multiindex.near_vectors(df.limit(0)).collect() == []


def test_visited_cells_are_those_within_the_margin():
    rng = np.random.default_rng(2)
    book = multiindex.Codebook(rng.normal(size=(5, 3)), rng.normal(size=(4, 3)), 1.5)
    queries = rng.normal(size=(30, 6))
    rows, cells = book.visited(queries)
    a, b = book.distances(queries)
    total = (a - a.min(1, keepdims=True))[:, :, None] + (b - b.min(1, keepdims=True))[:, None, :]
    want = {(q, i * 4 + j) for q, i, j in zip(*(x.tolist() for x in np.nonzero(total <= 1.5)))}
    assert set(zip(rows.tolist(), cells.tolist())) == want and len(rows) == len(want)


def test_query_recall(spark):
    from pulsegrid.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    d = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    unit = np.stack(d["embedding"].to_numpy()).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.93) & (d["label"].to_numpy()[:, None] == d["label"].to_numpy()[None, :])
    want = dict(zip(d["vec_id"], near.sum(axis=1) - 1))
    q, x = np.nonzero(near)
    ids = d["vec_id"].to_numpy()
    roots = dict(zip(*(a.tolist() for a in forest(ids[q], ids[x]))))
    got = QUERIES["op1_inverted_multi_index"](spark, sf).collect()
    assert len(got) == len(d)
    assert all(r.n_links == want[r.vec_id] and r.component_id == roots.get(r.vec_id, r.vec_id) for r in got)


@pytest.mark.parametrize("kind,labels", [("string", ["x", "x", "y", None]), ("double", [1.2, 1.2, 1.7, None]), ("int", [1, 1, 2, None])])
def test_labels_are_compared_as_they_are(spark, kind, labels):
    rows = [(i, [1.0, 2.0, 3.0], label) for i, label in enumerate(labels)]
    got = multiindex.near_vectors(spark.createDataFrame(rows, f"vec_id long, embedding array<double>, label {kind}")).orderBy("vec_id").collect()
    assert [(r.n_links, r.component_id) for r in got] == [(1, 0), (1, 0), (0, 2), (0, 3)]

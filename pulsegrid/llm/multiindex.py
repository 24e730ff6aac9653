"""Embedding near-duplicates by an inverted multi-index.

*Index.* Unit vectors are cut in two halves, each half has its own codebook (k-means on a bounded
sample), and the pairs of centroids form a grid of cells. Every vector is filed in the cell of
its two nearest centroids.

*Multi-sequence traversal.* A query visits cells by growing sum of the squared distances of its
halves to the cell's two centroids and stops at a margin over its nearest cell. The margin is
fitted to the target recall: neighbours at just the limiting angle are drawn around sampled vectors
(closer ones are easier), and linked pairs inside the sample are added; the quantile of the
margins under which their cells are met is taken.

*Verification.* In every visited cell the cosine is computed in double precision.

Only vectors with equal label (and length) meet. Equal vectors are one row with a weight. A cell
with many vectors is cut into chunks, its queries are dealt over salts; index chunks are held,
queries stream past. Tasks send one count per (vector, chunk) and a spanning forest of the links,
never pairs. All vectors are indexed and all are queries; nothing is capped.

Defined cases: null labels, null or zero vectors and vectors with a null or a component that is
not finite link with nothing (n_links 0, their own component); a null vec_id keeps its row and
counts as a link, a component of null ids only is null; repeated rows are vectors of their own
that link with each other; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import written
from pulsegrid.llm.components import connected_components, forest

#: Vectors that the codebooks and the margin are fitted on, at most.
SAMPLE = 8000
TARGET_RECALL = 0.999
#: Vectors that a cell should hold, and most vectors of an index chunk and queries of a salt.
CELL = 128
CHUNK = 4096
QUERIES = 65536
#: Cells that a query may visit on average in the sample; a finer grid that needs more is not used,
#: because each visit is a row to shuffle. It changes no result, only the number of comparisons.
MAX_VISITS = 8
_MAX_CENTROIDS = 256
_BLOCK = 512


@dataclass(frozen=True)
class Codebook:
    """Centroids of the two halves and the margin at which the traversal stops."""

    left: np.ndarray
    right: np.ndarray
    margin: float

    def distances(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = self.left.shape[1]
        return _squares(unit[:, :cut], self.left), _squares(unit[:, cut:], self.right)

    def cells(self, unit: np.ndarray) -> np.ndarray:
        a, b = self.distances(unit)
        return a.argmin(axis=1) * len(self.right) + b.argmin(axis=1)

    def visited(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, cell) of all visited cells, those nearest to the queries first."""
        a, b = self.distances(unit)
        i, j = a.argsort(axis=1, kind="stable"), b.argsort(axis=1, kind="stable")
        a, b = np.take_along_axis(a, i, 1), np.take_along_axis(b, j, 1)
        a, b = a - a[:, :1], b - b[:, :1]
        rows, cells = [], []
        for step in range(a.shape[1] + b.shape[1] - 1):  # ranks in both sequences, together
            met = False
            for x in range(max(0, step - b.shape[1] + 1), min(step, a.shape[1] - 1) + 1):
                near = np.flatnonzero(a[:, x] + b[:, step - x] <= self.margin)
                if len(near):
                    met = True
                    rows.append(near)
                    cells.append(i[near, x] * len(self.right) + j[near, step - x])
            if not met:
                break  # every cell beyond has both ranks at or above one of these
        return np.concatenate(rows), np.concatenate(cells)


def _squares(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.maximum((x**2).sum(axis=1)[:, None] - 2 * x @ centroids.T + (centroids**2).sum(axis=1)[None, :], 0)


def _means(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    centroids = x[rng.choice(len(x), size=k, replace=False)]
    for _ in range(rounds):
        at = _squares(x, centroids).argmin(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, at, x)
        n = np.bincount(at, minlength=k)
        centroids = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centroids)
    return centroids


def fit_codebook(sample: np.ndarray, k: int, threshold: float, recall: float = TARGET_RECALL) -> Codebook:
    """Codebooks of ``k`` centroids a half and the margin for the recall, on unit vectors."""
    rng = np.random.default_rng(7)
    dim = sample.shape[1]
    k = max(1, min(k, len(sample)))
    cut = dim // 2
    left = _means(sample[:, :cut], k if cut else 1, rng)
    right = _means(sample[:, cut:], k, rng)
    book = Codebook(left, right, np.inf)
    some = sample[: 2000]
    step = rng.normal(size=(4, *some.shape))
    step -= (step * some).sum(axis=2, keepdims=True) * some
    step /= np.maximum(np.linalg.norm(step, axis=2, keepdims=True), 1e-12)
    drawn = (threshold * some + math.sqrt(1 - threshold**2) * step).reshape(-1, dim)
    margins = [_margin(book, np.tile(some, (4, 1)), drawn)]
    q, x = np.nonzero(np.triu(some @ some.T >= threshold, 1))
    if len(q):
        margins.append(_margin(book, some[q[:100_000]], some[x[:100_000]]))
    return Codebook(left, right, max(float(np.quantile(m, recall)) for m in margins) + 1e-9)


def fit_grid(sample: np.ndarray, k: int, threshold: float) -> Codebook:
    """The codebook of at most ``k`` centroids a half whose queries visit few cells."""
    while True:
        book = fit_codebook(sample, k, threshold)
        some = sample[:1000]
        if k == 1 or len(book.visited(some)[0]) <= MAX_VISITS * len(some):
            return book
        k = max(1, 2 * k // 3)


def _margin(book: Codebook, queries: np.ndarray, others: np.ndarray) -> np.ndarray:
    """How far past its nearest cell each query must go to meet the other vector's cell."""
    a, b = book.distances(queries)
    x, y = book.distances(others)
    rows = np.arange(len(queries))
    return a[rows, x.argmin(axis=1)] - a.min(axis=1) + b[rows, y.argmin(axis=1)] - b.min(axis=1)


def _usable() -> Column:
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    return F.coalesce(F.col("label").isNotNull() & fine & some, F.lit(False))


def _matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _unit(x: np.ndarray) -> np.ndarray:
    """Unit vectors in double precision; scaling first keeps huge and tiny components finite."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _by_dim(batch: pa.RecordBatch, name: str) -> Iterator[tuple[int, pa.RecordBatch]]:
    dims = batch.column(batch.schema.get_field_index(name)).value_lengths().to_numpy(zero_copy_only=False)
    for dim in np.unique(dims):
        yield int(dim), batch.filter(pa.array(dims == dim))


_ROUTED = "dim int, cell long, draw long, stored boolean, rep long, weight long, vec "


def _route(books):
    """Rows of vectors in their own cell (stored) and in the visited cells (queries)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for dim, batch in _by_dim(whole, "vec"):
                raw = _matrix(batch.column(3), dim)
                unit = _unit(raw)
                book = books.value.get(dim)
                own = (np.arange(len(unit)), book.cells(unit) if book else np.zeros(len(unit), dtype=np.int64))
                asked = book.visited(unit) if book else own
                for stored, (rows, cells) in ((True, own), (False, asked)):
                    for low in range(0, len(rows), 8192):
                        at, cell = rows[low : low + 8192], cells[low : low + 8192]
                        index = pa.array(at)
                        vec = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * dim), pa.array(raw[at].ravel()))
                        draw = batch.column(0).take(index)
                        yield pa.record_batch(
                            [batch.column(1).take(index), pa.array(np.full(len(at), dim, dtype=np.int32)), pa.array(cell.astype(np.int64)), draw, pa.array(np.full(len(at), stored)), draw, batch.column(2).take(index), vec],
                            names=["label", "dim", "cell", "draw", "stored", "rep", "weight", "vec"],
                        )

    return run


def _verify(threshold: float):
    """Links of each query with the stored vectors of its chunk: counts and a spanning forest."""

    def links(query, rep_q, index, rep_x, weight_x):
        counts, a, b = [], [], []
        for low in range(0, len(query), _BLOCK):
            near = query[low : low + _BLOCK] @ index.T >= threshold
            counts.append(near @ weight_x)
            q, x = np.nonzero(near)
            u, v = forest(rep_q[low + q], rep_x[x])
            a.append(u)
            b.append(v)
        return np.concatenate(counts), *forest(np.concatenate(a), np.concatenate(b))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            marks = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)])
            stored = batch.column(5).to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(np.r_[True, (marks[1:] != marks[:-1]).any(axis=1) | (stored[1:] != stored[:-1])])
            for low, high in zip(starts, np.r_[starts[1:], len(marks)]):
                part = batch.slice(low, high - low)
                if tuple(marks[low]) != key:
                    key, held = tuple(marks[low]), []
                rep, weight = (part.column(i).to_numpy(zero_copy_only=False) for i in (6, 7))
                vec = _unit(_matrix(part.column(8), int(marks[low, 1])))
                if stored[low]:
                    held.append((vec, rep, weight))
                elif held:
                    if len(held) > 1:
                        held = [tuple(np.concatenate(x) for x in zip(*held))]
                    n, a, b = links(vec, rep, *held[0])
                    some = np.flatnonzero(n)
                    yield _found(rep[some], np.full(len(some), -1, dtype=np.int64), n[some])
                    yield _found(a, b, np.zeros(len(a), dtype=np.int64))

    return run


def _found(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([pa.array(x.astype(np.int64)) for x in (a, b, n)], names=["a", "b", "n"])


def _fit(reps: DataFrame, threshold: float) -> dict[int, Codebook]:
    """A codebook for each vector length in a bounded sample; other lengths get a single cell."""
    sizes = reps.groupBy("label", F.size("vec").alias("dim")).count().agg(F.max("count"), F.sum("count")).first()
    if not sizes[0]:
        return {}
    share = min(1.0, SAMPLE * 0.9 / sizes[1])
    drawn = reps.where(F.shiftrightunsigned(F.xxhash64("vec"), 33) < int(share * 2**31)).select("vec").limit(SAMPLE).toArrow().column("vec")
    k = max(1, min(_MAX_CENTROIDS, round(math.sqrt(sizes[0] / CELL))))
    books = {}
    column = drawn.combine_chunks()
    dims = column.value_lengths().to_numpy(zero_copy_only=False)
    for dim in np.unique(dims).tolist():
        unit = _unit(_matrix(column.filter(pa.array(dims == dim)), dim))
        if dim > 1 and len(unit) >= 4 * k:
            books[dim] = fit_grid(unit, k, threshold)
    return books


def _dealt(routed: DataFrame) -> DataFrame:
    """Stored rows and queries by (label, dim, cell, chunk, salt).

    A chunk holds ``CHUNK`` stored vectors, a salt ``QUERIES`` queries; stored rows are repeated
    for every salt and queries for every chunk of their cell. Cells of common size have one of
    both. The table of cells with more has at most rows / CHUNK entries.
    """
    key = ["label", "dim", "cell"]
    per = routed.groupBy(*key).agg(F.sum(F.col("stored").cast("long")).alias("_s"), F.sum((~F.col("stored")).cast("long")).alias("_q"))
    big = written(
        per.select(*key, F.ceil(F.col("_s") / CHUNK).alias("chunks"), F.ceil(F.col("_q") / QUERIES).alias("salts")).where("chunks > 1 OR salts > 1"),
        "index-hot-cells",
    )
    joined = routed.join(big, key, "left").fillna(1, ["chunks", "salts"])
    chunk = F.pmod(F.xxhash64("draw", F.lit(1)), F.col("chunks"))
    salt = F.pmod(F.xxhash64("draw", F.lit(2)), F.col("salts"))
    every = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    chunks = F.when(F.col("stored"), F.array(chunk)).otherwise(every("chunks"))
    salts = F.when(F.col("stored"), every("salts")).otherwise(F.array(salt))
    spread = joined.withColumn("chunk", F.explode(chunks)).withColumn("salt", F.explode(salts))
    return spread.select(*key, "chunk", "salt", "stored", "rep", "weight", "vec")


def near_vectors(embeddings: DataFrame, threshold: float = 0.93) -> DataFrame:
    """vec_id, n_links, component_id, kept for every vector."""
    kind = "array<float>" if dict(embeddings.dtypes)["embedding"] == "array<float>" else "array<double>"
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast(kind).alias("embedding")
    )
    usable = rows.where(_usable())
    classes = usable.groupBy("label", "embedding").agg(F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("first"))
    reps = written(classes.withColumn("rep", F.monotonically_increasing_id()).withColumnRenamed("embedding", "vec"), "vectors")
    books = rows.sparkSession.sparkContext.broadcast(_fit(reps, threshold))
    routed = written(reps.select("rep", "label", "weight", "vec").mapInArrow(_route(books), f"label {reps.schema['label'].dataType.simpleString()}, {_ROUTED}{kind}"), "index-rows")
    dealt = _dealt(routed)
    key = ["label", "dim", "cell", "chunk", "salt"]
    ordered = dealt.repartition(*key).sortWithinPartitions(*key, F.desc("stored"))
    found = written(ordered.mapInArrow(_verify(threshold), "a long, b long, n long"), "index-links")
    counts = found.where("n > 0").groupBy(F.col("a").alias("rep")).agg((F.sum("n") - 1).alias("n_links"))
    roots = connected_components(found.where("n = 0").select("a", "b"))
    tied = reps.select("rep", "first").join(roots, F.col("rep") == F.col("node"), "left")
    tied = written(tied.select("rep", "first", F.coalesce("root", "rep").alias("root")), "index-roots")
    smallest = tied.groupBy("root").agg(F.min("first").alias("component_id"))
    labelled = reps.select("rep", "label", "vec").join(counts, "rep", "left").join(tied.join(smallest, "root").select("rep", "component_id"), "rep")
    labelled = written(labelled.select("label", F.col("vec").alias("embedding"), "n_links", "component_id"), "index-labels")
    linked = usable.join(labelled, ["label", "embedding"]).select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id")
    alone = rows.where(~_usable()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))

"""Connected components of a graph given as rows (a, b) of 64-bit numbers.

Alternating large-star and small-star rounds: every round ties neighbours to the smallest node
around them, until each component is a star around its smallest node. Each task first reduces
its own edges to a spanning forest, so a dense group costs edges in proportion to its nodes.
Every round reads and writes files in the shared folder; minima are pre-aggregated before the
shuffle and joined from files, so AQE can split the rows of a hot node.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import written


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) for all nodes of the edges but the smallest."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while len(left):
        x, y = label[left], label[right]
        apart = x != y
        left, right, x, y = left[apart], right[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label[label] != label).any():
            label = label[label]
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    u, v = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    for batch in batches:
        u, v = forest(np.concatenate([u, batch["u"].to_numpy()]), np.concatenate([v, batch["v"].to_numpy()]))
        if len(u) > 1_000_000:  # bounded memory: what is kept goes out, the rounds tie it together
            yield pd.DataFrame({"u": u, "v": v})
            u, v = u[:0], v[:0]
    yield pd.DataFrame({"u": u, "v": v})


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node but the smallest of its component; ``edges``: (a, b)."""
    start = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v")
    current = written(start.mapInPandas(_local, "u long, v long").distinct(), "edges")
    seen = _signature(current)
    while seen[0]:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "large-min")
        large = written(
            both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large"
        )
        low = written(large.groupBy("u").agg(F.min("v").alias("m")), "small-min")
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        current = written(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = _signature(current)
        if now == seen:
            break
        seen = now
    return current.select(F.col("u").alias("node"), F.col("v").alias("root"))

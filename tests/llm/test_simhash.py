import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pulsegrid.llm import components, simhash


def reference_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reference_groups(rows):
    made = [(d, reference_fingerprint(t)) for d, t in rows]
    parent = list(range(len(made)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(made)):
        for j in range(i):
            if (made[i][1] ^ made[j][1]).bit_count() <= 3:
                parent[find(i)] = find(j)
    groups = {}
    for i, (d, _) in enumerate(made):
        groups.setdefault(find(i), []).append(d)
    smallest = {r: min((d for d in ds if d is not None), default=None) for r, ds in groups.items()}
    return sorted(((d, f"{fp:016x}", smallest[find(i)]) for i, (d, fp) in enumerate(made)), key=str)


def random_fingerprints(n, seed=0):
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(n // 5)]
    out = list(centres)
    while len(out) < n:
        x = rng.choice(out)
        for _ in range(rng.randint(1, 4)):
            x ^= 1 << rng.randrange(64)
        out.append(x)
    return np.unique(np.array(out, dtype=np.uint64))


def components_of(fp):
    near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 3
    a, b = np.nonzero(np.triu(near, 1))
    return dict(zip(*(x.tolist() for x in components.forest(fp.view(np.int64)[a], fp.view(np.int64)[b]))))


@pytest.mark.parametrize("limit", ["200000", "40"])
def test_links_equal_brute_force(spark, limit):
    """Also with every shard split by further vantage points."""
    fp = random_fingerprints(1500)
    ball = np.unique(np.array([7 ^ (1 << i) ^ (1 << j) ^ (1 << k) for i in range(0, 9) for j in range(9, 20) for k in range(20, 26)], dtype=np.uint64))
    fp = np.unique(np.concatenate([fp, ball]))
    spark.conf.set("spark.pulsegrid.simhash.maxShardRows", limit)
    try:
        df = spark.createDataFrame([(int(x),) for x in fp.view(np.int64)], "fp long")
        found = components.connected_components(simhash.fingerprint_links(df))
        assert {r["node"]: r["root"] for r in found.collect()} == components_of(fp)
    finally:
        spark.conf.unset("spark.pulsegrid.simhash.maxShardRows")


def test_vantage_tree_finds_every_pair():
    fp = random_fingerprints(700, 3)
    tree = simhash.VantageTree(fp)
    found = {(int(q), int(r)) for a, b in tree.search(fp) for q, r in zip(a, b)}
    want = set(zip(*(x.tolist() for x in np.nonzero(np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 3))))
    assert found == want


def test_odd_documents(spark):
    """Nulls, empty and blank texts, ties, repeated rows, a very long text, clashing columns."""
    long = " ".join(f"word{i % 977}" for i in range(50_000))
    rows = [(5, None), (4, ""), (3, " \t\n"), (9, "One  two\x0bTHREE four"), (8, "one two three FOUR"), (8, "one two three FOUR"),
            (None, "one two three four"), (None, "all alone here"), (7, "É é"), (6, "one"), (2, long), (1, long + " x"), (10, " a b c d")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"fp": F.lit("x"), "component_id": F.lit(0)})
    got = [tuple(r) for r in simhash.near_duplicates(df).collect()]
    assert sorted(got, key=str) == reference_groups(rows)


def test_no_documents(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(df).collect() == []


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000 + i, 1000) for i in range(50)] + [(7, 7)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(8)
    got = {r["node"]: r["root"] for r in components.connected_components(df).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {1000 + i: 1000 for i in range(1, 50)}


def test_query_on_given_tables(spark):
    from pulsegrid.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r)[:3] for r in QUERIES["op7_simhash_trees"](spark, sf).collect()]
    assert sorted(got, key=str) == reference_groups(docs)

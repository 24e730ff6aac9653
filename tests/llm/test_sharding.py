import math
import zlib

import pytest
import xxhash
from pyspark.sql import functions as F

from pulsegrid.llm import sharding

SF = "/root/testdata/sf0.01"


def place(doc_id, weights):
    """Scores of all shards for one key: the hashes chain over key and shard number."""
    seed = 42 if doc_id is None else xxhash.xxh64_intdigest(doc_id.to_bytes(8, "little", signed=True), 42)
    best = None
    for j, w in enumerate(weights):
        if w > 0:
            drawn = xxhash.xxh64_intdigest(j.to_bytes(4, "little"), seed) >> 11
            best = max(best or (-math.inf, 0), (-w / math.log((drawn + 0.5) / 2**53), j))
    return best[1]


def check(rows, docs, weights):
    want = sorted((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), place(d, weights), place(d, [*weights, 1.0])) for d, t in docs) if all(
        d is not None for d, _ in docs) else None
    got = [(r.doc_id, r.size, r.text_crc32, r.shard, r.grown_shard) for r in rows]
    if want is not None:
        assert sorted(got) == want
    assert {r.law for r in rows} <= {"key"}
    assert all(r.grown_shard in (r.shard, len(weights)) for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(slots) == list(range(len(slots))) for slots in by.values())


def test_query_equals_brute_force(spark):
    from pulsegrid.llm.queries import QUERIES

    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rows = QUERIES["op5_rendezvous_shards"](spark, SF).collect()
    check(rows, docs, [1.0] * 16)
    assert 20 <= sum(r.grown_shard == 16 for r in rows) <= 110  # about 1 of 17


@pytest.mark.parametrize("weights", [[1.0, 3.0, 0.0, 0.5], [2.0]])
def test_weights_and_odd_rows(spark, weights):
    docs = [(i, "x" * (i % 50)) for i in range(3000)] + [(7, "é"), (7, "é"), (7, None), (-5, "")] + [(42, "hot")] * 1500
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"shard": F.lit("clash"), "slot": F.lit(1)})
    rows = sharding.shard_documents(df, weights).collect()
    check(rows, docs, weights)
    if len(weights) == 4:
        share = [sum(r.shard == j and r.doc_id != 42 for r in rows) / 3004 for j in range(4)]
        assert share[2] == 0 and share[1] == pytest.approx(3 / 4.5, abs=0.04) and share[3] == pytest.approx(0.5 / 4.5, abs=0.03)


def test_nulls_and_empty_table(spark):
    df = spark.createDataFrame([(None, "a"), (None, None), (3, "b")], "doc_id long, text string")
    rows = sharding.shard_documents(df, [1.0] * 3).collect()
    check(rows, [(r.doc_id, None) for r in rows], [1.0] * 3)
    assert len({r.shard for r in rows if r.doc_id is None}) == 1
    assert sharding.shard_documents(df.limit(0), [1.0]).collect() == []
    with pytest.raises(ValueError):
        sharding.rendezvous(["doc_id"], [0.0])

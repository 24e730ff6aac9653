import math

import pytest
from compare import compare, duck
from pyspark.sql import functions as F

from pulsegrid.llm import mixing
from pulsegrid.llm.queries import QUERIES, SQL


def sizes_of(spark, tokens):
    return spark.createDataFrame([(s, t, d) for s, (t, d) in tokens.items()], "source string, tokens long, docs long")


def entropy_of(rows):
    return -sum(r.weight * math.log(r.weight) for r in rows if r.weight)


SIZES = {"a": (100_000, 900), "b": (10_000, 90), "c": (2_500, 30), None: (500, 5), "empty": (0, 3)}


def test_repetition_limit(spark):
    rows = {r.source: r for r in mixing.mix_plan(sizes_of(spark, SIZES), repeat_limit=3.0).collect()}
    assert sum(r.weight for r in rows.values() if r.weight) == pytest.approx(1)
    assert rows[None].repeats == pytest.approx(3.0, abs=1e-6) and rows["a"].repeats == pytest.approx(1.0)
    assert (rows["empty"].full, rows["empty"].rest, rows["empty"].weight) == (1, 0.0, None)


def test_target_entropy(spark):
    for target in (0.6, 1.0, math.log(4) - 1e-9):
        rows = mixing.mix_plan(sizes_of(spark, SIZES), repeat_limit=None, entropy=target).collect()
        assert entropy_of(rows) == pytest.approx(target, abs=1e-6)
    natural = mixing.mix_plan(sizes_of(spark, SIZES), repeat_limit=None, entropy=0.01).collect()
    assert {r.source: r.weight for r in natural if r.weight}["a"] == pytest.approx(100_000 / 113_000)


def test_budget_is_met(spark):
    plan = mixing.mix_plan(sizes_of(spark, SIZES), repeat_limit=5.0, budget=60_000.0).collect()
    used = sum((r.full * r.tokens + r.rest) for r in plan)
    assert used == pytest.approx(60_000)
    assert max(r.repeats for r in plan if r.weight) <= 5.0 + 1e-6


def docs_of(spark):
    rows = [(i, "w " * (i % 7), "hot" if i < 4000 else f"s{i % 3}") for i in range(6000)]
    rows += [(None, "x y", None), (None, "x y", None), (1, None, "nulls"), (1, "", "nulls"), (9, "q " * 20_000, "long")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("blocks", F.lit("clash"))


def test_no_document_is_lost_and_budgets_hold(spark):
    docs = docs_of(spark)
    _, plan, _ = mixing._planned(docs, repeat_limit=2.0)
    want = {r.source: r for r in plan.collect()}
    got = mixing.mixture(docs, repeat_limit=2.0)
    assert got.dropDuplicates(["doc_id", "source", "n_tokens"]).count() == docs.withColumn("n", mixing.n_words("text")).dropDuplicates(["doc_id", "source", "n"]).count()
    for r in got.groupBy("source").agg(F.sum("n_tokens").alias("n"), F.max("n_tokens").alias("most")).collect():
        target = want[r.source].full * want[r.source].tokens + want[r.source].rest
        assert target - 1 <= r.n <= target + r.most
    mixed = mixing.mix(docs, repeat_limit=2.0)
    assert mixed.columns == docs.columns and mixed.count() == got.count()


def test_empty_tables(spark):
    docs = docs_of(spark)
    assert mixing.mix(docs.limit(0)).count() == 0
    blank = spark.createDataFrame([(1, " ", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert sorted(r.doc_id for r in mixing.mix(blank).collect()) == [1, 2]


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    assert compare(spark, duck(sf), sf, "op6", QUERIES["op6_temperature_mix"], SQL["op6_temperature_mix"]) is None

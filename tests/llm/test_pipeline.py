from collections import Counter

import pytest
from pyspark.sql import functions as F
from test_linededup import brute as brute_lines
from test_simhash import reference_fingerprint, reference_groups

import corpus_pipeline
from pulsegrid.llm import langid, mixing, pieces
from pulsegrid.llm.common import tokenizer_path

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, extra string"


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def test_stage_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "simhash_near_dedup", "mix_sources", "sentencepiece"]


def test_whole_pipeline_equals_brute_force_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    known = [r for r in docs if langid.has_letter(r.text)]
    lines = dict(brute_lines([(r.doc_id, r.text) for r in known], short=True))
    groups = reference_groups(list(lines.items()))
    stay = {d for d, _, c in groups if d == c}
    mixed_in = spark.createDataFrame([(r.doc_id, lines[r.doc_id], r.source) for r in known if r.doc_id in stay], "doc_id long, text string, source string")
    want = Counter(r.doc_id for r in mixing.mixture(mixed_in, repeat_limit=2.0).collect())
    assert set(want) == stay and max(want.values()) <= 2
    model = pieces.load_model(tokenizer_path(corpus_pipeline.PIECE_MODEL))
    rows = corpus_pipeline.run(spark, SF).collect()
    assert Counter(r.doc_id for r in rows) == want
    ids, counts = pieces.Encoder(model).encode([lines[r.doc_id] for r in rows])
    at = 0
    for r, n in zip(rows, counts.tolist()):
        assert r.token_ids == ids[at : at + n].tolist() and r.round_trip
        at += n


ROWS = [
    (1, "the house and the garden\nare near the river\nand the road", "en", "a", 1, None),
    (2, "the house and the garden\nare near the river\nand the road", "en", "b", 2, "x"),
    (2, "the house and the garden\nare near the river\nand the road", "en", "b", 2, "x"),
    (3, None, None, None, None, None), (None, None, "de", "a", 3, None), (4, "12 34 !!", None, "a", 4, None), (5, "", "de", None, 5, None),
    (None, "das haus und der garten am fluss", "de", None, 6, None), (None, "das haus und der garten am fluss", "de", None, 6, None),
    (6, "das haus und der garten am fluss", None, "b", 7, None), (7, "word " * 30_000, "en", "c", 8, None),
]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_and_empty_tables(spark, name):
    docs = spark.createDataFrame(ROWS, SCHEMA).withColumns({"fp": F.lit(1), "n_removed": F.lit("clash"), "epoch": F.lit(2)})
    made = stage(name)(spark, docs, "")
    rows = made.collect()
    if name != "sentencepiece":
        assert made.columns == docs.columns
    ids = sorted((r.doc_id for r in rows), key=str)
    if name == "language_id":
        assert ids == sorted([1, 2, 2, None, None, 6, 7], key=str)
    if name in ("line_dedup", "sentencepiece"):
        assert ids == sorted((r[0] for r in ROWS), key=str)
    if name == "line_dedup":
        assert {(r.doc_id, r.text, r.n_chars) for r in rows if r.doc_id in (1, 2)} == {(1, ROWS[0][1], 1), (2, "", 0)}
    if name == "simhash_near_dedup":
        groups = reference_groups([r[:2] for r in ROWS])
        assert ids == sorted({c for _, _, c in groups})
    if name == "mix_sources":
        assert set(ids) == {r[0] for r in ROWS}
    assert stage(name)(spark, docs.limit(0), "").count() == 0


def test_language_stage_keeps_what_it_cannot_judge(spark):
    docs = spark.createDataFrame([(1, "one text"), (2, "ein Text"), (3, "12")], "doc_id long, text string").withColumn("lang", F.lit(None).cast("string"))
    assert sorted(r.doc_id for r in stage("language_id")(spark, docs, "").collect()) == [1, 2, 3]

"""The corpus pipeline: raw documents to token ids, one written table after each stage.

Language ID drops documents without a known language. Line dedup takes out passages that
occurred before (a document may become empty, none is dropped). SimHash near-dedup keeps one
document of each group. Mixing repeats documents of small sources up to ``REPEAT_LIMIT`` times, so that
every document stays in the mix. The last stage encodes the texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm import langid, linededup, mixing, pieces, simhash
from pulsegrid.llm.common import table, tokenizer_path, written

PIECE_MODEL = "piece_bpe_32k.model"
REPEAT_LIMIT = 2.0


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.without_unknown_language(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    edited = linededup.dedup_lines(docs.withColumn("n_removed", F.lit(0)), short=True)
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        edited = edited.withColumn("n_chars", F.when(F.col("n_removed") > 0, length).otherwise(F.col("n_chars")))
    return edited.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.without_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, repeat_limit=REPEAT_LIMIT)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode_documents(docs, pieces.load_model(tokenizer_path(PIECE_MODEL)))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("sentencepiece", encode),
]

#: SQL cannot express the language model, the fingerprints or the encoding; tests/llm compares
#: the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each reads the table that the one before it wrote."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
SQL = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}

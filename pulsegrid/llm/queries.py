"""One registered query for each operator; each returns the full result over its table."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm import html, langid, linededup, mixing, multiindex, pieces, quality, repair, resampling, sharding, simhash, toxicity, urls
from pulsegrid.llm.common import table, tokenizer_path
from pulsegrid.llm.html_pages import PAGES

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

N_SHARDS = 16
PIECE_MODEL = "piece_bpe_32k.model"


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


@query("op5_rendezvous_shards")
def rendezvous_shards(spark, sf):
    return sharding.shard_documents(table(spark, sf, "documents"), [1.0] * N_SHARDS)


#: The rules of the query's contract.
URL_RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
#: Hosts blocked where no rule fits, unless PULSEGRID_BLOCKED_HOSTS names a text file (any path that Spark reads, one host a line). These
#: names are the unwanted sites of the synthetic pages, under each of their domains: a stand-in for a list that a user brings.
BLOCKED_SITES = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
BLOCKED_UNDER = ("example.com", "example.net", "example.org")


def blocked_hosts(spark):
    """Column host: the given list, whatever its length."""
    path = os.environ.get("PULSEGRID_BLOCKED_HOSTS")
    if path:
        return spark.read.text(path).select(F.trim("value").alias("host")).where("host <> ''")
    return spark.createDataFrame([(f"{name}.{under}",) for name in BLOCKED_SITES for under in BLOCKED_UNDER], "host string")


@query("op10_url_cascade")
def url_cascade(spark, sf):
    return urls.judge_urls(table(spark, sf, "pages"), URL_RULES, blocked_hosts(spark))


@query("op7_simhash_trees")
def simhash_trees(spark, sf):
    return simhash.near_duplicates(table(spark, sf, "documents"))


@query("op9_risk_controlled_rules")
def risk_controlled_rules(spark, sf):
    return quality.judge_quality(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query("op8_string_kernel_language")
def string_kernel_language(spark, sf):
    return langid.identify_held_out(table(spark, sf, "documents"))


@query("op4_line_windows", linededup.ORACLE)
def line_windows(spark, sf):
    return linededup.dedup_lines(table(spark, sf, "documents")).select("doc_id", "text", "n_removed")


@query("op4_line_windows_short", linededup.ORACLE_SHORT)
def line_windows_short(spark, sf):
    return linededup.dedup_lines(table(spark, sf, "documents"), short=True).select("doc_id", "text", "n_removed")


REPEAT_LIMIT = 2.0


@query("op6_temperature_mix", mixing.oracle(REPEAT_LIMIT))
def temperature_mix(spark, sf):
    return mixing.mixture(table(spark, sf, "documents"), repeat_limit=REPEAT_LIMIT)


@query("op3_sentencepiece_viterbi")
def sentencepiece_viterbi(spark, sf):
    model = pieces.load_model(tokenizer_path(PIECE_MODEL))
    return pieces.encode_documents(table(spark, sf, "documents"), model)


@query("op2_main_text")
def main_text(spark, sf):
    tree = html.fit_tree(*html.labelled_rows(PAGES))
    return html.extract_main_text(table(spark, sf, "pages"), tree)


@query("op1_inverted_multi_index")
def inverted_multi_index(spark, sf):
    return multiindex.near_vectors(table(spark, sf, "embeddings"))


@query("op13_target_resampling", resampling.oracle())
def target_resampling(spark, sf):
    found = resampling.importance(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


@query("op11_conversation_repair", repair.oracle())
def conversation_repair(spark, sf):
    return repair.repair_conversations(table(spark, sf, "conversations"))


@query("op12_toxicity_grammar")
def toxicity_grammar(spark, sf):
    return toxicity.judge_held_out(table(spark, sf, "documents"), table(spark, sf, "labels"))

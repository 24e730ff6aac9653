"""Temperature mixing of sources to target weights, realised as budgeted block permutations.

*Weights.* With token shares p the weight of a source is p ** a / sum(p ** a), 0 <= a <= 1: one
keeps the natural shares, zero makes all sources equal. The exponent is bisected, either to the
flattest mix in which no source is read more than ``repeat_limit`` times, or to the natural-most mix
that reaches a target entropy (in nats).

*Budget.* A source gets weight x budget tokens. Without a budget the smallest one is taken with
which every source is read whole at least once, so that mixing loses no document.

*Realisation.* Documents of a source fall into blocks of about ``BLOCK_DOCS`` by a hash of their
doc_id. Each pass over the source is a new permutation of its blocks; full passes take all
blocks, the last pass takes blocks in order until the budget is used up, and of its last block
documents in hash order (one that starts inside the budget is taken whole).

Scale: a hot source is spread over its blocks; windows run over block summaries of one source,
and over the documents of the one block that the budget cuts. Only a few sums reach the driver.

Defined cases: a null source is a source of its own; sources without tokens are read once and
take no part in the weights; a null doc_id hashes like an empty one; rows with the same doc_id
are separate documents in one block; other columns are ignored (``mix_plan``) or kept (``mix``).
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pulsegrid.llm.common import WORD, n_words, written

BLOCK_DOCS = 1000
BISECTIONS = 40
_GRID = 16


def bisect(reached: Callable[[float], bool]) -> float:
    """The smallest exponent in [0, 1] for which ``reached`` (monotone) holds; 1 if none."""
    if reached(0.0):
        return 0.0
    low, high = 0.0, 1.0
    for _ in range(BISECTIONS):
        middle = (low + high) / 2
        if reached(middle):
            high = middle
        else:
            low = middle
    return high


def _narrow(measure: Callable[[list[float]], list[bool]]) -> float:
    """``bisect`` with many exponents measured by one job at a time."""
    if measure([0.0])[0]:
        return 0.0
    low, high = 0.0, 1.0
    while high - low > 2.0**-BISECTIONS:
        grid = [low + (high - low) * i / _GRID for i in range(1, _GRID)]
        low, high = next(((a, b) for a, b, ok in zip([low, *grid], grid, measure(grid)) if ok), (grid[-1], high))
    return high


def _sums(shares: DataFrame, exponents: list[float]) -> list[tuple[float, float]]:
    """(sum of p ** a, entropy of the mix) for each exponent; one aggregation."""
    made = []
    for a in exponents:
        made += [F.sum(F.pow("p", F.lit(a))), F.sum(F.pow("p", F.lit(a)) * F.ln("p"))]
    row = shares.agg(*[c.alias(f"c{i}") for i, c in enumerate(made)]).first()
    return [(row[2 * i], math.log(row[2 * i]) - a * row[2 * i + 1] / row[2 * i]) for i, a in enumerate(exponents)]


def mix_plan(
    sizes: DataFrame, repeat_limit: float | None = 2.0, entropy: float | None = None, budget: float | None = None
) -> DataFrame:
    """source, tokens, docs, weight, repeats, full (passes), rest (tokens of the last pass), blocks.

    ``sizes``: source, tokens, docs. Give ``repeat_limit`` or ``entropy``; a limit that the
    natural shares do not meet either gives the natural shares.
    """
    if (repeat_limit is None) == (entropy is None):
        raise ValueError("give either a repetition limit or a target entropy")
    ends = sizes.where("tokens > 0").agg(F.sum("tokens"), F.min("tokens"), F.max("tokens")).first()
    blocks = F.greatest(F.ceil(F.col("docs") / BLOCK_DOCS), F.lit(1)).cast("long").alias("blocks")
    if not ends[0]:
        nothing = [F.lit(None).cast("double").alias(c) for c in ("weight", "repeats")]
        return sizes.select("source", "tokens", "docs", *nothing, F.lit(1).cast("long").alias("full"), F.lit(0.0).alias("rest"), blocks)
    total, least, most = map(float, ends)
    shares = sizes.where("tokens > 0").select((F.col("tokens") / total).alias("p"))
    if entropy is not None:
        exponent = 1.0
        if _sums(shares, [1.0])[0][1] < entropy:  # entropy falls as the exponent grows
            exponent = 1 - _narrow(lambda grid: [h >= entropy for _, h in _sums(shares, [1 - g for g in grid])])
    elif budget is None:
        exponent = bisect(lambda a: math.pow(most / least, 1 - a) <= repeat_limit)
    else:

        def within(grid: list[float]) -> list[bool]:
            return [budget / total / z * math.pow(least / total, a - 1) <= repeat_limit for a, (z, _) in zip(grid, _sums(shares, grid))]

        exponent = _narrow(within)
    z = _sums(shares, [exponent])[0][0]
    p = F.col("tokens") / total
    weight = F.when(F.col("tokens") > 0, F.pow(p, F.lit(exponent)) / z)
    if budget is None:
        repeats = F.when(F.col("tokens") > 0, F.pow(F.lit(most) / F.col("tokens"), F.lit(1 - exponent)))
    else:
        repeats = weight * budget / F.col("tokens")
    full = F.floor(F.col("repeats") + 1e-9).cast("long")
    return (
        sizes.select("source", "tokens", "docs", weight.alias("weight"), repeats.alias("repeats"), blocks)
        .withColumn("full", F.coalesce(full, F.lit(1)))
        .withColumn("rest", F.coalesce(F.greatest((F.col("repeats") - full) * F.col("tokens"), F.lit(0.0)), F.lit(0.0)))
        .select("source", "tokens", "docs", "weight", "repeats", "full", "rest", "blocks")
    )


def draw(*parts: Column) -> Column:
    """A number of 32 bits from the MD5 of the parts, joined by colons."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts).cast("binary")), 1, 8), 16, 10).cast("long")


def _doc_draw(salt: str) -> Column:
    return draw(F.lit(salt), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))


def _with_block(rows: DataFrame, plan: DataFrame) -> DataFrame:
    sources = plan.select(F.col("source").alias("_pg_source"), F.col("blocks").alias("_pg_blocks"))
    joined = rows.join(sources, F.col("source").eqNullSafe(F.col("_pg_source")))
    return joined.withColumn("_pg_block", _doc_draw("block") % F.col("_pg_blocks")).drop("_pg_source", "_pg_blocks")


def _block_passes(thin: DataFrame, plan: DataFrame) -> DataFrame:
    """_pg_source, _pg_block, epoch, block_rank, _pg_room (tokens left if the budget cuts it)."""
    blocks = _with_block(thin, plan).groupBy("source", "_pg_block").agg(F.sum("n_tokens").alias("tokens"))
    lean = plan.select(F.col("source").alias("_pg_source"), "full", "rest")
    last = F.col("full") + F.when(F.col("rest") > 0, 1).otherwise(0) - 1
    passes = blocks.join(lean, F.col("source").eqNullSafe(F.col("_pg_source"))).where(last >= 0)
    passes = passes.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    key = draw(F.lit("pass"), F.coalesce("source", F.lit("")), F.col("epoch").cast("string"), F.col("_pg_block").cast("string"))
    order = Window.partitionBy("source", "epoch").orderBy("_pg_key", "_pg_block")
    ahead = order.rowsBetween(Window.unboundedPreceding, -1)
    ranked = passes.withColumn("_pg_key", key).withColumns(
        {"block_rank": F.row_number().over(order) - 1, "before": F.coalesce(F.sum("tokens").over(ahead), F.lit(0))}
    )
    whole = (F.col("epoch") < F.col("full")) | (F.col("before") + F.col("tokens") <= F.col("rest"))
    cut = F.when(~whole, F.col("rest") - F.col("before"))
    taken = ranked.where((F.col("epoch") < F.col("full")) | (F.col("before") < F.col("rest")))
    return taken.select("_pg_source", "_pg_block", F.col("epoch").cast("int").alias("epoch"), F.col("block_rank").cast("long").alias("block_rank"), cut.alias("_pg_room"))


def _realise(rows: DataFrame, tokens: Column, plan: DataFrame, passes: DataFrame) -> DataFrame:
    """Rows once for each pass that takes them; ``tokens`` is only computed where a block is cut."""
    placed = _with_block(rows, plan).withColumnRenamed("_pg_block", "_pg_at")

    def met(some: DataFrame) -> DataFrame:
        same = F.col("source").eqNullSafe(F.col("_pg_source")) & (F.col("_pg_at") == F.col("_pg_block"))
        return placed.join(some, same).drop("_pg_source", "_pg_block")

    whole = met(passes.where("_pg_room IS NULL")).drop("_pg_room", "_pg_at")
    order = Window.partitionBy("source", "_pg_at", "epoch").orderBy("_pg_draw", "doc_id", "_pg_tokens")
    ahead = order.rowsBetween(Window.unboundedPreceding, -1)
    cut = met(passes.where("_pg_room IS NOT NULL")).withColumns({"_pg_tokens": tokens, "_pg_draw": _doc_draw("order")})
    cut = cut.withColumn("_pg_before", F.coalesce(F.sum("_pg_tokens").over(ahead), F.lit(0)))
    cut = cut.where(F.col("_pg_before") < F.col("_pg_room"))
    return whole.unionByName(cut.drop("_pg_room", "_pg_at", "_pg_tokens", "_pg_draw", "_pg_before"))


def _planned(docs: DataFrame, **target) -> tuple[DataFrame, DataFrame, DataFrame]:
    thin = written(docs.select("doc_id", "source", n_words("text").alias("n_tokens")), "mix-sizes")
    sizes = thin.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs"))
    plan = written(mix_plan(written(sizes, "mix-sources"), **target), "mix-plan")
    return thin, plan, written(_block_passes(thin, plan), "mix-blocks")


def mix(docs: DataFrame, **target) -> DataFrame:
    """The documents' columns and rows, repeated as the mix asks for; targets as in ``mix_plan``."""
    _, plan, passes = _planned(docs, **target)
    packed = docs.select(F.struct("*").alias("_pg_row"), "doc_id", "source")
    made = _realise(packed, n_words(F.col("_pg_row.text")), plan, passes)
    return made.select("_pg_row.*")


def mixture(docs: DataFrame, **target) -> DataFrame:
    """doc_id, source, n_tokens, epoch, block_rank of every reading of a document in the mix."""
    thin, plan, passes = _planned(docs, **target)
    made = _realise(thin, F.col("n_tokens"), plan, passes)
    return made.select("doc_id", "source", "n_tokens", "epoch", "block_rank")


def oracle(repeat_limit: float) -> str:
    def draw_sql(*parts: str) -> str:
        return f"CAST('0x' || substr(md5({' || chr(58) || '.join(parts)}), 1, 8) AS BIGINT)"

    return rf"""
WITH RECURSIVE thin AS (
    SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS n_tokens FROM documents
), sizes AS (
    SELECT source, CAST(sum(n_tokens) AS DOUBLE) AS tokens, count(*) AS docs FROM thin GROUP BY source
), ends AS (
    SELECT min(tokens) AS least, max(tokens) AS most, sum(tokens) AS total FROM sizes WHERE tokens > 0
), halving AS (
    SELECT 0 AS step, 0.0::DOUBLE AS low, (CASE WHEN most / least <= {repeat_limit} THEN 0.0 ELSE 1.0 END)::DOUBLE AS high FROM ends
    UNION ALL
    SELECT step + 1, CASE WHEN pow(most / least, 1 - (low + high) / 2) <= {repeat_limit} THEN low ELSE (low + high) / 2 END,
           CASE WHEN pow(most / least, 1 - (low + high) / 2) <= {repeat_limit} THEN (low + high) / 2 ELSE high END
    FROM halving, ends WHERE step < {BISECTIONS}
), plan AS (
    SELECT source, tokens, greatest(CAST(ceil(docs / {BLOCK_DOCS}) AS BIGINT), 1) AS blocks,
           CASE WHEN tokens > 0 THEN pow(most / tokens, 1 - high) END AS repeats
    FROM sizes, ends, halving WHERE step = {BISECTIONS}
), passes AS (
    SELECT *, coalesce(CAST(floor(repeats + 1e-9) AS BIGINT), 1) AS n_full,
           coalesce(greatest((repeats - floor(repeats + 1e-9)) * tokens, 0), 0) AS rest FROM plan
), placed AS (
    SELECT t.*, p.n_full, p.rest, {draw_sql("'block'", "coalesce(CAST(doc_id AS VARCHAR), '')")} % p.blocks AS block
    FROM thin t JOIN passes p ON t.source IS NOT DISTINCT FROM p.source
), blocked AS (
    SELECT source, block, n_full, rest, sum(n_tokens) AS tokens FROM placed GROUP BY ALL
), turned AS (
    SELECT *, unnest(generate_series(0, n_full + (CASE WHEN rest > 0 THEN 1 ELSE 0 END) - 1)) AS epoch FROM blocked
), keyed AS (
    SELECT *, {draw_sql("'pass'", "coalesce(source, '')", "CAST(epoch AS VARCHAR)", "CAST(block AS VARCHAR)")} AS k FROM turned
), ranked AS (
    SELECT *, row_number() OVER o - 1 AS block_rank, coalesce(sum(tokens) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
    FROM keyed WINDOW o AS (PARTITION BY source, epoch ORDER BY k, block)
), read AS (
    SELECT t.doc_id, t.source, t.n_tokens, r.epoch, r.block_rank, r.epoch < r.n_full OR r.ahead + r.tokens <= r.rest AS whole,
           r.rest - r.ahead AS room,
           coalesce(sum(t.n_tokens) OVER (PARTITION BY t.source, t.block, r.epoch ORDER BY {draw_sql("'order'", "coalesce(CAST(t.doc_id AS VARCHAR), '')")}, t.doc_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM placed t JOIN ranked r ON t.source IS NOT DISTINCT FROM r.source AND t.block = r.block
)
SELECT doc_id, source, n_tokens, CAST(epoch AS INTEGER) AS epoch, CAST(block_rank AS BIGINT) AS block_rank FROM read WHERE whole OR before < room
"""

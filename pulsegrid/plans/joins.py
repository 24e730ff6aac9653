"""Join helpers: checked broadcast, keys-first filtering, salting of hot keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.session import broadcast_byte_limit, broadcast_row_limit, group_row_limit, materialise, stored


def _is_small(df: DataFrame, limit: int | None) -> bool:
    """At most ``limit`` rows, and few enough bytes; both are measured on what a limit lets through."""
    spark = df.sparkSession
    limit = broadcast_row_limit(spark) if limit is None else limit
    width = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    seen = df.limit(limit + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return seen[0] <= limit and seen[1] <= broadcast_byte_limit(spark)


def broadcast_if_small(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Mark ``df`` for broadcast only after measuring that it is small.

    Beyond the limits the join is left to Catalyst and AQE (shuffle, skew splitting).
    """
    return F.broadcast(df) if _is_small(df, limit) else df


def join_lookup(
    facts: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    limit: int | None = None,
    computed: bool = False,
) -> DataFrame:
    """Join rows to a one-row-per-key lookup: broadcast when small, salted when hot.

    ``computed`` says that the lookup is itself a result over large input: it is written
    once, so that measuring it does not run that input a second time.
    """
    if computed:
        lookup = materialise(lookup)
    if _is_small(lookup, limit):
        return facts.join(F.broadcast(lookup), list(keys), how)
    return salted_join(facts, lookup, keys, how)


def hot_keys(df: DataFrame, keys: Sequence[str], limit: int | None = None) -> DataFrame:
    """Keys with more than ``limit`` rows and the number of salts each needs.

    At most rows / limit keys can pass, so the table is small by construction.
    """
    limit = group_row_limit(df.sparkSession) if limit is None else limit
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") > limit)
        .select(*keys, F.ceil(F.col("_rows") / F.lit(limit)).cast("int").alias("_salts"))
    )


def salted_join(
    facts: DataFrame, other: DataFrame, keys: Sequence[str], how: str = "inner", limit: int | None = None
) -> DataFrame:
    """Shuffle join in which rows of hot keys on the ``facts`` side are spread.

    Rows with a NULL key have no match and take no part in the shuffle. If there are hot keys, ``facts`` is written once
    and its rows draw a salt from their place in these files: equal rows and rows of any column type spread
    alike, and a task that is run again draws the same salts. The few matching rows of ``other`` are repeated
    once per salt, so every salt finds them. ``how`` may be inner, left, left_semi or left_anti.
    """
    keys = list(keys)
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    hot = materialise(hot_keys(facts.where(known), keys, limit))
    if hot.isEmpty():
        met = facts.where(known).join(other.where(known), keys, how)
    else:
        facts = stored(facts, "salted")
        hot = broadcast_if_small(hot)
        salts = F.coalesce(F.col("_salts"), F.lit(1)).cast("long")
        place = facts.where(known).withColumn("_salt", F.monotonically_increasing_id())
        spread = place.join(hot, keys, "left").withColumn("_salt", F.pmod("_salt", salts)).drop("_salts")
        repeated = other.where(known).join(hot, keys, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1))).drop("_salts")
        met = spread.join(repeated, [*keys, "_salt"], how).drop("_salt")
    if how in ("left", "left_anti"):
        return met.unionByName(facts.where(~known), allowMissingColumns=True)
    return met


def rows_with_keys(df: DataFrame, keys: DataFrame, on: Sequence[str], keep: bool = True) -> DataFrame:
    """Keep (or drop) the rows whose key is listed; the key list is deduplicated first."""
    how = "left_semi" if keep else "left_anti"
    return join_lookup(df, keys.select(*on).distinct(), on, how, computed=True)


def tables_with_keys(frames: Sequence[DataFrame], keys: DataFrame, on: Sequence[str]) -> list[DataFrame]:
    """Keep, in every table, the rows whose key is listed.

    The key list is a table that is already written; it is measured once for all tables. Repeats in it do no harm.
    """
    small = bool(frames) and _is_small(keys.select(*on), None)
    met = (lambda df: df.join(F.broadcast(keys.select(*on)), list(on), "left_semi")) if small else (lambda df: salted_join(df, keys.select(*on), on, "left_semi"))
    return [met(df) for df in frames]

"""Leakage-free splits by record and their checks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions import text
from pulsegrid.operators.filters import development_member
from pulsegrid.plans.joins import join_lookup
from pulsegrid.plans.ordered import with_ordinal

PROTOCOLS = ("official", "subject_independent")


def is_test(record: Column, protocol: str = "official") -> Column:
    """Test membership of a record: by prefix, or by absence from the development set."""
    if protocol == "official":
        return text.dataset_split(record) == "test"
    if protocol == "subject_independent":
        return ~development_member(record)
    raise ValueError(f"unknown split protocol: {protocol}")


def group_folds(
    df: DataFrame, k: int = 5, seed: int = 42, group: str = "recording_id", y: str = "y", limit=None
) -> DataFrame:
    """One fold per group: groups in order of class rate, dealt out round robin.

    Ties follow a hash of seed and group, so the result depends on nothing else.
    """
    rates = df.groupBy(group).agg(F.avg(F.col(y).cast("double")).alias("rate"), F.count(F.lit(1)).alias("n"))
    tie = F.md5(F.concat(F.lit(f"{seed}|"), F.col(group).cast("string")))
    dealt = with_ordinal(rates.withColumn("_tie", tie), [], [F.round("rate", 9), "_tie", group], "_place", limit)
    return dealt.select(group, (F.col("_place") % k).cast("int").alias("fold"))


def group_stratified_split(
    df: DataFrame, k: int = 5, seed: int = 42, protocol: str = "official", group: str = "recording_id", y: str = "y",
    limit=None,
) -> DataFrame:
    """Add ``model_split``: test by protocol, fold 0 of the rest is val, the other folds train."""
    test = is_test(F.col(group), protocol)
    folds = group_folds(df.where(~test), k, seed, group, y, limit)
    joined = join_lookup(df, folds, [group], computed=True)
    name = F.when(test, "test").when(F.col("fold") == 0, "val").when(F.col("fold").isNotNull(), "train").otherwise("unused")
    return joined.withColumn("model_split", name).drop("fold")


def split_assignments(df: DataFrame, group: str = "recording_id", start: str = "window_start", y: str = "y") -> DataFrame:
    """Record, start, class, data set split and model split of every window."""
    return df.select(
        group, start, y, text.dataset_split(F.col(group)).alias("dataset_split"), "model_split"
    )


def split_summary(df: DataFrame, split: str = "model_split", group: str = "recording_id", y: str = "y") -> DataFrame:
    """Windows, records and class counts per split.

    Records are counted on distinct (split, record) pairs, so one hot record is one row.
    """
    per_record = df.groupBy(split, group).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum((F.col(y) == 0).cast("long")).alias("n0"),
        F.sum((F.col(y) == 1).cast("long")).alias("n1"),
    )
    return per_record.groupBy(split).agg(
        F.sum("n").alias("windows"),
        F.count(F.lit(1)).alias("recordings"),
        F.sum("n0").alias("normal_windows"),
        F.sum("n1").alias("apnea_windows"),
        (100.0 * F.sum("n1") / F.sum("n")).alias("apnea_pct"),
    )


def split_leakage(
    df: DataFrame, split: str = "model_split", group: str = "recording_id", names: Sequence[str] = ("train", "val", "test")
) -> DataFrame:
    """Records shared by each pair of splits; all numbers must be 0."""
    held = df.where(F.col(split).isin(*names)).groupBy(group).agg(F.collect_set(split).alias("s"))
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
    counts = held.agg(
        *[
            F.coalesce(
                F.sum((F.array_contains("s", a) & F.array_contains("s", b)).cast("long")), F.lit(0)
            ).alias(f"{a}_{b}_overlap")
            for a, b in pairs
        ]
    )
    cells = [F.struct(F.lit(f"{a}_{b}_overlap").alias("pair"), F.col(f"{a}_{b}_overlap").alias("n")) for a, b in pairs]
    return counts.select(F.inline(F.array(*cells)))


def assert_no_leakage(df: DataFrame, **names) -> None:
    bad = split_leakage(df, **names).where("n > 0").collect()
    if bad:
        raise ValueError(f"records shared between splits: {[(r['pair'], r['n']) for r in bad]}")


def dataset_sanity(
    df: DataFrame, samples: str = "n_samples", y: str = "y", split: str = "split", group: str = "recording_id"
) -> DataFrame:
    """Totals, sample count range, class and split counts as (check, key, n, records)."""
    per_record = df.groupBy(split, group, y).agg(
        F.count(F.lit(1)).alias("n"), F.min(samples).alias("lo"), F.max(samples).alias("hi")
    )
    none = F.lit(None).cast("long")
    text_none = F.lit(None).cast("string")
    whole = per_record.agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    row = lambda check, key, n, rec: F.struct(
        F.lit(check).alias("check"), key.alias("key"), n.cast("long").alias("n"), rec.alias("records")
    )
    first = whole.select(
        F.inline(F.array(row("total_windows", text_none, F.col("n"), none), row("min_samples", text_none, F.col("lo"), none),
                         row("max_samples", text_none, F.col("hi"), none)))
    )
    classes = per_record.groupBy(F.col(y).cast("string").alias("key")).agg(F.sum("n").alias("n")).select(
        F.lit("class").alias("check"), "key", "n", none.alias("records")
    )
    splits = per_record.groupBy(split, group).agg(F.sum("n").alias("n")).groupBy(F.col(split).alias("key")).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("records")
    ).select(F.lit("split").alias("check"), "key", "n", "records")
    return reduce(DataFrame.unionByName, [first, classes, splits])

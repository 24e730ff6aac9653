"""Shared helpers: written intermediate tables, inputs, whole words."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.session import scratch_path

#: Words are maximal runs of anything but space, tab, line feed, vertical tab, form feed and
#: carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """A public tokenizer's file: in the folder that PULSEGRID_TOKENIZERS names, else the installed one."""
    folder = os.environ.get("PULSEGRID_TOKENIZERS", "/opt/tokenizers")
    return f"{folder}/{name}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Later passes see the same rows, lineage ends at files that survive a lost executor, and
    Parquet keeps column pruning.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def utf8(column: str | Column) -> Column:
    """The bytes of a text, which go to Python without being decoded."""
    return (F.col(column) if isinstance(column, str) else column).cast("binary")


def n_words(column: str | Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(column, F.lit(WORD)), F.lit(0)).cast("long")


def pieces(sizes: Iterable[int], limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of rows whose sizes sum to ``limit`` at most (one row at least)."""
    start = total = 0
    at = 0
    for at, size in enumerate(sizes):
        if at > start and total + size > limit:
            yield start, at
            start, total = at, 0
        total += size
        at += 1
    if at > start:
        yield start, at


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indexes start, start + 1, ... for each (start, length), one after another."""
    lengths = np.asarray(lengths, dtype=np.int64)
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    ends = np.cumsum(lengths)
    return np.repeat(np.asarray(starts, dtype=np.int64) - (ends - lengths), lengths) + np.arange(total)

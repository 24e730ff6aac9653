"""Bloom filter cascades: exact membership of listed keys over a corpus's key universe.

Level 0 encodes the listed keys. Level 1 encodes the keys of the universe that level 0 lets
pass wrongly, level 2 the listed keys that level 1 lets pass, and so on until a level lets
nothing pass wrongly. A key of the universe is looked up by walking the levels until one
rejects it: the parity of that level tells whether it is listed. No join is needed, and for
every key of the universe the answer is exact.

Sizes: level 0 has a false positive rate of listed / (universe * sqrt 2) and the later ones
one half, so every later level holds fewer keys than the list does; the filter grows with the
list, not with the corpus. Keys take part as 128-bit hashes.

Defined cases: null urls and urls without ``://`` have an empty host and path and no keys; an
empty list or universe gives a cascade without levels, which lists nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import written

MAX_LEVELS = 64
#: Largest filter that is sent to the executors.
MAX_FILTER_BYTES = 256 << 20


@dataclass
class Cascade:
    """``levels``: (bits as bytes, number of bits, number of probes), outermost first."""

    levels: list[tuple[np.ndarray, int, int]] = field(default_factory=list)

    def contains(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Is each key, given as its two 64-bit hashes, listed?"""
        listed = np.zeros(len(a), dtype=bool)
        alive = np.arange(len(a))
        for depth, (bits, size, probes) in enumerate(self.levels):
            passed = probe(bits, size, probes, depth, a[alive], b[alive])
            listed[alive[~passed]] = depth % 2 == 1
            alive = alive[passed]
        listed[alive] = len(self.levels) % 2 == 1
        return listed


def positions(size: int, probes: int, depth: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bit numbers (keys x probes) by double hashing, different on every level."""
    a, b = a.astype(np.uint64), b.astype(np.uint64) | np.uint64(1)
    with np.errstate(over="ignore"):
        start = (a ^ np.uint64(0x9E3779B97F4A7C15 * (depth + 1) & (2**64 - 1))) * np.uint64(0xBF58476D1CE4E5B9)
        start ^= start >> np.uint64(31)
        steps = np.arange(probes, dtype=np.uint64)
        return (start[:, None] + steps * b[:, None]) % np.uint64(size)


def probe(bits: np.ndarray, size: int, probes: int, depth: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    at = positions(size, probes, depth, a, b)
    return ((bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1)


def _filter(keys: DataFrame, n: int, rate: float, depth: int) -> tuple[np.ndarray, int, int]:
    """A Bloom filter of ``n`` keys; tasks send the 64-bit words they set, not the keys."""
    size = max(64, math.ceil(-n * math.log(rate) / math.log(2) ** 2))
    probes = max(1, round(size / n * math.log(2)))
    if size // 8 > MAX_FILTER_BYTES:
        raise ValueError(f"a filter of {size // 8} bytes is over the limit of {MAX_FILTER_BYTES}; split the list")

    def bits_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at = np.unique(positions(size, probes, depth, batch["_a"].to_numpy(), batch["_b"].to_numpy()))
            word, first = np.unique(at >> np.uint64(6), return_index=True)
            bit = np.uint64(1) << (at & np.uint64(63))
            if len(at):
                yield pd.DataFrame({"word": word.astype(np.int64), "bits": np.bitwise_or.reduceat(bit, first).astype("<u8").view(np.int64)})

    words = keys.mapInPandas(bits_of, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    found = words.toPandas()  # at most twice as many bytes as the filter has
    bits = np.zeros((size + 63) // 64, dtype="<u8")
    bits[found["word"].to_numpy(dtype=np.int64)] = found["bits"].to_numpy(dtype=np.int64).view(np.uint64)
    return bits.view(np.uint8)[: (size + 7) // 8], size, probes


def build_cascade(listed: DataFrame, universe: DataFrame) -> Cascade:
    """Cascade of the string column ``key`` of ``listed`` over that of ``universe``.

    Keys of the list that the universe lacks are put into it. The one pass that tells listed
    from unlisted keys is an aggregation by key.
    """
    marked = universe.select("key", F.lit(False).alias("on")).unionByName(listed.select("key", F.lit(True).alias("on")))
    keys = written(
        marked.where(F.col("key").isNotNull())
        .groupBy("key")
        .agg(F.max("on").alias("on"))
        .select(F.xxhash64("key").alias("_a"), F.xxhash64("key", F.lit(1)).alias("_b"), "on"),
        "cascade-keys",
    )
    sizes = {r["on"]: r["n"] for r in keys.groupBy("on").agg(F.count(F.lit(1)).alias("n")).collect()}
    inside, outside = keys.where("on"), keys.where("NOT on")
    cascade = Cascade()
    n, rate = sizes.get(True, 0), 0.5
    if n and sizes.get(False, 0):
        rate = min(0.5, n / (math.sqrt(2) * sizes[False]))
    while n:
        depth = len(cascade.levels)
        if depth == MAX_LEVELS:
            raise ValueError("two keys share a 128-bit hash, or the levels do not shrink")
        level = _filter(inside, n, rate, depth)
        cascade.levels.append(level)
        inside, outside = written(_passing(outside, level, depth), "cascade-level"), inside
        n, rate = inside.count(), 0.5
    return cascade


def _passing(keys: DataFrame, level: tuple[np.ndarray, int, int], depth: int) -> DataFrame:
    sent = keys.sparkSession.sparkContext.broadcast(level)

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[probe(*sent.value, depth, batch["_a"].to_numpy(), batch["_b"].to_numpy())]

    return keys.mapInPandas(keep, keys.schema)


def listed_flag(cascade: Cascade, keys: Column, spark) -> Column:
    """For each element of an array of keys: is it listed? Exact for keys of the universe."""
    sent = spark.sparkContext.broadcast(cascade)

    @F.pandas_udf("array<boolean>")
    def look_up(a: pd.Series, b: pd.Series) -> pd.Series:
        counts = a.map(len).to_numpy()
        if not counts.sum():
            return pd.Series([np.zeros(0, dtype=bool)] * len(a), index=a.index)
        flags = sent.value.contains(np.concatenate(a.to_numpy()).astype(np.int64), np.concatenate(b.to_numpy()).astype(np.int64))
        return pd.Series(np.split(flags, np.cumsum(counts)[:-1]), index=a.index)

    return look_up(F.transform(keys, lambda k: F.xxhash64(k)), F.transform(keys, lambda k: F.xxhash64(k, F.lit(1))))


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty if null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), path


def candidate_keys(host: Column, path: Column, lengths: Sequence[int]) -> Column:
    """Host suffixes (at label borders) joined with the path's prefixes of the given lengths."""
    labels = F.split(host, "\\.", -1)
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    prefixes = F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in sorted(set(lengths))])
    prefixes = F.filter(prefixes, lambda p: p.isNotNull())
    pairs = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))
    return F.when(host != "", F.array_distinct(pairs)).otherwise(F.array().cast("array<string>"))


def split_rule(rule: str) -> tuple[str, str]:
    host, slash, path = rule.partition("/")
    return host.lower(), slash + path


def judge_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]],
    listed: DataFrame,
    key: str = "page_id",
) -> DataFrame:
    """key, host, path, rule, verdict, listed_key for every url.

    ``rules``: (verdict, ``host/path``), which fit a host and its subdomains and paths that
    start with the rule's; the longest fitting rule decides, the longer host on ties. Where no rule
    fits, a url is blocked if its host or a parent domain is on the list (column ``host``).
    Rules and list are both looked up through cascades over the corpus's keys: one for the
    rules of each verdict, one for the list.
    """
    spark = pages.sparkSession
    host, path = url_parts(F.col("url"))
    parts = pages.select(key, host.alias("host"), path.alias("path"))
    lengths = sorted({len(split_rule(r)[1]) for _, r in rules})
    ruled = candidate_keys(F.col("host"), F.col("path"), lengths)
    domains = candidate_keys(F.col("host"), F.lit(""), [0])
    hosts = parts.select("host").distinct()
    # a rule's path is one of few prefixes: the universe needs each host with each prefix once
    prefixes = parts.select("host", F.substring("path", 1, max([0, *lengths])).alias("path")).distinct()
    rule_universe = prefixes.select(F.explode(ruled).alias("key")).distinct()
    host_universe = hosts.select(F.explode(domains).alias("key")).distinct()

    def rule_keys(verdict: str) -> DataFrame:
        keys = ["".join(split_rule(r)) for v, r in rules if v == verdict]
        return spark.createDataFrame([(k,) for k in keys], "key string")

    verdicts = sorted({v for v, _ in rules})
    cascades = {v: build_cascade(rule_keys(v), rule_universe) for v in verdicts}
    on_list = build_cascade(listed.select(F.lower("host").alias("key")), host_universe)

    named = parts.withColumns({"_rule_keys": ruled, "_domains": domains})
    named = named.withColumns(
        {f"_on_{v}": listed_flag(c, F.col("_rule_keys"), spark) for v, c in cascades.items()}
        | {"_on_list": listed_flag(on_list, F.col("_domains"), spark)}
    )

    def hits_of(verdict: str) -> Column:
        zipped = F.arrays_zip(F.col("_rule_keys").alias("k"), F.col(f"_on_{verdict}").alias("on"))
        return F.transform(
            F.filter(zipped, lambda x: x["on"]),
            lambda x: F.struct(
                F.length(x["k"]).alias("n"), F.instr(x["k"], "/").alias("h"), x["k"].alias("rule"), F.lit(verdict).alias("verdict")
            ),
        )

    hits = [hits_of(v) for v in verdicts]
    best = F.array_max(F.concat(*hits)) if hits else F.lit(None).cast("struct<rule:string,verdict:string>")
    found = F.filter(F.arrays_zip(F.col("_domains").alias("k"), F.col("_on_list").alias("on")), lambda x: x["on"])
    judged = named.withColumns({"_best": best, "listed_key": F.get(F.transform(found, lambda x: x["k"]), F.lit(0))})
    return judged.select(
        key,
        "host",
        "path",
        F.col("_best.rule").alias("rule"),
        F.coalesce(F.col("_best.verdict"), F.when(F.col("listed_key").isNotNull(), "block").otherwise("allow")).alias("verdict"),
        "listed_key",
    )

"""Quality rules with risk-controlled thresholds.

Each rule rejects a document whose score is over a cutoff. The cutoffs are not set by hand: on
labelled documents, for each rule and stratum, the number of good documents that a cutoff would
reject is binomial, and the cutoff is safe if the exact upper (Clopper-Pearson) bound of that
share is no more than the allowed rate of false rejection.

Multiple testing: each (rule, stratum) is tested at delta / (rules x strata) (Bonferroni), and
inside it the cutoffs are tested from the highest down until the first one fails (fixed
sequence), so all that passed are safe together with probability 1 - delta. Each rule gets an
equal share of the allowed rate, so the union of the rules keeps it in every stratum. Among the
safe cutoffs the one is taken that rejects most bad documents, a good one counting as
``GOOD_WEIGHT`` bad ones; the middle one of equals. A rule without a safe cutoff that rejects
anything is off in that stratum.

The labelled documents are all documents with a label (every row takes part); only counts by
(rule, stratum, cutoff, label) reach the driver, at most rules x strata x cutoffs x 2 numbers.

Defined cases: null and blank texts have no words and fail the base rule; documents that pass
the base rule and whose stratum has no safe cutoff are kept; labels that are null, repeated or
without a document do no harm (a document is good or bad once, bad only if no label calls it good);
repeated documents give repeated rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import utf8, written

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
#: Bad documents that must be caught for one good document lost.
GOOD_WEIGHT = 10
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MEASURES = (*BASE, "n_lines")


def measure(text: bytes | None) -> tuple[int, ...]:
    """The counts named in ``MEASURES`` of a whole text."""
    if not text:
        return (0,) * len(MEASURES)
    words = text.split()
    n = len(words)
    solid = b"".join(words)
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    counts = Counter(windows)
    if len(counts) < len(windows):
        many = np.fromiter((counts[w] > 1 for w in windows), dtype=bool, count=len(windows))
        covered = np.zeros(n, dtype=bool)
        for shift in range(3):
            covered[shift : n - 2 + shift] |= many
        repeated = int(covered.sum())
    return n, len(solid.decode("utf-8", "replace")), symbols, len(lines) - len(set(lines)), repeated, len(lines)


def _measure_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = np.array([measure(x.as_py()) for x in batch.column(1)], dtype=np.int64).reshape(-1, len(MEASURES))
        yield pa.record_batch([batch.column(0), *map(pa.array, made.T)], names=["doc_id", *MEASURES])


def measures(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("text"))
    return rows.mapInArrow(_measure_batches, "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


#: Scores; a document is rejected if one is over its cutoff.
RULES: Mapping[str, tuple[str, str]] = {
    "symbols": ("n_symbols", "n_words"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
}
#: Candidate cutoffs of each rule, lowest first.
CUTOFFS: Mapping[str, tuple[float, ...]] = {
    "symbols": tuple(round(0.02 * 1.35**i, 4) for i in range(16)),
    "dup_lines": tuple(round(0.05 * i, 2) for i in range(1, 17)),
    "repeats": tuple(round(0.03 * i, 2) for i in range(1, 17)),
}
#: Strata by number of words: a document is in the last one whose bound it reaches.
STRATA = (0, 300)


def stratum() -> Column:
    found = F.lit(0)
    for i, bound in enumerate(STRATA):
        found = F.when(F.col("n_words") >= bound, i).otherwise(found)
    return found


def score(rule: str) -> Column:
    """Share named by the rule; zero where there is nothing to divide by."""
    part, whole = RULES[rule]
    return F.coalesce(F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double")), F.lit(0.0))


def _terms(k: int, n: int, p: float, step: int) -> float:
    """Sum of the binomial probabilities of k, k + step, ..., going away from the mean, until they no longer count."""
    term = math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p))
    total = 0.0
    while 0 <= k <= n and term > total * 1e-17:
        total += term
        term *= k / (n - k + 1) * (1 - p) / p if step < 0 else (n - k) / (k + 1) * p / (1 - p)
        k += step
    return total


def binomial_cdf(k: int, n: int, p: float) -> float:
    """P(Bin(n, p) <= k): the tail on k's side of the mean, in about sqrt(n) steps."""
    if k >= n or p <= 0:
        return 1.0
    if k < 0 or p >= 1:
        return 0.0
    return _terms(k, n, p, -1) if k <= n * p else 1.0 - _terms(k + 1, n, p, 1)


def is_safe(rejected: int, good: int, rate: float, level: float) -> bool:
    """Is the exact upper bound of the rejected share, at the level, no more than ``rate``?"""
    return good > 0 and binomial_cdf(rejected, good, rate) <= level


@dataclass(frozen=True)
class Thresholds:
    """(rule, stratum) -> cutoff, for the rules that are on."""

    cutoffs: Mapping[tuple[str, int], float]

    def rejects(self) -> Column:
        found = F.lit(False)
        for (rule, at), cutoff in sorted(self.cutoffs.items()):
            found = found | ((stratum() == at) & (score(rule) > cutoff))
        return found


def fit_thresholds(measured: DataFrame, labels: DataFrame, rate: float = 0.05, delta: float = 0.05) -> Thresholds:
    """Cutoffs from documents that pass the base rule and have a label (column ``quality``)."""
    told = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("quality").alias("good"))
    )
    held = measured.where(~base_failed()).join(told, "doc_id")
    levels = [_level(rule) for rule in RULES]
    counts = (
        held.select("good", stratum().alias("stratum"), *levels)
        .select("good", "stratum", F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("over")) for r in RULES])).alias("x"))
        .groupBy("stratum", "x.rule", "x.over", "good")
        .count()
        .collect()
    )
    tally: dict[tuple[str, int, int], np.ndarray] = {}
    for r in counts:
        key = (r["rule"], r["stratum"], int(r["good"] > 0))
        tally.setdefault(key, np.zeros(len(CUTOFFS[r["rule"]]) + 1, dtype=np.int64))[r["over"]] += r["count"]
    level = delta / (len(STRATA) * len(RULES))
    chosen = {}
    for rule, candidates in CUTOFFS.items():
        for at in range(len(STRATA)):
            none = np.zeros(len(candidates) + 1, dtype=np.int64)
            good, bad = tally.get((rule, at, 1), none), tally.get((rule, at, 0), none)
            gains = {}
            for i in reversed(range(len(candidates))):
                rejected = int(good[i + 1 :].sum())
                if not is_safe(rejected, int(good.sum()), rate / len(RULES), level):
                    break
                gains[i] = int(bad[i + 1 :].sum()) - GOOD_WEIGHT * rejected
            best = max(gains.values(), default=0)
            if best > 0:
                equals = sorted(i for i, gain in gains.items() if gain == best)
                chosen[rule, at] = candidates[equals[len(equals) // 2]]
    return Thresholds(chosen)


def _level(rule: str) -> Column:
    """How many of the rule's cutoffs the score is over."""
    s = score(rule)
    total = F.lit(0)
    for c in CUTOFFS[rule]:
        total = total + (s > c).cast("int")
    return total.alias(rule)


def judge_quality(docs: DataFrame, labels: DataFrame, rate: float = 0.05, delta: float = 0.05) -> DataFrame:
    """doc_id, the base counts, base_failed and kept for every document."""
    measured = written(measures(docs), "measures")
    thresholds = fit_thresholds(measured, labels, rate, delta)
    return measured.select("doc_id", *BASE, base_failed().alias("base_failed"), (~base_failed() & ~thresholds.rejects()).alias("kept"))

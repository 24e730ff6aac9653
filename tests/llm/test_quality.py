import math
import re
from collections import Counter

import pytest

from pulsegrid.llm import quality

SF = "/root/testdata/sf0.01"


def plain(text):
    """The contract's counts, position by position."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    at = {}
    for i in range(len(words) - 2):
        at.setdefault(tuple(words[i : i + 3]), []).append(i)
    covered = {i + k for where in at.values() if len(where) > 1 for i in where for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


ODD = [None, "", " \n\t ", "a", "a b c a b c", "x x x x x", "é ü|ß\n\né ü|ß\n", "#*$%&|<>", "l\nl \nl\n \n ", "w " * 30_000, "a\x1cb \x0bc"]


@pytest.mark.parametrize("text", ODD)
def test_measures_of_odd_texts(text):
    assert quality.measure(None if text is None else text.encode())[:5] == plain(text)


def test_query_counts_every_document(spark):
    from pulsegrid.llm.queries import QUERIES

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op9_risk_controlled_rules"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        counts = plain(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        assert r.base_failed == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
        assert not (r.base_failed and r.kept)


def test_exact_bound():
    want = sum(math.comb(40, k) * 0.1**k * 0.9 ** (40 - k) for k in range(3))
    assert quality.binomial_cdf(2, 40, 0.1) == pytest.approx(want, rel=1e-12)
    assert quality.is_safe(0, 299, 0.01, 0.05) and not quality.is_safe(0, 298, 0.01, 0.05)
    assert not quality.is_safe(0, 0, 0.5, 0.5)


def test_binomial_tails_stop_early():
    import time

    start = time.time()
    for k, n, p in ((0, 5, 0.3), (3, 5, 0.3), (5, 5, 0.3), (40, 100, 0.5), (60, 100, 0.5), (90, 100, 0.5)):
        want = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert quality.binomial_cdf(k, n, p) == pytest.approx(want, rel=1e-9)
    assert 0.4 < quality.binomial_cdf(1_666_000, 100_000_000, 0.01666) < 0.6 and quality.binomial_cdf(0, 10**8, 0.5) == 0.0
    assert time.time() - start < 2


def test_verdicts_equal_a_brute_force_fit(spark):
    """sf0.1, where cutoffs are on: every (rule, stratum) by a plain scan of all labelled documents."""
    from pulsegrid.llm.queries import QUERIES

    sf = "/root/testdata/sf0.1"
    rows = QUERIES["op9_risk_controlled_rules"](spark, sf).collect()
    lines = {r.doc_id: sum(1 for x in (r.text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r.quality is not None}
    share = lambda a, b: a / b if b else 0.0
    scores = {r.doc_id: {"symbols": share(r.n_symbols, r.n_words), "dup_lines": share(r.n_dup_lines, lines[r.doc_id]), "repeats": share(r.n_repeat_words, r.n_words)} for r in rows}
    held = [(r.doc_id, int(r.n_words >= 300)) for r in rows if not r.base_failed and r.doc_id in labels]
    limit = {}
    for rule, cutoffs in quality.CUTOFFS.items():
        for at in (0, 1):
            good = [scores[d][rule] for d, s in held if s == at and labels[d]]
            bad = [scores[d][rule] for d, s in held if s == at and not labels[d]]
            gains = {}
            for c in reversed(cutoffs):
                k = sum(x > c for x in good)
                p = 0.05 / 3
                tail = sum(math.exp(math.lgamma(len(good) + 1) - math.lgamma(i + 1) - math.lgamma(len(good) - i + 1) + i * math.log(p) + (len(good) - i) * math.log1p(-p)) for i in range(k + 1))
                if not good or tail > 0.05 / 6:
                    break
                gains[c] = sum(x > c for x in bad) - 10 * k
            best = max(gains.values(), default=0)
            if best > 0:
                equal = sorted(c for c, g in gains.items() if g == best)
                limit[rule, at] = equal[len(equal) // 2]
    assert limit
    rejected = 0
    for r in rows:
        over = any(scores[r.doc_id][rule] > c for (rule, at), c in limit.items() if at == int(r.n_words >= 300))
        assert r.kept == (not r.base_failed and not over)
        rejected += not r.base_failed and over
    assert rejected > 100


def labelled(spark, n_good, n_bad, good_symbols=0):
    words = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(words) + (" ###" * 30 if i < good_symbols else "")) for i in range(n_good)]
    docs += [(n_good + i, " ".join(words) + " ###" * 30) for i in range(n_bad)]
    labels = [(i, int(i < n_good)) for i in range(n_good + n_bad)]
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_cutoffs_need_evidence(spark):
    """No rule without enough good documents; none that rejects too many of them."""
    for n_good, lost, on in ((1000, 0, True), (20, 0, False), (1000, 40, False)):
        docs, labels = labelled(spark, n_good, 100, lost)
        cutoffs = quality.fit_thresholds(quality.measures(docs), labels).cutoffs
        assert (("symbols", 0) in cutoffs) == on
        if on:
            kept = Counter(r.kept for r in quality.judge_quality(docs, labels).collect())
            assert kept == {True: 1000, False: 100}


def test_empty_tables_and_null_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (None, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(None, 1), (1, None), (7, 0), (1, 1), (1, 0)], "doc_id long, quality int")
    rows = quality.judge_quality(docs, labels).collect()
    assert sorted((r.n_words, r.kept) for r in rows) == [(0, False), (2, False)]
    assert quality.judge_quality(docs.limit(0), labels.limit(0)).count() == 0

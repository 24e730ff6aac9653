import hashlib
import math
import re
import zlib

import numpy as np
import pytest

from pulsegrid.llm import resampling

SF = "/root/testdata/sf0.01"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def features(text, order=1):
    words = re.findall(WORD, lower(text or ""))
    return len(words), [" ".join(words[i : i + k]) for k in range(1, order + 1) for i in range(len(words) - k + 1)]


def brute(docs, target, order=1, buckets=10_000, percent=10, min_words=20, seed="2024"):
    """(doc_id, n_features, weight, score, rank) of every document, straight from the contract."""
    cells = lambda text: [zlib.crc32(f.encode()) % buckets for f in features(text, order)[1]]
    s, t = np.zeros(buckets, int), np.zeros(buckets, int)
    for _, text in docs:
        np.add.at(s, cells(text), 1)
    for text in target:
        np.add.at(t, cells(text), 1)
    S, T = int(s.sum()), int(t.sum())
    rows = []
    for doc_id, text in docs:
        got = [
            math.floor(1000 * math.log((float(t[b] + 1) * float(S + buckets)) / (float(s[b] + 1) * float(T + buckets))))
            for b in cells(text)
        ]
        weight = sum(got) // len(got) if got else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(got), weight, score, None, features(text)[0]])
    able = sorted((r for r in rows if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for rank, r in enumerate(able[: percent * len(able) // 100], 1):
        r[4] = rank
    return sorted((tuple(r[:5]) for r in rows), key=repr)


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def ours(found):
    return sorted((tuple(r) for r in found.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


def test_query_equals_brute_force(spark):
    from pulsegrid.llm.queries import QUERIES

    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("text").collect()]
    assert ours(QUERIES["op13_target_resampling"](spark, SF)) == brute(docs, target)


ODD = [None, "", "  \n", "A", "É é Ünï _ x__y", "a\x00b\x7fc{d}", "9 9 9", "日本語 テスト", "x" * 50, "ab " * 400]


@pytest.mark.parametrize("order", [1, 3])
def test_odd_texts_ties_and_repeated_rows(spark, order):
    docs = [(i % 13 if i % 7 else None, f"{ODD[i % len(ODD)] or ''} " + "Word tie " * (i % 30)) for i in range(200)]
    docs += [(500 + i, x) for i, x in enumerate(ODD)] + docs[:20]
    found = resampling.importance(frame(spark, docs), frame(spark, [("tie A",), (None,)], "text string"), order=order, percent=33)
    assert ours(found) == brute(docs, ["tie A", None], order=order, percent=33)


@pytest.mark.parametrize("order", [1, 2, 4])
def test_long_texts_are_read_in_parts(monkeypatch, order):
    """Cuts between parts neither split a word nor lose a window."""
    text = " ".join(f"w{i % 97}é" + "z" * (i % 40) for i in range(900)) + " " + "y" * 700 + "!" + "q" * 300
    want = sorted(zlib.crc32(f.encode()) % 10_000 for f in features(text, order)[1])
    for size in (1, 7, 64, 500, 1 << 20):
        monkeypatch.setattr(resampling.parts, "__defaults__", (size,))
        n, got = resampling.Buckets(order=order).features(text.encode())
        assert n == 902 and sorted(got.tolist()) == want


def test_split_groups_give_the_same_ranks(spark):
    docs = frame(spark, [(i, "same words here " * 8) for i in range(300)])
    target = frame(spark, [("words",)], "text string")
    plain = ours(resampling.importance(docs, target, percent=50))
    spark.conf.set("spark.pulsegrid.maxGroupRows", "1")
    try:
        assert ours(resampling.importance(docs, target, percent=50)) == plain
    finally:
        spark.conf.unset("spark.pulsegrid.maxGroupRows")


def test_empty_tables_and_whole_rows(spark):
    none = frame(spark, [])
    target = frame(spark, [("a b",)], "text string")
    assert resampling.importance(none, target).count() == 0
    docs = frame(spark, [(i, "a b c d e " * 5, i * 2) for i in range(40)], "doc_id long, text string, _pg_id int")
    assert resampling.importance(docs, target.limit(0)).where("rank is not null").count() == 4
    drawn = resampling.resample(docs, target, percent=25)
    assert drawn.columns == docs.columns and drawn.count() == 10

import zlib

import numpy as np
from pyspark.sql import functions as F

from pulsegrid.llm import langid


def brute_presence(text):
    """The set of hashed n-grams, one n-gram at a time."""
    t = f" {langid.folded_text(text)} "
    held = set()
    for n in langid.ORDERS:
        for i in range(len(t) - n + 1):
            code = 0
            for k in range(n):
                # the hash of n characters extends that of the first n - 1
                code = (code * 0x100000001B3 + ord(t[i + k]) + k + 1) % 2**64
            held.add((code * 0x9E3779B97F4A7C15 % 2**64) >> 50)
    return held


def test_presence_equals_brute_force():
    texts = ["Hello, wörld 12 and again hello", "", "x", "çéñ ß 漢字 🙂 end", "ab " * 500]
    rows = langid.presence_of_whole([langid.folded_text(t) for t in texts])
    for text, row in zip(texts, rows):
        assert set(np.flatnonzero(row).tolist()) == brute_presence(text)


def test_very_long_text_is_read_whole(monkeypatch):
    text = " ".join(f"word{i:x}q" for i in range(4000)) + " zürich"
    whole = langid.presence_of_whole([langid.folded_text(text)])
    monkeypatch.setattr(langid, "_CHARS", 1000)
    parts = langid.presence_of_whole([langid.folded_text(text), "another"])
    assert not (whole[0] & ~parts[0]).any()  # parts add blanks at their borders, nothing is lost
    assert (parts[0] & ~whole[0]).sum() <= 200


def test_kernel_is_shared_ngrams_over_geometric_mean():
    a, b = langid.presence_of_whole(["one two", "two three"])
    x, y = brute_presence("one two"), brute_presence("two three")
    assert np.isclose(langid.kernel(a[None], b[None])[0, 0], len(x & y) / (len(x) * len(y)) ** 0.5)


def test_held_out_accuracy(spark):
    from pulsegrid.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in QUERIES["op8_string_kernel_language"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    assert all(got[d.doc_id].held_out == (zlib.crc32(str(d.doc_id).encode()) % 3 == 1) for d in docs)
    assert all(0 <= r.score <= 1 for r in got.values())
    held = [d for d in docs if got[d.doc_id].held_out]
    assert sum(got[d.doc_id].lang_pred == d.lang for d in held) / len(held) > 0.98


def test_odd_rows(spark):
    rows = [(1, "the house and the garden", "en"), (3, "das haus und der garten", "de"), (4, None, "en"), (5, "", None), (6, "12 !? \n", "de"),
            (6, "12 !? \n", "de"), (None, "the garden and the house", None), (8, "x" * 700_000, None), (9, "und", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    got = sorted(((r.doc_id, r.lang_pred) for r in langid.identify_held_out(df).collect()), key=str)
    assert [x for x in got if x[1] == "und"] == [(4, "und"), (5, "und"), (6, "und"), (6, "und")]
    assert (None, "en") in got and len(got) == len(rows)


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [tuple(r)[2:] for r in langid.identify_held_out(df).collect()] == [("und", 0.0)]
    assert langid.identify_held_out(df.limit(0)).collect() == []


def test_number_signs_are_no_letters(spark):
    signs = ["25 ½", "10²", "①", "Ⅳ", "٣ 12 _"]
    assert not any(map(langid.has_letter, signs)) and all(map(langid.has_letter, ["½ a", "ª", "漢", "一", "ß²"]))
    assert all(any(map(str.isalpha, c)) == langid.has_letter(c) for c in map(chr, range(0x110000)))
    assert langid.folded_text("Ein ½ und 10² Ⅳ_x") == "ein und x"
    rows = [(0, "the house and the garden", "en"), (1, "das haus und der garten", "de"), *((i, t, "de") for i, t in enumerate(signs, 2))]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r.doc_id for r in langid.identify_held_out(df).collect() if r.lang_pred == "und"} == {2, 3, 4, 5, 6}
    assert {r.doc_id for r in langid.without_unknown_language(df).collect()} == {0, 1}


def test_parts_of_a_long_text_hold_its_ngrams_only(monkeypatch):
    texts = [langid.folded_text(" ".join(f"word{chr(97 + i % 26)}q{chr(97 + i // 26 % 26)}" for i in range(n))) for n in (0, 1, 700, 4000)]
    whole = langid.presence_of_whole(texts)
    for size in (7, 997, 1000, len(texts[2]), len(texts[2]) + 1):
        monkeypatch.setattr(langid, "_CHARS", size)
        assert (langid.presence_of_whole(texts) == whole).all()

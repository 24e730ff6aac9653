import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid.llm import pieces
from pulsegrid.llm.common import tokenizer_path
from pulsegrid.llm.queries import PIECE_MODEL

sentencepiece = pytest.importorskip("sentencepiece")
PATH = tokenizer_path(PIECE_MODEL)
#: A later field of a message replaces an earlier one: this makes the file a unigram model.
AS_UNIGRAM = b"\x12\x02\x18\x01"
ODD = ["", " ", "   a  b   ", " " * 100, "x" * 200, "\n\n \n", "▁▁a ▁", "<s> </s> <unk> <0x0A>", "漢字🙂 ñé", "\t\x00a", "a" + " " * 40 + "b", "word" * 400]


def data():
    with open(PATH, "rb") as file:
        return file.read()


@pytest.fixture(scope="module")
def model():
    return pieces.load_model(PATH)


def texts(n=400):
    rng = random.Random(5)
    kinds = ["abcdeinort \n éü漢", " a", "aàbcdefghijklmnopqrstuvwxyz    ", "".join(map(chr, range(33, 400))), "".join(map(chr, range(0x400, 0x500)))]
    return ODD + ["".join(rng.choice(k) for _ in range(rng.randint(1, 80))) for k in kinds for _ in range(n)]


def encoded(model, some):
    ids, counts = pieces.Encoder(model).encode(some)
    return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])], ids, counts


def test_bpe_equals_library(model):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    some = texts()
    got, ids, counts = encoded(model, some)
    want = library.encode(some)
    assert got == want
    assert pieces.decode(model, ids, counts) == [library.decode(x) for x in want]


def test_unigram_equals_library():
    """The same pieces and scores as a unigram model: sums of scores decide."""
    model = pieces.read_model(data() + AS_UNIGRAM)
    assert model.kind == pieces.UNIGRAM
    library = sentencepiece.SentencePieceProcessor(model_proto=data() + AS_UNIGRAM)
    some = [t for t in texts(200) if "▁▁" not in t and "  " not in t]

    def total(ids):
        return sum(model.scores[i] if model.kinds[i] == pieces.NORMAL else 0 for i in ids)

    for text, ids in zip(some, encoded(model, some)[0]):
        want = library.encode(text)
        assert ids == want or (len(ids) > 0 and total(ids) == pytest.approx(total(want))), text


def test_unigram_equals_all_segmentations():
    scores = {"a": -1.0, "b": -1.5, "ab": -2.2, "ba": -2.0, "aba": -3.1, "▁": -0.5, "▁a": -1.2}
    names = ["<unk>", *scores]
    model = pieces.PieceModel(names, np.array([0.0, *scores.values()]), np.array([pieces.UNKNOWN] + [pieces.NORMAL] * len(scores)), pieces.UNIGRAM, True)
    for n in range(1, 7):
        for letters in itertools.product("ab", repeat=n):
            word = "▁" + "".join(letters)
            best = max(
                sum(scores.get(word[i:j], -99) for i, j in zip(cut, cut[1:]))
                for k in range(len(word))
                for inner in itertools.combinations(range(1, len(word)), k)
                for cut in [(0, *inner, len(word))]
            )
            ids, counts = model.encode_words([word])
            assert sum(model.scores[i] for i in ids) == pytest.approx(best)
            assert model.search_one(word).tolist() == ids.tolist()


def test_long_words_and_forgotten_words(model, monkeypatch):
    some = ODD + ["abcdefgh" * 30, "abc def ghi"]
    want = encoded(model, some)[0]
    monkeypatch.setattr(pieces, "LONG_WORD", 2)
    monkeypatch.setattr(pieces, "_CACHED_WORDS", 1)
    encoder = pieces.Encoder(model)
    assert [encoder.encode([t])[0].tolist() for t in some] == want


def test_documents(spark, model):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(3, None), (None, "no id"), (3, "twice"), (3, "twice")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("token_ids", F.lit("clash"))
    made = pieces.encode_documents(docs, model)
    got = made.collect()
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    want = [(d, None if t is None else library.encode(t)) for d, t in rows]
    assert sorted(((r.doc_id, r.token_ids) for r in got), key=str) == sorted(want, key=str)
    assert all(r.n_tokens == len(r.token_ids or []) for r in got)
    assert [r.doc_id for r in got if not r.round_trip] == [6]  # the word mark itself
    back = sorted(((r.doc_id, r.text) for r in pieces.decode_documents(made, model).collect()), key=str)
    assert back == sorted(((d, t and t.replace("▁", " ")) for d, t in rows), key=str)
    assert pieces.encode_documents(docs.limit(0), model).count() == 0


def test_query_equals_library(spark):
    from pulsegrid.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op3_sentencepiece_viterbi"](spark, sf).collect()
    assert {r.doc_id: r.token_ids for r in rows} == {d: library.encode(t) for d, t in docs.items()}
    assert all(r.round_trip for r in rows)

import random
import re
import zlib

import numpy as np
import pytest

from pulsegrid.llm import toxicity as tox

SF = "/root/testdata/sf0.1"
MODEL = tox.ToxicityModel(dict.fromkeys(tox.WORDS[tox.INSULT], 2.0) | {"clown": 3.0}, {"blarg": 2.5})


def test_composed_machine_equals_the_cascade():
    """One pass of the composed machine gives what the four transducers give one after another."""
    draw = random.Random(3)
    for _ in range(300):
        symbols = draw.choices(tox.SYMBOLS, weights=[4, 2, 3, 2, 1, 4], k=draw.randrange(0, 14))
        want = [1.0] * len(symbols)
        passed = symbols
        for machine in (tox.negation(), tox.reported(), tox.target(), tox.insult()):
            state, out = 0, []
            for i, s in enumerate(passed):
                state, symbol, weight = machine.step(state, s)
                out.append(symbol)
                want[i] *= weight
            passed = out
        state, got = 0, []
        for s in symbols:
            state, _, weight = tox.GRAMMAR.step(state, s)
            got.append(weight)
        assert got == pytest.approx(want)


def test_context_changes_what_an_insult_weighs():
    score = tox.Matcher(MODEL).clause
    plain, aimed = score("what a stupid idea that was"), score("you are so stupid")
    assert aimed == pytest.approx(1.5 * plain) and plain == 2.0
    assert score("it is not stupid") == pytest.approx(0.2 * plain)
    assert score("she wrote that word stupid") == pytest.approx(0.4 * 1.5 * plain)
    assert score("they said it is not stupid") == pytest.approx(0.4 * 0.2 * plain)
    assert score("kill the lights") == 0 and score("i will kill you") > 0 and score("i will not kill you") == 0
    assert score("blargish stuff") == 2.5 and score("a fine day") == 0


def brute(text):
    """Clause by clause over the whole text."""
    matcher = tox.Matcher(MODEL)
    found = [matcher.clause(c) for c in re.split(r"[.!?;:\n]", (text or "").lower())]
    return sum(found), max(found, default=0)


ODD = ["", "   ", "Stupid", "stupid.stupid!", "astupid stupidity", "not ### stupid; you idiot", "É. Blargé you", "one\nyou clown\nkill you", "STUPID" * 3]


def test_search_finds_the_clauses_that_a_full_parse_finds():
    draw = random.Random(4)
    words = ["you", "stupid", "idiot", "not", "said", "kill", "blargon", "clown", "tree", "astupid", "stupido", "x9", ".", "!", "\n", ";", "***"]
    for text in [*ODD, *(" ".join(draw.choices(words, k=draw.randrange(1, 60))) for _ in range(300)), "you idiot " * 20_000, "a" * 200_000]:
        total, best = brute(text)
        assert tox.Matcher(MODEL).measures(text) == pytest.approx(
            (np.log1p(total), np.log1p(1000 * total / (len(text) + 200)), np.log1p(best))
        )


def test_cover_leaves_out_words_that_only_travel_with_insults():
    """Forty copies of one toxic text make all its words frequent; the insult alone explains them."""
    rows = [[1, 1, 0]] * 40 + [[1, 0, 1]] * 4 + [[1, 0, 0]] * 12 + [[0, 0, 0]] * 100
    toxic = np.array([True] * 56 + [False] * 100)
    copies = np.array([0] * 40 + list(range(1, 117)))
    assert tox.cover(np.array(rows, dtype=np.uint8), toxic, copies, ["vile ", "copied ", "word "]) == [0]
    assert tox.sketch("one two three four five six") == tox.sketch("Six five four three, two one!")


def test_held_out_documents(spark):
    """Accuracy on labelled documents that took no part in the fit; ids and hold-out as in the contract."""
    from pulsegrid.llm.queries import QUERIES

    rows = QUERIES["op12_toxicity_grammar"](spark, SF).collect()
    docs = {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    caught = [r.predicted for r in held if labels[r.doc_id]]
    wrong = [r.predicted for r in held if not labels[r.doc_id]]
    assert len(caught) > 50 and np.mean(caught) > 0.9 and np.mean(wrong) < 0.01


def test_learns_insults_that_no_list_names(spark):
    draw = random.Random(1)
    plain = [f"w{chr(97 + a)}{chr(97 + b)}" for a in range(26) for b in range(26)]
    text = lambda bad: " ".join(draw.choices(plain, k=60) + [bad] * 1) + f". {draw.choice(plain)} {bad} {draw.choice(plain)}."
    docs = [(i, text("grumbast" if i % 2 else "zortal" + draw.choice(["a", "os", "im"])) if i % 5 == 0 else text("tree")) for i in range(400)]
    labels = [(i, int(i % 5 == 0)) for i in range(400)]
    model = tox.learn(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    matcher = tox.Matcher(model)
    score = lambda t: model.score(np.array([matcher.measures(t)]))[0]
    assert score("waa grumbast wbb. grumbast") > 0.5 and score("waa zortalus wbb. zortalos") > 0.5
    assert score("waa wbb wcc tree") < 0.1


@pytest.mark.parametrize("labels", [[], [(1, None), (None, 1)], [(1, 1), (1, 0), (1, None)]])
def test_few_or_no_labels_nulls_and_repeated_rows(spark, labels):
    docs = spark.createDataFrame(
        [(1, "You stupid idiot.", 0.1), (1, "You stupid idiot.", 0.2), (2, None, 0.3), (None, "", 0.4), (4, "A fine day.", 0.5)],
        "doc_id long, text string, score double",
    )
    rows = tox.judge_held_out(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    assert sorted((str(r.doc_id), r.predicted) for r in rows) == [("1", 1), ("1", 1), ("2", 0), ("4", 0), ("None", 0)]
    assert not any(r.held_out for r in rows if r.doc_id is None)
    empty = spark.createDataFrame([], "doc_id long, toxic int")
    assert tox.judge_held_out(docs.limit(0), empty).count() == 0

"""Toxicity by a weighted finite-state pattern grammar.

*Words.* A word is a run of letters, lower-cased. It is an insult (with a weight), a threat, a target (who is meant),
a negation, a sign of reported speech, or another word.

*Grammar.* Four weighted transducers read the word classes of a clause: one blocks what a negation
just before denies, one lowers what is reported as somebody's speech, one raises what is aimed at a
target nearby, one turns what is left into factors. ``compose`` joins them into one deterministic machine; an insult scores its weight
times the factor on its arc, a threat only where it is aimed. A clause scores the sum over its path, and a text is judged by
its clauses' scores: their sum, the sum's density and the highest one.

*Fit.* The insults that are not listed here are learned, as words or as word beginnings, and so are all
weights. Candidates come from labelled texts: what occurs in far more toxic texts than clean ones. A greedy
cover takes the candidate that explains most toxic texts not yet explained, so words that only travel with
insults (in copies of one text, say) find nothing left to explain. A logistic regression turns the text's three measures into
the score. The fit uses at most about ``PER_LABEL`` labelled documents of each label, drawn by a hash
of doc_id: a bounded sample, the only rows that reach the driver (as candidate numbers and measures).

*Scale.* The sample is found by a broadcast of its bounded label list, so no text is shuffled for it; scoring is one
pass in which an Aho-Corasick search finds the few clauses with an insult or a threat, and only these are parsed.

Defined cases: null, empty and wordless texts have the score of a text without any match; without labels the listed words
and fixed weights decide; a doc_id with several labels is toxic if one says so, null labels and ids are left out of the
fit; repeated rows give repeated rows; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import utf8, written

#: Labelled documents of each label that take part in the fit (about; drawn by hash).
PER_LABEL = 4000
#: Candidates that the cover chooses from, and insults that it takes at most.
CANDIDATES = 4000
LEXEMES = 400
#: A candidate's share of toxic texts over its share of clean ones, at least; and toxic texts at least.
RATIO, SUPPORT = 6.0, 4
BEGINNINGS = range(3, 9)

INSULT, THREAT, TARGET, NEGATION, REPORTED, OTHER = "ITYNRO"
#: Fixed word lists, four languages each; learned weights replace the insults' one.
WORDS: Mapping[str, tuple[str, ...]] = {
    INSULT: (
        "idiot idiots moron morons stupid scum loser losers worthless pathetic imbecile dumbass bastard "
        "idiota idiotas estúpido estúpida imbécil inútil basura asqueroso "
        "imbécile stupide connard ordure minable crétin "
        "trottel arschloch abschaum dummkopf wertlos widerlich"
    ).split(),
    THREAT: "kill murder hurt stab shoot strangle matar mataré golpearé tuer tuerai frapperai töten umbringen töte".split(),
    TARGET: (
        "you your yours yourself u ur they them these those he she him her people "
        "tú usted ustedes vosotros ellos ellas vous toi tu te ils elles eux ihr euch dich dir du sie ihnen"
    ).split(),
    NEGATION: "not no never neither nor without isn aren wasn don doesn nunca jamás sin ne pas jamais sans nicht kein keine nie niemals ohne".split(),
    REPORTED: (
        "said says say quoted quotes wrote writes called claims claimed according reported "
        "dijo dice escribió llamó según dit disait écrit selon appelé sagte sagt schrieb nannte laut"
    ).split(),
}
PRIOR = 2.0
#: Factors of what the grammar finds.
FACTORS = {"plain": 1.0, "aimed": 1.5, "denied": 0.2, "reported": 0.4, "threat": 1.5}
#: How many words a negation and a target reach.
DENIES, AIMS = 3, 5

_LETTERS = re.compile(r"[^\W\d_]+")
_END = re.compile(r"[.!?;:\n]")
_ENDS = ".!?;:\n"


@dataclass(frozen=True)
class Transducer:
    """A deterministic weighted transducer: (state, symbol) -> (state, symbol out, weight); start is state 0.

    A symbol without an arc is passed on with weight 1 and leads to ``fallback[state]``.
    """

    arcs: Mapping[tuple[int, str], tuple[int, str, float]]
    fallback: Mapping[int, int] = field(default_factory=dict)

    def step(self, state: int, symbol: str) -> tuple[int, str, float]:
        return self.arcs.get((state, symbol)) or (self.fallback.get(state, state), symbol, 1.0)


def compose(first: Transducer, second: Transducer, symbols: str) -> Transducer:
    """The machine that gives ``first``'s output to ``second``; weights multiply, only reached states are made."""
    number, todo, arcs = {(0, 0): 0}, [(0, 0)], {}
    while todo:
        a, b = todo.pop()
        for symbol in symbols:
            to_a, middle, weight_a = first.step(a, symbol)
            to_b, out, weight_b = second.step(b, middle)
            if (to_a, to_b) not in number:
                number[to_a, to_b] = len(number)
                todo.append((to_a, to_b))
            arcs[number[a, b], symbol] = (number[to_a, to_b], out, weight_a * weight_b)
    return Transducer(arcs)


def negation() -> Transducer:
    """State: words that the last negation still reaches. Denied insults go on as d, denied threats as other words."""
    arcs = {}
    for left in range(DENIES + 1):
        arcs[left, NEGATION] = (DENIES, NEGATION, 1.0)
        if left:
            arcs[left, INSULT] = (left - 1, "d", 1.0)
            arcs[left, THREAT] = (left - 1, OTHER, 1.0)
    return Transducer(arcs, {left: max(0, left - 1) for left in range(DENIES + 1)})


def reported() -> Transducer:
    """State 1: a word of reporting came before in the clause."""
    lowered = FACTORS["reported"]
    arcs = {(0, REPORTED): (1, REPORTED, 1.0)}
    arcs |= {(1, s): (1, s, lowered) for s in (INSULT, THREAT, "d")}
    return Transducer(arcs)


def target() -> Transducer:
    """State: words that the last target still reaches, or (negative) that the last threat does. Aimed insults go on as A, carried-out threats as K."""
    arcs = {}
    for left in range(-AIMS, AIMS + 1):
        arcs[left, TARGET] = (AIMS, "K" if left < 0 else TARGET, 1.0)
        arcs[left, THREAT] = (-AIMS, "K" if left > 0 else OTHER, 1.0)
        if left > 0:
            arcs[left, INSULT] = (left - 1, "A", 1.0)
    fallback = {left: left - 1 if left > 0 else min(0, left + 1) for left in range(-AIMS, AIMS + 1)}
    return Transducer(arcs, fallback)


def insult() -> Transducer:
    """Factors of what is left; everything else weighs nothing."""
    factor = {INSULT: "plain", "A": "aimed", "d": "denied", "K": "threat"}
    symbols = (INSULT, THREAT, TARGET, NEGATION, REPORTED, OTHER, "A", "d", "K")
    return Transducer({(0, s): (0, s, FACTORS[factor[s]] if s in factor else 0.0) for s in symbols})


SYMBOLS = INSULT + THREAT + TARGET + NEGATION + REPORTED + OTHER
GRAMMAR = compose(compose(compose(negation(), reported(), SYMBOLS), target(), SYMBOLS), insult(), SYMBOLS)


@dataclass(frozen=True)
class ToxicityModel:
    """``words``: whole words, ``beginnings``: word beginnings, with their weights; ``weights``: of the measures and the constant."""

    words: Mapping[str, float]
    beginnings: Mapping[str, float]
    weights: tuple[float, ...] = (1.5, 0.5, 0.5, -4.0)

    def classes(self) -> dict[str, tuple[str, float]]:
        """Symbol and weight of the words with a fixed class; insults go before the others."""
        found = {w: (symbol, PRIOR if symbol == THREAT else 1.0) for symbol in (TARGET, REPORTED, NEGATION, THREAT) for w in WORDS[symbol]}
        return found | {w: (INSULT, x) for w, x in self.words.items()}

    def score(self, measures: np.ndarray) -> np.ndarray:
        logit = measures @ np.array(self.weights[:-1]) + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


class Matcher:
    """Scores the clauses of texts; made once a task."""

    def __init__(self, model: ToxicityModel):
        self.classes = model.classes()
        self.beginnings = model.beginnings
        self.lengths = sorted({len(b) for b in model.beginnings}, reverse=True)
        self.search = ahocorasick.Automaton()
        for word in {w for w, (symbol, _) in self.classes.items() if symbol in (INSULT, THREAT)} | set(model.beginnings):
            self.search.add_word(word, len(word))
        self.search.make_automaton()

    def classify(self, word: str) -> tuple[str, float]:
        found = self.classes.get(word)
        if found:
            return found
        for length in self.lengths:
            weight = self.beginnings.get(word[:length])
            if weight is not None:
                return INSULT, weight
        return OTHER, 1.0

    def clause(self, clause: str) -> float:
        state, total = 0, 0.0
        for word in _LETTERS.findall(clause):
            symbol, weight = self.classify(word)
            state, out, factor = GRAMMAR.step(state, symbol)
            if factor:
                total += factor * (PRIOR if out == "K" else weight)
        return total

    def clauses(self, text: str) -> Iterator[float]:
        """Scores of the clauses with an insult or a threat; ``text`` is lower-cased."""
        end = 0
        for last, length in self.search.iter(text):
            first = last - length + 1
            if first < end or (first and text[first - 1].isalpha()):
                continue
            start = max(end, *(text.rfind(mark, end, first) + 1 for mark in _ENDS))
            stop = _END.search(text, last + 1)
            end = stop.start() if stop else len(text)
            yield self.clause(text[start:end])

    def measures(self, text: str | None) -> tuple[float, float, float]:
        """Logarithms of the sum of the clauses' scores, of this sum over the length, and of the highest score."""
        found = list(self.clauses(text.lower())) if text else []
        total = sum(found)
        return (
            float(np.log1p(total)),
            float(np.log1p(1000 * total / (len(text or "") + 200))),
            float(np.log1p(max(found, default=0.0))),
        )


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def features(text: str) -> set[str]:
    """Distinct words (ending in a blank) of a text, and the beginnings that two of its words at least share.

    A beginning stands for a family of words; one word with it is often chance, above all in a long text.
    """
    words = Counter(_LETTERS.findall(text.lower()))
    shared: Counter = Counter()
    for w, n in words.items():
        for length in BEGINNINGS[: max(0, min(len(w), BEGINNINGS.stop) - BEGINNINGS.start)]:
            shared[w[:length]] += n
    return {w + " " for w in words if len(w) <= 40} | {b for b, n in shared.items() if n > 1}


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, toxic texts, clean texts) of columns toxic, text; a task's counts go out before they grow too large."""
    toxic, clean = Counter(), Counter()

    def packed() -> pa.RecordBatch:
        names = list(toxic | clean)
        columns = [names, [toxic[x] for x in names], [clean[x] for x in names]]
        made = pa.record_batch([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.int64()))], names=["feature", "toxic", "clean"])
        toxic.clear()
        clean.clear()
        return made

    for batch in batches:
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            (toxic if label else clean).update(features(text.as_py() or ""))
            if len(toxic) + len(clean) > 1_000_000:
                yield packed()
    yield packed()


def sample(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> tuple[DataFrame | None, dict[bool, float]]:
    """Columns toxic, text of the drawn documents (written), and the share of each label that was drawn."""
    told = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg((F.max("toxic") > 0).alias("toxic"))
        .withColumn("draw", F.shiftrightunsigned(F.xxhash64("doc_id"), 33))
    )
    sizes = {r["toxic"]: r["count"] for r in told.groupBy("toxic").count().collect()}
    if not sizes:
        return None, {}
    share = {label: min(1.0, per_label / n) for label, n in sizes.items()}
    wanted = F.lit(False)
    for label, part in share.items():
        wanted = wanted | ((F.col("toxic") == label) & (F.col("draw") < int(part * 2**31)))
    drawn = F.broadcast(told.where(wanted).select("doc_id", "toxic"))  # about 2 per_label rows
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(drawn, "doc_id")
    once = rows.groupBy("doc_id", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    return written(once.select("toxic", "text"), "labelled"), share


def sketch(text: str) -> int:
    """A number that copies and near copies of a text mostly share: from the three smallest checksums of its words."""
    sums = sorted({zlib.crc32(w.encode()) for w in _LETTERS.findall(text.lower())})[:3]
    return zlib.crc32(repr(sums).encode())


def cover(held: np.ndarray, toxic: np.ndarray, copies: np.ndarray, names: list[str], most: int = LEXEMES) -> list[int]:
    """Candidates (columns of the 0/1 matrix ``held``) that explain most toxic texts left, one after another.

    A toxic text counts less for every candidate that it holds already, the texts of one
    number in ``copies`` count once together, clean texts count against a candidate. Of candidates that begin each other one is taken.
    """
    _, of, many = np.unique(copies, return_inverse=True, return_counts=True)
    once = 1.0 / many[of]
    matrix = held.astype(np.float32)
    clean = (once * ~toxic) @ matrix * (RATIO * (once * toxic).sum() / max(1.0, (once * ~toxic).sum()))
    left, chosen = once * toxic, []
    free = np.ones(len(names), dtype=bool)
    while len(chosen) < most and free.any():
        gain = np.where(free, left @ matrix - clean * left.sum() / max(1e-9, (once * toxic).sum()), -np.inf)
        best = max(np.flatnonzero(gain >= gain.max() - 1e-6), key=lambda i: (len(names[i]), names[i]))
        if gain[best] < SUPPORT / 2:
            break
        chosen.append(int(best))
        left = left * np.where(held[:, best] > 0, 0.4, 1.0)
        near = names[best].rstrip()
        free &= np.array([not (n.startswith(near) or near.startswith(n.rstrip())) for n in names])
    return chosen


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights and constant of a logistic regression (Newton steps; the constant is not shrunk)."""
    x = np.hstack([x, np.ones((len(x), 1))])
    shrink = ridge * np.eye(x.shape[1])
    shrink[-1, -1] = 1e-6
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (p - y)) + shrink @ beta
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + shrink, slope)
        beta = beta - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return beta


def learn(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> ToxicityModel:
    """Fit on all labelled documents that are given (the caller holds some out); texts of ``docs``, column toxic of ``labels``."""
    prior = dict.fromkeys(WORDS[INSULT], PRIOR)
    rows, share = sample(docs, labels, per_label)
    if rows is None:
        return ToxicityModel(prior, {})
    texts = rows.select("toxic", "text")
    n = Counter({r["toxic"]: r["count"] for r in texts.groupBy("toxic").count().collect()})
    if not n[True] or not n[False]:
        return ToxicityModel(prior, {})
    counts = texts.mapInArrow(_counted, "feature string, toxic long, clean long").groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    ratio = ((F.col("toxic") + 0.5) / n[True]) / ((F.col("clean") + 0.5) / n[False])
    likely = counts.where((F.col("toxic") >= SUPPORT) & (ratio >= RATIO))
    top = likely.orderBy((F.col("toxic") * F.log(ratio)).desc(), F.length("feature").desc(), "feature").limit(CANDIDATES).collect()
    names = [r["feature"] for r in top]
    place = texts.sparkSession.sparkContext.broadcast({f: i for i, f in enumerate(names)})

    def incidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = np.zeros((batch.num_rows, len(place.value)), dtype=np.uint8)
            for i, text in enumerate(batch.column(1)):
                held[i, [place.value[f] for f in features(text.as_py() or "") if f in place.value]] = 1
            bits = pa.array([r.tobytes() for r in np.packbits(held, axis=1)], pa.binary())
            copies = pa.array([sketch(text.as_py() or "") for text in batch.column(1)], pa.int64())
            yield pa.record_batch([batch.column(0), bits, copies], names=["toxic", "bits", "copies"])

    words, beginnings = dict(prior), {}
    if names:
        found = texts.mapInArrow(incidence, "toxic boolean, bits binary, copies long").collect()
        bits = np.frombuffer(b"".join(r["bits"] for r in found), dtype=np.uint8).reshape(len(found), -1)
        held, toxic = np.unpackbits(bits, axis=1)[:, : len(names)], np.array([r["toxic"] for r in found])
        for i in cover(held, toxic, np.array([r["copies"] for r in found]), names):
            p, q = int(held[toxic, i].sum()), int(held[~toxic, i].sum())
            weight = float(np.log(((p + 0.5) / n[True]) / ((q + 0.5) / n[False])))
            (words if names[i].endswith(" ") else beginnings)[names[i].rstrip()] = round(min(6.0, weight), 4)
    model = ToxicityModel(words, beginnings)
    measured = _measured(rows.select(F.col("toxic"), "text"), model, "toxic", "boolean").collect()
    x = np.array([[r["total"], r["density"], r["best"]] for r in measured])
    y = np.array([r["toxic"] for r in measured], dtype=float)
    weight = np.where(y > 0, 1 / share[True], 1 / share[False])
    weight *= len(y) / weight.sum()
    return ToxicityModel(words, beginnings, tuple(logistic(x, y, weight).tolist()))


def _measured(rows: DataFrame, model: ToxicityModel, key: str, kind: str) -> DataFrame:
    """key, total, density, best of each text."""
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(sent.value)
        for batch in batches:
            made = np.array([matcher.measures(t.as_py()) for t in batch.column(1)]).reshape(-1, 3)
            yield pa.record_batch([batch.column(0), *map(pa.array, made.T)], names=[key, "total", "density", "best"])

    return rows.select(key, "text").mapInArrow(run, f"{key} {kind}, total double, density double, best double")


def score_texts(rows: DataFrame, model: ToxicityModel, key: str = "doc_id") -> DataFrame:
    """key, score of each text."""
    sent = rows.sparkSession.sparkContext.broadcast(model)
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(sent.value)
        for batch in batches:
            made = np.array([matcher.measures(None if t is None else t.decode("utf-8", "replace")) for t in batch.column(1).to_pylist()]).reshape(-1, 3)
            yield pa.record_batch([batch.column(0), pa.array(sent.value.score(made))], names=[key, "score"])

    return rows.select(key, utf8("text").alias("text")).mapInArrow(run, f"{key} {kind}, score double")


def judge_held_out(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document; learns from labels of documents that are not held out."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = learn(rows, labels.where(~held_out(F.col("doc_id").cast("long"))))
    return score_texts(rows, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )

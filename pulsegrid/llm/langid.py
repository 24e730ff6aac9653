"""Language identification by string kernels with Nystroem landmarks.

The blended-spectrum presence kernel of two texts counts the character n-grams (1 to 4) that
both hold, each counted once, over the geometric mean of the two texts' own counts. N-grams
are hashed to ``DIM`` numbers, so a text is a set of bits, whatever its length.

*Nystroem*: kernels against a few landmark texts, whitened by the landmarks' own kernel matrix,
give every text a short feature vector. *One-versus-rest kernel ridge regression* on these
vectors has one column of weights per language. Both steps are one matrix, so a batch of texts
is scored by two matrix products: bits x landmarks, kernels x weights.

The fit uses a bounded sample of labelled rows: at most ``per_language`` texts of each
language, those with the smallest hashes. Workers send bits (``DIM`` / 8 bytes a text), not texts.

Defined cases: a text that is null or has no letter is ``und`` with score 0; without a labelled
row every text is; languages tie to the alphabetically first; repeated rows give repeated rows;
other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm.common import pieces

DIM = 1 << 14
ORDERS = (1, 2, 3, 4)
UNKNOWN = "und"
#: Labelled texts of each language that take part in the fit, and how many of them are landmarks.
PER_LANGUAGE = 1000
LANDMARKS_PER_LANGUAGE = 32
RIDGE = 0.1
#: Characters and texts that are worked on at once.
_CHARS = 1 << 19
_ROWS = 256
#: Word characters but decimal digits; of these signs such as ½, ² and ① are no letters (``str.isalpha``, \p{L} in ``learn``).
_SIGN = re.compile(r"[^\W\d_]")


def presence(texts: list[str]) -> np.ndarray:
    """Rows of ``DIM`` zeros and ones: the hashed n-grams that each text holds.

    Texts are lower-cased, runs of characters that are no letters count as one blank.
    """
    return _grams([f" {t} " for t in texts])


def _grams(folded: list[str]) -> np.ndarray:
    """Like ``presence``, of texts that have their outer blanks."""
    held = np.zeros(len(folded) * DIM, dtype=np.uint8)
    codes = np.frombuffer("".join(folded).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    row = np.repeat(np.arange(len(folded), dtype=np.int64), [len(t) for t in folded])
    rolled = np.zeros(len(codes), dtype=np.uint64)
    for n in ORDERS:
        if len(codes) < n:
            break
        with np.errstate(over="ignore"):
            rolled = rolled[: len(codes) - n + 1] * np.uint64(0x100000001B3) + codes[n - 1 :] + np.uint64(n)
            mixed = (rolled * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 14)
        inside = row[: len(rolled)] == row[n - 1 :]
        held[row[: len(rolled)][inside] * DIM + mixed[inside].astype(np.int64)] = 1
    return held.reshape(len(folded), DIM)


def folded_text(text: str) -> str:
    folded = re.sub(r"[\W\d_]+", " ", text.lower())
    if folded.replace(" ", "").isalpha():
        return folded
    return re.sub(" +", " ", "".join([c if c.isalpha() else " " for c in folded]))


def presence_of_whole(texts: list[str]) -> np.ndarray:
    """Like ``presence``; very long texts are read in overlapping parts whose bits are joined."""
    held = np.zeros((len(texts), DIM), dtype=np.uint8)
    for low, high in pieces([len(t) for t in texts], _CHARS):
        if high - low == 1 and len(texts[low]) > _CHARS:
            t = f" {texts[low]} "
            for at in range(0, len(t), _CHARS):
                held[low] |= _grams([t[max(0, at - max(ORDERS) + 1) : at + _CHARS]])[0]
        else:
            held[low:high] = presence(texts[low:high])
    return held


@dataclass(frozen=True)
class LanguageModel:
    """``landmarks``: bits (landmark x DIM); ``weights``: kernel values to language scores."""

    languages: tuple[str, ...]
    landmarks: np.ndarray
    weights: np.ndarray

    def kernels(self, held: np.ndarray) -> np.ndarray:
        return kernel(held, self.landmarks)

    def scores(self, held: np.ndarray) -> np.ndarray:
        return self.kernels(held) @ self.weights[:-1] + self.weights[-1]


def kernel(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Shared n-grams over the geometric mean of both texts' counts."""
    norm = np.sqrt(np.outer(a.sum(axis=1, dtype=np.float32), b.sum(axis=1, dtype=np.float32)))
    return (a.astype(np.float32) @ b.astype(np.float32).T) / np.maximum(norm, 1)


def fit(held: np.ndarray, languages: list[str]) -> LanguageModel:
    """Nystroem features of the sample, then ridge regression of +1 / -1 for each language."""
    names = tuple(sorted(set(languages)))
    index = {name: i for i, name in enumerate(names)}
    y = np.array([index[x] for x in languages])
    chosen = np.concatenate([np.flatnonzero(y == i)[:LANDMARKS_PER_LANGUAGE] for i in range(len(names))])
    landmarks = held[chosen]
    values, vectors = np.linalg.eigh(kernel(landmarks, landmarks).astype(np.float64))
    good = values > 1e-6 * values[-1]
    whiten = vectors[:, good] / np.sqrt(values[good])
    features = np.hstack([kernel(held, landmarks).astype(np.float64) @ whiten, np.ones((len(held), 1))])
    target = np.where(y[:, None] == np.arange(len(names)), 1.0, -1.0)
    # languages weigh the same, however often they occur
    weight = (len(y) / len(names)) / np.bincount(y, minlength=len(names))[y]
    ridge = RIDGE * np.eye(features.shape[1])
    ridge[-1, -1] = 1e-9
    beta = np.linalg.solve(features.T @ (features * weight[:, None]) + ridge, features.T @ (target * weight[:, None]))
    weights = np.vstack([whiten @ beta[:-1], beta[-1:]]).astype(np.float32)
    return LanguageModel(names, landmarks, weights)


def has_letter(text: str | None) -> bool:
    return text is not None and any(found[0].isalpha() for found in _SIGN.finditer(text))


def predict(model: LanguageModel | None, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Languages and scores; the score is the softmax share of the winning language."""
    names = np.full(len(texts), UNKNOWN, dtype=object)
    score = np.zeros(len(texts))
    known = [i for i, t in enumerate(texts) if has_letter(t)] if model else []
    for at in range(0, len(known), _ROWS):
        some = known[at : at + _ROWS]
        raw = model.scores(presence_of_whole([folded_text(texts[i]) for i in some])).astype(np.float64)
        best = raw.argmax(axis=1)
        shares = np.exp(3 * (raw - raw.max(axis=1, keepdims=True)))
        score[some] = 1 / shares.sum(axis=1)
        names[some] = np.array(model.languages, dtype=object)[best]
    return names.tolist(), score


def _packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for low in range(0, len(batch), _ROWS):
            part = batch.iloc[low : low + _ROWS]
            held = presence_of_whole([folded_text(t) for t in part["text"]])
            bits = np.packbits(held, axis=1)
            yield pd.DataFrame({"lang": part["lang"].to_numpy(), "draw": part["draw"].to_numpy(), "bits": [r.tobytes() for r in bits]})


def learn(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> LanguageModel | None:
    """Fit on columns ``doc_id, text, lang`` of rows with a language and a letter.

    Counts by language set what share of the hash range each language draws from, so that the
    sample is bounded by about ``per_language`` rows of each language.
    """
    usable = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    usable = usable.select("lang", "text", F.shiftrightunsigned(F.xxhash64(F.col("doc_id").cast("string"), "text"), 33).alias("draw"))
    sizes = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    if not sizes:
        return None
    wanted = F.lit(False)
    for name, n in sorted(sizes.items()):
        share = min(1.0, (per_language + 6 * per_language**0.5) / n)
        wanted = wanted | ((F.col("lang") == name) & (F.col("draw") < int(share * 2**31)))
    rows = usable.where(wanted).mapInPandas(_packed, "lang string, draw long, bits binary").toPandas()
    rows = rows.sort_values(["lang", "draw", "bits"]).groupby("lang").head(per_language)
    held = np.unpackbits(np.frombuffer(b"".join(rows["bits"]), dtype=np.uint8).reshape(len(rows), -1), axis=1)
    return fit(held, rows["lang"].tolist())


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, model: LanguageModel | None, key: str = "doc_id") -> DataFrame:
    """key, lang_pred, score of every whole text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = dict(docs.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, score = predict(sent.value, batch.column(1).to_pylist())
            yield pa.record_batch([batch.column(0), pa.array(names, pa.string()), pa.array(score)], names=[key, "lang_pred", "score"])

    return docs.select(key, "text").mapInArrow(run, f"{key} {kind}, lang_pred string, score double")


def language(model: LanguageModel | None, text: Column, spark: SparkSession) -> Column:
    """struct(lang_pred, score) of a text column, for use beside other columns."""
    sent = spark.sparkContext.broadcast(model)

    def run(texts: pd.Series) -> pd.DataFrame:
        names, score = predict(sent.value, texts.tolist())
        return pd.DataFrame({"lang_pred": names, "score": score})

    return F.pandas_udf(run, "lang_pred string, score double")(text)


def without_unknown_language(docs: DataFrame) -> DataFrame:
    """All columns of the documents whose language is known; learns from all labelled ones.

    Without a labelled row no language can be told, so no document is rejected.
    """
    model = learn(docs)
    if model is None:
        return docs
    found = language(model, F.col("text"), docs.sparkSession)
    packed = docs.select(F.struct("*").alias("_pg_row"), found.alias("_pg_found"))
    return packed.where(F.col("_pg_found.lang_pred") != UNKNOWN).select("_pg_row.*")


def identify_held_out(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learns from labelled documents that are not held out."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    model = learn(rows.where(~held_out(F.col("doc_id"))))
    found = identify(rows, model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")

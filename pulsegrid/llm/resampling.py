"""Importance resampling towards a target distribution by hashed n-grams.

*Words and windows.* An untrained regular-expression split of the tokenizers library cuts the ASCII-lowered
text and returns each word with its offsets; windows of 1 to ``order`` consecutive words are pairs
of offsets, and the checksum of a longer window goes on from that of the shorter one, so no joined
text is built.

*Histograms.* A feature's bucket is the CRC-32 of its UTF-8 bytes modulo ``buckets``. Texts are read
once: a row keeps its own histogram (at most ``buckets`` entries, whatever its length), and the corpus'
histogram is the sum of these, added up inside each task before the shuffle. Only ``buckets``
numbers a table reach the driver.

*Gains.* A bucket's gain is the logarithm of its smoothed share in the target over its share in the
corpus; a text's weight is the floored mean gain of its features.

*Draw.* Gumbel noise derived from (seed, doc_id) makes the highest scores a draw without
replacement in proportion to exp(weight / 1000). Scores are whole numbers between about -50,000 and
+70,000 (logarithms of 64-bit counts and of a 32-bit draw), so the ranks come from the counts of the
distinct scores, which fit into one small task at every size, and from an order by doc_id inside one score.

Defined cases: a null or empty text has no feature and weight 0; documents under ``min_words`` words
are scored but never drawn; a null doc_id draws like the empty string and is ranked after the others of
its score; repeated doc_ids have the same noise and are ranked one by one; an empty corpus gives no row, an empty
target leaves all gains to the smoothing; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Regex, pre_tokenizers

from pulsegrid.llm.common import utf8, written
from pulsegrid.plans.ordered import with_ordinal

#: Everything in ASCII but digits and lower-case letters separates words.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
ORDER = 1
MIN_WORDS = 20
PERCENT = 10
SEED = "2024"
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_BREAKS = np.array([not (48 <= b <= 57 or 97 <= b <= 122) and b < 128 for b in range(256)])
#: Bytes of a text that are split at once; longer ones are cut at a separator.
_PART = 1 << 20
#: Words whose checksum is remembered at a time.
_REMEMBERED = 1 << 17


@lru_cache(maxsize=1)
def splitter() -> pre_tokenizers.Split:
    return pre_tokenizers.Split(Regex(SEPARATORS), "removed")


def parts(text: bytes, size: int = _PART) -> Iterator[bytes]:
    """The text in parts of about ``size`` bytes that end before a separator."""
    at = 0
    while len(text) - at > size:
        end = at + size
        while True:  # a word may be longer than a part
            stops = np.flatnonzero(_BREAKS[np.frombuffer(text, dtype=np.uint8, count=min(size, len(text) - end), offset=end)])
            if len(stops):
                end += int(stops[0])
                break
            end += size
            if end >= len(text):
                end = len(text)
                break
        yield text[at:end]
        at = end
    yield text[at:]


class Buckets:
    """Words and feature buckets of texts."""

    def __init__(self, buckets: int = BUCKETS, order: int = ORDER):
        self.buckets, self.order = buckets, order
        self._sums: dict[str, int] = {}

    def _sum(self, word: str) -> int:
        found = self._sums.get(word)
        if found is None:
            if len(self._sums) >= _REMEMBERED:
                self._sums.clear()
            found = self._sums[word] = zlib.crc32(word.encode())
        return found

    def features(self, text: bytes | None) -> tuple[int, np.ndarray]:
        """Number of words, and the bucket of every window of 1 to ``order`` words."""
        n, made, carried = 0, [], []
        for part in parts(text.translate(_LOWER)) if text else ():
            whole = part.decode("utf-8", "replace")
            spans = splitter().pre_tokenize_str(whole)
            n += len(spans)
            sums = [self._sum(word) for word, _ in spans]
            made.append(np.array(sums, dtype=np.int64))
            if self.order > 1:
                words = carried + [whole[low:high].encode() for _, (low, high) in spans]
                made.append(np.array(self._longer(words, len(carried)), dtype=np.int64))
                carried = words[max(0, len(words) - self.order + 1) :]
        found = np.concatenate(made) if made else np.zeros(0, dtype=np.int64)
        return n, found % self.buckets

    def _longer(self, words: list[bytes], known: int) -> list[int]:
        """Checksums of windows of 2 to ``order`` words that end behind the first ``known`` words."""
        out = []
        sums = [zlib.crc32(w) for w in words]
        for length in range(2, self.order + 1):
            sums = [zlib.crc32(b" " + w, s) for s, w in zip(sums, words[length - 1 :])]
            out += sums[max(0, known - length + 1) :]
        return out


def histograms(rows: DataFrame, keys: list[str], buckets: int = BUCKETS, order: int = ORDER) -> DataFrame:
    """keys, n_words, n_features and the row's histogram: bucket numbers and counts as packed integers."""
    kept = rows.select(*keys, utf8("text").alias("text"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema if f.name in keys)
    names = [*keys, "n_words", "n_features", "at", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = Buckets(buckets, order)
        for batch in batches:
            made = []
            for text in batch.column(len(keys)):
                n, found = maker.features(text.as_py())
                at, times = np.unique(found, return_counts=True)
                made.append((n, len(found), at.astype("<u4").tobytes(), times.astype("<u4").tobytes()))
            columns = list(zip(*made)) or [(), (), (), ()]
            types = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
            yield pa.record_batch(
                [*(batch.column(i) for i in range(len(keys))), *map(pa.array, columns, types)], names=names
            )

    return kept.mapInArrow(run, ", ".join(filter(None, [schema, "n_words long, n_features long, at binary, times binary"])))


def totals(made: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The sum of the rows' histograms; each task adds up its own first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for at, times in zip(batch.column(0), batch.column(1)):
                total[np.frombuffer(at.as_py(), "<u4")] += np.frombuffer(times.as_py(), "<u4")
        held = np.flatnonzero(total)
        yield pa.record_batch([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    summed = made.select("at", "times").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, dtype=np.int64)
    for r in summed.collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B)))) of each bucket."""
    b = len(corpus)
    s, t, total_s, total_t = corpus.astype(float), target.astype(float), float(corpus.sum() + b), float(target.sum() + b)
    ratio = ((t + 1) * total_s) / ((s + 1) * total_t)
    return np.array([math.floor(1000 * math.log(r)) for r in ratio.tolist()], dtype=np.int64)


def weighted(made: DataFrame, gain: np.ndarray, keys: list[str]) -> DataFrame:
    """keys, n_words, n_features, weight: the floored mean gain of a row's features."""
    sent = made.sparkSession.sparkContext.broadcast(gain)  # `buckets` numbers
    kept = made.select(*keys, "n_words", "n_features", "at", "times")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema if f.name not in ("at", "times"))
    last = len(keys) + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [
                int(sent.value[np.frombuffer(at.as_py(), "<u4")] @ np.frombuffer(times.as_py(), "<u4").astype(np.int64))
                for at, times in zip(batch.column(last), batch.column(last + 1))
            ]
            weight = [s // n if n else 0 for s, n in zip(sums, batch.column(last - 1).to_pylist())]
            columns = [batch.column(i) for i in range(last)]
            yield pa.record_batch([*columns, pa.array(weight, pa.int64())], names=[*keys, "n_words", "n_features", "weight"])

    return kept.mapInArrow(run, schema + ", weight long")


def gumbel(doc_id: Column, seed: str = SEED) -> Column:
    """floor(-1000 ln(-ln(u))) of a number u in (0, 1) that (seed, doc_id) decide."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def ranked(scored: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """Add rank: 1, 2, 3, ... for the highest floor(percent N / 100) scores of the N long documents.

    ``scored`` is read several times: pass a written table.
    """
    able = scored.where(F.col("n_words") >= min_words)
    # One row for each distinct score, a bounded number (module text): one task may hold them.
    counted = able.groupBy("score").agg(F.count(F.lit(1)).alias("_n"))
    above = Window.orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, -1)
    base = counted.select(
        "score",
        F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_above"),
        F.sum("_n").over(Window.partitionBy()).alias("_all"),
    )
    quota = F.floor(F.col("_all") * percent / 100)
    reached = written(base.where(F.col("_above") < quota).select("score", "_above", quota.alias("_quota")), "scores")
    joined = scored.join(F.broadcast(reached), "score", "left").withColumn(
        "_able", F.col("_above").isNotNull() & (F.col("n_words") >= min_words)
    )
    inside = with_ordinal(
        joined.where("_able"), ["score"], [F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("n_words")], "_inside"
    )
    place = F.col("_above") + F.col("_inside") + 1
    columns = [*scored.columns, "rank"]
    first = inside.withColumn("rank", F.when(place <= F.col("_quota"), place)).select(*columns)
    return first.unionByName(joined.where(~F.col("_able")).withColumn("rank", F.lit(None).cast("long")).select(*columns))


def importance(
    docs: DataFrame,
    target: DataFrame,
    buckets: int = BUCKETS,
    order: int = ORDER,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    seed: str = SEED,
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank of every row of ``docs`` (rank null: not drawn).

    ``docs`` has columns doc_id and text, ``target`` a column text.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    made = written(histograms(rows, ["doc_id"], buckets, order), "histograms")
    gain = gains(totals(made, buckets), totals(histograms(target.select("text"), [], buckets, order), buckets))
    scored = weighted(made, gain, ["doc_id"]).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    return ranked(written(scored, "scored"), percent, min_words)


def resample(docs: DataFrame, target: DataFrame, **settings) -> DataFrame:
    """The drawn documents with all their columns; rows that share a doc_id are drawn together."""
    drawn = importance(docs, target, **settings).where(F.col("rank").isNotNull()).select(F.col("doc_id").alias("_pg_id")).distinct()
    packed = docs.select(F.struct("*").alias("_pg_row"), F.col("doc_id").cast("long").alias("_pg_key"))
    return packed.join(drawn, F.col("_pg_key").eqNullSafe(F.col("_pg_id")), "left_semi").select("_pg_row.*")


def _crc(text: str) -> str:
    """DuckDB expression: CRC-32 of the UTF-8 bytes of a text expression, byte by byte with the usual table."""
    byte = f"(('0x' || substr(hex(encode({text})), 2 * i - 1, 2))::UBIGINT)"
    return (
        f"xor(list_reduce(list_concat([4294967295::UBIGINT], list_transform(range(1, octet_length(encode({text})) + 1), lambda i: {byte})), "
        "lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255::UBIGINT)::BIGINT + 1])), 4294967295::UBIGINT)"
    )


def oracle(buckets: int = BUCKETS, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: str = SEED) -> str:
    """The query's result for single words as DuckDB SQL; distinct words only are hashed."""
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = rf"regexp_extract_all({lowered}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
WITH crc_table AS (
    SELECT list(list_reduce(list_concat([c], range(8)::UBIGINT[]), lambda x, k: xor(x >> 1, (x & 1) * 3988292384::UBIGINT)) ORDER BY c) AS crc
    FROM (SELECT i::UBIGINT AS c FROM range(256) r(i))
), docs AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(len({words}), 0) AS n, {words} AS w FROM documents
), found AS (
    SELECT r, unnest(w) AS word FROM docs
), wanted AS (
    SELECT unnest({words}) AS word FROM benchmark
), spelled AS (
    SELECT word, {_crc('word')} % {buckets} AS b FROM (SELECT word FROM found UNION SELECT word FROM wanted), crc_table
), s AS (
    SELECT b, count(*) AS s FROM found JOIN spelled USING (word) GROUP BY b
), t AS (
    SELECT b, count(*) AS t FROM wanted JOIN spelled USING (word) GROUP BY b
), gain AS (
    SELECT b, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (coalesce((SELECT sum(s) FROM s), 0) + {buckets})::DOUBLE
        / ((s + 1)::DOUBLE * (coalesce((SELECT sum(t) FROM t), 0) + {buckets})::DOUBLE)))::BIGINT AS g
    FROM s LEFT JOIN t USING (b)
), weighed AS (
    SELECT r, sum(g) AS g FROM found JOIN spelled USING (word) JOIN gain USING (b) GROUP BY r
), scored AS (
    SELECT doc_id, n, CASE WHEN n = 0 THEN 0 ELSE floor(coalesce(g, 0)::DOUBLE / n)::BIGINT END AS weight,
        ('0x' || substr(sha256('{seed}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::UBIGINT::DOUBLE AS h
    FROM docs LEFT JOIN weighed USING (r)
), noisy AS (
    SELECT doc_id, n, weight, weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296)))::BIGINT AS score FROM scored
), placed AS (
    SELECT *, n >= {min_words} AS able,
        row_number() OVER (PARTITION BY n >= {min_words} ORDER BY score DESC, doc_id NULLS LAST, n) AS place,
        count(*) FILTER (n >= {min_words}) OVER () AS total
    FROM noisy
)
SELECT doc_id, n::BIGINT AS n_features, weight::BIGINT AS weight, score::BIGINT AS score,
    CASE WHEN able AND place <= total * {percent} // 100 THEN place::BIGINT END AS rank
FROM placed"""

"""SimHash near-duplicates: exact fingerprint links by distributed vantage-point trees.

The top of the tree is a distributed partition, its shards are searched by trees in memory.

* *Partition by Hamming distance.* Two fingerprints that differ in at most three bits differ in
  at most one bit in one of their halves. Each half is cut into eight segments and every
  segment's distance to a vantage point is taken; the eight distances name the shard.
* *Prune by triangle bounds.* |d(x, v) - d(y, v)| <= d(x, y) holds in every segment, and the
  segments are disjoint, so these differences add up to at most one: linked fingerprints lie in
  the same shard of a half, or in two shards that differ by one in one segment.
* *Query boundary-overlapping shards.* Each fingerprint is stored in its own shard and also
  queries the shards one step up (its partner queries it in the other direction).
* A shard with more than ``spark.pulsegrid.simhash.maxShardRows`` rows (stored or asked) is split again by
  distance to further vantage points over the rest of the bits, where three bits are left to
  differ; rows within three of a border query both sides. No pair is lost at any level.
* Inside a shard a vantage-point tree over the stored rows is searched with the same bounds.

Links leave a task as a spanning forest, never as all pairs of a group; equal fingerprints are
one node from the start. So a huge group of copies costs rows in proportion to its size.

Defined cases: null, empty and blank texts have fingerprint zero; null doc_ids keep their row,
count in their group, and a group of null doc_ids only has a null component_id; repeated rows
give repeated rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pulsegrid.llm.common import ragged, utf8, written
from pulsegrid.llm.components import connected_components, forest

RADIUS = 3
SEED = 42
SHINGLE_WORDS = 3
_SEGMENTS = 8  # of four bits, in each half
#: Vantage points: the first for the segments, the others for splits of hot shards.
_VANTAGE = tuple(xxhash.xxh64_intdigest(f"vantage {i}".encode()) for i in range(13))
_LEAF = 64
_SHELL = 4
_PAIRS_AT_ONCE = 2_000_000


def fingerprint(text: bytes | None) -> int:
    """The 64-bit SimHash of a text's word shingles."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= SHINGLE_WORDS:
        return xxhash.xxh64_intdigest(line, SEED)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    starts = np.cumsum(lengths + 1) - lengths - 1
    ends = (starts + lengths)[SHINGLE_WORDS - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[s:e], SEED) for s, e in zip(starts.tolist(), ends)], dtype="<u8")
    total = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65536):
        rows = hashes[at : at + 65536].view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    bits = np.packbits(total * 2 > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = np.array([fingerprint(x.as_py()) for x in batch.column(2)], dtype=np.uint64)
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(made.view(np.int64))], names=["doc_id", "digest", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, digest of the text, fp (the fingerprint's bits as a signed long)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("digest"), utf8("text").alias("text"))
    return rows.mapInArrow(_fingerprint_batches, "doc_id long, digest long, fp long")


def _segment_distances(fp: np.ndarray, half: int) -> np.ndarray:
    """Distances of a half's segments to the vantage point, as eight four-bit numbers."""
    x = ((fp ^ np.uint64(_VANTAGE[0])) >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)
    x = x - ((x >> np.uint64(1)) & np.uint64(0x55555555))
    return (x & np.uint64(0x33333333)) + ((x >> np.uint64(2)) & np.uint64(0x33333333))


def _route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each fingerprint to its own shard and, as a query, to those one step up."""
    for batch in batches:
        fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for half in (0, 1):
            own = _segment_distances(fp, half)
            top = np.uint64(half << 32)
            yield _rows(own | top, fp, True)
            for segment in range(_SEGMENTS):
                shift = np.uint64(4 * segment)
                up = ((own >> shift) & np.uint64(15)) < 4
                yield _rows((own[up] + (np.uint64(1) << shift)) | top, fp[up], False)


def _rows(shard: np.ndarray, fp: np.ndarray, stored: bool) -> pa.RecordBatch:
    return pa.record_batch(
        [pa.array(shard.view(np.int64)), pa.array(np.full(len(fp), stored)), pa.array(fp.view(np.int64))],
        names=["shard", "stored", "fp"],
    )


def _split_hot(rows: DataFrame, limit: int) -> DataFrame:
    """Split shards of more than ``limit`` rows by distance to further vantage points."""
    done = None
    for vantage in _VANTAGE[1:]:
        sizes = rows.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.max("stored").alias("any"))
        hot = written(sizes.where(F.col("any") & (F.col("n") > limit)).select("shard"), "hot-shards")
        if hot.isEmpty():
            break
        calm = rows.join(hot, "shard", "left_anti")
        done = calm if done is None else done.unionByName(calm)
        point = F.lit(vantage - (1 << 64) if vantage >> 63 else vantage)
        d = F.bit_count(F.col("fp").bitwiseXOR(point))
        own = F.floor(d / _SHELL)
        around = F.array_distinct(F.array(F.floor((d - RADIUS) / _SHELL), own, F.floor((d + RADIUS) / _SHELL)))
        routed = rows.join(hot, "shard", "left_semi").withColumn("_shell", F.explode(around)).withColumn("_own", own)
        # a stored row also queries the shells beside its own; its pairs within a shell are found there
        rows = written(
            routed.select(
                F.xxhash64("shard", "_shell").alias("shard"), (F.col("stored") & (F.col("_shell") == F.col("_own"))).alias("stored"), "fp"
            ),
            "split-shards",
        )
    return rows if done is None else done.unionByName(rows)


class VantageTree:
    """Rows of one shard; ``search`` yields (query, row) positions within the radius."""

    def __init__(self, fp: np.ndarray):
        self.fp = fp
        self.root = self._build(np.arange(len(fp)))

    def _build(self, at: np.ndarray):
        for tried in range(4 if len(at) > _LEAF else 0):
            point = self.fp[at[(tried * 7919) % len(at)]]
            d = np.bitwise_count(self.fp[at] ^ point).astype(np.int16)
            middle = int(np.median(d))
            near = d <= middle if (d > middle).any() else d < middle
            if near.any() and not near.all():
                parts = [(int(d[m].min()), int(d[m].max()), self._build(at[m])) for m in (near, ~near)]
                return point, parts
        return at

    def search(self, queries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        stack = [(self.root, np.arange(len(queries)))]
        while stack:
            node, asked = stack.pop()
            if isinstance(node, tuple):
                d = np.bitwise_count(queries[asked] ^ node[0]).astype(np.int16)
                for low, high, child in node[1]:
                    kept = asked[(d >= low - RADIUS) & (d <= high + RADIUS)]
                    if len(kept):
                        stack.append((child, kept))
                continue
            step = max(1, _PAIRS_AT_ONCE // len(node))
            for at in range(0, len(asked), step):
                some = asked[at : at + step]
                q, r = np.nonzero(np.bitwise_count(queries[some][:, None] ^ self.fp[node][None, :]) <= RADIUS)
                yield some[q], node[r]


def _small_shards(fp, first, last, position) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Every row against the stored rows after it (or all, for queries) of its shard."""
    counts = last - first
    ends = np.cumsum(counts)
    for low, high in pairwise(np.unique([0, *np.searchsorted(ends, np.arange(_PAIRS_AT_ONCE, ends[-1], _PAIRS_AT_ONCE)), len(counts)])):
        left = np.repeat(position[low:high], counts[low:high])
        right = ragged(first[low:high], counts[low:high])
        near = np.bitwise_count(fp[left] ^ fp[right]) <= RADIUS
        yield left[near], right[near]


def _links(shard: np.ndarray, stored: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links in whole shards; rows sorted by shard, stored ones first."""
    starts = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]])
    sizes = np.diff(np.r_[starts, len(shard)])
    stored_n = np.add.reduceat(stored.astype(np.int64), starts)
    left, right = [], []

    def take(a: np.ndarray, b: np.ndarray) -> None:
        if len(a):
            u, v = forest(fp[a].view(np.int64), fp[b].view(np.int64))
            left.append(u)
            right.append(v)

    small = np.repeat(stored_n <= _LEAF, sizes)
    position = np.arange(len(fp))
    begin, end = np.repeat(starts, sizes), np.repeat(starts + stored_n, sizes)
    asks = position[small & (end > begin)]
    if len(asks):
        first = np.where(stored[asks], asks + 1, begin[asks])
        for a, b in _small_shards(fp, first, end[asks], asks):
            take(a, b)
    for s in np.flatnonzero(stored_n > _LEAF):
        low, n = starts[s], stored_n[s]
        tree = VantageTree(fp[low : low + n])
        for q, r in tree.search(fp[low : low + sizes[s]]):
            take(low + q, low + r)
    if not left:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return forest(np.concatenate(left), np.concatenate(right))


def _link_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole shards at a time: the last shard of a batch waits for the next one."""
    held: list[tuple[np.ndarray, ...]] = []

    def links_of(parts) -> pa.RecordBatch:
        shard, stored, fp = (np.concatenate(x) for x in zip(*parts))
        a, b = _links(shard, stored, fp)
        return pa.record_batch([pa.array(a), pa.array(b)], names=["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        columns[2] = columns[2].view(np.uint64)
        cut = int(np.searchsorted(columns[0], columns[0][-1]))
        if cut:
            held.append(tuple(c[:cut] for c in columns))
        elif held and held[-1][0][-1] == columns[0][0]:
            held.append(tuple(columns))
            continue
        if held:
            yield links_of(held)
        held = [tuple(c[cut:] for c in columns)]
    if held:
        yield links_of(held)


def fingerprint_links(distinct: DataFrame) -> DataFrame:
    """(a, b): a spanning forest of all links between the distinct fingerprints ``fp``."""
    limit = int(distinct.sparkSession.conf.get("spark.pulsegrid.simhash.maxShardRows", "200000"))
    routed = distinct.select("fp").mapInArrow(_route, "shard long, stored boolean, fp long")
    rows = _split_hot(written(routed, "shards"), limit)
    ordered = rows.repartition("shard").sortWithinPartitions("shard", F.desc("stored"))
    return ordered.mapInArrow(_link_batches, "a long, b long")


def _groups(docs: DataFrame) -> DataFrame:
    """doc_id, digest, fp, root (a fingerprint that names the component), component_id."""
    rows = written(fingerprints(docs), "fingerprints")
    distinct = written(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    roots = connected_components(written(fingerprint_links(distinct), "links"))
    tied = roots.select(F.col("node").alias("fp"), "root")
    tied = tied.unionByName(tied.select(F.col("root").alias("fp"), "root").distinct())
    tied = written(distinct.join(tied, "fp"), "tied")
    smallest = tied.groupBy("root").agg(F.min("first").alias("component_id"))
    grouped = tied.join(smallest, "root").select("fp", "root", "component_id")
    label = distinct.join(grouped, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), F.coalesce("component_id", "first").alias("component_id"))
    return rows.join(written(label, "labels"), "fp")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable)."""
    return _groups(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """All columns of one document of each component: the one with the smallest doc_id.

    Null doc_ids come last; among equal doc_ids a digest of the text decides, and of rows that
    are equal in both one stays.
    """
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest")
    first = _groups(docs).groupBy("root").agg(F.min(key).alias("first"))
    first = written(first.select(F.col("first.doc_id").alias("_pg_id"), F.col("first.digest").alias("_pg_digest")), "representatives")
    packed = docs.select(F.struct("*").alias("_pg_row"), F.col("doc_id").cast("long").alias("_pg_doc"), F.xxhash64("text").alias("_pg_text"))
    same = F.col("_pg_doc").eqNullSafe(F.col("_pg_id")) & (F.col("_pg_text") == F.col("_pg_digest"))
    one = Window.partitionBy("_pg_doc", "_pg_text").orderBy("_pg_doc")
    kept = packed.join(first, same, "left_semi").withColumn("_pg_nth", F.row_number().over(one)).where("_pg_nth = 1")
    return kept.select("_pg_row.*")

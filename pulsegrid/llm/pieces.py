"""SentencePiece encoding and decoding by a batched Viterbi search.

Texts are cut into words (a run of word marks and the characters up to the next mark); no piece
reaches over such a border, so distinct words are encoded once per batch. Words of equal length
advance together, one character at a time: the hashes of all substrings that end there probe the
sorted piece keys, and the maximum over the substrings' lengths stores a backpointer per word.

* Unigram models maximise the sum of the pieces' scores.
* BPE models are defined by merges, not by sums. There a step is allowed only if merging the two
  pieces' text gives just these two pieces; a segmentation in which every neighbouring pair is
  allowed is the one that the merges give, and of all pieces that can end a prefix exactly one
  is allowed. So the same search with these 0 / -infinity transitions gives the model's own ids.

A character without a piece becomes its UTF-8 bytes' pieces (or the unknown piece if the model
has no bytes). Decoding joins the pieces' bytes and drops the blank that encoding puts in front.

Defined cases: null gives null ids; the empty text no ids; the word mark itself (U+2581) comes
back as a blank; invalid bytes decode to U+FFFD; other columns are ignored.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm.common import pieces as ranges
from pulsegrid.llm.common import ragged

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Longer words are few: they go through the same search one by one.
LONG_WORD = 48
_CHARS = 2_000_000
_CACHED_WORDS = 400_000
_SIEVE_BITS = 20
_PAIR_BITS = 21
_UNKNOWN_PENALTY = 10.0


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(field number, value) of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
        else:
            size = varint() if tag & 7 == 2 else {1: 8, 5: 4}[tag & 7]
            yield tag >> 3, data[at : at + size]
            at += size


@dataclass
class PieceModel:
    pieces: list[str]
    scores: np.ndarray
    kinds: np.ndarray
    kind: int
    prefix: bool
    ids: dict[str, int] = field(default_factory=dict)

    def __post_init__(self):
        self.ids = {p: i for i, p in enumerate(self.pieces) if self.kinds[i] in (NORMAL, USER)}
        self.unknown = int(np.flatnonzero(self.kinds == UNKNOWN)[0])
        self.bytes = np.full(256, self.unknown, dtype=np.int32)
        for i in np.flatnonzero(self.kinds == BYTE):
            self.bytes[int(self.pieces[i][1:-1], 16)] = i
        self.longest = max(map(len, self.ids), default=1)
        self.unknown_score = float(self.scores[list(self.ids.values())].min()) - _UNKNOWN_PENALTY if self.ids else 0.0
        self._index()
        order = np.unique(-self.scores, return_inverse=True)[1]
        self.rank = order.tolist()
        tied = np.bincount(order)[order] > 1
        self.tied = {i for i in self.ids.values() if tied[i]}
        inner = any(MARK in p.lstrip(MARK) for p in self.ids)
        newline = any("\n" in p for p in self.ids)
        # a word border must be one that no piece crosses
        self.words = re.compile("(?s).+" if inner else f"{MARK}+[^{MARK}]*|[^{MARK}]+" if newline else f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n")
        self.parts: dict[int, tuple[int, int] | None] = {}
        self.pair_keys = np.full(1 << _PAIR_BITS, -1, dtype=np.int64)
        self.pair_ok = np.zeros(1 << _PAIR_BITS, dtype=bool)
        if self.kind == BPE:
            for p, i in self.ids.items():
                made, parts = self.merge(list(p))
                if made == [i]:
                    self.parts[i] = parts
        self.whole = np.zeros(len(self.pieces), dtype=bool)
        self.whole[list(self.parts) if self.kind == BPE else list(self.ids.values())] = True
        texts = [self._bytes_of(i) for i in range(len(self.pieces))]
        self.text = np.frombuffer(b"".join(texts), dtype=np.uint8)
        self.text_n = np.array([len(t) for t in texts], dtype=np.int64)
        self.text_at = np.cumsum(self.text_n) - self.text_n

    def _bytes_of(self, i: int) -> bytes:
        if self.kinds[i] == BYTE:
            return bytes([int(self.pieces[i][1:-1], 16)])
        if self.kinds[i] == CONTROL:
            return b""
        return " ⁇ ".encode() if self.kinds[i] == UNKNOWN else self.pieces[i].replace(MARK, " ").encode()

    def _index(self) -> None:
        """Sorted keys of all pieces, with their characters for an exact comparison."""
        names = list(self.ids)
        self.codes = np.zeros((len(names), self.longest), dtype=np.uint32)
        for row, name in enumerate(names):
            self.codes[row, : len(name)] = [ord(c) for c in name]
        hashes = np.array([self._hash(self.codes[row, : len(name)]) for row, name in enumerate(names)], dtype=np.uint64)
        order = np.argsort(hashes, kind="stable")
        self.keys, self.codes = hashes[order], self.codes[order]
        self.maybe = np.zeros(1 << _SIEVE_BITS, dtype=bool)
        self.maybe[hashes >> np.uint64(64 - _SIEVE_BITS)] = True
        self.key_ids = np.array(list(self.ids.values()), dtype=np.int64)[order]

    @staticmethod
    def _hash(codes: np.ndarray) -> np.uint64:
        value = np.uint64(0)
        with np.errstate(over="ignore"):
            for c in codes:
                value = value * _BASE + np.uint64(c) + np.uint64(1)
        return value

    def merge(self, symbols: list[str]) -> tuple[list[int], tuple[int, int] | None]:
        """Merge the best neighbouring pair, leftmost of equals, until none is a piece; the last pair."""
        parts = None
        while len(symbols) > 1:
            found = [(self.rank[i], at, i) for at in range(len(symbols) - 1) if (i := self.ids.get(symbols[at] + symbols[at + 1])) is not None]
            if not found:
                break
            _, at, _ = min(found)
            parts = (self.ids.get(symbols[at], -1), self.ids.get(symbols[at + 1], -1))
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return [self.ids.get(s, -1) for s in symbols], parts

    def allowed(self, a: int, b: int) -> bool:
        """Do the merges turn the text of these two pieces into just these two pieces?

        Merges inside either piece are undone from the last one back; meanwhile the symbols at
        the border must not form a piece that is due before the merge that was undone.
        """
        if a not in self.parts or b not in self.parts:
            return False
        if a in self.tied or b in self.tied:
            return self.merge(list(self.pieces[a] + self.pieces[b]))[0] == [a, b]
        x, y, due = a, b, float("inf")
        while True:
            joined = self.ids.get(self.pieces[x] + self.pieces[y])
            if joined is not None and self.rank[joined] < due:
                return False
            left, right = self.parts[x], self.parts[y]
            if left is None and right is None:
                return True
            if right is None or (left is not None and self.rank[x] > self.rank[y]):
                if min(left) < 0 or left[1] not in self.parts:
                    return self.merge(list(self.pieces[a] + self.pieces[b]))[0] == [a, b]
                due, x = self.rank[x], left[1]
            else:
                if min(right) < 0 or right[0] not in self.parts:
                    return self.merge(list(self.pieces[a] + self.pieces[b]))[0] == [a, b]
                due, y = self.rank[y] + 0.5, right[0]  # of equal merges the one on the left comes first

    def _find(self, hashes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, piece ids) of the substrings (rows of ``codes``) that are pieces."""
        rows = np.flatnonzero(self.maybe[hashes >> np.uint64(64 - _SIEVE_BITS)])
        some = hashes[rows]
        at = np.minimum(np.searchsorted(self.keys, some), len(self.keys) - 1)
        same = self.keys[at] == some
        rows, at = rows[same], at[same]
        n = codes.shape[1]
        same = (self.codes[at, :n] == codes[rows]).all(axis=1)
        if n < self.longest:
            same &= self.codes[at, n] == 0
        return rows[same], self.key_ids[at[same]]

    def _steps(self, before: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Which steps from a piece (-1: the start or an unknown character) to a piece are allowed.

        Pairs are remembered in a table of fixed size; a pair may push out another one.
        """
        ok = self.whole[piece]
        if self.kind != BPE:
            return ok
        inner = np.flatnonzero(ok & (before >= 0))
        n = len(self.pieces)
        keys = before[inner] * n + piece[inner]
        with np.errstate(over="ignore"):
            slot = (keys.astype(np.uint64) * _BASE) >> np.uint64(64 - _PAIR_BITS)
        known = self.pair_keys[slot] == keys
        allowed = self.pair_ok[slot]
        if not known.all():
            fresh = np.flatnonzero(~known)
            pairs, at = np.unique(keys[fresh], return_inverse=True)
            found = np.fromiter((self.allowed(k // n, k % n) for k in pairs.tolist()), dtype=bool, count=len(pairs))
            allowed[fresh] = found[at]
            self.pair_keys[slot[fresh]], self.pair_ok[slot[fresh]] = keys[fresh], found[at]
        ok[inner] = allowed
        return ok

    def search(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """(pieces of words of one length, number for each); -1 - (code point) is a character without one."""
        length = len(words[0])
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).reshape(-1, length)
        n = len(codes)
        prefix = np.zeros((length + 1, n), dtype=np.uint64)
        powers = np.ones(self.longest + 1, dtype=np.uint64)
        last = np.full((length + 1, n), -1, dtype=np.int64)
        back = np.ones((length + 1, n), dtype=np.int32)
        total = np.full((length + 1, n), -np.inf)
        total[0] = 0
        with np.errstate(over="ignore"):
            for i in range(1, length + 1):
                prefix[i] = prefix[i - 1] * _BASE + codes[:, i - 1] + np.uint64(1)
            for size in range(1, len(powers)):
                powers[size] = powers[size - 1] * _BASE
            for i in range(1, length + 1):
                # without any piece a character stands for itself
                total[i] = 0.0 if self.kind == BPE else total[i - 1] + self.unknown_score
                for size in range(1, min(i, self.longest) + 1):
                    start = i - size
                    some, found = self._find(prefix[i] - prefix[start] * powers[size], codes[:, start:i])
                    ok = self._steps(last[start, some], found)
                    some, found = some[ok], found[ok]
                    score = float(size) if self.kind == BPE else total[start, some] + self.scores[found]
                    better = score > total[i, some]
                    some = some[better]
                    total[i, some] = score if self.kind == BPE else score[better]
                    last[i, some], back[i, some] = found[better], size
        return self._walk(codes, last, back)

    @staticmethod
    def _walk(codes: np.ndarray, last: np.ndarray, back: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, length = codes.shape
        at, rows = np.full(n, length), np.arange(n)
        made, used = np.zeros((n, length), dtype=np.int64), np.zeros((n, length), dtype=bool)
        for column in range(length - 1, -1, -1):
            rows = rows[at[rows] > 0]
            if not len(rows):
                break
            here = at[rows]
            piece = last[here, rows]
            made[rows, column] = np.where(piece >= 0, piece, -1 - codes[rows, here - 1].astype(np.int64))
            used[rows, column] = True
            at[rows] -= back[here, rows]
        return made[used], used.sum(axis=1)

    def search_one(self, word: str) -> np.ndarray:
        """The same search over one long word."""
        last, back, total = [-1], [1], [0.0]
        for i in range(1, len(word) + 1):
            best, piece, step = 0.0 if self.kind == BPE else total[i - 1] + self.unknown_score, -1, 1
            for size in range(1, min(i, self.longest) + 1):
                found = self.ids.get(word[i - size : i])
                before = last[i - size]
                if found is None:
                    continue
                if not self.whole[found] or (self.kind == BPE and before >= 0 and not self.allowed(before, found)):
                    continue
                score = float(size) if self.kind == BPE else total[i - size] + self.scores[found]
                if score > best:
                    best, piece, step = score, found, size
            last.append(piece)
            back.append(step)
            total.append(best)
        made, at = [], len(word)
        while at:
            made.append(last[at] if last[at] >= 0 else -1 - ord(word[at - 1]))
            at -= back[at]
        return np.array(made[::-1], dtype=np.int64)

    def _with_bytes(self, found: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids, with bytes in place of characters without a piece."""
        odd = np.flatnonzero(found < 0)
        if not len(odd):
            return found.astype(np.int32), counts
        filled = [self.bytes[list(chr(-1 - x).encode("utf-8", "replace"))] for x in found[odd].tolist()]
        if self.bytes.max() == self.unknown:
            filled = [x[:1] for x in filled]
        sizes = np.ones(len(found), dtype=np.int64)
        sizes[odd] = [len(x) for x in filled]
        out = np.repeat(found, sizes)
        starts = np.cumsum(sizes) - sizes
        out[ragged(starts[odd], sizes[odd])] = np.concatenate(filled)
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])]
        return out.astype(np.int32), np.diff(ends)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words one after another, number for each)."""
        lengths = np.array([len(w) for w in words])
        order = np.argsort(lengths, kind="stable")
        flats, sizes = [], []
        for group in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
            some = [words[i] for i in group.tolist()]
            if len(some[0]) > LONG_WORD:
                each = [self.search_one(w) for w in some]
                found, counts = np.concatenate(each), np.array([len(x) for x in each], dtype=np.int64)
            else:
                found, counts = self.search(some)
            found, counts = self._with_bytes(found, counts)
            flats.append(found)
            sizes.append(counts)
        flat, size = np.concatenate(flats), np.concatenate(sizes)
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        at = np.cumsum(size) - size
        return flat[ragged(at[back], size[back])], size[back]

    def split(self, text: str) -> list[str]:
        if not text:
            return []
        return self.words.findall((MARK if self.prefix else "") + text.replace(" ", MARK))


class Encoder:
    """Encodes batches of texts; remembers the words of earlier batches, a bounded number."""

    def __init__(self, model: PieceModel):
        self.model = model
        self._reset()

    def _reset(self) -> None:
        self.index: dict[str, int] = {}
        self.flat = np.zeros(0, dtype=np.int32)
        self.at = self.n = np.zeros(0, dtype=np.int64)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids one after another, number of ids of each text)."""
        if len(self.index) > _CACHED_WORDS:
            self._reset()
        known, index = len(self.index), self.index
        words = [[index.setdefault(w, len(index)) for w in self.model.split(t or "")] for t in texts]
        if len(index) > known:
            fresh, n = self.model.encode_words(list(islice(index, known, None)))
            self.at = np.concatenate([self.at, len(self.flat) + np.cumsum(n) - n])
            self.n = np.concatenate([self.n, n])
            self.flat = np.concatenate([self.flat, fresh])
        counts = np.array([len(w) for w in words], dtype=np.int64)
        used = np.fromiter(chain.from_iterable(words), dtype=np.int64, count=int(counts.sum()))
        ids = self.flat[ragged(self.at[used], self.n[used])]
        ends = np.concatenate([[0], np.cumsum(self.n[used])])[np.concatenate([[0], np.cumsum(counts)])]
        return ids, np.diff(ends)


def decode(model: PieceModel, ids: np.ndarray, counts: np.ndarray) -> list[str]:
    """Texts of ids that lie one after another."""
    sizes = model.text_n[ids]
    raw = model.text[ragged(model.text_at[ids], sizes)].tobytes()
    ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])]
    out = []
    for low, high in zip(ends[:-1].tolist(), ends[1:].tolist()):
        if model.prefix and raw[low : low + 1] == b" ":
            low += 1
        out.append(raw[low:high].decode("utf-8", "replace"))
    return out


def read_model(data: bytes) -> PieceModel:
    """The model in a SentencePiece ``.model`` file; only models without character rules."""
    pieces, scores, kinds, kind, prefix = [], [], [], UNIGRAM, True
    for number, value in _fields(data):
        if number == 1:
            one = dict(_fields(value))
            pieces.append(one.get(1, b"").decode())
            scores.append(struct.unpack("<f", one[2])[0] if 2 in one else 0.0)
            kinds.append(one.get(3, NORMAL))
        elif number == 2:
            kind = dict(_fields(value)).get(3, kind)
        elif number == 3:
            rules = dict(_fields(value))
            prefix = bool(rules.get(3, 1))
            if rules.get(2) or rules.get(4, 1) or not rules.get(5, 1):
                raise ValueError("models with character rules or that drop white space are not supported")
    if kind not in (UNIGRAM, BPE):
        raise ValueError(f"model type {kind} is neither unigram nor BPE")
    return PieceModel(pieces, np.array(scores, dtype=np.float64), np.array(kinds), kind, prefix)


def load_model(path: str) -> PieceModel:
    with open(path, "rb") as file:
        return read_model(file.read())


_ENCODERS: dict[int, Encoder] = {}


def _encoder(sent) -> Encoder:
    """One encoder for each worker and broadcast model."""
    key = id(sent.value)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(sent.value)
    return _ENCODERS[key]


def encode_documents(docs: DataFrame, model: PieceModel, key: str = "doc_id") -> DataFrame:
    """key, token_ids, n_tokens and round_trip (decoding gives the text back) of whole texts."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = dict(docs.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(sent)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for low, high in ranges([len(t or "") for t in texts], _CHARS):
                some = texts[low:high]
                ids, counts = encoder.encode(some)
                back = decode(encoder.model, ids, counts)
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32), mask=np.array([t is None for t in some] + [False]))
                yield pa.record_batch(
                    [batch.column(0).slice(low, high - low), pa.ListArray.from_arrays(offsets, pa.array(ids)), pa.array(counts), pa.array([t is None or t == b for t, b in zip(some, back)])],
                    names=[key, "token_ids", "n_tokens", "round_trip"],
                )

    return docs.select(key, "text").mapInArrow(run, f"{key} {kind}, token_ids array<int>, n_tokens long, round_trip boolean")


def decode_documents(encoded: DataFrame, model: PieceModel, key: str = "doc_id") -> DataFrame:
    """key, text from key, token_ids; null ids give null; ids outside the model are an error."""
    sent = encoded.sparkSession.sparkContext.broadcast(model)
    kind = dict(encoded.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            counts = np.array([0 if x is None else x for x in lists.value_lengths().to_pylist()], dtype=np.int64)
            ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            texts = [t if ok else None for t, ok in zip(decode(sent.value, ids, counts), lists.is_valid().to_pylist())]
            yield pa.record_batch([batch.column(0), pa.array(texts, pa.string())], names=[key, "text"])

    return encoded.select(key, "token_ids").mapInArrow(run, f"{key} {kind}, text string")

"""Encoding of a corpus with a public byte-level BPE tokenizer.

Method: pair occurrence index. The different words of a block of texts that the worker has not met yet lie in one linked
list of symbols; every adjacent pair is mapped to all its positions, the active ranks are applied in ascending order, and
each merge updates the lists of the pairs it touches. A merge thus costs its occurrences, however long the words are.

Token files are read from a path that is a parameter; the driver reads the file once and broadcasts its bytes (its size
is that of the vocabulary, not of the data).
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Default vocabulary file: lines of base64 token and rank.
BYTE_BPE_50K = "/opt/tokenizers/byte_bpe_50k.tiktoken"

# Fixed value: the pattern that splits text into words before the merges of the byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Characters of a block that is indexed at once, and words kept by a worker; both bound memory, neither changes results.
BLOCK_CHARS = 1 << 21
KEPT_WORDS = 400_000


class PairIndexEncoder:
    """Encodes words with a rank table through an index from pairs to their positions."""

    def __init__(self, vocabulary: bytes) -> None:
        self.rank = {base64.b64decode(a): int(b) for a, b in (line.split() for line in vocabulary.splitlines() if line)}
        self.token = {r: t for t, r in self.rank.items()}
        self.byte = [self.rank[bytes([b])] for b in range(256)]
        self.joined: dict[tuple[int, int], int] = {}
        self.find = regex.compile(PATTERN).findall
        self.reset()

    def reset(self) -> None:
        """Forgets the words kept so far."""
        self.word: dict[str, int] = {}
        self.starts = np.zeros(0, np.int64)
        self.sizes = np.zeros(0, np.int32)
        self.pool = np.zeros(0, np.int32)

    def pair_rank(self, pair: tuple[int, int]) -> int:
        """Rank (and id) of the token that joins a pair; -1 if there is none."""
        got = self.joined.get(pair)
        if got is None:
            got = self.joined[pair] = self.rank.get(self.token[pair[0]] + self.token[pair[1]], -1)
        return got

    def merge(self, words: list[str]) -> list[list[int]]:
        """Ids of each word."""
        byte, sym, ends = self.byte, [], []
        for w in words:
            sym.extend([byte[b] for b in w.encode("utf-8", "surrogatepass")])
            ends.append(len(sym))
        n = len(sym)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        start = 0
        for e in ends:  # lists end at word ends
            if e > start:
                after[e - 1], before[start] = -1, -1
            start = e
        at: dict[tuple[int, int], list[int]] = {}
        for i in range(n):
            j = after[i]
            if j >= 0:
                at.setdefault((sym[i], sym[j]), []).append(i)
        rank = self.pair_rank
        active = [(r, p) for p in at if (r := rank(p)) >= 0]
        heapq.heapify(active)
        while active:
            r, pair = heapq.heappop(active)
            a, b = pair
            opened: set[tuple[int, int]] = set()
            places = at.pop(pair, None)
            if places is None:
                continue
            places.sort()  # left to right, so that of overlapping occurrences the left one joins
            for i in places:
                j = after[i]
                if j < 0 or sym[i] != a or sym[j] != b:
                    continue
                sym[i], sym[j] = r, -1
                k = after[i] = after[j]
                if k >= 0:
                    before[k] = i
                    p = (r, sym[k])
                    at.setdefault(p, []).append(i)
                    opened.add(p)
                h = before[i]
                if h >= 0:
                    p = (sym[h], r)
                    at.setdefault(p, []).append(h)
                    opened.add(p)
            for p in opened:
                q = rank(p)
                if q >= 0:
                    heapq.heappush(active, (q, p))
        out, start = [], 0
        for e in ends:
            out.append([s for s in sym[start:e] if s >= 0])
            start = e
        return out

    def keep(self, words: set[str]) -> None:
        """Encodes words that are not kept yet and keeps them."""
        new = sorted(words)
        ids = self.merge(new)
        size = np.fromiter(map(len, ids), np.int32, len(ids))
        flat = np.fromiter((x for i in ids for x in i), np.int32, int(size.sum()))
        first = len(self.pool) + np.concatenate([[0], np.cumsum(size[:-1], dtype=np.int64)]) if len(size) else np.zeros(0, np.int64)
        base = len(self.word)
        self.word.update(zip(new, range(base, base + len(new))))
        self.starts, self.sizes, self.pool = np.concatenate([self.starts, first]), np.concatenate([self.sizes, size]), np.concatenate([self.pool, flat])

    def indexed(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of words of each text, and the kept index of each word of all texts."""
        if len(self.word) > KEPT_WORDS:
            self.reset()
        words: list[str] = []
        counts = np.zeros(len(texts), np.int64)
        for i, t in enumerate(texts):
            if t:
                got = self.find(t)
                counts[i] = len(got)
                words += got
        unknown = set(words).difference(self.word)
        if unknown:
            self.keep(unknown)
        return counts, np.fromiter(map(self.word.__getitem__, words), np.int64, len(words))

    def lengths(self, texts: list[str]) -> np.ndarray:
        """Number of ids of each text."""
        counts, at = self.indexed(texts)
        total = np.concatenate([[0], np.cumsum(self.sizes[at], dtype=np.int64)])
        ends = np.cumsum(counts)
        return total[ends] - total[ends - counts]

    def encode(self, texts: list[str]) -> pa.ListArray:
        """Ids of each text."""
        counts, at = self.indexed(texts)
        size = self.sizes[at].astype(np.int64)
        total = np.concatenate([[0], np.cumsum(size)])
        place = np.repeat(self.starts[at] - total[:-1], size) + np.arange(total[-1])
        offsets = total[np.concatenate([[0], np.cumsum(counts)])]
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(self.pool[place], pa.int32()))


_ENCODER: dict[int, PairIndexEncoder] = {}


def encoder(vocabulary: bytes) -> PairIndexEncoder:
    """The worker's encoder for a vocabulary."""
    key = hash(vocabulary)
    if key not in _ENCODER:
        _ENCODER.clear()
        _ENCODER[key] = PairIndexEncoder(vocabulary)
    return _ENCODER[key]


def blocks(texts: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """Consecutive texts of about :data:`BLOCK_CHARS` characters, with the index of the first."""
    start, size, held = 0, 0, []
    for t in texts.to_pylist():
        held.append(t)
        size += len(t or "")
        if size >= BLOCK_CHARS:
            yield start, held
            start, size, held = start + len(held), 0, []
    if held:
        yield start, held


def _vocabulary(df: DataFrame, path: str):
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def token_ids(df: DataFrame, path: str = BYTE_BPE_50K, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, ids ARRAY<INT>)`` of each row, without special tokens.

    Null and empty texts give the empty list; a blank text gives the ids of its blanks; strings of special tokens are
    ordinary text; rows with a null or repeated key stay rows of their own. One pass, no shuffle.
    """
    held = _vocabulary(df, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(held.value)
        for b in batches:
            for first, texts in blocks(b.column(1)):
                yield pa.RecordBatch.from_arrays([b.column(0).slice(first, len(texts)), e.encode(texts)], names=[key, "ids"])

    source = df.select(key, text)
    return source.mapInArrow(run, f"{key} {source.schema[key].dataType.simpleString()}, ids array<int>")


def token_counts(df: DataFrame, path: str = BYTE_BPE_50K, key: str = "doc_id", text: str = "text", also: tuple[str, ...] = ()) -> DataFrame:
    """``(key, *also, tokens BIGINT)`` of each row; 0 for null and empty texts. The ids themselves are not built.

    ``also`` names columns that travel with their row, so that null and repeated keys need no join.
    """
    held = _vocabulary(df, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(held.value)
        for b in batches:
            for first, texts in blocks(b.column(1)):
                n = len(texts)
                kept = [b.column(0).slice(first, n), *[c.slice(first, n) for c in b.columns[2:]]]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(e.lengths(texts), pa.int64())], names=[key, *also, "tokens"])

    source = df.select(key, text, *also)
    types = ", ".join(f"`{c}` {source.schema[c].dataType.simpleString()}" for c in (key, *also))
    return source.mapInArrow(run, f"{types}, tokens bigint")

"""Byte-level BPE: whole pre-tokens by a minimal perfect hash, the rest by merging linked bytes from a heap.

Tasks get the vocabulary as a broadcast, whose size is that of the vocabulary file. Ids travel as
the little-endian unsigned 32-bit integers of flat token files.
"""

from __future__ import annotations

import heapq
import itertools
import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
import xxhash
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Pre-tokens whose ids a worker remembers; beyond it starts anew, and keeps as many older ones at hand.
MEMO = 350_000
# Of longer texts, not all pre-tokens are held at a time.
LONG_TEXT = 1 << 22
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_TRIES = 256


def _slot(hashes: np.ndarray, seeds: np.ndarray, n: int) -> np.ndarray:
    x = hashes ^ (seeds.astype(np.uint64) * _GOLD)
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return ((x ^ (x >> np.uint64(29))) % np.uint64(n)).astype(np.int64)


def _hashes(keys: Iterable[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64)


@dataclass
class PerfectHash:
    """A place in 0..n-1 of its own for each of n keys; other keys land anywhere.

    Keys fall into buckets; each bucket stores the seed that sends its keys to free places. Buckets
    of one key store the place itself, as -1 - place, so that no place stays free.
    """

    seeds: np.ndarray
    n: int

    @classmethod
    def build(cls, keys: list[bytes]) -> PerfectHash:
        n = len(keys)
        buckets = max(1, n // 4)
        hashes = _hashes(keys)
        if len(np.unique(hashes)) < n:
            raise ValueError("keys repeat or collide")
        bucket = (hashes % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        ends = np.cumsum(np.bincount(bucket, minlength=buckets))
        sizes = np.diff(ends, prepend=0)
        seeds, taken = np.zeros(buckets, np.int64), np.zeros(n, bool)
        for b in np.argsort(-sizes, kind="stable"):
            if sizes[b] < 2:
                break
            own = hashes[order[ends[b] - sizes[b] : ends[b]]]
            first = 0
            while True:
                tries = np.arange(first, first + _TRIES)
                places = _slot(own[None, :], tries[:, None], n)
                ordered = np.sort(places, axis=1)
                good = ~taken[places].any(axis=1) & (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)
                if good.any():
                    at = int(good.argmax())
                    seeds[b], taken[places[at]] = first + at, True
                    break
                first += _TRIES
        seeds[sizes == 1] = -1 - np.flatnonzero(~taken)[: int((sizes == 1).sum())]
        return cls(seeds, n)

    def places(self, keys: list[bytes]) -> np.ndarray:
        hashes = _hashes(keys)
        seeds = self.seeds[(hashes % np.uint64(len(self.seeds))).astype(np.int64)]
        return np.where(seeds < 0, -1 - seeds, _slot(hashes, np.maximum(seeds, 0), self.n))


def merge_bytes(piece: bytes, ranks: dict[bytes, int], longest: int) -> list[int]:
    """Ids of one pre-token: the adjacent pair of lowest rank merges first, the leftmost of equals.

    end[i] is where the part that starts at i ends, 0 once it was merged into the part before.
    A heap entry is stale when one of its parts has changed. O(n log n) for n bytes.
    """
    n = len(piece)
    end, before = list(range(1, n + 1)), list(range(-1, n))
    heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, left, right, stop = heapq.heappop(heap)
        if end[left] != right or end[right] != stop:
            continue
        end[left], end[right] = stop, 0
        if stop < n:
            before[stop] = left
            if end[stop] - left <= longest and (r := ranks.get(piece[left : end[stop]])) is not None:
                heapq.heappush(heap, (r, left, stop, end[stop]))
        first = before[left]
        if first >= 0 and stop - first <= longest and (r := ranks.get(piece[first:stop])) is not None:
            heapq.heappush(heap, (r, first, left, stop))
    ids, at = [], 0
    while at < n:
        ids.append(ranks[piece[at : end[at]]])
        at = end[at]
    return ids


class Encoder:
    """Encodes texts in one worker. Memory: the vocabulary, twice MEMO pre-tokens, one text and its ids."""

    def __init__(self, tokens: list[bytes], hash_: PerfectHash, order: np.ndarray, pattern: str):
        self.tokens, self.hash, self.order = tokens, hash_, order
        self.pattern = regex.compile(pattern)
        self.ranks = {t: r for r, t in enumerate(tokens) if t}
        self.longest = max(map(len, tokens))
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _learn(self, pieces: list[str]) -> None:
        keys = [p.encode("utf-8", "surrogatepass") for p in pieces]
        ranks = self.order[self.hash.places(keys)].tolist()
        for piece, key, rank in zip(pieces, keys, ranks, strict=True):
            ids = [rank] if self.tokens[rank] == key else merge_bytes(key, self.ranks, self.longest)
            self.memo[piece] = struct.pack(f"<{len(ids)}I", *ids)

    def _ids(self, pieces: list[str]) -> bytes:
        memo, older = self.memo, self.older
        if len(memo) > MEMO:
            self.memo, self.older = memo, older = {}, memo
        new = [p for p in set(pieces) if p not in memo]
        if new:
            memo.update((p, older[p]) for p in new if p in older)
            self._learn([p for p in new if p not in memo])
        return b"".join(map(memo.__getitem__, pieces))

    def encode(self, text: str) -> bytes:
        if len(text) <= LONG_TEXT:
            return self._ids(self.pattern.findall(text))
        found = (m.group() for m in self.pattern.finditer(text))
        return b"".join(iter(lambda: self._ids(list(itertools.islice(found, LONG_TEXT // 8))), b""))


_encoders: list[Encoder] = []


def encoder_of(vocabulary: tuple) -> Encoder:
    """The worker's encoder for a vocabulary; the tasks that it runs one after the other share what it remembers."""
    if not _encoders or _encoders[0].tokens is not vocabulary[0]:
        _encoders[:] = [Encoder(*vocabulary)]
    return _encoders[0]


class BytePairs:
    """Encoding and decoding columns for one vocabulary.

    tokens: bytes of each rank, every single byte among them. pattern: each match in a text is
    encoded separately, text between matches is left out, special tokens are ordinary text.
    """

    def __init__(self, spark: SparkSession, tokens: list[bytes], pattern: str):
        missing = [b for b in range(256) if bytes([b]) not in set(tokens)]
        if missing:
            raise ValueError(f"the vocabulary lacks the bytes {missing}")
        ranks = [r for r, t in enumerate(tokens) if t]
        keys = [tokens[r] for r in ranks]
        hash_ = PerfectHash.build(keys)
        order = np.zeros(len(keys), np.int64)
        order[hash_.places(keys)] = ranks
        self._vocabulary = spark.sparkContext.broadcast((tokens, hash_, order, pattern))

    def encode(self, text: Column) -> Column:
        """Ids of a text as little-endian unsigned 32-bit integers; null and empty texts have none."""
        vocabulary = self._vocabulary

        @F.pandas_udf("binary")
        def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            encoder = encoder_of(vocabulary.value)
            for texts in batches:
                yield pd.Series([encoder.encode(t) if t else b"" for t in texts], dtype=object)

        return encode(text)

    def decode(self, ids: Column) -> Column:
        """Bytes of such ids; null for null. An id outside the vocabulary is an error."""
        vocabulary = self._vocabulary

        @F.pandas_udf("binary")
        def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            token = vocabulary.value[0].__getitem__
            for packed in batches:
                yield pd.Series([None if p is None else b"".join(map(token, np.frombuffer(p, "<u4").tolist())) for p in packed], dtype=object)

        return decode(ids)

"""Byte-level BPE: encoding and decoding of whole texts by a table of ranks.

A pre-token that is in the vocabulary is resolved whole by a minimal perfect hash: one slot per
vocabulary entry, one comparison per look-up. Others are merged by rank with a heap over a
linked list of their bytes, so a pre-token of n bytes costs n log n. Results stay in the
worker's bounded memory. The table is read on every worker from ``path``; no row is shuffled.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from risklake.llm.pretokens import PATTERN, Memory, Pretokens
from risklake.llm.words import blocks, utf8


class PerfectHash:
    """Minimal perfect hash of byte strings: hash, displace, and rank.

    Keys fall into buckets; every bucket, the fullest first, gets the first displacement that
    sends its keys to free places among ``SPREAD`` times as many as there are keys. The rank of a
    place among the taken ones is the key's slot, so there is one slot a key.
    """

    SPREAD = 1.25

    def __init__(self, keys: list[bytes], values: list[int]):
        self.places = max(1, int(len(keys) * self.SPREAD))
        self.buckets = max(1, len(keys) // 3)
        hashed = [xxhash.xxh3_64_intdigest(k) for k in keys]
        buckets: list[list[int]] = [[] for _ in range(self.buckets)]
        for i, h in enumerate(hashed):
            buckets[h % self.buckets].append(i)
        self.shift = [0] * self.buckets
        taken = [-1] * self.places
        for b in sorted(range(self.buckets), key=lambda x: -len(buckets[x])):
            shift = 0
            while True:
                at = [self._place(hashed[i], shift) for i in buckets[b]]
                if all(taken[p] < 0 for p in at) and len(set(at)) == len(at):
                    break
                shift += 1
            self.shift[b] = shift
            for i, p in zip(buckets[b], at):
                taken[p] = i
        order = [i for i in taken if i >= 0]
        self.rank = np.cumsum(np.array(taken) >= 0).tolist()
        self.keys = [keys[i] for i in order]
        self.values = [values[i] for i in order]

    def _place(self, hashed: int, shift: int) -> int:
        return (((hashed ^ (shift * 0x9E3779B97F4A7C15)) * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF) >> 24) % self.places

    def get(self, key: bytes) -> int | None:
        hashed = xxhash.xxh3_64_intdigest(key)
        slot = self.rank[self._place(hashed, self.shift[hashed % self.buckets])] - 1
        return self.values[slot] if slot >= 0 and self.keys[slot] == key else None


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        pairs = [line.split() for line in file if line.strip()]
    return {base64.b64decode(a): int(b) for a, b in pairs}


class Vocabulary:
    """Ranks of byte strings, and a perfect hash of them."""

    def __init__(self, path: str):
        self.ranks = read_ranks(path)
        self.pairs = {tuple(key): rank for key, rank in self.ranks.items() if len(key) == 2}
        self.whole = PerfectHash(list(self.ranks), list(self.ranks.values()))

    def encode_piece(self, piece: bytes) -> bytes:
        """Ids of one pre-token, packed as 32-bit integers: remembered ids stay small."""
        found = self.whole.get(piece)
        return array("i", [found] if found is not None else self.merge(piece)).tobytes()

    def merge(self, piece: bytes) -> list[int]:
        """Merges the pair of lowest rank, the leftmost of equals, until none is left.

        Heap entries are rank, left place and end in one number. One is outdated unless its left
        place still starts a part and the part behind it still ends where it did.
        """
        n, rank_of = len(piece), self.ranks.get
        after = list(range(1, n + 2))
        before = list(range(-1, n))
        heap = [
            r << 64 | i << 32 | i + 2
            for i, pair in enumerate(zip(piece, piece[1:]))
            if (r := self.pairs.get(pair)) is not None
        ]
        heapq.heapify(heap)
        while heap:
            top = heapq.heappop(heap)
            left, end = top >> 32 & 0xFFFFFFFF, top & 0xFFFFFFFF
            middle = after[left]
            if middle < 0 or middle >= n or after[middle] != end:
                continue
            after[left] = end
            after[middle] = -1
            if end < n:
                before[end] = left
                stop = after[end]
                if (r := rank_of(piece[left:stop])) is not None:
                    heapq.heappush(heap, r << 64 | left << 32 | stop)
            start = before[left]
            if start >= 0 and (r := rank_of(piece[start:end])) is not None:
                heapq.heappush(heap, r << 64 | start << 32 | end)
        out, at = [], 0
        while at < n:
            stop = after[at]
            out.append(rank_of(piece[at:stop]))
            at = stop
        return out


class Pieces:
    """Byte strings by rank, all a worker needs to decode."""

    def __init__(self, path: str):
        ranks = read_ranks(path)
        parts = [b""] * (max(ranks.values(), default=-1) + 1)
        for key, rank in ranks.items():
            parts[rank] = key
        self.bytes = np.frombuffer(b"".join(parts), np.uint8)
        self.ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])])

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all ids, and the place behind each id's."""
        first, size = self.ends[ids], self.ends[ids + 1] - self.ends[ids]
        stop = np.cumsum(size)
        at = np.repeat(first - (stop - size), size) + np.arange(int(stop[-1]) if len(stop) else 0)
        return self.bytes[at], stop


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=2)
def _pieces(path: str) -> Pieces:
    return Pieces(path)


@lru_cache(maxsize=2)
def _memory(path: str) -> Memory:
    known = vocabulary(path)
    return Memory(lambda pieces: map(known.encode_piece, pieces))


def _columns(df: DataFrame, *drop: str) -> list[str]:
    return [f"`{n}` {t}" for n, t in df.dtypes if n not in drop]


def _encoding(path: str, kept: list[str], text_col: str, ids_col: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memory = _memory(path)
    for batch in batches:
        for block in blocks(batch, text_col):
            cut = Pretokens(*utf8(block.column(text_col)))
            pieces, which = cut.distinct()
            found = memory.values(pieces)
            size = np.fromiter(map(len, found), np.int64, len(found)) // 4
            known = np.frombuffer(b"".join(found), np.int32)
            first, size = (np.cumsum(size) - size)[which], size[which]
            ends = np.concatenate([[0], np.cumsum(size)])
            at = np.repeat(first - ends[:-1], size) + np.arange(ends[-1])
            ids = pa.ListArray.from_arrays(pa.array(ends[cut.rows].astype(np.int32)), pa.array(known[at]))
            yield pa.record_batch({n: block.column(n) for n in kept} | {ids_col: ids})


def _decoding(path: str, kept: list[str], ids_col: str, bytes_col: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = _pieces(path)
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            lists = part.column(ids_col)
            size = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            data, stop = known.decode(lists.flatten().to_numpy())
            ends = np.concatenate([[0], stop])[np.concatenate([[0], np.cumsum(size)])]
            texts = [data[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]
            yield pa.record_batch({n: part.column(n) for n in kept} | {bytes_col: pa.array(texts, pa.binary())})


def _known(pattern: str) -> None:
    if pattern != PATTERN:
        raise ValueError("only the byte-level pattern is known")


def encode(docs: DataFrame, path: str, pattern: str = PATTERN, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """All columns of ``docs`` but ``text_col``, and ``ids_col``: the ids of the whole text.

    Every match of ``pattern`` is encoded on its own, without special tokens. A null text gives
    no ids, like an empty one. A column already called ``ids_col`` is replaced. Only the usual
    byte-level ``pattern`` is known.
    """
    _known(pattern)
    source = docs.drop(ids_col) if ids_col != text_col else docs
    kept = [n for n in source.columns if n != text_col]
    schema = ", ".join([*_columns(source, text_col), f"`{ids_col}` array<int>"])
    return source.mapInArrow(partial(_encoding, path, kept, text_col, ids_col), schema)


def decode(encoded: DataFrame, path: str, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """All columns of ``encoded`` and ``bytes_col``: the bytes of the ids; null ids give none.
    A column already called ``bytes_col`` is replaced."""
    source = encoded.drop(bytes_col)
    schema = ", ".join([*_columns(source), f"`{bytes_col}` binary"])
    return source.mapInArrow(partial(_decoding, path, source.columns, ids_col, bytes_col), schema)


def encode_and_decode(
    docs: DataFrame, path: str, pattern: str = PATTERN, text_col: str = "text", ids_col: str = "ids", bytes_col: str = "decoded"
) -> DataFrame:
    """What ``decode`` makes of ``encode``'s rows, both in one worker: one after the other they would take
    two Python workers a task, each with the tables and what it has met."""
    _known(pattern)
    source = docs.drop(*{ids_col, bytes_col} - {text_col})
    kept = [n for n in source.columns if n != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoded = _encoding(path, kept, text_col, ids_col, batches)
        yield from _decoding(path, [*kept, ids_col], ids_col, bytes_col, encoded)
        # A worker outlives its task, beside the next one's: what Arrow holds for later goes back.
        pa.default_memory_pool().release_unused()

    return source.mapInArrow(run, ", ".join([*_columns(source, text_col), f"`{ids_col}` array<int>, `{bytes_col}` binary"]))

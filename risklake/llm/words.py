"""Words of many texts at once, as numpy arrays over one block of UTF-8 bytes.

Shared by the operators on word sequences. A word is a run of bytes outside a set of
separators, all of which are ASCII, so words never cut a code point. Word and window hashes are 64 bits; two
independent ones (``seed`` 0 and 1) make 128 where equality of sequences rests on them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: White space that separates words: 0x20 and 0x09 to 0x0D.
SPACES = bytes([0x20, *range(0x09, 0x0E)])
#: Texts are worked on in blocks of about so many bytes; a longer text is a block of its own.
BLOCK_BYTES = 500_000

_BASE = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit (multiply, shift, xor)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(seed: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64, and of its inverse."""
    base = int(_BASE[seed])
    inverse = pow(base, -1, 2**64)
    with np.errstate(over="ignore"):
        for_base = [np.full(size + 1, x, np.uint64) for x in (base, inverse)]
        for run in for_base:
            run[0] = 1
            np.cumprod(run, out=run)
    return for_base[0], for_base[1]


@lru_cache(maxsize=2)
def _usual_powers(seed: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(seed, BLOCK_BYTES)


def powers(seed: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``size + 1`` of them. A worker keeps those for a usual block, not for a longer text."""
    return _usual_powers(seed) if size <= BLOCK_BYTES else _powers(seed, size)


@lru_cache(maxsize=4)
def _byte_codes(seed: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F + 2 * seed))


@lru_cache(maxsize=4)
def _is_space(spaces: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(spaces)] = True
    return table


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; null is the empty text."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(batch: pa.RecordBatch, column: str = "text", size: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``size`` bytes of text each, at least a row."""
    if not batch.num_rows:
        return
    _, offsets = utf8(batch.column(column))
    start = 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + size, "right")) - 1)
        yield batch.slice(start, stop - start)
        start = stop


class Words:
    """The words of one block: byte spans, the row each is in, and the rows' first words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, spaces: bytes = SPACES):
        inside = ~_is_space(spaces)[data]
        first = np.zeros(len(data) + 1, bool)
        first[offsets] = True
        before = np.empty(len(data), bool)
        after = np.empty(len(data), bool)
        if len(data):
            before[0], before[1:] = False, inside[:-1]
            after[-1], after[:-1] = False, inside[1:]
        self.data = data
        self.starts = np.flatnonzero(inside & (~before | first[:-1]))
        self.ends = np.flatnonzero(inside & (~after | first[1:])) + 1
        #: Word i of row r is self.rows[r] + i.
        self.rows = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.rows)

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self, seed: int = 0) -> np.ndarray:
        with np.errstate(over="ignore"):
            up, down = powers(seed, len(self.data))
            total = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum(_byte_codes(seed)[self.data] * up[: len(self.data)], out=total[1:])
            return mix((total[self.ends] - total[self.starts]) * down[self.starts])


def window_hashes(words: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """The hash of every ``size`` consecutive word hashes; those over a row's end are the caller's to drop."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        up, down = powers(seed, len(words))
        total = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * up[: len(words)], out=total[1:])
        return mix((total[size:] - total[:-size]) * down[:n])


def window_rows(words: Words, size: int) -> np.ndarray:
    """Which windows of ``size`` words lie in one row: the positions of their first words."""
    left = words.rows[1:].repeat(words.counts) - np.arange(len(words.starts))
    return np.flatnonzero(left >= size)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, all other bytes as they are."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)

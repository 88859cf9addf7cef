"""Pre-tokens of byte-level tokenizers, all of a block at once, and a bounded memory of what was
worked out for them."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import lru_cache

import numpy as np
import regex

from risklake.llm.words import Words

#: The pattern that byte-level tokenizers cut texts by. A fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The endings that the pattern cuts off behind an apostrophe. Fixed values.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
SPACE, LETTER, NUMBER, OTHER = range(4)


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """The class of every code point."""
    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    kinds = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for found in regex.finditer(pattern, every):
            a, b = (x + 0x800 * (x >= 0xD800) for x in found.span())
            kinds[a:b] = kind
    return kinds


class Pretokens(Words):
    """The pre-tokens of one block of texts, with ``PATTERN``'s cuts.

    ``special`` strings are pre-tokens of their own wherever they stand; the texts around them
    are cut as if they ended there.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, special: regex.Pattern | None = None):
        text = data.tobytes().decode()
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        n = len(points)
        size = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
        place = np.zeros(n + 1, np.int64)
        np.cumsum(size, out=place[1:])
        border = np.zeros(n + 1, bool)
        border[np.searchsorted(place, offsets)] = True
        whole = [found.span() for found in special.finditer(text)] if special else []
        for a, b in whole:
            border[[a, b]] = True
        border[n] = True
        kind = _kinds()[points]

        # A run of one class starts a pre-token. The last white space before another run is cut
        # off the others; a plain blank there goes to that run.
        starts = np.zeros(n + 1, bool)
        run = border[:-1].copy()
        run[1:] |= kind[1:] != kind[:-1]
        starts[:-1] = run
        behind = np.flatnonzero(run[1:] & ~border[1:-1] & (kind[:-1] == SPACE)) + 1
        starts[behind - 1] = True
        starts[behind[points[behind - 1] == 0x20]] = False
        # An apostrophe that starts a pre-token takes an ending with it.
        marks = np.flatnonzero((points == 0x27) & starts[:-1] & run)
        for ending in ENDINGS:
            at = marks[marks + len(ending) < n]
            for k, letter in enumerate(ending, 1):
                at = at[(points[at + k] == ord(letter)) & ~border[at + k]]
            starts[at + 1] = False
            starts[at + len(ending) + 1] = True
        for a, b in whole:
            starts[a:b] = False
            starts[[a, b]] = True
        first = np.flatnonzero(starts[:-1])
        self.data = data
        self.starts = place[first]
        self.ends = place[np.append(first[1:], n)] if len(first) else self.starts
        self.rows = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.rows)

    def distinct(self) -> tuple[list[bytes], np.ndarray]:
        """The different pre-tokens of the block, and which of them each pre-token is."""
        _, first, which = np.unique(self.hashes(), return_index=True, return_inverse=True)
        data = self.data.tobytes()
        spans = zip(self.starts[first].tolist(), self.ends[first].tolist())
        return [data[a:b] for a, b in spans], which


class Memory:
    """Values by pre-token. Those of ``fixed`` stay; others are worked out when first met, and
    forgotten all at once when there are ``limit`` of them, so that a worker's memory is bounded.
    A pre-token of over ``LONG`` bytes, which hardly comes again, is worked out each time."""

    LONG = 64

    def __init__(self, work: Callable[[list[bytes]], Iterable], fixed: dict | None = None, limit: int = 400_000):
        self.work, self.limit = work, limit
        self.fixed = fixed or {}
        self.met: dict = {}

    def values(self, pieces: list[bytes]) -> list:
        if len(self.met) > self.limit:
            self.met = {}
        fixed, met = self.fixed, self.met
        out = [fixed.get(p) or met.get(p) for p in pieces]
        missing = [i for i, value in enumerate(out) if value is None]
        new = [pieces[i] for i in missing]
        for i, piece, value in zip(missing, new, self.work(new)):
            out[i] = value
            if len(piece) <= self.LONG:
                met[piece] = value
        return out

"""FM-index over short word sequences: wavelet matrix, backward search, matching statistics.

One index holds the segments of a shard, each a few dozen symbols long, one after the other.
The Burrows-Wheeler transform is kept as a wavelet matrix of packed bits with block counts
(1.5 bits a symbol and level); a backward step is one rank per level for either end of an
interval. Everything runs on all streamed sequences at once.
"""

from __future__ import annotations

import numpy as np


class WaveletMatrix:
    """Rank queries on a sequence of symbols 0 .. 2**levels - 1."""

    def __init__(self, symbols: np.ndarray, levels: int):
        self.levels = levels
        self.bits: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.zeros: list[int] = []
        current = symbols
        for level in range(levels - 1, -1, -1):
            bit = ((current >> level) & 1).astype(bool)
            padded = np.zeros((len(bit) // 64 + 1) * 64, np.uint8)
            padded[: len(bit)] = bit
            packed = np.packbits(padded, bitorder="little").view("<u8")
            counts = np.zeros(len(packed) + 1, np.int32)
            np.cumsum(np.bitwise_count(packed), out=counts[1:])
            self.bits.append(packed)
            self.counts.append(counts)
            self.zeros.append(len(bit) - int(bit.sum()))
            current = np.concatenate([current[~bit], current[bit]])

    def descend(self, symbols: np.ndarray, positions: np.ndarray) -> np.ndarray:
        """Where position i of the sequence ends up below all levels on the way of a symbol;
        the difference of two such places is a difference of ranks."""
        at = positions
        for k in range(self.levels):
            block = at >> 6
            low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = self.counts[k][block] + np.bitwise_count(self.bits[k][block] & low)
            bit = (symbols >> (self.levels - 1 - k)) & 1
            at = np.where(bit == 1, self.zeros[k] + ones, at - ones)
        return at


def _sparse_minima(values: np.ndarray) -> list[np.ndarray]:
    """Minima of all runs of 1, 2, 4 ... values."""
    table, width = [values], 1
    while 2 * width <= len(values):
        table.append(np.minimum(table[-1][:-width], table[-1][width:]))
        width *= 2
    return table


class FMIndex:
    """Index of segments; ``words`` holds their symbols one segment after the other.

    ``owners`` ranks the document of each segment. Matches are looked for in segments with a
    smaller owner than the streamed one's.
    """

    def __init__(self, words: np.ndarray, lengths: np.ndarray, owners: np.ndarray):
        segments = len(lengths)
        _, symbols = np.unique(words, return_inverse=True)
        of = np.repeat(np.arange(segments), lengths)
        #: Segment s starts at starts[s] of the text and is followed by a separator of its own.
        self.starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]]).astype(np.int64)
        self.lengths = lengths.astype(np.int64)
        n = len(words) + segments
        text = np.empty(n, np.int64)
        text[np.arange(len(words)) + of] = symbols + 1
        separators = self.starts + self.lengths
        text[separators] = 0
        self.text = text

        # Suffix array by doubling; separators are unequal, so a suffix is settled by its segment.
        rank = text + segments
        rank[separators] = np.arange(segments)
        ranks = [np.unique(rank, return_inverse=True)[1]]
        width = 1
        while ranks[-1].max(initial=0) + 1 < n:
            r = ranks[-1]
            second = np.zeros(n, np.int64)
            second[: n - width] = r[width:] + 1
            ranks.append(np.unique(r * (n + 1) + second, return_inverse=True)[1])
            width *= 2
        order = np.empty(n, np.int64)
        order[ranks[-1]] = np.arange(n)

        # Longest common prefix of neighbours in the order, from the ranks of every doubling.
        lcp = np.zeros(n, np.int64)
        a, b = order[:-1].copy(), order[1:].copy()
        for k in range(len(ranks) - 1, -1, -1):
            inside = (a < n) & (b < n)
            same = np.zeros(n - 1, bool)
            same[inside] = ranks[k][a[inside]] == ranks[k][b[inside]]
            lcp[1:][same] += 1 << k
            a, b = a + same * (1 << k), b + same * (1 << k)
        del ranks

        bwt = text[order - 1]
        self.size = n
        self.wavelet = WaveletMatrix(bwt, max(1, int(bwt.max(initial=0)).bit_length()))
        alphabet = np.arange(int(text.max(initial=0)) + 1)
        before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(alphabet)))[:-1]])
        self.first = before - self.wavelet.descend(alphabet, np.zeros(len(alphabet), np.int64))
        owner = np.repeat(owners, self.lengths + 1)
        self.owner_minima = _sparse_minima(owner[order].astype(np.int32))
        self.lcp_minima = _sparse_minima(lcp.astype(np.int32))
        self.owners = owners

    def _step(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self.first[symbols] + self.wavelet.descend(symbols, at)

    def _least_owner(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The smallest owner in order[low:high]; intervals are not empty."""
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(low), np.int32)
        for k in np.unique(level):
            here = level == k
            table = self.owner_minima[k]
            out[here] = np.minimum(table[low[here]], table[high[here] - (1 << int(k))])
        return out

    def _parent(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The next larger interval of a common prefix, and that prefix's length."""
        lcp = self.lcp_minima[0]
        inner = np.where(high < self.size, lcp[np.minimum(high, self.size - 1)], 0)
        length = np.maximum(lcp[low], inner)
        low, high = low.copy(), high.copy()
        for k in range(len(self.lcp_minima) - 1, -1, -1):
            width, table = 1 << k, self.lcp_minima[k]
            ok = low - width + 1 > 0
            ok &= table[np.where(ok, low - width + 1, 0)] >= length
            low = np.where(ok, low - width, low)
            ok = high + width <= self.size
            ok &= table[np.where(ok, high, 0)] >= length
            high = np.where(ok, high + width, high)
        root = length == 0
        return np.where(root, 0, low), np.where(root, self.size, high), length

    def shared_windows(self, size: int) -> np.ndarray:
        """For every position of the text: do ``size`` symbols that start here also occur in a
        segment with a smaller owner?

        Matching statistics by backward search: a sequence is read from its end; while the
        symbol in front still leaves a smaller owner in the interval, the match grows to the
        left, else its right end is cut back to the parent interval.
        """
        found = np.zeros(self.size, bool)
        query = np.arange(len(self.starts))
        at = self.starts + self.lengths
        low = np.zeros(len(query), np.int64)
        high = np.full(len(query), self.size, np.int64)
        length = np.zeros(len(query), np.int64)
        while len(query):
            symbols = self.text[at - 1]
            lower, higher = self._step(symbols, low), self._step(symbols, high)
            grows = lower < higher
            grows[grows] = self._least_owner(lower[grows], higher[grows]) < self.owners[query[grows]]
            low, high = np.where(grows, lower, low), np.where(grows, higher, high)
            length = length + grows
            stuck = ~grows & (length == 0)
            at = at - (grows | stuck)
            found[at[grows & (length >= size)]] = True
            cut = ~grows & (length > 0)
            if cut.any():
                low[cut], high[cut], length[cut] = self._parent(low[cut], high[cut])
            # What is left of a sequence must still have room for a window.
            go = (at > self.starts[query]) & (at - self.starts[query] + length >= size)
            query, at, low, high, length = query[go], at[go], low[go], high[go], length[go]
        return found

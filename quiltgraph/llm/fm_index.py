"""A compressed FM-index over integer symbols, with vectorised backward search.

The Burrows-Wheeler transform of the text is kept as a wavelet tree in matrix form: one packed bit
vector a level with counts every 64 bits. Suffixes are sorted to ``depth`` symbols, which is all that
backward search of patterns of up to ``depth`` symbols needs; ``lcp`` keeps, to that depth, what
neighbouring suffixes share (a byte each), so that an interval can be widened to a shorter prefix. The suffix order
itself is not kept: the least ``key`` of each full-depth interval stands for its places.
"""

from __future__ import annotations

import numpy as np

U = np.uint64


class Bits:
    """A bit vector with constant-time rank."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        packed = np.packbits(np.concatenate([bits, np.zeros(-n % 64 + 64, bool)]), bitorder="little").view("<u8")
        self.words = packed
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)])[:-1]

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        w = i >> 6
        return self.before[w] + np.bitwise_count(self.words[w] & ((U(1) << (i & 63).astype(U)) - U(1))).astype(np.int64)


class WaveletTree:
    """rank(c, i): how many c stand before place i; one bit vector for each bit of the symbols."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.levels: list[tuple[int, Bits, int]] = []
        x = symbols
        for shift in range(max(1, int(n_symbols - 1).bit_length()) - 1, -1, -1):
            bit = (x >> shift & 1).astype(bool)
            self.levels.append((shift, Bits(bit), int(len(bit) - bit.sum())))
            x = np.concatenate([x[~bit], x[bit]])
        self.first = self._descend(np.arange(n_symbols), np.zeros(n_symbols, np.int64))

    def _descend(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for shift, bits, zeros in self.levels:
            ones = bits.rank(i)
            i = np.where(c >> shift & 1, zeros + ones, i - ones)
        return i

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        return self._descend(c, i) - self.first[c]


class FmIndex:
    """Symbols are 1 to n_symbols - 1; 0 separates documents and is never searched."""

    def __init__(self, text: np.ndarray, n_symbols: int, depth: int, key: np.ndarray | None = None):
        if not len(text) or text[-1]:
            text = np.append(text, 0)  # the end is a separator, so no match runs over it
        n = len(text)
        key = np.arange(n) if key is None else key
        self.n, self.depth = n, depth
        order = np.argsort(_ranks(text, depth), kind="stable")
        self.tree = WaveletTree(text[order - 1], n_symbols)
        self.below = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n_symbols))])
        same = np.ones(max(0, n - 1), bool)
        shared = np.zeros(n, np.uint8)
        padded = np.concatenate([text, np.zeros(depth, text.dtype)])
        for d in range(depth):
            at = order + d
            here = padded[at]
            same &= (here[1:] == here[:-1]) & (here[1:] != 0)
            shared[1:] += same
        self.lcp = shared
        self._edges: dict[int, np.ndarray] = {}
        self._least = np.minimum.reduceat(key[order], self.edges(depth))

    def least(self, lo: np.ndarray) -> np.ndarray:
        """The least key of the places of full-depth intervals, by their starts."""
        return self._least[np.searchsorted(self.edges(self.depth), lo, "right") - 1]

    def edges(self, length: int) -> np.ndarray:
        """Where suffixes begin that differ from the one before within ``length`` symbols."""
        if length not in self._edges:
            self._edges[length] = np.flatnonzero(self.lcp < length)
        return self._edges[length]

    def extend(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One backward step: the intervals of c followed by what [lo, hi) stands for."""
        return self.below[c] + self.tree.rank(c, lo), self.below[c] + self.tree.rank(c, hi)

    def widen(self, lo: np.ndarray, hi: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the first ``length`` symbols of each."""
        lo, hi = lo.copy(), hi.copy()
        for d in np.unique(length).tolist():
            at = length == d
            if d == 0:
                lo[at], hi[at] = 0, self.n
                continue
            e = self.edges(d)
            lo[at] = e[np.searchsorted(e, lo[at], "right") - 1]
            k = np.searchsorted(e, hi[at], "left")
            hi[at] = np.where(k < len(e), e[np.minimum(k, len(e) - 1)], self.n)
        return lo, hi

    def matching_statistics(self, patterns: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each place of the patterns (in a row, with offsets ``at``): the length of the longest match from
        there on that occurs in the text, up to ``depth``, and the start of its suffix interval.

        All patterns are read from right to left at once. A full-depth match gives up its last symbol
        before the step; one that cannot be extended gives up symbols until it can. A symbol below 0
        does not occur in the text.
        """
        length, first = np.zeros(len(patterns), np.int64), np.zeros(len(patterns), np.int64)
        live = np.flatnonzero(np.diff(at) > 0)
        place = at[live + 1] - 1
        stop = at[live]
        lo, hi, size = np.zeros(len(live), np.int64), np.full(len(live), self.n), np.zeros(len(live), np.int64)
        while len(place):
            full = size == self.depth
            if full.any():
                lo[full], hi[full] = self.widen(lo[full], hi[full], size[full] - 1)
                size[full] -= 1
            c = patterns[place]
            todo = np.flatnonzero(c > 0)
            missing = c <= 0
            lo[missing], hi[missing], size[missing] = 0, self.n, 0
            while len(todo):
                a, b = self.extend(c[todo], lo[todo], hi[todo])
                found = b > a
                yes, no = todo[found], todo[~found]
                lo[yes], hi[yes] = a[found], b[found]
                size[yes] += 1
                dead = no[size[no] == 0]  # not in the text at all
                no = no[size[no] > 0]
                lo[dead], hi[dead] = 0, self.n
                if len(no):
                    size[no] -= 1
                    lo[no], hi[no] = self.widen(lo[no], hi[no], size[no])
                todo = no
            length[place], first[place] = size, lo
            keep = place > stop
            place, stop, lo, hi, size = place[keep] - 1, stop[keep], lo[keep], hi[keep], size[keep]
        return length, first


def _ranks(text: np.ndarray, depth: int) -> np.ndarray:
    """Ranks of all suffixes by their first ``depth`` symbols (zeros beyond the end), by doubling."""

    def pair(a: np.ndarray, b: np.ndarray, k: int) -> np.ndarray:
        later = np.zeros(len(b), np.int64)
        later[: len(b) - k] = b[k:] + 1 if k < len(b) else 0
        return np.unique(a.astype(np.int64) * (int(later.max()) + 1) + later, return_inverse=True)[1]

    have, power, k = None, text, 1
    done = 0
    while True:
        if depth & k:
            have = power if have is None else pair(have, power, done)
            done += k
        k *= 2
        if k > depth:
            return have
        power = pair(power, power, k // 2)

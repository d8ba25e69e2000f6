"""A compressed full-text index over word numbers, searched for many patterns at once."""

from __future__ import annotations

import numpy as np


class WaveletMatrix:
    """Bit planes of a sequence, with the number of ones before each 64-bit word."""

    def __init__(self, values: np.ndarray, symbols: int):
        self.size = len(values)
        self.bits = max(1, int(symbols - 1).bit_length())
        self.planes, self.before, self.zeros = [], [], []
        for level in range(self.bits - 1, -1, -1):
            ones = (values >> level & 1).astype(bool)
            padded = np.zeros(-(-(self.size + 1) // 64) * 64, np.uint8)
            padded[:self.size] = ones
            plane = np.packbits(padded, bitorder="little").view(np.uint64)
            self.planes.append(plane)
            self.before.append(np.concatenate([[0], np.cumsum(np.bitwise_count(plane), dtype=np.int64)[:-1]]))
            self.zeros.append(self.size - int(ones.sum()))
            values = np.concatenate([values[~ones], values[ones]])
        self.starts = self._down(np.arange(symbols), np.zeros(symbols, np.int64))

    def _down(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for i in range(self.bits):
            word = at >> 6
            inside = self.planes[i][word] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
            ones = self.before[i][word] + np.bitwise_count(inside)
            up = (symbols >> (self.bits - 1 - i) & 1).astype(bool)
            at = np.where(up, self.zeros[i] + ones, at - ones)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol is among the first ``at`` values."""
        return self._down(symbols, at) - self.starts[symbols]


class FMIndex:
    """Over a text of numbers, 0 being the separator. Patterns of up to ``depth`` symbols can be counted.

    Suffixes are sorted by ``depth`` symbols only: that fixes the bounds of every shorter pattern's rows.
    """

    def __init__(self, text: np.ndarray, symbols: int, depth: int = 64):
        self.text, self.depth = text, depth
        order = self._sorted(text, depth)
        self.wavelet = WaveletMatrix(text[order - 1], symbols)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])[:-1]

    @staticmethod
    def _sorted(text: np.ndarray, depth: int) -> np.ndarray:
        """Rotations by their first ``depth`` symbols, by doubling the length that ranks stand for."""
        size, rank, length = len(text), text.astype(np.int64), 1
        order = np.argsort(rank, kind="stable")
        while length < depth:
            key = rank * (int(rank.max()) + 1) + np.roll(rank, -(length % size))
            order = np.argsort(key, kind="stable")
            ahead = key[order]
            new = np.cumsum(np.concatenate([[0], ahead[1:] != ahead[:-1]]))
            rank = np.empty(size, np.int64)
            rank[order] = new
            length *= 2
            if new[-1] == size - 1:
                break
        return order

    def extend(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of ``symbol + pattern`` from the rows of each pattern."""
        both = self.wavelet.rank(np.concatenate([symbols, symbols]), np.concatenate([low, high]))
        both += np.concatenate([self.first[symbols], self.first[symbols]])
        return both[:len(low)], both[len(low):]


def repeated(index: FMIndex, starts: np.ndarray, lengths: np.ndarray, window: int):
    """(stream, from, to) of stretches all of whose windows occur at least twice in the index's text.

    Streams are parts of that text, searched backward from the end of a window. Where a search stops at
    a word ``p``, no window that holds both ``p`` and the end repeats, and those between them do: so few
    searches settle many windows. ``done`` is the last window end settled, ``reach`` how far
    the present searches will have settled. A search runs on past its window, to the index's depth.
    """
    stop = lengths - 1
    depth, leap = index.depth, index.depth - window + 1
    done = np.full(len(starts), window - 2)
    end, reach = np.full(len(starts), window - 1), np.full(len(starts), -1)
    at, low, high = end.copy(), np.zeros(len(starts), np.int64), np.full(len(starts), len(index.text))
    active = np.flatnonzero(lengths >= window)
    found = []
    while len(active):
        here = at[active]
        symbol = index.text[starts[active] + np.maximum(here, 0)]
        new_low, new_high = index.extend(symbol, low[active], high[active])
        good = (here >= 0) & (new_high - new_low >= 2) & (end[active] - here < depth)
        on = active[good]
        low[on], high[on] = new_low[good], new_high[good]
        at[on] -= 1
        off, p = active[~good], here[~good]
        if len(off):
            last = end[off]
            hit = last >= p + window
            found.append((off[hit], p[hit] + 1, last[hit] + 1))
            fresh = reach[off] < 0
            # a search cut off at its depth says nothing of windows that hold p
            cut = (p >= 0) & (last - p >= depth)
            over = np.where(cut, last, np.maximum(last, p + window - 1))
            reach[off] = np.where(fresh, over, reach[off])
            lower = np.minimum(last - 1, p + window - 1)
            settled = lower <= done[off]
            ready, rest = off[settled], off[~settled]
            done[ready] = reach[ready]
            farther = np.minimum(done[ready] + leap, np.maximum(stop[ready], done[ready] + 1))
            end[ready] = np.where(hit[settled], farther, done[ready] + 1)
            reach[ready] = -1
            end[rest] = lower[~settled]
            at[off], low[off], high[off] = end[off], 0, len(index.text)
            active = np.concatenate([on, off[done[off] < stop[off]]])
    if not found:
        return (np.empty(0, np.int64),) * 3
    return tuple(np.concatenate([f[i] for f in found]) for i in range(3))

"""An FM-index over a sequence of small integers, searched for many patterns at once."""

from __future__ import annotations

import numpy as np


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes in order, by doubling the length compared."""
    n = len(symbols)
    _, rank = np.unique(symbols, return_inverse=True)
    rank = rank.astype(np.int64)
    step = 1
    while True:
        follow = np.zeros(n, np.int64)
        follow[: n - step] = rank[step:] + 1
        key = rank * (n + 1) + follow
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        fresh = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        if fresh[-1] == n - 1 or step >= n:
            return order
        step *= 2


class WaveletMatrix:
    """Ranks and values of a sequence, one level of bits after another."""

    def __init__(self, values: np.ndarray, bits: int):
        self.levels = []
        for level in range(bits - 1, -1, -1):
            bit = (values >> level) & 1
            zeros = np.concatenate([[0], np.cumsum(1 - bit)])
            self.levels.append((level, zeros, int(zeros[-1])))
            values = np.concatenate([values[bit == 0], values[bit == 1]])

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each symbol comes before its end."""
        start = np.zeros_like(end)
        for level, zeros, count in self.levels:
            one = (symbol >> level) & 1 == 1
            start = np.where(one, count + start - zeros[start], zeros[start])
            end = np.where(one, count + end - zeros[end], zeros[end])
        return end - start

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each position, and how often it comes before."""
        symbol, start = np.zeros_like(at), np.zeros_like(at)
        for level, zeros, count in self.levels:
            one = zeros[at + 1] == zeros[at]
            symbol |= one.astype(at.dtype) << level
            start = np.where(one, count + start - zeros[start], zeros[start])
            at = np.where(one, count + at - zeros[at], zeros[at])
        return symbol, at - start


class FMIndex:
    """Index of ``symbols``, in which 0 separates parts that no match may span.

    Every ``sample``-th position and every beginning of a part is sampled.
    """

    def __init__(self, symbols: np.ndarray, sample: int = 32):
        self.n = n = len(symbols)
        symbols = symbols.astype(np.int64)
        parted = symbols == 0
        # Separators differ, so that suffixes are told apart within their part.
        told = np.where(parted, np.cumsum(parted) - 1, symbols + int(parted.sum()))
        order = suffix_order(told)
        self.last = symbols[order - 1]  # the symbol before each suffix, in order
        self.tree = WaveletMatrix(self.last, max(int(symbols.max()).bit_length(), 1))
        counts = np.bincount(symbols)
        self.before = np.concatenate([[0], np.cumsum(counts)])
        starts = np.concatenate([[True], parted[:-1]])
        chosen = starts | parted | (np.arange(n) % sample == 0)
        self.sampled = np.where(chosen[order], order, -1)

    def search(self, patterns: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first, end) rows of each pattern, one per row of ``patterns``, aligned at the right end."""
        first, end = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n)
        width = patterns.shape[1]
        for back in range(width):
            live = np.flatnonzero((back < sizes) & (first < end))
            if not len(live):
                break
            symbol = patterns[live, width - 1 - back]
            known = symbol < len(self.before) - 1
            end[live[~known]] = first[live[~known]]
            live, symbol = live[known], symbol[known]
            base = self.before[symbol]
            first[live] = base + self.tree.rank(symbol, first[live])
            end[live] = base + self.tree.rank(symbol, end[live])
        return first, end

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Position of each row: back to the nearest sampled one."""
        found = np.full(len(rows), -1)
        walked, open_, rows = np.zeros(len(rows), np.int64), np.arange(len(rows)), rows.copy()
        while len(open_):
            at = self.sampled[rows]
            done = at >= 0
            found[open_[done]] = at[done] + walked[open_[done]]
            open_, rows = open_[~done], rows[~done]
            if len(open_):
                symbol, rank = self.tree.access(rows)
                rows = self.before[symbol] + rank
                walked[open_] += 1
        return found

"""An FM-index over a sequence of small integers: counts and finds phrases by backward
search, with ranks from a wavelet matrix and positions from sampled suffixes."""

from __future__ import annotations

import numpy as np

SAMPLE_EVERY = 16


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in ascending order, by doubling the compared length; only
    suffixes that are still tied are sorted again. The last symbol must be the least and
    occur once."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    ranked = symbols[order]
    first = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    length = 1
    while not first.all():
        tied = ~(first & np.append(first[1:], True))
        at = np.flatnonzero(tied)
        suffixes = order[at]
        # a tied suffix is longer than the compared length, as the last symbol is unique
        key = rank[suffixes] * (n + 1) + rank[suffixes + length]
        by = np.argsort(key, kind="stable")
        order[at], key = suffixes[by], key[by]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        first[at] = new
        rank[order[at]] = at[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        length *= 2
    return order


class WaveletMatrix:
    """Ranks of symbols in a sequence: each level deals the sequence by one bit, from the
    highest, zeros first."""

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        self.bits = max(1, int(symbols.max()).bit_length())
        self.ones = np.zeros((self.bits, n + 1), dtype=np.int32)
        self.zeros = np.zeros(self.bits, dtype=np.int64)
        for level in range(self.bits):
            bit = (symbols >> (self.bits - 1 - level)) & 1
            np.cumsum(bit, out=self.ones[level, 1:])
            self.zeros[level] = n - self.ones[level, n]
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its position."""
        start = np.zeros_like(at)
        for level in range(self.bits):
            ones = self.ones[level]
            bit = ((symbol >> (self.bits - 1 - level)) & 1).astype(bool)
            start_ones, at_ones = ones[start], ones[at]
            start = np.where(bit, self.zeros[level] + start_ones, start - start_ones)
            at = np.where(bit, self.zeros[level] + at_ones, at - at_ones)
        return at - start

    def symbol_and_rank(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each position and how often it occurs before it."""
        symbol, start = np.zeros_like(at), np.zeros_like(at)
        for level in range(self.bits):
            ones = self.ones[level]
            bit = (ones[at + 1] - ones[at]).astype(bool)
            symbol = (symbol << 1) | bit
            start = np.where(bit, self.zeros[level] + ones[start], start - ones[start])
            at = np.where(bit, self.zeros[level] + ones[at], at - ones[at])
        return symbol, at - start


class FMIndex:
    """symbols: integers from 1 on; 0 is put behind them."""

    def __init__(self, symbols: np.ndarray):
        text = np.append(symbols.astype(np.int64), 0)
        suffixes = suffix_array(text)
        self.n = len(text)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text))])  # symbols less than each
        self.wavelet = WaveletMatrix(text[suffixes - 1])
        sampled = suffixes % SAMPLE_EVERY == 0
        self.sampled_before = np.concatenate([[0], np.cumsum(sampled)])
        self.samples = suffixes[sampled]

    def intervals(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows [low, high) whose suffixes begin with each phrase; phrases end at the
        right edge of the array, padded on the left."""
        low = np.zeros(len(phrases), dtype=np.int64)
        high = np.full(len(phrases), self.n, dtype=np.int64)
        live = np.arange(len(phrases))
        width = phrases.shape[1]
        for step in range(width):
            live = live[(lengths[live] > step) & (low[live] < high[live])]
            if not len(live):
                break
            symbol = phrases[live, width - 1 - step]
            known = symbol < len(self.before) - 1
            high[live[~known]] = low[live[~known]]
            live, symbol = live[known], symbol[known]
            low[live] = self.before[symbol] + self.wavelet.rank(symbol, low[live])
            high[live] = self.before[symbol] + self.wavelet.rank(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The position of each row's suffix: steps back to the nearest sampled one."""
        found = np.empty(len(rows), dtype=np.int64)
        open_, steps = np.arange(len(rows)), 0
        rows = rows.copy()
        while len(open_):
            known = self.sampled_before[rows + 1] > self.sampled_before[rows]
            found[open_[known]] = self.samples[self.sampled_before[rows[known]]] + steps
            open_, rows = open_[~known], rows[~known]
            symbol, rank = self.wavelet.symbol_and_rank(rows)
            rows = self.before[symbol] + rank
            steps += 1
        return found

"""A full-text index over integer symbols: Burrows-Wheeler transform, wavelet tree ranks, sampled suffix positions."""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix positions in order, by prefix doubling; only suffixes that are still tied are sorted again."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    key = text[order]
    rank = np.empty(n, np.int64)
    start = np.ones(n, bool)
    start[1:] = key[1:] != key[:-1]
    heads = np.flatnonzero(start)
    rank[order] = np.repeat(heads, np.diff(np.append(heads, n)))
    width = 1
    while True:
        size = np.diff(np.append(heads, n))
        tied = np.repeat(size > 1, size)  # by place in the order
        if not tied.any():
            return order
        places = np.flatnonzero(tied)
        suffixes = order[places]
        after = suffixes + width
        second = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        first = rank[suffixes]
        by = np.argsort(first * (n + 1) + second)
        suffixes, first, second = suffixes[by], first[by], second[by]
        order[places] = suffixes
        new = np.ones(len(places), bool)
        new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        rank[suffixes] = places[np.maximum.accumulate(np.where(new, np.arange(len(places)), 0))]
        heads = np.union1d(np.flatnonzero(~tied), places[new])
        width *= 2


class Bits:
    """A bit string with the number of ones before each place."""

    def __init__(self, bits: np.ndarray) -> None:
        self.words = np.frombuffer(np.packbits(bits, bitorder="little").tobytes() + b"\0" * (-(-len(bits) // 8) % -8 + 16), np.uint8)
        self.words = np.frombuffer(self.words[: len(self.words) // 8 * 8].tobytes(), np.uint64)
        self.before = np.zeros(len(self.words) + 1, np.int64)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])

    def ones(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)


class WaveletTree:
    """Ranks of symbols; the nodes of a level lie side by side, zeros before ones."""

    def __init__(self, symbols: np.ndarray, sigma: int) -> None:
        self.depth = max(1, int(sigma - 1).bit_length())
        self.levels: list[tuple[Bits, int]] = []
        for level in range(self.depth):
            bits = (symbols >> (self.depth - 1 - level)) & 1
            self.levels.append((Bits(bits.astype(np.uint8)), int(len(bits) - bits.sum())))
            symbols = np.concatenate([symbols[bits == 0], symbols[bits == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        low, high = np.zeros_like(at), at
        for level, (bits, zeros) in enumerate(self.levels):
            one = ((symbol >> (self.depth - 1 - level)) & 1).astype(bool)
            below, above = bits.ones(low), bits.ones(high)
            low, high = np.where(one, zeros + below, low - below), np.where(one, zeros + above, high - above)
        return high - low

    def get(self, at: np.ndarray) -> np.ndarray:
        symbol = np.zeros(len(at), np.int64)
        for bits, zeros in self.levels:
            one = bits.get(at).astype(np.int64)
            ones = bits.ones(at)
            at = np.where(one == 1, zeros + ones, at - ones)
            symbol = symbol * 2 + one
        return symbol


class FMIndex:
    """Index of symbols 1 .. sigma - 1; 0 is the end mark, which is added here."""

    def __init__(self, symbols: np.ndarray, sigma: int, sample: int = 16) -> None:
        text = np.append(symbols, 0).astype(np.int64)
        suffixes = suffix_array(text)
        last = text[suffixes - 1]
        self.size = len(text)
        self.tree = WaveletTree(last, sigma)
        self.first = np.zeros(sigma + 1, np.int64)
        np.cumsum(np.bincount(text, minlength=sigma), out=self.first[1:])
        kept = suffixes % sample == 0
        self.sampled, self.samples = Bits(kept.astype(np.uint8)), suffixes[kept]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffix range of each pattern (rows, aligned to the right), by backward search over all at once."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.size, np.int64)
        width = patterns.shape[1]
        for i in range(width):
            on = np.flatnonzero((lengths > i) & (low < high))
            symbol = patterns[on, width - 1 - i]
            low[on] = self.first[symbol] + self.tree.rank(symbol, low[on])
            high[on] = self.first[symbol] + self.tree.rank(symbol, high[on])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffixes: walk back to the next sampled one."""
        out, steps, left, at = np.empty(len(rows), np.int64), 0, np.arange(len(rows)), rows.copy()
        while len(left):
            hit = self.sampled.get(at) == 1
            out[left[hit]] = self.samples[self.sampled.ones(at[hit])] + steps
            left, at = left[~hit], at[~hit]
            symbol = self.tree.get(at)
            at = self.first[symbol] + self.tree.rank(symbol, at)
            steps += 1
        return out

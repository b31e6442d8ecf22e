"""A compressed full-text index of strings of integers, searched backwards for many strings at once."""

from __future__ import annotations

from functools import cached_property

import numpy as np


class Bits:
    """A bit vector in 64-bit words, with the number of ones before each word."""

    def __init__(self, bits: np.ndarray) -> None:
        whole = np.zeros(-(-(len(bits) + 1) // 64) * 64, np.uint8)
        whole[: len(bits)] = bits
        self.words = np.packbits(whole, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class Wavelet:
    """A wavelet matrix: how often a symbol occurs before a place, in one step per bit of a symbol."""

    def __init__(self, symbols: np.ndarray, largest: int) -> None:
        self.levels: list[tuple[int, Bits, int]] = []
        rest = symbols
        for bit in range(max(int(largest).bit_length(), 1) - 1, -1, -1):
            one = (rest >> bit) & 1
            self.levels.append((bit, Bits(one), int(len(rest) - one.sum())))
            rest = np.concatenate([rest[one == 0], rest[one == 1]])
        # Where the symbols of each kind begin once they are sorted by all bits.
        self.begin = self.sent(np.arange(largest + 1), np.zeros(largest + 1, np.int64))

    def sent(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for bit, ones, zeros in self.levels:
            before = ones.ones(at)
            at = np.where((symbol >> bit) & 1, zeros + before, at - before)
        return at

    def count(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self.sent(symbol, at) - self.begin[symbol]


def dense(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Ranks from 0 of pairs of non-negative numbers; equal pairs share one."""
    key = first * (int(second.max()) + 1) + second
    order = np.argsort(key, kind="stable")
    rank = np.zeros(len(key), np.int64)
    rank[order] = np.cumsum(np.append(0, key[order][1:] != key[order][:-1]))
    return rank


class FMIndex:
    """Index of strings, given one after another with the start of each; symbols are any 64-bit numbers.

    Suffixes are sorted by doubling. Each string ends in a mark that differs from
    all others, so no match goes beyond a string. The index keeps the
    Burrows-Wheeler transform in a wavelet matrix, and lengths common to
    neighbouring suffixes up to ``cap``.
    """

    def __init__(self, symbols: np.ndarray, offsets: np.ndarray, cap: int) -> None:
        self.cap = cap
        lengths = np.diff(offsets)
        self.alphabet, codes = np.unique(symbols, return_inverse=True)
        n = len(symbols) + len(lengths)
        string = np.repeat(np.arange(len(lengths)), lengths)
        ends = offsets[1:] + np.arange(len(lengths))
        text = np.zeros(n, np.int64)  # 0 stands for every end
        place = np.arange(len(symbols)) + string
        text[place] = codes + 1
        rank = np.zeros(n, np.int64)
        rank[ends] = np.arange(len(lengths))
        rank[place] = len(lengths) + codes
        ranks, width = [rank], 1
        while width <= int(lengths.max(initial=0)):
            after = np.zeros(n, np.int64)
            after[:-width] = rank[width:] + 1
            rank = dense(rank, after)
            width *= 2
            ranks.append(rank)
        order = np.argsort(rank, kind="stable")
        self.string = np.repeat(np.arange(len(lengths)), lengths + 1)[order]  # of each suffix
        self.size = n
        self.common = self.shared_lengths(ranks, order)
        before = text[order - 1]  # the last end stands before the first symbol
        self.wavelet = Wavelet(before, len(self.alphabet))
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(self.alphabet) + 1))])[:-1]
        self.heads = np.flatnonzero(self.common < cap)  # suffixes from one head on to the next share ``cap`` symbols
        self.group = np.cumsum(self.common[:-1] < cap) - 1

    def shared_lengths(self, ranks: list[np.ndarray], order: np.ndarray) -> np.ndarray:
        """Symbols that each suffix shares with the one before it, up to ``cap``; 0 at both ends."""
        n = len(order)
        common = np.zeros(n + 1, np.int64)
        a, b = order[:-1], order[1:]
        for level in range(len(ranks) - 1, -1, -1):
            x, y = a + common[1:n], b + common[1:n]
            # Equal ranks tell of equal symbols only where no end has been met; ends differ.
            inside = (x < n) & (y < n)
            same = inside & (ranks[level][np.minimum(x, n - 1)] == ranks[level][np.minimum(y, n - 1)])
            common[1:n] += np.where(same, 1 << level, 0)
        return np.minimum(common, self.cap)

    @cached_property
    def least(self) -> list[np.ndarray]:
        """Minima of ``common`` over 1, 2, 4 ... neighbours from each place on."""
        tables = [self.common]
        while 2 << (len(tables) - 1) <= len(self.common):
            step = 1 << (len(tables) - 1)
            tables.append(np.minimum(tables[-1][:-step], tables[-1][step:]))
        return tables

    def parents(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The smallest larger intervals of suffixes, and how many symbols all of theirs share."""
        depth = np.maximum(self.common[low], self.common[high])
        low, high = low.copy(), high.copy()
        for level in range(len(self.least) - 1, -1, -1):
            step = 1 << level
            table = self.least[level]
            fits = low - step + 1 >= 0
            low -= np.where(fits & (table[np.where(fits, low - step + 1, 0)] >= depth), step, 0)
            fits = high + step <= len(self.common)
            high += np.where(fits & (table[np.where(fits, high, 0)] >= depth), step, 0)
        none = depth == 0
        return depth, np.where(none, 0, low), np.where(none, self.size, high)

    def statistics(self, symbols: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matching statistics: for each place of each string the length, up to ``cap``, of the longest
        match that begins there, and the interval of suffixes that it heads.

        All strings are read backwards at once. Where a symbol cannot be put before
        the match, the match loses its end until it can.
        """
        lengths = np.diff(offsets)
        code = np.searchsorted(self.alphabet, symbols)
        known = code < len(self.alphabet)
        known[known] = self.alphabet[code[known]] == symbols[known]
        code = code + 1
        size = np.zeros(len(symbols), np.int64)
        left, right = np.zeros(len(symbols), np.int64), np.full(len(symbols), self.size, np.int64)
        longest_first = np.argsort(-lengths, kind="stable")
        ends = offsets[1:][longest_first]
        rows = len(lengths)
        low, high, held = np.zeros(rows, np.int64), np.full(rows, self.size, np.int64), np.zeros(rows, np.int64)
        for step in range(1, int(lengths.max(initial=0)) + 1):
            rows = int(np.searchsorted(-lengths[longest_first], -step, "right"))
            at = ends[:rows] - step
            lost = ~known[at]
            low[:rows][lost], high[:rows][lost], held[:rows][lost] = 0, self.size, 0
            open_ = np.flatnonzero(~lost)
            while len(open_):
                c = code[at[open_]]
                both = self.wavelet.count(np.tile(c, 2), np.concatenate([low[open_], high[open_]])).reshape(2, -1) + self.smaller[c]
                fits = both[0] < both[1]
                done, fails = open_[fits], open_[~fits]
                low[done], high[done] = both[0][fits], both[1][fits]
                held[done] += 1
                if len(fails):
                    held[fails], low[fails], high[fails] = self.parents(low[fails], high[fails])
                open_ = fails
            beyond = np.flatnonzero(held[:rows] >= self.cap)
            if len(beyond):
                group = self.group[low[beyond]]
                low[beyond], held[beyond] = self.heads[group], self.cap
                high[beyond] = self.heads[group + 1]
            size[at], left[at], right[at] = held[:rows], low[:rows], high[:rows]
        return size, left, right

"""An FM-index over a sequence of whole numbers: counts and places of patterns by backward search."""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """The suffixes' order, by prefix doubling; ``text`` ends with a number below all others."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        second = np.zeros(n, np.int64)
        second[: n - step] = rank[step:] + 1
        key = rank * (n + 1) + second
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        fresh = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        if fresh[-1] == n - 1:
            return order
        step *= 2


class Bits:
    """A bit vector with rank."""

    def __init__(self, bits: np.ndarray) -> None:
        n = len(bits)
        packed = np.packbits(np.concatenate([bits.astype(np.uint8), np.zeros(-n % 64 + 64, np.uint8)]), bitorder="little")
        self.words = packed.view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words).astype(np.int64))])[:-1]

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) != 0

    def rank(self, i: np.ndarray) -> np.ndarray:
        """How many ones are before place i."""
        w = i >> 6
        low = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & low)


class WaveletTree:
    """Ranks of symbols in a sequence, a bit vector per level (pointerless, zeros before ones)."""

    def __init__(self, text: np.ndarray, symbols: int) -> None:
        self.depth = max(1, int(symbols - 1).bit_length())
        self.levels: list[tuple[int, Bits, int]] = []
        t = text
        for shift in range(self.depth - 1, -1, -1):
            bits = (t >> shift) & 1 != 0
            self.levels.append((shift, Bits(bits), int((~bits).sum())))
            t = np.concatenate([t[~bits], t[bits]])

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How many times each symbol occurs before place i (arrays of one length)."""
        lo = np.zeros_like(i)
        for shift, bits, zeros in self.levels:
            one = (symbol >> shift) & 1 != 0
            r_lo, r_hi = bits.rank(lo), bits.rank(i)
            lo = np.where(one, zeros + r_lo, lo - r_lo)
            i = np.where(one, zeros + r_hi, i - r_hi)
        return i - lo

    def access(self, i: np.ndarray) -> np.ndarray:
        """The symbols at places i."""
        symbol = np.zeros_like(i)
        for _, bits, zeros in self.levels:
            one = bits.get(i)
            r = bits.rank(i)
            symbol = symbol * 2 + one
            i = np.where(one, zeros + r, i - r)
        return symbol


class FMIndex:
    """``text``: numbers from 1 to symbols - 1.  ``sample``: every so many places of the text are kept."""

    def __init__(self, text: np.ndarray, symbols: int, sample: int = 8) -> None:
        text = np.append(np.asarray(text, np.int64), 0)
        order = suffix_array(text)
        bwt = text[order - 1]
        self.tree = WaveletTree(bwt, symbols)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])
        self.size = len(text)
        kept = order % sample == 0
        self.kept = Bits(kept)
        self.places = order[kept]

    def ranges(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffix ranges [from, to) of patterns of one length, a row each."""
        lo = np.zeros(len(patterns), np.int64)
        hi = np.full(len(patterns), self.size, np.int64)
        alive = np.arange(len(patterns))
        for j in range(patterns.shape[1] - 1, -1, -1):
            c = patterns[alive, j]
            lo[alive] = self.first[c] + self.tree.rank(c, lo[alive])
            hi[alive] = self.first[c] + self.tree.rank(c, hi[alive])
            alive = alive[hi[alive] > lo[alive]]
            if not len(alive):
                break
        hi = np.maximum(hi, lo)
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The text places of suffix rows: steps back to the next kept place."""
        rows = rows.astype(np.int64)
        out = np.empty(len(rows), np.int64)
        left, steps = np.arange(len(rows)), 0
        while len(left):
            here = rows[left]
            done = self.kept.get(here)
            out[left[done]] = self.places[self.kept.rank(here[done])] + steps
            left, here = left[~done], here[~done]
            c = self.tree.access(here)
            rows[left] = self.first[c] + self.tree.rank(c, here)
            steps += 1
        return out

    def occurrences(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pattern row, text place) of every occurrence."""
        lo, hi = self.ranges(patterns)
        n = hi - lo
        which = np.repeat(np.arange(len(patterns)), n)
        rows = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
        return which, self.locate(rows)

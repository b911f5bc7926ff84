"""An FM-index over a sequence of word ids, searched for many phrases at once with numpy."""

from __future__ import annotations

import numpy as np


def suffix_array(sym: np.ndarray) -> np.ndarray:
    """Order of the suffixes of ``sym``; every 0 is a terminator of its own, ordered by position.

    Ranks of three neighbours are packed into one key, so the depth sorted by triples each round.
    """
    n = len(sym)
    ends = np.flatnonzero(sym == 0)
    rank = sym.astype(np.int64) + len(ends)
    rank[ends] = np.arange(len(ends))
    rank += 1
    depth, bits = 1, np.uint64(21)
    while True:
        size = int(rank.max()) + 1
        far = 3 if size <= 1 << 21 else 2
        shift = bits if far == 3 else np.uint64(32)
        key = rank.astype(np.uint64)
        for step in range(1, far):
            at = step * depth
            key <<= shift
            if at < n:
                key[:n - at] |= rank[at:].astype(np.uint64)
        order = np.argsort(key)
        new = np.ones(n, bool)
        new[1:] = key[order][1:] != key[order][:-1]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new)
        if new.all():
            return order
        depth *= far


class BitRank:
    """A bit vector with rank by 64-bit words."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, bool)
        padded[:len(bits)] = bits
        self.word = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.word).astype(np.int64))])

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Set bits before each position."""
        at = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[at] + np.bitwise_count(self.word[at] & mask)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.word[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) == 1


class WaveletTree:
    """Ranks and values of a sequence: one bit vector per bit of the symbols, highest first."""

    def __init__(self, sym: np.ndarray, largest: int):
        self.depth = max(1, int(largest).bit_length())
        self.levels, self.zeros = [], []
        for level in reversed(range(self.depth)):
            bits = (sym >> level) & 1 == 1
            self.levels.append(BitRank(bits))
            self.zeros.append(int(len(sym) - bits.sum()))
            sym = np.concatenate([sym[~bits], sym[bits]])

    def rank(self, sym: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each position (plus the symbol's own start; see ``start``)."""
        for level, (bits, zeros) in enumerate(zip(self.levels, self.zeros)):
            one = (sym >> (self.depth - 1 - level)) & 1 == 1
            ones = bits.ones(i)
            i = np.where(one, zeros + ones, i - ones)
        return i

    def value(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each position, and ``rank`` of it there."""
        sym = np.zeros(len(i), np.int64)
        for bits, zeros in zip(self.levels, self.zeros):
            one = bits.get(i)
            ones = bits.ones(i)
            i = np.where(one, zeros + ones, i - ones)
            sym = sym * 2 + one
        return sym, i


class FMIndex:
    """``sym``: word ids from 1, where 0 ends a run; phrases hold no 0. It must end with 0."""

    SAMPLE = 16

    def __init__(self, sym: np.ndarray):
        order = suffix_array(sym)
        self.size = len(sym)
        largest = int(sym.max()) if len(sym) else 0
        last = sym[order - 1]
        self.tree = WaveletTree(last, largest)
        counts = np.bincount(sym, minlength=largest + 2)
        self.first = np.concatenate([[0], np.cumsum(counts)])
        every = np.arange(largest + 1)
        self.start = self.tree.rank(every, np.zeros(largest + 1, np.int64))
        # positions are known for every 16th place and wherever a run begins
        known = (order % self.SAMPLE == 0) | (last == 0)
        self.sampled = BitRank(known)
        self.position = order[known]

    def _step(self, sym: np.ndarray, i: np.ndarray) -> np.ndarray:
        return self.first[sym] + self.tree.rank(sym, i) - self.start[sym]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search: for each row of word ids, the range of suffixes that begin with it."""
        known = (phrases < len(self.start)).all(1)
        lo, hi = np.zeros(len(phrases), np.int64), np.zeros(len(phrases), np.int64)
        alive = np.flatnonzero(known)
        for col in reversed(range(phrases.shape[1])):
            sym = phrases[alive, col]
            if col == phrases.shape[1] - 1:
                lo[alive], hi[alive] = self.first[sym], self.first[sym + 1]
            else:
                lo[alive], hi[alive] = self._step(sym, lo[alive]), self._step(sym, hi[alive])
            gone = lo[alive] >= hi[alive]
            lo[alive[gone]] = hi[alive[gone]] = 0
            alive = alive[~gone]
            if not len(alive):
                break
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: step back through the text to a known position."""
        out = np.empty(len(rows), np.int64)
        todo, at, steps = np.arange(len(rows)), rows.copy(), 0
        while len(todo):
            done = self.sampled.get(at)
            out[todo[done]] = self.position[self.sampled.ones(at[done])] + steps
            todo, at = todo[~done], at[~done]
            sym, rank = self.tree.value(at)
            at = self.first[sym] + rank - self.start[sym]
            steps += 1
        return out

"""A string's grammar by recompression, and longest common extensions on it.

Levels alternate: a level of runs names each maximal run of one symbol by (symbol, length), a level of pairs deals
the symbols to two sides by a hash and names each pair that goes from one side to the other.  Whether two
neighbours belong together depends on the two alone, so equal substrings are named alike but for their
ends, and a level of pairs takes off about a quarter of the symbols.

The longest common extension of two positions climbs while both are at the beginning of a name; where one is
not, it compares a name's rest first.  At the level where symbols differ it turns round, and passes on each way
down what the two differing names begin with in common: at most one name or a part of a run.  Queries are
answered many at a time, level by level.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Level:
    """Symbols, and how the next level's names cover them: name k covers first[k] to first[k + 1], place i is in
    name up[i]."""

    symbols: np.ndarray
    first: np.ndarray
    up: np.ndarray
    runs: bool

    def reversed(self) -> Level:
        m, names = len(self.symbols), len(self.first) - 1
        return Level(self.symbols[::-1], (m - self.first)[::-1], (names - 1 - self.up)[::-1], self.runs)


def _named(pairs: np.ndarray, fresh: int) -> tuple[np.ndarray, int]:
    """One new symbol per distinct value."""
    values, which = np.unique(pairs, return_inverse=True)
    return fresh + which, fresh + len(values)


def _sides(symbols: np.ndarray, turn: int) -> np.ndarray:
    """A side for each symbol, another deal each turn."""
    salt = np.uint64((turn + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    z = (symbols.astype(np.uint64) + salt) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return (z >> np.uint64(63)).astype(bool)


class Grammar:
    """The grammar of ``symbols`` (not negative).  The first and the last symbol must occur nowhere else."""

    def __init__(self, symbols: np.ndarray):
        s = np.asarray(symbols, dtype=np.int64)
        self.levels: list[Level] = []
        fresh, turn = int(s.max(initial=0)) + 1, 0
        while len(s) > 1:
            starts = np.append(True, s[1:] != s[:-1])
            if not starts.all():
                fresh, s = self._add(s, starts, fresh, runs=True)
            left = _sides(s, turn)
            turn += 1
            one = left[:-1] & ~left[1:]
            other = ~left[:-1] & left[1:]
            joined = one if one.sum() >= other.sum() else other
            if joined.any():
                fresh, s = self._add(s, np.append(True, ~joined), fresh, runs=False)

    def _add(self, s: np.ndarray, starts: np.ndarray, fresh: int, runs: bool) -> tuple[int, np.ndarray]:
        """Names for the stretches that begin at ``starts``; single symbols keep theirs."""
        first = np.append(np.flatnonzero(starts), len(s))
        sizes = np.diff(first)
        self.levels.append(Level(s, first, np.repeat(np.arange(len(sizes)), sizes), runs))
        several = np.flatnonzero(sizes > 1)
        at = first[several]
        second = sizes[several] if runs else s[at + 1]
        out = s[first[:-1]]
        out[several], fresh = _named(s[at] * (int(second.max()) + 1) + second, fresh)
        return fresh, out

    def reversed(self) -> Grammar:
        """The grammar of the string read backwards."""
        out = object.__new__(Grammar)
        out.levels = [x.reversed() for x in self.levels]
        return out

    def extensions(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols from ``i`` on equal those from ``j`` on, for pairs of different places."""
        origin = np.asarray(i, dtype=np.int64)
        left, right = origin.copy(), np.asarray(j, dtype=np.int64).copy()
        turned = np.zeros(len(left), dtype=np.int64)
        active = np.arange(len(left))
        for h, level in enumerate(self.levels):
            if not len(active):
                break
            a, b = left[active], right[active]
            begun = self._begin(level, a) & self._begin(level, b)
            same = level.symbols[a] == level.symbols[b]
            step = np.where(~begun & same, self._common(level, a, b), 0)
            a, b = a + step, b + step
            climbs = begun | (same & self._begin(level, a) & self._begin(level, b))
            left[active], right[active] = np.where(climbs, level.up[a], a), np.where(climbs, level.up[b], b)
            turned[active[~climbs]] = h
            active = active[climbs]
        order = np.argsort(-turned, kind="stable")
        count = np.searchsorted(-turned[order], -np.arange(len(self.levels) + 1), side="right")
        for h in range(len(self.levels) - 1, 0, -1):
            active = order[:count[h]]  # those that turned at this level or above
            if len(active):
                below = self.levels[h - 1]
                a, b = below.first[left[active]], below.first[right[active]]
                step = np.where(below.symbols[a] == below.symbols[b], self._common(below, a, b), 0)
                left[active], right[active] = a + step, b + step
        return left - origin

    @staticmethod
    def _begin(level: Level, at: np.ndarray) -> np.ndarray:
        return level.first[level.up[at]] == at

    @staticmethod
    def _common(level: Level, a: np.ndarray, b: np.ndarray):
        """What two places with one symbol pass together: the rest of the shorter run, or the symbol."""
        if not level.runs:
            return 1
        return np.minimum(level.first[level.up[a] + 1] - a, level.first[level.up[b] + 1] - b)

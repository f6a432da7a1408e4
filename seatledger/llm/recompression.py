"""Longest common extensions on a run-length grammar made by recompression.

A sequence of numbers is shortened level by level until a handful of symbols is
left.  A block level replaces each stretch of one symbol by a single symbol; a
pair level deals the symbols to a left and a right side and replaces each left
symbol followed by a right one.  Equal stretches are replaced alike wherever
they stand, but for a symbol at each end.  So the first difference after two
places is found by going up the levels while the symbols agree and down again
into the first two that differ: a few steps per level, for many pairs of places
at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Levels end at a sequence this short; what is left is compared symbol by symbol.
TOP = 64


@dataclass
class Level:
    """A sequence of symbols; ``first`` has the place of each symbol's first child one level below."""

    symbols: np.ndarray
    first: np.ndarray | None
    blocks: bool
    parent: np.ndarray | None = None

    def rest(self, at: np.ndarray, above: Level) -> np.ndarray:
        """How many symbols are left in the parent of each place."""
        return above.first[self.parent[at] + 1] - at


def _numbered(*columns: np.ndarray) -> np.ndarray:
    """Rows numbered by content."""
    key = columns[0].astype(np.int64)
    for column in columns[1:]:
        key = key * (int(column.max(initial=0)) + 1) + column
    return np.unique(key, return_inverse=True)[1]


def _block_level(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
    return _numbered(s[first], np.diff(np.r_[first, len(s)])), first


def _pair_level(s: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    mixed = (s.astype(np.uint64) + np.uint64(level + 1)) * np.uint64(0x9E3779B97F4A7C15)
    left = (mixed >> np.uint64(40)) & np.uint64(1) == 1
    pairs = left[:-1] & ~left[1:]
    other = ~left[:-1] & left[1:]
    pairs = other if other.sum() > pairs.sum() else pairs
    first = np.flatnonzero(np.r_[True, ~pairs])
    second = np.where(np.diff(np.r_[first, len(s)]) == 2, s[np.minimum(first + 1, len(s) - 1)] + 1, 0)
    return _numbered(s[first], second), first


class Grammar:
    """The levels over ``sequence``, whose first and last symbols must each occur once only."""

    def __init__(self, sequence: np.ndarray):
        self.levels = [Level(np.unique(sequence, return_inverse=True)[1], None, False)]
        while len(s := self.levels[-1].symbols) > TOP:
            blocks = len(self.levels) % 2 == 1
            symbols, first = _block_level(s) if blocks else _pair_level(s, len(self.levels))
            self.levels[-1].parent = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(s)]))
            self.levels.append(Level(symbols, np.r_[first, len(s)], blocks))

    def mirrored(self) -> Grammar:
        """The same grammar read from the end."""
        out = object.__new__(Grammar)
        out.levels = []
        for level, below in zip(self.levels, [None, *self.levels]):
            parent = None if level.parent is None else level.parent[-1] - level.parent[::-1]
            first = None if below is None else len(below.symbols) - level.first[::-1]
            out.levels.append(Level(level.symbols[::-1], first, level.blocks, parent))
        return out

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols from places ``a`` and from places ``b`` on are equal; ``a`` differs from ``b``."""
        levels = self.levels
        origin, x, y = a.copy(), a.astype(np.int64), b.astype(np.int64)
        height = np.zeros(len(a), np.int64)
        going_up = np.arange(len(a))
        for k, level in enumerate(levels):
            equal = level.symbols[x[going_up]] == level.symbols[y[going_up]]
            going_up = going_up[equal]
            if k + 1 == len(levels):
                while len(going_up):
                    x[going_up] += 1
                    y[going_up] += 1
                    going_up = going_up[level.symbols[x[going_up]] == level.symbols[y[going_up]]]
                break
            above = levels[k + 1]
            px, py = level.parent[x[going_up]], level.parent[y[going_up]]
            inside = (above.first[px] != x[going_up]) | (above.first[py] != y[going_up])
            step = np.minimum(above.first[px + 1] - x[going_up], above.first[py + 1] - y[going_up])
            x[going_up] += np.where(inside, step, 0)
            y[going_up] += np.where(inside, step, 0)
            # Blocks of unequal rests differ right after the shorter one: no need to look higher.
            up = (above.first[level.parent[x[going_up]]] == x[going_up]) & (above.first[level.parent[y[going_up]]] == y[going_up])
            going_up = going_up[up]
            x[going_up], y[going_up] = level.parent[x[going_up]], level.parent[y[going_up]]
            height[going_up] = k + 1
        for k in range(len(levels) - 1, 0, -1):
            down = np.flatnonzero(height >= k)
            above, level = levels[k], levels[k - 1]
            xs, ys = above.first[x[down]], above.first[y[down]]
            equal = level.symbols[xs] == level.symbols[ys]
            if above.blocks:
                step = np.minimum(level.rest(xs, above), level.rest(ys, above))
            else:
                step = 1
            x[down], y[down] = xs + np.where(equal, step, 0), ys + np.where(equal, step, 0)
        return x - origin

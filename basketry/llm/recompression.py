"""Recompression of an integer sequence into a run-length grammar, and longest common extensions on it.

Rounds alternate two compressions until no symbol occurs twice:

* block: each maximal run of one symbol becomes the symbol of (it, length);
* pair: symbols are dealt into left and right by a seeded bit, and each left
  symbol followed by a right one becomes the symbol of the two.

Equal symbols have equal expansions, and where two places agree for long
enough, the rounds treat them alike: a common extension climbs the levels from
its start, aligned with the symbols' edges, until the symbols differ, and
descends to the place inside them where the expansions do.  A level steps over
at most one pair or one run, so a query costs a few steps a level; all queries
of a batch move together.  Backward extensions use the same levels, read from
right to left.
"""

from __future__ import annotations

import dataclasses

import numpy as np

from basketry.llm import common as C


@dataclasses.dataclass
class Level:
    """A sequence of symbols, and how it was compressed into the next level."""

    symbols: np.ndarray
    block: bool = False
    parent: np.ndarray | None = None  # place in the next level
    first: np.ndarray | None = None  # by place in the next level: the first symbol here, and one past the last
    _back: "Level | None" = None

    def backward(self) -> "Level":
        """The level read from right to left."""
        if self._back is None:
            if self.parent is None:
                self._back = Level(self.symbols[::-1])
            else:
                n, up = len(self.symbols), len(self.first) - 1
                self._back = Level(self.symbols[::-1], self.block, (up - 1 - self.parent)[::-1], (n - self.first)[::-1])
        return self._back


def _named(keys: np.ndarray, fresh: int) -> tuple[np.ndarray, int]:
    """New symbols, the same for equal keys; the next free symbol."""
    names, inverse = np.unique(keys, return_inverse=True)
    return inverse + fresh, fresh + len(names)


def grammar(sequence: np.ndarray) -> list[Level]:
    """The levels of ``sequence`` (small non-negative integers), from itself to one without a repeated symbol."""
    cur = sequence.astype(np.int64)
    fresh = int(cur.max(initial=-1)) + 1
    out: list[Level] = []
    turn = 0
    while True:
        if len(np.unique(cur)) == len(cur):
            return [*out, Level(cur)]
        turn += 1
        starts = np.ones(len(cur), bool)
        if turn % 2:
            starts[1:] = cur[1:] != cur[:-1]
        else:
            right = (C.mix(cur.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(turn)) >> np.uint64(17)) & np.uint64(1) > 0
            starts[1:] = right[:-1] | ~right[1:]
        edge = np.append(np.flatnonzero(starts), len(cur))
        size = np.diff(edge)
        many = np.flatnonzero(size > 1)
        if not len(many):
            continue
        nxt = cur[edge[:-1]]
        told = size[many] if turn % 2 else cur[edge[many] + 1]
        nxt[many], fresh = _named(nxt[many] * np.int64(max(fresh, len(cur)) + 1) + told, fresh)
        out.append(Level(cur, bool(turn % 2), np.cumsum(starts) - 1, edge))
        cur = nxt


def extend(levels: list[Level], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Common symbols of ``levels[0]`` from ``a[k]`` and ``b[k]`` (different places) on.

    The sequence must end in a symbol that occurs once.
    """
    start = a
    a, b = a.copy(), b.copy()
    height = np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    for at, level in enumerate(levels):  # climb while the symbols agree
        height[live] = at
        x, y = a[live], b[live]
        same = level.symbols[x] == level.symbols[y]
        live, x, y = live[same], x[same], y[same]
        if not len(live):
            break
        p, q = level.parent[x], level.parent[y]
        loose = (level.first[p] != x) | (level.first[q] != y)
        if level.block:
            left, right = level.first[p + 1] - x, level.first[q + 1] - y
            step = np.where(loose, np.minimum(left, right), 0)
            a[live] += step
            b[live] += step
            go = ~loose | (left == right)  # a shorter run ends at a different symbol
            live, step = live[go], step[go]
        else:
            a[live] += loose
            b[live] += loose
        a[live], b[live] = level.parent[a[live]], level.parent[b[live]]
    for at in range(int(height.max(initial=0)) - 1, -1, -1):  # descend to the place where they differ
        level = levels[at]
        live = np.flatnonzero(height > at)
        x, y = level.first[a[live]], level.first[b[live]]
        same = level.symbols[x] == level.symbols[y]
        if level.block:
            p, q = a[live], b[live]
            step = np.where(same, np.minimum(level.first[p + 1] - x, level.first[q + 1] - y), 0)
        else:
            step = same
        a[live], b[live] = x + step, y + step
    return a - start


def extend_back(levels: list[Level], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Common symbols that end at ``a[k]`` and ``b[k]``; the sequence must begin with a symbol that occurs once."""
    n = len(levels[0].symbols)
    return extend([x.backward() for x in levels], n - 1 - a, n - 1 - b)

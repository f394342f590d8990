"""Run-length grammars by recompression, and longest common extensions on them.

A sequence of symbols is shortened by turns: block compression replaces each
maximal block of one symbol by a new symbol for (symbol, count); pair
compression splits the symbols into left and right ones and replaces each
left-right pair by a new symbol.  Equal stretches are replaced alike except at
their ends, so the common extension of two places is found by climbing while
both stand at a boundary of the next level (at most one symbol or one block
is compared per level) and coming down again (one symbol or block per level).
All queries of a batch are answered together, level by level.
"""

from __future__ import annotations

import numpy as np
import pandas as pd


def _side(symbols: np.ndarray, level: int) -> np.ndarray:
    """Left (True) or right: one mixed bit of the symbol, another at each level."""
    x = symbols.astype(np.uint64) + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(63)).astype(bool)


def _blocks(symbols: np.ndarray) -> np.ndarray:
    """Where each maximal block of one symbol begins."""
    return np.flatnonzero(np.concatenate([[True], symbols[1:] != symbols[:-1]]))


class Grammar:
    """Levels of a recompressed sequence; ``forward`` and ``backward`` give common extensions.

    Level 2k holds the symbols before block compression, level 2k+1 those
    before pair compression.  ``starts[l]`` is where each symbol of level l + 1
    begins in level l, ``at[l]`` the symbol of level l + 1 that holds each of level l.
    The sequence gets a mark of its own at either end, so that no extension passes it.
    """

    def __init__(self, symbols: np.ndarray):
        codes = pd.factorize(symbols)[0].astype(np.int64) + 1
        now = np.concatenate([[0], codes, [len(symbols) + 1]])
        self.levels, self.starts, self.at = [now], [], []
        names = len(symbols) + 2  # of the symbols so far
        level = 0
        while len(now) > 2 and (level == 0 or self._repeats(now)):
            begin = _blocks(now)
            count = np.diff(np.append(begin, len(now)))
            now, names = self._up(begin, now[begin], count, count > 1, names)
            left = _side(now, level)
            first = np.flatnonzero(left[:-1] & ~left[1:])
            begin = np.ones(len(now), bool)
            begin[first + 1] = False
            begin = np.flatnonzero(begin)
            paired = np.diff(np.append(begin, len(now))) > 1
            after = now[np.minimum(begin + 1, len(now) - 1)]
            now, names = self._up(begin, now[begin], after, paired, names)
            level += 2

    @staticmethod
    def _repeats(symbols: np.ndarray) -> bool:
        """Whether any symbol is met twice; if none is, no extension reaches further up."""
        return len(pd.unique(symbols)) < len(symbols)

    def _up(self, begin: np.ndarray, head: np.ndarray, second: np.ndarray, new: np.ndarray, names: int) -> tuple[np.ndarray, int]:
        """The next level: ``head`` where a symbol stays, one name per (head, second) where ``new``."""
        span = int(second.max()) + 1
        made, found = pd.factorize(head[new] * span + second[new])
        now = head.copy()
        now[new] = made + names
        at = np.zeros(len(self.levels[-1]), np.int64)
        at[begin[1:]] = 1
        self.starts.append(begin)
        self.at.append(np.cumsum(at))
        self.levels.append(now)
        return now, names + len(found)

    def forward(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Symbols that agree from places ``x`` and ``y`` on (``x < y``, from 0)."""
        return self._extend(x + 1, y + 1, +1)

    def backward(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Symbols that agree before places ``x`` and ``y`` (``x < y``, from 0)."""
        return self._extend(x + 1, y + 1, -1)

    def _step(self, level: int, x: np.ndarray, y: np.ndarray, way: int) -> tuple[np.ndarray, np.ndarray]:
        """How far one comparison goes from ``x`` and from ``y``, and whether it ends at a difference.

        One symbol at a pair level; at a block level what is left of both blocks, if they are of one symbol.
        """
        symbols = self.levels[level]
        a, b = (x, y) if way > 0 else (x - 1, y - 1)
        same = symbols[a] == symbols[b]
        if level % 2:
            return same.astype(np.int64), ~same
        starts, at = self.starts[level], self.at[level]
        if way > 0:
            ends = np.append(starts[1:], len(symbols))
            of_x, of_y = ends[at[a]] - a, ends[at[b]] - b
        else:
            of_x, of_y = a - starts[at[a]] + 1, b - starts[at[b]] + 1
        return np.where(same, np.minimum(of_x, of_y), 0), ~same | (of_x != of_y)

    def _extend(self, x: np.ndarray, y: np.ndarray, way: int) -> np.ndarray:
        """Climb from level 0 until a difference shows, then narrow it down to level 0 again.

        Places are boundaries between symbols: what lies after (``way`` +1) or before (-1) is compared.
        """
        begin, n, top = x, len(x), len(self.levels) - 1
        x, y = x.copy(), y.copy()
        stopped = np.full(n, top)  # the level where each query met its difference
        rising = np.arange(n)
        for level in range(top):
            starts, at = self.starts[level], self.at[level]
            edge = lambda p: (p < len(at)) & (starts[at[np.minimum(p, len(at) - 1)]] == p) | (p >= len(at))
            inside = rising[~(edge(x[rising]) & edge(y[rising]))]
            if len(inside):
                far, differs = self._step(level, x[inside], y[inside], way)
                x[inside] += way * far
                y[inside] += way * far
                stopped[inside[differs]] = level
                rising = rising[stopped[rising] == top]
            if not len(rising):
                break
            for p in (x, y):
                held = p[rising]
                p[rising] = np.where(held < len(at), at[np.minimum(held, len(at) - 1)], len(starts))
        order = np.argsort(-stopped, kind="stable")
        falling = 0
        for level in range(top, -1, -1):
            falling = int(np.searchsorted(-stopped[order], -level, "right"))
            who = order[:falling]
            if level < top:
                came = who[stopped[who] > level]
                starts = np.append(self.starts[level], len(self.levels[level]))
                x[came], y[came] = starts[x[came]], starts[y[came]]
                far, _ = self._step(level, x[came], y[came], way)
                x[came] += way * far
                y[came] += way * far
            else:  # the top is compared symbol by symbol; all of its symbols differ unless it is the only level
                far = self._walk(who, x, y, way)
                x[who] += way * far
                y[who] += way * far
        return np.abs(x - begin)

    def _walk(self, who: np.ndarray, x: np.ndarray, y: np.ndarray, way: int) -> np.ndarray:
        symbols, far = self.levels[-1], np.zeros(len(who), np.int64)
        going = np.arange(len(who))
        while len(going):
            a, b = x[who[going]] + way * far[going], y[who[going]] + way * far[going]
            if way < 0:
                a, b = a - 1, b - 1
            inner = (np.minimum(a, b) >= 0) & (np.maximum(a, b) < len(symbols))
            going, a, b = going[inner], a[inner], b[inner]
            same = symbols[a] == symbols[b]
            going = going[same]
            far[going] += 1
        return far

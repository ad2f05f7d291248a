"""Run-length grammar of a sequence by recompression, and longest common extensions on it.

A sequence is rewritten level by level.  Block compression replaces every maximal block of one
symbol by a symbol of its own for (symbol, length); pair compression deals the symbols into a
left and a right half by a hash and replaces every pair left-right by a symbol of its own.  Both
depend on the symbols alone, so equal stretches are rewritten equally except at their ends, and
two extensions are compared by climbing the levels in step: at each level at most one symbol (or
the rest of one block) is compared before both places stand at the start of a symbol of the
next level.  Where symbols differ, the way leads down again in the same manner.

Symbols below zero are separators: each occurs once and is never joined.  A sequence must begin
and end with one, so that no extension leaves its part of the sequence.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from ridgeline.llm.common import multipliers


class Level(NamedTuple):
    """Symbols of a level; the symbol of the next level that each belongs to, and where those start (and the end)."""

    symbols: np.ndarray
    parent: np.ndarray
    first: np.ndarray
    blocks: bool

    def mirrored(self) -> Level:
        """The level as read from the right."""
        return Level(self.symbols[::-1], (len(self.first) - 2 - self.parent)[::-1], (len(self.symbols) - self.first)[::-1], self.blocks)


class Grammar(NamedTuple):
    levels: list[Level]
    top: np.ndarray

    def mirrored(self) -> Grammar:
        return Grammar([level.mirrored() for level in self.levels], self.top[::-1])


def _level(symbols: np.ndarray, starts: np.ndarray, blocks: bool) -> Level:
    first = np.append(np.flatnonzero(starts), len(symbols)).astype(np.int32)
    return Level(symbols, (np.cumsum(starts) - 1).astype(np.int32), first, blocks)


def _renamed(symbols: np.ndarray, where: np.ndarray, keys: np.ndarray, fresh: int) -> tuple[np.ndarray, int]:
    """``symbols`` with those at ``where`` numbered from ``fresh`` on, equal keys alike."""
    own, number = np.unique(keys, return_inverse=True)
    symbols[where] = (fresh + number).astype(np.int32)
    return symbols, fresh + len(own)


def recompress(symbols: np.ndarray) -> Grammar:
    """Grammar of ``symbols``: until no two symbols that are not separators stand side by side."""
    symbols = symbols.astype(np.int32)
    fresh, levels = int(symbols.max(initial=0)) + 1, []
    odd = multipliers(256, seed=11)
    turn = 0
    while True:
        starts = np.ones(len(symbols), bool)
        starts[1:] = symbols[1:] != symbols[:-1]
        if not starts.all():
            levels.append(_level(symbols, starts, True))
            length = np.diff(levels[-1].first)
            symbols = symbols[starts]
            many = np.flatnonzero(length > 1)
            keys = symbols[many].astype(np.int64) << np.int64(32) | length[many]
            symbols, fresh = _renamed(symbols, many, keys, fresh)
        plain = symbols >= 0
        if not (plain[1:] & plain[:-1]).any():
            return Grammar(levels, symbols)
        side = (symbols.astype(np.uint64) * odd[turn % len(odd)]) >> np.uint64(63) == 1
        turn += 1
        left, right = plain & side, plain & ~side
        pairs, other = left[:-1] & right[1:], right[:-1] & left[1:]
        if other.sum() > pairs.sum():
            pairs = other
        heads = np.flatnonzero(pairs)
        if not len(heads):
            continue
        starts = np.ones(len(symbols), bool)
        starts[heads + 1] = False
        levels.append(_level(symbols, starts, False))
        keys = symbols[heads].astype(np.int64) << np.int64(32) | symbols[heads + 1]
        symbols, fresh = _renamed(symbols[starts], levels[-1].parent[heads], keys, fresh)


def extensions(grammar: Grammar, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each pair of different places: how many symbols from them on are equal."""
    a, b = i.astype(np.int64), j.astype(np.int64)
    stop = np.full(len(a), len(grammar.levels))
    going = np.arange(len(a))
    for k, level in enumerate(grammar.levels):
        if not len(going):
            break
        x, y = a[going], b[going]
        up, vp = level.parent[x], level.parent[y]
        within = (level.first[up] != x) | (level.first[vp] != y)
        same = level.symbols[x] == level.symbols[y]
        ends = within & ~same
        if within.any():
            left, right = level.first[up + 1] - x, level.first[vp + 1] - y
            step = np.where(within & same, np.minimum(left, right) if level.blocks else 1, 0)
            ends |= within & same & level.blocks & (left != right)
            x, y = x + step, y + step
        a[going], b[going] = x, y
        stop[going[ends]] = k
        going = going[~ends]
        a[going], b[going] = level.parent[a[going]], level.parent[b[going]]
    while len(going):
        going = going[grammar.top[a[going]] == grammar.top[b[going]]]
        a[going] += 1
        b[going] += 1
    for k in range(len(grammar.levels) - 1, -1, -1):
        level = grammar.levels[k]
        down = np.flatnonzero(stop > k)
        if not len(down):
            continue
        up, vp = a[down], b[down]
        x, y = level.first[up].astype(np.int64), level.first[vp].astype(np.int64)
        same = level.symbols[x] == level.symbols[y]
        size = np.minimum(level.first[up + 1] - x, level.first[vp + 1] - y) if level.blocks else 1
        a[down], b[down] = x + same * size, y + same * size
    return a - i

"""Suffix arrays of many short strings at once, by linear grouping (no recursive renaming).

For every string the suffixes are first grouped by their first symbol.  Groups are processed
in descending order.  A suffix of the current group ends the known prefix of the nearest
suffix to its left that has a smaller group (its previous-smaller pointer); the suffixes so
pointed at move to new groups right after their own, ordered by how many suffixes of the
current group follow them in a row.  When all groups are processed, the suffixes of a group
share their Lyndon prefix and groups are in order.  Then suffixes are emitted in ascending
order: each emitted suffix places, at the front of their groups, the suffixes whose Lyndon
prefix ends where it starts.

Strings are rows of one matrix and take every step together, so a step is numpy work on all.
"""

from __future__ import annotations

import numpy as np


def suffix_arrays(text: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Row r of the result: the starts of the suffixes of ``text[r, :length[r]]`` in ascending order, then -1.

    The end of a string is smaller than any symbol.  Symbols are non-negative.
    """
    rows, n = text.shape
    if rows == 0 or n == 0:
        return np.full((rows, n), -1, np.int32)
    wide = -(-n // 8) * 8  # whole machine words a row; see _equal
    if wide != n:
        text = np.concatenate((text, np.zeros((rows, wide - n), text.dtype)), axis=1)
    inside = np.arange(wide) < length[:, None]
    group, size = _first_groups(text, inside)
    final, end = _lyndon_groups(group, size, inside, length)
    return _emit(final, end, inside, length)[:, :n]


def _equal(matrix: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the cells that equal their row's value, in order; looks at words of eight cells first."""
    hit = matrix == value[:, None]
    word = np.flatnonzero(hit.reshape(-1).view(np.uint64))
    w, c = np.nonzero(hit.reshape(-1, 8)[word])
    at = word[w] * 8 + c
    return at // matrix.shape[1], at % matrix.shape[1]


def _first_groups(text: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group of each suffix, named by the group's first place in the order (-1 outside), and group sizes by name."""
    rows, n = text.shape
    symbol = np.where(inside, text, np.iinfo(np.int16).max).astype(np.int16)
    order = np.argsort(symbol, axis=1, kind="stable")
    ranked = np.take_along_axis(symbol, order, axis=1)
    first = np.ones((rows, n), bool)
    first[:, 1:] = ranked[:, 1:] != ranked[:, :-1]
    name = np.maximum.accumulate(np.where(first, np.arange(n), 0), axis=1)
    group = np.empty((rows, n), np.int16)
    np.put_along_axis(group, order, name.astype(np.int16), axis=1)
    flat = (np.arange(rows)[:, None] * n + group)[inside]
    size = np.bincount(flat, minlength=rows * n)
    group[~inside] = -1
    return group, size


def _lyndon_groups(group: np.ndarray, size: np.ndarray, inside: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Groups by Lyndon prefix, and the position at which each suffix's Lyndon prefix ends.

    Positions that are not processed yet are a doubly linked list, so the previous-smaller
    pointer of a suffix of the current (largest) group is its left neighbour outside the group.
    """
    rows, n = group.shape
    width = n + 2  # list cells: 0 before the string, position + 1, length + 1 after it
    left = np.tile(np.arange(-1, n + 1, dtype=np.int32), rows)
    right = np.tile(np.arange(1, n + 3, dtype=np.int32), rows)
    final = np.where(inside, group, 0).astype(np.int32)
    end = np.zeros((rows, n), np.int32)
    work, flat_final, flat_end = group, final.reshape(-1), end.reshape(-1)
    alive, part = np.arange(rows), work  # rows of ``part``, a copy of some rows of ``work`` once most are done
    while True:
        current = part.max(axis=1)
        still = current >= 0
        left_over = int(still.sum())
        if not left_over:
            break
        if 4 * left_over < 3 * len(alive):
            alive, part, current = alive[still], part[still], current[still]
        elif left_over < len(alive):
            current = np.where(still, current, np.int16(-2))
        r, i = _equal(part, current)
        at = alive[r] * n + i
        cell = alive[r] * width + i + 1
        to_left, to_right = left[cell], right[cell]
        flat_end[at] = to_right - 1
        # runs: members that are neighbours of each other in the list
        head = np.ones(len(at), bool)
        head[1:] = (r[1:] != r[:-1]) | (to_left[1:] != i[:-1] + 1)
        heads = np.flatnonzero(head)
        tails = np.append(heads[1:], len(at)) - 1
        run = tails - heads + 1
        row, before, after = alive[r[heads]], to_left[heads], to_right[tails]
        part[r, i] = -1
        right[row * width + before] = after
        left[row * width + after] = before
        some = before > 0
        row, pointed, run, own = row[some], before[some] - 1, run[some], r[heads[some]]
        if not len(row):
            continue
        # new groups: within each old group by run length, longer runs last
        suffix = row * n + pointed
        old = row * n + flat_final[suffix]
        order = np.argsort(old * (n + 1) + (n - run), kind="stable")
        suffix, old, run, own, pointed = suffix[order], old[order], run[order], own[order], pointed[order]
        places = np.arange(len(order))
        new_old = np.ones(len(order), bool)
        new_old[1:] = old[1:] != old[:-1]
        new_class = new_old.copy()
        new_class[1:] |= run[1:] != run[:-1]
        start = np.maximum.accumulate(np.where(new_old, places, 0))
        class_first = np.flatnonzero(new_class)
        class_last = np.append(class_first[1:], len(order)) - 1
        name_at = old[class_first] + size[old[class_first]] - (class_last - start[class_first] + 1)
        moved_first = np.flatnonzero(new_old)
        moved = np.append(moved_first[1:], len(order)) - moved_first
        size[old[moved_first]] -= moved
        size[name_at] = class_last - class_first + 1
        name = np.repeat(name_at, class_last - class_first + 1) % n
        flat_final[suffix] = name
        part[own, pointed] = name
    return final, end


def _emit(final: np.ndarray, end: np.ndarray, inside: np.ndarray, length: np.ndarray) -> np.ndarray:
    rows, n = final.shape
    # suffixes by where their Lyndon prefix ends
    which = np.flatnonzero(inside.reshape(-1))
    row = which // n
    key = row * (n + 1) + end.reshape(-1)[which]
    by_end = which[np.argsort(key, kind="stable")]
    count = np.bincount(key, minlength=rows * (n + 1))
    first = np.cumsum(count) - count
    free = np.tile(np.arange(n, dtype=np.int32), rows)
    order = np.full(rows * n, -1, np.int32)
    flat_final = final.reshape(-1)
    at = np.flatnonzero(length > 0)
    now = length[at].astype(np.int64)
    for step in range(n + 1):
        slot = at * (n + 1) + now
        many = count[slot]
        total = int(many.sum())
        if total:
            ahead = np.cumsum(many) - many
            placed = by_end[np.repeat(first[slot] - ahead, many) + np.arange(total)]
            bucket = placed // n * n + flat_final[placed]
            where = placed // n * n + free[bucket]
            order[where] = placed % n
            free[bucket] += 1
        if step == n:
            break
        on = length[at] > step
        at = at[on]
        if not len(at):
            break
        now = order[at * n + step].astype(np.int64)
    return order.reshape(rows, n)

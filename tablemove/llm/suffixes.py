"""Ordering windows of text: multikey quicksort to a shallow depth, blind tries below it.

Pure array code on one bounded group of segments; ``repeats`` deals the groups out.
"""

from __future__ import annotations

import numpy as np

#: Bytes that the multikey sort looks at before blind tries take over.
SHALLOW = 32
_WORD = 8


def words_at(data: np.ndarray) -> np.ndarray:
    """For each byte, it and the seven behind it as one big-endian number; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(_WORD, np.uint8)]).astype(np.uint64)
    total = np.zeros(data.size, np.uint64)
    for i in range(_WORD):
        total = (total << np.uint64(8)) | padded[i : i + data.size]
    return total


def _ranked(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by both keys, and in that order the numbers of the groups that agree in both."""
    order = np.lexsort((second, first))
    a, b = first[order], second[order]
    new = np.ones(order.size, bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return order, np.cumsum(new) - 1


def _several(groups: np.ndarray) -> np.ndarray:
    """Which entries share their group with another one; groups are numbered from 0."""
    return np.bincount(groups)[groups] > 1


def _common(words: np.ndarray, data: np.ndarray, x: np.ndarray, y: np.ndarray, start: int, length: int) -> np.ndarray:
    """Bytes that the windows at ``x`` and ``y`` agree in, given that ``start`` of them do."""
    result = np.full(x.size, length, np.int64)
    open_ = np.flatnonzero(x != y)
    at = start
    while open_.size and at < length:
        differ = words[x[open_] + at] != words[y[open_] + at]
        found = open_[differ]
        if found.size:
            depth = np.full(found.size, at, np.int64)
            same = np.ones(found.size, bool)
            for i in range(_WORD):
                inside = np.minimum(at + i, length - 1)
                same &= data[x[found] + inside] == data[y[found] + inside]
                depth += same & (at + i < length)
            result[found] = np.minimum(depth, length)
        open_ = open_[~differ]
        at += _WORD
    return result


def equal_windows(data: np.ndarray, starts: np.ndarray, keys: np.ndarray, length: int) -> np.ndarray:
    """A class number for each window ``data[start : start + length]``: same key and same bytes, same class.

    Windows are ordered by key and bytes. The multikey quicksort splits all groups at once, a
    word of eight bytes a step, and leaves out groups that are down to one window. Groups that still
    agree in ``SHALLOW`` bytes have long common prefixes: each becomes a blind trie, whose
    nodes know only the depth at which their windows first differ and the byte there. A node's
    depth is the least that any of its windows has in common with the first one, all
    nodes of a level are made in one step, and windows that never differ end in one leaf.
    """
    words = words_at(data)
    _, groups = np.unique(keys, return_inverse=True)
    active = np.arange(starts.size)
    result = np.empty(starts.size, np.int64)
    made = 0

    def settle(entries: np.ndarray, own: np.ndarray) -> None:
        nonlocal made
        if entries.size:
            result[entries] = made + own
            made += int(own.max()) + 1

    def split(active: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Settles groups of one window and numbers the others anew."""
        several = _several(groups)
        alone = active[~several]
        settle(alone, np.arange(alone.size))
        active, groups = active[several], groups[several]
        return active, np.unique(groups, return_inverse=True)[1] if groups.size else groups

    for depth in range(0, min(SHALLOW, length - _WORD + 1), _WORD):
        active, groups = split(active, groups)
        if not active.size:
            return result
        order, groups = _ranked(groups, words[starts[active] + depth])
        active = active[order]
    active, groups = split(active, groups)

    known = min(SHALLOW, (length // _WORD) * _WORD)
    while active.size:
        order = np.argsort(groups, kind="stable")
        active, groups = active[order], groups[order]
        begins = np.flatnonzero(np.diff(groups, prepend=-1))
        first = starts[active[begins]][groups]
        common = _common(words, data, starts[active], first, known, length)
        depth = np.minimum.reduceat(common, begins)
        same = depth[groups] >= length
        leaf = groups[same]
        if leaf.size:
            settle(active[same], np.unique(leaf, return_inverse=True)[1])
        active, groups = active[~same], groups[~same]
        if not active.size:
            break
        branch = data[starts[active] + depth[groups]]
        order, numbers = _ranked(groups, branch.astype(np.int64))
        # Below a node its windows agree as far as its depth; the least of all nodes is enough to know.
        known = int(depth[groups].min())
        active, groups = split(active[order], numbers)
    return result

"""Suffix arrays by linear grouping.

Phase one sorts the suffixes into groups of equal Lyndon prefixes.  Groups are
taken from the largest down; a suffix of the group points to the nearest suffix to
its left that is in a smaller group, and all suffixes pointed at move behind the
others of their group, by how often they are met.  Phase two reads the order off:
in ascending order each suffix that is placed places the one to its left and
those that this one points to, each at the next place of its group.  No part of the
text is renamed or sorted recursively.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np


def suffix_array(text: Sequence[int]) -> np.ndarray:
    """Start positions of the suffixes of ``text`` in ascending order.

    ``text`` holds non-negative numbers; its end sorts before all of them.
    """
    n = len(text) + 1  # the end is a suffix of its own
    codes = np.zeros(n, np.int64)
    codes[:-1] = np.asarray(text, np.int64) + 1
    by_code = np.argsort(codes, kind="stable")
    ordered = codes[by_code]
    heads = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    first = np.empty(n, np.int64)
    first[by_code] = np.repeat(heads, np.diff(np.append(heads, n)))
    place = np.empty(n, np.int64)
    place[by_code] = np.arange(n)
    order, at, group = by_code.tolist(), place.tolist(), first.tolist()
    size = [0] * n
    for h, c in zip(heads.tolist(), np.diff(np.append(heads, n)).tolist()):
        size[h] = c
    left = _group(order, at, group, size)
    return np.array(_emit(group, left), np.int64)[1:]


def _group(order: list[int], at: list[int], group: list[int], size: list[int]) -> list[int]:
    """Phase one.  A group is named by the first place of its suffixes in ``order``;
    ``group`` is refined in place.  Returns the previous-smaller pointers."""
    left = [-1] * len(order)
    end = len(order)
    while end > 0:
        start = group[order[end - 1]]
        if end - start == 1:
            i = order[start]
            p = i - 1
            while p >= 0 and group[p] > start:
                p = left[p]
            left[i] = p
            if p >= 0:
                g = group[p]
                last = size[g] - 1
                if last:  # p becomes a group of its own behind the rest
                    size[g] = last
                    last += g
                    q = order[last]
                    if q != p:
                        here = at[p]
                        order[here], order[last] = q, p
                        at[q], at[p] = here, last
                    group[p] = last
                    size[last] = 1
        else:
            met: dict[int, int] = {}
            for i in sorted(order[start:end]):
                p = i - 1
                while p >= 0 and group[p] >= start:
                    p = left[p]
                left[i] = p
                if p >= 0 and size[group[p]] > 1:
                    met[p] = met.get(p, 0) + 1
            if met:
                most = max(met.values())
                for c in range(most, 0, -1):
                    _split([p for p, k in met.items() if k == c] if most > 1 else list(met), order, at, group, size)
        end = start
    return left


def _split(moved: list[int], order: list[int], at: list[int], group: list[int], size: list[int]) -> None:
    """All of ``moved`` leave their groups for new groups right behind them; a group that
    would move as a whole stays as it is."""
    leaving: dict[int, int] = {}
    for p in moved:
        g = group[p]
        leaving[g] = leaving.get(g, 0) + 1
    new = {}
    for g, k in leaving.items():
        if k < size[g]:
            size[g] -= k
            new[g] = g + size[g]
            size[new[g]] = k
    free = dict(new)
    for p in moved:
        g = group[p]
        if g in free:
            last = free[g]
            free[g] = last + 1
            group[p] = new[g]
            q, here = order[last], at[p]
            order[here], order[last] = q, p
            at[q], at[p] = here, last


def _emit(group: list[int], left: list[int]) -> list[int]:
    """Phase two: the order of all suffixes from their groups and pointers."""
    n = len(group)
    out = [-1] * n
    out[0] = n - 1
    free = list(range(n))  # next place of the group that starts here
    group[n - 1] = -1  # placed
    for i in range(n):
        p = out[i] - 1
        while p >= 0:
            g = group[p]
            if g < 0:
                break
            k = free[g]
            out[k] = p
            free[g] = k + 1
            group[p] = -1
            p = left[p]
    return out

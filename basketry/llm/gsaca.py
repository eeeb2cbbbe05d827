"""Suffix sorting by linear grouping construction.

Phase 1 groups the suffixes by their longest Lyndon prefix.  Groups are taken
in descending order; each member finds its previous smaller suffix by
following pointers, and the suffixes pointed at move behind the rest of
their group, those pointed at more often further.  Phase 2 reads the suffix
array from its front: the suffixes whose next smaller suffix is the one just
read go to the front of what is left of their group.  No recursion and no
renaming; both phases are linear.
"""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix array of a sequence of integers (a suffix precedes its extensions)."""
    m = len(text)
    n = m + 1
    values = np.zeros(n, np.int64)
    values[:m] = np.unique(text, return_inverse=True)[1] + 1 if m else 0
    values[m] = 0
    order = np.argsort(values, kind="stable")
    by = values[order]
    starts = np.flatnonzero(np.concatenate([[True], by[1:] != by[:-1]]))
    lengths = np.diff(np.append(starts, n))
    first = np.empty(n, np.int64)
    first[order] = np.repeat(starts, lengths)
    where = np.empty(n, np.int64)
    where[order] = np.arange(n)
    sizes = np.zeros(n, np.int64)
    sizes[starts] = lengths
    sa, pos, group, size = order.tolist(), where.tolist(), first.tolist(), sizes.tolist()
    prev = [-1] * n

    # Phase 1: groups in descending order.
    end = n - 1
    while end > 0:
        g = group[sa[end]]
        if g == end:
            i = sa[end]
            p = i - 1
            while p >= 0 and group[p] >= g:
                p = prev[p]
            prev[i] = p
            if p >= 0:
                old = group[p]
                last = old + size[old] - 1
                if last != old:  # p becomes a group of its own behind the others
                    q, at = sa[last], pos[p]
                    sa[at] = q
                    pos[q] = at
                    sa[last] = p
                    pos[p] = last
                    size[old] -= 1
                    group[p] = last
                    size[last] = 1
            end -= 1
            continue
        count: dict[int, int] = {}
        most = 1
        for i in sorted(sa[g:end + 1]):
            p = i - 1
            while p >= 0 and group[p] >= g:
                p = prev[p]
            prev[i] = p
            if p >= 0:
                if p in count:
                    c = count[p] = count[p] + 1
                    if c > most:
                        most = c
                else:
                    count[p] = 1
        if most == 1:
            levels = [list(count)]
        else:
            by_count: dict[int, list[int]] = {}
            for p, c in count.items():
                by_count.setdefault(c, []).append(p)
            levels = [by_count[c] for c in sorted(by_count, reverse=True)]
        for level in levels:
            moved: dict[int, int] = {}
            for p in level:
                old = group[p]
                size[old] -= 1
                last = old + size[old]
                moved[old] = moved.get(old, 0) + 1
                q = sa[last]
                if q != p:
                    at = pos[p]
                    sa[at] = q
                    pos[q] = at
                    sa[last] = p
                    pos[p] = last
            for p in level:
                old = group[p]
                if moved[old] > 0:
                    moved[old] = -moved[old]
                    if size[old]:
                        size[old + size[old]] = -moved[old]
            for p in level:
                old = group[p]
                if size[old]:
                    group[p] = old + size[old]
            for old, c in moved.items():
                if not size[old]:  # all of it moved: it stays one group
                    size[old] = -c
        end = g - 1

    # Phase 2: the order within the groups.
    out = [0] * n
    placed = bytearray(n)
    out[0] = m
    placed[m] = 1
    free = list(range(n))
    for k in range(n):
        j = out[k] - 1
        while j >= 0 and not placed[j]:
            placed[j] = 1
            g = group[j]
            at = free[g]
            out[at] = j
            free[g] = at + 1
            j = prev[j]
    return np.array(out[1:], np.int64)

"""Suffix array by linear grouping: no recursion and no renaming.

First phase: suffixes start grouped by their first symbol. Groups are processed from the highest to the lowest. For each
suffix of a group the pointer to the nearest earlier suffix in a lower group (previous smaller) is found by following the
pointers of what lies between; the suffixes pointed at are moved to the end of their own group, ordered by how many members
point at them. In the end a group holds the suffixes with the same longest Lyndon prefix, and groups are in order.

Second phase: from the smallest suffix on, each suffix places the one before it, and what that one points at, at the next
free place of their groups.
"""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: list[int] | np.ndarray) -> list[int]:
    """Order of the suffixes of ``symbols``, whose last entry must be smaller than all others."""
    n = len(symbols)
    if n < 2:
        return list(range(n))
    text = np.asarray(symbols)
    first = np.argsort(text, kind="stable")
    starts = np.flatnonzero(np.concatenate([[True], np.diff(text[first]) != 0]))
    sizes, spots, of = np.diff(np.append(starts, n)), np.empty(n, np.int64), np.empty(n, np.int64)
    spots[first], of[first] = np.arange(n), np.repeat(starts, sizes)
    ends = np.zeros(n + 1, np.int64)
    ends[starts] = starts + sizes
    order, place, group, end = first.tolist(), spots.tolist(), of.tolist(), ends.tolist()

    before = [-1] * n
    top = n
    # The lowest group is the last suffix alone, which points at nothing. It also stands behind the first place: ``group[-1]`` ends a search.
    while (low := group[order[top - 1]]):
        pointed: dict[int, int] = {}
        for suffix in sorted(order[low:top]) if top - low > 1 else order[low:top]:
            at = suffix - 1
            while group[at] >= low:
                at = before[at]
            before[suffix] = at
            if at >= 0:
                pointed[at] = pointed.get(at, 0) + 1
        times = set(pointed.values())
        for count in sorted(times, reverse=True):
            back: dict[int, int] = {}  # per group, where its moved suffixes begin
            for s in pointed if len(times) == 1 else [s for s, c in pointed.items() if c == count]:
                old = group[s]
                to = back[old] = (back[old] if old in back else end[old]) - 1
                # Each one changes places with the last that is not moved yet.
                here, other = place[s], order[to]
                order[here], place[other] = other, here
                order[to], place[s] = s, to
            for old, new in back.items():
                if new != old:
                    stop = end[old]
                    for s in order[new:stop]:
                        group[s] = new
                    end[old], end[new] = new, stop
        top = low

    result, free_place, done = [0] * n, list(range(n + 1)), bytearray(n)
    result[0] = n - 1
    done[n - 1] = 1
    free_place[group[n - 1]] += 1
    for i in range(n):
        at = result[i] - 1
        while at >= 0 and not done[at]:
            own = group[at]
            result[free_place[own]] = at
            free_place[own] += 1
            done[at] = 1
            at = before[at]
    return result

"""Suffix array in linear time by grouping suffixes by their Lyndon prefixes.

First the suffixes are grouped by first symbol. Groups are taken from the highest down; each suffix
of a group finds the nearest suffix before it that is in a lower group (its previous smaller one),
and suffixes found k times leave their own group for a new one right above it, larger k higher.
What remains are the groups of equal longest Lyndon prefixes, in order. One pass over the growing
array then places, for each suffix, the chain of previous smaller suffixes that starts before it.
Nothing is renamed and nothing is solved recursively.
"""

from __future__ import annotations

from collections.abc import Sequence


def suffix_array(s: Sequence[int]) -> list[int]:
    """s ends with its only smallest symbol."""
    n = len(s)
    if not n:
        return []
    by_symbol: dict[int, list[int]] = {}
    for i, c in enumerate(s):
        by_symbol.setdefault(c, []).append(i)
    order: list[int] = []
    group, size = [0] * n, [0] * n
    for c in sorted(by_symbol):
        members = by_symbol[c]
        start = len(order)
        size[start] = len(members)
        for i in members:
            group[i] = start
        order += members
    place = [0] * n
    for at, i in enumerate(order):
        place[i] = at
    before = [-1] * n
    end = n - 1
    while end >= 0:
        last = order[end]
        start = group[last]
        if start == end:
            p = last - 1
            while p >= 0 and group[p] > start:
                p = before[p]
            before[last] = p
            if p >= 0:
                g = group[p]
                k = size[g]
                if k > 1:
                    tail, at = g + k - 1, place[p]
                    if at != tail:
                        other = order[tail]
                        order[at], order[tail], place[other], place[p] = other, p, at, tail
                    size[g], size[tail], group[p] = k - 1, 1, tail
        else:
            found: dict[int, int] = {}
            for i in sorted(order[start : end + 1]):
                p = i - 1
                while p >= 0 and group[p] > start:
                    p = before[p]
                if p >= 0 and group[p] == start:
                    p = before[p]
                before[i] = p
                if p >= 0:
                    found[p] = found.get(p, 0) + 1
            times: dict[int, list[int]] = {}
            for p, k in found.items():
                times.setdefault(k, []).append(p)
            for k in sorted(times, reverse=True):
                left: dict[int, list[int]] = {}
                for p in times[k]:
                    left.setdefault(group[p], []).append(p)
                for g, members in left.items():
                    tail = g + size[g]
                    for p in members:
                        tail -= 1
                        at = place[p]
                        if at != tail:
                            other = order[tail]
                            order[at], order[tail], place[other], place[p] = other, p, at, tail
                    size[g] -= len(members)
                    size[tail] = len(members)
                    for p in members:
                        group[p] = tail
        end = start - 1
    out = [-1] * n
    out[0] = n - 1
    free = list(range(n))
    placed = bytearray(n)
    placed[n - 1] = 1
    free[0] = 1
    for at in range(n):
        p = out[at] - 1
        while p >= 0 and not placed[p]:
            g = group[p]
            out[free[g]] = p
            free[g] += 1
            placed[p] = 1
            p = before[p]
    return out

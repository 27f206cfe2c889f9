"""Suffix arrays by linear grouping: suffixes are grouped by their Lyndon prefix, then each group's order is emitted.

Groups are ranges of one array. They are taken in descending order. For each suffix of a group the previous smaller
suffix is found by pointers; suffixes that are pointed to move into a new group directly above their old one, those with
more pointers higher. A group's suffixes then share their longest Lyndon prefix. At the end a pass over the array from
the left puts each suffix that ends before the one at hand first in what is left of its group, so nothing is renamed or
sorted again. Each pointer is followed once, so time and memory are linear.
"""

from __future__ import annotations


def suffix_array(symbols: list[int]) -> list[int]:
    """Starts of the suffixes in order. symbols: whole numbers of which the last is the only least one."""
    n = len(symbols)
    if not n:
        return []
    count = [0] * n  # suffixes of a group, at the group's first place
    size: dict[int, int] = {}
    for c in symbols:
        size[c] = size.get(c, 0) + 1
    first, at = {}, 0
    for c in sorted(size):
        first[c] = at
        at += size[c]
    group = [first[c] for c in symbols]
    order, place = [0] * n, [0] * n
    for i, g in enumerate(group):
        q = g + count[g]
        count[g] += 1
        order[q] = i
        place[i] = q
    before = [-1] * n  # the previous smaller suffix
    end = n
    while end:
        g = group[order[end - 1]]
        pointed: dict[int, int] = {}
        for i in sorted(order[g:end]) if end - g > 1 else order[g:end]:
            p = i - 1
            while p >= 0 and group[p] >= g:
                p = before[p]
            before[i] = p
            if p >= 0:
                pointed[p] = pointed.get(p, 0) + 1
        by_pointers: dict[int, list[int]] = {}
        for p, k in pointed.items():
            by_pointers.setdefault(k, []).append(p)
        for k in sorted(by_pointers, reverse=True):
            moving = by_pointers[k]
            for p in moving:  # to the end of its group's range
                old = group[p]
                left = count[old] = count[old] - 1
                q = old + left
                other, was = order[q], place[p]
                order[q], order[was] = p, other
                place[p], place[other] = q, was
            for p, q in zip(moving, [group[p] + count[group[p]] for p in moving], strict=True):
                group[p] = q
                count[q] += 1
        end = g
    out, slot = [0] * n, list(range(n))
    out[0] = n - 1
    group[n - 1] = -1
    for i in range(n):
        j = out[i] - 1
        while j >= 0 and (g := group[j]) >= 0:
            out[slot[g]] = j
            slot[g] += 1
            group[j] = -1
            j = before[j]
    return out

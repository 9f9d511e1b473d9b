"""Suffix arrays by linear grouping of suffixes.

Phase 1 groups suffixes by their longest Lyndon prefix: groups start as first symbols and are processed in descending
order. Each member of a group points to the nearest suffix on its left in a smaller group; a suffix that l members point
to is moved to a new group just above its own, its prefix grown by l times the processed group's. Phase 2 reads the order
off: suffixes of a group are ordered by what follows their prefix, so each suffix that is emitted lets the ones whose
prefix ends before it take the next place of their group. Nothing is renamed, and no reduced text is sorted.
"""

from __future__ import annotations


def suffix_array(text: list[int]) -> list[int]:
    """Starts of the suffixes of a list of positive integers, in order; the end counts as the smallest symbol."""
    text = [*text, 0]
    n = len(text)
    first: dict[int, list[int]] = {}
    for i, c in enumerate(text):
        first.setdefault(c, []).append(i)
    symbols = sorted(first)
    rank = {c: g for g, c in enumerate(symbols)}
    group = [rank[c] for c in text]
    members = [first[c] for c in symbols]
    length, done = [1] * len(symbols), [False] * len(symbols)
    lower, upper = list(range(-1, len(symbols) - 1)), [*range(1, len(symbols)), -1]
    prev = [-1] * n
    g = len(symbols) - 1
    while g >= 0:
        done[g] = True
        mine = sorted(i for i in members[g] if group[i] == g)
        members[g] = mine
        children: dict[int, int] = {}
        for s in mine:
            p = s - 1
            while p >= 0 and done[group[p]]:
                p = prev[p]
            prev[s] = p
            if p >= 0:
                children[p] = children.get(p, 0) + 1
        moved: dict[tuple[int, int], list[int]] = {}
        for p, k in children.items():
            moved.setdefault((k, group[p]), []).append(p)
        for (k, old), parents in sorted(moved.items(), reverse=True) if len(moved) > 1 else moved.items():
            new = len(members)  # just above the old group, below those with more children
            members.append(parents)
            length.append(length[old] + k * length[g])
            done.append(False)
            lower.append(old)
            upper.append(upper[old])
            lower[upper[old]] = new
            upper[old] = new
            for p in parents:
                group[p] = new
        g = lower[g]
    place, at, g = [0] * len(members), 0, 0
    while g >= 0:
        place[g] = at
        at += len(members[g])
        g = upper[g]
    order = [0] * n
    order[0], place[0] = n - 1, 1
    for i in range(n):
        j = order[i]
        s = j - 1
        while s >= 0 and s + length[group[s]] == j:
            g = group[s]
            order[place[g]] = s
            place[g] += 1
            s = prev[s]
    return order[1:]

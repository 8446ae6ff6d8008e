"""Suffix sorting by Lyndon groups: linear, and without renaming or recursion.

Every suffix has a longest prefix that is a Lyndon word; suffixes with the same one form a group. The first phase
finds the groups from the greatest to the least: a group's suffixes point to the nearest smaller suffix before them,
and those get their prefix longer by the group's word, once for each suffix that points to them. The second phase goes
through the groups upwards: what follows a suffix's Lyndon prefix is a smaller suffix, so its place in
the order is known by the time the suffix's group is reached.
"""

from __future__ import annotations

NONE = -1


def lyndon_groups(text: bytes) -> tuple[list[int], list[int], list[int]]:
    """Each suffix's group, each group's length of prefix, and the groups with suffixes in ascending order."""
    symbols = sorted(set(text))
    number = {c: g for g, c in enumerate(symbols)}
    group = [number[c] for c in text]
    members: list[list[int]] = [[] for _ in symbols]
    for i, g in enumerate(group):
        members[g].append(i)
    length = [1] * len(symbols)
    below, above = list(range(-1, len(symbols) - 1)), [*range(1, len(symbols)), NONE]
    previous = [NONE] * len(text)  # previous smaller suffix, once the group is finished
    finished, descending = [False] * len(symbols), []
    at = len(symbols) - 1
    while at != NONE:
        mine = [i for i in members[at] if group[i] == at]
        finished[at] = True
        if mine:
            descending.append(at)
        repeats: dict[int, int] = {}
        for i in mine:
            p = i - 1
            while p >= 0 and finished[group[p]]:
                p = previous[p]
            previous[i] = p
            if p >= 0:
                repeats[p] = repeats.get(p, 0) + 1
        moves: dict[tuple[int, int], list[int]] = {}
        for p, n in repeats.items():
            moves.setdefault((group[p], n), []).append(p)
        # Most repeats first: each new group comes right above the old one, below those made before.
        for old, n in sorted(moves, key=lambda m: -m[1]):
            new, next_ = len(members), above[old]
            mine = sorted(moves[old, n])
            members.append(mine)
            length.append(length[old] + n * length[at])
            finished.append(False)
            below.append(old)
            above.append(next_)
            above[old] = new
            if next_ != NONE:
                below[next_] = new
            for p in mine:
                group[p] = new
        at = below[at]
    return group, length, descending[::-1]


def suffix_order(text: bytes) -> list[int]:
    """Starts of the suffixes in ascending order."""
    n = len(text)
    group, length, ascending = lyndon_groups(text)
    ordered: dict[int, list[int]] = {g: [] for g in ascending}
    following: list[list[int]] = [[] for _ in range(n + 1)]  # suffixes by the one after their Lyndon prefix
    for i, g in enumerate(group):
        following[i + length[g]].append(i)
    for i in following[n]:
        ordered[group[i]].append(i)
    out = []
    for g in ascending:
        mine = ordered[g]  # grows while it is read: a repeated word follows itself
        for i in mine:
            out.append(i)
            for j in following[i]:
                ordered[group[j]].append(j)
    return out

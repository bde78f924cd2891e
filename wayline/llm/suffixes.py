"""Suffix sorting by Lyndon groups, in linear time and without recursion or renaming."""

from __future__ import annotations

from collections import defaultdict


def lyndon_groups(codes: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Groups of suffixes with equal longest Lyndon prefixes.

    Returns the group of every suffix, the position behind its Lyndon prefix (its next smaller suffix) and the
    groups from the largest to the smallest. Suffixes start in groups by their first code. Groups are processed
    in descending order. The previous smaller suffix of a member is its nearest neighbour to the left among
    suffixes that are not processed yet and belong to a lower group; that one's prefix grows by as many copies
    of the group's prefix as it has members behind it, so it moves to a group of its own just above its old one,
    more copies above fewer.
    """
    n = len(codes)
    values = sorted(set(codes))
    first = {code: g for g, code in enumerate(values)}
    group = [first[code] for code in codes]
    members: list[list[int]] = [[] for _ in values]
    for i, g in enumerate(group):
        members[g].append(i)
    below, above = [g - 1 for g in range(len(values))], [g + 1 for g in range(len(values))]
    if values:
        above[-1] = -1
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    parent, behind, order = [-1] * n, [n] * n, []
    g = len(values) - 1
    while g >= 0:
        now = sorted(i for i in members[g] if group[i] == g)
        copies: dict[int, int] = {}
        for i in now:
            behind[i] = right[i]
            p = left[i]
            if p >= 0 and group[p] == g:
                p = parent[p]
            parent[i] = p
            if p >= 0:
                copies[p] = copies.get(p, 0) + 1
        for i in now:
            p, r = left[i], right[i]
            if p >= 0:
                right[p] = r
            if r < n:
                left[r] = p
        moved = defaultdict(list)
        for p, k in copies.items():
            moved[group[p], k].append(p)
        for h, k in sorted(moved, reverse=True):  # fewer copies last, so nearest to h
            new = len(members)
            members.append(moved[h, k])
            for p in moved[h, k]:
                group[p] = new
            up = above[h]
            below.append(h)
            above.append(up)
            above[h] = new
            if up >= 0:
                below[up] = new
        order.append(g)
        g = below[g]
    return group, behind, order


def suffix_array(codes: list[int]) -> list[int]:
    """The starts of the suffixes of codes in order; a suffix that is a prefix of another comes first.

    Smaller suffixes are emitted first; each one places the suffixes whose Lyndon prefix ends where it starts at
    the next free place of their groups.
    """
    n = len(codes)
    group, behind, order = lyndon_groups(codes)
    size = [0] * (max(order, default=-1) + 1)
    for g in group:
        size[g] += 1
    free, total = [0] * len(size), 0
    for g in reversed(order):
        free[g] = total
        total += size[g]
    ending: list[list[int]] = [[] for _ in range(n + 1)]
    for i, end in enumerate(behind):
        ending[end].append(i)
    out = [0] * n

    def place(at: int) -> None:
        for i in ending[at]:
            out[free[group[i]]] = i
            free[group[i]] += 1

    place(n)
    for k in range(n):
        place(out[k])
    return out


def repeated_windows(strings: list[bytes], length: int) -> list[list[tuple[int, int]]]:
    """For every string, the ranges [first, behind last) of starts whose `length` bytes also start elsewhere."""
    codes, text, owner = [], bytearray(), []
    for k, string in enumerate(strings):
        text += string + b"\0"
        codes.extend(byte + 1 for byte in string)
        codes.append(0)
        last = len(string) - length
        owner.extend([k if i <= last else -1 for i in range(len(string))])
        owner.append(-1)
    text = bytes(text)
    starts = [i for i in suffix_array(codes) if owner[i] >= 0]
    found = set()
    for a, b in zip(starts, starts[1:], strict=False):
        if text[a : a + length] == text[b : b + length]:
            found.add(a)
            found.add(b)
    out: list[list[tuple[int, int]]] = [[] for _ in strings]
    base, bases = 0, []
    for string in strings:
        bases.append(base)
        base += len(string) + 1
    for i in sorted(found):
        ranges, at = out[owner[i]], i - bases[owner[i]]
        if ranges and ranges[-1][1] == at:
            ranges[-1] = (ranges[-1][0], at + 1)
        else:
            ranges.append((at, at + 1))
    return out

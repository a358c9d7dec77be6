"""Suffix array by linear grouping of suffixes, for one string of numbers in a task.

Phase one groups suffixes by their Lyndon prefixes. Groups begin as equal first numbers and are taken in descending
order. Each suffix of a group points to the nearest suffix before it that lies in a smaller group; a suffix pointed to
by k members has k copies of the group's prefix right after its own, so it moves, with others of its group and count,
to a new group behind those that are pointed to less often. Pointers skip what larger suffixes have already hidden,
so all of them together take linear time.

Phase two takes the suffixes in ascending order, the end mark first. When a suffix is known, those that it is the
next smaller suffix of follow from the pointers, and each takes the next place of its group. No part of the string is
renamed or sorted again.
"""
from __future__ import annotations


def suffix_array(text: list[int]) -> list[int]:
    """Order of the suffixes of ``text``, numbers of 0 or more; an end mark is taken to be less than all of them."""
    n = len(text) + 1
    # group by first number: places, members, and the first place of each suffix's group
    counts: dict[int, int] = {}
    for x in text:
        counts[x] = counts.get(x, 0) + 1
    start, at = {}, 1
    for x in sorted(counts):
        start[x] = at
        at += counts[x]
    group = [start[x] for x in text]
    group.append(0)
    member, place, free = [0] * n, [0] * n, dict(start)
    member[0], place[n - 1] = n - 1, 0
    for i, x in enumerate(text):
        k = free[x]
        free[x] = k + 1
        member[k], place[i] = i, k
    end = [0] * (n + 1)  # by a group's first place, the place behind its last one
    end[0] = 1
    for x, k in start.items():
        end[k] = k + counts[x]

    smaller = [-1] * n
    above = n
    while above > 1:
        low = group[member[above - 1]]
        times: dict[int, int] = {}
        if above - low == 1:
            own = (member[low],)
        else:
            own = sorted(member[low:above])
        for i in own:
            j = i - 1
            while j >= 0 and group[j] >= low:
                j = smaller[j]
            smaller[i] = j
            if j >= 0:
                times[j] = times.get(j, 0) + 1
        above = low
        if not times:
            continue
        most = max(times.values())
        if most == 1:
            rounds = (list(times),)
        else:
            by_count: dict[int, list[int]] = {}
            for j, k in times.items():
                by_count.setdefault(k, []).append(j)
            rounds = tuple(by_count[k] for k in sorted(by_count, reverse=True))
        for movers in rounds:
            # to the end of their groups; what is left of a group stays before them
            touched: dict[int, int] = {}
            for j in movers:
                g = group[j]
                last = touched.get(g)
                last = (end[g] if last is None else last) - 1
                touched[g] = last
                k = place[j]
                if k != last:
                    other = member[last]
                    member[k], place[other] = other, k
                    member[last], place[j] = j, last
            for g, first in touched.items():
                if first == g:
                    continue  # all of the group moves: it keeps its place
                stop = end[g]
                end[g], end[first] = first, stop
                for k in range(first, stop):
                    group[member[k]] = first

    out = [-1] * n
    out[0] = n - 1
    done = [False] * n
    done[n - 1] = True
    following = list(range(n))
    for k in range(n):
        j = out[k] - 1
        while j >= 0 and not done[j]:
            g = group[j]
            slot = following[g]
            following[g] = slot + 1
            out[slot] = j
            done[j] = True
            j = smaller[j]
    return out[1:]

"""Suffix arrays by linear grouping, for many short strings at a time.

The construction has two phases and no recursive renaming:

1. Suffixes start in groups by first symbol. Groups are taken in descending order. Every member
   points to the previous position with a smaller group; the suffixes pointed to are extended by the
   group's prefix, so they leave their group for a new one right above it (those that absorb more
   copies higher up). At the end a group holds the suffixes that share their longest Lyndon prefix,
   and groups are in lexicographic order.
2. Groups are taken in ascending order. When a suffix ``s`` is final, the suffixes whose Lyndon prefix
   ends right before ``s`` (found along the same pointers, from ``s - 1``) take the next free place of
   their groups.

Strings are independent. They advance in step, each with its own next group, so every numpy call
works on one group of every string.
"""

from __future__ import annotations

import numpy as np

from sunfleet.llm.kernels import ranges


def suffix_arrays(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sorted suffix positions of each string, in the places ``[start, end)`` of the string.

    ``symbols`` holds small non-negative integers; strings are adjacent and not empty, and every one
    ends with a symbol that is smaller than all its others.
    """
    n = len(symbols)
    base = int(symbols.max(initial=0)) + 1
    text = np.repeat(np.arange(len(starts)), ends - starts)
    key = text * base + symbols
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    fresh = np.r_[True, sorted_key[1:] != sorted_key[:-1]] if n else np.zeros(0, dtype=bool)
    heads = np.flatnonzero(fresh)
    place = np.empty(n, dtype=np.int64)
    place[order] = np.arange(n)
    group = np.empty(n + 1, dtype=np.int64)  # first place of a suffix's group
    group[order] = heads[np.cumsum(fresh) - 1]
    group[n] = -1
    limit = np.zeros(n + 1, dtype=np.int64)  # end of the group that starts here
    limit[heads] = np.r_[heads[1:], n]
    first = np.zeros(n + 1, dtype=bool)
    first[starts] = True
    before = np.full(n + 1, n, dtype=np.int64)  # previous position with a smaller group; n: none
    _group_by_lyndon_prefix(order, place, group, limit, first, before, starts, ends, n)
    return _place(group, limit, first, before, starts, ends, n)


def _group_by_lyndon_prefix(order, place, group, limit, first, before, starts, ends, n) -> None:
    done = np.zeros(n + 1, dtype=bool)
    moved = np.zeros(n + 1, dtype=bool)
    low, top = starts, ends.copy()
    while len(top):
        head = group[order[top - 1]]
        member = order[ranges(head, top - head)]
        to = np.where(first[member], n, member - 1)
        done[member] = True
        before[member] = to
        walk = np.flatnonzero(done[to])
        while len(walk):
            to[walk] = before[to[walk]]
            before[member[walk]] = to[walk]
            walk = walk[done[to[walk]]]
        to = np.sort(to)
        to = to[: np.searchsorted(to, n)]
        if len(to):
            new = np.flatnonzero(np.r_[True, to[1:] != to[:-1]])
            copies = np.diff(np.r_[new, len(to)])
            to = to[new]
            rank = group[to] * (int(copies.max()) + 1) + copies
            by = np.argsort(rank, kind="stable")
            to, rank, copies = to[by], rank[by], copies[by]
            old = group[to]
            run = np.flatnonzero(np.r_[True, old[1:] != old[:-1]])
            size = np.diff(np.r_[run, len(to)])
            tail = limit[old[run]] - size
            at = ranges(tail, size)
            # the moved suffixes take the end of their group, those that were there take their places
            moved[to] = True
            holes = place[to]
            holes = holes[holes < np.repeat(tail, size)]
            there = order[at]
            there = there[~moved[there]]
            moved[to] = False
            order[holes] = there
            place[there] = holes
            order[at] = to
            place[to] = at
            limit[old[run]] = tail
            split = np.flatnonzero(np.r_[True, rank[1:] != rank[:-1]])
            head_of = at[split]
            group[to] = np.repeat(head_of, np.diff(np.r_[split, len(to)]))
            limit[head_of] = at[np.r_[split[1:] - 1, len(to) - 1]] + 1
        go = head > low
        low, top = low[go], head[go]


def _place(group, limit, first, before, starts, ends, n) -> np.ndarray:
    out = np.full(n, -1, dtype=np.int64)
    free = np.arange(n + 1)  # next free place of the group that starts here
    placed = np.zeros(n + 1, dtype=bool)
    placed[n] = True
    out[starts] = ends - 1  # the smallest suffix is the last symbol, alone in its group
    free[starts] += 1
    placed[ends - 1] = True
    head, top = starts, ends
    while len(head):
        at, stop = head, limit[head]
        while True:
            # suffixes of the current groups that are in place and have not passed on yet
            size = free[head] - at
            source = out[ranges(at, size)]
            at = at + size
            if not len(source):
                break
            to = np.where(first[source], n, source - 1)
            found, by = [], []
            rank = np.flatnonzero(~placed[to])
            to = to[rank]
            own = np.repeat(head, size)[rank]
            while len(to):
                found.append(to)
                by.append(rank)
                # a suffix of the current group ends the chain: what lies before it is in place
                on = group[to] != own
                to, rank, own = before[to[on]], rank[on], own[on]
                on = ~placed[to]
                to, rank, own = to[on], rank[on], own[on]
            if found:
                to, rank = np.concatenate(found), np.concatenate(by)
                by_rank = np.argsort(rank, kind="stable")
                to = to[by_rank]
                once = np.sort(np.unique(to, return_index=True)[1])
                to = to[once]
                to = to[np.argsort(group[to], kind="stable")]
                into = group[to]
                run = np.flatnonzero(np.r_[True, into[1:] != into[:-1]])
                count = np.diff(np.r_[run, len(to)])
                out[ranges(free[into[run]], count)] = to
                free[into[run]] += count
                placed[to] = True
        go = stop < top
        head, top = stop[go], top[go]
    return out

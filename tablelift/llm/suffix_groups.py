"""Suffix arrays of many short texts at once, by linear grouping construction.

Phase one groups the suffixes of a text by their Lyndon prefix (the longest Lyndon word they begin
with), in order.  Groups start as the first symbols and are processed from the highest down.  For the
group with prefix u, every member's previous smaller suffix is the nearest position to its left
that is neither in the group nor in a higher one; a position p that is so pointed at by c members
is followed by u^c, so its prefix grows by c times u and it moves to a new group directly above
its old one, higher for larger c.  Phase two goes through the groups from the lowest up and emits
each one's order: a member's suffix is u followed by its next smaller suffix, which lies in a lower
group, whose order is known, or is the next member, in a run of u's.  Nothing is renamed or sorted
twice.

All texts of a batch go through both phases in step: round r takes the r-th group of every text, and
each operation of a round is one numpy call over the members of all these groups.  Positions that
are not yet processed form a linked list per text, which gives the pointers.
"""

from __future__ import annotations

import numpy as np


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (sizes[0] numbers), starts[1], ..."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def _lyndon_groups(symbols: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(order, group start per position, group end per group start, prefix length), all in global positions."""
    n = len(symbols)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.argsort(text * 512 + symbols, kind="stable")  # texts stay together, symbols ascend
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    sorted_symbols = symbols[order]
    begins = np.ones(n, bool)
    begins[1:] = (sorted_symbols[1:] != sorted_symbols[:-1]) | (text[order][1:] != text[order][:-1])
    first = np.flatnonzero(begins)
    group = np.empty(n, np.int64)  # of a position: where its group starts in `order`
    group[order] = np.repeat(first, np.diff(np.append(first, n)))
    end = np.zeros(n + 1, np.int64)  # of a group start: where the group ends
    end[first] = np.append(first[1:], n)
    length = np.ones(n, np.int64)
    left = np.arange(-1, n - 1)  # nearest unprocessed position to the left, or one before the text
    right = np.arange(1, n + 1)
    floor = bounds[text]  # a text's first position
    top = bounds[1:].copy()  # groups from here up are processed
    lowest = bounds[:-1]
    moved_flag = np.zeros(n, bool)
    live = np.flatnonzero(top > lowest)
    while len(live):
        start = group[order[top[live] - 1]]
        members = np.sort(order[_ranges(start, top[live] - start)])
        top[live] = start
        # Runs of members that are neighbours among the unprocessed positions share one pointer.
        head = np.ones(len(members), bool)
        head[1:] = (left[members[1:]] != members[:-1]) | (left[members[1:]] < floor[members[1:]])
        heads = np.flatnonzero(head)
        count = np.diff(np.append(heads, len(members)))
        before, after = left[members[heads]], right[members[np.append(heads[1:], len(members)) - 1]]
        inside = before >= floor[members[heads]]
        fits = after < n
        left[after[fits]] = before[fits]
        right[before[before >= 0]] = after[before >= 0]
        parent, count, unit = before[inside], count[inside], length[members[heads]][inside]
        if len(parent):
            length[parent] += count * unit
            old = group[parent]
            rank = np.lexsort((parent, count, old))
            parent, count, old = parent[rank], count[rank], old[rank]
            new_old = np.ones(len(old), bool)
            new_old[1:] = old[1:] != old[:-1]
            at = np.flatnonzero(new_old)
            size = np.diff(np.append(at, len(old)))
            stop = end[old[at]]
            target = _ranges(stop - size, size)  # the upper end of each old group
            # Whoever stands there and does not move changes places with someone who moves.
            moved_flag[parent] = True
            standing = order[target]
            stay = standing[~moved_flag[standing]]
            vacated = place[parent]
            vacated = vacated[vacated < np.repeat(stop - size, size)]
            moved_flag[parent] = False
            order[vacated] = stay
            place[stay] = vacated
            order[target] = parent
            place[parent] = target
            begin = new_old.copy()
            begin[1:] |= count[1:] != count[:-1]
            starts = np.flatnonzero(begin)
            new_start = target[starts]
            new_end = target[np.append(starts[1:], len(target)) - 1] + 1
            group[parent] = np.repeat(new_start, np.diff(np.append(starts, len(target))))
            end[old[at]] = stop - size  # first, as a group that moves whole begins where the old one did
            end[new_start] = new_end
        live = live[top[live] > lowest[live]]
    return order, group, end, length


def suffix_arrays(symbols: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The sorted suffixes of every text, as global positions; text i takes places bounds[i]..bounds[i+1]-1."""
    symbols, bounds = symbols.astype(np.int64), bounds.astype(np.int64)
    order, group, end, length = _lyndon_groups(symbols, bounds)
    n = len(symbols)
    text_end = np.repeat(bounds[1:], np.diff(bounds))
    rank = np.full(n + 1, -1, np.int64)  # of a suffix among its text's; the empty suffix is lowest
    result = np.empty(n, np.int64)
    bottom, highest = bounds[:-1].copy(), bounds[1:]
    live = np.flatnonzero(bottom < highest)
    while len(live):
        start = bottom[live]
        stop = end[group[order[start]]]
        members = np.sort(order[_ranges(start, stop - start)])
        bottom[live] = stop
        following = members + length[members]  # next smaller suffix
        last = np.ones(len(members), bool)  # of a run of equal prefixes
        last[:-1] = following[:-1] != members[1:]
        last[:-1] |= group[members[:-1]] != group[members[1:]]
        lasts = np.flatnonzero(last)
        run = np.searchsorted(lasts, np.arange(len(members)))
        repeats = lasts[run] - np.arange(len(members))
        tail = following[lasts]
        tail_rank = np.where(tail < text_end[members[lasts]], rank[np.minimum(tail, n)], -1)
        emitted = np.lexsort((tail_rank[run], repeats, group[members]))
        target = _ranges(start, stop - start)
        result[target] = members[emitted]
        rank[members[emitted]] = target
        live = live[bottom[live] < highest[live]]
    return result

"""Suffix arrays of many short texts at once, built by grouping suffixes with equal Lyndon prefixes.

The linear construction has two phases. In the first, suffixes are grouped by their first byte, and groups are taken from the largest
down. Each suffix of the group at hand points to the nearest suffix before it that lies in a lower group (its previous smaller one). Those pointed
at leave their group for new ones right above it: the longer ones of the same beginning, by the number of pointers. When all groups are done, suffixes share a
group if they share their Lyndon prefix. In the second phase the suffixes are taken in ascending order; the one before each, and what its pointers lead to, are the next ones of their groups. Nothing is renamed or sorted recursively.

Both phases go step by step, but texts are independent: all texts of a batch make their next step together, as numpy operations over the batch.
"""

from __future__ import annotations

import numpy as np


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[i], starts[i] + 1, ... for lengths[i] places, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


def lyndon_groups(text: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(group, before) of every suffix: its group's first place in the order, and the previous smaller suffix.

    ``text`` holds texts one after the other, beginning at ``starts``, each ended by a symbol of its own lowest value. Groups
    and places count through the whole array; a suffix without a smaller one before it points to len(text).
    """
    n = len(text)
    lengths = np.diff(np.append(starts, n))
    owner = np.repeat(np.arange(len(starts)), lengths)
    order = np.lexsort((text, owner))
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    edge = np.ones(n, bool)
    edge[1:] = (text[order][1:] != text[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    first = np.flatnonzero(edge)
    end = np.zeros(n + 1, np.int64)  # by first place of a group: where it ends
    end[first] = np.append(first[1:], n)
    group = np.empty(n + 1, np.int64)
    group[order] = np.repeat(first, np.diff(np.append(first, n)))
    group[n] = -1
    before = np.arange(-1, n + 1)[: n + 1]
    before[starts] = n
    before[n] = n
    moving = np.zeros(n + 1, bool)
    low, top = starts.astype(np.int64), starts + lengths  # of each text: where its places begin, and where the groups not yet taken end
    while len(top):
        at = group[order[top - 1]]
        suffixes = order[_ranges(at, top - at)]
        own = np.repeat(at, top - at)
        smaller = before[suffixes]
        left = np.flatnonzero(group[smaller] >= own)
        while len(left):  # through suffixes of this group or higher ones
            smaller[left] = before[smaller[left]]
            left = left[group[smaller[left]] >= own[left]]
        before[suffixes] = smaller
        top = at
        going = top > low
        low, top = low[going], top[going]

        smaller = np.sort(smaller[smaller < n])
        if not len(smaller):
            continue
        new = np.ones(len(smaller), bool)
        new[1:] = smaller[1:] != smaller[:-1]
        pointed = smaller[new]
        times = np.diff(np.append(np.flatnonzero(new), len(smaller)))
        old = group[pointed]
        by = np.lexsort((times, old))
        pointed, times, old = pointed[by], times[by], old[by]
        new = np.ones(len(old), bool)
        new[1:] = old[1:] != old[:-1]
        begin = np.flatnonzero(new)
        size = np.diff(np.append(begin, len(old)))
        stop = end[old[begin]] - size  # they take the last places of their group, those pointed at most often at its end
        target = _ranges(stop, size)
        vacated = place[pointed]
        vacated = vacated[vacated < np.repeat(stop, size)]
        moving[pointed] = True
        there = order[target]
        there = there[~moving[there]]
        moving[pointed] = False
        order[vacated] = there
        place[there] = vacated
        order[target] = pointed
        place[pointed] = target
        end[old[begin]] = stop
        new[1:] |= times[1:] != times[:-1]
        begin = np.flatnonzero(new)
        size = np.diff(np.append(begin, len(old)))
        group[pointed] = np.repeat(target[begin], size)
        end[target[begin]] = target[begin] + size
    return group[:n], before[:n]


def suffix_arrays(text: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The suffixes of every text in ascending order, at the text's own places of one array. See ``lyndon_groups``."""
    n = len(text)
    group, before = lyndon_groups(text, starts)
    out = np.full(n, -1, np.int64)
    stops = np.append(starts[1:], n).astype(np.int64)
    out[starts] = stops - 1  # the closing symbol
    free = np.arange(n + 1)  # by first place of a group: its next free place
    placed = np.zeros(n + 1, bool)
    placed[stops - 1] = True
    placed[n] = True
    at = starts.astype(np.int64)  # each text's place in the order
    now = np.where(stops - 1 > at, stops - 2, n)
    first = at.copy()
    while len(at):
        done = placed[now]
        put = now[~done]
        g = group[put]
        out[free[g]] = put
        free[g] += 1
        placed[put] = True
        # where nothing is to be put, on to the next place: the suffix one symbol longer; else on along the pointer
        at += done
        over = at >= stops
        if over.any():
            keep = ~over
            at, stops, first, now, done = at[keep], stops[keep], first[keep], now[keep], done[keep]
        s = np.where(done, out[at] - 1, n)
        s[done & (s < first)] = n
        s[~done] = before[now[~done]]
        now = s
    return out

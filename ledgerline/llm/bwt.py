"""Repeated strings in one shard of text, by interval expansion on its Burrows-Wheeler transform (operator 5).

The shard is a list of separate byte strings; matches never cross them.  Its
suffixes are sorted by their first ``depth`` bytes, which fixes the interval of
every string up to that length.  Intervals are then extended breadth first, one
byte to the left in a step.  When the interval of a string one byte longer than
the step's strings ends at a place whose common prefix is not yet known, that
common prefix has the step's length: values appear in increasing order, each
place is settled once, and its interval is extended further.  Expansion stops at
the minimum length; places still unknown there have at least that much in common.
"""

from __future__ import annotations

import numpy as np


def suffix_order(text: np.ndarray, ends: np.ndarray, depth: int) -> np.ndarray:
    """Places of ``text`` sorted by their next ``depth`` symbols; ties by place.

    ``ends[i]`` is the place of the separator that closes the string of place i
    (separators are 0, all others are greater; nothing is compared beyond one).
    """
    n = len(text)
    room = np.minimum(ends - np.arange(n), 8).astype(np.uint64)
    packed = np.zeros(n, np.uint64)
    padded = np.concatenate([text.astype(np.uint64), np.zeros(8, np.uint64)])
    for i in range(7):
        packed = (packed << np.uint64(9)) | np.where(room > i, padded[i:i + n], 0)
    order = np.argsort(packed, kind="stable")
    rank = np.empty(n, np.int64)
    first = np.concatenate(([True], packed[order][1:] != packed[order][:-1]))
    rank[order] = np.flatnonzero(first)[np.cumsum(first) - 1]
    open_ = _tied(first, n)
    step = 7
    while step < depth and open_.any():
        places = np.flatnonzero(open_)  # slots of the order that still have equals
        who = order[places]
        nxt = who + step
        follow = np.where(nxt <= ends[who], rank[np.minimum(nxt, n - 1)] + 1, 0)
        follow[text[who] == 0] = 0
        both = rank[who] * (n + 1) + follow
        by = np.argsort(both, kind="stable")  # equals keep their places' order
        who, both = who[by], both[by]
        order[places] = who
        new = np.concatenate(([True], both[1:] != both[:-1]))
        rank[who] = places[np.flatnonzero(new)][np.cumsum(new) - 1]
        open_[:] = False
        open_[places[_tied(new, len(new))]] = True
        step *= 2
    return order


def _tied(first: np.ndarray, n: int) -> np.ndarray:
    """Which slots share their group with another slot."""
    alone = first.copy()
    alone[:-1] &= first[1:]
    return ~alone


def repeated_starts(strings: list[bytes], length: int) -> list[np.ndarray]:
    """For each string, the starts of its ``length``-byte substrings that also start somewhere else in the list."""
    sizes = np.array([len(s) for s in strings], np.int64)
    text = np.zeros(int((sizes + 1).sum()), np.int16)
    ends = np.empty(len(text), np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes + 1)[:-1])).astype(np.int64)
    for s, at in zip(strings, starts):
        text[at:at + len(s)] = np.frombuffer(s, np.uint8).astype(np.int16) + 1
        ends[at:at + len(s) + 1] = at + len(s)
    n = len(text)
    if not n:
        return [np.empty(0, np.int64) for _ in strings]
    order = suffix_order(text, ends, length).astype(np.int64)
    unknown = _expand(text[order - 1], text[order], n, length)
    # a suffix repeats when it shares `length` symbols with a neighbour in the order
    repeated = np.zeros(n, bool)
    same = unknown[1:n]
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    return [np.flatnonzero(repeated[at:at + max(0, int(k) - length + 1)]) for at, k in zip(starts, sizes)]


def _expand(before: np.ndarray, heads: np.ndarray, n: int, length: int) -> np.ndarray:
    """Whether the common prefix of slots i - 1 and i is at least ``length`` (slots 0 and n are edges)."""
    by_symbol = np.argsort(before, kind="stable")
    back = np.empty(n, np.int64)  # slot of the suffix that is one symbol longer to the left
    back[by_symbol] = np.arange(n)
    same = before[by_symbol][1:] == before[by_symbol][:-1]
    earlier, later = np.full(n, -1, np.int64), np.full(n, n, np.int64)  # the same symbol's last and next slot
    earlier[by_symbol[1:][same]] = by_symbol[:-1][same]
    later[by_symbol[:-1][same]] = by_symbol[1:][same]
    unknown = np.ones(n + 1, bool)
    unknown[0] = unknown[n] = False
    # strings of one symbol; every separator counts as a symbol of its own
    edge = np.concatenate(([0], np.flatnonzero((heads[1:] != heads[:-1]) | (heads[1:] == 0)) + 1))
    low, high = edge, np.concatenate((edge[1:], [n])) - 1
    fresh = unknown[high + 1]
    unknown[high + 1] = False
    low, high = low[fresh | (high + 1 == n)], high[fresh | (high + 1 == n)]
    for _ in range(1, length):
        if not len(low):
            break
        width = high - low + 1
        alone = width == 1
        one = low[alone]
        one = back[one[before[one] > 0]]
        wide_low, wide_high, width = low[~alone], high[~alone], width[~alone]
        if len(wide_low):
            owner = np.repeat(np.arange(len(wide_low)), width)
            slot = np.arange(int(width.sum())) - np.repeat(np.cumsum(width) - width, width) + wide_low[owner]
            real = before[slot] > 0
            starts = back[slot[real & (earlier[slot] < wide_low[owner])]]
            stops = back[slot[real & (later[slot] > wide_high[owner])]]
            # intervals of different strings of one length are disjoint, so both ends sort alike
            low = np.concatenate((one, np.sort(starts)))
            high = np.concatenate((one, np.sort(stops)))
        else:
            low = high = one
        fresh = unknown[high + 1]
        unknown[high + 1] = False
        last = high + 1 == n
        low, high = low[fresh | last], high[fresh | last]
    return unknown

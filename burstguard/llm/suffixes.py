"""Suffix arrays by induced sorting, and permuted common prefixes, in whole-array operations.

Induction places suffixes in order of the array itself. As long as the entries up to some slot are known, all their
predecessors can be placed at once; so a pass goes from one unknown slot to the next in batches, and the text's
alphabet may be of any size, as the recursion on names needs.
"""

from __future__ import annotations

import numpy as np


def suffix_types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one. The last symbol must be the only smallest one."""
    n = len(text)
    rising = text[:-1] < text[1:]
    decides = np.append(text[:-1] != text[1:], True)
    # the nearest position from i on whose comparison decides
    nearest = np.minimum.accumulate(np.where(decides, np.arange(n), n)[::-1])[::-1]
    return np.append(rising, True)[nearest]


def _place(heads: np.ndarray, symbols: np.ndarray, step: int) -> np.ndarray:
    """Slots for entries of these symbols in their order; ``heads`` move on by ``step`` each."""
    order = np.argsort(symbols, kind="stable")
    ordered = symbols[order]
    first = np.flatnonzero(np.diff(ordered, prepend=-1))
    counts = np.diff(np.append(first, len(ordered)))
    within = np.arange(len(ordered)) - np.repeat(first, counts)
    slots = np.empty(len(symbols), np.int64)
    slots[order] = heads[ordered] + step * within
    heads[ordered[first]] += step * counts
    return slots


def _induce(text: np.ndarray, smaller: np.ndarray, lms: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The array induced by leftmost-smaller suffixes ``lms`` in the given order."""
    n = len(text)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    large_ends = starts + np.bincount(text[~smaller], minlength=len(sizes))
    sa = np.full(n, -1, np.int64)
    tails = ends - 1
    sa[_place(tails, text[lms[::-1]], -1)] = lms[::-1]
    heads, at, bucket = starts.copy(), 0, 0
    while at < n:  # larger suffixes, from the left
        open_ = heads[bucket:] < large_ends[bucket:]
        first = int(open_.argmax())
        if open_[first]:
            bucket += first
            stop = max(int(heads[bucket]), at)
        else:
            stop = n
        known = sa[at:stop]
        before = known[known > 0] - 1
        before = before[~smaller[before]]
        if len(before):
            sa[_place(heads, text[before], 1)] = before
        at = stop
    # smaller suffixes, from the right: they take all slots behind the larger ones anew
    inside = np.arange(n) >= np.repeat(large_ends, sizes)
    sa[inside] = -1
    sa[0] = n - 1
    tails, at, bucket = ends - 1, n, len(sizes) - 1
    tails[text[n - 1]] -= 1
    while at > 0:
        open_ = tails[bucket::-1] >= large_ends[bucket::-1]
        first = int(open_.argmax())
        if open_[first]:
            bucket -= first
            stop = min(int(tails[bucket]) + 1, at)
        else:
            stop = 0
        known = sa[stop:at][::-1]
        before = known[known > 0] - 1
        before = before[smaller[before]]
        if len(before):
            sa[_place(tails, text[before], -1)] = before
        at = stop
    return sa


def _same_substrings(text: np.ndarray, left: np.ndarray, right: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether the substrings at ``left`` and ``right`` are equal over their common ``lengths``."""
    same = np.ones(len(left), bool)
    active = np.arange(len(left))
    offset = 0
    while len(active):
        equal = text[left[active] + offset] == text[right[active] + offset]
        same[active[~equal]] = False
        offset += 1
        active = active[equal & (lengths[active] > offset)]
    return same


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes in order. ``text``: integers from 0 on, with one 0, at the end."""
    n = len(text)
    if n == 1:
        return np.zeros(1, np.int64)
    sizes = np.bincount(text)
    smaller = suffix_types(text)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    sa = _induce(text, smaller, lms, sizes)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    ordered = sa[is_lms[sa]]
    # names of the leftmost-smaller substrings, each up to and with the next one's start
    length = np.zeros(n, np.int64)
    length[lms] = np.append(np.diff(lms) + 1, 1)
    a, b = ordered[:-1], ordered[1:]
    new = length[a] != length[b]
    check = np.flatnonzero(~new)
    new[check] = ~_same_substrings(text, a[check], b[check], length[a[check]])
    names = np.zeros(n, np.int64)
    names[ordered] = np.concatenate([[0], np.cumsum(new)])
    reduced = names[lms]
    if reduced.max() + 1 < len(reduced):
        ordered = lms[suffix_array(reduced)]
        return _induce(text, smaller, ordered, sizes)
    order = np.empty(len(lms), np.int64)
    order[reduced] = lms
    return _induce(text, smaller, order, sizes)


def permuted_prefixes(text: np.ndarray, sa: np.ndarray, starts: np.ndarray, cap: int) -> np.ndarray:
    """For each position, the length of the prefix it shares with the suffix before it in the array.

    Where the symbols before both suffixes agree, the value is one less than at the position before; so only the other
    positions, and the segment ``starts``, are compared. Values count up to ``cap`` from there.
    """
    n = len(text)
    previous = np.full(n, -1, np.int64)
    previous[sa[1:]] = sa[:-1]
    here = np.arange(n)
    reducible = np.zeros(n, bool)
    both = (here > 0) & (previous > 0)
    reducible[both] = text[here[both] - 1] == text[previous[both] - 1]
    reducible[starts] = False
    reducible[sa[0]] = False
    reducible &= previous >= 0
    found = np.flatnonzero(~reducible & (previous >= 0))
    lcp = np.zeros(n, np.int64)
    active, offset = found, 0
    last = n - 1
    while len(active) and offset < cap:
        a, b = active + offset, previous[active] + offset
        inside = (a <= last) & (b <= last)
        active, a, b = active[inside], a[inside], b[inside]
        equal = text[a] == text[b]
        active = active[equal]
        offset += 1
        lcp[active] = offset
    base = np.maximum.accumulate(np.where(reducible, -1, here))
    return np.maximum(np.where(reducible, lcp[base] - (here - base), lcp), 0)


def repeated_starts(segments: list[bytes], length: int) -> list[np.ndarray]:
    """For each segment, a mask of the starts whose ``length`` bytes also start elsewhere in the segments."""
    sizes = np.array([len(s) for s in segments], np.int64)
    joined = b"".join(segments)
    total = len(joined) + len(segments) + 1
    text = np.ones(total, np.int64)  # 1 stands behind each segment, 0 at the end
    begin = np.cumsum(sizes + 1) - sizes - 1
    where = np.arange(len(joined)) + np.repeat(np.arange(len(segments)), sizes)
    text[where] = np.frombuffer(joined, np.uint8).astype(np.int64) + 2
    text[-1] = 0
    sa = suffix_array(text)
    shared = permuted_prefixes(text, sa, begin, int(sizes.max()) + 1)
    left = np.zeros(total, np.int64)  # bytes up to the end of the own segment
    left[where] = np.repeat(begin + sizes, sizes) - where
    previous = np.full(total, -1, np.int64)
    previous[sa[1:]] = sa[:-1]
    hit = np.flatnonzero((shared >= length) & (left >= length))
    hit = hit[left[previous[hit]] >= length]
    mark = np.zeros(total, bool)
    mark[hit] = True
    mark[previous[hit]] = True
    return [mark[a : a + max(0, s - length + 1)] for a, s in zip(begin.tolist(), sizes.tolist())]

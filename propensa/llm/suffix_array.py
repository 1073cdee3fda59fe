"""Suffix arrays by induced sorting, in numpy.

Suffixes are classified as S (smaller than the next one) or L.  The leftmost
S of each run marks a substring; these substrings are sorted by inducing,
named by rank, and the string of names is sorted recursively.  From the order
of the marked suffixes two inducing passes place all others in linear time.

A pass visits buckets (first symbols) in order and handles a whole bucket at
once, so that numpy does the work: what a bucket induces into itself is found
in rounds, what it induces into later buckets is dealt out by a stable sort.
A string of many names is written with two digits a name, which keeps the
number of buckets small at each level.
"""

from __future__ import annotations

import numpy as np

#: Most names that are used as symbols directly; more take two digits.
DIRECT = 1 << 11


def suffix_array(text: np.ndarray, size: int | None = None) -> np.ndarray:
    """Start positions of all suffixes of ``text`` (integers >= 0, below
    ``size``) in ascending order; an end is smaller than any symbol."""
    text = np.asarray(text)
    n = len(text)
    size = int(text.max()) + 1 if size is None and n else (size or 1)
    # 32-bit places: a shard is far below 2 ** 31 symbols
    text = text.astype(np.uint8 if size <= 1 << 8 else np.uint16 if size <= 1 << 16 else np.int64)
    if n <= 1:
        return np.arange(n)
    smaller = s_types(text)
    marks = (np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1).astype(np.int32)
    if len(marks) > 1:
        ordered = induce(text, size, smaller, marks)
        is_mark = np.zeros(n, bool)
        is_mark[marks] = True
        ordered = ordered[is_mark[ordered]]
        names, count = named(text, marks, ordered)
        marks = marks[order_of_names(names, count, n)]
    return induce(text, size, smaller, marks)


def s_types(text: np.ndarray) -> np.ndarray:
    """For each suffix, whether it is smaller than the one after it."""
    n = len(text)
    rises = np.zeros(n, np.int8)
    rises[:-1][text[:-1] < text[1:]] = 1
    rises[:-1][text[:-1] > text[1:]] = -1
    rises[-1] = -1
    # equal neighbours share the type of the next change
    place = np.where(rises != 0, np.arange(n, dtype=np.int32), np.int32(n - 1))
    following = np.minimum.accumulate(place[::-1])[::-1]
    return rises[following] > 0


def named(text: np.ndarray, marks: np.ndarray, ordered: np.ndarray) -> tuple[np.ndarray, int]:
    """Ranks of the marked substrings in text order; how many differ."""
    n, m = len(text), len(marks)
    end = np.append(marks[1:] + 1, n)        # a substring includes the next mark
    length = np.empty(n, np.int32)
    length[marks] = end - marks
    a, b = ordered[:-1], ordered[1:]
    # the last one ends with the text, so it equals no other
    same = (length[a] == length[b]) & (a != marks[-1]) & (b != marks[-1])
    todo = np.flatnonzero(same)
    step, at = np.arange(8), 0
    while len(todo):
        place = np.minimum(at + step, (length[a[todo]] - 1)[:, None])
        equal = (text[a[todo][:, None] + place] == text[b[todo][:, None] + place]).all(axis=1)
        same[todo[~equal]] = False
        at += 8
        todo = todo[equal]
        todo = todo[length[a[todo]] > at]
    rank = np.empty(n, np.int32)
    rank[ordered] = np.concatenate([[0], np.cumsum(~same)])
    names = rank[marks]
    return names, int(names.max()) + 1 if m else 0


def order_of_names(names: np.ndarray, count: int, n: int) -> np.ndarray:
    """Suffix array of the string of names."""
    if count == len(names):
        order = np.empty(count, np.int32)
        order[names] = np.arange(count, dtype=np.int32)
        return order
    if count <= DIRECT or 2 * len(names) >= n:
        return suffix_array(names, count)
    base = int(np.ceil(np.sqrt(count)))
    digits = np.empty(2 * len(names), np.int32)
    digits[0::2], digits[1::2] = names // base, names % base
    order = suffix_array(digits, base)
    return order[order % 2 == 0] // 2


def induce(text: np.ndarray, size: int, smaller: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """All suffixes in order, given the marked ones in theirs."""
    n = len(text)
    total = np.bincount(text, minlength=size)
    ends = np.cumsum(total)
    heads = ends - total
    n_s = np.bincount(text[smaller], minlength=size)
    tails = ends - n_s                       # first S place of each bucket
    array = np.empty(n, np.int32)
    # marks by bucket, in their order
    symbol = text[marks]
    by_symbol = marks[np.argsort(symbol, kind="stable")]
    mark_ends = np.cumsum(np.bincount(symbol, minlength=size))

    def deal(target: np.ndarray, fill: np.ndarray, sign: int) -> None:
        """Append suffixes to their buckets, upwards or downwards from ``fill``."""
        symbols = text[target]
        order = np.argsort(symbols, kind="stable")
        symbols = symbols[order]
        first = np.flatnonzero(np.concatenate([[True], symbols[1:] != symbols[:-1]]))
        counts = np.diff(np.append(first, len(symbols)))
        rank = np.arange(len(symbols)) - np.repeat(first, counts)
        array[fill[symbols] + sign * rank] = target[order]
        fill[symbols[first]] += sign * counts

    # L suffixes, buckets upwards; the end induces the last one
    fill = heads.copy()
    array[fill[text[-1]]] = n - 1
    fill[text[-1]] += 1
    for c in np.flatnonzero(total):
        low, done = heads[c], heads[c]
        while done < fill[c]:
            before = array[done:fill[c]] - 1
            done = fill[c]
            before = before[before >= 0]
            own = before[text[before] == c]
            array[done:done + len(own)] = own
            fill[c] += len(own)
        before = array[low:fill[c]] - 1
        before = before[before >= 0]
        before = before[text[before] > c]
        own_marks = by_symbol[mark_ends[c - 1] if c else 0:mark_ends[c]]
        before = np.concatenate([before, own_marks - 1])
        if len(before):
            deal(before, fill, 1)
    # S suffixes, buckets downwards
    fill = ends - 1
    for c in np.flatnonzero(total)[::-1]:
        high, done = ends[c] - 1, ends[c] - 1
        while done > fill[c]:
            before = array[fill[c] + 1:done + 1][::-1] - 1
            done = fill[c]
            before = before[before >= 0]
            own = before[text[before] == c]
            array[done - len(own) + 1:done + 1] = own[::-1]
            fill[c] -= len(own)
        before = np.concatenate([array[tails[c]:high + 1][::-1], array[heads[c]:tails[c]][::-1]]) - 1
        before = before[before >= 0]
        before = before[text[before] < c]
        if len(before):
            deal(before, fill, -1)
    return array


def permuted_lcp(text: np.ndarray, array: np.ndarray) -> np.ndarray:
    """For each position, how many symbols its suffix shares with the one
    before it in ``array``.  Only positions whose preceding symbols differ are
    compared; each other value is one less than that of the position before.
    """
    n = len(text)
    phi = np.full(n, -1, np.int32)
    phi[array[1:]] = array[:-1]
    before = np.maximum(phi - 1, 0)
    place = np.arange(n, dtype=np.int32)
    carried = (phi > 0) & (place > 0)
    carried &= text[np.maximum(place - 1, 0)] == text[before]
    start = np.flatnonzero(~carried)
    other = phi[start]
    found = np.zeros(len(start), np.int64)
    todo = np.flatnonzero(other >= 0)
    padded = np.concatenate([text, np.zeros(8, text.dtype)])
    step, at = np.arange(8), 0
    while len(todo):
        a, b = start[todo] + at, other[todo] + at
        equal = padded[a[:, None] + step] == padded[b[:, None] + step]
        # positions beyond the end are told apart by where they are
        inside = (np.maximum(a, b)[:, None] + step) < n
        run = np.cumprod(equal & inside, axis=1).sum(axis=1)
        found[todo] += run
        todo = todo[run == 8]
        at += 8
    last = np.maximum.accumulate(np.where(~carried, place, 0))
    value = np.zeros(n, np.int32)
    value[start] = found
    return np.maximum(value[last] - (place - last), 0)

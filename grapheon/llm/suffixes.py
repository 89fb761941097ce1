"""Suffix arrays by induced sorting, in array steps, and permuted common prefixes.

Suffixes are of type S (smaller than the next one) or L (larger). The leftmost S suffixes (LMS) are sorted by their
substrings up to the next one: put into buckets by first symbol, then L suffixes are induced from left to right and S suffixes
from right to left. Equal substrings get one name; if names repeat, the string of names is sorted in turn: by this function again while it has few
names, else by doubling ranks, for a pass over buckets costs a step for each symbol. (Names as two digits each, sorted by this function whatever their number, give the
same at 1.8 times the cost.) The sorted LMS suffixes then induce the order of all. A bucket's suffixes are taken in waves: all that are there, then those that these
put into the same bucket.
"""

from __future__ import annotations

import numpy as np


def _types(s: np.ndarray) -> np.ndarray:
    """True for S. The last symbol is the unique least one and S."""
    n = len(s)
    change = np.flatnonzero(s[1:] != s[:-1])
    ends = np.append(change, n - 1)  # last place of each run
    up = np.append(s[change + 1] > s[change], True)
    return np.repeat(up, np.diff(np.append(-1, ends)))


def _induce(s: np.ndarray, small: np.ndarray, lms: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Suffixes in order, induced from LMS suffixes that are in order within their buckets."""
    n = len(s)
    tails = np.cumsum(sizes)
    heads = tails - sizes
    sa = np.empty(n, lms.dtype)
    symbols = np.flatnonzero(sizes)
    first = s[lms]
    order = np.argsort(first, kind="stable")
    seeds = lms[order]
    seed_ends = np.searchsorted(first[order], np.arange(len(sizes) + 1))
    fill = heads.copy()

    def push(now: np.ndarray, want_small: bool, at: np.ndarray, step: int) -> None:
        j = now - 1
        if want_small:
            j = j[small[j] & (j >= 0)]
        else:
            j = j[~(small[j] | (j < 0))]
        if not len(j):
            return
        c = s[j]
        by = np.argsort(c, kind="stable")
        j, c = j[by], c[by]
        count = np.bincount(c, minlength=len(sizes))
        to = at - (np.cumsum(count) - count) if step > 0 else at - 1 + (np.cumsum(count) - count)
        place = np.arange(len(c))
        if step > 0:
            sa[to[c] + place] = j
            at += count
        else:
            sa[to[c] - place] = j
            at -= count

    for c in symbols:
        i = heads[c]
        while i < fill[c]:
            now = sa[i : fill[c]].copy()
            i = fill[c]
            push(now, False, fill, 1)
        if seed_ends[c] < seed_ends[c + 1]:
            push(seeds[seed_ends[c] : seed_ends[c + 1]], False, fill, 1)
    back = tails.copy()
    sa[0] = n - 1  # the sentinel is its own bucket
    back[s[n - 1]] = 0
    for c in symbols[::-1]:
        i = tails[c]
        if c == s[n - 1]:
            push(sa[:1].copy(), True, back, -1)
            continue
        while i > back[c]:
            now = sa[back[c] : i][::-1].copy()
            i = back[c]
            push(now, True, back, -1)
        if heads[c] < fill[c]:
            push(sa[heads[c] : fill[c]][::-1].copy(), True, back, -1)
    return sa


def _by_doubling(names: np.ndarray) -> np.ndarray:
    n = len(names)
    rank = names.astype(np.int64) + 1
    k = 1
    while True:
        other = np.zeros(n, np.int64)
        other[: n - k] = rank[k:] if k < n else 0
        key = rank * (n + 1) + other
        order = np.argsort(key)  # equal keys keep any order until they differ
        rise = np.append(True, key[order][1:] != key[order][:-1])
        if rise.all():
            return order
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(rise)
        k *= 2


def suffix_array(s: np.ndarray, few: int = 512) -> np.ndarray:
    """Suffix array of s, whose symbols are 0 or more and whose last one is the only 0."""
    n = len(s)
    if n < 2:
        return np.zeros(n, np.int64)
    s = s.astype(np.min_scalar_type(int(s.max())))  # symbols of one or two bytes are sorted by counting
    small = _types(s)
    lms = (np.flatnonzero(small[1:] & ~small[:-1]) + 1).astype(np.int32 if n < 1 << 31 else np.int64)
    sizes = np.bincount(s)
    sa = _induce(s, small, lms, sizes)
    # names of LMS substrings, in their order
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    ordered = sa[is_lms[sa]]
    follow = np.zeros(n, np.int64)
    follow[lms] = np.append(lms[1:], n - 1)
    a, b = ordered[:-1], ordered[1:]
    length = follow[b] - b
    same = (follow[a] - a) == length
    live, at = np.flatnonzero(same), 0
    while len(live):
        differ = (s[a[live] + at] != s[b[live] + at]) | (small[a[live] + at] != small[b[live] + at])
        same[live[differ]] = False
        at += 1
        live = live[~differ]
        live = live[length[live] >= at]
    names = np.zeros(n, np.int64)
    names[ordered] = np.cumsum(np.append(0, ~same))
    reduced = names[lms]
    top = int(reduced.max())
    if top + 1 == len(lms):
        order = np.argsort(reduced, kind="stable")
    elif top < few:
        order = suffix_array(reduced, few)  # the last LMS suffix is the sentinel, the only 0
    else:
        order = _by_doubling(reduced)
    return _induce(s, small, lms[order], sizes)


def permuted_prefixes(s: np.ndarray, sa: np.ndarray, most: int) -> np.ndarray:
    """For each suffix, in the order of the text: symbols that it shares with the suffix before it in sa, `most` at most.

    A suffix shares at least as much as one that starts d symbols earlier, less d. So every 64th suffix is compared from its start, then those halfway between
    from what the one before leaves, and so on; what is compared adds up to a multiple of the text. Symbols take a byte, and eight are compared at a time.
    """
    n = len(s)
    ends = np.zeros(n + most + 16, np.uint8)  # past the end nothing agrees with a symbol but another end, and ends aren't aligned
    ends[:n] = s
    word = np.zeros(n + most + 8, np.uint64)
    for k in range(8):
        word |= ends[k : len(word) + k].astype(np.uint64) << np.uint64(8 * k)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    out = np.zeros(n, np.int64)

    def grow(a: np.ndarray, at: np.ndarray) -> None:
        b = before[a]
        a, b, at = a[b >= 0], b[b >= 0], at[b >= 0]
        while len(a):
            differ = word[a + at] ^ word[b + at]
            no = np.flatnonzero(differ)
            low = differ[no]
            low &= ~low + np.uint64(1)  # the lowest bit that differs
            out[a[no]] = at[no] + ((np.frexp(low.astype(np.float64))[1] - 1) >> 3)
            on = np.flatnonzero(differ == 0)
            a, b, at = a[on], b[on], at[on] + 8
            full = at >= most
            out[a[full]] = most
            a, b, at = a[~full], b[~full], at[~full]

    step = 64
    grow(np.arange(0, n, step), np.zeros(-(-n // step), np.int64))
    while step > 1:
        between = np.arange(step // 2, n, step)
        least = np.maximum(np.minimum(out[between - step // 2], most) - step // 2, 0)
        grow(between, least)
        step //= 2
    return np.minimum(out, most).astype(np.int32)

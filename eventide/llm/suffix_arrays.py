"""Suffix arrays by induced sorting, and permuted common prefixes up to a length.

Suffixes are classified as smaller (S) or larger (L) than the next one; the
substrings between leftmost S suffixes are sorted by one round of inducing,
named, and sorted recursively where names repeat; a last round induces the
whole array. Inducing walks the buckets of the first symbol in order and moves
all entries a bucket holds at once, so its cost is linear in the text with a
few array operations a bucket; where buckets are many and small (inner
levels), it moves entry by entry.
"""

from __future__ import annotations

import numpy as np

_FEW = 48      # mean entries a bucket below which single steps are cheaper than array steps


def _types(s: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next; the last one (a unique smallest symbol) is."""
    n = len(s)
    out = np.ones(n, bool)
    if n > 1:
        differs = s[:-1] != s[1:]
        nxt = np.where(differs, np.arange(n - 1), n - 1)
        nxt = np.minimum.accumulate(nxt[::-1])[::-1]
        out[:-1] = (s[:-1] < s[1:])[nxt]
    return out


def _ranks(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, their counts, and each entry's place among equal keys."""
    first = np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]))
    counts = np.diff(np.append(first, len(sorted_keys)))
    return sorted_keys[first], counts, np.arange(len(sorted_keys)) - np.repeat(first, counts)


def _induce_arrays(s, small, lms, starts, ends):
    sa = np.full(len(s), -1, np.int64)
    c = s[lms]
    order = np.argsort(c, kind="stable")
    keys, counts, rank = _ranks(c[order])
    tail = np.zeros(len(starts), np.int64)          # leftmost-S suffixes at the end of each bucket
    tail[keys] = counts
    sa[ends[c[order]] - tail[c[order]] + rank] = lms[order]
    head = starts.copy()
    used = np.flatnonzero(ends > starts).tolist()

    def push_large(chunk):
        p = chunk - 1
        p = p[p >= 0]
        p = p[~small[p]]
        if len(p):
            cp = s[p]
            o = np.argsort(cp, kind="stable")
            cp = cp[o]
            keys, counts, rank = _ranks(cp)
            sa[head[cp] + rank] = p[o]
            head[keys] += counts

    for b in used:
        lo = starts[b]
        while lo < head[b]:
            hi = head[b]
            push_large(sa[lo:hi])
            lo = hi
        if tail[b]:
            push_large(sa[ends[b] - tail[b]:ends[b]].copy())
    low = ends.copy()

    def push_small(chunk):
        p = chunk - 1
        p = p[p >= 0]
        p = p[small[p]]
        if len(p):
            cp = s[p]
            o = np.argsort(cp, kind="stable")
            cp = cp[o]
            keys, counts, rank = _ranks(cp)
            sa[low[cp] - 1 - rank] = p[o]
            low[keys] -= counts

    last = s[-1]
    low[last] -= 1
    sa[low[last]] = len(s) - 1
    for b in reversed(used):
        hi = ends[b]
        while hi > low[b]:
            lo = low[b]
            push_small(sa[lo:hi][::-1].copy())
            hi = lo
        if head[b] > starts[b]:
            push_small(sa[starts[b]:head[b]][::-1].copy())
    return sa


def _induce_steps(s, small, lms, starts, ends):
    s, small, ends_l, head = s.tolist(), small.tolist(), ends.tolist(), starts.tolist()
    sa, low = [-1] * len(s), list(ends_l)
    for p in reversed(lms.tolist()):
        low[s[p]] -= 1
        sa[low[s[p]]] = p
    lms_low = list(low)
    for i in range(len(s)):
        p = sa[i] - 1
        if p >= 0 and not small[p]:
            c = s[p]
            sa[head[c]] = p
            head[c] += 1
    for c, x in enumerate(lms_low):          # leftmost-S entries are set anew
        for i in range(max(x, head[c]), ends_l[c]):
            sa[i] = -1
    low = list(ends_l)
    low[s[-1]] -= 1
    sa[low[s[-1]]] = len(s) - 1
    for i in range(len(s) - 1, -1, -1):
        p = sa[i] - 1
        if p >= 0 and small[p]:
            c = s[p]
            low[c] -= 1
            sa[low[c]] = p
    return np.array(sa, np.int64)


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Suffix array of integers >= 0 whose last one is the smallest and occurs once."""
    n = len(s)
    if n < 3:
        return np.argsort(s, kind="stable").astype(np.int64)
    s = np.asarray(s)
    if s.max() > 0xFFFF:
        s = s.astype(np.int64)
    else:
        s = s.astype(np.uint16)              # small symbols sort by counting
    counts = np.bincount(s)
    ends = np.cumsum(counts)
    starts = ends - counts
    small = _types(s)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    induce = _induce_arrays if n >= _FEW * int((counts > 0).sum()) else _induce_steps
    sa = induce(s, small, lms, starts, ends)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    order = sa[is_lms[sa]]                   # by their substrings
    index = np.zeros(n, np.int64)
    index[lms] = np.arange(len(lms))
    size = np.append(np.diff(lms), 1)[index[order]]      # up to the next one, whose symbol is compared too
    same = np.zeros(len(order), bool)
    same[1:] = size[1:] == size[:-1]
    at, k = np.flatnonzero(same), 0
    while len(at):
        a, b = order[at] + k, order[at - 1] + k
        inside = k <= size[at]
        eq = ~inside | (s[np.minimum(a, n - 1)] == s[np.minimum(b, n - 1)])
        same[at[~eq]] = False
        at = at[eq & inside]
        k += 1
    names = np.cumsum(~same) - 1
    if names[-1] + 1 < len(order):
        reduced = np.empty(len(lms), np.int64)
        reduced[index[order]] = names
        order = lms[suffix_array(reduced)]
    return induce(s, small, order, starts, ends)


def common_prefixes(text: np.ndarray, sa: np.ndarray, most: int) -> np.ndarray:
    """Permuted common prefixes: for each suffix of ``sa`` in text order, the length it shares with the one before it in ``sa``, up to ``most``.

    Every suffix named in ``sa`` must have ``most`` bytes. Returned in the order of ``sa`` (0 for the first).
    """
    out = np.zeros(len(sa), np.int64)
    if len(sa) < 2:
        return out
    raw = text.tobytes() + bytes(8)
    words = np.ndarray(len(text) + 1, "<u8", raw, strides=(1,))
    by_text = np.argsort(sa[1:], kind="stable") + 1      # text order: neighbours in memory are compared together
    a, b, live, k = sa[by_text], sa[by_text - 1], by_text, 0
    while len(live) and k < most:
        x = words[a + k] ^ words[b + k]
        step = np.where(x == 0, 8, (np.bitwise_count((x & -x) - np.uint64(1)) >> 3).astype(np.int64))
        out[live] = np.minimum(k + step, most)
        on = x == 0
        a, b, live = a[on], b[on], live[on]
        k += 8
    return out

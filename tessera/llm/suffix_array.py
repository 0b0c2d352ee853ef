"""Suffix array by induced sorting, and permuted common prefixes.

Suffixes are classified as smaller (S) or larger (L) than their right
neighbour.  Leftmost-smaller (LMS) substrings are sorted by inducing, named,
and the string of names is sorted recursively; its order induces the order of
all suffixes.  The byte level works on whole buckets with array operations; a
bucket needs one round per run of equal symbols.  Levels below it have large
alphabets and are at most half as long each; they are induced by a plain scan.
"""

from __future__ import annotations

import numpy as np


def _types(t: np.ndarray) -> np.ndarray:
    """S (True) or L (False) per suffix; the last one is S."""
    n = len(t)
    differ = np.flatnonzero(t[:-1] != t[1:])
    small = np.ones(n, bool)
    if len(differ):
        at = np.searchsorted(differ, np.arange(n - 1))
        inside = at < len(differ)
        to = differ[np.minimum(at, len(differ) - 1)]
        small[:-1] = np.where(inside, t[to] < t[to + 1], True)
    return small


def _push(sa, t, j, place, step):
    """Append suffixes ``j`` (in scan order) to their buckets."""
    sym = t[j]
    order = np.argsort(sym, kind="stable")
    s = sym[order]
    first = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
    count = np.diff(np.append(first, len(s)))
    rank = np.arange(len(s)) - np.repeat(first, count)
    sa[place[s] + step * rank] = j[order]
    place[s[first]] += step * count


def _induce_buckets(t, small, lms, size):
    """Suffix array induced from ``lms`` in order; a small alphabet."""
    n, k = len(t), len(size)
    end = np.cumsum(size)
    begin = end - size
    sa = np.full(n, -1, np.int64)
    n_lms = np.bincount(t[lms], minlength=k)
    place = end - n_lms
    _push(sa, t, lms, place, 1)
    head = begin.copy()
    for c in np.flatnonzero(size).tolist():
        done = int(begin[c])
        while done < head[c]:                         # L suffixes, round by round
            stop = int(head[c])
            j = sa[done:stop] - 1
            done = stop
            j = j[j >= 0]
            j = j[~small[j]]
            if len(j):
                _push(sa, t, j, head, 1)
        j = sa[end[c] - n_lms[c]:end[c]] - 1          # LMS suffixes of the bucket
        j = j[j >= 0]
        if len(j):
            _push(sa, t, j[~small[j]], head, 1)
    tail = end - 1
    for c in np.flatnonzero(size)[::-1].tolist():
        done = int(end[c]) - 1
        while done > tail[c]:                         # S suffixes, from the top
            stop = int(tail[c])
            j = sa[stop + 1:done + 1][::-1] - 1
            done = stop
            j = j[j >= 0]
            j = j[small[j]]
            if len(j):
                _push(sa, t, j, tail, -1)
        j = sa[begin[c]:head[c]][::-1] - 1            # then its L suffixes
        j = j[j >= 0]
        j = j[small[j]]
        if len(j):
            _push(sa, t, j, tail, -1)
    sa[0] = n - 1
    return sa


def _induce_scan(t, small, lms, size):
    """The same for a large alphabet, as a plain scan."""
    n = len(t)
    end = np.cumsum(size)
    begin = (end - size).tolist()
    tt, ss = t.tolist(), small.tolist()
    sa = [-1] * n
    place = end.tolist()
    for j in reversed(lms.tolist()):
        place[tt[j]] -= 1
        sa[place[tt[j]]] = j
    head = begin
    for i in range(n):
        j = sa[i] - 1
        if j >= 0 and not ss[j]:
            c = tt[j]
            sa[head[c]] = j
            head[c] += 1
    place = end.tolist()
    for i in range(n - 1, -1, -1):
        j = sa[i] - 1
        if j >= 0 and ss[j]:
            c = tt[j]
            place[c] -= 1
            sa[place[c]] = j
    sa[0] = n - 1
    return np.array(sa, np.int64)


BUCKET_ALPHABET = 4096    # up to here whole buckets, beyond it the scan


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Suffix array of integers ``t`` that end in a unique smallest 0."""
    n = len(t)
    if n <= 2:
        return np.arange(n)[::-1].copy()
    size = np.bincount(t)
    induce = _induce_buckets if len(size) <= BUCKET_ALPHABET else _induce_scan
    small = _types(t)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if len(lms) == 0:
        return induce(t, small, lms, size)
    rough = induce(t, small, lms, size)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    ordered = rough[is_lms[rough]]
    name = _names(t, lms, ordered)
    rank = np.empty(n, np.int64)
    rank[ordered] = name
    reduced = rank[lms]                               # names in text order
    if name[-1] + 1 == len(lms):
        return induce(t, small, ordered, size)
    return induce(t, small, lms[suffix_array(reduced)], size)


def _names(t, lms, ordered):
    """Rank of each LMS substring in ``ordered``; equal substrings share one."""
    stop = np.empty(len(t), np.int64)
    stop[lms[:-1]] = lms[1:] + 1
    stop[lms[-1]] = len(t)
    length = stop[ordered] - ordered
    differ = length[1:] != length[:-1]
    left, right = ordered[:-1], ordered[1:]
    at = np.flatnonzero(~differ)
    k = 0
    while len(at):                                    # symbol by symbol, equal so far
        unequal = t[left[at] + k] != t[right[at] + k]
        differ[at[unequal]] = True
        k += 1
        at = at[~unequal]
        at = at[length[at] > k]
    name = np.zeros(len(ordered), np.int64)
    np.cumsum(differ, out=name[1:])
    return name


def common_prefixes(t: np.ndarray, sa: np.ndarray, limit: int) -> np.ndarray:
    """Permuted longest common prefixes: for each suffix, in text order, its
    common prefix with the suffix before it in ``sa``, up to ``limit``.

    Only irreducible values (the left neighbours differ) are compared; every
    other value is one less than the value at its left.  ``limit`` must exceed
    the distance from any place to the next separator 1: the places after a
    separator are compared too, so that no carried value comes from one that
    was cut off at ``limit``.
    """
    n = len(t)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    left = np.arange(n)
    need = (before >= 0) & ((left == 0) | (before == 0) | (t[np.maximum(left - 1, 0)] == 1)
                            | (t[np.maximum(left - 1, 0)] != t[np.maximum(before - 1, 0)]))
    plcp = np.zeros(n, np.int64)
    i = np.flatnonzero(need)
    j = before[i]
    block = 32
    pad = np.concatenate([t, np.full(limit + block, -1, t.dtype)])
    view = np.lib.stride_tricks.sliding_window_view(pad, block)
    # The padding at the end is equal on both sides only if i == j, never.
    k = 0
    while len(i) and k < limit:
        same = view[i + k] == view[j + k]
        whole = same.all(1)
        step = np.where(whole, block, same.argmin(1))
        plcp[i] += step
        i, j = i[whole], j[whole]
        k += block
    # Carry: value at i is the largest irreducible value before it, less the distance.
    reach = np.where(need, plcp + left, 0)
    return np.minimum(np.maximum(np.maximum.accumulate(reach) - left, 0), limit)


def repeated(units: list[bytes], length: int) -> list[np.ndarray]:
    """For each byte string the starts whose ``length`` bytes also start at
    another place of any of the strings."""
    size = np.array([len(u) for u in units], np.int64)
    end = np.cumsum(size + 1)
    t = np.zeros(int(end[-1]) + 1, np.int16)
    body = np.frombuffer(b"\0".join(units) + b"\0", np.uint8)
    t[:-1] = body.astype(np.int16) + 2
    t[end - 1] = 1                                    # ends of units; 0 ends all
    sa = suffix_array(t)
    plcp = common_prefixes(t, sa, length + int(size.max(initial=0)))
    best = plcp.copy()
    best[sa[:-1]] = np.maximum(best[sa[:-1]], plcp[sa[1:]])
    hit = np.flatnonzero(best >= length)
    owner = np.searchsorted(end, hit, "right")
    first = end - size - 1
    inside = owner < len(units)                       # whole strings of one unit only
    inside[inside] = hit[inside] + length < end[owner[inside]]
    hit, owner = hit[inside], owner[inside]
    cut = np.searchsorted(owner, np.arange(len(units) + 1))
    return [hit[cut[i]:cut[i + 1]] - first[i] for i in range(len(units))]

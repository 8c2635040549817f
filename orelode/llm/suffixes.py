"""Suffix arrays of byte strings by induced sorting, a bucket at a time in numpy.

Positions are smaller (S) or larger (L) than the next suffix; an S after an L is a leftmost S. The
leftmost-S suffixes are sorted through the names of the substrings between them; L suffixes follow
from them in one pass over the buckets, S suffixes from those in a second. Each pass moves whole
waves of a bucket at once: entries whose predecessor falls into the same bucket are the next wave.

One thing differs from the textbook: where names repeat, the shorter string of names is not sorted by
the same routine again, as its alphabet has as many buckets as names, but by doubling the length by
which its suffixes are ranked.
"""

from __future__ import annotations

import numpy as np


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)


def _ragged(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places of the ranges ``[begin, begin + size)``, one after the other."""
    return np.arange(size.sum()) + np.repeat(begin - _starts(size), size)


def _put(sa: np.ndarray, where: np.ndarray, found: np.ndarray, chars: np.ndarray, up: bool) -> None:
    """Appends ``found`` to the buckets of ``chars`` in order; ``where`` holds the next free places."""
    order = np.argsort(chars, kind="stable")
    count = np.bincount(chars, minlength=256)
    used = np.flatnonzero(count)
    rank = np.arange(len(found)) - np.repeat(_starts(count[used]), count[used])
    own = chars[order]
    sa[where[own] + (rank if up else -rank)] = found[order]
    where[used] += count[used] if up else -count[used]


def _induce(text: np.ndarray, larger: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """The suffix array that follows from the leftmost-S positions in the order given."""
    n = len(text)
    size = np.bincount(text, minlength=256)
    head, tail = _starts(size), np.cumsum(size).astype(np.int64)
    chars = text[lms]
    leftmost = np.split(lms, np.cumsum(np.bincount(chars, minlength=256))[:-1]) if len(lms) else [lms] * 256
    sa = np.full(n, -1, np.int32)
    where = head.copy()
    # The end of the text is the smallest suffix; what precedes it is larger.
    sa[where[text[-1]]] = n - 1
    where[text[-1]] += 1
    for c in np.flatnonzero(size):
        done = head[c]
        while done < where[c]:
            wave, done = sa[done : where[c]], where[c]
            before = wave[wave > 0] - 1
            before = before[larger[before]]
            if len(before):
                _put(sa, where, before, text[before], up=True)
        wave = leftmost[c]
        before = wave[wave > 0] - 1
        before = before[larger[before]]
        if len(before):
            _put(sa, where, before, text[before], up=True)
    ends_l = where.copy()
    where = tail - 1
    for c in np.flatnonzero(size)[::-1]:
        done = tail[c] - 1
        while done > where[c]:
            wave, done = sa[where[c] + 1 : done + 1][::-1], where[c]
            before = wave[wave > 0] - 1
            before = before[~larger[before]]
            if len(before):
                _put(sa, where, before, text[before], up=False)
        wave = sa[head[c] : ends_l[c]][::-1]
        before = wave[wave > 0] - 1
        before = before[~larger[before]]
        if len(before):
            _put(sa, where, before, text[before], up=False)
    return sa


def _ranked(names: np.ndarray) -> np.ndarray:
    """The order of the suffixes of ``names``, by doubling; only ranks still shared are refined."""
    n = len(names)
    rank = names.astype(np.int64)
    order = np.argsort(rank, kind="stable")
    step = 1
    while True:
        sorted_rank = rank[order]
        new = np.ones(n, bool)
        new[1:] = sorted_rank[1:] != sorted_rank[:-1]
        first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        rank[order] = first
        shared = ~new
        shared[:-1] |= ~new[1:]
        at = np.flatnonzero(shared)
        if not len(at):
            return order
        open_ = order[at]
        ahead = open_ + step
        next_ = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        both = rank[open_] * np.int64(n + 1) + next_
        again = np.argsort(both, kind="stable")
        order[at] = open_[again]
        # Ranks inside a group: its first place plus the place of the first with the same pair.
        refined = both[again]
        change = np.ones(len(at), bool)
        change[1:] = refined[1:] != refined[:-1]
        rank[order[at]] = at[np.maximum.accumulate(np.where(change, np.arange(len(at)), 0))]
        step *= 2


def suffix_array(text: np.ndarray) -> np.ndarray:
    """The places of ``text`` (bytes) in the order of the suffixes that begin there."""
    n = len(text)
    if n < 2:
        return np.arange(n, dtype=np.int32)
    step = np.sign(text[1:].astype(np.int16) - text[:-1])
    step = np.append(step, np.int16(-1))
    # A place takes the sign of the next place that differs from its successor.
    nearest = np.where(step != 0, np.arange(n), n)
    nearest = np.minimum.accumulate(nearest[::-1])[::-1]
    larger = step[nearest] < 0
    lms = np.flatnonzero(~larger[1:] & larger[:-1]) + 1
    if len(lms) > 1:
        by_char = lms[np.argsort(text[lms], kind="stable")]
        rough = _induce(text, larger, by_char)
        is_lms = np.zeros(n, bool)
        is_lms[lms] = True
        order = rough[is_lms[rough]].astype(np.int64)
        # Substrings run to the next leftmost S, included; the last runs to the end of the text.
        size_at = np.zeros(n, np.int64)
        size_at[lms] = np.append(np.diff(lms) + 1, n - lms[-1] + 1)
        a, b = order[:-1], order[1:]
        sa_, sb = size_at[a], size_at[b]
        same = (sa_ == sb) & (a + sa_ <= n) & (b + sb <= n)
        at = np.flatnonzero(same)
        sizes = sa_[at]
        equal = text[_ragged(a[at], sizes)] == text[_ragged(b[at], sizes)]
        if len(at):
            same[at] = np.add.reduceat(equal, _starts(sizes), dtype=np.int64) == sizes
        name_at = np.zeros(n, np.int64)
        name_at[order] = np.concatenate([[0], np.cumsum(~same)])
        names = name_at[lms]
        lms = lms[_ranked(names)]
    return _induce(text, larger, lms)


def permuted_common_prefixes(text: np.ndarray, sa: np.ndarray, most: int) -> np.ndarray:
    """For each place the bytes, up to ``most``, that its suffix shares with the one sorted before it.

    A place whose left neighbour is preceded by the same byte shares one less than that neighbour;
    only the others are compared, all at once.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    here = np.arange(n)
    own = before < 1
    own |= here == 0
    own[1:] |= text[:-1] != text[np.maximum(before[1:] - 1, 0)]
    own[1:] |= before[1:] - 1 != before[:-1]
    at = np.flatnonzero(own & (before >= 0))
    other, length = before[at], np.zeros(len(at), np.int64)
    active = np.arange(len(at))
    limit = np.minimum(n - np.maximum(at, other), most + n)
    while len(active):
        k = length[active]
        more = k < limit[active]
        active, k = active[more], k[more]
        more = text[at[active] + k] == text[other[active] + k]
        active = active[more]
        length[active] += 1
        if len(active) and length[active[0]] > 4 * most:
            length[active] = limit[active]
            break
    ends = np.zeros(n, np.int64)
    ends[at] = at + length
    reach = np.maximum.accumulate(ends)
    out = np.maximum(reach - here, 0)
    out[before < 0] = 0
    return np.minimum(out, most)

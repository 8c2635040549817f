"""Hashes of words and word shingles, for many texts in one vectorised step.

A word is a run of letters and digits in lower case; characters beyond ASCII count as letters.
"""

from __future__ import annotations

import numpy as np

#: Words of a shingle.
SHINGLE_WORDS = 5
_BASE = np.uint64(0x9E3779B97F4A7C15)
_FACTORS = np.array(
    [0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
     0xE7037ED1A0B428DB], np.uint64,
)
_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and where each text's begin (one more entry at the end)."""
    blobs = [t.lower().encode("utf-8", "surrogatepass") if t else b"" for t in texts]
    data = np.frombuffer(b" ".join([b"", *blobs, b""]), np.uint8)
    begins = np.cumsum([1, *(len(b) + 1 for b in blobs)])
    inside = _WORD_BYTE[data]
    edges = np.diff(inside.astype(np.int8))
    starts, ends = np.flatnonzero(edges == 1) + 1, np.flatnonzero(edges == -1) + 1
    first = np.searchsorted(starts, begins)
    if not len(starts):
        return np.zeros(0, np.uint64), first
    sizes = ends - starts
    offset = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    powers = np.cumprod(np.full(sizes.max(), _BASE))
    values = (data[inside].astype(np.uint64) + np.uint64(1)) * powers[offset]
    return mix(np.add.reduceat(values, np.cumsum(sizes) - sizes) + sizes.astype(np.uint64)), first


def shingle_hashes(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of every shingle. A text of fewer words, but some, has one of all its words."""
    k, n = SHINGLE_WORDS, len(words)
    total = np.zeros(n, np.uint64)
    size = np.diff(first)
    left = np.repeat(first[1:], size) - np.arange(n)  # words from here to the text's end
    for j in range(k):
        shifted = np.concatenate([words[j:], np.zeros(min(j, n), np.uint64)])
        total += np.where(left > j, shifted * _FACTORS[j], np.uint64(0))
    whole = np.zeros(n, bool)
    whole[first[:-1][(size > 0) & (size < k)]] = True
    good = (left >= k) | whole
    owner = np.repeat(np.arange(len(size)), size)
    return mix(total[good]), owner[good]


def weighted_sets(
    shingles: np.ndarray, owner: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different shingles of each text in ascending order, their text, and how often each occurs."""
    order = np.lexsort((shingles, owner))
    s, o = shingles[order], owner[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (o[1:] != o[:-1])
    at = np.flatnonzero(new)
    return s[at], o[at], np.diff(np.append(at, len(s)))

"""Byte-level BPE, encoded and decoded as a tree reduction.

A text is cut into leaves; neighbours are joined by encoding a window around the cut again, which
grows until what lies outside it provably stays as it is. Encoding is then a monoid: leaves may be
encoded anywhere and joined in any bracketing, with the tokens of the whole text as the result.

Two facts make a join final:

* The pattern is matched from left to right and never looks back, and no match runs from a letter or
  digit into white space. So a blank after a letter or digit begins a match in every text that holds
  it, and the window that runs between two such places, one on each side of the cut, is enough.
* Within one match, a token sequence is the encoding of its bytes exactly if each adjacent pair is
  the encoding of its own bytes. So a window of tokens may be replaced as soon as its new ends agree
  with the tokens outside.
"""

from __future__ import annotations

import base64
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
import tiktoken
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters of a leaf. Texts up to this length are one leaf.
LEAF_CHARS = 32_768
#: Bytes of one match that are encoded in one piece; longer matches are reduced by the same tree.
LEAF_BYTES = 2_048
# The characters of Unicode's White_Space, which ``\s`` stands for in the library.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def _breaks(text: str, at: int) -> bool:
    """Whether a match begins at ``at`` in every text that holds this place."""
    return text[at] in " \t\n\r" and text[at - 1].isalnum()


@lru_cache(maxsize=4)
def _codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


class Codec:
    """A vocabulary of ranks with the two monoids: over tokens of one match, and over matches."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        own = pattern.replace(r"[^\s", f"[^{WHITE}")
        own = own.replace(r"\S", f"[^{WHITE}]").replace(r"\s", f"[{WHITE}]")
        self.pattern = regex.compile(own)
        self.encoding = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
        self.pieces = {rank: piece for piece, rank in ranks.items()}

    # One match -----------------------------------------------------------------------------

    def _bytes(self, ids: list[int]) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids))

    def _plain(self, data: bytes) -> list[int]:
        return self.encoding._encode_single_piece(data)

    def _agree(self, left: int, right: int) -> bool:
        return self._plain(self.pieces[left] + self.pieces[right]) == [left, right]

    def join_tokens(self, left: list[int], right: list[int]) -> list[int]:
        """The tokens of two neighbouring byte strings of one match, from the tokens of each."""
        width = 1
        while left and right:
            a, b = max(0, len(left) - width), min(len(right), width)
            window = self._plain(self._bytes(left[a:] + right[:b]))
            if (a == 0 or self._agree(left[a - 1], window[0])) and (
                b == len(right) or self._agree(window[-1], right[b])
            ):
                return left[:a] + window + right[b:]
            width *= 2
        return left or right

    def match_tokens(self, data: bytes) -> list[int]:
        if len(data) <= LEAF_BYTES:
            return self._plain(data)
        middle = len(data) // 2
        return self.join_tokens(self.match_tokens(data[:middle]), self.match_tokens(data[middle:]))

    # Many matches --------------------------------------------------------------------------

    def encode(self, text: str) -> list[int]:
        """The tokens of ``text``: its leaves, joined pairwise up the tree."""
        return self._reduce(text, 0, len(text))

    def _reduce(self, text: str, begin: int, end: int) -> list[int]:
        """The tokens of ``text[begin:end]``, read as a text of its own."""
        if end - begin <= LEAF_CHARS:
            return self.encoding.encode_ordinary(text[begin:end])
        cut = (begin + end) // 2
        left, right = self._reduce(text, begin, cut), self._reduce(text, cut, end)
        start = next((p for p in range(cut - 1, begin, -1) if _breaks(text, p)), begin)
        stop = next((p for p in range(cut + 1, end) if _breaks(text, p)), end)
        return (
            self._without(left, text[start:cut], at_end=True)
            + self._window(text[start:stop])
            + self._without(right, text[cut:stop], at_end=False)
        )

    def _window(self, text: str) -> list[int]:
        if len(text) <= 2 * LEAF_CHARS:
            return self.encoding.encode_ordinary(text)
        ids: list[int] = []
        for match in self.pattern.finditer(text):
            ids += self.match_tokens(match[0].encode())
        return ids

    def _without(self, ids: list[int], part: str, at_end: bool) -> list[int]:
        """``ids`` less the tokens at one end that spell ``part``."""
        left, n = len(part.encode()), 0
        while left > 0:
            n += 1
            left -= len(self.pieces[ids[-n] if at_end else ids[n - 1]])
        if left:
            raise AssertionError("a place where matches break lies inside a token")
        return ids[: len(ids) - n] if at_end else ids[n:]

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of ``ids``: two halves side by side, up the tree."""
        if len(ids) <= LEAF_CHARS:
            return self._bytes(ids.tolist())
        middle = len(ids) // 2
        return self.decode(ids[:middle]) + self.decode(ids[middle:])


def encoder(path: str, pattern: str) -> Callable[[Column], Column]:
    """A function of a text column that gives its token ids, four bytes each, little-endian.

    NULL and the empty text have no tokens. Lone surrogates cannot occur in Spark's strings.
    """

    @F.pandas_udf("binary")
    def encode(texts: pd.Series) -> pd.Series:
        codec = _codec(path, pattern)
        return pd.Series(
            [np.array(codec.encode(t), "<u4").tobytes() if t else b"" for t in texts], dtype=object
        )

    return encode


def decoder(path: str, pattern: str) -> Callable[[Column], Column]:
    """A function of a column of ids as :func:`encoder` gives them, back to bytes."""

    @F.pandas_udf("binary")
    def decode(blobs: pd.Series) -> pd.Series:
        codec = _codec(path, pattern)
        return pd.Series(
            [codec.decode(np.frombuffer(b, "<u4")) if b else b"" for b in blobs], dtype=object
        )

    return decode

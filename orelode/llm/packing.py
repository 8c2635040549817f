"""Packing of token streams into windows by an order-preserving dynamic program.

The documents of a partition form one stream. A window may end after a document, after a sentence,
or, where neither is near, anywhere. Of all ways to cut the stream the one is taken that minimises
padding plus penalties for cuts inside documents:

    D[j] = penalty(j) + min over i within reach of (D[i] + padding(b_j - b_i))

For padding to a fixed length that is a sliding minimum of ``D[i] + b_i``, kept in a monotone queue;
windows whose length is a power of two need no padding and are twelve more transitions. So the
program is linear in the number of possible cuts. It runs over bounded stretches of the stream; what
follows the last cut of a stretch is carried into the next.

Nothing is shuffled: each partition is packed where it lies, in its own order.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from orelode.llm.common import frugal, remember, steps

MAX_TOKENS = 4096
#: Id that ends each document.
END_ID = 2
#: What cuts cost, in tokens of padding.
SENTENCE_CUT, WORD_CUT = 8, 64
#: What a window of a power-of-two length costs, so that windows don't crumble.
SHORT_WINDOW = 48
#: Windows that a stretch of the dynamic program spans.
STRETCH = 256
#: Words a worker remembers the ids of.
CACHED_WORDS = 600_000

SCHEMA = (
    "doc_id long, start long, length long, ids binary, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)

# What the vocabulary's normaliser takes for white space.
_WHITE = re.compile("[\t-\r \x85\xa0  -     　]+")
# Letters that have no other form, then signs other than the apostrophe.
_PLAIN = re.compile("([A-Za-zß-öø-ÿÀ-ÖØ-Þ]+)([!-&(-/:-@[-`{-~]*)")
_LATIN = re.compile("[\x00-\x7e\xc0-\xff]*")


class WordCodec:
    """Ids of texts by a vocabulary whose words never reach over white space, a word at a time.

    Each different word is encoded once by the library, then looked up.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}
        ends = [
            i for word, i in self.library.get_vocab().items()
            if re.search("[.!?]+(</w>)?$", word) and i != END_ID
        ]
        self.sentence_end = np.zeros(self.library.get_vocab_size() + 1, bool)
        self.sentence_end[ends] = True
        # How the model spells the bytes of a letter.
        spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.spelled = {c: spell(chr(c))[0][0] for c in range(0xC0, 0x100)}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        # The library looks for added tokens before it lowers letters: such texts go to it whole.
        whole = {i for i, t in enumerate(texts) if any(a in t.lower() for a in self.added)}
        words = [[] if i in whole else _words(t) for i, t in enumerate(texts)]
        known = self.known
        new = {w for own in words for w in own if w not in known}
        if len(known) + len(new) > CACHED_WORDS:
            known.clear()
            new = set().union(*words)
        self._learn(new)
        get = known.__getitem__
        return [
            np.frombuffer(self._library(texts[i]) if i in whole else b"".join(map(get, own)), "<u4")
            for i, own in enumerate(words)
        ]

    def _learn(self, new: set[str]) -> None:
        """Letters and a tail of signs are two matches of the vocabulary's pattern, whose ids add up.

        A match of letters goes straight to the model; all else takes the library's whole way.
        """
        known, one, spelled, plain = self.known, self.library.model.tokenize, self.spelled, _PLAIN.fullmatch
        other = []
        for word in new:
            match = plain(word)
            if match is None:
                other.append(word)
                continue
            stem, tail = match.groups()
            ids = known.get(stem)
            if ids is None:
                low = stem.lower()
                found = one(low if low.isascii() else low.translate(spelled))
                ids = known[stem] = array("I", [t.id for t in found]).tobytes()
            if tail:
                end = known.get(tail)
                if end is None:
                    end = known[tail] = self._library(tail)
                known[word] = ids + end
        for word in other:
            known[word] = self._library(word)

    def _library(self, word: str) -> bytes:
        return array("I", self.library.encode(word, add_special_tokens=False).ids).tobytes()


def _words(text: str) -> list[str]:
    """What white space separates; in lower case where that is one character for one."""
    if _odd(text):
        return [w for w in _WHITE.split(text) if w]
    return (text.lower() if text.isascii() or _LATIN.fullmatch(text) else text).split()


def _odd(text: str) -> bool:
    """Whether Python's white space and the vocabulary's may differ on ``text``."""
    return any(c in text for c in "\x1c\x1d\x1e\x1f")


@lru_cache(maxsize=2)
def word_codec(path: str) -> WordCodec:
    return WordCodec(path)


def best_cuts(
    places: np.ndarray, penalties: np.ndarray, limit: int, last: bool
) -> list[int]:
    """Indices into ``places`` (which begins with 0) where windows end, at least total cost.

    No gap of ``places`` is wider than ``limit``. ``last``: the final window ends at the last place;
    else it ends at the cheapest place within a window of the end.
    """
    spots, cost = places.tolist(), [0.0] * len(places)
    came, where = [0] * len(places), {0: 0}
    queue: deque[tuple[float, int]] = deque([(0.0, 0)])
    powers = [1 << k for k in range(limit.bit_length()) if 1 << k <= limit]
    padded = limit if limit in powers else -1
    for j in range(1, len(spots)):
        b, extra = spots[j], float(penalties[j])
        while spots[queue[0][1]] < b - limit:
            queue.popleft()
        least, i = queue[0]
        least += limit - b
        for p in powers:
            k = where.get(b - p)
            if k is not None:
                c = cost[k] + (0 if p == padded else SHORT_WINDOW)
                if c < least:
                    least, i = c, k
        cost[j], came[j], where[b] = least + extra, i, j
        key = cost[j] + b
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, j))
    j = len(spots) - 1
    if not last:
        near = [k for k in range(1, len(spots)) if spots[k] > spots[-1] - limit]
        j = min(reversed(near), key=cost.__getitem__)
    cuts = []
    while j:
        cuts.append(j)
        j = came[j]
    return cuts[::-1]


def _places(
    ids: np.ndarray, ends: np.ndarray, sentence_end: np.ndarray, limit: int
) -> tuple[np.ndarray, np.ndarray]:
    """Possible cuts of a stream and their penalties; ``ends``: where its documents end."""
    kind = np.full(len(ids) + 1, np.inf)
    kind[1:][sentence_end[ids]] = SENTENCE_CUT
    kind[0] = kind[ends] = 0
    cuts = np.flatnonzero(np.isfinite(kind))
    cuts = cuts if cuts[-1] == len(ids) else np.append(cuts, len(ids))
    step = max(1, limit // 16)
    wide = np.flatnonzero(np.diff(cuts) > step)
    more = [np.arange(cuts[w] + step, cuts[w + 1], step) for w in wide]
    cuts = np.unique(np.concatenate([cuts, *more])).astype(np.int64)
    return cuts, np.where(np.isfinite(kind[cuts]), kind[cuts], WORD_CUT)


def pack(
    docs: DataFrame, doc_id: str, text: str, tokenizer: str, max_tokens: int = MAX_TOKENS
) -> DataFrame:
    """One row per piece of a document, with its ids and its place in a sequence.

    NULL and empty texts are documents of the end id alone. A document whose id is NULL or repeated
    is packed like any other. Sequences are numbered within their partition, and the numbers of
    different partitions never meet. An empty table gives no sequences.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remember("packing", word_codec.cache_clear)
        codec, number = word_codec(tokenizer), TaskContext.get().partitionId() << 40
        held: list[tuple[int | None, int, int, np.ndarray]] = []  # id, start, all tokens, ids
        size = 0

        def flush(last: bool) -> pa.RecordBatch:
            nonlocal held, size, number
            ids = np.concatenate([h[3] for h in held])
            ends = np.cumsum([len(h[3]) for h in held])
            places, penalties = _places(ids, ends, codec.sentence_end, max_tokens)
            if not last:  # the end of a stretch is no better than its neighbours
                penalties[-1] = max(penalties[-1], SENTENCE_CUT)
            stops = places[best_cuts(places, penalties, max_tokens, last)].tolist()
            rows: list[tuple] = []
            rest, at, k, begin = [], 0, 0, 0
            for doc, start, total, own in held:
                used = 0
                while used < len(own) and k < len(stops):
                    n = min(len(own) - used, stops[k] - at)
                    blob = own[used : used + n].tobytes()
                    rows.append((
                        doc, start + used, n, blob, zlib.crc32(blob), total, number + k, at - begin
                    ))
                    used, at = used + n, at + n
                    if at == stops[k]:
                        k, begin = k + 1, at
                if used < len(own):
                    rest.append((doc, start + used, total, own[used:]))
            number += len(stops)
            held, size = rest, sum(len(r[3]) for r in rest)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), arrow)], names=names
            )

        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for part in steps(texts):
                found = codec.encode([t or "" for t in texts[part]])
                for doc, own in zip(keys[part], found):
                    own = np.append(own, np.array([END_ID], "<u4"))
                    held.append((doc, 0, len(own), own))
                    size += len(own)
                    if size >= STRETCH * max_tokens:
                        yield flush(last=False)
        if held:
            yield flush(last=True)

    arrow = (
        pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(),
        pa.int64(),
    )
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    return docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(
        frugal(run, "packing"), SCHEMA
    )

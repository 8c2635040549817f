"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counting is distributed: each task adds up its n-grams in one array per language, and Spark sums the
arrays' entries by (language, bucket). What reaches the driver, and is broadcast, is the matrix of
log probabilities: ``buckets x languages``, whatever the size of the corpus.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orelode.llm.common import frugal, give_back, row_sums, steps

BUCKET_BITS = 15
ORDERS = (1, 2, 3)
#: Added to each count.
SMOOTHING = 0.5
#: Characters of one step, and entries of the product of counts and model that one step holds.
STEP_CHARS, SCORED_CELLS = 250_000, 1_000_000
#: Most languages a model may have: with it the matrix stays under 64 MB.
MOST_LANGUAGES = 512
UNKNOWN = "und"
# Odd multipliers that mix the code points of an n-gram.
_MIX = (2654435761, 2246822519, 3266489917)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _grams(chars: np.ndarray, ends: np.ndarray, known: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of ``chars``, whose texts begin at ``ends``, and where each text's begin.

    Those that lie in the first ``known`` characters are left out.
    """
    parts, valid = [], []
    inside = np.repeat(ends[1:], np.diff(ends))
    at = np.arange(len(chars))
    for order in ORDERS:
        code = np.full(len(chars), 40503 * order, np.uint32)
        some = np.zeros(len(chars), bool)
        for k in range(order):
            shifted = np.zeros(len(chars), np.uint32)
            shifted[: len(chars) - k] = chars[k:]
            code += shifted * np.uint32(_MIX[k])
            some |= shifted > 0
        code ^= code >> np.uint32(15)
        code *= np.uint32(2146121005)
        parts.append(code >> np.uint32(32 - BUCKET_BITS))
        valid.append(some & (at + order <= inside) & (at + order > known))
    buckets, good = np.stack(parts, 1), np.stack(valid, 1)
    per_place = np.concatenate([[0], np.cumsum(good.sum(1))])
    return buckets[good].astype(np.int64), per_place[ends]


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def ngrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all n-grams of the texts, where each text's begin, and its number of letters.

    Texts are taken in lower case, all but letters as one blank; n-grams of a blank alone and those
    that reach over the end of a text are left out.
    """
    lowered = [t.lower() if t else "" for t in texts]
    sizes = np.fromiter(map(len, lowered), np.int64, len(lowered))
    points = _points("".join(lowered))
    begins = np.concatenate([[0], np.cumsum(sizes)])
    letter = _letters()[points]
    counts = row_sums(letter, begins).astype(np.int64)
    # One blank on each side of a text, and one for each run of what is not a letter.
    after = np.concatenate([[False], letter])
    after[begins[:-1]] = False
    keep = letter | after[:-1]
    kept = np.concatenate([[0], np.cumsum(keep)])[begins]
    owner = np.repeat(np.arange(len(sizes)), np.diff(kept))
    chars = np.zeros(len(owner) + 2 * len(sizes), np.uint32)
    place = np.arange(len(owner)) + 2 * owner + 1
    chars[place] = np.where(letter[keep], points[keep], 0)
    buckets, starts = _grams(chars, kept + 2 * np.arange(len(kept)))
    return buckets, starts, counts


def _long_ngrams(text: str) -> Iterator[tuple[np.ndarray, int]]:
    """What ``ngrams`` finds in one text, piece by piece: buckets and letters of each piece."""
    text = text.lower()
    most = max(ORDERS)
    held, before = np.zeros(1, np.uint32), False  # the last characters so far, and whether the last is a letter
    for begin in range(0, len(text), STEP_CHARS):
        points = _points(text[begin : begin + STEP_CHARS])
        letter = _letters()[points]
        keep = letter | np.concatenate([[before], letter[:-1]])
        closing = [0] if begin + STEP_CHARS >= len(text) else []
        chars = np.concatenate([held, np.where(letter[keep], points[keep], 0), closing]).astype(np.uint32)
        known = len(held) if begin else 0
        yield _grams(chars, np.array([0, len(chars)]), known)[0], int(letter.sum())
        held, before = chars[-(most - 1):], bool(letter[-1])


def counted(texts: list[str | None]) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts a few at a time: which, then text, bucket and count of their different n-grams, and letters.

    A text over ``STEP_CHARS`` comes alone and in as many pieces as it takes.
    """
    size = 1 << BUCKET_BITS
    for part in steps(texts, STEP_CHARS):
        if part.stop == part.start + 1 and len(texts[part.start] or "") > STEP_CHARS:
            for buckets, letters in _long_ngrams(texts[part.start]):
                n = np.bincount(buckets, minlength=size)
                some = np.flatnonzero(n)
                yield part, np.zeros(len(some), np.int64), some, n[some], np.array([letters])
        else:
            buckets, begins, letters = ngrams(texts[part])
            both = np.repeat(np.arange(len(letters)) * size, np.diff(begins)) + buckets
            both, n = np.unique(both, return_counts=True)
            yield part, both // size, both % size, n, letters


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    log_prior: np.ndarray
    log_prob: np.ndarray  # buckets x languages

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Languages and posterior probabilities; ``und`` and 0 without letters or without a model."""
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        logs = np.tile(self.log_prior, (len(texts), 1))
        letters = np.zeros(len(texts), np.int64)
        rows = max(1, SCORED_CELLS // len(self.languages))
        for part, owner, bucket, n, found in counted(texts):
            letters[part] += found
            # A sparse matrix of counts times the model, a bounded number of its entries at a time.
            for k in range(0, len(owner), rows):
                some = slice(k, k + rows)
                products = self.log_prob[bucket[some]] * n[some, None]
                first = np.flatnonzero(np.diff(owner[some], prepend=-1))
                logs[part.start + owner[some][first]] += np.add.reduceat(products, first, axis=0)
        best = logs.argmax(1)
        score = 1 / np.exp(logs - logs.max(1, keepdims=True)).sum(1)
        names = [self.languages[b] if n else UNKNOWN for b, n in zip(best, letters)]
        return names, np.where(letters > 0, score, 0.0)


def train(docs: DataFrame, text: str, label: str) -> LanguageModel:
    """Fits the model on every row of ``docs`` whose label is not NULL.

    Rows with NULL or letterless text count for the prior alone. Equal scores go to the language
    that sorts first. An empty table gives a model that answers ``und``.
    """
    size = 1 << BUCKET_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        rows: dict[str, int] = {}
        for batch in batches:
            texts, labels = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for label in labels:
                rows[label] = rows.get(label, 0) + 1
                if label not in sums:
                    sums[label] = np.zeros(size, np.int64)
            for part, owner, bucket, n, _ in counted(texts):
                names, codes = np.unique(np.array(labels[part], object), return_inverse=True)
                for k, name in enumerate(names):
                    own = codes[owner] == k
                    sums[name] += np.bincount(bucket[own], n[own], size).astype(np.int64)
        for name, total in sums.items():
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict({
                "name": pa.array([name] * (len(some) + 1), pa.string()),
                "bucket": pa.array(np.append(some, -1), pa.int32()),
                "n": pa.array(np.append(total[some], rows[name]), pa.int64()),
            })

    counts = (
        docs.select(F.col(text).cast("string"), F.col(label).cast("string").alias("label"))
        .filter(F.col("label").isNotNull())
        .mapInArrow(frugal(count), "name string, bucket int, n long")
        .groupBy("name", "bucket").agg(F.sum("n").alias("n"))
    )
    # At most one row per language and bucket.
    table = counts.toPandas()
    names = tuple(sorted(table["name"].unique()))
    if len(names) > MOST_LANGUAGES:
        raise ValueError(f"{len(names)} languages; a model takes {MOST_LANGUAGES} at most")
    code = {n: k for k, n in enumerate(names)}
    which = table["name"].map(code).to_numpy(dtype=np.int64)
    total, prior = np.full((size, len(names)), SMOOTHING), np.ones(len(names))
    gram = table["bucket"].to_numpy() >= 0
    total[table["bucket"].to_numpy()[gram], which[gram]] += table["n"].to_numpy()[gram]
    prior[which[~gram]] = table["n"].to_numpy()[~gram]
    log_prob = np.log(total / total.sum(0)) if names else total
    log_prior = np.log(prior / prior.sum()) if names else prior
    return LanguageModel(names, log_prior, log_prob.astype(np.float32))


def predictor(model: Broadcast) -> Callable[[Column], Column]:
    """A function of a text column that gives a struct of ``lang_pred`` and ``score``.

    NULL, empty and letterless texts are ``und`` with 0; equal languages go to the one that sorts first.
    Texts of any length are read whole, in pieces. Repeated rows get equal answers.
    """

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        names, scores = model.value.predict([t if isinstance(t, str) else None for t in texts])
        return pd.DataFrame({"lang_pred": names, "score": scores})

    return predict

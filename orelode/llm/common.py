"""Small helpers the operators of this package share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters of text that one vectorised step takes at most, unless a single text is longer.
STEP_CHARS = 1_000_000


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores in front until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def steps(texts: Sequence[str | None], limit: int = STEP_CHARS) -> Iterator[slice]:
    """Slices of ``texts`` of at most ``limit`` characters together; a longer text stands alone."""
    begin = total = 0
    for i, text in enumerate(texts):
        size = len(text) if text else 0
        if i > begin and total + size > limit:
            yield slice(begin, i)
            begin, total = i, 0
        total += size
    if begin < len(texts):
        yield slice(begin, len(texts))


def give_back() -> None:
    """Returns memory that this worker no longer uses, so that idle workers of a long session stay small."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def few(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The rows a few at a time: as Python values they take far more room than in the batch."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


#: How to drop what this worker remembers between partitions, by the operator that remembers it.
_REMEMBERED: dict[str, Callable[[], None]] = {}


def remember(owner: str, forget: Callable[[], None]) -> None:
    _REMEMBERED[owner] = forget


def forget_others(owner: str) -> None:
    """Drops what this worker remembers for other operators than ``owner``."""
    for name in [n for n in _REMEMBERED if n != owner]:
        _REMEMBERED.pop(name)()


def frugal(step: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], owner: str = ""):
    """A step for ``mapInArrow`` that drops other operators' memory first and gives back its own at the end.

    What an earlier step of this worker has freed but still holds goes before the first batch comes.
    """

    @wraps(step)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_others(owner)
        give_back()
        try:
            yield from step(batches)
        finally:
            give_back()

    return run


def text_key(text: Column) -> Column:
    """128 bits that stand for a text; NULL stays NULL."""
    data = text.cast("binary")
    return F.when(text.isNotNull(), F.substring(F.sha2(data, 256), 1, 32))


def row_sums(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Sums of ``values[begins[i]:begins[i + 1]]``, 0 for empty ranges; ``begins`` has one more entry."""
    total = np.zeros((values.shape[0] + 1, *values.shape[1:]), np.float64)
    np.cumsum(values, axis=0, dtype=np.float64, out=total[1:])
    return total[begins[1:]] - total[begins[:-1]]

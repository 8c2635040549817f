"""Removal of every byte of a repeated passage, by suffix arrays over shards of the corpus.

A window is a string of 200 bytes. Two equal windows have equal bytes throughout, so they have the
same smallest 40-byte hash at the same offset: the window's anchor. Windows whose anchor's hash occurs
once repeat nowhere. The others, with their anchors, are dealt to shards by that hash, so equal windows
always meet. A shard sorts the suffixes of its text by induced sorting and computes permuted common
prefixes; suffixes that share 200 bytes or more are repeats.

Equal texts are one text, and so are equal texts around an anchor: one text with a count, which settles
its copies before any shard is made. A shard sorts what differs. An anchor with very many different
texts (a line that is on a third of all pages) would fill a shard by itself. Such texts are anchored anew
by more of their bytes: the windows that hold the anchor at offsets of one half of a range share a longer
string than those of the whole range, and meet by that. Halves are halved until what differs fits a shard;
at a single offset the string is the window, which is one text.
Copies are told by 128 bits of a text; other hashes only choose what is compared.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orelode.llm.common import few, free_name, frugal, text_key
from orelode.llm.suffixes import permuted_common_prefixes, suffix_array
from orelode.llm.words import mix
from orelode.sources.paths import materialise

#: Bytes of a passage, and of the string that anchors it.
WINDOW, ANCHOR = 200, 40
_SPAN = WINDOW - ANCHOR + 1  # anchors a window may have
#: Bytes of different text that one suffix array covers, or so many again.
SHARD_BYTES = 2_000_000
#: An anchor with more texts, which might not fit a shard, is replaced by longer ones.
OFTEN = SHARD_BYTES // (WINDOW + _SPAN)
#: Bytes that one vectorised step takes, unless one text is longer: about a hundred times as many in memory.
STEP_BYTES = 250_000
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.full(n, base)
    out[:1] = 1
    return np.cumprod(out)


def hashes(data: np.ndarray, size: int, salt: int = 0) -> np.ndarray:
    """Mixed hashes of all strings of ``size`` bytes in ``data``, by where they begin."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    spread = mix(np.arange(256, dtype=np.uint64) + np.uint64(1 + 1000 * salt))
    np.cumsum(spread[data] * _powers(n, _BASE), out=sums[1:])
    return mix((sums[size:] - sums[:-size]) * _powers(n - size + 1, _INVERSE))


def _sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """The place of the smallest of each ``width`` neighbours, the leftmost among equal ones."""
    best, at, have = values, np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        left, right = best[:-step], best[step:]
        take = right < left
        best = np.where(take, right, left)
        at = np.where(take, at[step:], at[:-step])
        have += step
    return at


def _texts(batch: pa.RecordBatch, column: int) -> list[bytes]:
    return batch.column(column).cast(pa.binary()).to_pylist()


def _find_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hash, key, place, first, last) of every anchor; the key is that of the text."""
    for batch in few(batches):
        keys, texts = batch.column(0).to_pylist(), _texts(batch, 1)
        begin = 0
        while begin < len(texts):
            stop = begin + 1
            size = len(texts[begin])
            while stop < len(texts) and size + len(texts[stop]) <= STEP_BYTES:
                size += len(texts[stop])
                stop += 1
            # One pass over all texts of the step; anchors of windows that cross texts are dropped.
            data = b"".join(texts[begin:stop])
            sizes = np.fromiter(map(len, texts[begin:stop]), np.int64, stop - begin)
            starts = np.cumsum(sizes) - sizes
            if len(data) >= WINDOW:
                codes = hashes(np.frombuffer(data, np.uint8), ANCHOR)
                at = _sliding_argmin(codes, _SPAN)
                owner = np.repeat(np.arange(len(sizes)), sizes)
                good = np.arange(len(at)) + WINDOW <= (starts + sizes)[owner[: len(at)]]
                windows = np.flatnonzero(good)
                if len(windows):
                    place, own = at[windows], owner[windows]
                    new = np.ones(len(windows), bool)
                    new[1:] = (place[1:] != place[:-1]) | (own[1:] != own[:-1])
                    a = np.flatnonzero(new)
                    z = np.append(a[1:], len(windows)) - 1
                    p, who = place[a], own[a]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(codes[p].view(np.int64)),
                        pa.array(keys[begin:stop], pa.binary()).take(pa.array(who)),
                        pa.array(p - starts[who], pa.int64()),
                        pa.array((p - windows[a]).astype(np.int16)),
                        pa.array((p - windows[z]).astype(np.int16)),
                    ], names=["hash", "key", "place", "back", "ahead"])
            begin = stop


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each text, for each listed anchor: the text of its windows, where it starts and the offsets."""
    for batch in few(batches):
        names, texts = batch.column(0).to_pylist(), _texts(batch, 1)
        owner = np.repeat(np.arange(len(names)), batch.column(2).value_lengths().to_numpy())
        anchors = pa.RecordBatch.from_struct_array(batch.column(2).flatten())
        rows: list[tuple] = []
        size = 0
        for k in range(0, len(owner), 4_096):
            columns = (c.to_pylist() for c in anchors.slice(k, 4_096).columns)
            for who, code, place, back, ahead in zip(owner[k : k + 4_096].tolist(), *columns):
                part = texts[who][place - back : place - ahead + WINDOW]
                rows.append((code, names[who], place - back, ahead, back, part))
                size += len(part)
                if size > STEP_BYTES:
                    yield _regions(rows)
                    rows, size = [], 0
        if rows:
            yield _regions(rows)


def _regions(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int16(), pa.int16(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
        names=["hash", "key", "start", "low", "high", "region"],
    )


def repeats(regions: list[bytes]) -> list[np.ndarray]:
    """For each region which of its windows occur in another place of this or another region.

    The list holds all regions that may share a window, equal ones as often as they occur.
    """
    number: dict[bytes, int] = {}
    which = np.array([number.setdefault(r, len(number)) for r in regions])
    times = np.bincount(which)
    different = list(number)
    size = np.array([len(r) for r in different])
    starts = np.cumsum(size) - size
    text = np.frombuffer(b"".join(different), np.uint8)
    sa = suffix_array(text)
    shared = permuted_common_prefixes(text, sa, WINDOW)
    # Suffixes with a whole window in their own region, in sorted order.
    owner = np.repeat(np.arange(len(size)), size)
    whole = np.arange(len(text)) + WINDOW <= (starts + size)[owner]
    joined = shared[sa] >= WINDOW
    # A suffix without a whole window stands between two groups only if the chain is broken there.
    group = np.cumsum(~joined)
    entry = whole[sa]
    group, place = group[entry], sa[entry]
    count = np.bincount(group, weights=times[owner[place]], minlength=int(group[-1]) + 1 if len(group) else 0)
    again = np.zeros(len(text), bool)
    again[place] = count[group] > 1
    cut = [again[a : a + n - WINDOW + 1] for a, n in zip(starts, size)]
    return [cut[w] for w in which]


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of repeated windows (key, first, last), from rows that come sorted by hash."""
    held: list[tuple[bytes, int, bytes]] = []
    size, last = 0, None
    seen: set[bytes] = set()

    def found() -> pa.RecordBatch:
        keys, firsts, lasts = [], [], []
        for (key, start, _), again in zip(held, repeats([r for _, _, r in held])):
            edge = np.flatnonzero(np.diff(np.concatenate([[0], again.view(np.int8), [0]])))
            keys += [key] * (len(edge) // 2)
            firsts.append(start + edge[::2])
            lasts.append(start + edge[1::2] - 1)
        return pa.RecordBatch.from_arrays([
            pa.array(keys, pa.binary()), pa.array(np.concatenate(firsts), pa.int64()),
            pa.array(np.concatenate(lasts), pa.int64()),
        ], names=["key", "first", "last"])

    for batch in batches:
        columns = (batch[c].to_pylist() for c in ("hash", "key", "start", "region"))
        for code, key, start, region in zip(*columns):
            if code != last and size > SHARD_BYTES:
                yield found()
                held, size, seen = [], 0, set()
            last = code
            held.append((key, start, region))
            if region not in seen:
                seen.add(region)
                size += len(region)
    if held:
        yield found()


def _halved(rows: DataFrame, width: int) -> DataFrame:
    """Each region cut at multiples of ``width`` offsets, under the string that a part's windows share."""
    block = F.explode(F.sequence(F.floor(F.col("low") / width), F.floor(F.col("high") / width)))
    rows = rows.withColumn("block", block).withColumn("top", F.col("high"))
    least = F.col("block") * width
    most = F.least(least + (width - 1), F.lit(_SPAN - 1))
    rows = rows.withColumn("low", F.greatest("low", least)).withColumn("high", F.least("high", most))
    skipped = F.col("top") - F.col("high")
    rows = rows.withColumn("start", F.col("start") + skipped).withColumn(
        "region", F.substring("region", (skipped + 1).cast("int"), (F.col("high") - F.col("low") + WINDOW).cast("int"))
    )
    shared = F.substring(
        "region", (F.col("high") - least + 1).cast("int"), (F.lit(WINDOW) - (most - least)).cast("int")
    )
    return rows.withColumn("hash", F.xxhash64("block", shared)).select(
        "hash", "key", "start", "low", "high", "region"
    )


def _settle(rows: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """Runs of windows in regions that occur twice, and the different regions, dealt so that shards hold them.

    Each round keeps one row for each different region, so that its rows, not those of the copies, are
    halved in the next. There are as many rounds at most as a window's offsets can be halved.
    """
    runs, regions = [], []
    width = 1 << (_SPAN - 1).bit_length()
    mark = F.unhex(F.md5("region")).alias("mark")
    while True:
        one = F.min(F.struct("key", "start", "low", "high"))
        same = materialise(
            rows.groupBy("hash", "region").agg(F.count("*").alias("n"), one.alias("one")), "same-regions"
        )
        # A region that occurs twice is a repeat from end to end, in all of its places.
        last = (F.col("start") + F.length("region") - WINDOW).alias("last")
        placed = rows.select("hash", mark, "key", F.col("start").alias("first"), last)
        twice = same.filter("n > 1").select("hash", mark)
        runs.append(placed.join(twice, ["hash", "mark"], "left_semi").select("key", "first", "last"))
        sizes = same.groupBy("hash").agg(F.count("*").alias("different")).filter("different > 1")
        open_ = same.join(sizes, "hash").select("hash", "one.*", "region", "different")
        regions.append(open_.filter(F.col("different") <= OFTEN).select("hash", "key", "start", "region"))
        rows = open_.filter(F.col("different") > OFTEN)
        if width == 1 or rows.isEmpty():
            return runs, regions
        width //= 2
        rows = materialise(_halved(rows, width), "halved-regions")


def repeated_windows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, first, last)``: runs of windows of each text that also start elsewhere.

    ``docs`` has one key for equal texts; the copies of a text beyond the first are not looked at here.
    """
    anchored = docs.select(key, text).mapInArrow(
        frugal(_find_anchors), "hash long, key binary, place long, back short, ahead short"
    )
    spot = F.xxhash64("key", "place")
    # Stored, so that the join below reads both sides from plain shuffles and a hot anchor can be split.
    shared = materialise(
        anchored.groupBy("hash").agg(
            F.min(spot).alias("low"), F.max(spot).alias("high")
        ).filter("low != high").select("hash"), "anchors"
    )
    wanted = anchored.join(shared, "hash").groupBy("key").agg(
        F.collect_set(F.struct("hash", "place", "back", "ahead")).alias("found")
    )
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).groupBy("key").agg(
        F.any_value("text").alias("text")
    )
    cut = materialise(texts.join(wanted, "key").select("key", "text", "found").mapInArrow(
        frugal(_cut), "hash long, key binary, start long, low short, high short, region binary"
    ), "regions")
    runs, regions = _settle(cut)
    dealt = reduce(DataFrame.unionByName, regions).repartition("hash").sortWithinPartitions("hash")
    found = dealt.mapInArrow(frugal(_search), "key binary, first long, last long")
    return reduce(DataFrame.unionByName, runs, found)


def covered(size: int, first: list[int] | np.ndarray, last: list[int] | np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of bytes that the windows of the given runs cover, as (begin, end)."""
    edge = np.zeros(size + 1, np.int64)
    np.add.at(edge, np.asarray(first, np.int64), 1)
    np.add.at(edge, np.asarray(last, np.int64) + WINDOW, -1)
    inside = np.concatenate([[False], np.cumsum(edge[:-1]) > 0, [False]])
    turn = np.flatnonzero(inside[1:] != inside[:-1])
    return list(zip(turn[::2].tolist(), turn[1::2].tolist()))


KEPT = "n_bytes long, kept binary, spans array<struct<begin:long,end:long>>"


def clean(text: bytes | None, copies: int, runs: list[dict] | None) -> tuple[int, bytes, list[dict]]:
    """Bytes of a text, what is left of it, and the removed spans."""
    data = bytes(text) if text is not None else b""
    spans = []
    if copies > 1 and len(data) >= WINDOW:
        spans = [(0, len(data))]
    elif runs is not None and len(runs):
        spans = covered(len(data), [r["first"] for r in runs], [r["last"] for r in runs])
    ends = [0, *(x for s in spans for x in s), len(data)]
    kept = b"".join(data[a:b] for a, b in zip(ends[::2], ends[1::2]))
    return len(data), kept, [{"begin": a, "end": b} for a, b in spans]


def cleaner() -> Callable[..., Column]:
    @F.pandas_udf(KEPT)
    def cleaned(texts: pd.Series, copies: pd.Series, runs: pd.Series) -> pd.DataFrame:
        rows = [clean(*x) for x in zip(texts, copies, runs)]
        return pd.DataFrame(rows, columns=["n_bytes", "kept", "spans"])

    return cleaned


def characters() -> Callable[[Column], Column]:
    """A function of a column of bytes that gives its whole characters; cut ones go."""

    @F.pandas_udf("string")
    def whole(values: pd.Series) -> pd.Series:
        return pd.Series([bytes(v).decode("utf-8", "ignore") for v in values], dtype=object)

    return whole


def remove_repeats(docs: DataFrame, text: str, cleaned: str = "cleaned") -> DataFrame:
    """Every row of ``docs`` with a struct ``cleaned`` of ``n_bytes``, ``kept`` and ``spans``.

    Texts are UTF-8 bytes and NULL is the empty text. Each byte goes that lies in a 200-byte string
    which also starts anywhere else, in the same row or another; strings are judged on the input. So a
    text of 200 bytes or more that occurs in two rows goes whole from both, and rows that agree in
    every column count as two. Texts under 200 bytes stay. ``kept`` may cut through a character;
    ``spans`` are the removed runs. Ids play no part.
    """
    data = F.coalesce(F.col(text).cast("binary"), F.lit(b"").cast("binary"))
    keyed = docs.select(F.col(text).cast("string").alias("text")).filter(F.length(data) >= WINDOW)
    keyed = keyed.select(F.unhex(text_key(F.col("text"))).alias("key"), "text")
    counts = keyed.groupBy("key").agg(F.count("*").alias("copies"))
    runs = repeated_windows(keyed, "key", "text").groupBy("key").agg(
        F.collect_list(F.struct("first", "last")).alias("runs")
    )
    facts = materialise(counts.filter("copies > 1").join(runs, "key", "full"), "repeats")
    key, copies, found = (free_name(docs, n) for n in ("_key", "_copies", "_runs"))
    facts = facts.select(F.col("key").alias(key), F.col("copies").alias(copies), F.col("runs").alias(found))
    marked = docs.withColumn(key, F.unhex(text_key(F.col(text).cast("string")))).join(facts, key, "left")
    marked = marked.withColumn(
        cleaned, cleaner()(data, F.coalesce(F.col(copies), F.lit(1)), F.col(found))
    )
    return marked.drop(key, copies, found)

"""Near-duplicate documents by ProbMinHash over weighted word shingles.

Each shingle emits the points of a Poisson process whose rate is its weight; each point falls on one
of the signature's components, which keeps the shingle of its earliest point. Two components are
equal with the probability Jaccard of the weighted sets. A shingle stops as soon as its next point
comes after the latest of all kept points (early termination), so long documents need little more
than one point a shingle.

Bands of the signature collide; pairs that collide are checked on the exact sets, unless their
signatures already differ by five standard deviations too much. Within a bucket all are first checked
against one member, that which collides most. Pairs of a bucket whose ends are by then in one group
need no check, as they could not change the groups. The others are compared in blocks: those outside a
bucket's main group against all it holds, without a row per pair. So no colliding pair is lost, and a
large group of copies costs one check a member.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from orelode.llm.common import few, free_name, frugal, give_back, steps
from orelode.llm.components import components
from orelode.llm.words import mix, shingle_hashes, weighted_sets, word_hashes
from orelode.sources.paths import materialise

SIMILARITY = 0.8
#: A pair at the threshold collides in some band with probability 0.998.
BANDS, ROWS = 28, 7
#: Share of equal components below which a pair at the threshold falls once in a million times.
LEAST_EQUAL = 0.66
#: Members outside and inside of a main group that one block compares.
LEFT, RIGHT = 256, 1024
#: Characters whose words and shingles are held at once, unless one text is longer.
SIGNED_CHARS = 250_000
_STEP = np.uint64(0x9E3779B97F4A7C15)


def weights(counts: np.ndarray) -> np.ndarray:
    """A shingle's weight: a line said forty times does not outweigh the rest of its text."""
    return 1 + np.log(counts)


def signatures(
    shingles: np.ndarray, owner: np.ndarray, weight: np.ndarray, texts: int, size: int
) -> np.ndarray:
    """``texts x size`` hashes of the shingles with the earliest points; 0 for texts without any."""
    best = np.full(texts * size, np.inf)
    kept = np.zeros(texts * size, np.uint64)
    h, o, rate = shingles, owner, weight
    x, state = np.zeros(len(h)), shingles.copy()
    rounds = 0
    while len(h):
        state = state + _STEP
        draw = mix(state)
        x = x - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / rate
        at = o * size + (mix(draw ^ _STEP) % np.uint64(size)).astype(np.int64)
        np.minimum.at(best, at, x)
        won = best[at] == x
        kept[at[won]] = h[won]
        rounds += 1
        if rounds < 4 or rounds % 4 == 0:
            live, where = np.unique(o, return_inverse=True)
            latest = best.reshape(texts, size)[live].max(1)
            on = x < latest[where]
            h, o, rate, x, state = h[on], o[on], rate[on], x[on], state[on]
    return kept.reshape(texts, size)


def band_keys(signature: np.ndarray) -> np.ndarray:
    keys = np.zeros((len(signature), BANDS), np.uint64)
    for r in range(ROWS):
        keys = mix(keys + signature[:, r::ROWS] + np.uint64(r + 1))
    return keys


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """The probability Jaccard of two weighted sets of (ascending hashes, weights)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(i):
        return 0.0
    u, v = a[1][i], b[1][j]
    order = np.argsort(v / u, kind="stable")
    u, v = u[order], v[order]
    # For each shared shingle: those of a lower ratio count by u, the others by v.
    below = np.cumsum(u) - u
    above = v.sum() - (np.cumsum(v) - v)
    only_a, only_b = a[1].sum() - u.sum(), b[1].sum() - v.sum()
    return float((1 / ((only_a + below) / u + (only_b + above) / v)).sum())


def _sets(texts: list[str | None]):
    words, first = word_hashes(texts)
    shingles, owner, counts = weighted_sets(*shingle_hashes(words, first))
    return words, first, shingles, owner, counts


def _sequence_keys(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Two hashes of each text's whole sequence of words."""
    size = np.diff(first)
    at = np.arange(len(words)) - np.repeat(first[:-1], size)
    place = mix(at.astype(np.uint64) * _STEP + np.uint64(1))
    out = np.zeros((len(size), 2), np.uint64)
    some = size > 0
    for k in range(2):
        values = mix(words * (place | np.uint64(1)) + np.uint64(k) * _STEP)
        if some.any():
            out[some, k] = np.add.reduceat(values, first[:-1][some])
    return out


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in few(batches):
        texts = batch.column(1).to_pylist()
        for part in steps(texts, SIGNED_CHARS):
            words, first, shingles, owner, counts = _sets(texts[part])
            n = part.stop - part.start
            signed = signatures(shingles, owner, weights(counts), n, BANDS * ROWS)
            keys = band_keys(signed)
            same = _sequence_keys(words, first)
            some = np.diff(first) > 0
            flat = pa.array(keys[some].ravel().view(np.int64))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(part.start, n).filter(pa.array(some)),
                pa.array(same[some, 0].view(np.int64)),
                pa.array(same[some, 1].view(np.int64)),
                pa.ListArray.from_arrays(np.arange(0, len(flat) + 1, BANDS, dtype=np.int32), flat),
                pa.array([x.tobytes() for x in signed[some].astype(np.uint8)], pa.binary()),
            ], names=["id", "key_a", "key_b", "bands", "signature"])


def _pack_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in few(batches):
        texts = batch.column(1).to_pylist()
        for part in steps(texts, SIGNED_CHARS):
            _, _, shingles, owner, counts = _sets(texts[part])
            n = part.stop - part.start
            cut = np.searchsorted(owner, np.arange(n + 1))
            heavy = counts.astype("<u4")
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(part.start, n),
                pa.array([shingles[a:b].tobytes() for a, b in zip(cut, cut[1:])], pa.binary()),
                pa.array([
                    b"" if (heavy[a:b] == 1).all() else heavy[a:b].tobytes()
                    for a, b in zip(cut, cut[1:])
                ], pa.binary()),
            ], names=["id", "shingles", "counts"])


def _unpack(shingles: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    h = np.frombuffer(shingles, "<u8")
    return h, weights(np.frombuffer(counts, "<u4")) if counts else np.ones(len(h))


def _similar(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    try:
        for columns in batches:
            found = pd.Series([
                similarity(_unpack(a, m), _unpack(b, n)) >= SIMILARITY - 1e-12
                for a, m, b, n in zip(*columns)
            ], dtype=bool)
            del columns
            yield found
    finally:
        give_back()


def _alike(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Whether two signatures of one byte a component leave the threshold possible."""
    try:
        for columns in batches:
            x, y = (np.frombuffer(b"".join(s), np.uint8).reshape(len(s), -1) for s in columns)
            found = pd.Series((x == y).mean(1) >= LEAST_EQUAL, dtype=bool)
            del columns, x, y
            yield found
    finally:
        give_back()


def _both(pairs: DataFrame, facts: DataFrame) -> DataFrame:
    """``pairs(u, v)`` with the columns of ``facts`` for each end, as ``u_`` and ``v_``.

    Facts grow with the documents, so they are never broadcast.
    """
    for end in ("u", "v"):
        named = facts.select(*(F.col(c).alias(end if c == "id" else f"{end}_{c}") for c in facts.columns))
        pairs = pairs.join(named.hint("merge"), end)
    return pairs


def _verified(pairs: DataFrame, signed: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of ``pairs(u, v)`` whose exact similarity reaches the threshold."""
    alike = F.pandas_udf(_alike, BooleanType())("u_signature", "v_signature")
    hopeful = _both(pairs, signed.select("id", "signature")).filter(alike).select("u", "v")
    similar = F.pandas_udf(_similar, BooleanType())("u_shingles", "u_counts", "v_shingles", "v_counts")
    return _both(hopeful, sets).filter(similar).select("u", "v")


def linked(left: list[tuple], right: list[tuple]) -> np.ndarray:
    """Which of ``left`` and ``right``, weighted sets both, reach the threshold, as a matrix."""
    voc = np.intersect1d(np.concatenate([x[0] for x in left]), np.concatenate([x[0] for x in right]))
    size = [np.array([len(x[0]) for x in side], float) for side in (left, right)]
    plain = [np.array([(x[1] == 1).all() for x in side]) for side in (left, right)]
    shares = [np.zeros((len(left), len(right))) for _ in range(3)]
    for k in range(0, len(voc), 4096):
        part = voc[k : k + 4096]
        has, weight = [], []
        for side in (left, right):
            a, w = np.zeros((len(side), len(part)), np.float32), np.zeros((len(side), len(part)), np.float32)
            for i, (h, x) in enumerate(side):
                at = np.searchsorted(part, h)
                at[at == len(part)] = 0
                some = part[at] == h
                a[i, at[some]], w[i, at[some]] = 1, (x / x.sum())[some]
            has.append(a)
            weight.append(w)
        shares[0] += has[0] @ has[1].T
        shares[1] += weight[0] @ has[1].T
        shares[2] += has[0] @ weight[1].T
    common, by_left, by_right = shares
    out = common >= SIMILARITY * (size[0][:, None] + size[1] - common) - 1e-9
    out &= common > 0
    # The shared part of either side bounds the similarity of sets with weights.
    weighed = ~(plain[0][:, None] & plain[1])
    out[weighed] = False
    hopeful = weighed & (np.minimum(by_left, by_right) >= SIMILARITY - 1e-3)
    for i, j in np.argwhere(hopeful):
        out[i, j] = similarity(left[i], right[j]) >= SIMILARITY - 1e-12
    return out


def _compare(tile: pa.Table) -> pa.Table:
    """(u, v): which members outside the main group belong to the group named v."""
    side = tile["side"].to_numpy()
    ids, labels = tile["id"].to_numpy(), tile["label"].to_numpy()
    sets = [_unpack(*x) for x in zip(tile["shingles"].to_pylist(), tile["counts"].to_pylist())]
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    found: set[tuple[int, int]] = set()
    if len(left) and len(right):
        near = linked([sets[i] for i in left], [sets[j] for j in right])
        for i, row in zip(left, near):
            found |= {(int(ids[i]), int(v)) for v in np.unique(labels[right[row]]) if v != labels[i]}
    u, v = zip(*sorted(found)) if found else ((), ())
    return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})


def _blocks(members: DataFrame, label: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between members of one bucket that ``label`` has in different groups."""
    bucket = ["band", "value"]
    placed = members.join(label, "id", "left").select(
        *bucket, "id", F.coalesce("component_id", "id").alias("label")
    )
    sizes = placed.groupBy(*bucket, "label").agg(F.count("*").alias("n"))
    split = sizes.groupBy(*bucket).agg(
        F.max_by("label", F.struct("n", "label")).alias("main"), F.count("*").alias("labels")
    ).filter("labels > 1").drop("labels")
    open_ = materialise(
        placed.join(split, bucket).select("main", "id", "label").distinct(), "open"
    )
    ways = open_.groupBy("main").agg(
        F.ceil(F.count_if(F.col("label") != F.col("main")) / LEFT).cast("int").alias("ways"),
        F.ceil(F.count("*") / RIGHT).cast("int").alias("parts"),
    )
    sides = open_.join(ways, "main")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    tiles = sides.filter("label != main").select(
        "main", own("ways").alias("i"), every("parts").alias("j"), F.lit(0).alias("side"), "id", "label"
    ).unionByName(sides.select(
        "main", every("ways").alias("i"), own("parts").alias("j"), F.lit(1).alias("side"), "id", "label"
    ))
    return tiles.join(sets.hint("merge"), "id").groupBy("main", "i", "j").applyInArrow(
        _compare, "u long, v long"
    )


def near_duplicates(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``(id, class_id)`` for each different id: the smallest id of its group, itself included.

    Groups are the connected components of pairs whose probability Jaccard over five-word shingles
    is 0.8 or more. Texts that are equal word for word are one text from the start. NULL, empty and
    wordless texts have no partner; texts of fewer than five words have one shingle. Rows with NULL
    ids take no part and are not returned; rows that share an id count as one document.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    rows = rows.filter("id is not null")
    signed = materialise(
        rows.mapInArrow(frugal(_sign), "id long, key_a long, key_b long, bands array<long>, signature binary"), "signatures"
    )
    # Copies: one representative stands for each different sequence of words.
    groups = signed.groupBy("key_a", "key_b").agg(F.min("id").alias("first"))
    copies = materialise(
        signed.select("id", "key_a", "key_b").join(groups, ["key_a", "key_b"]).filter("id != first")
        .select(F.col("id").alias("u"), F.col("first").alias("v")), "copies"
    )
    # An id of several texts stays if one of them is the first of its kind.
    ones = signed.join(groups.select(F.col("first").alias("id")).distinct(), "id", "left_semi")
    banded = ones.select("id", F.posexplode("bands").alias("band", "value"))
    bucket = ["band", "value"]
    crowd = banded.groupBy(*bucket).agg(F.count("*").alias("n")).filter("n > 1")
    shared = materialise(banded.join(crowd, bucket), "buckets")
    heard = shared.groupBy("id").agg(F.sum("n").alias("heard"))
    pivots = shared.join(heard, "id").groupBy(*bucket).agg(
        F.max_by("id", F.struct("heard", -F.col("id"))).alias("pivot")
    )
    members = materialise(shared.join(pivots, bucket).select(*bucket, "id", "pivot"), "members")

    def distinct(pairs: DataFrame) -> DataFrame:
        ends = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
        return pairs.filter("u != v").select(*ends).distinct()

    stars = distinct(members.select(F.col("id").alias("u"), F.col("pivot").alias("v")))
    wanted = members.select("id").distinct()
    sets = materialise(
        rows.join(wanted.hint("merge"), "id", "left_semi").mapInArrow(
            frugal(_pack_sets), "id long, shingles binary, counts binary"
        ), "sets"
    )
    links = materialise(_verified(stars, signed, sets).unionByName(copies), "verified")
    more = materialise(_blocks(members, components(links), sets), "found")
    links = links.unionByName(more)
    last = components(links)
    return rows.select("id").distinct().join(last, "id", "left").select(
        "id", F.coalesce("component_id", "id").alias("class_id")
    )


def drop_near_duplicates(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The rows of ``docs`` less all but one document of each group: that with the smallest id stays.

    Of rows that share an id the one whose text sorts first stays. Rows with NULL ids all stay.
    """
    found = near_duplicates(docs, doc_id, text)
    gone = materialise(found.filter("id != class_id").select(F.col("id").alias(doc_id)), "gone")
    twice = materialise(
        docs.filter(F.col(doc_id).isNotNull()).groupBy(doc_id).agg(F.count("*").alias("n"))
        .filter("n > 1").select(doc_id), "repeated"
    )
    left = docs.join(gone, doc_id, "left_anti")
    number = free_name(docs, "_number")
    first = F.row_number().over(Window.partitionBy(doc_id).orderBy(text))
    once = left.join(twice, doc_id, "left_semi").withColumn(number, first).filter(F.col(number) == 1)
    return left.join(twice, doc_id, "left_anti").unionByName(once.drop(number)).select(docs.columns)

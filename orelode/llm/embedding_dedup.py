"""Pairs of vectors with a cosine of 0.9 or more, by a subspace pigeonhole join.

For unit vectors a cosine of c is a squared distance of ``2 - 2c``. The vectors are rotated and split
into blocks; if a pair is that near, then in some block it is no farther apart than the block's share
of the squared distance. Each block is range-joined: the first coordinate falls into cells as wide as
the block's radius, so partners lie in the same or the next cell. What passes in a block is checked by
the exact cosine. Nothing is missed, and the share of a pair belongs to the first block it passes in.

Blocks are measured on whole numbers (rotated components times 2^20), whose sums are exact in double
precision; so all tasks agree on where a pair passes.

Equal vectors are one vector with a count. Cells are cut into chunks, and tasks meet pairs of chunks.
They give counts and a spanning set of links, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orelode.llm.components import components
from orelode.llm.vectors import binary, by_dimension, is_single, matrix, unit, vector_rows
from orelode.sources.paths import materialise

COSINE = 0.9
#: Dimensions of a block.
BLOCK = 8
#: Vectors of a cell that one chunk takes, and rows and columns of one step within a task.
CHUNK, STEP = 16_384, 256
SCALE = 1 << 20
#: Squared distance added to each budget for rounding.
SLACK = 1e-4


def _blocks(d: int) -> list[tuple[int, int]]:
    return [(b, min(b + BLOCK, d)) for b in range(0, d, BLOCK)]


def _budget(width: int, d: int) -> float:
    return (2 - 2 * COSINE) * width / d + SLACK


def _rotation(d: int) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(11).standard_normal((d, d)))[0]


def _rotated(u: np.ndarray) -> np.ndarray:
    """Rotated components as whole numbers in double precision, one vector at a time alike."""
    turned = np.einsum("nd,de->ne", u, _rotation(u.shape[1]))
    return np.rint(turned * SCALE)


def _file(kind: str):
    """Each vector under its cell in each block, and as a visitor under the next one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, own in by_dimension(batch.column(2)):
                d = own.shape[1]
                turned = _rotated(unit(own))
                for number, (a, b) in enumerate(_blocks(d)):
                    # Whole numbers may round a coordinate up by half a unit at each end.
                    radius = np.sqrt(_budget(b - a, d)) * SCALE + 1
                    cell = np.floor(turned[:, a] / radius).astype(np.int64)
                    for visits in (0, 1):
                        take = pa.array(at)
                        yield pa.RecordBatch.from_arrays([
                            pa.array(np.full(len(at), d, np.int32)),
                            pa.array(np.full(len(at), number, np.int32)),
                            pa.array(cell + visits), pa.array(np.full(len(at), bool(visits))),
                            batch.column(0).take(take), batch.column(1).take(take),
                            binary(own.astype(kind)),
                        ], names=["d", "block", "cell", "visits", "vec_id", "n", "vector"])

    return run


def _labels(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group numbers of the rows and columns of a link matrix: a spanning structure of its links."""
    rows, cols = linked.shape
    left, right = np.arange(rows), np.full(cols, rows)
    while True:
        below = np.where(linked, left[:, None], rows).min(0)
        back = np.where(linked, below[None, :], rows).min(1)
        new = np.minimum(left, back)
        if (new == left).all() and (below == right).all():
            return left, right
        left, right = new, below


def _meet(kind: str):
    """Links between the chunks of a tile, counted and reduced to a spanning set."""

    def run(key: tuple, tile: pa.Table) -> pa.Table:
        d, block = key[0].as_py(), key[1].as_py()
        tile = tile.combine_chunks().sort_by([("side", "ascending"), ("vec_id", "ascending")])
        i, j = key[3].as_py(), key[4].as_py()
        ids, n = tile["vec_id"].to_numpy(), tile["n"].to_numpy()
        visits, side = tile["visits"].to_numpy(), tile["side"].to_numpy()
        own = unit(matrix(tile["vector"].combine_chunks(), kind))
        turned = _rotated(own)
        spans = _blocks(d)
        limits = [np.floor(_budget(b - a, d) * SCALE * SCALE) for a, b in spans]
        squares = [(turned[:, a:b] ** 2).sum(1) for a, b in spans]
        count = np.zeros(len(ids), np.int64)
        us, vs = [], []
        a, b = spans[block]
        here, limit = turned[:, a:b], limits[block]
        # Neighbours in three coordinates lie together, so boxes of rows are small.
        width = np.sqrt(limit) / 2
        strips = [np.floor(here[:, min(k, b - a - 1)] / width) for k in (0, 1)]
        order = np.lexsort((here[:, min(2, b - a - 1)], strips[1], strips[0]))
        first = order[side[order] == 0]
        second = first if i == j else order[side[order] == 1]
        rough = (here / SCALE).astype(np.float32)
        size, one = (rough * rough).sum(1, keepdims=True), np.ones((len(ids), 1), np.float32)
        by_row, by_col = np.hstack([-2 * rough, size, one]), np.hstack([rough, one, size])
        starts = np.arange(0, len(second), STEP)
        least, most = (f.reduceat(here[second], starts) for f in (np.minimum, np.maximum))
        for p in range(0, len(first), STEP):
            r = first[p : p + STEP]
            gap = np.maximum(0, np.maximum(here[r].min(0) - most, least - here[r].max(0)))
            meets = np.flatnonzero((gap * gap).sum(1) <= limit)
            meets = meets[meets >= p // STEP] if i == j else meets
            for k in range(0, len(meets), 8):
                c = np.concatenate([second[q * STEP : (q + 1) * STEP] for q in meets[k : k + 8]])
                # In single precision with some slack, then exactly for what is left.
                near = by_row[r] @ by_col[c].T <= np.float32(limit / SCALE**2 + 1e-5)
                if i == j and k == 0:  # rows of one box, each pair once
                    near[:, : len(r)] = np.triu(near[:, : len(r)], 1)
                if np.count_nonzero(near) > 20_000:
                    # Two visitors met in the cell they come from.
                    near &= ~(visits[r][:, None] & visits[c])
                    apart = squares[block][r][:, None] + squares[block][c] - 2 * (here[r] @ here[c].T)
                    linked = near & (apart <= limit) & (own[r] @ own[c].T >= COSINE)
                else:
                    linked = np.zeros_like(near)
                    x, y = np.nonzero(near)
                    some = ~(visits[r[x]] & visits[c[y]])
                    x, y = x[some], y[some]
                    apart = ((here[r[x]] - here[c[y]]) ** 2).sum(1)
                    some = apart <= limit
                    x, y = x[some], y[some]
                    linked[x, y] = (own[r[x]] * own[c[y]]).sum(1) >= COSINE
                some_r, some_c = linked.any(1), linked.any(0)
                if not some_r.any():
                    continue
                r2, c2 = r[some_r], c[some_c]
                linked = linked[np.ix_(some_r, some_c)]
                left, right = _labels(linked)
                us += [ids[r2], ids[c2]]
                vs += [ids[r2][left], ids[r2][right]]
                for e in range(block):
                    x, y = (turned[rows, slice(*spans[e])] for rows in (r2, c2))
                    before = squares[e][r2][:, None] + squares[e][c2] - 2 * (x @ y.T)
                    linked &= before > limits[e]
                np.add.at(count, r2, linked @ n[c2])
                np.add.at(count, c2, n[r2] @ linked)
        got = np.flatnonzero(count)
        u, v = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (us, vs))
        pairs = np.unique(np.stack([u, v], 1)[u != v], axis=0) if len(u) else np.zeros((0, 2), np.int64)
        return pa.table({
            "u": pa.array(np.concatenate([ids[got], pairs[:, 0]]), pa.int64()),
            "v": pa.array(
                np.concatenate([np.zeros(len(got), np.int64), pairs[:, 1]]), pa.int64(),
                mask=np.arange(len(got) + len(pairs)) < len(got),
            ),
            "n": pa.array(
                np.concatenate([count[got], np.zeros(len(pairs), np.int64)]), pa.int64()
            ),
        })

    return run


def near_vectors(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``(vec_id, n_links, component_id)`` for every row, links being cosines of 0.9 or more.

    NULL, zero, empty or not finite vectors link with nothing: no links, a component of their own.
    Vectors of different dimensions are never compared. A row with a NULL id takes no part and has no
    component. Rows that share an id are different vectors of one node: their links add up.
    """
    some = vector_rows(rows, vec_id, vector)
    kind = "<f4" if is_single(some) else "<f8"
    groups = materialise(
        some.groupBy("vector").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("n")), "vectors"
    )
    filed = groups.select("vec_id", "n", "vector").mapInArrow(
        _file(kind),
        "d int, block int, cell long, visits boolean, vec_id long, n long, vector binary",
    )
    cell = ["d", "block", "cell"]
    chunks = filed.groupBy(*cell).agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    mine = F.pmod(F.xxhash64("vec_id"), F.col("chunks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    placed = filed.join(chunks, cell).withColumn("mine", mine).withColumn("other", other)
    tiles = placed.select(
        *cell, F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
        (F.col("mine") > F.col("other")).cast("int").alias("side"), "visits", "vec_id", "n", "vector",
    )
    met = materialise(
        tiles.groupBy(*cell, "i", "j").applyInArrow(_meet(kind), "u long, v long, n long"), "links"
    )
    counts = met.filter("v is null").groupBy("u").agg(F.sum("n").alias("found"))
    copies = some.join(groups.withColumnRenamed("vec_id", "first"), "vector").select(
        "vec_id", "first", (F.col("n") - 1).alias("equal")
    )
    links = met.filter("v is not null").select("u", "v").unionByName(
        copies.select(F.col("vec_id").alias("u"), F.col("first").alias("v"))
    )
    parts = components(links)
    linked = copies.join(counts.withColumnRenamed("u", "first"), "first", "left").groupBy("vec_id").agg(
        F.sum(F.col("equal") + F.coalesce("found", F.lit(0))).alias("n_links")
    )
    known = rows.select(F.col(vec_id).cast("long").alias("vec_id"))
    out = known.join(linked, "vec_id", "left").join(parts.withColumnRenamed("id", "vec_id"), "vec_id", "left")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    )

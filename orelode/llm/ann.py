"""Approximate nearest neighbours by multiprobe p-stable hashing.

A table hashes a unit vector x to the cell ``floor((a_i . x + b_i) / w)`` for M normal vectors a_i.
A query visits, beside its own cell, those cells of each table that hold its neighbours with the
highest probability: perturbing hash i by -1 or +1 costs the squared distance to that wall, and sets
of perturbations are visited by ascending sum. What the visited cells of all tables hold is ranked
by the exact cosine.

Equal vectors are one entry of the index, with as many of their smallest ids as a result can show,
so a vector that makes up a third of all rows is compared once. Cells are cut into chunks; a task
meets bounded pieces only and keeps the best few of each query.
"""

from __future__ import annotations

import heapq
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orelode.llm.vectors import binary, by_dimension, is_single, matrix, unit, vector_rows
from orelode.llm.words import mix

#: Entries of a cell that one comparison takes.
CHUNK = 8192
#: Queries a task holds results for before it passes them on.
HELD = 100_000


@dataclass(frozen=True)
class Settings:
    """``tables`` of ``hashes`` functions of width ``width``, and ``probes`` cells of each."""

    tables: int = 10
    hashes: int = 6
    width: float = 1.5
    probes: int = 60
    seed: int = 7

    def functions(self, d: int) -> tuple[np.ndarray, np.ndarray]:
        rng = np.random.default_rng([self.seed, d])
        a = rng.standard_normal((d, self.tables * self.hashes))
        return a, rng.uniform(0, self.width, self.tables * self.hashes)

    def perturbations(self) -> np.ndarray:
        """Sets of at most three single steps: +1 for an upper, -1 for a lower wall, else 0."""
        moves = [np.zeros(self.hashes, np.int64)]
        for r in range(1, min(3, self.hashes) + 1):
            for where in itertools.combinations(range(self.hashes), r):
                for signs in itertools.product((-1, 1), repeat=r):
                    move = np.zeros(self.hashes, np.int64)
                    move[list(where)] = signs
                    moves.append(move)
        return np.array(moves)


def _codes(cells: np.ndarray, dimension: int) -> np.ndarray:
    """One number per cell, of coordinates along the last axis; vectors of two dimensions share none."""
    code = mix(np.full(cells.shape[:-1], dimension, np.uint64))
    for k in range(cells.shape[-1]):
        code = mix(code + cells[..., k].astype(np.uint64) + np.uint64(k + 1))
    return code.view(np.int64)


def _hashed(settings: Settings, query: bool, single: bool):
    """Rows of (table, code, vec_id, ids, vector) for the index, or for the cells a query visits."""
    moves = settings.perturbations()
    kind = "<f4" if single else "<f8"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, own in by_dimension(batch.column(2)):
                for begin in range(0, len(at), 2000):
                    rows, part = at[begin : begin + 2000], own[begin : begin + 2000]
                    a, b = settings.functions(part.shape[1])
                    places = (unit(part) @ a + b) / settings.width
                    places = places.reshape(len(part), settings.tables, settings.hashes)
                    cells = np.floor(places).astype(np.int64)
                    yield from (probed if query else filed)(batch, rows, part, places, cells)

    def filed(batch, rows, part, places, cells):
        n, t = cells.shape[:2]
        yield emit(batch, np.repeat(rows, t), np.repeat(part, t, 0),
                   np.tile(np.arange(t), n), _codes(cells, part.shape[1]).ravel())

    def probed(batch, rows, part, places, cells):
        low = (places - cells) ** 2  # squared distance to the lower wall, then to the upper
        cost = np.einsum("nth,mh->ntm", low, moves == -1) + np.einsum(
            "nth,mh->ntm", (1 - places + cells) ** 2, moves == 1
        )
        count = min(settings.probes, len(moves))
        best = np.argpartition(cost, count - 1, axis=2)[:, :, :count]
        n, t = cells.shape[:2]
        codes = _codes(cells[:, :, None, :] + moves[best], part.shape[1])
        yield emit(batch, np.repeat(rows, t * count), np.repeat(part, t * count, 0),
                   np.tile(np.repeat(np.arange(t), count), n), codes.ravel())

    def emit(batch, rows, vectors, table, code):
        take = pa.array(rows)
        return pa.RecordBatch.from_arrays([
            pa.array(table, pa.int32()), pa.array(code), batch.column(0).take(take),
            batch.column(1).take(take), binary(vectors.astype(kind)),
        ], names=["table", "code", "vec_id", "ids", "vector"])

    return run


def nearest(
    rows: DataFrame, vec_id: str, vector: str, queries: str, k: int = 5,
    settings: Settings | None = None,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest found of each row that ``queries`` picks.

    ``queries`` is SQL over ``vec_id``. The measure is the cosine in double precision, ties go to the
    smaller id, a row is never its own neighbour; rows that share an id are one row, of which the smallest vector
    (compared component by component) counts. NULL ids, and
    vectors that are NULL, zero, empty or not finite, take no part. Vectors of different dimensions are
    never compared. Queries without any candidate have no rows, so an empty table gives none.
    """
    settings = settings or Settings()
    rows = vector_rows(rows, vec_id, vector)
    # One vector an id, the same whichever row comes first.
    rows = rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))
    single = is_single(rows)
    kind = "<f4" if single else "<f8"
    order = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    entries = (
        rows.withColumn("n", order).filter(F.col("n") <= k + 1)
        .groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .select(F.col("ids")[0].alias("vec_id"), "ids", "vector")
    )
    asked = rows.filter(queries).select("vec_id", F.array().cast("array<long>").alias("ids"), "vector")
    schema = "table int, code long, vec_id long, ids array<long>, vector binary"
    index = entries.mapInArrow(_hashed(settings, False, single), schema)
    probes = asked.mapInArrow(_hashed(settings, True, single), schema)
    # Hashing makes hundreds of rows of one, which Spark's sizes do not tell: merged, none of them go to the driver.
    cells = index.groupBy("table", "code").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks")).hint("merge")
    spread = F.col("chunks") > 1
    index = index.join(cells, ["table", "code"]).select(
        "table", "code",
        F.when(spread, F.pmod(F.xxhash64("vec_id"), "chunks")).otherwise(0).cast("int").alias("chunk"),
        F.lit(0).alias("asks"), "vec_id", "ids", "vector",
    )
    probes = probes.join(cells, ["table", "code"]).select(
        "table", "code", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
        F.lit(1).alias("asks"), "vec_id", "ids", "vector",
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[float, int]]] = {}
        names: dict[int, list[int]] = {}

        def passed() -> pa.RecordBatch:
            flat = [(q, s, names[v]) for q, found in held.items() for s, v in _top(found, k)]
            held.clear(), names.clear()
            return pa.RecordBatch.from_arrays([
                pa.array([f[0] for f in flat], pa.int64()), pa.array([f[1] for f in flat], pa.float64()),
                pa.array([f[2] for f in flat], pa.list_(pa.int64())),
            ], names=["query_id", "score", "ids"])

        def meet(entries: list[pa.RecordBatch], asks: pa.RecordBatch) -> None:
            table = pa.Table.from_batches(entries)
            whole = [c.combine_chunks() for c in (table["vec_id"], table["ids"], table["vector"])]
            own, ids = matrix(_whole(whole[2]), kind), _whole(whole[0]).to_pylist()
            with_ids = _whole(whole[1])
            for begin in range(0, asks.num_rows, 256):
                part = asks.slice(begin, 256)
                wanted = matrix(part["vector"], kind)
                if wanted.shape[1] != own.shape[1]:
                    return
                a, b = unit(wanted), unit(own)
                near = a @ b.T
                m = min(k + 1, len(own))
                best = np.argpartition(-near, m - 1, axis=1)[:, :m]
                # Again pair by pair, so that a pair has the same score wherever it is found.
                score = np.clip((a[:, None, :] * b[best]).sum(2), -1, 1)
                for q, row, scores in zip(part["vec_id"].to_pylist(), best.tolist(), score.tolist()):
                    kept = held.setdefault(q, [])
                    kept += [(s, ids[v]) for s, v in zip(scores, row)]
                    if len(kept) > 8 * k:
                        kept[:] = _top(kept, k)
                    for v in row:
                        if ids[v] not in names:
                            names[ids[v]] = with_ids[v].as_py()

        group, entries = None, []
        for batch in batches:
            for key, asks, part in _runs(batch):
                if key != group:
                    group, entries = key, []
                if not asks:
                    entries.append(part)
                elif entries:
                    meet(entries, part)
            if len(held) > HELD:
                yield passed()
        if held:
            yield passed()

    tiles = index.unionByName(probes).repartition("table", "code", "chunk").sortWithinPartitions(
        "table", "code", "chunk", "asks"
    )
    found = tiles.mapInArrow(compare, "query_id long, score double, ids array<long>")
    each = (
        found.groupBy("query_id", F.col("ids")[0].alias("entry"))
        .agg(F.max("score").alias("score"), F.first("ids").alias("ids"))
        .select("query_id", "score", F.explode("ids").alias("vec_id"))
        .filter("vec_id != query_id")
    )
    rank = F.row_number().over(
        Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    )
    return each.withColumn("rank", rank).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def _whole(column):
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _top(found: list[tuple[float, int]], k: int) -> list[tuple[float, int]]:
    """The best ``k + 1`` different entries: one may be the query's own vector."""
    return heapq.nsmallest(k + 1, set(found), key=lambda x: (-x[0], x[1]))


def _runs(batch: pa.RecordBatch):
    """The stretches of a sorted batch that share cell and side."""
    keys = [batch.column(c).to_numpy(zero_copy_only=False) for c in range(4)]
    if not batch.num_rows:
        return
    change = np.zeros(batch.num_rows, bool)
    for x in keys:
        change[1:] |= x[1:] != x[:-1]
    starts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
    for a, b in zip(starts, starts[1:]):
        yield (keys[0][a], keys[1][a], keys[2][a]), bool(keys[3][a]), batch.slice(a, b - a)

"""Tables kept as plain parquet: a change feed plus, now and then, a snapshot.

A batch appends its after-images under ``changes/_batch_id=n`` and touches nothing else, so its
cost follows the batch, a retry overwrites its own folder, and no file being read is ever replaced.
Every ``snapshot_every`` batches the state is written out under ``snapshot/_through=n``.

With ``buckets`` both are laid out by a hash of the key. A batch then reads only the folders of the buckets
its keys fall into, and a snapshot rewrites only the buckets that changed since the one before: each
bucket has a newest snapshot of its own, and the feed after it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orelode.operators.changes import BATCH, net_changes
from orelode.operators.merge import ACTION, apply_changes
from orelode.operators.sizes import weighed
from orelode.sources.paths import compact_write, complete_batches, file_stream, numbered, remove

BUCKET = "_bucket"


def bucket_of(key: str, buckets: int) -> Column:
    """The bucket of a key: the same on every run; NULL has one as well."""
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class ChangeTable:
    spark: SparkSession
    path: str
    schema: str
    key: str
    insert_only: bool = False
    snapshot_every: int = 16
    buckets: int = 0

    @property
    def feed_schema(self) -> str:
        return f"{self.schema}, {ACTION} string"

    @property
    def _columns(self) -> list[str]:
        return StructType.fromDDL(self.schema).fieldNames()

    def _snapshots(self) -> list[int]:
        return complete_batches(self.spark, f"{self.path}/snapshot", "_through")

    def _batches(self) -> list[int]:
        return complete_batches(self.spark, f"{self.path}/changes", BATCH)

    def is_new(self, batch_id: int) -> bool:
        """No batch before this one wrote anything."""
        return not any(n < batch_id for n in (*self._snapshots(), *self._batches()))

    def _write(self, rows: DataFrame, path: str) -> None:
        if self.buckets:
            # Adaptive execution cuts a large bucket into several files and puts small ones together.
            rows = rows.withColumn(BUCKET, bucket_of(self.key, self.buckets)).hint("rebalance", BUCKET)
            compact_write(rows).partitionBy(BUCKET).parquet(path)
        else:
            compact_write(rows).parquet(path)

    def write_changes(self, changes: DataFrame, batch_id: int) -> None:
        self._write(changes, f"{self.path}/changes/{BATCH}={batch_id}")

    def write_snapshot(self, state: DataFrame, through: int) -> None:
        self._write(state, f"{self.path}/snapshot/_through={through}")

    def compact(self, batch_id: int) -> None:
        """Snapshot what changed before ``batch_id`` once enough batches have gathered."""
        done = max((s for s in self._snapshots() if s < batch_id), default=None)
        since = [b for b in self._batches() if (done is None or b > done) and b < batch_id]
        if len(since) < self.snapshot_every:
            return
        changed = None
        if self.buckets:
            changed = {b for n in since for b in self._buckets_in("changes", BATCH, n)}
        self.write_snapshot(self._state(batch_id, changed), since[-1])

    def _buckets_in(self, kind: str, prefix: str, n: int) -> list[int]:
        return numbered(self.spark, f"{self.path}/{kind}/{prefix}={n}", BUCKET)

    def touched(self, keys: DataFrame) -> set[int] | None:
        """The buckets that ``keys`` (a column of key values) fall into: so many numbers at most."""
        if not self.buckets:
            return None
        return {r[0] for r in keys.select(bucket_of(keys.columns[0], self.buckets)).distinct().collect()}

    def feed(self, batches: list[int], buckets: list[tuple[int, int]] | None = None) -> DataFrame:
        """The change rows of the given batches, with their batch number; or of (batch, bucket) pairs."""
        root = f"{self.path}/changes"
        reader = self.spark.read.schema(f"{self.feed_schema}, {BATCH} bigint{self._layout}")
        if buckets is None:
            paths = [f"{root}/{BATCH}={b}" for b in batches]
        else:
            paths = [f"{root}/{BATCH}={n}/{BUCKET}={b}" for n, b in buckets]
        return reader.option("basePath", root).parquet(*paths).drop(BUCKET)

    @property
    def _layout(self) -> str:
        return f", {BUCKET} int" if self.buckets else ""

    def feed_stream(self) -> DataFrame:
        """The change feed as a stream; every batch is seen once per checkpoint."""
        return file_stream(self.spark).schema(f"{self.feed_schema}, {BATCH} bigint{self._layout}").parquet(
            f"{self.path}/changes"
        ).drop(BUCKET)

    def state(
        self, before: int | None = None, touching: DataFrame | None = None, rows: int | None = None
    ) -> DataFrame:
        """The table as of all committed batches, or those before a given one.

        ``touching`` (distinct values of one column, ``rows`` at most; counted if not given) limits the
        state to rows with those values. Where the column is the key it meets the files first: if it is
        small Spark broadcasts it, and neither the snapshot nor the feed is shuffled. For any other column
        a row's newest image decides, so first the keys are found that had such a value in any image.
        """
        if touching is not None:
            touching = weighed(touching, touching.count() if rows is None else rows)
        if touching is not None and touching.columns != [self.key]:
            images = [df for df in self._images(before) if df is not None]
            if not images:
                return self.spark.createDataFrame([], self.schema)
            column = touching.columns[0]
            keys = reduce(DataFrame.unionByName, [df.select(self.key, column) for df in images])
            keys = keys.join(touching, column, "left_semi").select(self.key).distinct()
            return self.state(before, keys).join(touching, column, "left_semi").select(*self._columns)

        return self._state(before, None if touching is None else self.touched(touching), touching, rows)

    def _state(
        self, before: int | None, buckets: set[int] | None, touching: DataFrame | None = None,
        rows: int | None = None,
    ) -> DataFrame:
        def limited(df: DataFrame) -> DataFrame:
            return df if touching is None else df.join(touching, self.key, "left_semi")

        base, first, feed = self._images(before, not self.insert_only, buckets)
        if base is None and first is not None:
            base, first = first, None
        if base is not None:
            base = limited(base).select(*self._columns)
        if feed is None:
            return base if base is not None else self.spark.createDataFrame([], self.schema)
        if rows is None and base is not None and not self.insert_only:
            rows = feed.count()  # of the files' footers
        feed = limited(feed)
        if not self.insert_only:
            feed = net_changes(feed, self.key)
        feed = feed.select(*self._columns)
        if base is None:
            return feed
        return base.unionByName(feed) if self.insert_only else apply_changes(base, feed, self.key, rows or 0)

    def _images(
        self, before: int | None, split_first: bool = False, buckets: set[int] | None = None
    ) -> tuple[DataFrame | None, DataFrame | None, DataFrame | None]:
        """The newest snapshot, the first batch if it met an empty table, and the later feed."""

        def in_scope(n: int) -> bool:
            return before is None or n < before

        if self.buckets:
            return self._bucket_images(in_scope, buckets)
        snapshot = max(filter(in_scope, self._snapshots()), default=None)
        batches = [b for b in self._batches() if in_scope(b) and (snapshot is None or b > snapshot)]
        base = first = None
        if snapshot is not None:
            base = self.spark.read.schema(self.schema).parquet(f"{self.path}/snapshot/_through={snapshot}")
        elif batches and split_first:
            # It met an empty table: its rows are the state it left.
            first, batches = self.feed(batches[:1]), batches[1:]
        return base, first, self.feed(batches) if batches else None

    def _newest(self, in_scope: Callable[[int], bool]) -> dict[int, int]:
        """Each bucket's newest snapshot."""
        snapshots = sorted(filter(in_scope, self._snapshots()))
        return {b: s for s in snapshots for b in self._buckets_in("snapshot", "_through", s)}

    def _bucket_images(
        self, in_scope: Callable[[int], bool], buckets: set[int] | None
    ) -> tuple[DataFrame | None, None, DataFrame | None]:
        """Only the folders of ``buckets`` are listed and read, each from its own newest snapshot on."""
        newest = {b: s for b, s in self._newest(in_scope).items() if buckets is None or b in buckets}
        through = max(filter(in_scope, self._snapshots()), default=-1)
        # What a snapshot did not rewrite had not changed, so the feed counts from the last one.
        batches = [n for n in self._batches() if in_scope(n) and n > through]
        parts = [
            (n, b) for n in batches for b in self._buckets_in("changes", BATCH, n) if buckets is None or b in buckets
        ]
        base = None
        if newest:
            root = f"{self.path}/snapshot"
            reader = self.spark.read.schema(f"{self.schema}, _through bigint{self._layout}")
            paths = [f"{root}/_through={s}/{BUCKET}={b}" for b, s in sorted(newest.items())]
            base = reader.option("basePath", root).parquet(*paths).drop("_through", BUCKET)
        return base, None, self.feed([], parts) if parts else None

    def forget(self, before: int) -> list[str]:
        """Remove what neither a state nor a reader needs: change folders below ``before`` that a
        snapshot covers, and snapshots older than that. Returns the folders removed.

        ``before`` is the first batch that some reader has yet to take.
        """
        kept = max((s for s in self._snapshots() if s < before), default=None)
        if kept is None:
            return []
        needed = set(self._newest(lambda s: s <= kept).values()) if self.buckets else {kept}
        old = [f"{self.path}/snapshot/_through={s}" for s in self._snapshots() if s < kept and s not in needed]
        old += [f"{self.path}/changes/{BATCH}={b}" for b in self._batches() if b <= kept]
        for folder in old:
            remove(self.spark, folder)
        return old

"""Bronze, silver and gold loads over files and change tables.

Every load is a file-source stream run with ``availableNow`` and ``foreachBatch``: the checkpoint
remembers what was consumed, and all a micro-batch writes is keyed by its number, so a batch that
is run again overwrites its own output. Within a batch the quarantine is written before the
changes; the checkpoint commits last.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from orelode.functions.dates import ntz
from orelode.operators.changes import BATCH, net_changes
from orelode.operators.dedup import latest_per_key
from orelode.operators.dense import dense_keys
from orelode.operators.keys import assign_keys
from orelode.operators.merge import ACTION, INSERT, MergeRule, duplicate_keys, insert_all, merge_changes
from orelode.operators.quality import DQ_SCHEMA, quarantined
from orelode.operators.scd2 import scd2_changes, unknown_member
from orelode.operators.sizes import weighed
from orelode.plans.audit import AuditLog, Step, observe_actions, observe_verdicts
from orelode.plans.gold import customer_source, dim_date, fact_source, product_source
from orelode.plans.silver import silver_source, tag
from orelode.plans.views import publish_views
from orelode.sources.bronze import BRONZE_SCHEMA, bronze_rows, file_manifest, file_names, read_raw
from orelode.sources.history import HISTORY_SCHEMA, unloaded_files
from orelode.sources.paths import compact_write, complete_batches, exists, file_stream, remove
from orelode.sources.tables import ChangeTable
from orelode.specs import (
    DIM_CUSTOMERS, DIM_PRODUCTS, DIMENSIONS, ENTITIES, FACTS, INGESTION, DimSpec, EntitySpec,
    FactSpec, IngestEntry,
)

#: The parent that an entity's rows need, and the column that names it in both.
PARENTS = {
    "order_items": ("orders", "order_id"),
    "payments": ("orders", "order_id"),
    "shipments": ("orders", "order_id"),
    "addresses": ("customers", "customer_id"),
}
BRONZE_COLUMNS = ("payload", "ingestion_ts", "source_file")
BatchFn = Callable[[DataFrame, int], None]


class AmbiguousSource(ValueError):
    """A merge source holds a key more than once."""


@dataclass(frozen=True)
class Options:
    strict_quality: bool = False
    scd2_mode: str = "versioned"
    one_default_address: bool = False
    parallel: int = 8  # loads of independent tables run at the same time
    max_files: int = 1000  # raw files per bronze micro-batch
    snapshot_every: int = 16
    hold_orphans: bool = False  # children wait outside silver until their parent is there
    buckets: int = 0  # key buckets that tables are laid out by; 0: none
    dense_keys: bool = False  # facts are numbered without gaps, new rows only
    load_history: bool = False  # raw files are known by name, time and length, not by name alone


_RANGES = "_from string, _low bigint, _high bigint"


def _joined(ranges: DataFrame) -> DataFrame:
    """Ranges of whole numbers per table, those that touch made one."""
    w = Window.partitionBy("_from").orderBy("_low")
    before = F.max("_high").over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = ranges.withColumn("_new", F.coalesce((F.col("_low") > before + 1).cast("int"), F.lit(1)))
    marked = marked.withColumn("_range", F.sum("_new").over(w))
    return marked.groupBy("_from", "_range").agg(
        F.min("_low").alias("_low"), F.max("_high").alias("_high")
    ).drop("_range")


class Medallion:
    """All tables under one root folder, and the loads between them."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        landing: str | None = None,
        ingestion: tuple[IngestEntry, ...] = INGESTION,
        options: Options = Options(),
    ):
        self.spark, self.root, self.options, self.ingestion = spark, root.rstrip("/"), options, ingestion
        self.landing = (landing or f"{self.root}/landing").rstrip("/")

    # Tables ---------------------------------------------------------------------------------

    def bronze_path(self, entity: str) -> str:
        return f"{self.root}/bronze/{entity}"

    def bronze(self, entity: str) -> DataFrame:
        path = self.bronze_path(entity)
        done = complete_batches(self.spark, path, BATCH)
        if not done:
            return self.spark.createDataFrame([], BRONZE_SCHEMA)
        return self.spark.read.schema(BRONZE_SCHEMA).parquet(*(f"{path}/{BATCH}={b}" for b in done))

    def silver(self, entity: str) -> ChangeTable:
        s = ENTITIES[entity]
        return ChangeTable(
            self.spark, f"{self.root}/silver/{entity}", s.schema, s.key, s.insert_only,
            self.options.snapshot_every, self.options.buckets,
        )

    def gold(self, name: str) -> ChangeTable:
        spec: DimSpec | FactSpec = DIMENSIONS.get(name) or FACTS[name]
        key = spec.surrogate if name in DIMENSIONS else spec.key
        return ChangeTable(
            self.spark, f"{self.root}/gold/{name}", spec.schema, key,
            name in FACTS and FACTS[name].insert_only, self.options.snapshot_every,
            self.options.buckets,
        )

    def dim_date(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/gold/dim_date")

    def dq_errors(self, entity: str | None = None) -> DataFrame:
        paths = [
            f"{self.root}/common/dq_errors/{e}/{BATCH}={b}"
            for e in ([entity] if entity else ENTITIES)
            for b in complete_batches(self.spark, f"{self.root}/common/dq_errors/{e}", BATCH)
        ]
        if not paths:
            return self.spark.createDataFrame([], DQ_SCHEMA)
        return self.spark.read.schema(DQ_SCHEMA).parquet(*paths)

    def manifest(self, entity: str) -> DataFrame:
        path = f"{self.root}/common/manifest/{entity}"
        done = complete_batches(self.spark, path, BATCH)
        schema = "source_file string, rows_loaded bigint"
        if not done:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{path}/{BATCH}={b}" for b in done))

    def loaded_files(self, entity: str) -> DataFrame:
        """The raw files that were loaded, as they were then, where ``load_history`` is set."""
        path = self._history_path(entity)
        done = complete_batches(self.spark, path, BATCH)
        if not done:
            return self.spark.createDataFrame([], HISTORY_SCHEMA)
        return self.spark.read.schema(HISTORY_SCHEMA).parquet(*(f"{path}/{BATCH}={b}" for b in done))

    def _history_path(self, entity: str) -> str:
        return f"{self.root}/common/load_history/{entity}"

    def audit(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/common/etl_logs")

    # Running --------------------------------------------------------------------------------

    def _run(self, stream: DataFrame, fn: BatchFn, name: str) -> None:
        query = (
            stream.writeStream.foreachBatch(fn)
            .option("checkpointLocation", f"{self.root}/checkpoints/{name}")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()

    def _staged(self, df: DataFrame, name: str, batch_id: int) -> DataFrame:
        """An intermediate table of one batch, replaced if the batch is run again."""
        path = f"{self.root}/staging/{name}/{batch_id}"
        compact_write(df).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _fresh(self, batch: DataFrame, name: str, batch_id: int) -> tuple[DataFrame, int, int]:
        """The rows of upstream batches that no earlier batch of this reader has taken.

        With it come the number of these rows and of the upstream batches (0 if rows have no such number).

        A file stream knows files; an upstream batch that was written again has new ones. So readers
        go by batch number: what a batch takes is marked, under its own number, before it writes.
        """
        source = [c for c in ("_from", BATCH) if c in batch.columns]
        if not source:
            return batch, batch.count(), 0
        table = F.col("_from") if "_from" in source else F.lit("")
        marks = f"{self.root}/consumed/{name}"
        done = [b for b in complete_batches(self.spark, marks, "_reader") if b < batch_id]
        taken = batch.groupBy(table.alias("_from"), BATCH).agg(F.count(F.lit(1)).alias("_rows"))
        if done:
            # All that earlier batches took, as ranges of numbers: a row or two per upstream table.
            old = self.spark.read.schema(_RANGES).parquet(f"{marks}/_reader={done[-1]}")
            o = old.select(F.col("_from").alias("_o"), "_low", "_high")
            covered = (F.col("_from") == F.col("_o")) & F.col(BATCH).between(F.col("_low"), F.col("_high"))
            taken = taken.join(o, covered, "left_anti")
        new = self._staged(taken.coalesce(1), f"taken/{name}", batch_id)
        ranges = new.select("_from", F.col(BATCH).alias("_low"), F.col(BATCH).alias("_high"))
        _joined(old.unionByName(ranges) if done else ranges).coalesce(1).write.mode("overwrite").parquet(f"{marks}/_reader={batch_id}")
        # A batch run again reads the marks before its own, so the last two folders are needed.
        for n in done[:-2]:
            remove(self.spark, f"{marks}/_reader={n}")
        rows, batches = new.agg(F.sum("_rows"), F.count(F.lit(1))).first()
        return batch.join(new, source, "left_semi") if done else batch, rows or 0, batches

    def _net(self, batch: DataFrame, table: ChangeTable, batches: int) -> DataFrame:
        """The last image per key; a single batch of a table's feed holds each key once."""
        return batch if table.insert_only or batches == 1 else net_changes(batch, table.key)

    def _all(self, loads: list[Callable[[], None]]) -> None:
        """Run independent loads; the first failure is raised once the running ones are done."""
        if self.options.parallel <= 1:
            for load in loads:
                load()
            return
        with ThreadPoolExecutor(self.options.parallel) as pool:
            for done in [pool.submit(load) for load in loads]:
                done.result()

    def _layer(self, layer: str, log: AuditLog, groups: list[list[Callable[[], None]]]) -> None:
        try:
            with log.step(layer, "MASTER", None, "FINISH", f"{layer.title()} layer completed"):
                for group in groups:
                    self._all(group)
        finally:
            log.flush()

    def _log(self, run_id: str) -> AuditLog:
        return AuditLog(self.spark, f"{self.root}/common/etl_logs", run_id)

    def run(self, run_id: str, load_ts: str) -> None:
        """Bronze, then silver, then gold; a failing layer stops the run."""
        self.load_bronze(run_id, load_ts)
        self.load_silver(run_id, load_ts)
        self.load_gold(run_id, load_ts)

    # Single loads ---------------------------------------------------------------------------

    def load_entity(self, entity: str, run_id: str, load_ts: str) -> None:
        """One silver table."""
        self._alone(run_id, lambda log: self._silver(ENTITIES[entity], log, run_id, load_ts))

    def load_dim(self, name: str, run_id: str, load_ts: str) -> None:
        """One dimension."""
        self._seed()
        if name == DIM_PRODUCTS.name:
            self._alone(run_id, self._dim_products)
        elif name == DIM_CUSTOMERS.name:
            self._alone(run_id, lambda log: self._dim_customers(log, load_ts))
        else:
            raise ValueError(f"unknown dimension {name!r}")

    def load_fact(self, name: str, run_id: str, load_ts: str) -> None:
        """One fact."""
        self._seed()
        self._alone(run_id, lambda log: self._fact(FACTS[name], log, load_ts))

    def _alone(self, run_id: str, load: Callable[[AuditLog], None]) -> None:
        log = self._log(run_id)
        try:
            load(log)
        finally:
            log.flush()

    def publish(self, role: str) -> dict[str, DataFrame]:
        """The reporting views over the current star schema, masked for ``role``."""
        return publish_views({n: self.gold(n).state() for n in (*DIMENSIONS, *FACTS)}, role)

    # Bronze ---------------------------------------------------------------------------------

    def load_bronze(self, run_id: str, load_ts: str) -> None:
        log = self._log(run_id)
        active = [e for e in self.ingestion if e.is_active]
        self._layer("BRONZE", log, [[lambda e=e: self._bronze(e, log, load_ts) for e in active]])

    def _bronze(self, entry: IngestEntry, log: AuditLog, load_ts: str) -> None:
        path = f"{self.landing}/{entry.path}"
        info = {
            "load_strategy": "INGEST_COPY", "source_obj": path, "business_key": "filename",
            "description": "Raw file ingestion",
            "manifest": f"{self.root}/common/manifest/{entry.entity}",
        }
        with log.step("BRONZE", "LOAD_BRONZE", entry.entity.upper(), "COPY", "Files landed", info) as step:
            step.add(processed_files=0)
            if not exists(self.spark, path):
                return
            if self.options.load_history:
                self._load_unloaded(entry, step, load_ts, path)
                return
            names = file_names(self.spark, path, self.options.max_files)
            self._run(names, self._bronze_batch(entry, step, load_ts), f"bronze_{entry.entity}")

    def _load_unloaded(self, entry: IngestEntry, step: Step, load_ts: str, path: str) -> None:
        """Load files that the history does not hold as they are, a batch at a time.

        The history is written last: what died before it is done again under the same number. A file that
        changes after it was listed stands in the history as listed, so it loads once more.
        """
        write, history = self._bronze_batch(entry, step, load_ts), self._history_path(entry.entity)
        while True:
            done = complete_batches(self.spark, history, BATCH)
            batch_id = done[-1] + 1 if done else 0
            new = unloaded_files(self.spark, path, self.loaded_files(entry.entity), self.options.max_files)
            files = self._staged(new, f"files/{entry.entity}", batch_id)
            if files.isEmpty():
                return
            write(files.select("path"), batch_id)
            files.write.mode("overwrite").parquet(f"{history}/{BATCH}={batch_id}")

    def _bronze_batch(self, entry: IngestEntry, step: Step, load_ts: str) -> BatchFn:
        def write(names: DataFrame, batch_id: int) -> None:
            # As many names as a batch may have files.
            batch = read_raw(names.sparkSession, [r[0] for r in names.collect()], entry.layout)
            seen = Observation(f"bronze_{entry.entity}_{batch_id}")
            watched = batch.observe(
                seen,
                F.count("payload").alias("good"),
                F.count(F.when(F.col("payload").isNull(), 1)).alias("bad"),
            )
            out = f"{self.bronze_path(entry.entity)}/{BATCH}={batch_id}"
            compact_write(bronze_rows(watched, ntz(load_ts))).parquet(out)
            files = f"{self.root}/common/manifest/{entry.entity}/{BATCH}={batch_id}"
            landed = batch.sparkSession.read.schema(BRONZE_SCHEMA).parquet(out)
            file_manifest(landed).write.mode("overwrite").parquet(files)
            counts = seen.get
            # The names stay in the manifest: the log holds their number.
            loaded = batch.sparkSession.read.parquet(files).count()
            step.add(rows=counts["good"], bad_records=counts["bad"], processed_files=loaded)
            if counts["bad"]:
                per_file = batch.groupBy("source_file").agg(F.count("payload").alias("n"))
                lost = per_file.where("n = 0").count()
                if lost:
                    step.add(unreadable_files=lost)
                    step.fault = f"{step.info['unreadable_files']} files without a readable record"

        return write

    # Silver ---------------------------------------------------------------------------------

    def load_silver(self, run_id: str, load_ts: str) -> None:
        log = self._log(run_id)
        held = PARENTS if self.options.hold_orphans else {}
        groups = [[s for n, s in ENTITIES.items() if n not in held], [ENTITIES[n] for n in held]]
        self._layer(
            "SILVER", log, [[lambda s=s: self._silver(s, log, run_id, load_ts) for s in group] for group in groups]
        )

    def _silver(self, spec: EntitySpec, log: AuditLog, run_id: str, load_ts: str) -> None:
        info = {
            "load_strategy": spec.strategy, "source_obj": f"bronze.{spec.name}", "business_key": spec.key,
            "description": "Insert unseen keys" if spec.insert_only else "Newest image per key",
        }
        name = spec.name.upper()
        step_name = "INSERT" if spec.insert_only else "MERGE"
        with log.step("SILVER", name, name, step_name, "Merge done", info) as step:
            path = self.bronze_path(spec.name)
            if not exists(self.spark, path):
                return
            stream = file_stream(self.spark).schema(f"{BRONZE_SCHEMA}, {BATCH} bigint").parquet(path)
            if self.options.hold_orphans and spec.name in PARENTS:
                parent = self.silver(PARENTS[spec.name][0])
                stream = stream.withColumn("_from", F.lit(spec.name))
                if exists(self.spark, f"{parent.path}/changes"):
                    # New parents make a batch too, be there new children or not.
                    arrived = parent.feed_stream().select(BATCH, F.lit("parents").alias("_from"))
                    stream = stream.unionByName(arrived, allowMissingColumns=True)
            self._run(stream, self.silver_batch(spec, step, run_id, load_ts), f"silver_{spec.name}")

    def silver_batch(self, spec: EntitySpec, step: Step, run_id: str, load_ts: str) -> BatchFn:
        table = self.silver(spec.name)
        rule = MergeRule.for_entity(spec)

        def write(batch: DataFrame, batch_id: int) -> None:
            batch, *_ = self._fresh(batch, f"silver/{spec.name}", batch_id)
            if "_from" in batch.columns:
                batch = batch.where(F.col("_from") == spec.name)
            tagged = tag(batch.select(*BRONZE_COLUMNS), spec, self.options.strict_quality)
            watched, verdicts = observe_verdicts(tagged, f"dq_{spec.name}_{batch_id}")
            errors = f"{self.root}/common/dq_errors/{spec.name}/{BATCH}={batch_id}"
            compact_write(quarantined(watched, spec, run_id, ntz(load_ts))).parquet(errors)
            table.compact(batch_id)
            # Read a second time rather than cached: a first load may exceed the executors' disks.
            source = silver_source(tagged, spec)
            if self.options.hold_orphans and spec.name in PARENTS:
                source = self._with_parents(source, spec, batch_id)
            if table.is_new(batch_id):
                changes = insert_all(source, rule, ntz(load_ts))
            else:
                # Stored, the source serves twice (keys to look for, rows to merge) at a known size.
                source = self._staged(source, f"silver/{spec.name}", batch_id)
                rows = source.count()
                # One row a key on both sides: the target has as many at most.
                target = weighed(table.state(batch_id, source.select(spec.key), rows), rows)
                changes = merge_changes(target, source, rule, ntz(load_ts))
            changes, actions = observe_actions(changes, f"merge_{spec.name}_{batch_id}")
            table.write_changes(changes, batch_id)
            v, a = verdicts.get, actions.get
            step.add(
                rows=a["inserted"] + a["updated"], errors=v["rejected"],
                inserted=a["inserted"], updated=a["updated"], undecided=v["undecided"],
            )

        return write

    def waiting(self, entity: str, before: int | None = None) -> DataFrame:
        """The rows of an entity that wait for their parent, as of its last batch or one before ``before``."""
        path = f"{self.root}/waiting/{entity}"
        done = [b for b in complete_batches(self.spark, path, BATCH) if before is None or b < before]
        schema = self.silver(entity).schema
        if not done:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{path}/{BATCH}={done[-1]}")

    def _with_parents(self, source: DataFrame, spec: EntitySpec, batch_id: int) -> DataFrame:
        """New and waiting rows whose parent is there; the others are written to wait for the next batch.

        Of a new and a waiting image of one key the newer stays, as within a batch. A row without reference
        waits for nobody. Each batch replaces the rows that wait, so one that is accepted is accepted once.
        """
        parent, column = PARENTS[spec.name]
        rows = latest_per_key(source.unionByName(self.waiting(spec.name, batch_id).select(*source.columns)), spec)
        rows = self._staged(rows, f"candidates/{spec.name}", batch_id)
        wanted = rows.where(F.col(column).isNotNull()).select(column).distinct()
        count = rows.count()
        known = weighed(self.silver(parent).state(touching=wanted, rows=count).select(column), count)
        orphans = rows.where(F.col(column).isNotNull()).join(known, column, "left_anti").select(*source.columns)
        compact_write(orphans).parquet(f"{self.root}/waiting/{spec.name}/{BATCH}={batch_id}")
        held = self.waiting(spec.name, batch_id + 1).select(spec.key)
        held = weighed(held, held.count())
        # Against what was written to wait, by key: a row is in one of the two, whatever arrives meanwhile.
        same = F.col(spec.key).eqNullSafe(F.col("_held"))
        return rows.join(held.withColumnRenamed(spec.key, "_held"), same, "left_anti")

    # Gold -----------------------------------------------------------------------------------

    def load_gold(self, run_id: str, load_ts: str) -> None:
        log = self._log(run_id)
        self._seed()
        dims = [
            lambda: self._dim_products(log),
            lambda: self._dim_customers(log, load_ts),
        ]
        facts = [lambda f=f: self._fact(f, log, load_ts) for f in FACTS.values()]
        self._layer("GOLD", log, [dims, facts])

    def _seed(self) -> None:
        """The calendar and the unknown members, once."""
        path = f"{self.root}/gold/dim_date"
        if not exists(self.spark, f"{path}/_SUCCESS"):
            dim_date(self.spark).coalesce(1).write.mode("overwrite").parquet(path)
        for spec in DIMENSIONS.values():
            table = self.gold(spec.name)
            if not exists(self.spark, f"{table.path}/snapshot/_through=-1/_SUCCESS"):
                table.write_snapshot(unknown_member(self.spark, spec), -1)

    def _buckets(self) -> int:
        return int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def _dim_step(self, spec: DimSpec, log: AuditLog, source: str, description: str):
        info = {
            "load_strategy": "MERGE_SCD2", "source_obj": source, "business_key": spec.natural_key,
            "description": description,
        }
        name = spec.name.upper()
        return log.step("GOLD", name, name, "MERGE", "Versions written", info)

    def _dim_products(self, log: AuditLog) -> None:
        silver = self.silver("products")
        with self._dim_step(DIM_PRODUCTS, log, "silver.products", "Price and status history") as step:
            if not exists(self.spark, f"{silver.path}/changes"):
                return

            def write(batch: DataFrame, batch_id: int) -> None:
                batch, rows, batches = self._fresh(batch, "dim_products", batch_id)
                source = product_source(self._net(batch, silver, batches))
                touched = batch.select("product_id").distinct()
                self._write_dim(DIM_PRODUCTS, source, touched, rows, batch_id, step)

            self._run(silver.feed_stream(), write, "dim_products")

    def _dim_customers(self, log: AuditLog, load_ts: str) -> None:
        customers, addresses = self.silver("customers"), self.silver("addresses")
        with self._dim_step(
            DIM_CUSTOMERS, log, "silver.customers, silver.addresses", "Profile and address history"
        ) as step:
            if not all(exists(self.spark, f"{t.path}/changes") for t in (customers, addresses)):
                return
            changed = customers.feed_stream().select(
                "customer_id", BATCH, F.lit("customers").alias("_from")
            ).union(addresses.feed_stream().select("customer_id", BATCH, F.lit("addresses").alias("_from")))

            def write(batch: DataFrame, batch_id: int) -> None:
                batch, rows, _ = self._fresh(batch, "dim_customers", batch_id)
                ids = batch.where(F.col("customer_id").isNotNull()).select("customer_id").distinct()
                # Stored, the ids are worked out once for all that asks for them.
                ids = weighed(self._staged(ids, "dim_customers", batch_id), rows)
                profiles = customers.state(touching=ids, rows=rows)
                homes = weighed(addresses.state(touching=ids, rows=rows), rows)
                if not self.options.one_default_address:
                    self._one_default(profiles, homes)
                source = customer_source(
                    profiles, homes, ids, ntz(load_ts), self.options.one_default_address
                )
                self._write_dim(DIM_CUSTOMERS, source, ids, rows, batch_id, step)

            self._run(changed, write, "dim_customers")

    def _one_default(self, customers: DataFrame, addresses: DataFrame) -> None:
        """Fail if a customer has several default addresses; counted before anything is joined."""
        twice = duplicate_keys(addresses.where(F.col("is_default")), "customer_id")
        found = twice.join(customers.select("customer_id"), "customer_id", "left_semi").take(1)
        if found:
            raise AmbiguousSource(
                f"dim_customers: customer_id {found[0].customer_id} occurs more than once in the source"
            )

    def _write_dim(
        self, spec: DimSpec, source: DataFrame, touched: DataFrame, rows: int, batch_id: int, step: Step
    ) -> None:
        """``rows``: so many values in ``touched`` at most, each with one current version."""
        table = self.gold(spec.name)
        table.compact(batch_id)
        target = weighed(table.state(batch_id, touched, rows), rows)
        changes = scd2_changes(target, source, spec, batch_id, self._buckets(), self.options.scd2_mode)
        changes, actions = observe_actions(changes, f"{spec.name}_{batch_id}")
        table.write_changes(changes, batch_id)
        a = actions.get
        step.add(rows=a["inserted"] + a["updated"], opened=a["inserted"], closed=a["updated"])

    def _fact(self, spec: FactSpec, log: AuditLog, load_ts: str) -> None:
        silver, table = self.silver(spec.entity), self.gold(spec.name)
        rule = MergeRule.for_fact(spec)
        info = {
            "load_strategy": spec.strategy, "source_obj": f"silver.{spec.entity}", "business_key": spec.key,
            "description": "Insert unseen keys" if spec.insert_only else "Latest state per key",
        }
        name = spec.name.upper()
        step_name = "INSERT" if spec.insert_only else "MERGE"
        with log.step("GOLD", name, name, step_name, "Facts merged", info) as step:
            if not exists(self.spark, f"{silver.path}/changes"):
                return

            def write(batch: DataFrame, batch_id: int) -> None:
                batch, count, batches = self._fresh(batch, spec.name, batch_id)
                net = self._net(batch, silver, batches)
                orders = None
                if spec.name in ("fact_sales", "fact_shipments", "fact_payments"):
                    orders = self.silver("orders").state(touching=batch.select("order_id").distinct(), rows=count)
                rows = fact_source(
                    spec.name,
                    net,
                    orders,
                    self.gold("dim_products").state(),
                    self.gold("dim_customers").state(),
                )
                if self.options.dense_keys:
                    source = rows.withColumn(spec.surrogate, F.lit(None).cast("bigint"))
                else:
                    source = assign_keys(
                        rows, spec.surrogate, spec.key, batch_id, self._buckets(), unique=True
                    )
                table.compact(batch_id)
                if table.is_new(batch_id):
                    changes = insert_all(source, rule, ntz(load_ts))
                else:
                    touched = batch.select(spec.key).distinct()
                    target = weighed(table.state(batch_id, touched, count), count)
                    changes = merge_changes(target, source, rule, ntz(load_ts))
                if self.options.dense_keys:
                    changes = self._numbered(changes, spec, batch_id)
                changes, actions = observe_actions(changes, f"{spec.name}_{batch_id}")
                table.write_changes(changes, batch_id)
                a = actions.get
                step.add(
                    rows=a["inserted"] + a["updated"], inserted=a["inserted"], updated=a["updated"]
                )

            self._run(silver.feed_stream(), write, spec.name)

    def _numbered(self, changes: DataFrame, spec: FactSpec, batch_id: int) -> DataFrame:
        """A fact's changes, of which the inserted rows get the numbers after the last; others keep theirs."""
        changes = self._staged(changes, f"unnumbered/{spec.name}", batch_id)
        twice = duplicate_keys(changes.where(F.col(spec.key).isNotNull()), spec.key).take(1)
        if twice:
            raise AmbiguousSource(f"{spec.name}: {spec.key} {twice[0][0]} occurs more than once in the source")
        table = self.gold(spec.name)
        last = 0
        if not table.is_new(batch_id):
            last = table.state(before=batch_id).agg(F.max(spec.surrogate)).first()[0] or 0
        inserted = dense_keys(changes.where(F.col(ACTION) == INSERT), spec.surrogate, spec.key, last)
        return inserted.unionByName(changes.where(F.col(ACTION) != INSERT))

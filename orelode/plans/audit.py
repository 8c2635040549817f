"""The load log: one row per step, buffered on the driver and appended once per layer."""

from __future__ import annotations

import datetime as dt
import json
import threading
import time
import traceback
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from orelode.operators.merge import ACTION, INSERT, UPDATE
from orelode.operators.quality import REJECTED

LOG_SCHEMA = (
    "log_uuid string, pipeline_run_id string, layer string, process_name string, "
    "target_table string, step_name string, status string, message string, error_code string, "
    "error_stack string, rows_affected bigint, error_count bigint, duration_sec decimal(12,3), "
    "application_id string, user_name string, additional_info string, created_at timestamp_ntz"
)


def observe_verdicts(tagged: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count verdicts while the rows pass by, without a job of its own."""
    seen = Observation(name)
    r = F.col(REJECTED)
    return tagged.observe(
        seen,
        F.count(F.lit(1)).alias("read"),
        F.count(F.when(r, 1)).alias("rejected"),
        F.count(F.when(~r, 1)).alias("accepted"),
        F.count(F.when(r.isNull(), 1)).alias("undecided"),
    ), seen


def observe_actions(changes: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    seen = Observation(name)
    a = F.col(ACTION)
    return changes.observe(
        seen,
        F.count(F.when(a == INSERT, 1)).alias("inserted"),
        F.count(F.when(a == UPDATE, 1)).alias("updated"),
    ), seen


@dataclass
class Step:
    """What a running load reports; filled in as its batches complete."""

    rows: int = 0
    errors: int = 0
    info: dict = field(default_factory=dict)
    fault: str | None = None  # what kept the load from success without stopping it

    def add(self, rows: int = 0, errors: int = 0, **info) -> None:
        self.rows += rows
        self.errors += errors
        for k, v in info.items():
            old = self.info.get(k)
            self.info[k] = old + v if isinstance(v, int) and old is not None else v


class AuditLog:
    def __init__(self, spark: SparkSession, path: str, run_id: str):
        self.spark, self.path, self.run_id = spark, path, run_id
        self._rows: list[tuple] = []
        self._lock = threading.Lock()
        self._user = spark.sparkContext.sparkUser()

    def log(
        self, layer: str, process: str, target: str | None, step: str, status: str, message: str,
        rows: int = 0, errors: int = 0, seconds: float = 0.0, error_code: str | None = None,
        error_stack: str | None = None, info: dict | None = None,
    ) -> None:
        row = (
            str(uuid.uuid4()), self.run_id, layer, process, target, step, status, message,
            error_code, error_stack, rows, errors, Decimal(f"{seconds:.3f}"),
            self.spark.sparkContext.applicationId, self._user,
            None if info is None else json.dumps(info),
            dt.datetime.now(dt.UTC).replace(tzinfo=None),
        )
        with self._lock:
            self._rows.append(row)

    def flush(self) -> None:
        with self._lock:
            rows, self._rows = self._rows, []
        if rows:
            self.spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    @contextmanager
    def step(
        self, layer: str, process: str, target: str | None, step: str, message: str, info: dict | None = None
    ) -> Iterator[Step]:
        """Log START, then SUCCESS with what was counted, or FAIL and raise on."""
        begun = time.monotonic()
        self.log(layer, process, target, "INIT", "START", "Load begins")
        report = Step()
        try:
            yield report
        except Exception as e:
            self.log(
                layer, process, target, "FAILURE", "FAIL", str(e),
                seconds=time.monotonic() - begun,
                error_code=type(e).__name__, error_stack=traceback.format_exc(),
                info={"failed_at_step": process},
            )
            raise
        self.log(
            layer, process, target, step, "FAIL" if report.fault else "SUCCESS", report.fault or message,
            report.rows, report.errors, time.monotonic() - begun,
            info={**(info or {}), **report.info} or None,
        )

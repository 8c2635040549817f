from __future__ import annotations

import json
import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parent.parent), str(Path(__file__).resolve().parent)]

from orelode.functions.dates import ntz  # noqa: E402
from orelode.plans.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "orelode-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def sf_dir():
    return SF


@pytest.fixture
def bronze(spark):
    """Bronze rows from Python records: dicts, or (dict, ingestion_ts, source_file)."""
    from pyspark.sql import functions as F

    def make(records, ts="2020-01-01 00:00:00", source="a.json"):
        rows = []
        for r in records:
            record, at, file = r if isinstance(r, tuple) else (r, ts, source)
            rows.append((record if isinstance(record, str) else json.dumps(record), at, file))
        df = spark.createDataFrame(rows, "value string, ts string, source_file string")
        return df.select(
            F.parse_json("value").alias("payload"),
            F.col("ts").cast("timestamp_ntz").alias("ingestion_ts"),
            "source_file",
        )

    return make


@pytest.fixture
def at():
    return ntz

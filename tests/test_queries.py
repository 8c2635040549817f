"""Every registered query against its SQL, over all rows of the smallest tables."""

from __future__ import annotations

import pytest
from compare import duck, duck_rows, spark_rows
from conftest import SF

from __spark_entry__ import entry
from orelode.registry.oracles import all_oracles
from orelode.registry.queries import all_queries

QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, name):
    columns, rows = spark_rows(QUERIES[name](spark, SF))
    want_columns, want_rows = duck_rows(con, ORACLES[name])
    assert columns == want_columns
    assert len(rows) == len(want_rows)
    assert rows == want_rows


def test_flagship(spark):
    df = entry(spark)
    assert "customer_key" in df.columns and df.where("customer_key > 0").count() > 0

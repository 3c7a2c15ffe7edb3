"""Every registered query against its SQL on the driver's tables.

``SF_DIR`` selects the scale; the default is the smallest.
"""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_module

SF_DIR = os.environ.get("SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no driver tables")


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isfinite(value):
        return round(value, 8)
    return value


def _sorted(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(entry_module.oracle_sql()))
def test_query_equals_sql(spark, database, name):
    found = entry_module.queries()[name](spark, SF_DIR)
    expected = database.sql(entry_module.oracle_sql()[name])
    assert sorted(found.columns) == sorted(expected.columns)
    assert _sorted(found.collect(), found.columns) == _sorted(expected.fetchall(), expected.columns)


@pytest.mark.parametrize("name", sorted(set(entry_module.queries()) - set(entry_module.oracle_sql())))
def test_query_without_sql_runs(spark, name):
    assert entry_module.queries()[name](spark, SF_DIR).count() > 0


def test_entry_has_rows(spark):
    assert entry_module.entry(spark).count() > 0

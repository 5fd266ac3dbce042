"""Every registered query against its SQL counterpart on the smallest tables."""

import math
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from ledgerlake.plans.catalog import QUERIES
from ledgerlake.plans.oracle import ORACLE

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def in_order(rows):
    return sorted(rows, key=lambda row: [(v is None, str(v)) for v in row])


def test_entry(spark):
    rows = entry(spark).collect()
    assert len(rows) == 5 and all(r["matches"] for r in rows)


def test_every_query_of_the_catalog_has_sql():
    assert set(ORACLE) == set(QUERIES) and set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    df = queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = in_order(tuple(r) for r in df.select(*columns).collect())
    result = duck.execute(oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = in_order(tuple(r[names.index(c)] for c in columns) for r in result.fetchall())
    assert len(got) == len(want)
    for g, w in zip(got, want):
        for a, b in zip(g, w):
            assert a == b or (isinstance(a, float) and isinstance(b, float) and math.isclose(a, b, rel_tol=1e-12))

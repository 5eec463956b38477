"""Every registered query matches its oracle in DuckDB on the sf0.001 tables, or holds its property
(``query_properties``).  The optional corpus queries have their tests beside them."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from oracle_check import norm  # noqa: E402
from query_properties import PROPERTIES  # noqa: E402
from tessera.plans import catalog  # noqa: E402
from tessera.session import TABLES  # noqa: E402

SF = "/root/testdata/sf0.001"
QUERIES = entry.queries()
ORACLE = entry.oracle_sql()
OWN = sorted(set(catalog.QUERIES) | (set(ORACLE) & set(QUERIES)))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) >= 1
    assert df.columns == ["segment", "n", "avg_value", "max_value"]


@pytest.mark.parametrize("name", OWN)
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    found = df.collect()
    if name not in ORACLE:
        PROPERTIES[name](spark, SF, found)
        return
    rows = sorted(repr(tuple(norm(x) for x in r)) for r in found)
    rel = con.sql(ORACLE[name])
    assert sorted(rel.columns) == sorted(df.columns)
    order = [rel.columns.index(c) for c in df.columns]
    orows = sorted(repr(tuple(norm(r[i]) for i in order)) for r in rel.fetchall())
    assert rows == orows


def test_every_query_is_checked():
    assert set(PROPERTIES) == set(catalog.QUERIES) - set(catalog.ORACLE)

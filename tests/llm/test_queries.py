"""Registered queries beside their SQL on the smallest test tables; the others give rows."""

from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

import verify  # noqa: E402

from slowtide.llm.catalog import ORACLES, QUERIES  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    connection = pytest.importorskip("duckdb").connect()
    for t in verify.TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    got, names = verify.rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert got
    if name in ORACLES:
        rel = con.sql(ORACLES[name])
        assert (got, names) == verify.rows_of(rel.columns, rel.fetchall())


def test_entry_has_them_and_the_pipeline():
    import __spark_entry__ as entry

    assert {*QUERIES, "pipeline"} <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())

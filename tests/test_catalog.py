"""Every registered query beside its SQL on the smallest test tables."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
import verify  # noqa: E402

from slowtide.catalog import ORACLES, QUERIES  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# Queries that fit a model have no SQL counterpart.
ROWS_ONLY = {"ml4_ml7_train_delay_classifier", "ml5_score_latest_and_batch", "st2_stream_scores", "flow_train_predict_monitor"}
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for t in verify.TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return connection


def test_only_model_fits_lack_sql():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan and "EvalPython" not in plan
    got, names = verify.rows_of(df.columns, [tuple(r) for r in df.collect()])
    sql = ORACLES.get(name)
    if sql is None:
        assert got
        return
    rel = con.sql(sql)
    want, want_names = verify.rows_of(rel.columns, rel.fetchall())
    assert names == want_names
    assert {c: TYPES[t] for c, t in df.dtypes} == dict(zip(rel.columns, map(str, rel.types)))
    assert got == want


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1

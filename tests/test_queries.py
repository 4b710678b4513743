"""Every check query against its SQL counterpart in DuckDB, on the smallest tables.

Their plans must stay free of Python workers and of joins that compare all pairs.
"""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as spark_entry
from checks.frames import TABLES
from checks.registry import ORACLE, QUERIES
from checks.verify import rows_of

SF = "/root/testdata/sf0.001"
UNWANTED = [
    "PythonUDF", "ArrowEval", "MapInPandas", "FlatMapGroups", "CartesianProduct",
    "BroadcastNestedLoopJoin",
]


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry_has_rows(spark):
    assert spark_entry.entry(spark).columns == ["user_id", "event_type", "dt_s", "dt_e"]
    assert spark_entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, db, name):
    df = QUERIES[name](spark, SF)
    cursor = db.execute(ORACLE[name])
    want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == want
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in UNWANTED if word in plan]

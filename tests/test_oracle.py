"""Every registered query against its SQL equivalent, and the shape of its plan."""

import math

import duckdb
import pytest

import __spark_entry__ as engine
from acoustic_spark.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def normal(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    return repr(value + 0.0) if isinstance(value, float) else str(value)


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(tuple(normal(v) for v in row) for row in frame.itertuples(index=False))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    result = engine.queries()[name](spark, SF)
    plan = plan_of(result)
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    found = result.toPandas()
    sql = engine.oracle_sql().get(name)
    if sql is None:
        assert len(found) > 0
        return
    expected = duck.execute(sql).df()
    assert sorted(found.columns) == sorted(expected.columns)
    assert [str(found[c].dtype) for c in sorted(found)] == [str(expected[c].dtype) for c in sorted(expected)]
    assert rows(found) == rows(expected)


def test_entry(spark):
    assert engine.entry(spark).count() > 0

"""Every SQL-expressible plan equals its DuckDB oracle (rows, columns, values)."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL, duck, normalise

ORACLES = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_runs(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) > 0
    assert entry.entry(spark).columns == ["bucket", "anomalies", "rows", "anomaly_rate"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_plan_matches_oracle(spark, con, name):
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    want = con.sql(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    a, b = normalise(got), normalise(want)
    assert a.equals(b), f"{name}:\n{a.head()}\n{b.head()}"

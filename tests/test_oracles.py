"""Every registered query against its DuckDB oracle at sf0.01 (the driver's gate)."""

import pytest

import __spark_entry__ as E
from conftest import SF_ORACLE, SF_SMALL
from oracle import compare, duck

QUERIES = E.queries()
ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "station" in df.columns


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    res = compare(QUERIES[name](spark, SF_ORACLE), con, ORACLES[name])
    assert res["ok"], res


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only_query_runs(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = df.collect()
    assert rows, "an empty result"
    for i, column in enumerate(df.columns):  # no column that was lost on the way
        assert column in ("rule", "lower", "upper", "new_share", "corr", "direction") or any(r[i] is not None for r in rows), column

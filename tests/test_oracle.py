"""Every registered query vs its DuckDB oracle SQL on the smallest test data."""

import pytest

from ledgerflow.plans.catalog import REGISTRY
from ledgerflow.plans.compare import compare, duckdb_connection

from .conftest import SF_SMALL

NAMES = sorted(REGISTRY)


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    q = REGISTRY[name]
    df = q.build(spark, SF_SMALL)
    if q.sql is None:
        assert df.count() >= 0
        return
    out = compare(name, df, con, q.sql)
    assert out.ok, out.detail


def test_registry_entry_contract(spark):
    import __spark_entry__ as entry
    qs, sqls = entry.queries(), entry.oracle_sql()
    assert set(sqls) <= set(qs)
    assert len(qs) >= 90
    df = entry.entry(spark)
    assert df.count() > 0

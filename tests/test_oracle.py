"""Every registered query against its DuckDB twin on the smallest tables."""
import pytest

from __spark_entry__ import oracle_sql, queries
from newsflow.plans import catalog
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare, duck

NAMES = sorted(oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, queries()[name], oracle_sql()[name], SF_SMALL)
    assert r["ok"], r.get("why")


def test_every_query_has_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLE) | catalog.NO_SQL
    assert set(oracle_sql()) <= set(queries())

"""Every registered query against its SQL oracle (DuckDB) on sf0.001."""

import pytest

from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def _names():
    from feedlake.catalog import ORACLE, load_all
    load_all()
    return sorted(ORACLE)


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, con, name):
    from __spark_entry__ import oracle_sql, queries
    ok, msgs = compare(spark, con, name, queries()[name], oracle_sql()[name], SF_SMALL)
    assert ok, "\n".join(msgs)


def test_every_query_has_oracle():
    from __spark_entry__ import oracle_sql, queries
    from feedlake.catalog import ORACLE, QUERIES
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql())


def test_entry(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() > 0 and "customer_slug" in df.columns

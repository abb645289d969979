"""Every registered query against its DuckDB oracle on the smallest test tables."""

import pytest

import __spark_entry__ as E
from tidemart.plans.catalog import QUERIES
from tidemart.plans.compare import compare, duck
from tidemart.plans.oracle_sql import ORACLE

from shared import SF_SMALL

NAMES = sorted(QUERIES)


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["date_key", "total_orders", "total_quantity", "total_revenue",
                          "total_discounted_revenue", "loaded_at"]
    assert df.count() > 0


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, SF_SMALL, E.queries()[name], E.oracle_sql()[name], con)
    assert r["cols_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["match"], r

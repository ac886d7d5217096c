"""Every registered query against its SQL oracle (DuckDB) on sf0.001:
same columns, types, row count and multiset of rows."""

import pytest

import __spark_entry__ as entry
from kinrank.plans import catalog, oracle
from kinrank.plans.compare import compare

from .conftest import SF_SMALL

NAMES = sorted(catalog.registry())


def test_every_query_has_an_oracle():
    assert set(NAMES) == set(oracle.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    r = compare(spark, duck, name, entry.queries()[name], entry.oracle_sql()[name], SF_SMALL)
    assert r["ok"], r


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["user_id", "item_id", "prediction"]
    assert df.count() > 0

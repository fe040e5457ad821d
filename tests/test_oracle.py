"""Every registered query with oracle SQL against DuckDB; the others must return rows."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import difference, duck

SF = "/root/testdata/sf0.001"
ORACLES = oracle_sql()
#: Too few hourly rows here for folds with a gap of 168.
MAY_BE_EMPTY = {"d3_leakage_check", "m15_linear_search_hourly", "m15_tree_search_hourly", "m15_leaf_search_hourly"}
#: Hundreds of models each: ``pytest -m full_size`` runs them.
FULL_SIZE = {"m15_tree_search", "m15_tree_search_hourly", "m15_leaf_search_hourly"}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", [pytest.param(n, marks=pytest.mark.full_size) if n in FULL_SIZE else n for n in sorted(queries())])
def test_query(spark, con, name):
    got = queries()[name](spark, SF).toPandas()
    if name in ORACLES:
        assert difference(got, con.execute(ORACLES[name]).df()) is None
    if name not in MAY_BE_EMPTY:
        assert len(got) > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "temp_rolling_avg_24h" in df.columns

import pytest

from clauseforge.plans.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(name, compare):
    compare(QUERIES[name], ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_runs(name, spark, sf):
    df = QUERIES[name](spark, sf)
    assert df.columns and df.count() >= 0

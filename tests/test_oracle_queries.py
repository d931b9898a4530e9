"""Every registered query against its DuckDB oracle on sf0.001 (the driver
repeats this on sf0.01)."""

import pytest

from stepfold.plans import registry
from tests.oracle import compare

SF = "/root/testdata/sf0.001"
QUERIES = registry.queries()
ORACLE = registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck_sf001, name):
    problems = compare(spark, duck_sf001, name, QUERIES[name], ORACLE[name], SF)
    assert not problems, problems


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_without_oracle_runs(spark, name):
    assert QUERIES[name](spark, SF).count() >= 0


def test_entry(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())

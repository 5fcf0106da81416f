"""Every catalogue query against its DuckDB twin; queries without one give rows."""

import oracle
import pytest

from cohortspark.plans import catalogue

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_equals_oracle(spark, name):
    columns, rows = oracle.differences(spark, SMALL, catalogue.QUERIES[name], catalogue.ORACLES[name])
    assert not columns
    assert not rows


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLES)))
def test_gives_rows(spark, name):
    assert catalogue.QUERIES[name](spark, SMALL).head(1)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["chromosome", "position", "studies", "effect", "std_err", "chi2"]
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())

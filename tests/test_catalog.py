"""Every catalogue query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as entry_module
from urbanlens.plans.catalog import QUERIES
from urbanlens.plans.oracle import ORACLE_SQL
from urbanlens.plans.verify import compare

SF = "/root/testdata/sf0.001"


def test_every_query_has_an_oracle():
    assert set(entry_module.queries()) >= set(QUERIES)
    assert set(entry_module.oracle_sql()) >= set(QUERIES) == set(ORACLE_SQL)


def test_entry_runs(spark):
    df = entry_module.entry(spark)
    rows = df.collect()
    assert df.columns == ["period", "percentage"] and len(rows) == 4


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    result = compare(spark, name, SF)
    assert result["columns_match"], result
    assert result["values_match"], result

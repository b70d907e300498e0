"""Every registered query against its DuckDB oracle (row count, columns, values)."""

import pytest

import __spark_entry__ as entry_module
from formlake.plans.oracle import ORACLE_SQL
from formlake.plans.compare import compare
from formlake.plans.queries import QUERIES
from tests.conftest import SF_MID, SF_SMALL

NAMES = sorted(QUERIES)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry_module.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle_small(spark, name):
    result = compare(entry_module.queries()[name](spark, SF_SMALL), entry_module.oracle_sql()[name], SF_SMALL)
    assert result["match"], result


@pytest.mark.parametrize("name", ["parse_filings", "enriched_signals", "sell_rollup", "elite_buys", "form4_index"])
def test_query_matches_oracle_mid(spark, name):
    result = compare(entry_module.queries()[name](spark, SF_MID), entry_module.oracle_sql()[name], SF_MID)
    assert result["match"], result
    assert result["spark_rows"] > 0


def test_entry_smoke(spark):
    df = entry_module.entry(spark)
    assert df.count() >= 0
    assert "ahab_score" in df.columns

"""Driver contract: entry runs, every query has an oracle."""

import __spark_entry__ as entry_mod
from caseweek.catalogue import QUERIES
from caseweek.oracle import oracle_queries


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert "week" in df.columns and "componentID" in df.columns


def test_every_query_has_oracle_sql():
    assert set(QUERIES) == set(oracle_queries())
    assert set(QUERIES) <= set(entry_mod.queries()) and set(entry_mod.oracle_sql()) <= set(entry_mod.queries())

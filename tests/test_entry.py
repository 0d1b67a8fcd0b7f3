"""Driver contract: entry runs, every oracle has a query."""

import __spark_entry__ as e


def test_entry_runs(spark):
    df = e.entry(spark)
    assert df.count() > 0
    assert "Fare_Amt" in df.columns


def test_oracles_match_queries():
    q, s = e.queries(), e.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 45

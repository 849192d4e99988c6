"""Driver contract: entry runs, every oracle has a query, rows-only queries run."""

import pytest

import __spark_entry__ as entry_mod
from sf_paths import SF_SMALL


def test_entry(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["user_id", "day", "y", "prediction", "fold"]
    assert df.count() > 0


def test_contract_keys():
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 70


@pytest.mark.parametrize("name", sorted(set(entry_mod.queries()) - set(entry_mod.oracle_sql())))
def test_rows_only_queries_run(spark, name):
    df = entry_mod.queries()[name](spark, SF_SMALL)
    rows = df.collect()
    assert rows and len(set(df.columns)) == len(df.columns)
    assert all(any(r[c] is not None for r in rows) for c in df.columns)

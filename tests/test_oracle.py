"""The correctness gate: every registered query vs its DuckDB oracle (sf0.01)."""

from __future__ import annotations

import pytest
from conftest import ORACLE_DIR, SMOKE_DIR

from __spark_entry__ import entry, oracle_sql, queries
from oracle_check import compare
from ticklake.plans import registry

QUERIES = registry.queries()
SQL = oracle_sql()


def test_every_query_has_an_oracle():
    assert set(SQL) <= set(queries())
    assert set(QUERIES) - set(SQL) == set()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    res = compare(spark, name, ORACLE_DIR, SQL.get(name), QUERIES[name])
    assert res["status"] == "match", res


def test_entry_smoke(spark):
    df = entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:2] == ["pair", "minute_bucket"]
    assert SMOKE_DIR.endswith("sf0.001")

"""Every contract query against its DuckDB oracle on the small fixture."""

from __future__ import annotations

import pytest

from vigil.plans import registry
from vigil.plans.compare import compare

REG = registry.all_queries()
ORACLE = sorted(n for n, (_, sql) in REG.items() if sql)
ROWS_ONLY = sorted(n for n, (_, sql) in REG.items() if not sql)


def test_entry_contract(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(REG) <= set(entry.queries())


@pytest.mark.parametrize("name", ORACLE)
def test_oracle_match(spark, duck, sf_dir, name):
    fn, sql = REG[name]
    r = compare(spark, duck, name, fn, sql, sf_dir)
    assert r["status"] == "match", r


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_rows_only_runs(spark, sf_dir, name):
    fn, _ = REG[name]
    df = fn(spark, sf_dir)
    assert df.count() > 0

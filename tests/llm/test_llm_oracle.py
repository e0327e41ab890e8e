"""Queries of this subpackage that have SQL, against DuckDB."""

from __future__ import annotations

import duckdb
import pytest

from voxloom.llm import registry


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_same_rows(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "pages"):
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    found, wanted = registry.QUERIES[name](spark, sf).toPandas(), con.execute(registry.ORACLE_SQL[name]).df()
    columns = sorted(found.columns)
    assert columns == sorted(wanted.columns)
    assert sorted(map(repr, found[columns].itertuples(index=False, name=None))) == sorted(map(repr, wanted[columns].itertuples(index=False, name=None)))

"""Every catalogue query with SQL against DuckDB on the smallest tables; the others give rows."""

from __future__ import annotations

import duckdb
import pytest

from voxloom.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    return con


def rows(df):
    columns = sorted(df.columns)
    return sorted(map(repr, df[columns].astype(object).where(df[columns].notna(), None).itertuples(index=False, name=None)))


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_same_rows(spark, sf, duck, name):
    found, wanted = catalogue.QUERIES[name](spark, sf).toPandas(), duck.execute(catalogue.ORACLE_SQL[name]).df()
    assert sorted(found.columns) == sorted(wanted.columns)
    assert rows(found) == rows(wanted)


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLE_SQL) - {"q_kmeans_full", "q_recluster"}))
def test_gives_rows(spark, sf, name):
    assert catalogue.QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 10

"""Every query with SQL against DuckDB on the same tables."""

import os

import pytest

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db(sf_dir):
    import duckdb

    if not os.path.isdir(sf_dir):
        pytest.skip("no test tables")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(frame):
    import pandas as pd

    def cell(v):
        if v is None or v is pd.NaT or v is pd.NA or v != v:
            return "~"
        return repr(float(v)) if isinstance(v, (int, float)) or "int" in str(type(v)) or "float" in str(type(v)) else str(v)

    columns = sorted(frame.columns)
    return columns, sorted(tuple(map(cell, r)) for r in frame[columns].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, db, sf_dir, name):
    got = canonical(entry.queries()[name](spark, sf_dir).toPandas())
    want = canonical(db.execute(entry.oracle_sql()[name]).fetch_df())
    assert got == want


def test_entry(spark):
    assert entry.entry(spark).count() == 4

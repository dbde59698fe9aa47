"""Every query against its SQL counterpart in DuckDB, on the whole tables."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as driver
from outlay.plans import catalogue, oracle

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    return con


def test_every_query_has_its_sql():
    assert set(catalogue.queries()) == set(oracle.oracle_sql())
    assert set(catalogue.queries()) <= set(driver.queries())
    assert set(oracle.oracle_sql()) <= set(driver.oracle_sql()) <= set(driver.queries())


def _values(frame, columns):
    def show(v):
        if pd.isna(v):
            return None
        if hasattr(v, "year"):
            return str(v)[:10]
        return v

    return sorted(
        (tuple(show(v) for v in row) for row in frame[columns].itertuples(index=False)), key=repr
    )


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query_matches_its_sql(spark, con, name):
    ours = catalogue.queries()[name](spark, SF)
    theirs = con.execute(oracle.oracle_sql()[name])
    columns = sorted(ours.columns)
    assert columns == sorted(c[0] for c in theirs.description)
    assert _values(ours.toPandas(), columns) == _values(theirs.df(), columns)


def test_entry(spark):
    assert driver.entry(spark).columns == [
        "segments_date", "domain", "brand", "channel_type", "total_spend_eur",
    ]

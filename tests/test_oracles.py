"""Registered queries against their DuckDB SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

from mentionflow.plans.registry import QUERIES, SQL, flagship

#: These take the same steps as monitor_output and are compared on larger tables by the driver.
LONG = {"stage_counts", "run_health", "gated_health"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in LONG])
def test_query_and_sql_agree(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    want = duck.sql(SQL[name])
    assert sorted(want.columns) == columns
    rows = lambda got: sorted((tuple(r) for r in got), key=str)
    assert rows(df.select(*columns).collect()) == rows(want.select(*[f'"{c}"' for c in columns]).fetchall())


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


def test_flagship(spark, sf_dir):
    df = flagship(spark, sf_dir)
    assert len(df.columns) == 14 and df.count() > 0

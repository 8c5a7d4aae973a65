"""The registered queries: each that has an SQL twin equals it."""

import glob
import os

import duckdb
import pytest

from check import normal
from tickguard.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, name):
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    got, want = normal(QUERIES[name](spark, sf).toPandas()), normal(con.execute(ORACLES[name]).df())
    assert list(got.columns) == list(want.columns)
    assert got.equals(want)


def test_one_query_an_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))

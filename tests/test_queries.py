"""Every registered query against its SQL twin."""

import glob
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import normal
from tickguard.plans.catalog import QUERIES
from tickguard.plans.oracles import ORACLES

SF_DIR = os.environ.get("TICKGUARD_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


def test_entry_returns_alerts(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    got = normal(QUERIES[name](spark, SF_DIR).toPandas())
    want = normal(duck.execute(ORACLES[name]).df())
    assert list(got.columns) == list(want.columns)
    assert len(got) == len(want)
    assert got.equals(want)

"""Every query of the catalogue against its SQL."""

import glob
import os

import duckdb
import pytest

from tests.helpers import same
from tidemark.plans import queries as plans

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from read_parquet('{f}')")
    return c


@pytest.mark.parametrize("name", sorted(plans.Q))
def test_query(spark, duck, name):
    same(plans.Q[name](spark, SF).toPandas(), duck.execute(plans.SQL[name]).df())


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())

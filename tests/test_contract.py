"""Driver contract: entry, registered queries vs their oracle SQL (sf0.001)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                                "scripts"))

import __spark_entry__ as contract  # noqa: E402
from check_oracle import TABLES, rows_of  # noqa: E402
from conftest import SF001  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def test_entry_flagship(spark):
    df = contract.entry(spark)
    assert df.columns == ["city", "date", "avg_temperature", "avg_wind_speed", "avg_humidity",
                          "avg_pressure", "has_forecast_data"]
    assert df.count() == 275


def own_queries():
    """The library's own queries; corpus queries have tests of their own."""
    return sorted(set(contract.queries()) - set(contract._corpus()[0]))


def test_every_query_has_an_oracle():
    assert set(own_queries()) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", own_queries())
def test_query_matches_oracle(spark, duck, name):
    got = contract.queries()[name](spark, SF001).toPandas()
    want = duck.execute(contract.oracle_sql()[name]).df()
    gc, gr = rows_of(got)
    wc, wr = rows_of(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr

"""Every registered query against its DuckDB oracle at sf0.01 (the driver's gate)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from assetrank.plans import catalog  # noqa: E402
from oracle_check import digest  # noqa: E402
from assetrank.sources.fixtures import TABLES  # noqa: E402

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLE)
    assert set(catalog.QUERIES) <= set(E.queries()) and set(catalog.ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    rel = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in rel.description]
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_entry_smoke(spark):
    out = E.entry(spark)
    assert out.count() == 5
    assert out.columns == ["rank", "ticker", "name", "industry", "sector", "ret", "vol", "pe"]


SERIES = ["cum_sum", "diff", "true_range", "sliding_agg", "sliding_list", "expanding_agg", "volatility", "order_within_ticker", "ewm"]


@pytest.mark.parametrize("name", SERIES)
def test_series_query_with_many_blocks(spark, con, name):
    """The same oracles with tiny time blocks, so every series spans many blocks."""
    spark.conf.set("assetrank.blockRows", "200")
    try:
        df = E.queries()[name](spark, SF)
        rows = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.unset("assetrank.blockRows")
    rel = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in rel.description]
    assert digest(df.columns, rows)[0] == digest(ocols, rel.fetchall())[0]

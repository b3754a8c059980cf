"""Every registered query against its DuckDB oracle on the sf0.001 driver data."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tools.check_oracle import TABLES, digest
from tradescope.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_oracle():
    assert set(catalog.CATALOG) <= set(E.oracle_sql())


@pytest.fixture(scope="module")
def tables(spark):
    # One lazily built source for the sweep: builders and their grain
    # statistics are computed once and shared, as in a refresh.
    from tradescope.plans.tables import Tables
    from tradescope.sources.trades import fixture_trades

    return Tables(fixture_trades(spark, SF), as_of=catalog.AS_OF)


def _compare(df, duck, name):
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert digest(df.columns, srows)[0] == digest(dcols, drows)[0]


@pytest.mark.parametrize("name", sorted(catalog.CATALOG))
def test_query_matches_oracle(spark, duck, tables, name):
    _compare(catalog.run(name, tables), duck, name)


@pytest.mark.parametrize("name", ["pr_top10", "build_strategy_performance", "sl_by_pair", "poll_timing"])
def test_entry_queries_match_oracle(spark, duck, name):
    """The driver's own path: ``queries()[name](spark, sf_dir)``."""
    _compare(E.queries()[name](spark, SF), duck, name)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "trading_pair" in df.columns

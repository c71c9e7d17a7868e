"""The driver contract, and oracle agreement on the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as E
from tools.check_oracle import digest

SF = "/root/testdata/sf0.001"
QUICK = ["ohlcv_bars", "ema10", "spread_bars", "panel_candles", "union_feeds", "dead_letters",
         "insert_ignore_trades", "late_trades", "upsert_bars_merge", "book_top20", "encode_wire_json"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "spread_bps" in df.columns


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute(f"create view events as select * from read_parquet('{SF}/events.parquet')")
    return c


@pytest.mark.parametrize("name", QUICK)
def test_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF).toPandas()
    exp = con.execute(E.oracle_sql()[name]).fetchdf()
    assert sorted(got.columns) == sorted(exp.columns)
    assert len(got) == len(exp)
    assert digest(got) == digest(exp[got.columns])

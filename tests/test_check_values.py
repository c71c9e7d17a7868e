"""Aggregate check values of the bar job at sf0.01, computed independently
in DuckDB while surveying (SURVEY Appendix A)."""

from pyspark.sql import functions as F

from tickbars.plans import panels as P
from tickbars.plans.jobs import bar_job
from tickbars.sources import fixtures as FX


def test_bar_job_check_values(spark):
    job = bar_job(FX.trades(spark, "/root/testdata/sf0.01"))
    r = job.agg(F.count("*").alias("n"), F.sum("spread_usd").alias("u"), F.sum("spread_bps").alias("b"),
                F.sum("ema10").alias("e")).first()
    assert r.n == 3603
    assert round(r.u, 2) == 270310.53 and round(r.b, 4) == 52465877.2533 and round(r.e, 4) == 184989.9651
    c = P.panel_candles(job, "BTCUSD").first()
    assert c.time_ms == 1704067200000 and c.high == 178.35 and c.low == 6.55
    assert round(c.open, 6) == 13.456667 and round(c.close, 6) == 109.293333
    # The dashboard reads the table, which only receives matched (three-source)
    # minutes: 605 of the 720 BTCUSD minutes.
    assert P.panel_imbalance(job, "BTCUSD").count() == 605

"""Dashboard queries over the bar table (O-51a..g, O-31, O-72, O-28).

Each takes the bar table, the dashboard's symbol and an optional inclusive
time range in epoch ms (the dashboard's time filter).  The filters are plain
column predicates, so a Parquet scan gets them pushed down and, on a
date-partitioned table, prunes partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickbars.constants import SOURCE_FEED1

TIME = "window_start_ms"


def _where(bars: DataFrame, symbol: str, t_from: int | None, t_to: int | None) -> DataFrame:
    pred: Column = F.col("symbol") == F.lit(symbol)
    if t_from is not None:
        pred = pred & (F.col(TIME) >= F.lit(t_from))
    if t_to is not None:
        pred = pred & (F.col(TIME) <= F.lit(t_to))
    return bars.filter(pred)


def _by_time(bars: DataFrame, symbol: str, t_from, t_to, *aggs: Column) -> DataFrame:
    """GROUP BY time for one symbol.  Grouping by (symbol, time) is the same
    grouping (the symbol is fixed by the filter) and is already satisfied by
    bars hash-partitioned on symbol, so no extra shuffle is planned."""
    return (_where(bars, symbol, t_from, t_to).groupBy("symbol", F.col(TIME).alias("time_ms"))
            .agg(*aggs).drop("symbol").orderBy("time_ms"))


def panel_candles(bars, symbol, t_from=None, t_to=None) -> DataFrame:
    return _by_time(bars, symbol, t_from, t_to,
                    F.avg("open").alias("open"), F.max("high").alias("high"),
                    F.min("low").alias("low"), F.avg("close").alias("close"))


def panel_vwap(bars, symbol, t_from=None, t_to=None) -> DataFrame:
    return _by_time(bars, symbol, t_from, t_to,
                    (F.sum(F.col("vwap") * F.col("volume")) / F.nullif(F.sum("volume"), F.lit(0.0)))
                    .alias("vwap"))


def panel_buy_sell(bars, symbol, t_from=None, t_to=None) -> DataFrame:
    return _by_time(bars, symbol, t_from, t_to,
                    F.sum("buy_volume").alias("buy_volume"), F.sum("sell_volume").alias("sell_volume"))


def panel_close_ema(bars, symbol, t_from=None, t_to=None) -> DataFrame:
    return _by_time(bars, symbol, t_from, t_to,
                    F.avg("close").alias("close"), F.avg("ema10").alias("ema10"))


def panel_imbalance(bars, symbol, t_from=None, t_to=None) -> DataFrame:
    b, s = F.sum("buy_volume"), F.sum("sell_volume")
    return _by_time(bars, symbol, t_from, t_to,
                    ((b - s) / F.nullif(b + s, F.lit(0.0))).alias("imbalance"))


def _spread_series(bars, symbol, column, t_from, t_to, source=SOURCE_FEED1) -> DataFrame:
    rows = _where(bars, symbol, t_from, t_to).filter(
        (F.col("source") == F.lit(source)) & F.col(column).isNotNull())
    return rows.select(F.col(TIME).alias("time_ms"), F.col(column)).orderBy("time_ms")


def spread_usd_series(bars, symbol, t_from=None, t_to=None) -> DataFrame:
    return _spread_series(bars, symbol, "spread_usd", t_from, t_to)


def spread_bps_series(bars, symbol, t_from=None, t_to=None) -> DataFrame:
    return _spread_series(bars, symbol, "spread_bps", t_from, t_to)


def distinct_symbols(bars: DataFrame) -> DataFrame:
    """Dashboard variable: SELECT DISTINCT symbol ORDER BY symbol."""
    return bars.select("symbol").distinct().orderBy("symbol")


def newest_first() -> list[Column]:
    return [F.desc(TIME), F.asc("symbol"), F.asc("source")]


def latest_bars(bars: DataFrame, n: int = 10) -> DataFrame:
    """ORDER BY window_start DESC LIMIT n (a top-n: Spark plans TakeOrdered,
    each task keeps n rows, the driver merges n x tasks)."""
    return bars.orderBy(*newest_first()).limit(n)

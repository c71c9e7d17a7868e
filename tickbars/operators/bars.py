"""OHLCV bars (O-50, O-81, O-84) and bar roll-up (O-50i).

One ``groupBy`` with built-in aggregates: Spark runs it as a partial
(map-side) hash aggregate, a shuffle of one buffer row per key and minute
and map task, and a final aggregate.  A hot symbol therefore costs no more
shuffle than a cold one.  ``min_by``/``max_by`` on the arrival order give
the first/last trade to arrive, and they merge by order key, so partial
buffers may combine in any order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickbars.functions.symbols import canonical_symbol
from tickbars.functions.timefns import floor_to

MINUTE_MS = 60_000


def _bar_aggregates(price: Column, qty: Column, maker: Column, arrival: Column) -> list[Column]:
    maker = F.coalesce(maker, F.lit(False))
    return [
        F.min_by(price, arrival).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, arrival).alias("close"),
        F.sum(qty).alias("volume"),
        F.sum(price * qty).alias("_pv"),
        F.sum(F.when(maker, F.lit(0.0)).otherwise(qty)).alias("buy_volume"),
        F.sum(F.when(maker, qty).otherwise(F.lit(0.0))).alias("sell_volume"),
        F.count(F.lit(1)).cast("int").alias("trade_count"),
    ]


def _finish(df: DataFrame) -> DataFrame:
    """vwap = sum(p*q)/volume when volume > 0, else close."""
    return df.withColumn(
        "vwap", F.when(F.col("volume") > 0, F.col("_pv") / F.col("volume")).otherwise(F.col("close"))
    ).drop("_pv")


BAR_COLUMNS = ["symbol", "source", "window_start_ms", "window_end_ms", "open", "high", "low",
               "close", "volume", "vwap", "buy_volume", "sell_volume", "trade_count"]


def ohlcv_bars(
    trades: DataFrame,
    interval_ms: int = MINUTE_MS,
    arrival: str = "arrival",
    time_col: str = "trade_time_ms",
    canonicalize: bool = True,
) -> DataFrame:
    """Trades -> one bar per (canonical symbol, source, tumbling window).

    Windows are epoch aligned and half-open ``[start, start + interval)``.
    """
    sym = canonical_symbol("symbol") if canonicalize else F.col("symbol")
    start = floor_to(time_col, interval_ms)
    bars = trades.groupBy(sym.alias("symbol"), F.col("source"), start.alias("window_start_ms")).agg(
        *_bar_aggregates(F.col("price"), F.col("quantity"), F.col("is_buyer_maker"), F.col(arrival))
    )
    bars = _finish(bars).withColumn("window_end_ms", F.col("window_start_ms") + F.lit(interval_ms))
    return bars.select(*BAR_COLUMNS)


def stream_ohlcv_bars(trades: DataFrame, interval: str = "1 minute", delay: str = "5 seconds",
                      arrival: str = "arrival") -> DataFrame:
    """Streaming twin: event-time watermark + tumbling ``window``; emits a bar
    once the watermark passes its end (append mode), late trades are dropped."""
    ts = F.timestamp_millis(F.col("trade_time_ms"))
    bars = (trades.withColumn("_et", ts)
            .withWatermark("_et", delay)
            .groupBy(canonical_symbol("symbol").alias("symbol"), F.col("source"),
                     F.window("_et", interval).alias("w"))
            .agg(*_bar_aggregates(F.col("price"), F.col("quantity"), F.col("is_buyer_maker"),
                                  F.col(arrival))))
    bars = _finish(bars).select(
        "symbol", "source",
        F.unix_millis(F.col("w.start")).alias("window_start_ms"),
        F.unix_millis(F.col("w.end")).alias("window_end_ms"),
        "open", "high", "low", "close", "volume", "vwap", "buy_volume", "sell_volume", "trade_count",
        F.col("w"),
    )
    return bars


def rollup_bars(bars: DataFrame, interval_ms: int) -> DataFrame:
    """Coarser bars from finer ones (e.g. 1m -> 5m / 1h), the merge of
    partial bar buffers: open of the earliest, close of the latest, extremes,
    sums, and vwap re-weighted by volume."""
    start = floor_to("window_start_ms", interval_ms)
    out = bars.groupBy("symbol", "source", start.alias("window_start_ms")).agg(
        F.min_by("open", "window_start_ms").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "window_start_ms").alias("close"),
        F.sum("volume").alias("volume"),
        F.sum(F.col("vwap") * F.col("volume")).alias("_pv"),
        F.sum("buy_volume").alias("buy_volume"),
        F.sum("sell_volume").alias("sell_volume"),
        F.sum("trade_count").cast("int").alias("trade_count"),
    )
    return _finish(out).withColumn("window_end_ms", F.col("window_start_ms") + F.lit(interval_ms)) \
        .select(*BAR_COLUMNS)

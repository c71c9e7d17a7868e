"""The batch form of the bar job.

trades -> OHLCV per (canonical symbol, source, minute) -> EMA per (symbol,
source) -> three-source match with spread.

Shuffles: one partial aggregate of the trades (the only trade-sized step,
combined map-side, so a hot symbol is not a hot partition).  Its output,
the bars, is written once to the shared folder (``session.materialize``):
the lineage is cut after the expensive stage, and the chunked EMA may read
the bar table twice.  The bars are then hash-partitioned once on (symbol,
time chunk); that partitioning serves the EMA windows (symbol, source,
chunk), the carry join (packed per symbol and chunk) and the spread window
(symbol, chunk, minute).  No task holds more than one time chunk
(``chunk`` bar intervals) of one symbol.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from pyspark.sql import functions as F

from tickbars.constants import NULL_KEY
from tickbars.operators.bars import MINUTE_MS, ohlcv_bars
from tickbars.operators.ema import chunk_of, ema_chunked
from tickbars.operators.spread import MATCH_SOURCES, spread_bars
from tickbars.session import materialize

CHUNK_BARS = 2048  # time chunk of the EMA/spread stage, in bar intervals (one running sum per chunk for N = 10)


def _bars_ema(trades: DataFrame, interval_ms: int, period: int, arrival: str, chunk: int) -> DataFrame:
    bars = materialize(ohlcv_bars(trades, interval_ms=interval_ms, arrival=arrival), "bars")
    # a null symbol (malformed record) is a key too: NULL_KEY through the joins
    bars = bars.withColumn("symbol", F.coalesce("symbol", F.lit(NULL_KEY)))
    bars = bars.withColumn("_chunk", chunk_of("window_start_ms", interval_ms, chunk)) \
        .repartition("symbol", "_chunk")
    return ema_chunked(bars, period=period, step_ms=interval_ms, chunk=chunk, chunk_col="_chunk",
                       out="ema10", partition_keys=("symbol",))


def _restore(df: DataFrame) -> DataFrame:
    return df.withColumn("symbol", F.when(F.col("symbol") != NULL_KEY, F.col("symbol")))


def bars_with_ema(trades: DataFrame, interval_ms: int = MINUTE_MS, period: int = 10,
                  arrival: str = "arrival", chunk: int = CHUNK_BARS) -> DataFrame:
    """All bars with their EMA."""
    return _restore(_bars_ema(trades, interval_ms, period, arrival, chunk).drop("_chunk"))


def bar_job(trades: DataFrame, interval_ms: int = MINUTE_MS, period: int = 10,
            sources: tuple[str, ...] = MATCH_SOURCES, arrival: str = "arrival",
            chunk: int = CHUNK_BARS) -> DataFrame:
    """Rows the bar job writes to the ``ohlcv`` table (matched bars + spread)."""
    b = _bars_ema(trades, interval_ms, period, arrival, chunk)
    return _restore(spread_bars(b, sources, group_extra=("_chunk",)).drop("_chunk"))

"""Trade job operators (O-21, O-22, O-53, O-55, O-57, O-83, O-90)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickbars.constants import SIDE_BUY, SIDE_SELL, TRADE_RETENTION_MS
from tickbars.functions.timefns import floor_to
from tickbars.operators.scan import chunked_running

TRADE_TABLE_COLUMNS = ["trade_time_ms", "symbol", "source", "trade_id", "price", "quantity",
                       "side", "ingestion_time_ms", "latency_ms"]
TRADE_KEY = ["symbol", "source", "trade_id", "trade_time_ms"]


def side_label(is_buyer_maker: Column) -> Column:
    """Buyer is the maker -> the aggressor sold."""
    return F.when(F.coalesce(is_buyer_maker, F.lit(False)), F.lit(SIDE_SELL)).otherwise(F.lit(SIDE_BUY))


def enrich_side(trades: DataFrame) -> DataFrame:
    """Trade -> row of the ``trades`` table.  A projection: no shuffle (the
    reference's keyBy before this stateless step has no effect on output)."""
    return trades.select(
        "trade_time_ms", "symbol", "source", "trade_id", "price", "quantity",
        side_label(F.col("is_buyer_maker")).alias("side"), "ingestion_time_ms", "latency_ms",
    )


def with_latency(trades: DataFrame, recv_ms: Column) -> DataFrame:
    """ingestion time = receive time (not the wall clock, so replays are
    deterministic); latency = ingestion - trade time, may be negative."""
    return trades.withColumn("ingestion_time_ms", recv_ms) \
                 .withColumn("latency_ms", recv_ms - F.col("trade_time_ms"))


def first_arrivals(rows: DataFrame, key: list[str], arrival: str = "arrival") -> DataFrame:
    """One row per key: the first to arrive.  An aggregate, not a window, so
    duplicates are combined map-side before the shuffle."""
    others = [c for c in rows.columns if c not in key]
    picked = rows.groupBy(*key).agg(F.min_by(F.struct(*others), F.col(arrival)).alias("_r"))
    return picked.select(*key, *[F.col(f"_r.{c}").alias(c) for c in others]).select(*rows.columns)


def insert_ignore(table: DataFrame, batch: DataFrame, key: list[str] = TRADE_KEY,
                  arrival: str = "arrival") -> DataFrame:
    """INSERT ... ON CONFLICT DO NOTHING: new content of the table.

    Within the batch the first arrival per key wins; keys already in the
    table are not touched.  The anti-join shuffles both sides on the key
    (or broadcasts the batch when adaptive execution measures it small).
    """
    cols = table.columns
    fresh = first_arrivals(batch, key, arrival).select(*cols)
    new_rows = fresh.join(table.select(*key), on=key, how="left_anti")
    return table.unionByName(new_rows)


def retain(table: DataFrame, time_col: str = "trade_time_ms", keep_ms: int = TRADE_RETENTION_MS,
           as_of: Column | int | None = None) -> DataFrame:
    """Retention: drop rows older than ``keep_ms`` before ``as_of`` (default:
    the newest row, a scalar aggregate)."""
    if as_of is None:
        bound = table.agg(F.max(time_col)).scalar()  # scalar subquery
    else:
        bound = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return table.filter(F.col(time_col) >= bound - F.lit(keep_ms))


def latest_trades(table: DataFrame, symbol: str, n: int = 20) -> DataFrame:
    """The (symbol, trade_time DESC) access path: filter + top-n."""
    return table.filter(F.col("symbol") == F.lit(symbol)) \
        .orderBy(F.col("trade_time_ms").desc(), F.col("trade_id").desc()).limit(n)


def late_flags(trades: DataFrame, partition: str = "partition", arrival: str = "arrival",
               time_col: str = "trade_time_ms", delay_ms: int = 5000,
               interval_ms: int = 60_000, chunk: int = 1 << 16) -> DataFrame:
    """Flag trades a bounded-out-of-orderness watermark would drop (O-83).

    Watermark before a row = max event time of the earlier rows of its
    source partition (arrival order) - delay; the row is late iff its
    window end is at or before it.  The running max is a chunked prefix
    scan (operators/scan.py), so a busy partition is not one task.
    """
    t = chunked_running(trades, [partition], [arrival], F.col(time_col), "max",
                        F.floor(F.col(arrival) / F.lit(chunk)), "_seen", exclusive=True)
    window_end = floor_to(time_col, interval_ms) + F.lit(interval_ms)
    late = F.coalesce(window_end <= F.col("_seen") - F.lit(delay_ms), F.lit(False))
    return t.withColumn("is_late", late).drop("_seen")

"""The three jobs as jobs: options in, running queries out (O-01..O-03, O-05,
O-54, O-59).

Each starter takes ``JobOptions`` and a checkpoint root.  The input defaults to
the topic the options name (``records`` / ``frames`` replace it, e.g. by landed
files); the sink is the database when ``jdbc_url`` is set, else a day-partitioned
file table.  The checkpoint, bar and EMA settings of the options apply here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbars.operators.tables import ON_CONFLICT_UPDATE
from tickbars.options import JobOptions
from tickbars.sources import jdbc as DB
from tickbars.sources import wire as W
from tickbars.streaming import jobs as J


def _props(o: JobOptions) -> dict[str, str]:
    return {k: v for k, v in (("user", o.jdbc_user), ("password", o.jdbc_password)) if v}


def _records(spark: SparkSession, o: JobOptions, records: DataFrame | None) -> DataFrame:
    return W.read_kafka(spark, o.bootstrap_servers, o.trade_topic) if records is None else records


def start_bars(spark: SparkSession, o: JobOptions, root: str, state_partitions: int,
               records: DataFrame | None = None, table: str | None = None):
    """Topic -> decode hop (trades, dead letters) -> bars, EMA and spread -> bar
    table.  Returns both running queries: (decode hop, bar job)."""
    hop = J.start_decode_hop(_records(spark, o, records), f"{root}/decoded", f"{root}/bars_dlq",
                             f"{root}/checkpoints/decode", processingTime=o.checkpoint_interval)
    bars = J.start_bar_job(
        None, table or f"{root}/ohlcv", f"{root}/checkpoints/bars", trigger=o.checkpoint_interval,
        delay=o.watermark_delay, interval=o.bar_interval, period=o.ema_period, state_partitions=state_partitions,
        dlq=f"{root}/broken_bars", writer=_bar_database(o) if o.jdbc_url else None,
        trades=J.read_decoded(spark, f"{root}/decoded"))
    return hop, bars


def _bar_database(o: JobOptions):
    write = DB.jdbc_writer(o.jdbc_url, "ohlcv", DB.SQL_BAR_KEY, ["window_start"] + [
        c for c in J.BAR_SINK_COLUMNS if c != "window_start_ms"], ON_CONFLICT_UPDATE, _props(o))
    return lambda df, batch: write(DB.bar_table_rows(df), batch)


def start_trades(spark: SparkSession, o: JobOptions, root: str, records: DataFrame | None = None,
                 table: str | None = None):
    """Topic -> side label -> trades table (the database when ``jdbc_url`` is
    set); bad records to dead letters."""
    return J.start_trade_job(_records(spark, o, records), table or f"{root}/trades", f"{root}/checkpoints/trades",
                             f"{root}/trades_dlq", trigger=o.checkpoint_interval,
                             writer=_trade_database(o) if o.jdbc_url else None)


def _trade_database(o: JobOptions):
    write = DB.jdbc_writer(o.jdbc_url, "trades", DB.SQL_TRADE_KEY, DB.SQL_TRADE_COLUMNS, [], _props(o))
    return lambda df, batch: write(DB.trade_table_rows(df), batch)


def subscribed(frames: DataFrame, o: JobOptions) -> DataFrame:
    """Frames of the symbols the options subscribe to; a frame that names no
    symbol (status, heartbeat, broken text) is kept."""
    lists = {"BINANCE": o.binance_symbols, "COINBASE": o.coinbase_symbols, "KRAKEN": o.kraken_symbols}
    symbol = F.upper(F.regexp_replace(frame_symbol("raw"), "[^A-Za-z0-9]", ""))
    wanted = F.lit(False)
    for source, symbols in lists.items():
        names = [x.upper().replace("-", "").replace("/", "") for x in symbols]
        wanted = wanted | ((F.col("source") == source) & symbol.isin(*names))
    return frames.filter(F.coalesce(wanted, F.lit(True)))


def frame_symbol(raw: str):
    """The symbol a raw frame names: feed 1 ``s`` (or the stream name), feed 2
    ``product_id``, feed 3 the first ``symbol``; null when there is none."""
    got = F.lit(None).cast("string")
    for pattern in (r'"s"\s*:\s*"([^"]+)"', r'"stream"\s*:\s*"([^"@]+)@', r'"product_id"\s*:\s*"([^"]+)"',
                    r'"symbol"\s*:\s*"([^"]+)"'):
        found = F.regexp_extract(raw, pattern, 1)
        got = F.coalesce(got, F.when(found != "", found))
    return got


def start_producer(spark: SparkSession, o: JobOptions, root: str, frames: DataFrame, to_kafka: bool = True,
                   state_partitions: int | None = None):
    """Captured frames of the subscribed symbols -> trades and dead letters, and
    the books of all three feeds: topics, or folders under ``root`` when
    ``to_kafka`` is off.  Returns both running queries: (frames, books)."""
    from tickbars.operators.feeds import parse_frames

    mine = subscribed(frames, o)
    write = J.feed_topics(o) if to_kafka else J.feed_writer(f"{root}/out")
    feeds = parse_frames(mine).writeStream.foreachBatch(write) \
        .option("checkpointLocation", f"{root}/checkpoints/producer").trigger(processingTime=o.checkpoint_interval).start()

    def to_topic(records: DataFrame, batch_id: int) -> None:
        W.write_kafka(records, o.bootstrap_servers, o.book_topic)

    books = J.start_book_topic(mine, to_topic if to_kafka else J.batch_writer(f"{root}/books"),
                               f"{root}/checkpoints/books", state_partitions=state_partitions,
                               processingTime=o.checkpoint_interval)
    return feeds, books

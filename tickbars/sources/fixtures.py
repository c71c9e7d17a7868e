"""Deterministic adapters from the driver's ``events`` table to the inputs
of a market-data pipeline (trades, frames, book deltas, wire records).

Everything here is a column projection of ``events`` (no shuffle), so the
fixtures scale with the table and partition like it.  The DuckDB oracle in
``oracle_queries.py`` computes the same adapters in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbars.functions.timefns import epoch_ms
from tickbars.sources.tables import read_table

# Fixed values of the adapter (must equal the SQL oracle's).
START_MS = 1704067200000          # 2024-01-01T00:00:00Z, first day of events
TIME_COMPRESSION = 60             # 30 days of events -> 12 hours of trades
SOURCES = ("BINANCE", "COINBASE", "KRAKEN")
BROKEN_EVERY = 50                 # raw frame is not JSON when event_id % 50 = 0
BOOK_FRAME_EVERY = 5              # event_id % 5 = 4 -> book frame, else trade frame
SNAPSHOT_EVERY = 97               # book delta is a snapshot when event_id % 97 = 0
LATE_EVERY = 7                    # late-trade fixture moves every 7th trade back
VERY_LATE_EVERY = 211             # late-stream fixture moves every 211th trade
VERY_LATE_MS = 14_400_000         # ... four hours back
DUPLICATE_EVERY = 10              # duplicate-trade fixture repeats every 10th trade


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events")


def _spread(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Rows dealt out round-robin over the default parallelism, for the per-row
    JSON work of the frame adapter: a table of any size can come back as few,
    uneven splits."""
    return df.repartition(spark.sparkContext.defaultParallelism)


def _k(df: DataFrame) -> Column:
    return F.get_json_object(F.col("props"), "$.k").cast("double")


def _source() -> Column:
    return (F.when(F.col("event_id") % 3 == 0, "BINANCE")
            .when(F.col("event_id") % 3 == 1, "COINBASE").otherwise("KRAKEN"))


def _trade_columns(ev: DataFrame) -> list[Column]:
    ms = epoch_ms(ev, "ts")
    btc = (F.col("user_id") % 2) == 0
    src = _source()
    raw_symbol = (F.when(src == "BINANCE", F.when(btc, "BTCUSDT").otherwise("ETHUSDT"))
                  .when(src == "COINBASE", F.when(btc, "BTC-USD").otherwise("ETH-USD"))
                  .otherwise(F.when(btc, "XBT/USD").otherwise("ETH/USD")))
    # integer division (ms - START) / 60, the same rounding as SQL '//'
    trade_time = F.lit(START_MS) + F.floor((ms - F.lit(START_MS)) / TIME_COMPRESSION).cast("bigint")
    lat = (F.col("user_id") % 97).cast("bigint")
    return [
        F.col("event_id").alias("trade_id"),
        F.when(btc, "BTCUSD").otherwise("ETHUSD").alias("symbol"),
        src.alias("source"),
        raw_symbol.alias("raw_symbol"),
        trade_time.alias("trade_time_ms"),
        F.col("value").alias("price"),
        ((_k(ev) + 1) / 100).alias("quantity"),
        F.col("event_type").isin("view", "signup").alias("is_buyer_maker"),
        (trade_time + lat).alias("ingestion_time_ms"),
        lat.alias("latency_ms"),
        F.col("event_id").alias("arrival"),
    ]


def _level_columns(ev: DataFrame) -> list[Column]:
    return [
        F.when(F.col("event_id") % SNAPSHOT_EVERY == 0, "snapshot").otherwise("update").alias("kind"),
        F.when(F.col("event_type").isin("view", "click"), "bid").otherwise("offer").alias("side"),
        (F.floor(F.col("value") / 5) * 5).cast("double").alias("level_price"),
        (_k(ev) % 5).alias("level_qty"),
    ]


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one normalised trade per event; ``arrival`` is the topic order."""
    ev = events(spark, sf_dir)
    return ev.select(*_trade_columns(ev))


def feed_symbol(raw_symbol: Column, source: Column) -> Column:
    """Symbol as the producer writes it to the trade topic (per-feed clean-up)."""
    from tickbars.functions.symbols import coinbase_symbol, kraken_symbol
    return (F.when(source == "COINBASE", coinbase_symbol(raw_symbol))
            .when(source == "KRAKEN", kraken_symbol(raw_symbol))
            .otherwise(raw_symbol))


def late_trades_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """every 7th trade moved back in time; partition = source."""
    t = trades(spark, sf_dir)
    shift = ((F.col("trade_id") * 7919) % 41) * 4000
    return t.withColumn(
        "trade_time_ms",
        F.when(F.col("trade_id") % LATE_EVERY == 0, F.col("trade_time_ms") - shift)
        .otherwise(F.col("trade_time_ms")),
    ).withColumn("partition", F.col("source"))


def late_stream_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2b: F2 with every 211th trade four hours late, so that a stream run in
    slices of an hour and a half drops some."""
    return late_trades_input(spark, sf_dir).withColumn("trade_time_ms", F.when(
        F.col("trade_id") % VERY_LATE_EVERY == 0, F.col("trade_time_ms") - VERY_LATE_MS).otherwise(F.col("trade_time_ms")))


def duplicate_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 plus a later second copy of every 10th trade."""
    t = trades(spark, sf_dir)
    dup = (t.filter(F.col("trade_id") % DUPLICATE_EVERY == 0)
           .withColumn("latency_ms", F.col("latency_ms") + 1000)
           .withColumn("ingestion_time_ms", F.col("ingestion_time_ms") + 1000)
           .withColumn("arrival", F.col("arrival") + 10_000_000))
    return t.unionByName(dup)


def _iso(ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def _num_text(c: Column) -> Column:
    return F.format_string("%.2f", c)


def book_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one level change per event; snapshot every 97th event."""
    ev = events(spark, sf_dir)
    return ev.select(
        _source().alias("source"),
        F.when(F.col("user_id") % 2 == 0, "BTCUSD").otherwise("ETHUSD").alias("symbol"),
        F.col("event_id").alias("seq"),
        *_level_columns(ev),
    ).withColumnsRenamed({"level_price": "price", "level_qty": "quantity"}) \
     .withColumn("sub", F.lit(0).cast("bigint"))


def raw_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one captured frame per event, in the shape each exchange sends.

    event_id % 5 = 4 gives an order-book frame, other events a trade frame;
    event_id % 50 = 0 is a broken (non-JSON) frame.
    """
    ev = _spread(spark, events(spark, sf_dir))
    j = ev.select(*_trade_columns(ev), *_level_columns(ev))
    src, sym = F.col("source"), F.col("raw_symbol")
    iso = _iso(F.col("trade_time_ms"))
    is_book = F.col("trade_id") % BOOK_FRAME_EVERY == BOOK_FRAME_EVERY - 1
    is_bid = F.col("side") == "bid"

    binance_trade = F.to_json(F.struct(
        F.concat(F.lower(sym), F.lit("@trade")).alias("stream"),
        F.struct(F.lit("trade").alias("e"), F.col("trade_time_ms").alias("E"), sym.alias("s"),
                 F.col("trade_id").alias("t"), _num_text(F.col("price")).alias("p"),
                 _num_text(F.col("quantity")).alias("q"), F.col("trade_time_ms").alias("T"),
                 F.col("is_buyer_maker").alias("m")).alias("data")))
    lvl_pair = F.array(F.array(_num_text(F.col("level_price")), _num_text(F.col("level_qty"))))
    empty_pairs = F.array().cast("array<array<string>>")
    binance_book = F.to_json(F.struct(
        F.concat(F.lower(sym), F.lit("@depth20@100ms")).alias("stream"),
        F.struct(F.when(is_bid, lvl_pair).otherwise(empty_pairs).alias("bids"),
                 F.when(is_bid, empty_pairs).otherwise(lvl_pair).alias("asks")).alias("data")))
    coinbase_trade = F.to_json(F.struct(
        F.lit("market_trades").alias("channel"),
        F.array(F.struct(F.array(F.struct(
            sym.alias("product_id"), _num_text(F.col("price")).alias("price"),
            _num_text(F.col("quantity")).alias("size"), F.col("trade_id").cast("string").alias("trade_id"),
            iso.alias("time"), F.when(F.col("is_buyer_maker"), "SELL").otherwise("BUY").alias("side"),
        )).alias("trades"))).alias("events")))
    coinbase_book = F.to_json(F.struct(
        F.lit("l2_data").alias("channel"),
        F.array(F.struct(
            F.col("kind").alias("type"), sym.alias("product_id"), iso.alias("time"),
            F.array(F.struct(F.col("side").alias("side"), _num_text(F.col("level_price")).alias("price_level"),
                             _num_text(F.col("level_qty")).alias("new_quantity"))).alias("updates"),
        )).alias("events")))
    kraken_trade = F.to_json(F.struct(
        F.lit("trade").alias("channel"),
        F.array(F.struct(
            sym.alias("symbol"), F.col("price").alias("price"), F.col("quantity").alias("qty"),
            F.col("trade_id").alias("trade_id"), iso.alias("timestamp"),
            F.when(F.col("is_buyer_maker"), "sell").otherwise("buy").alias("side"),
        )).alias("data")))
    k_lvl = F.array(F.struct(F.col("level_price").alias("price"), F.col("level_qty").alias("qty")))
    k_empty = F.array().cast("array<struct<price:double,qty:double>>")
    kraken_book = F.to_json(F.struct(
        F.lit("book").alias("channel"), F.col("kind").alias("type"),
        F.array(F.struct(
            sym.alias("symbol"), iso.alias("timestamp"),
            F.when(is_bid, k_lvl).otherwise(k_empty).alias("bids"),
            F.when(is_bid, k_empty).otherwise(k_lvl).alias("asks"),
        )).alias("data")))

    frame = (F.when(F.col("trade_id") % BROKEN_EVERY == 0,
                    F.concat(F.lit("not json "), F.col("trade_id").cast("string")))
             .when(src == "BINANCE", F.when(is_book, binance_book).otherwise(binance_trade))
             .when(src == "COINBASE", F.when(is_book, coinbase_book).otherwise(coinbase_trade))
             .otherwise(F.when(is_book, kraken_book).otherwise(kraken_trade)))
    return j.select(src.alias("source"), F.col("trade_id").alias("seq"),
                    F.col("ingestion_time_ms").alias("recv_ms"), frame.alias("raw"))


def wire_records(spark: SparkSession, sf_dir: str, duplicates: bool = False) -> DataFrame:
    """the trade topic as Kafka would return it (key, value, partition,
    offset, timestamp); with ``duplicates`` the F3 redeliveries are added
    (offset = their later arrival)."""
    t = duplicate_trades(spark, sf_dir) if duplicates else trades(spark, sf_dir)
    value = F.to_json(F.struct(
        F.lit("trade").alias("e"), F.col("trade_time_ms").alias("E"),
        feed_symbol(F.col("raw_symbol"), F.col("source")).alias("s"),
        F.col("trade_id").alias("t"), F.col("price").alias("p"), F.col("quantity").alias("q"),
        F.col("trade_time_ms").alias("T"), F.col("is_buyer_maker").alias("m"),
        F.col("source").alias("source"), F.col("ingestion_time_ms").alias("ingestionTimeMs"),
        F.col("latency_ms").alias("latencyMs"), F.lit("x").alias("unknownField"),
    ))
    return t.select(
        F.col("raw_symbol").alias("key"), value.alias("value"),
        (F.col("trade_id") % 3).cast("int").alias("partition"),
        F.col("arrival").alias("offset"),
        F.timestamp_millis(F.col("ingestion_time_ms")).alias("timestamp"),
    )


def bad_wire_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """topic records of which some cannot be decoded (no JSON, no object, a
    price that is no number or NaN), some break a constraint of the trades table
    (no source, a long symbol) and some only miss a field, which is not bad."""
    records = wire_records(spark, sf_dir)
    trade_id, v = F.col("offset"), F.col("value")
    at = lambda n: trade_id % n == 0
    return records.withColumn("value", F.when(at(101), F.lit("not json")).when(at(103), F.lit("[1, 2]"))
                              .when(at(107), F.regexp_replace(v, '"p":[^,]+', '"p":"abc"'))
                              .when(at(109), F.regexp_replace(v, '"p":[^,]+', '"p":"NaN"'))
                              .when(at(113), F.regexp_replace(v, '"T":[^,]+,', ""))
                              .when(at(127), F.regexp_replace(v, '"source":"[^"]*"', '"source":null'))
                              .when(at(131), F.regexp_replace(v, '"s":"[^"]*"', '"s":"' + "S" * 21 + '"')).otherwise(v))


def broken_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8: rows of the trades table, some of which break a constraint (nulls and
    over-long texts at fixed ids)."""
    from tickbars.operators.trades import enrich_side

    t = enrich_side(trades(spark, sf_dir))
    at = lambda n: F.col("trade_id") % n == 0
    return t.withColumns({
        "trade_time_ms": F.when(~at(59), F.col("trade_time_ms")),
        "symbol": F.when(at(37), F.lit(None)).when(at(41), F.repeat(F.lit("S"), 21)).otherwise(F.col("symbol")),
        "source": F.when(at(43), F.repeat("source", 4)).otherwise(F.col("source")),
        "price": F.when(~at(47), F.col("price")),
        "quantity": F.when(~at(53), F.col("quantity")),
        "side": F.when(at(61), "LONGER").otherwise(F.col("side")),
    })

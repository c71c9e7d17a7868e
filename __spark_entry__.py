"""

(spark, sf_dir) -> DataFrame over the whole test tables; ``oracle_sql()``
gives the DuckDB SQL for the same key (see oracle_queries.py).  Computed
doubles are rounded to 6 places on both sides.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle_queries import PANEL_FROM, PANEL_SYMBOL, PANEL_TO, SILENCE_MS  # noqa: E402
from oracle_queries import oracle_sql as _oracle_sql  # noqa: E402
from tickbars import session as S  # noqa: E402
from tickbars.functions.symbols import canonical_symbol, composite_key, split_composite_key  # noqa: E402
from tickbars.functions.timefns import iso_to_ms, ms_to_ts  # noqa: E402
from tickbars.operators import book as BK  # noqa: E402
from tickbars.operators import feeds as FD  # noqa: E402
from tickbars.operators import tables as TB  # noqa: E402
from tickbars.operators import trades as TR  # noqa: E402
from tickbars.operators.bars import ohlcv_bars, rollup_bars  # noqa: E402
from tickbars.operators.spread import match_sources, match_sources_join, spread_bars  # noqa: E402
from tickbars.plans import panels as P  # noqa: E402
from tickbars.plans.jobs import bar_job, bars_with_ema  # noqa: E402
from tickbars.sources import fixtures as FX  # noqa: E402
from tickbars.sources import wire as W  # noqa: E402
from tickbars.streaming import jobs as J  # noqa: E402

try:  # the corpus operators are an optional subpackage
    from tickbars.llm import queries as LLM
except ImportError:
    LLM = None
try:
    import corpus_pipeline as PIPELINE
except ImportError:
    PIPELINE = None

SMOKE_DIR = "/root/testdata/sf0.001"


# Rounding for the cross-engine check: sums run in different orders, so the
# last bits differ; values such as 22.6934375 sit exactly on a 7th-decimal
# tie and would round apart.  Both sides therefore round x + 1e-9 to 6 places.
TIE_SHIFT = 1e-9


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every double column for the oracle comparison."""
    cols = [F.round(F.col(f.name) + F.lit(TIE_SHIFT), places).alias(f.name)
            if isinstance(f.dataType, T.DoubleType) else F.col(f.name) for f in df.schema.fields]
    return df.select(*cols)


def _trades(spark, d):
    S.configure(spark)
    return FX.trades(spark, d)


def _bars(spark, d):
    return ohlcv_bars(_trades(spark, d))


def _job(spark, d):
    return bar_job(_trades(spark, d))


_BAR_TABLES: dict[tuple[str, str], str] = {}


def _bar_table(spark, d):
    """The stored bar table the dashboard reads, day-partitioned: the bar job
    writes it once per application and input."""
    key = spark.sparkContext.applicationId, d
    if key not in _BAR_TABLES:
        path = S.fresh_path(S.configure(spark), "bar-table")
        TB.write_partitioned(_job(spark, d), path, "window_start_ms")
        _BAR_TABLES[key] = path
    return _BAR_TABLES[key]


def _panel_rows(spark, d):
    """One symbol and time range of the bar table: days are pruned, symbol and
    time are pushed into the scan."""
    return TB.scan_filtered(spark, _bar_table(spark, d), "window_start_ms", symbol=PANEL_SYMBOL,
                            t_from=PANEL_FROM, t_to=PANEL_TO)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the bar job's table rows (OHLCV + EMA-10 + spread) at sf0.001."""
    return rounded(_job(spark, SMOKE_DIR))


def _queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    q["ohlcv_bars"] = lambda s, d: _bars(s, d)
    q["bar_vwap"] = lambda s, d: _bars(s, d).select("symbol", "source", "window_start_ms", "vwap")
    q["ema10"] = lambda s, d: bars_with_ema(_trades(s, d))
    q["match_sources"] = lambda s, d: match_sources(bars_with_ema(_trades(s, d)))
    q["match_sources_join"] = lambda s, d: match_sources_join(S.materialize(_bars(s, d), "bars"))
    q["spread_bars"] = lambda s, d: _job(s, d)
    q["canonical_symbol"] = lambda s, d: _trades(s, d).select(
        "trade_id", "raw_symbol", canonical_symbol("raw_symbol").alias("canonical"))
    for name in ["panel_candles", "panel_vwap", "panel_buy_sell", "panel_close_ema",
                 "panel_imbalance", "spread_usd_series", "spread_bps_series"]:
        q[name] = (lambda fn: lambda s, d: fn(_panel_rows(s, d), PANEL_SYMBOL, PANEL_FROM, PANEL_TO))(getattr(P, name))
    q["distinct_symbols"] = lambda s, d: P.distinct_symbols(s.read.parquet(_bar_table(s, d)))
    q["latest_bars"] = lambda s, d: TB.newest_rows(s, _bar_table(s, d), 10, P.newest_first())
    q["bar_rollup"] = lambda s, d: rollup_bars(_bars(s, d), 5 * 60_000)
    q.update(_feed_queries())
    q.update(_trade_queries())
    return q


HOUR_MS = 3_600_000
LATE_BATCHES = 8


def _wire(spark, d):
    S.configure(spark)
    return FX.wire_records(spark, d)


def _decoded(spark, d):
    return W.decode_trades(_wire(spark, d)).drop("arrival_order")


def _trade_queries():
    q = {}
    q["decode_wire_json"] = lambda s, d: _decoded(s, d)
    q["encode_wire_json"] = lambda s, d: W.encode_trades(_decoded(s, d))
    q["enrich_side"] = lambda s, d: TR.enrich_side(_decoded(s, d))
    q["trade_latency"] = lambda s, d: TR.with_latency(
        W.decode_trades(_wire(s, d), keep=("timestamp",)), F.unix_millis("timestamp")).select(
        "trade_id", "ingestion_time_ms", "latency_ms")
    q["epoch_ms_roundtrip"] = lambda s, d: _trades(s, d).select(
        "trade_id", "trade_time_ms",
        F.unix_millis(ms_to_ts("trade_time_ms")).alias("ts_ms"),
        F.date_format(ms_to_ts("trade_time_ms"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("iso"),
        iso_to_ms(F.date_format(ms_to_ts("trade_time_ms"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")).alias("iso_ms"))
    q["composite_key_split"] = lambda s, d: _composite(_trades(s, d))
    q["insert_ignore_trades"] = _insert_ignore
    q["late_trades"] = lambda s, d: TR.late_flags(FX.late_trades_input(S.configure(s), d)).select(
        "trade_id", "source", "trade_time_ms", "is_late")
    q["retain_trades"] = lambda s, d: TR.retain(TR.enrich_side(_trades(s, d)), keep_ms=6 * HOUR_MS)
    q["latest_trades_by_symbol"] = _latest_trades
    q["upsert_bars_merge"] = _upsert
    q["constraint_violations"] = lambda s, d: TB.constraint_report(
        FX.broken_trades(S.configure(s), d), TB.TRADE_NOT_NULL)
    q["constraint_dead_letters"] = lambda s, d: TB.split_valid(
        FX.broken_trades(S.configure(s), d), TB.TRADE_NOT_NULL)[1].select("trade_id", "reason")
    q["bars_scan_filtered"] = _bars_scan
    q["book_levels_asof"] = lambda s, d: BK.book_levels_asof(FX.book_deltas(S.configure(s), d))
    q["book_top20"] = lambda s, d: BK.book_top(FX.book_deltas(S.configure(s), d))
    q["book_from_frames"] = lambda s, d: BK.book_top(S.materialize(FD.book_rows(_frames(s, d)), "book-levels"))
    q.update(_stream_queries())
    return q


def _stream_queries():
    """Real Structured Streaming runs (file source, availableNow, fresh
    checkpoint under spark.checkpoint.dir); the sink is read back."""
    q = {}
    q["stream_ohlcv_bars"] = lambda s, d: J.run_bar_job(s, _trades(s, d), what="bars")
    q["stream_ema10"] = lambda s, d: J.run_bar_job(s, _trades(s, d), what="ema").drop("bar_time")
    q["stream_spread_bars"] = lambda s, d: J.run_bar_job(s, _trades(s, d), what="spread")
    q["stream_restart"] = lambda s, d: J.run_bar_job(s, _trades(s, d), stages=(2,), what="spread")
    q["stream_crash_restart"] = lambda s, d: J.run_crash_job(s, _trades(s, d))[0]
    q["stream_enrich_trades"] = lambda s, d: J.run_trade_job(s, FX.wire_records(S.configure(s), d, duplicates=True))
    q["stream_late_drop"] = lambda s, d: J.run_bar_job(
        s, FX.late_stream_input(S.configure(s), d), batches=LATE_BATCHES, what="bars")
    q["stream_book"] = lambda s, d: FD.flatten_book(
        J.run_book_job(s, FX.book_deltas(S.configure(s), d)), ["source", "symbol", "seq", "sub"])
    q["stream_book_topic"] = _book_topic
    q["stream_feed_liveness"] = lambda s, d: J.run_liveness(s, _frames(s, d), SILENCE_MS)
    q["stream_upsert_replay"] = lambda s, d: J.run_upsert_replay(s, _trades(s, d))
    q["stream_union_feeds"] = lambda s, d: _stream_feeds(s, d, "trades")
    q["stream_dead_letters"] = lambda s, d: _stream_feeds(s, d, "dlq")
    q["stream_bars_from_frames"] = lambda s, d: J.run_frames_to_bars(s, _frames(s, d))
    q["wire_dead_letters"] = lambda s, d: s.read.parquet(
        J.run_decode_hop(s, FX.bad_wire_records(S.configure(s), d))[1]).select("partition", "offset", "error")
    q["stream_trade_source"] = lambda s, d: J.run_decode_job(s, FX.wire_records(S.configure(s), d)).drop("arrival_order")
    return q


def _book_topic(spark, d):
    """The records of the book topic, decoded again: a row per level, and one
    without a level for an empty book."""
    level = "array<struct<price:double,quantity:double>>"
    books = J.run_book_topic(spark, _frames(spark, d)).select("key", F.from_json(
        "value", f"source string, symbol string, timestampMs long, bids {level}, asks {level}").alias("b"))
    side = lambda n, label: F.transform(f"b.{n}", lambda x, i: F.struct(
        F.lit(label).alias("side"), (i + 1).alias("level"), x["price"].alias("price"), x["quantity"].alias("quantity")))
    rows = books.select("key", "b.source", "b.symbol", F.col("b.timestampMs").alias("timestamp_ms"),
                        F.explode_outer(F.concat(side("bids", "bid"), side("asks", "ask"))).alias("l"))
    return rows.select("key", "source", "symbol", "timestamp_ms", "l.side", "l.level", "l.price", "l.quantity")


def _stream_feeds(spark, d, output):
    out, _ = J.run_feed_job(spark, _frames(spark, d))
    return spark.read.parquet(f"{out}/{output}").drop("batch")


def _composite(trades):
    k = composite_key(F.col("symbol"), F.col("source"))
    sym, src = split_composite_key(k)
    return trades.select("trade_id", k.alias("key"), sym.alias("key_symbol"), src.alias("key_source"))


def _insert_ignore(spark, d):
    """Table holds the first 6 hours; the batch is every trade plus a later
    second copy of every 10th one (F3).  Result: each trade once, first copy."""
    t = _trades(spark, d)
    table = TR.enrich_side(t.filter(F.col("trade_time_ms") < F.lit(FX.START_MS + 6 * HOUR_MS)))
    dup = FX.duplicate_trades(spark, d)
    batch = dup.select("trade_time_ms", "symbol", "source", "trade_id", "price", "quantity",
                       TR.side_label(F.col("is_buyer_maker")).alias("side"), "ingestion_time_ms",
                       "latency_ms", "arrival")
    return TR.insert_ignore(table, batch)


def _latest_trades(spark, d):
    """The (symbol, trade_time DESC) access path: the trades table is written
    day-partitioned with files sorted by symbol and time descending, then
    read with the symbol filter pushed into the scan (row groups of other
    symbols are skipped by their min/max statistics) and a top-20."""
    path = S.fresh_path(spark, "trades")
    TB.write_partitioned(TR.enrich_side(_trades(spark, d)), path, "trade_time_ms",
                         sort_cols=["symbol", F.col("trade_time_ms").desc()])
    table = spark.read.parquet(path).drop("d")
    return TR.latest_trades(table, "BTCUSD", 20)


def _upsert(spark, d):
    """Target: bars of the first 8 hours with spread 0; updates: the bar
    job's spread rows with close + 1 (F6)."""
    bars = bars_with_ema(_trades(spark, d))
    target = bars.filter(F.col("window_start_ms") < F.lit(FX.START_MS + 8 * HOUR_MS)) \
        .withColumns({"spread_usd": F.lit(0.0), "spread_bps": F.lit(0.0)}).select(*TB.BAR_TABLE_COLUMNS)
    updates = spread_bars(bars).withColumn("close", F.col("close") + 1).select(*TB.BAR_TABLE_COLUMNS)
    return TB.merge_upsert(target, updates)


def _bars_scan(spark, d):
    """Write the bar table day-partitioned under the shared folder, then
    read it back with the dashboard's pushed-down filters."""
    path = S.fresh_path(spark, "ohlcv")
    TB.write_partitioned(bar_job(_trades(spark, d)).select(*TB.BAR_TABLE_COLUMNS), path, "window_start_ms")
    return TB.scan_filtered(spark, path, "window_start_ms", symbol="BTCUSD", source="BINANCE",
                            t_from=FX.START_MS + HOUR_MS, t_to=FX.START_MS + 5 * HOUR_MS)


def _frames(spark, d):
    S.configure(spark)
    return FX.raw_frames(spark, d)


def _deltas(spark, d, source):
    """Level changes of one feed: the other feeds' frames are not parsed."""
    return FD.book_rows(_frames(spark, d).filter(F.col("source") == source)).filter("not header").drop("header")


def _published_books(spark, d):
    """The book topic's content: every feed's snapshots after every message."""
    frames = S.materialize(_frames(spark, d), "frames")
    feed1 = FD.feed1_books(frames).withColumn("sub", F.lit(0).cast("long"))
    rebuilt = BK.book_snapshots(S.materialize(FD.book_rows(frames), "book-levels"))
    cols = ["source", "symbol", "seq", "sub", "timestamp_ms", "bids", "asks"]
    return feed1.select(*cols).unionByName(rebuilt.select(*cols))


def _feed_queries():
    q = {}
    q["raw_frames_scan"] = lambda s, d: FD.parse_frames(_frames(s, d), want=()).select(
        "source", "seq", "recv_ms", "kind")
    q["feed_demux"] = lambda s, d: FD.demux(_frames(s, d))
    for i, src in ((1, "BINANCE"), (2, "COINBASE"), (3, "KRAKEN")):
        q[f"normalize_feed{i}"] = (lambda src: lambda s, d: FD.normalize(_frames(s, d), src))(src)
    q["union_feeds"] = lambda s, d: FD.union_feeds(_frames(s, d))
    q["dead_letters"] = lambda s, d: FD.dead_letters(_frames(s, d))
    q["feed_counts"] = lambda s, d: FD.feed_counts(_frames(s, d))
    q["book_feed1"] = lambda s, d: FD.flatten_book(
        FD.feed1_books(_frames(s, d)), ["source", "seq", "symbol", "timestamp_ms"])
    q["book_feed2_deltas"] = lambda s, d: _deltas(s, d, "COINBASE")
    q["book_feed3_deltas"] = lambda s, d: _deltas(s, d, "KRAKEN")
    q["symbol_filter"] = lambda s, d: _symbol_filter(_trades(s, d))
    q["bars_from_frames"] = lambda s, d: ohlcv_bars(
        FD.union_feeds(_frames(s, d)).withColumn("arrival", FD.frame_order()))
    q["encode_book_json"] = lambda s, d: W.encode_books(FD.feed1_books(_frames(s, d)))
    q["book_snapshots"] = lambda s, d: FD.flatten_book(
        _published_books(s, d), ["source", "symbol", "seq", "sub", "timestamp_ms"])
    q["book_messages"] = lambda s, d: _published_books(s, d).select(
        "source", "symbol", "seq", "sub", "timestamp_ms", F.size("bids").alias("n_bids"), F.size("asks").alias("n_asks"))
    q["encode_dead_letters"] = lambda s, d: W.encode_dead_letters(FD.dead_letters(_frames(s, d)))
    return q


def _symbol_filter(trades):
    """Subscriptions per feed, configured the way the fixture was captured
    (feed 3 names the pair XBT/USD)."""
    from tickbars.options import JobOptions
    o = JobOptions.from_env({"KRAKEN_SYMBOLS": "XBT/USD"})
    subs = {"BINANCE": o.binance_symbols, "COINBASE": o.coinbase_symbols, "KRAKEN": o.kraken_symbols}
    pred = None
    for src, syms in subs.items():
        p = (F.col("source") == src) & F.col("raw_symbol").isin(*syms)
        pred = p if pred is None else pred | p
    return trades.filter(pred).select("trade_id", "source", "raw_symbol")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {k: (lambda fn: lambda spark, sf_dir: rounded(fn(spark, sf_dir)))(fn)
           for k, fn in _queries().items()}
    if LLM:
        out.update(LLM.queries())
    if PIPELINE:
        out["pipeline"] = PIPELINE.run
    return out


def oracle_sql() -> dict[str, str]:
    out = _oracle_sql()
    if LLM:
        out.update(LLM.oracle_sql())
    if PIPELINE and PIPELINE.ORACLE_SQL:
        out["pipeline"] = PIPELINE.ORACLE_SQL
    return out

import duckdb

import __spark_entry__ as E
from tools.check_oracle import digest

SF = "/root/testdata/sf0.001"


def test_stream_equals_batch_on_closed_windows_with_restart(spark):
    con = duckdb.connect()
    con.execute(f"create view events as select * from read_parquet('{SF}/events.parquet')")
    got = E.queries()["stream_restart"](spark, SF).toPandas()
    exp = con.execute(E.oracle_sql()["stream_restart"]).fetchdf()
    assert len(got) == len(exp) > 0
    assert digest(got) == digest(exp[got.columns])


def test_trade_stream_dedupes(spark):
    got = E.queries()["stream_enrich_trades"](spark, SF)
    assert got.count() == 1000
    assert got.select("trade_id").distinct().count() == 1000


def test_feed_stream_counters(spark):
    from tickbars.sources import fixtures as FX
    from tickbars.streaming import jobs as J

    out, counters = J.run_feed_job(spark, FX.raw_frames(spark, SF))
    assert counters["frames"] == 1000 and counters["not_json"] == 20
    assert counters["produced"] == 780 and counters["dead_letters"] == 20
    assert spark.read.parquet(f"{out}/dlq").count() == 20
    assert spark.read.parquet(f"{out}/trades").count() == 780


def test_production_starters_on_files(spark):
    from pyspark.sql import functions as F

    from tickbars import session as S
    from tickbars.sources import fixtures as FX
    from tickbars.streaming import jobs as J

    base = S.fresh_path(spark, "starter")
    J.land_batches(spark, FX.wire_records(spark, SF), "offset", 2, base)
    q1 = J.start_trade_job(J.read_records(spark, base), f"{base}/trades", f"{base}/ck-trades")
    q2 = J.start_bar_job(J.read_records(spark, base), f"{base}/ohlcv", f"{base}/ck-bars")
    for q in (q1, q2):
        q.processAllAvailable()
        q.stop()
    assert spark.read.parquet(f"{base}/trades").count() == 1000
    bars = spark.read.parquet(f"{base}/ohlcv")
    assert bars.count() > 0 and bars.filter(F.col("spread_usd").isNull()).count() == 0


def test_trade_job_dead_letters(spark):
    from pyspark.sql import functions as F

    from tickbars.sources import fixtures as FX
    from tickbars.streaming import jobs as J

    rec = FX.wire_records(spark, SF)
    broken = rec.filter(F.col("offset") % 100 == 0).withColumn("value", F.lit("{broken"))
    mixed = rec.filter(F.col("offset") % 100 != 0).unionByName(broken)
    table = J.run_trade_job(spark, mixed)
    assert table.count() == 990
    base = table.inputFiles()[0].split("/table/")[0]
    assert spark.read.parquet(f"{base}/dlq").count() == 10


def test_late_drop_rule_on_handmade_batches(spark):
    """A row of micro-batch N is dropped iff its window end <= (max event time
    of batches <= N-2) - 5 s.  Batch 2 holds a trade at 50 s (window end 60 s
    <= 100 s - 5 s: dropped) and one at 150 s (window [120, 180) s is still
    open: counted)."""
    from tickbars.streaming import jobs as J

    cols = J.TRADE_FILE_SCHEMA.simpleString()[len("struct<"):-1]
    times = [100_000, 101_000, 200_000, 201_000, 50_000, 150_000]
    rows = [(i, "BTCUSDT", "BINANCE", t, 10.0 + i, 1.0, False, t, 0, i) for i, t in enumerate(times)]
    m = {}
    bars = J.run_bar_job(spark, spark.createDataFrame(rows, cols), batches=3, what="bars", metrics=m)
    assert m["dropped_late"] == 1
    got = sorted((r.window_start_ms, r.trade_count) for r in bars.collect())
    assert got == [(60_000, 2), (120_000, 1)]


def test_counters_outlive_the_progress_reports(spark):
    """More batches than a query keeps reports of: totals stay whole."""
    from tickbars.sources import fixtures as FX
    from tickbars.streaming import jobs as J

    key = "spark.sql.streaming.numRecentProgressUpdates"
    spark.conf.set(key, "3")
    try:
        _, counters = J.run_feed_job(spark, FX.raw_frames(spark, SF), batches=5)
        assert counters["frames"] == 1000 and counters["dead_letters"] == 20
        cols = J.TRADE_FILE_SCHEMA.simpleString()[len("struct<"):-1]
        times = [100_000, 101_000, 200_000, 201_000, 50_000, 150_000, 300_000, 301_000, 400_000, 50_001, 500_000, 500_001]
        rows = [(i, "BTCUSDT", "BINANCE", t, 10.0 + i, 1.0, False, t, 0, i) for i, t in enumerate(times)]
        m = {}
        J.run_bar_job(spark, spark.createDataFrame(rows, cols), batches=6, what="bars", metrics=m)
        assert m["dropped_late"] == 2
    finally:
        spark.conf.unset(key)


def test_stream_book_keeps_emptied_books_over_batches(spark):
    """Stream and batch publish the same books: emptied ones, snapshots and
    levels carried from one micro-batch to the next, times included."""
    from pyspark.sql import functions as F

    from tests.test_book import COLS, _random_rows
    from tickbars.operators import book as B
    from tickbars.streaming import jobs as J

    deltas = spark.createDataFrame(_random_rows(5, 200), COLS).withColumn("timestamp_ms", F.col("seq") * 10)
    cols = ["source", "symbol", "seq", "sub", "timestamp_ms", "bids", "asks"]
    got = sorted(J.run_book_job(spark, deltas, batches=3, depth=4).select(*cols).collect())
    exp = sorted(B.replayed_books(deltas, 4, bucket=8).select(*cols).collect())
    assert got == exp and any(not r.bids and not r.asks for r in got)


def test_stream_book_hands_on_runs_of_a_key(spark, monkeypatch):
    """A key's messages leave the state in runs with the book before each; replayed
    anywhere they are the batch's books."""
    from pyspark.sql import functions as F

    from tests.test_book import COLS, _random_rows
    from tickbars.operators import book as B
    from tickbars.operators.replay import replay_runs
    from tickbars.streaming import jobs as J
    from tickbars.streaming import processors as P
    import pyarrow as pa

    run = {"source": "A", "symbol": "B", "seq": [7, 8], "sub": [0, 0], "timestamp_ms": [None, 5], "snapshot": [False, True],
           "changes": [1, 1], "is_bid": [True, False], "price": [10.0, 11.0], "quantity": [0.0, 2.0], "keep": [False, False],
           "bid_price": [10.0, 9.0], "bid_quantity": [1.0, 3.0], "ask_price": [12.0], "ask_quantity": [4.0]}
    rows = [r for b in replay_runs(5, ["source", "symbol"])([pa.RecordBatch.from_pylist([run])]) for r in b.to_pylist()]
    assert [(r["seq"], r["timestamp_ms"], r["bid_price"], r["ask_price"], r["ask_quantity"]) for r in rows] \
        == [(7, None, [9.0], [12.0], [4.0]), (8, 5, [], [11.0], [2.0])]
    monkeypatch.setattr(P.BookProcessor.__init__, "__defaults__", (8,))
    monkeypatch.setattr(P, "RUNS", 3)
    time = F.when(F.col("seq") % 3 > 0, F.col("seq") * 10)
    deltas = spark.createDataFrame(_random_rows(6, 200), COLS).withColumn("timestamp_ms", time)
    cols = ["source", "symbol", "seq", "sub", "timestamp_ms", "bids", "asks"]
    got = sorted(map(str, J.run_book_job(spark, deltas, batches=2, depth=4).select(*cols).collect()))
    assert got and got == sorted(map(str, B.replayed_books(deltas, 4, bucket=8).select(*cols).collect()))


def test_book_topic_and_liveness_keys(spark):
    con = duckdb.connect()
    con.execute(f"create view events as select * from read_parquet('{SF}/events.parquet')")
    for key in ("stream_book_topic", "stream_feed_liveness"):
        got = E.queries()[key](spark, SF).toPandas()
        exp = con.execute(E.oracle_sql()[key]).fetchdf()
        assert len(got) == len(exp) > 0, key
        assert digest(got) == digest(exp[got.columns]), key


def test_feed_liveness_on_a_gap(spark):
    from tickbars.operators.feeds import feed_liveness

    rows = [("A", t) for t in (0, 10, 109, 209, 310, 500)] + [("B", 50), (None, 60), ("A", None)]
    got = sorted(tuple(r) for r in feed_liveness(spark.createDataFrame(rows, "source string, recv_ms long"), 100).collect())
    # 109 to 209 is a gap of exactly 100: no silence; 209 to 310 is longer
    assert got == [("A", 0, True), ("A", 309, False), ("A", 310, True), ("A", 410, False), ("A", 500, True),
                   ("A", 600, False), ("B", 50, True), ("B", 150, False)]


def test_idle_key_starts_again_from_its_seed(spark):
    """A key that is silent longer than idle_ms is forgotten; another is kept."""
    from tickbars.streaming import jobs as J

    cols = J.TRADE_FILE_SCHEMA.simpleString()[len("struct<"):-1]
    m = 60_000
    ticks = [("A", 0, 10.0), ("A", m, 20.0)] + [("B", i * m, 10.0 + i) for i in range(30)] + [("A", 29 * m, 40.0)] \
        + [("B", i * m, 10.0 + i) for i in range(30, 34)]
    rows = [(i, s, "BINANCE", t, p, 1.0, False, t, 0, i) for i, (s, t, p) in enumerate(sorted(ticks, key=lambda x: x[1]))]
    df = spark.createDataFrame(rows, cols)
    for idle, last in ((None, None), (5 * m, 40.0)):
        out = J.run_bar_job(spark, df, batches=6, what="ema", idle_ms=idle)
        got = {(r.symbol, r.window_start_ms): r.ema10 for r in out.collect()}
        a, first = 2 / 11, 10.0
        second = a * 20 + (1 - a) * first
        assert abs(got["A", 29 * m] - (last or a * 40 + (1 - a) * second)) < 1e-9
        ema = 10.0
        for i in range(1, 31):
            ema = a * (10.0 + i) + (1 - a) * ema
            assert abs(got["B", i * m] - ema) < 1e-9


def test_stop_between_state_and_sink(spark):
    """Stopped inside a batch, the job ends with the rows and the state of an
    uninterrupted run."""
    from tickbars.sources import fixtures as FX
    from tickbars.streaming import jobs as J

    trades = FX.trades(spark, SF)
    whole, ck1 = J.run_crash_job(spark, trades, at=None)
    broken, ck2 = J.run_crash_job(spark, trades, at=2)
    got = [sorted(map(str, df.collect())) for df in (whole, broken)]
    assert got[0] and got[0] == got[1]
    states = []
    for ck in (ck1, ck2):
        read = [spark.read.format("statestore").option("operatorId", k).load(ck).select("key", "value") for k in (0, 2)]
        states.append([sorted(map(str, df.collect())) for df in read])
    assert states[0] == states[1] and any(states[0])

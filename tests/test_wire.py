"""Wire decoding: case-distinct keys, lenient numbers, unknown keys ignored,
defaults for missing primitives, non-objects undecodable."""

from tickbars.sources import wire as W


def test_decode_and_undecodable(spark):
    vals = ['{"e":"trade","E":5,"s":"BTCUSDT","t":"12","p":"1.5","q":2,"T":9,"m":"true","zz":1}',
            '{"s":"ETHUSDT"}', '{broken', '123', '[1]']
    recs = spark.createDataFrame([(v, i) for i, v in enumerate(vals)], "value string, offset long")
    got = {r.arrival: r for r in W.decode_trades(recs).collect()}
    a = got[0]
    assert (a.event_type, a.event_time_ms, a.trade_id, a.price, a.quantity, a.trade_time_ms, a.is_buyer_maker) == \
        ("trade", 5, 12, 1.5, 2.0, 9, True)
    b = got[1]
    assert (b.symbol, b.price, b.trade_id, b.is_buyer_maker, b.event_type) == ("ETHUSDT", 0.0, 0, False, None)
    assert set(got) == {0, 1}
    assert sorted(r.offset for r in W.undecodable(recs).collect()) == [2, 3, 4]


def test_present_but_bad_is_a_dead_letter(spark):
    vals = ['{"s":"A","p":"abc"}', '{"s":"A","p":"NaN"}', '{"s":"A","q":"x"}', '{"s":"A","T":"soon"}', '{"s":"A","m":"perhaps"}',
            '{"s":"A","p":null}', '{"s":"A","t":"7"}']
    recs = spark.createDataFrame([(v, i) for i, v in enumerate(vals)], "value string, offset long")
    assert sorted(r.offset for r in W.undecodable(recs).collect()) == [0, 1, 2, 3, 4]
    assert sorted((r.offset, r.price, r.trade_id) for r in W.decode_trades(recs).collect()) == [(5, 0.0, 0), (6, 0.0, 7)]


def test_arrival_order_compares_partitions(spark):
    """Two partitions: the lower offset can be the later record."""
    from pyspark.sql import functions as F

    from tickbars.operators.bars import ohlcv_bars

    rows = [('{"s":"BTCUSDT","source":"X","p":100,"q":1,"T":60000}', 0, 5000, 60_000),
            ('{"s":"BTCUSD","source":"X","p":200,"q":1,"T":61000}', 1, 7, 61_000)]
    recs = spark.createDataFrame(rows, "value string, partition int, offset long, ms long") \
        .withColumn("timestamp", F.timestamp_millis("ms"))
    bar = ohlcv_bars(W.decode_trades(recs), arrival="arrival_order").first()
    assert (bar.open, bar.close) == (100.0, 200.0)


def test_each_path_is_read_once(spark):
    """One parse and two struct reads, whatever reads the decoded rows."""
    recs = spark.createDataFrame([("{}", 0, 1)], "value string, partition int, offset long").selectExpr(
        "*", "timestamp_millis(0) as timestamp")
    for df in (W.decode_trades(recs), W.undecodable(recs), W.decode_trades(recs).filter("price > 1").select("symbol")):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("variant_get(") <= 2 and plan.count("parse_json(") <= 1


def test_nested_values_are_bad(spark):
    vals = ['{"s":"A","p":{"x":1}}', '{"s":"A","q":[1]}', '{"s":"A","m":{}}', '{"s":"A","unknown":{"x":[1]}}', None, "  {} "]
    recs = spark.createDataFrame([(v, i) for i, v in enumerate(vals)], "value string, offset long")
    assert sorted(r.offset for r in W.undecodable(recs).collect()) == [0, 1, 2, 4]


def test_decode_hop_feeds_the_bar_job(spark):
    from tickbars.sources import fixtures as FX
    from tickbars.streaming import jobs as J

    sf = "/root/testdata/sf0.001"
    out, dlq = J.run_decode_hop(spark, FX.bad_wire_records(spark, sf), batches=2)
    letters = spark.read.parquet(dlq)
    good = spark.read.schema(J.DECODED_SCHEMA).parquet(f"{out}/batch=*")
    assert letters.count() + good.count() == FX.wire_records(spark, sf).count()
    assert {r.error for r in letters.select("error").distinct().collect()} == {
        "ParseError", "ConstraintViolation: source is null", "ConstraintViolation: symbol longer than 20"}
    q = J.start_bar_job(None, f"{out}-ohlcv", f"{out}-ck", trades=J.read_decoded(spark, out), dlq=f"{out}-broken")
    q.processAllAvailable()
    q.stop()
    assert spark.read.parquet(f"{out}-ohlcv").count() > 0


def test_broken_bars_are_dead_letters(spark):
    from tickbars import session as S
    from tickbars.operators.tables import BAR_TABLE_COLUMNS
    from tickbars.streaming.jobs import upsert_writer

    row = {c: 1.0 for c in BAR_TABLE_COLUMNS} | {"symbol": "A", "source": "X", "window_start_ms": 0, "trade_count": 1}
    bad = [row | {"symbol": "B" * 21}, row | {"symbol": "C", "vwap": None}]
    types = {"symbol": "string", "source": "string", "window_start_ms": "long", "trade_count": "long"}
    df = spark.createDataFrame([[r[c] for c in BAR_TABLE_COLUMNS] for r in [row, *bad]],
                               ", ".join(f"{c} {types.get(c, 'double')}" for c in BAR_TABLE_COLUMNS))
    base = S.fresh_path(spark, "bars")
    upsert_writer(f"{base}/t", f"{base}/dlq")(df, 3)
    assert [r.symbol for r in spark.read.parquet(f"{base}/t").collect()] == ["A"]
    assert sorted(r.error for r in spark.read.parquet(f"{base}/dlq/batch=3").collect()) == [
        "ConstraintViolation: symbol longer than 20", "ConstraintViolation: vwap is null"]


def test_subscribed_frames(spark):
    from tickbars.options import JobOptions
    from tickbars.streaming.apps import subscribed

    frames = [("BINANCE", '{"e":"trade","s":"BTCUSDT"}'), ("BINANCE", '{"e":"trade","s":"ETHUSDT"}'),
              ("BINANCE", '{"stream":"btcusdt@depth20@100ms","data":{}}'), ("COINBASE", '{"events":[{"product_id":"BTC-USD"}]}'),
              ("COINBASE", '{"events":[{"product_id":"ETH-USD"}]}'), ("KRAKEN", '{"data":[{"symbol":"BTC/USD"}]}'),
              ("KRAKEN", '{"channel":"heartbeat"}'), ("KRAKEN", "broken")]
    df = spark.createDataFrame([(i, s, r) for i, (s, r) in enumerate(frames)], "seq long, source string, raw string")
    assert sorted(r.seq for r in subscribed(df, JobOptions.from_env({})).collect()) == [0, 2, 3, 5, 6, 7]

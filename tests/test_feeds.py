"""Hand-made frames for each feed (valid, ignored, missing fields, quoted
numbers, broken JSON, several trades in one frame, a bad element)."""

from tickbars.operators import feeds as FD

FRAMES = [
    ("BINANCE", 1, 1000, '{"stream":"btcusdt@trade","data":{"e":"trade","E":900,"s":"BTCUSDT","t":7,'
                         '"p":"62345.67","q":"0.012","T":950,"m":true,"zz":1}}'),
    ("BINANCE", 2, 1000, '{"result":null,"id":1}'),
    ("BINANCE", 3, 1100, '{"stream":"btcusdt@depth20@100ms","data":{"bids":[["62000.00","0.5"],["61999.5","1"]],'
                         '"asks":[["62001.00","0.25"]]}}'),
    ("BINANCE", 4, 1200, 'not json'),
    ("BINANCE", 5, 1300, '{"stream":"btcusdt@trade","data":{"e":"trade","s":"BTCUSDT","t":8,"p":"abc","q":"1"}}'),
    ("COINBASE", 1, 2000, '{"channel":"market_trades","events":[{"trades":['
                          '{"product_id":"BTC-USD","price":"100.5","size":"2","trade_id":"11","time":"2024-01-01T00:00:01.5Z","side":"SELL"},'
                          '{"product_id":"BTC-USD","price":"bad","size":"1","trade_id":"12","time":"","side":"BUY"}]}]}'),
    ("COINBASE", 2, 2100, '{"channel":"heartbeats"}'),
    ("COINBASE", 3, 2200, '{"channel":"market_trades"}'),
    ("COINBASE", 4, 2300, '{"channel":"market_trades","events":[{"trades":[{"product_id":"ETH-USD","time":""}]}]}'),
    ("COINBASE", 5, 2400, '{"channel":"l2_data","events":[{"type":"snapshot","product_id":"BTC-USD","time":"",'
                          '"updates":[{"side":"bid","price_level":"10","new_quantity":"1"},'
                          '{"side":"offer","price_level":"11","new_quantity":"0"}]}]}'),
    ("KRAKEN", 1, 3000, '{"channel":"trade","data":[{"symbol":"XBT/USD","price":5.5,"qty":0.1,"trade_id":3,'
                        '"timestamp":"2024-01-01T00:00:02.000Z","side":"sell"},'
                        '{"symbol":"ETH/USD","price":6.5,"qty":0.2,"trade_id":4,"timestamp":"","side":"buy"}]}'),
    ("KRAKEN", 2, 3100, '{"channel":"book","type":"snapshot","data":[{"symbol":"XBT/USD","timestamp":"",'
                        '"bids":[{"price":9.0,"qty":0.0}],"asks":[]}]}'),
    ("KRAKEN", 3, 3200, '{"channel":"status","data":[]}'),
]
SCHEMA = "source string, seq long, recv_ms long, raw string"


def _frames(spark):
    return spark.createDataFrame(FRAMES, SCHEMA)


def test_demux(spark):
    kinds = {(r.source, r.seq): r.kind for r in FD.demux(_frames(spark)).collect()}
    assert kinds[("BINANCE", 1)] == "trade" and kinds[("BINANCE", 2)] == "ignored"
    assert kinds[("BINANCE", 3)] == "book" and kinds[("BINANCE", 4)] == "dead"
    assert kinds[("COINBASE", 2)] == "ignored" and kinds[("KRAKEN", 3)] == "ignored"
    lenient = {(r.source, r.seq): r.kind for r in FD.demux(_frames(spark), strict=False).collect()}
    assert lenient[("BINANCE", 2)] == "trade"


def test_trades_all_feeds(spark):
    t = {(r.source, r.seq, r.pos): r for r in FD.union_feeds(_frames(spark)).collect()}
    b = t[("BINANCE", 1, 0)]
    assert (b.symbol, b.trade_id, b.price, b.quantity, b.trade_time_ms, b.is_buyer_maker) == \
        ("BTCUSDT", 7, 62345.67, 0.012, 950, True)
    assert b.ingestion_time_ms == 1000 and b.latency_ms == 50 and b.event_time_ms == 900
    c = t[("COINBASE", 1, 0)]
    assert (c.symbol, c.trade_id, c.price, c.quantity, c.is_buyer_maker) == ("BTCUSD", 11, 100.5, 2.0, True)
    assert c.trade_time_ms == 1704067201500 and c.event_time_ms == 2000
    assert ("COINBASE", 1, 1) not in t  # bad price: element dropped, frame dead-lettered
    m = t[("COINBASE", 4, 0)]  # missing price/size -> 0, empty time -> receive time
    assert (m.symbol, m.price, m.quantity, m.trade_time_ms, m.trade_id) == ("ETHUSD", 0.0, 0.0, 2300, 0)
    k1, k2 = t[("KRAKEN", 1, 0)], t[("KRAKEN", 1, 1)]
    assert (k1.symbol, k1.is_buyer_maker, k1.trade_time_ms) == ("BTCUSD", True, 1704067202000)
    assert (k2.symbol, k2.is_buyer_maker, k2.trade_time_ms) == ("ETHUSD", False, 3000)
    assert ("BINANCE", 5, 0) not in t
    assert len(t) == 5


def test_dead_letters_once_per_frame(spark):
    dl = sorted((r.source, r.seq, r.error) for r in FD.dead_letters(_frames(spark)).collect())
    assert dl == [("BINANCE", 4, "ParseError"), ("BINANCE", 5, "ParseError"), ("COINBASE", 1, "ParseError")]


def test_books(spark):
    b1 = FD.feed1_books(_frames(spark)).collect()
    assert len(b1) == 1 and b1[0].symbol == "BTCUSDT" and b1[0].timestamp_ms == 1100
    assert [(x.price, x.quantity) for x in b1[0].bids] == [(62000.0, 0.5), (61999.5, 1.0)]
    rows = {(r.source, r.seq, r.side, r.price): r for r in FD.book_rows(_frames(spark)).collect()}
    assert rows[("COINBASE", 5, "ask", 11.0)].quantity == 0.0  # 'offer' -> ask
    assert rows[("COINBASE", 5, "bid", 10.0)].kind == "snapshot"
    k = rows[("KRAKEN", 2, "bid", 9.0)]
    assert k.keep_zero and k.symbol == "BTCUSD" and k.timestamp_ms == 3100


def test_counts(spark):
    c = {r.source: r for r in FD.feed_counts(_frames(spark)).collect()}
    assert (c["BINANCE"].frames, c["BINANCE"].dead_frames, c["BINANCE"].ignored_frames) == (5, 1, 1)
    assert c["COINBASE"].ignored_frames == 1 and c["KRAKEN"].book_frames == 1


def test_feed2_positions_across_events(spark):
    t = '{"product_id":"BTC-USD","price":"%s","size":"1","trade_id":"%d","time":"","side":"BUY"}'
    raw = ('{"channel":"market_trades","events":[{"trades":[%s,%s]},{"trades":[%s,%s]}]}'
           % (t % ("1", 1), t % ("2", 2), t % ("3", 3), t % ("4", 4)))
    fr = spark.createDataFrame([("COINBASE", 9, 100, raw)], SCHEMA)
    got = sorted((r.pos, r.trade_id, r.price) for r in FD.union_feeds(fr).collect())
    assert got == [(0, 1, 1.0), (1, 2, 2.0), (2, 3, 3.0), (3, 4, 4.0)]

import random

from tickbars.operators import book as B

COLS = "source string, symbol string, seq long, sub long, lpos long, kind string, side string, " \
       "price double, quantity double, keep_zero boolean"


def _simulate(rows):
    """Reference: apply messages one by one to per-key dicts."""
    books, out = {}, set()
    msgs = {}
    for r in rows:
        msgs.setdefault((r[0], r[1], r[2], r[3]), []).append(r)
    for (src, sym, seq, sub) in sorted(msgs, key=lambda m: (m[2], m[3])):
        book = books.setdefault((src, sym), {"bid": {}, "ask": {}})
        ms = sorted(msgs[(src, sym, seq, sub)], key=lambda r: r[4])
        if ms[0][5] == "snapshot":
            book["bid"].clear()
            book["ask"].clear()
        for r in ms:
            side = r[6]
            if side is None:
                continue
            side = "bid" if side == "bid" else "ask"
            if r[8] == 0 and not r[9]:
                book[side].pop(r[7], None)
            else:
                book[side][r[7]] = r[8]
        for side in ("bid", "ask"):
            for p, q in book[side].items():
                out.add((src, sym, seq, sub, side, p, q))
    return out


def _random_rows(seed, n=600):
    rnd = random.Random(seed)
    rows = []
    for seq in range(n):
        src, sym = rnd.choice([("X", "BTC"), ("X", "ETH"), ("Y", "BTC")])
        kind = "snapshot" if rnd.random() < 0.03 else "update"
        for lp in range(rnd.choice([0, 1, 1, 2, 3]) if kind == "snapshot" else 1):
            rows.append((src, sym, seq, 0, lp, kind, rnd.choice(["bid", "offer"]), float(rnd.randrange(10)),
                         float(rnd.randrange(3)), kind == "snapshot" and src == "Y"))
        if kind == "snapshot" and not any(r[2] == seq for r in rows):
            rows.append((src, sym, seq, 0, 0, kind, None, None, None, False))
    return rows


def test_levels_match_simulation_small_chunks(spark):
    rows = _random_rows(1)
    df = spark.createDataFrame(rows, COLS)
    exp = _simulate(rows)
    for chunk, bucket in ((1 << 16, 1024), (13, 5)):
        got = {tuple(r) for r in B.book_levels_asof(df, chunk=chunk, bucket=bucket).collect()}
        assert got == exp


def test_top_levels_order(spark):
    rows = [("X", "BTC", 1, 0, i, "snapshot", "bid" if i % 2 else "ask", float(i), 1.0, False) for i in range(30)]
    df = spark.createDataFrame(rows, COLS)
    top = B.top_levels(B.book_levels_asof(df), depth=3).collect()
    bids = sorted((r.level, r.price) for r in top if r.side == "bid")
    asks = sorted((r.level, r.price) for r in top if r.side == "ask")
    assert bids == [(1, 29.0), (2, 27.0), (3, 25.0)] and asks == [(1, 0.0), (2, 2.0), (3, 4.0)]
    snap = B.snapshots(B.top_levels(B.book_levels_asof(df), depth=3)).collect()[0]
    assert [x.price for x in snap.bids] == [29.0, 27.0, 25.0]


def test_books_from_parsed_frames_multi_level(spark):
    """Feed-2/3 messages with several levels: a snapshot counts once and its
    levels apply in order (lpos), zero quantities keep/delete per feed."""
    from tickbars.operators import feeds as FD

    frames = [
        ("COINBASE", 1, 10, '{"channel":"l2_data","events":[{"type":"snapshot","product_id":"BTC-USD","time":"",'
                            '"updates":[{"side":"bid","price_level":"10","new_quantity":"1"},'
                            '{"side":"bid","price_level":"9","new_quantity":"2"},'
                            '{"side":"offer","price_level":"11","new_quantity":"3"}]}]}'),
        ("COINBASE", 2, 20, '{"channel":"l2_data","events":[{"type":"update","product_id":"BTC-USD","time":"",'
                            '"updates":[{"side":"bid","price_level":"10","new_quantity":"0"},'
                            '{"side":"bid","price_level":"8","new_quantity":"5"}]},'
                            '{"type":"snapshot","product_id":"BTC-USD","time":"",'
                            '"updates":[{"side":"offer","price_level":"12","new_quantity":"1"}]}]}'),
        ("KRAKEN", 3, 30, '{"channel":"book","type":"snapshot","data":[{"symbol":"XBT/USD","timestamp":"",'
                          '"bids":[{"price":5.0,"qty":0.0},{"price":4.0,"qty":1.0}],"asks":[{"price":6.0,"qty":2.0}]}]}'),
    ]
    fr = spark.createDataFrame(frames, "source string, seq long, recv_ms long, raw string")
    deltas = FD.book_rows(fr)
    rows = [tuple(r) for r in deltas.filter("not header").select("source", "symbol", "seq", "sub", "lpos", "kind", "side",
                                           "price", "quantity", "keep_zero").collect()]
    got = {tuple(r) for r in B.book_levels_asof(deltas).collect()}
    assert got == _simulate(rows)
    assert ("COINBASE", "BTCUSD", 1, 0, "bid", 9.0, 2.0) in got
    assert ("COINBASE", "BTCUSD", 2, 0, "bid", 8.0, 5.0) in got
    assert not any(r[2] == 2 and r[3] == 1 and r[4] == "bid" for r in got)  # second event is a snapshot
    assert ("KRAKEN", "BTCUSD", 3, 0, "bid", 5.0, 0.0) in got  # feed-3 snapshot keeps zero


def test_bad_first_level_and_emptied_book(spark):
    """A snapshot whose first level is bad still clears the book, and a message
    that leaves the book empty is published as an empty book."""
    from tickbars.operators import feeds as FD

    def frame(seq, kind, *levels):
        ups = ",".join('{"side":"bid","price_level":"%s","new_quantity":"%s"}' % x for x in levels)
        return ("COINBASE", seq, 10 * seq, '{"channel":"l2_data","events":[{"type":"%s","product_id":"BTC-USD",'
                                           '"time":"","updates":[%s]}]}' % (kind, ups))

    frames = [frame(1, "snapshot", ("5", "1")), frame(2, "snapshot", ("oops", "1"), ("7", "2")),
              frame(3, "update", ("7", "0")), frame(4, "update", ("8", "1"))]
    deltas = FD.book_rows(spark.createDataFrame(frames, "source string, seq long, recv_ms long, raw string"))
    got = {r.seq: (r.timestamp_ms, [x.price for x in r.bids], r.asks) for r in B.book_snapshots(deltas).collect()}
    assert got == {1: (10, [5.0], []), 2: (20, [7.0], []), 3: (30, [], []), 4: (40, [8.0], [])}


def _published(rows, depth):
    """Best ``depth`` levels after every message, as (key, seq) -> (bids, asks)."""
    books, out, msgs = {}, {}, {}
    for r in rows:
        msgs.setdefault(r[2], []).append(r)
    for seq in sorted(msgs):
        first = msgs[seq][0]
        book = books.setdefault(first[:2], {"bid": {}, "ask": {}})
        if first[5] == "snapshot":
            book["bid"].clear()
            book["ask"].clear()
        for r in sorted(msgs[seq], key=lambda r: r[4]):
            if r[6] is None or r[7] is None:
                continue
            side = "bid" if r[6] == "bid" else "ask"
            if r[8] is None or (r[8] == 0 and not r[9]):
                book[side].pop(r[7], None)
            else:
                book[side][r[7]] = r[8]
        out[(*first[:2], seq)] = (sorted(book["bid"].items(), reverse=True)[:depth], sorted(book["ask"].items())[:depth])
    return out


def test_replayed_books_match_simulation(spark):
    """Chunks of a few messages: levels carried over many chunks, snapshots
    between and inside chunks, emptied books, null prices, quantities and keys."""
    rows = _random_rows(7, 400)
    rows += [(None, "BTC", 1000 + i, 0, 0, "update", "bid", float(i % 4), float(i % 3), False) for i in range(30)]
    rows += [("X", "BTC", 2000, 0, 0, "update", "bid", None, 1.0, False),
             ("X", "BTC", 2001, 0, 0, "update", "bid", 3.0, None, False),
             ("X", "BTC", 2002, 0, 0, "snapshot", None, None, None, False)]
    exp = _published(rows, 3)
    df = spark.createDataFrame(rows, COLS)
    for chunk, bucket in ((1 << 16, 1024), (13, 4), (50, 1)):
        got = {(r.source, r.symbol, r.seq): ([tuple(x) for x in r.bids], [tuple(x) for x in r.asks])
               for r in B.replayed_books(df, 3, chunk=chunk, bucket=bucket).collect()}
        assert got == exp
    assert B.replayed_books(df.limit(0), 3).count() == 0


def test_level_rows_are_shuffled_with_their_chunk(spark):
    """With broadcasts off, exchanges by the key alone (or key and epoch) stand
    over the per-chunk aggregate, not over level rows."""
    import re

    df = spark.createDataFrame(_random_rows(3, 200), COLS)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        books = B.replayed_books(df, 3, bucket=16)
        lines = books._jdf.queryExecution().executedPlan().toString().splitlines()
        depth = [re.search(r"[A-Za-z(]", x).start() if re.search(r"[A-Za-z(]", x) else 0 for x in lines]
        for i, x in enumerate(lines):
            keys = re.search(r"Exchange hashpartitioning\(([^\[]*), \d+\)", x)
            if not keys or "_chunk" in keys.group(1):
                continue
            below = []
            for j in range(i + 1, len(lines)):
                if depth[j] <= depth[i]:
                    break
                below.append(lines[j])
            first_agg = next(y for y in below if "Aggregate" in y or "FileScan" in y)
            assert "Aggregate" in first_agg, x
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)

"""Exchange-frame parsing (O-10..O-19, O-21, O-26, O-30, O-42..O-44, O-91).

Input: captured frames ``(source, seq, recv_ms, raw)``, one row per WebSocket
message, from files or a topic.  ``parse_frames`` reads each frame once:
``try_parse_json`` gives a VARIANT, and one projection turns it into

* ``kind``    trade | book | ignored | dead (the feed's channel dispatch),
* ``trades``  array of normalised trades found in the frame,
* ``levels``  array of order-book level changes (feeds 2 and 3),
* ``book``    the stateless partial-depth snapshot (feed 1),
* ``bad``     some element is present but unparsable.

Every output (per-feed trades, their union, dead letters, book rows,
counters) is then an ``explode`` or a filter of that one projection: a
single scan, no shuffle, no per-feed re-read.  Paths are read the lenient
way the feed handlers read them (missing -> default).

Choices where the reference is lenient (README "Quirks"):
* a frame that is not JSON, or has a field present but unparsable, goes to
  the dead letters once, with error ``ParseError``; valid trades of the
  same frame still pass;
* ``strict=True`` ignores feed-1 frames without ``e = 'trade'``
  (acknowledgements), which the reference turns into zero-valued trades;
* missing price / size default to 0, as in the reference.
Event/ingestion time is the capture time ``recv_ms``, not the wall clock,
so a replay gives the same rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickbars.constants import (BID, FEED1_DEPTH_MARKER, FEED1_TRADE_EVENT, FEED2_BOOK_CHANNEL,
                                FEED2_SELL, FEED2_TRADE_CHANNEL, FEED3_BOOK_CHANNEL, FEED3_SELL,
                                FEED3_TRADE_CHANNEL, PARSE_ERROR, SNAPSHOT, SOURCE_FEED1,
                                SOURCE_FEED2, SOURCE_FEED3)
from tickbars.functions.symbols import coinbase_symbol, kraken_symbol, stream_symbol
from tickbars.functions.timefns import iso_to_ms

TRADE_COLUMNS = ["source", "seq", "pos", "event_type", "event_time_ms", "symbol", "trade_id",
                 "price", "quantity", "trade_time_ms", "is_buyer_maker", "ingestion_time_ms",
                 "latency_ms"]
DELTA_COLUMNS = ["source", "symbol", "seq", "sub", "lpos", "kind", "side", "price", "quantity",
                 "keep_zero", "timestamp_ms"]
VARR = "array<variant>"


def _get(v: Column, path: str, dtype: str) -> Column:
    return F.try_variant_get(v, path, dtype)


def _field(v: Column, path: str, dtype: str, default=None) -> tuple[Column, Column]:
    """(typed value, 'present but not convertible').  Missing or JSON null
    gives ``default``."""
    raw = _get(v, path, "variant")
    val = _get(v, path, dtype)
    # the value first: the element is looked at again only where it gave none
    bad = val.isNull() & raw.isNotNull() & ~F.is_variant_null(raw)
    if default is not None:
        val = F.coalesce(val, F.lit(default).cast(dtype))
    return val, F.coalesce(bad, F.lit(False))


def _text(v: Column, path: str) -> Column:
    return F.coalesce(_get(v, path, "string"), F.lit(""))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def _with_time(text: Column, fallback: Column, body) -> Column:
    """``body`` of (epoch ms of an instant text, 'present but no instant'); parsed once."""
    parsed = lambda t: F.when(t == "", fallback).otherwise(iso_to_ms(t))
    return _let(text, lambda t: _let(F.struct(parsed(t).alias("ms"), (t == "").alias("none")), lambda x: body(
        x["ms"], ~x["none"] & x["ms"].isNull())))


def _trade(pos, event_time, symbol, trade_id, price, qty, trade_time, maker, bad) -> Column:
    return F.struct(pos.cast("bigint").alias("pos"), event_time.cast("bigint").alias("event_time_ms"),
                    symbol.alias("symbol"), trade_id.alias("trade_id"), price.alias("price"),
                    qty.alias("quantity"), trade_time.cast("bigint").alias("trade_time_ms"),
                    maker.alias("is_buyer_maker"), bad.alias("bad"))


def _feed1_trades(d: Column) -> Column:
    e_time, b1 = _field(d, "$.E", "bigint", 0)
    tid, b2 = _field(d, "$.t", "bigint", 0)
    price, b3 = _field(d, "$.p", "double", 0.0)
    qty, b4 = _field(d, "$.q", "double", 0.0)
    t_time, b5 = _field(d, "$.T", "bigint", 0)
    maker, b6 = _field(d, "$.m", "boolean", False)
    return F.array(_trade(F.lit(0), e_time, _get(d, "$.s", "string"), tid, price, qty, t_time, maker,
                          b1 | b2 | b3 | b4 | b5 | b6))


def _feed2_trades(v: Column, recv: Column) -> Column:
    def one(t: Column) -> Column:
        price, b1 = _field(t, "$.price", "double", 0.0)
        size, b2 = _field(t, "$.size", "double", 0.0)
        tid = F.coalesce(_get(t, "$.trade_id", "bigint"), F.lit(0).cast("bigint"))
        return _with_time(_text(t, "$.time"), recv, lambda t_time, b3: _trade(
            F.lit(0), recv, coinbase_symbol(_text(t, "$.product_id")), tid, price, size, t_time,
            _text(t, "$.side") == FEED2_SELL, b1 | b2 | b3))

    events = F.coalesce(_get(v, "$.events", VARR), F.array().cast(VARR))
    flat = F.flatten(F.transform(events, lambda e: F.transform(
        F.coalesce(_get(e, "$.trades", VARR), F.array().cast(VARR)), one)))
    # pos: the trade's place in the frame (events in order, trades in order)
    return F.transform(flat, lambda x, k: x.withField("pos", k.cast("bigint")))


def _feed3_trades(v: Column, recv: Column) -> Column:
    def one(t: Column, i: Column) -> Column:
        return _with_time(_text(t, "$.timestamp"), recv, lambda t_time, bad: _trade(
            i, t_time, kraken_symbol(_text(t, "$.symbol")),
            F.coalesce(_get(t, "$.trade_id", "bigint"), F.lit(0).cast("bigint")),
            F.coalesce(_get(t, "$.price", "double"), F.lit(0.0)),
            F.coalesce(_get(t, "$.qty", "double"), F.lit(0.0)),
            t_time, _text(t, "$.side") == FEED3_SELL, bad))

    data = F.coalesce(_get(v, "$.data", VARR), F.array().cast(VARR))
    return F.transform(data, one)


def _level(sub, kind, symbol, side, price, qty, keep_zero, ts, bad, lpos=None) -> Column:
    lpos = F.lit(0) if lpos is None else lpos
    return F.struct((lpos < 0).alias("header"), sub.cast("bigint").alias("sub"), lpos.cast("bigint").alias("lpos"),
                    kind.alias("kind"), symbol.alias("symbol"),
                    side.alias("side"), price.alias("price"), qty.alias("quantity"),
                    keep_zero.alias("keep_zero"), ts.cast("bigint").alias("timestamp_ms"),
                    bad.alias("bad"))


def _header(sub, kind, symbol, keep_zero, ts) -> Column:
    """The message itself, apart from its levels: it clears and counts even if
    it has no level or only bad ones."""
    return _level(sub, kind, symbol, F.lit(None).cast("string"), F.lit(None).cast("double"),
                  F.lit(None).cast("double"), keep_zero, ts, F.lit(False), F.lit(-1))


def _feed2_levels(v: Column, recv: Column) -> Column:
    """events[] of l2_data: one message per event; 'bid' -> bid, any other side -> ask."""
    def event(e: Column, i: Column) -> Column:
        kind = F.when(_text(e, "$.type") == SNAPSHOT, SNAPSHOT).otherwise("update")
        sym = coinbase_symbol(_text(e, "$.product_id"))
        ups = F.coalesce(_get(e, "$.updates", VARR), F.array().cast(VARR))

        def upd(ts: Column, u: Column, j: Column) -> Column:
            price, b1 = _field(u, "$.price_level", "double", 0.0)
            qty, b2 = _field(u, "$.new_quantity", "double", 0.0)
            side = F.when(_text(u, "$.side") == BID, "bid").otherwise("ask")
            return _level(i, kind, sym, side, price, qty, F.lit(False), ts, b1 | b2, j)

        return _with_time(_text(e, "$.time"), recv, lambda ts, bad_t: F.concat(
            F.array(_header(i, kind, sym, F.lit(False), ts)), F.transform(ups, lambda u, j: upd(ts, u, j))))

    events = F.coalesce(_get(v, "$.events", VARR), F.array().cast(VARR))
    return F.flatten(F.transform(events, event))


def _feed3_levels(v: Column, recv: Column) -> Column:
    """Frame-level type; data[].bids/asks of {price, qty}; snapshots keep zeros."""
    kind = F.when(_text(v, "$.type") == SNAPSHOT, SNAPSHOT).otherwise("update")
    keep = kind == SNAPSHOT

    def item(d: Column, i: Column) -> Column:
        sym = kraken_symbol(_text(d, "$.symbol"))

        def side(ts: Column, name: str, label: str) -> Column:
            arr = F.coalesce(_get(d, f"$.{name}", VARR), F.array().cast(VARR))
            return F.transform(arr, lambda x: _level(
                i, kind, sym, F.lit(label), F.coalesce(_get(x, "$.price", "double"), F.lit(0.0)),
                F.coalesce(_get(x, "$.qty", "double"), F.lit(0.0)), keep, ts, F.lit(False)))

        def message(ts: Column) -> Column:
            both = F.transform(F.concat(side(ts, "bids", "bid"), side(ts, "asks", "ask")),
                               lambda x, j: x.withField("lpos", j.cast("bigint")))
            return F.concat(F.array(_header(i, kind, sym, keep, ts)), both)

        return _with_time(_text(d, "$.timestamp"), recv, lambda ts, bad_t: message(ts))

    data = F.coalesce(_get(v, "$.data", VARR), F.array().cast(VARR))
    return F.flatten(F.transform(data, item))


def _feed1_book(d: Column) -> Column:
    """Partial depth: ["price","qty"] pairs as sent; non-array side -> empty."""
    def levels(name: str) -> Column:
        arr = F.coalesce(_get(d, f"$.{name}", VARR), F.array().cast(VARR))
        return F.transform(arr, lambda x: F.struct(
            F.try_variant_get(x, "$[0]", "double").alias("price"),
            F.try_variant_get(x, "$[1]", "double").alias("quantity")))
    return F.struct(levels("bids").alias("bids"), levels("asks").alias("asks"))


def frame_order() -> Column:
    """Arrival order of trades from frames, (seq, pos), as one number: a bar's
    first and last trade then stay a hash aggregate (a struct would sort)."""
    return (F.col("seq").cast("decimal(20,0)") * F.lit(10_000_000_000).cast("decimal(11,0)")
            + F.col("pos").cast("decimal(20,0)"))


ALL_OUTPUTS = ("trades", "levels", "book")


def _barrier(df: DataFrame, **counters: Column) -> DataFrame:
    """A CollectMetrics node: later filters are not pushed below it, so what
    stands under it is evaluated once per frame."""
    return df.observe(f"feed_{uuid.uuid4().hex[:8]}", F.count(F.lit(1)).alias("rows"),
                      *[c.alias(k) for k, c in counters.items()])


def parse_frames(frames: DataFrame, strict: bool = True, want: tuple[str, ...] = ALL_OUTPUTS) -> DataFrame:
    """One projection per frame; see the module doc.  Staged selects keep
    each generated expression small (shared sub-results are columns).

    ``want``: which outputs to build.  A reader of one output gets only the
    frames of its kind, and nothing else is looked up in them; with none, only
    the kind of every frame is told."""
    p = _barrier(frames.select("source", "seq", "recv_ms", "raw", F.try_parse_json("raw").alias("_v")))
    v = F.col("_v")
    p = p.select("*",
                 _text(v, "$.stream").alias("_stream"), _text(v, "$.channel").alias("_channel"),
                 F.coalesce(_get(v, "$.data", "variant"), v).alias("_d"))
    src, d, recv = F.col("source"), F.col("_d"), F.col("recv_ms")
    b_trade = F.coalesce(_get(d, "$.e", "string") == FEED1_TRADE_EVENT, F.lit(False)) if strict else F.lit(True)
    ch = F.col("_channel")
    kind = (F.when(v.isNull(), "dead")
            .when(src == SOURCE_FEED1, F.when(F.col("_stream").contains(FEED1_DEPTH_MARKER), "book")
                  .when(b_trade, "trade").otherwise("ignored"))
            .when(src == SOURCE_FEED2, F.when(ch == FEED2_TRADE_CHANNEL, "trade")
                  .when(ch == FEED2_BOOK_CHANNEL, "book").otherwise("ignored"))
            .when(src == SOURCE_FEED3, F.when(ch == FEED3_TRADE_CHANNEL, "trade")
                  .when(ch == FEED3_BOOK_CHANNEL, "book").otherwise("ignored"))
            .otherwise("ignored"))
    p = p.withColumn("kind", kind)
    if not want:
        return p.select("source", "seq", "recv_ms", "raw", "kind")
    if set(want) < set(ALL_OUTPUTS):
        p = p.filter(F.col("kind").isin(*{"trade" if w == "trades" else "book" for w in want}))
    trades = (F.when(F.col("kind") != "trade", F.lit(None))
              .when(src == SOURCE_FEED1, _feed1_trades(d))
              .when(src == SOURCE_FEED2, _feed2_trades(v, recv))
              .otherwise(_feed3_trades(v, recv)))
    levels = (F.when(F.col("kind") != "book", F.lit(None))
              .when(src == SOURCE_FEED2, _feed2_levels(v, recv))
              .when(src == SOURCE_FEED3, _feed3_levels(v, recv)))
    book = F.when((F.col("kind") == "book") & (src == SOURCE_FEED1), _feed1_book(d))
    outputs = {"trades": trades, "levels": levels, "book": book}
    p = p.select("source", "seq", "recv_ms", "raw", "kind", "_stream", *[outputs[w].alias(w) for w in want])
    book_bad = F.exists(F.concat(F.col("book.bids"), F.col("book.asks")),
                        lambda x: x["price"].isNull() | x["quantity"].isNull()) if "book" in want else None
    checks = {"trades": lambda: F.exists("trades", lambda t: t["bad"]),
              "levels": lambda: F.exists("levels", lambda x: x["bad"] | x["timestamp_ms"].isNull()),
              "book": lambda: book_bad}
    bad = F.lit(False)
    for w in want:
        bad = bad | F.coalesce(checks[w](), F.lit(False))
    return _barrier(p.withColumn("bad", bad))


def demux(frames: DataFrame, strict: bool = True) -> DataFrame:
    """Frame -> kind (O-10, O-11, O-12)."""
    return parse_frames(frames, strict, want=()).select("source", "seq", "kind")


def trades_of(parsed: DataFrame) -> DataFrame:
    """Explode parsed frames into normalised trades (valid elements only)."""
    # explode_outer: a plain explode makes the optimizer add size(trades) > 0
    # below the projection, which would evaluate the whole parse twice
    t = parsed.select("source", "seq", "recv_ms", F.explode_outer("trades").alias("t"))
    t = t.filter(F.col("t").isNotNull() & ~F.col("t.bad"))
    return t.select(
        "source", "seq", F.col("t.pos").alias("pos"), F.lit("trade").alias("event_type"),
        F.col("t.event_time_ms").alias("event_time_ms"), F.col("t.symbol").alias("symbol"),
        F.col("t.trade_id").alias("trade_id"), F.col("t.price").alias("price"),
        F.col("t.quantity").alias("quantity"), F.col("t.trade_time_ms").alias("trade_time_ms"),
        F.col("t.is_buyer_maker").alias("is_buyer_maker"),
        F.col("recv_ms").alias("ingestion_time_ms"),
        (F.col("recv_ms") - F.col("t.trade_time_ms")).alias("latency_ms"))


def normalize(frames: DataFrame, source: str, strict: bool = True) -> DataFrame:
    """Valid normalised trades of one feed (O-14, O-15, O-16)."""
    return trades_of(parse_frames(frames.filter(F.col("source") == source), strict, want=("trades",)))


def union_feeds(frames: DataFrame, strict: bool = True) -> DataFrame:
    """All feeds as one trade stream (O-30) -- one scan, arrival = (seq, pos)."""
    return trades_of(parse_frames(frames, strict, want=("trades",)))


def dead_letters_of(parsed: DataFrame) -> DataFrame:
    bad = parsed.filter((F.col("kind") == "dead") | F.col("bad"))
    return bad.select(F.col("raw").alias("rawPayload"), F.lit(PARSE_ERROR).alias("error"),
                      F.col("recv_ms").alias("ingestionTimeMs"), "source", "seq")


def dead_letters(frames: DataFrame, strict: bool = True) -> DataFrame:
    """Raw frames that failed to parse, once per frame (O-26, O-59c)."""
    return dead_letters_of(parse_frames(frames, strict))


def _counters() -> dict[str, Column]:
    good = F.size(F.filter("trades", lambda t: ~t["bad"]))
    kind = F.col("kind")
    return {"frames": F.count(F.lit(1)), "not_json": F.count_if(kind == "dead"), "ignored": F.count_if(kind == "ignored"),
            "produced": F.sum(F.when(F.col("trades").isNotNull(), good).otherwise(0).cast("long")),
            "dead_letters": F.count_if((kind == "dead") | F.col("bad"))}


def counters_of(parsed: DataFrame) -> DataFrame:
    """One row of counters of parsed frames; ``produced`` and ``dead_letters``
    are the row counts of the trade and the dead-letter output."""
    return parsed.agg(*[c.alias(name) for name, c in _counters().items()])


def feed_counts(frames: DataFrame, strict: bool = True) -> DataFrame:
    """Per-source counters (O-91): frames by kind, trades produced and dead
    letters written, one partial aggregate."""
    n = _counters()
    return parse_frames(frames, strict).groupBy("source").agg(
        n["frames"].alias("frames"),
        F.count_if(F.col("kind") == "trade").alias("trade_frames"),
        F.count_if(F.col("kind") == "book").alias("book_frames"),
        n["ignored"].alias("ignored_frames"),
        n["not_json"].alias("dead_frames"),
        n["produced"].alias("produced_trades"),
        n["dead_letters"].alias("dead_letters"),
    )


def feed_liveness(frames: DataFrame, silence_ms: int = 30_000, delay: str = "1 second") -> DataFrame:
    """When each feed was connected (O-91): rows (source, at_ms, connected), true
    at the first frame after a silence, false ``silence_ms`` after the last frame
    before one; a silence is longer than ``silence_ms``.  A session-window aggregate
    by receive time, batch or stream; frames may come ``delay`` (at least 1 ms) out of order.  A stream tells a connection once its end has passed the watermark, so an open
    one is not in its output.  Frames without a source or time count for none."""
    at = F.timestamp_millis("recv_ms")
    live = frames.filter(F.col("source").isNotNull() & F.col("recv_ms").isNotNull()).select("source", at.alias("at"))
    if frames.isStreaming:
        live = live.withWatermark("at", delay)
    spans = live.groupBy("source", F.session_window("at", f"{silence_ms} milliseconds").alias("w")).agg(
        F.count(F.lit(1)).alias("frames"))
    flag = lambda c, on: F.struct(F.unix_millis(c).alias("at_ms"), F.lit(on).alias("connected"))
    return spans.select("source", F.inline(F.array(flag(F.col("w.start"), True), flag(F.col("w.end"), False))))


def levels_of(parsed: DataFrame) -> DataFrame:
    """Level changes, and one header row (lpos -1, no side) per message.  Bad
    levels are left out; a bad time leaves the time null, not the levels out."""
    rows = parsed.select("source", "seq", F.explode_outer("levels").alias("l"))
    rows = rows.filter(F.col("l").isNotNull() & ~F.col("l.bad"))
    return rows.select("source", F.col("l.symbol").alias("symbol"), "seq", F.col("l.sub").alias("sub"),
                       F.col("l.lpos").alias("lpos"), F.col("l.header").alias("header"), F.col("l.kind").alias("kind"), F.col("l.side").alias("side"),
                       F.col("l.price").alias("price"), F.col("l.quantity").alias("quantity"),
                       F.col("l.keep_zero").alias("keep_zero"), F.col("l.timestamp_ms").alias("timestamp_ms"))


def book_rows(frames: DataFrame, strict: bool = True) -> DataFrame:
    """Book frames of feeds 2 and 3 -> level-change rows (O-43, O-44).

    One message per (seq, sub), with a header row (null side) of its own, so
    that a message counts, and a snapshot clears, whatever its levels hold.
    ``keep_zero``: store a zero quantity instead of deleting (feed-3
    snapshots)."""
    return levels_of(parse_frames(frames, strict, want=("levels",)))


def feed1_snapshots(parsed: DataFrame) -> DataFrame:
    """Parsed feed-1 book frames -> stateless snapshots (O-42); symbol from
    the stream name, time = receive time."""
    p = parsed.filter((F.col("source") == SOURCE_FEED1) & (F.col("kind") == "book") & ~F.col("bad"))
    return p.select("source", "seq", stream_symbol("_stream").alias("symbol"),
                    F.col("recv_ms").alias("timestamp_ms"),
                    F.col("book.bids").alias("bids"), F.col("book.asks").alias("asks"))


def feed1_books(frames: DataFrame, strict: bool = True) -> DataFrame:
    """Feed-1 partial-depth frames -> stateless snapshots (O-42)."""
    return feed1_snapshots(parse_frames(frames.filter(F.col("source") == SOURCE_FEED1), strict, want=("book",)))


def flatten_book(books: DataFrame, keys: list[str]) -> DataFrame:
    """Snapshot arrays -> one row per (side, level) for checks and tables;
    one generator over both sides (no union, one pass)."""
    rows = books.select(*keys, F.size("bids").alias("_n"), F.posexplode_outer(F.concat("bids", "asks")).alias("_at", "l"))
    is_bid = F.col("_at") < F.col("_n")
    return rows.filter(F.col("_at").isNotNull()).select(
        *keys, F.when(is_bid, "bid").otherwise("ask").alias("side"),
        F.when(is_bid, F.col("_at") + 1).otherwise(F.col("_at") - F.col("_n") + 1).alias("level"), "l.price", "l.quantity")

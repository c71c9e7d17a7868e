"""DuckDB oracle SQL for every checked key of ``__spark_entry__.queries()``.

Written independently of the Spark code: the same fixture adapters over the
pre-registered ``events`` view, then plain SQL per operator.  Computed
doubles are rounded to 6 places on both sides (sum order differs).
"""

from __future__ import annotations

# Fixture adapter (FIXTURES.md F1) and the bar job as SQL.
TRADES = """
trades as (
  select event_id as trade_id,
         case when user_id % 2 = 0 then 'BTCUSD' else 'ETHUSD' end as symbol,
         case event_id % 3 when 0 then 'BINANCE' when 1 then 'COINBASE' else 'KRAKEN' end as source,
         case event_id % 3
           when 0 then case when user_id % 2 = 0 then 'BTCUSDT' else 'ETHUSDT' end
           when 1 then case when user_id % 2 = 0 then 'BTC-USD' else 'ETH-USD' end
           else case when user_id % 2 = 0 then 'XBT/USD' else 'ETH/USD' end end as raw_symbol,
         1704067200000 + (epoch_us(ts) // 1000 - 1704067200000) // 60 as trade_time_ms,
         value as price,
         (cast(json_extract_string(props, '$.k') as double) + 1) / 100 as quantity,
         event_type in ('view', 'signup') as is_buyer_maker,
         1704067200000 + (epoch_us(ts) // 1000 - 1704067200000) // 60 + user_id % 97 as ingestion_time_ms,
         user_id % 97 as latency_ms,
         event_id as arrival
  from events)"""

BARS = """
bars as (
  select symbol, source,
         trade_time_ms // 60000 * 60000 as window_start_ms,
         trade_time_ms // 60000 * 60000 + 60000 as window_end_ms,
         arg_min(price, arrival) as open, max(price) as high, min(price) as low,
         arg_max(price, arrival) as close,
         sum(quantity) as volume,
         case when sum(quantity) > 0 then sum(price * quantity) / sum(quantity)
              else arg_max(price, arrival) end as vwap,
         sum(case when is_buyer_maker then 0.0 else quantity end) as buy_volume,
         sum(case when is_buyer_maker then quantity else 0.0 end) as sell_volume,
         cast(count(*) as integer) as trade_count
  from trades
  group by symbol, source, trade_time_ms // 60000 * 60000)"""

EMA = """
ema as (
  select *,
         list_reduce(list(close) over (partition by symbol, source order by window_start_ms
                                       rows between unbounded preceding and current row),
                     lambda acc, x: (2.0 / 11) * x + (1 - 2.0 / 11) * acc) as ema10
  from bars)"""

SPREAD = """
matched as (
  select * from ema
  where source in ('BINANCE', 'COINBASE', 'KRAKEN')
    and (symbol, window_start_ms) in (
      select symbol, window_start_ms from ema
      where source in ('BINANCE', 'COINBASE', 'KRAKEN')
      group by symbol, window_start_ms having count(distinct source) = 3)),
spread as (
  select m.*,
         max(close) over g - min(close) over g as spread_usd,
         (max(close) over g - min(close) over g) / nullif(avg(close) over g, 0) * 10000 as spread_bps
  from matched m
  window g as (partition by symbol, window_start_ms))"""


def with_(*ctes: str) -> str:
    return "with " + ",".join(ctes) + "\n"


def R(x: str) -> str:
    """6-place rounding with the boundary moved off exact decimal ties (see
    __spark_entry__.rounded)."""
    return f"round(({x}) + 1e-9, 6)"


def r(x: str, alias: str | None = None) -> str:
    return f"{R(x)} as {alias or x}"


BAR_OUT = ("symbol, source, window_start_ms, window_end_ms, " + ", ".join(
    r(c) for c in ["open", "high", "low", "close", "volume", "vwap", "buy_volume", "sell_volume"])
    + ", trade_count")

BAR_JOB = with_(TRADES, BARS, EMA, SPREAD)

# Dashboard settings used by the registered panel queries: one symbol, and eight
# hours of the first day.
PANEL_SYMBOL = "BTCUSD"
PANEL_FROM, PANEL_TO = 1704067200000 + 3600000, 1704067200000 + 9 * 3600000


def _panel(select: str, where: str = "", group: bool = True) -> str:
    q = BAR_JOB + f"select window_start_ms as time_ms, {select} from spread where symbol = '{PANEL_SYMBOL}' " \
        f"and window_start_ms between {PANEL_FROM} and {PANEL_TO} {where}"
    if group:
        q += " group by window_start_ms"
    return q + " order by time_ms"


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["ohlcv_bars"] = with_(TRADES, BARS) + f"select {BAR_OUT} from bars"
    q["bar_vwap"] = with_(TRADES, BARS) + "select symbol, source, window_start_ms, round((vwap) + 1e-9, 6) as vwap from bars"
    q["ema10"] = with_(TRADES, BARS, EMA) + f"select {BAR_OUT}, round((ema10) + 1e-9, 6) as ema10 from ema"
    q["match_sources"] = BAR_JOB + f"select {BAR_OUT}, round((ema10) + 1e-9, 6) as ema10 from matched"
    q["spread_bars"] = BAR_JOB + (f"select {BAR_OUT}, round((ema10) + 1e-9, 6) as ema10, "
                                  "round((spread_usd) + 1e-9, 6) as spread_usd, round((spread_bps) + 1e-9, 6) as spread_bps from spread")
    q["canonical_symbol"] = with_(TRADES) + (
        "select trade_id, raw_symbol, replace(case when raw_symbol like '%USDT' "
        "then left(raw_symbol, length(raw_symbol) - 1) else raw_symbol end, '-', '') as canonical from trades")
    q["panel_candles"] = _panel("round((avg(open)) + 1e-9, 6) as open, round((max(high)) + 1e-9, 6) as high, "
                                "round((min(low)) + 1e-9, 6) as low, round((avg(close)) + 1e-9, 6) as close")
    q["panel_vwap"] = _panel("round((sum(vwap * volume) / nullif(sum(volume), 0)) + 1e-9, 6) as vwap")
    q["panel_buy_sell"] = _panel("round((sum(buy_volume)) + 1e-9, 6) as buy_volume, round((sum(sell_volume)) + 1e-9, 6) as sell_volume")
    q["panel_close_ema"] = _panel("round((avg(close)) + 1e-9, 6) as close, round((avg(ema10)) + 1e-9, 6) as ema10")
    q["panel_imbalance"] = _panel("round(((sum(buy_volume) - sum(sell_volume)) / "
                                  "nullif(sum(buy_volume) + sum(sell_volume), 0)) + 1e-9, 6) as imbalance")
    q["spread_usd_series"] = _panel("round((spread_usd) + 1e-9, 6) as spread_usd",
                                    "and source = 'BINANCE' and spread_usd is not null", group=False)
    q["spread_bps_series"] = _panel("round((spread_bps) + 1e-9, 6) as spread_bps",
                                    "and source = 'BINANCE' and spread_bps is not null", group=False)
    q["distinct_symbols"] = BAR_JOB + "select distinct symbol from spread order by symbol"
    q["latest_bars"] = BAR_JOB + (f"select {BAR_OUT}, round((ema10) + 1e-9, 6) as ema10, round((spread_usd) + 1e-9, 6) as spread_usd, "
                                  "round((spread_bps) + 1e-9, 6) as spread_bps from spread "
                                  "order by window_start_ms desc, symbol, source limit 10")
    q["bar_rollup"] = with_(TRADES, BARS) + """
select symbol, source, window_start_ms // 300000 * 300000 as window_start_ms,
       window_start_ms // 300000 * 300000 + 300000 as window_end_ms,
       round((arg_min(open, window_start_ms)) + 1e-9, 6) as open, round((max(high)) + 1e-9, 6) as high,
       round((min(low)) + 1e-9, 6) as low, round((arg_max(close, window_start_ms)) + 1e-9, 6) as close,
       round((sum(volume)) + 1e-9, 6) as volume,
       round((case when sum(volume) > 0 then sum(vwap * volume) / sum(volume)
                  else arg_max(close, window_start_ms) end) + 1e-9, 6) as vwap,
       round((sum(buy_volume)) + 1e-9, 6) as buy_volume, round((sum(sell_volume)) + 1e-9, 6) as sell_volume,
       cast(sum(trade_count) as integer) as trade_count
from bars group by symbol, source, window_start_ms // 300000 * 300000"""
    q.update(feed_oracles())
    q.update(trade_oracles())
    q.update(encode_oracle())
    q.update(book_oracles())
    q.update(stream_oracles())
    q["book_from_frames"] = book_frames_oracle()
    q.update(published_oracles())
    q["stream_bars_from_frames"] = "with " + TRADES + """,
trade_frames as (select * from trades where trade_id % 50 <> 0 and trade_id % 5 <> 4)""" + \
        "," + BARS.replace("from trades", "from trade_frames") + \
        f"\nselect {BAR_OUT} from bars where window_end_ms + 5000 <= (select max(trade_time_ms) from trade_frames)"
    q["bars_from_frames"] = "with " + TRADES + """,
trade_frames as (select * from trades where trade_id % 50 <> 0 and trade_id % 5 <> 4)""" + \
        "," + BARS.replace("from trades", "from trade_frames") + f"\nselect {BAR_OUT} from bars"
    return q


# ------------------------------------------------------------------ feeds
FRAMES = TRADES + """,
frames as (
  select t.*, t.trade_id as seq, t.ingestion_time_ms as recv_ms,
         case when t.trade_id % 50 = 0 then 'dead' when t.trade_id % 5 = 4 then 'book' else 'trade' end as kind,
         case when ev.event_id % 97 = 0 then 'snapshot' else 'update' end as level_kind,
         case when ev.event_type in ('view', 'click') then 'bid' else 'ask' end as level_side,
         cast(floor(ev.value / 5) * 5 as double) as level_price,
         cast(json_extract_string(ev.props, '$.k') as double) % 5 as level_qty
  from trades t join events ev on ev.event_id = t.trade_id)"""

FEED_SYMBOL = ("case source when 'COINBASE' then replace(raw_symbol, '-', '') "
               "when 'KRAKEN' then replace(replace(raw_symbol, '/', ''), 'XBT', 'BTC') else raw_symbol end")

NORMALIZED_COLS = ("source, seq, cast(0 as bigint) as pos, 'trade' as event_type, {event_time} as event_time_ms, "
                   "{symbol} as symbol, trade_id, {price} as price, {qty} as quantity, trade_time_ms, "
                   "is_buyer_maker, recv_ms as ingestion_time_ms, recv_ms - trade_time_ms as latency_ms")


def _norm(source: str) -> str:
    event_time = {"BINANCE": "trade_time_ms", "COINBASE": "recv_ms", "KRAKEN": "trade_time_ms"}[source]
    price = "price" if source == "KRAKEN" else "cast(printf('%.2f', price) as double)"
    qty = "quantity" if source == "KRAKEN" else "cast(printf('%.2f', quantity) as double)"
    cols = NORMALIZED_COLS.format(event_time=event_time, symbol=FEED_SYMBOL, price=price, qty=qty)
    return f"select {cols} from frames where kind = 'trade' and source = '{source}'"


def feed_oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    pre = "with " + FRAMES + "\n"
    q["feed_demux"] = pre + "select source, seq, kind from frames"
    for i, s in ((1, "BINANCE"), (2, "COINBASE"), (3, "KRAKEN")):
        q[f"normalize_feed{i}"] = pre + _norm(s)
    q["union_feeds"] = pre + " union all ".join(_norm(s) for s in ("BINANCE", "COINBASE", "KRAKEN"))
    q["dead_letters"] = pre + ("select 'not json ' || cast(seq as varchar) as rawPayload, 'ParseError' as error, "
                               "recv_ms as ingestionTimeMs, source, seq from frames where kind = 'dead'")
    q["feed_counts"] = pre + ("select source, count(*) as frames, cast(count_if(kind = 'trade') as bigint) as trade_frames, "
                              "cast(count_if(kind = 'book') as bigint) as book_frames, cast(0 as bigint) as ignored_frames, "
                              "cast(count_if(kind = 'dead') as bigint) as dead_frames, "
                              "cast(count_if(kind = 'trade') as bigint) as produced_trades, "
                              "cast(count_if(kind = 'dead') as bigint) as dead_letters from frames group by source")
    q["book_feed1"] = pre + ("select source, seq, upper(raw_symbol) as symbol, recv_ms as timestamp_ms, "
                             "level_side as side, 1 as level, cast(printf('%.2f', level_price) as double) as price, "
                             "cast(printf('%.2f', level_qty) as double) as quantity "
                             "from frames where kind = 'book' and source = 'BINANCE'")
    q["book_feed2_deltas"] = pre + (f"select source, {FEED_SYMBOL} as symbol, seq, cast(0 as bigint) as sub, cast(0 as bigint) as lpos, "
                                    "level_kind as kind, level_side as side, "
                                    "cast(printf('%.2f', level_price) as double) as price, "
                                    "cast(printf('%.2f', level_qty) as double) as quantity, false as keep_zero, "
                                    "trade_time_ms as timestamp_ms from frames where kind = 'book' and source = 'COINBASE'")
    q["book_feed3_deltas"] = pre + (f"select source, {FEED_SYMBOL} as symbol, seq, cast(0 as bigint) as sub, cast(0 as bigint) as lpos, "
                                    "level_kind as kind, level_side as side, level_price as price, "
                                    "level_qty as quantity, level_kind = 'snapshot' as keep_zero, "
                                    "trade_time_ms as timestamp_ms from frames where kind = 'book' and source = 'KRAKEN'")
    q["encode_book_json"] = pre + """
select upper(raw_symbol) as key,
       json_object('source', source, 'symbol', upper(raw_symbol), 'timestampMs', recv_ms,
                   'bids', case when level_side = 'bid'
                                then [{'price': cast(printf('%.2f', level_price) as double),
                                       'quantity': cast(printf('%.2f', level_qty) as double)}] else [] end,
                   'asks', case when level_side = 'ask'
                                then [{'price': cast(printf('%.2f', level_price) as double),
                                       'quantity': cast(printf('%.2f', level_qty) as double)}] else [] end)::varchar as value
from frames where kind = 'book' and source = 'BINANCE'"""
    q["encode_dead_letters"] = pre + """
select cast(null as varchar) as key,
       json_object('rawPayload', 'not json ' || cast(seq as varchar), 'error', 'ParseError',
                   'ingestionTimeMs', recv_ms)::varchar as value
from frames where kind = 'dead'"""
    q["symbol_filter"] = pre + ("select trade_id, source, raw_symbol from trades "
                                "where raw_symbol in ('BTCUSDT', 'BTC-USD', 'XBT/USD')")
    q["raw_frames_scan"] = pre + "select source, seq, recv_ms, kind from frames"
    return q


# ------------------------------------------------------------ trade job
HOUR = 3600000
START = 1704067200000

WIRE = TRADES + f""",
wire as (
  select 'trade' as event_type, trade_time_ms as event_time_ms, {FEED_SYMBOL} as symbol, trade_id,
         price, quantity, trade_time_ms, is_buyer_maker, source, ingestion_time_ms, latency_ms,
         cast(trade_id % 3 as integer) as partition, trade_id as "offset", trade_id as arrival,
         raw_symbol
  from trades)"""

ENRICHED = ("trade_time_ms, symbol, source, trade_id, round((price) + 1e-9, 6) as price, "
            "round((quantity) + 1e-9, 6) as quantity, case when is_buyer_maker then 'SELL' else 'BUY' end as side, "
            "ingestion_time_ms, latency_ms")


def trade_oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    w = "with " + WIRE + "\n"
    q["decode_wire_json"] = w + ("select event_type, event_time_ms, symbol, trade_id, round((price) + 1e-9, 6) as price, "
                                 "round((quantity) + 1e-9, 6) as quantity, trade_time_ms, is_buyer_maker, source, "
                                 "ingestion_time_ms, latency_ms, partition, \"offset\", arrival from wire")
    q["enrich_side"] = w + f"select {ENRICHED} from wire"
    q["trade_latency"] = w + "select trade_id, ingestion_time_ms, ingestion_time_ms - trade_time_ms as latency_ms from wire"
    q["epoch_ms_roundtrip"] = "with " + TRADES + ("\nselect trade_id, trade_time_ms, trade_time_ms as ts_ms, "
                                                  "strftime(make_timestamp(trade_time_ms * 1000), '%Y-%m-%dT%H:%M:%S.%gZ') as iso, "
                                                  "trade_time_ms as iso_ms from trades")
    q["composite_key_split"] = "with " + TRADES + ("\nselect trade_id, symbol || '~' || source as key, "
                                                   "symbol as key_symbol, source as key_source from trades")
    q["insert_ignore_trades"] = "with " + TRADES + f"\nselect {ENRICHED} from trades"
    q["late_trades"] = "with " + TRADES + f""",
moved as (
  select trade_id, source, arrival,
         case when trade_id % 7 = 0 then trade_time_ms - ((trade_id * 7919) % 41) * 4000
              else trade_time_ms end as trade_time_ms
  from trades)
select trade_id, source, trade_time_ms,
       coalesce(trade_time_ms // 60000 * 60000 + 60000 <=
                max(trade_time_ms) over (partition by source order by arrival
                                         rows between unbounded preceding and 1 preceding) - 5000,
                false) as is_late
from moved"""
    q["retain_trades"] = "with " + TRADES + (f"\nselect {ENRICHED} from trades "
                                             f"where trade_time_ms >= (select max(trade_time_ms) from trades) - {6 * HOUR}")
    q["latest_trades_by_symbol"] = "with " + TRADES + (f"\nselect {ENRICHED} from trades where symbol = 'BTCUSD' "
                                                       "order by trade_time_ms desc, trade_id desc limit 20")
    cols = ["open", "high", "low", "close", "volume", "vwap", "buy_volume", "sell_volume", "ema10"]
    tsel = ", ".join(f"t.{c}" for c in cols)
    q["upsert_bars_merge"] = BAR_JOB.rstrip("\n") + f""",
target as (
  select symbol, source, window_start_ms, {', '.join(cols)}, trade_count,
         0.0 as spread_usd, 0.0 as spread_bps
  from ema where window_start_ms < {START + 8 * HOUR}),
updates as (
  select symbol, source, window_start_ms, open, high, low, close + 1 as close, volume, vwap, buy_volume,
         sell_volume, ema10, trade_count, spread_usd, spread_bps
  from spread),
merged as (
  select coalesce(t.symbol, u.symbol) as symbol, coalesce(t.source, u.source) as source,
         coalesce(t.window_start_ms, u.window_start_ms) as window_start_ms,
         {', '.join(f'case when t.symbol is not null then t.{c} else u.{c} end as {c}' for c in cols + ['trade_count'])},
         case when u.symbol is not null then u.spread_usd else t.spread_usd end as spread_usd,
         case when u.symbol is not null then u.spread_bps else t.spread_bps end as spread_bps
  from target t full outer join updates u
    on t.symbol = u.symbol and t.source = u.source and t.window_start_ms = u.window_start_ms)
select symbol, source, window_start_ms, {', '.join(R(c) + ' as ' + c for c in cols)}, trade_count,
       {R('spread_usd')} as spread_usd, {R('spread_bps')} as spread_bps
from merged"""
    q["bars_scan_filtered"] = BAR_JOB + (f"select symbol, source, window_start_ms, "
                                         f"{', '.join(R(c) + ' as ' + c for c in cols)}, trade_count, "
                                         f"{R('spread_usd')} as spread_usd, {R('spread_bps')} as spread_bps from spread "
                                         f"where symbol = 'BTCUSD' and source = 'BINANCE' "
                                         f"and window_start_ms between {START + HOUR} and {START + 5 * HOUR}")
    rules = [(f"{c} not null", f"{c} is null") for c in
             ("trade_time_ms", "symbol", "source", "trade_id", "price", "quantity", "side", "ingestion_time_ms", "latency_ms")]
    rules += [(f"{c} length <= {n}", f"length({c}) > {n}") for c, n in (("symbol", 20), ("source", 20), ("side", 4))]
    broken = "with " + TRADES + """,
broken as (
  select nullif(trade_time_ms, case when trade_id % 59 = 0 then trade_time_ms end) as trade_time_ms,
         case when trade_id % 37 = 0 then null when trade_id % 41 = 0 then repeat('S', 21) else symbol end as symbol,
         case when trade_id % 43 = 0 then repeat(source, 4) else source end as source, trade_id,
         case when trade_id % 47 = 0 then null else price end as price,
         case when trade_id % 53 = 0 then null else quantity end as quantity,
         case when trade_id % 61 = 0 then 'LONGER' when is_buyer_maker then 'SELL' else 'BUY' end as side,
         ingestion_time_ms, latency_ms
  from trades)
"""
    q["constraint_violations"] = broken + " union all ".join(
        f"select '{name}' as rule, cast(count_if(coalesce({cond}, false)) as bigint) as violations from broken"
        for name, cond in rules)
    case = " ".join(f"when {cond} then '{name.replace('not null', 'is null').replace('length <=', 'longer than')}'"
                    for name, cond in rules)
    q["constraint_dead_letters"] = broken + f"select trade_id, reason from (select trade_id, case {case} end as reason " \
        "from broken) where reason is not null"
    return q


def encode_oracle() -> dict[str, str]:
    return {"encode_wire_json": "with " + WIRE + """
select symbol as key,
       json_object('e', event_type, 'E', event_time_ms, 's', symbol, 't', trade_id, 'p', price,
                   'q', quantity, 'T', trade_time_ms, 'm', is_buyer_maker, 'source', source,
                   'ingestionTimeMs', ingestion_time_ms, 'latencyMs', latency_ms)::varchar as value
from wire"""}


# ------------------------------------------------------------ order book
DELTAS = """
deltas as (
  select case event_id % 3 when 0 then 'BINANCE' when 1 then 'COINBASE' else 'KRAKEN' end as source,
         case when user_id % 2 = 0 then 'BTCUSD' else 'ETHUSD' end as symbol,
         event_id as seq,
         case when event_id % 97 = 0 then 'snapshot' else 'update' end as kind,
         case when event_type in ('view', 'click') then 'bid' else 'ask' end as side,
         cast(floor(value / 5) * 5 as double) as price,
         cast(json_extract_string(props, '$.k') as double) % 5 as quantity
  from events),
epochs as (
  select *, sum(case when kind = 'snapshot' then 1 else 0 end)
              over (partition by source, symbol order by seq rows between unbounded preceding and current row) as epoch
  from deltas),
versions as (
  select *, lead(seq) over (partition by source, symbol, epoch, side, price order by seq) as next_seq
  from epochs),
live as (
  select m.source, m.symbol, m.seq, cast(0 as bigint) as sub, v.side, v.price, v.quantity
  from epochs m join versions v
    on m.source = v.source and m.symbol = v.symbol and m.epoch = v.epoch
   and v.seq <= m.seq and (v.next_seq is null or m.seq < v.next_seq)
  where v.quantity <> 0)"""


def book_oracles() -> dict[str, str]:
    pre = "with " + DELTAS + "\n"
    return {
        "book_levels_asof": pre + "select * from live",
        "book_top20": pre + """select * from (
  select *, cast(row_number() over (partition by source, symbol, seq, sub, side
                                    order by case when side = 'bid' then -price else price end) as integer) as level
  from live) where level <= 20""",
    }


# ------------------------------------------------------------ streaming
CLOSED = "window_end_ms + 5000 <= (select max(trade_time_ms) from trades)"


def stream_oracles() -> dict[str, str]:
    o = oracle_sql_base()
    return {
        "stream_ohlcv_bars": with_(TRADES, BARS) + f"select {BAR_OUT} from bars where {CLOSED}",
        "stream_ema10": with_(TRADES, BARS, EMA) + f"select {BAR_OUT}, {R('ema10')} as ema10 from ema where {CLOSED}",
        "stream_spread_bars": o["spread_bars"] + f" where {CLOSED}",
        "stream_restart": o["spread_bars"] + f" where {CLOSED}",
        "stream_crash_restart": o["spread_bars"] + f" where {CLOSED}",
        "stream_enrich_trades": trade_oracles()["enrich_side"],
        "stream_trade_source": trade_oracles()["decode_wire_json"],
        "wire_dead_letters": "with " + WIRE + """,
letters as (
  select partition, "offset", case
    when "offset" % 101 = 0 or "offset" % 103 = 0 or "offset" % 107 = 0 or "offset" % 109 = 0 then 'ParseError'
    when "offset" % 113 = 0 then null
    when "offset" % 127 = 0 then 'ConstraintViolation: source is null'
    when "offset" % 131 = 0 then 'ConstraintViolation: symbol longer than 20' end as error
  from wire)
select * from letters where error is not null""",
        "stream_late_drop": late_drop_oracle(8),
        "stream_book": book_oracles()["book_top20"],
        "stream_union_feeds": feed_oracles()["union_feeds"],
        "stream_dead_letters": feed_oracles()["dead_letters"],
        "stream_upsert_replay": BAR_JOB + (
            "select symbol, source, window_start_ms, " + ", ".join(
                R(c) + " as " + c for c in ["open", "high", "low", "close", "volume", "vwap", "buy_volume",
                                            "sell_volume", "ema10", "spread_usd", "spread_bps"])
            + f", trade_count from spread where {CLOSED}"),
        "match_sources_join": with_(TRADES, BARS) + """
select b.symbol, b.window_start_ms, round((b.close) + 1e-9, 6) as close_binance,
       round((c.close) + 1e-9, 6) as close_coinbase, round((k.close) + 1e-9, 6) as close_kraken,
       round((greatest(b.close, c.close, k.close) - least(b.close, c.close, k.close)) + 1e-9, 6) as spread_usd,
       round(((greatest(b.close, c.close, k.close) - least(b.close, c.close, k.close))
              / nullif((b.close + c.close + k.close) / 3.0, 0) * 10000) + 1e-9, 6) as spread_bps
from bars b join bars c on b.symbol = c.symbol and b.window_start_ms = c.window_start_ms
            join bars k on b.symbol = k.symbol and b.window_start_ms = k.window_start_ms
where b.source = 'BINANCE' and c.source = 'COINBASE' and k.source = 'KRAKEN'""",
    }


def oracle_sql_base() -> dict[str, str]:
    return {"spread_bars": BAR_JOB + (f"select {BAR_OUT}, {R('ema10')} as ema10, "
                                      f"{R('spread_usd')} as spread_usd, {R('spread_bps')} as spread_bps from spread")}


def late_drop_oracle(batches: int) -> str:
    """Bars of the late-trade stream.  Files are slices of arrival; a row of
    micro-batch N is dropped iff its window end <= (max event time of
    batches <= N-2) - 5 s (Spark filters late rows with the previous
    batch's watermark); windows are emitted once end + 5 s <= max time."""
    return "with " + TRADES + f""",
moved as (
  select trade_id, symbol, source, price, quantity, is_buyer_maker, arrival,
         case when trade_id % 7 = 0 then trade_time_ms - ((trade_id * 7919) % 41) * 4000
              else trade_time_ms end - case when trade_id % 211 = 0 then 14400000 else 0 end as trade_time_ms
  from trades),
sliced as (
  select m.*, (arrival - s.lo) // s.step as batch
  from moved m, (select min(arrival) as lo, (max(arrival) - min(arrival)) // {batches} + 1 as step from moved) s),
per_batch as (select batch, max(trade_time_ms) as bmax from sliced group by batch),
late_wm as (
  select batch, max(bmax) over (order by batch range between unbounded preceding and 2 preceding) - 5000 as wm
  from per_batch),
kept as (
  select s.* from sliced s join late_wm w using (batch)
  where w.wm is null or s.trade_time_ms // 60000 * 60000 + 60000 > w.wm),
bars as (
  select symbol, source, trade_time_ms // 60000 * 60000 as window_start_ms,
         trade_time_ms // 60000 * 60000 + 60000 as window_end_ms,
         arg_min(price, arrival) as open, max(price) as high, min(price) as low, arg_max(price, arrival) as close,
         sum(quantity) as volume,
         case when sum(quantity) > 0 then sum(price * quantity) / sum(quantity) else arg_max(price, arrival) end as vwap,
         sum(case when is_buyer_maker then 0.0 else quantity end) as buy_volume,
         sum(case when is_buyer_maker then quantity else 0.0 end) as sell_volume,
         cast(count(*) as integer) as trade_count
  from kept group by symbol, source, trade_time_ms // 60000 * 60000)
select {BAR_OUT} from bars where window_end_ms + 5000 <= (select max(trade_time_ms) from moved)"""


def book_frames_oracle() -> str:
    """Books rebuilt from the captured book frames of feeds 2 and 3."""
    return "with " + FRAMES + f""",
deltas as (
  select source, {FEED_SYMBOL} as symbol, seq, level_kind as kind, level_side as side,
         level_price as price, level_qty as quantity,
         source = 'KRAKEN' and level_kind = 'snapshot' as keep_zero
  from frames where kind = 'book' and source in ('COINBASE', 'KRAKEN')),
epochs as (
  select *, sum(case when kind = 'snapshot' then 1 else 0 end)
              over (partition by source, symbol order by seq rows between unbounded preceding and current row) as epoch
  from deltas),
versions as (
  select *, lead(seq) over (partition by source, symbol, epoch, side, price order by seq) as next_seq
  from epochs),
live as (
  select m.source, m.symbol, m.seq, cast(0 as bigint) as sub, v.side, v.price, v.quantity
  from epochs m join versions v
    on m.source = v.source and m.symbol = v.symbol and m.epoch = v.epoch
   and v.seq <= m.seq and (v.next_seq is null or m.seq < v.next_seq)
  where v.quantity <> 0 or v.keep_zero)
select * from (
  select *, cast(row_number() over (partition by source, symbol, seq, sub, side
                                    order by case when side = 'bid' then -price else price end) as integer) as level
  from live) where level <= 20"""


#: A feed is silent when no frame came for this long (its disconnection).
SILENCE_MS = 30_000


def published_oracles() -> dict[str, str]:
    """The book topic of all three feeds: rows of the snapshots, and the sizes
    of both sides for every message (empty books included)."""
    top = book_frames_oracle()
    head, last = top[:top.rindex("select * from (")], top[top.rindex("select * from ("):]
    pre = head.rstrip() + f""",
top as ({last}),
msgs as (
  select source, {FEED_SYMBOL} as symbol, seq, trade_time_ms as timestamp_ms
  from frames where kind = 'book' and source in ('COINBASE', 'KRAKEN')),
feed1 as (
  select source, upper(raw_symbol) as symbol, seq, recv_ms as timestamp_ms, level_side as side,
         cast(printf('%.2f', level_price) as double) as price, cast(printf('%.2f', level_qty) as double) as quantity
  from frames where kind = 'book' and source = 'BINANCE')
"""
    return {
        "stream_feed_liveness": "with " + FRAMES + f""",
gaps as (
  select source, seq, recv_ms, case when recv_ms - lag(recv_ms) over (partition by source order by recv_ms, seq) <= {SILENCE_MS}
                               then 0 else 1 end as opens from frames),
spans as (
  select source, recv_ms, sum(opens) over (partition by source order by recv_ms, seq rows between unbounded preceding and current row) as span
  from gaps),
closed as (
  select source, min(recv_ms) as first_ms, max(recv_ms) + {SILENCE_MS} as end_ms from spans group by source, span
  having max(recv_ms) + {SILENCE_MS} <= (select max(recv_ms) - 1000 from frames))
select source, first_ms as at_ms, true as connected from closed
union all select source, end_ms, false from closed""",
        "stream_book_topic": pre + """,
snaps as (
  select source, symbol, seq, side, cast(level as integer) as level, price, quantity from top
  union all select source, symbol, seq, side, 1, price, quantity from feed1),
heads as (
  select source, symbol, seq, timestamp_ms from msgs
  union all select source, symbol, seq, timestamp_ms from feed1)
select h.symbol as key, h.source, h.symbol, h.timestamp_ms, s.side, s.level, s.price, s.quantity
from heads h left join snaps s on s.source = h.source and s.symbol = h.symbol and s.seq = h.seq""",
        "book_snapshots": pre + """
select t.source, t.symbol, t.seq, t.sub, m.timestamp_ms, t.side, t.level, t.price, t.quantity
from top t join msgs m on t.source = m.source and t.symbol = m.symbol and t.seq = m.seq
union all
select source, symbol, seq, cast(0 as bigint), timestamp_ms, side, 1, price, quantity from feed1""",
        "book_messages": pre + """
select m.source, m.symbol, m.seq, cast(0 as bigint) as sub, m.timestamp_ms,
       cast(count(case when t.side = 'bid' then 1 end) as integer) as n_bids,
       cast(count(case when t.side = 'ask' then 1 end) as integer) as n_asks
from msgs m left join top t on t.source = m.source and t.symbol = m.symbol and t.seq = m.seq
group by all
union all
select source, symbol, seq, cast(0 as bigint), timestamp_ms,
       cast(side = 'bid' as integer), cast(side = 'ask' as integer) from feed1""",
    }

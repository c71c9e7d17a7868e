"""Symbol clean-up rules (O-17..O-20, O-27)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickbars.constants import FEED3_BASE_ALIAS, QUOTE_WITH_T

KEY_SEP = "~"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def canonical_symbol(c: Column | str) -> Column:
    """BTCUSDT / BTC-USD / BTC-USDT -> BTCUSD: drop a trailing T of USDT, then '-'."""
    s = _c(c)
    trimmed = F.when(s.endswith(QUOTE_WITH_T), s.substr(F.lit(1), F.length(s) - 1)).otherwise(s)
    return F.replace(trimmed, F.lit("-"), F.lit(""))


def coinbase_symbol(c: Column | str) -> Column:
    """Feed 2 product id -> symbol: remove '-'."""
    return F.replace(_c(c), F.lit("-"), F.lit(""))


def kraken_symbol(c: Column | str) -> Column:
    """Feed 3 pair -> symbol: remove '/', then XBT -> BTC."""
    return F.replace(F.replace(_c(c), F.lit("/"), F.lit("")), F.lit(FEED3_BASE_ALIAS[0]), F.lit(FEED3_BASE_ALIAS[1]))


def stream_symbol(c: Column | str) -> Column:
    """Feed 1 stream name 'btcusdt@depth20@100ms' -> 'BTCUSDT'."""
    return F.upper(F.substring_index(_c(c), "@", 1))


def composite_key(symbol: Column | str, source: Column | str) -> Column:
    """symbol~source; a null part is written as the text 'null'."""
    return F.concat(F.coalesce(_c(symbol), F.lit("null")), F.lit(KEY_SEP),
                    F.coalesce(_c(source), F.lit("null")))


def split_composite_key(c: Column | str) -> tuple[Column, Column]:
    """Inverse of composite_key: split on the first '~'; missing part -> 'UNKNOWN'."""
    parts = F.split(_c(c), KEY_SEP, 2)
    return parts.getItem(0), F.coalesce(F.get(parts, 1), F.lit("UNKNOWN"))

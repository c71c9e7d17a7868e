"""Job options from the environment (O-05).

Same variable names and defaults as the feed and job configuration being
reproduced.  The database URL and passwords have no default.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field

# Environment names and their defaults.
DEFAULTS = {
    "KAFKA_BOOTSTRAP_SERVERS": "kafka:29092",
    "KAFKA_TOPIC": "crypto-trades",
    "KAFKA_DLQ_TOPIC": "crypto-trades-dlq",
    "KAFKA_ORDERBOOK_TOPIC": "crypto-orderbook",
    "SYMBOLS": "BTCUSDT",
    "BINANCE_DEPTH_STREAMS": "btcusdt@depth20@100ms",
    "COINBASE_SYMBOLS": "BTC-USD",
    "KRAKEN_SYMBOLS": "BTC/USD",
}


def split_symbols(text: str, upper: bool = False) -> list[str]:
    """Comma list -> trimmed, non-empty items (upper-cased for feed 1)."""
    items = [s.strip() for s in (text or "").split(",")]
    return [s.upper() if upper else s for s in items if s]


@dataclass(frozen=True)
class JobOptions:
    bootstrap_servers: str = DEFAULTS["KAFKA_BOOTSTRAP_SERVERS"]
    trade_topic: str = DEFAULTS["KAFKA_TOPIC"]
    dlq_topic: str = DEFAULTS["KAFKA_DLQ_TOPIC"]
    book_topic: str = DEFAULTS["KAFKA_ORDERBOOK_TOPIC"]
    binance_symbols: list[str] = field(default_factory=lambda: ["BTCUSDT"])
    binance_depth_streams: str = DEFAULTS["BINANCE_DEPTH_STREAMS"]
    coinbase_symbols: list[str] = field(default_factory=lambda: ["BTC-USD"])
    kraken_symbols: list[str] = field(default_factory=lambda: ["BTC/USD"])
    jdbc_url: str | None = None
    jdbc_user: str | None = None
    jdbc_password: str | None = None
    watermark_delay: str = "5 seconds"
    bar_interval: str = "1 minute"
    ema_period: int = 10
    checkpoint_interval: str = "10 seconds"

    @classmethod
    def from_env(cls, env: dict[str, str] | None = None) -> "JobOptions":
        env = dict(os.environ if env is None else env)

        def get(k: str) -> str:
            return env.get(k, DEFAULTS[k])

        return cls(
            bootstrap_servers=get("KAFKA_BOOTSTRAP_SERVERS"),
            trade_topic=get("KAFKA_TOPIC"),
            dlq_topic=get("KAFKA_DLQ_TOPIC"),
            book_topic=get("KAFKA_ORDERBOOK_TOPIC"),
            binance_symbols=split_symbols(get("SYMBOLS"), upper=True),
            binance_depth_streams=get("BINANCE_DEPTH_STREAMS"),
            coinbase_symbols=split_symbols(get("COINBASE_SYMBOLS")),
            kraken_symbols=split_symbols(get("KRAKEN_SYMBOLS")),
            jdbc_url=env.get("JDBC_URL") or env.get("TIMESCALEDB_URL"),
            jdbc_user=env.get("JDBC_USER"),
            jdbc_password=env.get("JDBC_PASSWORD"),
        )

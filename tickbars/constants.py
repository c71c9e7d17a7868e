"""Names and settings that must equal those of the pipeline
being reproduced for results to match.  Stated once, here.
"""

# Exchange sources, in feed order.
SOURCE_FEED1 = "BINANCE"
SOURCE_FEED2 = "COINBASE"
SOURCE_FEED3 = "KRAKEN"
MATCH_SOURCES = (SOURCE_FEED1, SOURCE_FEED2, SOURCE_FEED3)

# Channel dispatch of the raw frames.
FEED1_DEPTH_MARKER = "@depth"          # feed 1: stream name containing it -> book
FEED1_TRADE_EVENT = "trade"            # feed 1: data.e of a trade
FEED2_TRADE_CHANNEL = "market_trades"
FEED2_BOOK_CHANNEL = "l2_data"
FEED3_TRADE_CHANNEL = "trade"
FEED3_BOOK_CHANNEL = "book"
SNAPSHOT = "snapshot"

# Sides as each feed spells them.
FEED2_SELL = "SELL"                    # feed 2 trade side of a buyer-maker trade
FEED3_SELL = "sell"                    # feed 3 trade side of a buyer-maker trade
BID = "bid"                            # book side; any other side is an ask
SIDE_SELL = "SELL"                     # enriched side label when the buyer is the maker
SIDE_BUY = "BUY"

# Symbol rules.
QUOTE_WITH_T = "USDT"                  # canonical: drop the trailing T of this suffix
FEED3_BASE_ALIAS = ("XBT", "BTC")      # feed 3: XBT means BTC

# Dead letters and job settings.
PARSE_ERROR = "ParseError"
BAR_INTERVAL_MS = 60_000               # 1-minute tumbling windows
WATERMARK_DELAY = "5 seconds"          # bounded out-of-orderness
EMA_PERIOD = 10
BOOK_DEPTH = 20
TRADE_RETENTION_MS = 24 * 3_600_000

# Not a fixed value of the reference: stands for a null string key inside
# keyed steps (joins treat null as no match); no symbol or source contains it.
NULL_KEY = "\u0000"

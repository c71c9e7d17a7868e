"""Column-expression helpers (all JVM built-ins, no Python UDFs)."""

from tickbars.functions.symbols import (  # noqa: F401
    canonical_symbol,
    coinbase_symbol,
    kraken_symbol,
    stream_symbol,
    composite_key,
    split_composite_key,
)
from tickbars.functions.timefns import (  # noqa: F401
    epoch_ms,
    ms_to_ts,
    iso_to_ms,
    floor_to,
)

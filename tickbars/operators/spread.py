"""Three-way source match and cross-source spread (O-60, O-61, O-86).

The reference keeps per-source bar maps in keyed state and emits the three
bars of a (symbol, minute) once all three sources have one.  On a table this
is a window over (symbol, window_start): each group holds at most one bar per
source, so groups are tiny and bounded; no self-join, no pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickbars.constants import MATCH_SOURCES  # noqa: E402  (re-exported)


def match_sources(bars: DataFrame, sources: tuple[str, ...] = MATCH_SOURCES,
                  time_col: str = "window_start_ms", group_extra: tuple[str, ...] = ()) -> DataFrame:
    """Bars of the (symbol, window) groups in which every source has a bar.
    ``group_extra``: columns that are functions of the window (e.g. its time
    chunk), added to the window partition so an existing partitioning on
    (symbol, chunk) is reused."""
    g = Window.partitionBy("symbol", *group_extra, time_col)
    b = bars.filter(F.col("source").isin(*sources))
    b = b.withColumn("_n", F.size(F.collect_set("source").over(g)))
    return b.filter(F.col("_n") == len(sources)).drop("_n")


def spread_bars(bars: DataFrame, sources: tuple[str, ...] = MATCH_SOURCES,
                time_col: str = "window_start_ms", group_extra: tuple[str, ...] = ()) -> DataFrame:
    """Matched bars with spread_usd = max(close) - min(close) and
    spread_bps = spread_usd / avg(close) * 10000 (null when avg is 0)."""
    g = Window.partitionBy("symbol", *group_extra, time_col)
    b = bars.filter(F.col("source").isin(*sources))
    b = b.select(
        "*",
        F.size(F.collect_set("source").over(g)).alias("_n"),
        (F.max("close").over(g) - F.min("close").over(g)).alias("spread_usd"),
        F.avg("close").over(g).alias("_avg"),
    )
    b = b.filter(F.col("_n") == len(sources))
    b = b.withColumn("spread_bps", F.try_divide(F.col("spread_usd"), F.col("_avg")) * F.lit(10000.0))
    return b.drop("_n", "_avg")


def match_sources_join(bars: DataFrame, sources: tuple[str, ...] = MATCH_SOURCES,
                       time_col: str = "window_start_ms") -> DataFrame:
    """Cross-check form of the match: inner equi-joins of the per-source
    bars on (symbol, window).  Keys are unique per side, so every join is
    1:1 -- no pairs are multiplied.  One row per matched minute with each
    source's close and the spread."""
    key = ["symbol", time_col]
    parts = [bars.filter(F.col("source") == s).select(*key, F.col("close").alias(f"close_{s.lower()}"))
             for s in sources]
    j = parts[0]
    for p in parts[1:]:
        j = j.join(p, on=key, how="inner")
    closes = [F.col(f"close_{s.lower()}") for s in sources]
    avg = sum(closes[1:], closes[0]) / F.lit(float(len(sources)))
    spread = F.greatest(*closes) - F.least(*closes)
    return j.select(*key, *closes, spread.alias("spread_usd"),
                    (F.try_divide(spread, avg) * F.lit(10000.0)).alias("spread_bps"))

"""Symbol and time helpers against plain-Python statements of the rules,
on generated inputs (all examples evaluated in one Spark job)."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickbars.functions.symbols import (canonical_symbol, coinbase_symbol, composite_key, kraken_symbol,
                                        split_composite_key, stream_symbol)
from tickbars.functions.timefns import iso_to_ms, ms_to_ts

ALPHABET = st.text(alphabet="ABCDTUSX-/@~xbt", max_size=12)


def _canonical(s):
    if s.endswith("USDT"):
        s = s[:-1]
    return s.replace("-", "")


@settings(max_examples=1, deadline=None)
@given(st.lists(ALPHABET, min_size=200, max_size=200))
def test_symbol_rules(spark, words):
    df = spark.createDataFrame([(w,) for w in words], "s string")
    k = composite_key("s", F.lit("SRC"))
    a, b = split_composite_key(k)
    rows = df.select("s", canonical_symbol("s").alias("c"), coinbase_symbol("s").alias("cb"),
                     kraken_symbol("s").alias("kr"), stream_symbol("s").alias("st"),
                     a.alias("a"), b.alias("b")).collect()
    for r in rows:
        s = r.s
        assert r.c == _canonical(s)
        assert r.cb == s.replace("-", "")
        assert r.kr == s.replace("/", "").replace("XBT", "BTC")
        assert r.st == s.split("@")[0].upper()
        head, _, tail = (s + "~SRC").partition("~")
        assert (r.a, r.b) == (head, tail)


@settings(max_examples=1, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=4_102_444_800_000), min_size=100, max_size=100))
def test_epoch_ms_roundtrip(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "ms long")
    iso = F.date_format(ms_to_ts("ms"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    for r in df.select("ms", F.unix_millis(ms_to_ts("ms")).alias("a"), iso_to_ms(iso).alias("b")).collect():
        assert r.ms == r.a == r.b


def test_iso_instants_only(spark):
    texts = ["2024-01-01T00:00:01.5Z", "2024-01-01t00:00:01z", "2024-01-01T00:00:01+01:00", "2024", "2024-01-01", "",
             "2024-01-01T00:00:01", "2024-01-01 00:00:01Z", "2024-01-01T00:00Z", "2024-13-01T00:00:00Z", None]
    got = [r.ms for r in spark.createDataFrame([(t,) for t in texts], "s string").select(iso_to_ms("s").alias("ms")).collect()]
    assert got == [1704067201500, 1704067201000, 1704063601000, None, None, None, None, None, None, None, None]

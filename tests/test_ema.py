import random

from tickbars.operators.ema import doubling_depth, ema


def _fold(xs, period):
    a = 2.0 / (period + 1)
    out, e = [], None
    for x in xs:
        e = x if e is None else a * x + (1 - a) * e
        out.append(e)
    return out


def test_depth_reaches_exact_zero():
    for n in (2, 5, 10, 20, 50, 200):
        d = doubling_depth(n)
        assert (1 - 2.0 / (n + 1)) ** (2 ** d) == 0.0


def test_matches_sequential_fold_with_gaps_and_long_history(spark):
    rnd = random.Random(11)
    rows, ref = [], {}
    for key, n in (("A", 5000), ("B", 37), ("C", 1)):
        t, xs = 0, []
        for _ in range(n):
            t += 60_000 * rnd.choice([1, 1, 1, 2, 7])  # gaps are not filled
            x = round(rnd.uniform(10, 1000), 2)
            rows.append((key, "S", t, x))
            xs.append((t, x))
        ref[key] = dict(zip([t for t, _ in xs], _fold([x for _, x in xs], 10)))
    df = spark.createDataFrame(rows, "symbol string, source string, window_start_ms long, close double")
    got = ema(df, period=10).collect()
    assert len(got) == len(rows)
    for r in got:
        exp = ref[r.symbol][r.window_start_ms]
        assert abs(r.ema10 - exp) <= 1e-9 * abs(exp), (r, exp)


def test_other_periods(spark):
    xs = [float(i % 13) for i in range(300)]
    df = spark.createDataFrame([("K", "S", i * 60_000, x) for i, x in enumerate(xs)],
                               "symbol string, source string, window_start_ms long, close double")
    for p in (3, 26):
        got = sorted((r.window_start_ms, r[f"ema{p}"]) for r in ema(df, period=p).collect())
        for (_, g), e in zip(got, _fold(xs, p)):
            assert abs(g - e) < 1e-9


def test_ema_bounded_by_closes_on_fixture(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from tickbars.plans.jobs import bars_with_ema
    from tickbars.sources import fixtures as FX

    bars = bars_with_ema(FX.trades(spark, "/root/testdata/sf0.001"))
    w = Window.partitionBy("symbol", "source").orderBy("window_start_ms") \
        .rowsBetween(Window.unboundedPreceding, 0)
    out = bars.select("ema10", F.min("close").over(w).alias("lo"), F.max("close").over(w).alias("hi"))
    assert out.filter((F.col("ema10") < F.col("lo") - 1e-9) | (F.col("ema10") > F.col("hi") + 1e-9)).count() == 0


def test_chunked_matches_fold(spark):
    from tickbars.operators.ema import ema_chunked

    rnd = random.Random(13)
    rows, ref = [], {}
    for key, n in (("A", 900), ("B", 5), ("C", 1)):
        t, xs = 0, []
        for _ in range(n):
            t += 60_000 * rnd.choice([1, 1, 3])
            x = round(rnd.uniform(10, 1000), 2)
            rows.append((key, "S", t, x))
            xs.append((t, x))
        ref[key] = dict(zip([t for t, _ in xs], _fold([x for _, x in xs], 10)))
    df = spark.createDataFrame(rows, "symbol string, source string, window_start_ms long, close double")
    for chunk in (7, 64, 2048, 4096):
        got = ema_chunked(df, period=10, chunk=chunk).collect()
        assert len(got) == len(rows)
        for r in got:
            exp = ref[r.symbol][r.window_start_ms]
            assert abs(r.ema10 - exp) <= 1e-9 * abs(exp), (chunk, r, exp)


def test_chunked_with_null_key_value(spark):
    from tickbars.operators.ema import ema_chunked

    rows = [("K", None, i * 60_000, float(i + 1)) for i in range(20)] + \
           [("K", "S", i * 60_000, float(2 * i + 1)) for i in range(20)]
    df = spark.createDataFrame(rows, "symbol string, source string, window_start_ms long, close double") \
        .repartition("symbol")
    got = {(r.source, r.window_start_ms): r.ema10
           for r in ema_chunked(df, chunk=7, partition_keys=("symbol",)).collect()}
    for src, xs in ((None, [float(i + 1) for i in range(20)]), ("S", [float(2 * i + 1) for i in range(20)])):
        for i, e in enumerate(_fold(xs, 10)):
            assert abs(got[(src, i * 60_000)] - e) < 1e-9


def test_bar_job_keeps_null_symbol(spark):
    from tickbars.plans.jobs import bars_with_ema

    cols = "trade_id long, symbol string, source string, trade_time_ms long, price double, " \
           "quantity double, is_buyer_maker boolean, arrival long"
    rows = [(i, None if i % 2 else "BTCUSDT", "BINANCE", i * 60_000, float(i), 1.0, False, i) for i in range(10)]
    out = bars_with_ema(spark.createDataFrame(rows, cols)).collect()
    assert len(out) == 10 and sum(r.symbol is None for r in out) == 5


def test_carries_over_many_groups(spark):
    """Groups of two and three chunks give the fold over the whole history."""
    from tickbars.operators.ema import ema_chunked

    xs = [float((7 * i) % 23) for i in range(300)]
    df = spark.createDataFrame([("A", "X", 60_000 * (i + 3 * (i // 40)), x) for i, x in enumerate(xs)],
                               "symbol string, source string, window_start_ms long, close double")
    exp, ema = [], None
    for x in xs:
        ema = x if ema is None else 2 / 11 * x + (1 - 2 / 11) * ema
        exp.append(ema)
    for group in (2, 3, 512):
        got = [r.ema10 for r in ema_chunked(df, chunk=4, group=group).orderBy("window_start_ms").collect()]
        assert max(abs(a - b) for a, b in zip(got, exp)) < 1e-9 and len(got) == len(exp)

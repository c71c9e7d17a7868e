from pyspark.sql import functions as F

from tickbars.operators import tables as TB
from tickbars.operators import trades as TR

BAR = "symbol string, source string, window_start_ms long, close double, spread_usd double, spread_bps double"


def test_merge_upsert_updates_only_spread(spark):
    target = spark.createDataFrame([("B", "X", 0, 1.0, 0.0, 0.0), ("B", "X", 60, 2.0, 0.0, 0.0)], BAR)
    upd = spark.createDataFrame([("B", "X", 60, 9.0, 5.0, None), ("B", "X", 120, 3.0, 1.0, 2.0)], BAR)
    got = {r.window_start_ms: r for r in TB.merge_upsert(target, upd).collect()}
    assert (got[0].close, got[0].spread_usd) == (1.0, 0.0)
    assert (got[60].close, got[60].spread_usd, got[60].spread_bps) == (2.0, 5.0, None)
    assert (got[120].close, got[120].spread_bps) == (3.0, 2.0)


def test_insert_ignore_first_arrival_wins(spark):
    cols = "trade_time_ms long, symbol string, source string, trade_id long, price double, quantity double, " \
           "side string, ingestion_time_ms long, latency_ms long"
    table = spark.createDataFrame([(1, "A", "X", 1, 1.0, 1.0, "BUY", 1, 0)], cols)
    batch = spark.createDataFrame([(1, "A", "X", 1, 9.0, 1.0, "BUY", 1, 0, 5),
                                   (2, "A", "X", 2, 2.0, 1.0, "BUY", 2, 0, 7),
                                   (2, "A", "X", 2, 3.0, 1.0, "BUY", 2, 0, 6)], cols + ", arrival long")
    got = {r.trade_id: r.price for r in TR.insert_ignore(table, batch).collect()}
    assert got == {1: 1.0, 2: 3.0}


def test_retention_and_constraints(spark):
    df = spark.createDataFrame([(0,), (10,), (100,)], "trade_time_ms long")
    assert sorted(r[0] for r in TR.retain(df, keep_ms=50).collect()) == [100]
    rows = spark.createDataFrame([("A" * 25, "X", "BUY"), ("B", None, "SELL"), ("C", "Y", "SELLX")],
                                 "symbol string, source string, side string")
    ok, bad = TB.split_valid(rows, ["symbol", "source", "side"])
    assert ok.count() == 0
    assert sorted(r.reason for r in bad.collect()) == ["side longer than 4", "source is null",
                                                       "symbol longer than 20"]


def test_partitioned_write_prunes(spark, tmp_path):
    df = spark.range(0, 5).select((F.col("id") * 86_400_000).alias("window_start_ms"),
                                  F.lit("BTCUSD").alias("symbol"), F.lit("BINANCE").alias("source"))
    path = str(tmp_path / "t")
    TB.write_partitioned(df, path, "window_start_ms")
    q = TB.scan_filtered(spark, path, "window_start_ms", symbol="BTCUSD", t_from=86_400_000,
                         t_to=2 * 86_400_000)
    assert sorted(r.window_start_ms for r in q.collect()) == [86_400_000, 172_800_000]
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(d" in plan and "PushedFilters" in plan


def test_day_tables_insert_ignore_and_retention(spark, tmp_path):
    from tickbars.operators.trades import TRADE_KEY, TRADE_TABLE_COLUMNS

    day = TB.DAY_MS
    cols = "trade_time_ms long, symbol string, source string, trade_id long, price double, quantity double, " \
           "side string, ingestion_time_ms long, latency_ms long, arrival long"
    batch = spark.createDataFrame([(t, "A", "X", i, 1.0, 1.0, "BUY", t, 0, i)
                                   for i, t in enumerate([10, 20, day + 5, 3 * day + 1])], cols)
    path = str(tmp_path / "trades")
    for _ in range(2):  # the second run is a replay: nothing is added
        TB.insert_ignore_days(spark, batch, path, "trade_time_ms", TRADE_KEY, TRADE_TABLE_COLUMNS)
    assert spark.read.parquet(path).count() == 4
    dropped = TB.drop_expired_days(spark, path, keep_ms=day, as_of_ms=3 * day + 10)
    assert dropped == [0, 1]
    assert sorted(r.trade_time_ms for r in spark.read.parquet(path).collect()) == [3 * day + 1]


def test_jdbc_statements():
    from tickbars.sources import jdbc

    up = jdbc.upsert_statement("ohlcv", "s1", TB.BAR_KEY, TB.BAR_TABLE_COLUMNS, TB.ON_CONFLICT_UPDATE)
    assert up.endswith("ON CONFLICT (symbol, source, window_start_ms) DO UPDATE SET "
                       "spread_usd = EXCLUDED.spread_usd, spread_bps = EXCLUDED.spread_bps")
    ig = jdbc.insert_ignore_statement("trades", "s2", ["symbol", "source", "trade_id", "trade_time_ms"],
                                      ["trade_time_ms", "symbol"])
    assert ig == ("INSERT INTO trades (trade_time_ms, symbol) SELECT trade_time_ms, symbol FROM s2 "
                  "ON CONFLICT (symbol, source, trade_id, trade_time_ms) DO NOTHING")


def test_upsert_survives_a_stop_at_any_step(spark, monkeypatch):
    """Stop the sink at each file-system step, replay, and find the same table."""
    from tickbars import session as S
    from tickbars.operators import tables as TB

    def bars(rows):
        cols = ["symbol", "source", "window_start_ms"]
        df = spark.createDataFrame(rows, "symbol string, source string, window_start_ms long, spread_usd double")
        return df.select(*cols, *[F.lit(1.0).alias(c) for c in TB.BAR_TABLE_COLUMNS[3:12]], F.lit(1).alias("trade_count"),
                         "spread_usd", F.lit(0.5).alias("spread_bps"))

    day = TB.DAY_MS
    first = bars([("A", "X", 0, 1.0), ("B", "X", 0, 1.0), ("A", "X", day, 1.0)])
    second = bars([("A", "X", 0, 2.0), ("C", "X", day, 2.0)])
    want = {("A", 0, 2.0), ("B", 0, 1.0), ("A", day, 1.0), ("C", day, 2.0)}
    renamed = TB._renamed
    for stop in range(5):
        table = S.fresh_path(spark, "crash")
        TB.upsert_days(spark, first, table, "window_start_ms")
        left = [stop]

        def breaking(fs, src, dst):
            if left[0] == 0:
                raise OSError("stopped")
            left[0] -= 1
            renamed(fs, src, dst)

        monkeypatch.setattr(TB, "_renamed", breaking)
        try:
            TB.upsert_days(spark, second, table, "window_start_ms")
        except OSError:
            pass
        monkeypatch.setattr(TB, "_renamed", renamed)
        TB.upsert_days(spark, second, table, "window_start_ms")
        got = {(r.symbol, r.window_start_ms, r.spread_usd) for r in spark.read.parquet(table).collect()}
        assert got == want, stop


TRADE_COLS = "trade_time_ms long, symbol string, source string, trade_id long, price double, quantity double, " \
             "side string, ingestion_time_ms long, latency_ms long, arrival long"


def _trade_batch(spark, items):
    return spark.createDataFrame([(t, "A", "X", i, p, 1.0, "BUY", t, 0, n) for n, (t, i, p) in enumerate(items)], TRADE_COLS)


def _insert(spark, batch, path):
    from tickbars.operators.trades import TRADE_KEY, TRADE_TABLE_COLUMNS

    TB.insert_ignore_days(spark, batch, path, "trade_time_ms", TRADE_KEY, TRADE_TABLE_COLUMNS)


def test_insert_ignore_touches_only_the_hours_of_the_batch(spark, tmp_path):
    """Redeliveries in later batches change nothing, and the other hours are not
    even opened (one of them holds a broken file)."""
    h, path = TB.HOUR_MS, str(tmp_path / "trades")
    _insert(spark, _trade_batch(spark, [(5, 1, 1.0), (h + 5, 2, 2.0), (-5, 4, 4.0)]), path)
    (tmp_path / "trades" / "d=0" / "h=9").mkdir()
    (tmp_path / "trades" / "d=0" / "h=9" / "part-broken.parquet").write_bytes(b"not parquet")
    _insert(spark, _trade_batch(spark, [(h + 5, 2, 9.0), (h + 6, 3, 3.0), (h + 6, 3, 8.0), (-5, 4, 9.0)]), path)
    (tmp_path / "trades" / "d=0" / "h=9" / "part-broken.parquet").unlink()
    got = sorted((r.trade_id, r.price) for r in spark.read.parquet(path).collect())
    assert got == [(1, 1.0), (2, 2.0), (3, 3.0), (4, 4.0)]
    old = TB.read_hours(spark, path, [1], spark.read.parquet(path).schema)
    assert {f.split("/h=")[1].split("/")[0] for f in old.inputFiles()} == {"1"}
    _insert(spark, _trade_batch(spark, []), path)
    assert spark.read.parquet(path).count() == 4


def test_compaction_survives_a_stop_at_any_step(spark, tmp_path, monkeypatch):
    renamed = TB._renamed
    for stop in range(3):
        path = str(tmp_path / f"trades{stop}")
        for i in range(4):
            _insert(spark, _trade_batch(spark, [(i, i, 1.0), (TB.HOUR_MS + i, 10 + i, 2.0)]), path)
        left = [stop]

        def breaking(fs, src, dst):
            if left[0] == 0:
                raise OSError("stopped")
            left[0] -= 1
            renamed(fs, src, dst)

        monkeypatch.setattr(TB, "_renamed", breaking)
        try:
            TB.compact_hours(spark, path, [0])
        except OSError:
            pass
        monkeypatch.setattr(TB, "_renamed", renamed)
        TB.compact_hours(spark, path, [0, 7])
        rows = spark.read.parquet(path)
        assert sorted(r.trade_id for r in rows.collect()) == [0, 1, 2, 3, 10, 11, 12, 13], stop
        files = [f for f in rows.inputFiles() if "/h=0/" in f]
        assert len(files) == 1 and len(rows.inputFiles()) == 5
        assert TB.compact_hours(spark, path, [0]) == []


def test_newest_rows_opens_the_newest_days_only(spark, tmp_path):
    day = TB.DAY_MS
    df = spark.createDataFrame([(d * day + i, f"S{i}") for d in range(6) for i in range(3)], "window_start_ms long, symbol string")
    path = str(tmp_path / "bars")
    TB.write_partitioned(df, path, "window_start_ms")
    order = [F.desc("window_start_ms")]
    for n, days in ((1, {"5"}), (3, {"5"}), (4, {"4", "5"}), (100, set("012345"))):
        got = TB.newest_rows(spark, path, n, order)
        want = [r.window_start_ms for r in df.orderBy(*order).limit(n).collect()]
        assert [r.window_start_ms for r in got.collect()] == want
        assert {f.split("/d=")[1].split("/")[0] for f in got.inputFiles()} == days
    where = F.col("symbol") == "S1"
    assert TB.newest_rows(spark, path, 2, order, where).count() == 2

import pytest
from pyspark.sql import functions as F

from tickbars.operators import buckets as B
from tickbars.operators import tables as TB

DAY = TB.DAY_MS


def bars(spark, rows):
    """(symbol, window start, spread) as bars; another open price per call site is the fourth value."""
    df = spark.createDataFrame([(*r, 1.0)[:4] for r in rows], "symbol string, window_start_ms long, spread_usd double, open double")
    fixed = {"source": F.lit("X"), "trade_count": F.lit(1), "spread_bps": F.lit(0.5)}
    return df.select(*[F.col(c) if c in df.columns else fixed.get(c, F.lit(2.0)).alias(c) for c in TB.BAR_TABLE_COLUMNS])


def upsert(spark, df, table, **kw):
    return B.upsert_buckets(spark, df.persist(), table, "window_start_ms", **kw)


def rows(spark, df, table, days=None):
    got = B.read_buckets(spark, table, df.schema, days).select("symbol", "window_start_ms", "spread_usd", "open").collect()
    assert len(got) == len(set(got))
    return {tuple(r) for r in got}


def test_an_update_rewrites_one_bucket(spark, tmp_path):
    table = f"{tmp_path}/t"
    first = bars(spark, [(f"S{k}", d * DAY, 1.0) for k in range(40) for d in (0, 1)])
    assert rows(spark, first, table) == set()
    upsert(spark, first, table)
    before = {at: p.toString() for at, p in B._current(spark, table).items()}
    touched = upsert(spark, bars(spark, [("S7", DAY, 9.0, 5.0)]), table)
    after = {at: p.toString() for at, p in B._current(spark, table).items()}
    assert len(touched) == 1 and touched[0][0] == "d=1"
    assert [at for at in after if after[at] != before[at]] == touched and set(after) == set(before)
    got = rows(spark, first, table)
    # the key keeps its other columns, only the spread is new
    assert ("S7", DAY, 9.0, 1.0) in got and len(got) == 80
    assert got == {tuple(r) for r in spark.read.parquet(table).select("symbol", "window_start_ms", "spread_usd", "open").collect()}
    # the buckets not touched are not read: one of them is broken now
    other = next(at for at in after if at != touched[0])
    for f in (tmp_path / "t" / other[0] / after[other].rsplit("/", 1)[1]).glob("*.parquet"):
        f.write_bytes(b"broken")
    upsert(spark, bars(spark, [("S7", DAY, 10.0)]), table)


def test_files_are_whole_buckets_and_days_are_pruned(spark, tmp_path):
    table = f"{tmp_path}/t"
    for k in range(6):
        upsert(spark, bars(spark, [(f"S{k}", 0, 1.0), (f"S{k}", 3 * DAY, 1.0)]), table, buckets=1)
    files = [p for p in (tmp_path / "t").rglob("*.parquet")]
    assert len(files) == 2  # one for each day, however many batches
    df = bars(spark, [("S0", 0, 1.0)])
    assert {r[1] for r in rows(spark, df, table, [3, 8])} == {3 * DAY} and rows(spark, df, table, [5]) == set()
    upsert(spark, bars(spark, [(f"T{k}", 0, 1.0) for k in range(10)]), table, buckets=1, rows_per_file=4)
    assert len(list((tmp_path / "t" / "d=0").rglob("*.parquet"))) == 4
    with pytest.raises(ValueError):
        upsert(spark, df, table, buckets=2)
    assert upsert(spark, df.filter("false"), table, buckets=1) == []


def test_a_stop_at_any_step_shows_the_old_or_the_new_table(spark, tmp_path, monkeypatch):
    first = bars(spark, [("A", 0, 1.0), ("B", 0, 1.0), ("A", DAY, 1.0)])
    second = bars(spark, [("A", 0, 2.0, 7.0), ("C", DAY, 2.0)])
    old = {("A", 0, 1.0, 1.0), ("B", 0, 1.0, 1.0), ("A", DAY, 1.0, 1.0)}
    new = {("A", 0, 2.0, 1.0), ("B", 0, 1.0, 1.0), ("A", DAY, 1.0, 1.0), ("C", DAY, 2.0, 1.0)}
    seen = set()
    for step in ("writing", "written", "commit", "recover"):
        table = f"{tmp_path}/{step}"
        upsert(spark, first, table, buckets=2)
        mark, recover, calls = B._mark, B.recover_buckets, []

        def stop_mark(spark, table, kind, version, lines=()):
            if (step, kind) == ("written", "commit"):
                raise OSError("stopped")
            mark(spark, table, kind, version, lines)
            if step == kind:
                raise OSError("stopped")

        def stop_recover(spark, table):
            calls.append(1)
            if step == "recover" and len(calls) == 2:
                raise OSError("stopped")
            recover(spark, table)

        monkeypatch.setattr(B, "_mark", stop_mark)
        monkeypatch.setattr(B, "recover_buckets", stop_recover)
        with pytest.raises(OSError):
            upsert(spark, second, table, buckets=2)
        monkeypatch.setattr(B, "_mark", mark)
        monkeypatch.setattr(B, "recover_buckets", recover)
        got = rows(spark, first, table)
        assert got == (old if step in ("writing", "written") else new)
        seen.add(frozenset(got))
        for _ in range(2):  # the batch again, and once more
            upsert(spark, second, table, buckets=2)
            assert rows(spark, first, table) == new
        assert spark.read.parquet(table).count() == len(new)
    assert len(seen) == 2

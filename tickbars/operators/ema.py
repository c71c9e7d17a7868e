"""EMA-N over consecutive bars per (symbol, source) (O-70).

ema_0 = x_0 and ema_n = a*x_n + w*ema_{n-1}, a = 2/(N+1), w = 1-a; gaps in
time are not filled: the recurrence runs over the bars that exist.

Each bar is the affine map y -> A*y + B with (A, B) = (w, a*x) and, for the
key's first bar, (0, x) (it ignores any earlier state).  ema_n is the B of
the composition of maps 0..n.  The composition is associative, so it is
evaluated as a parallel prefix scan by doubling: step s composes every
row's map with the map 2^s rows earlier (``lag`` over the key, ordered by
time).  After S steps a row holds the composition of its last 2^S bars, whose
A part is w^(2^S).  S is the first depth at which w^(2^S) underflows to
exactly 0.0 in IEEE doubles, so nothing earlier can change any result: the
scan equals the full-history fold (to floating-point rounding), for any
number of bars, with S = 12 passes for N = 10.

All work is built-in column arithmetic and ``lag`` windows (JVM, no Python).

Two layouts:
* ``ema``: the window partition is one (symbol, source) key -- bounded by
  the time span (one bar per interval), not by the trade volume;
* ``ema_chunked``: the key's bars are cut into time chunks of at most
  ``chunk`` bars; inside a chunk the prefix maps are one scaled running sum
  (``a w^j sum w^-i x_i``; used when w^-chunk stays far inside double range,
  2,048 bars for N = 10) or else the doubling scan (exact, the chunk is
  shorter than 2^S); each chunk's total map is folded directly from its
  values (a bounded ``collect_list``); the totals of earlier chunks are
  folded per key on that small table, and the carry is joined back.  No task holds more than one chunk of a key.  It
  reads its input twice, so give it a written table (session.materialize),
  not a lineage that would re-run upstream work.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Smallest positive subnormal double is about e^-744.4.
_UNDERFLOW_LOG = 745.2


def doubling_depth(period: int) -> int:
    """Number of doubling steps after which w^(2^S) == 0.0 in doubles."""
    w = 1.0 - 2.0 / (period + 1)
    steps = max(1, math.ceil(math.log2(_UNDERFLOW_LOG / -math.log(w))))
    assert w ** (2 ** steps) == 0.0
    return steps


def ema(
    bars: DataFrame,
    period: int = 10,
    value: str = "close",
    keys: tuple[str, ...] = ("symbol", "source"),
    order: str = "window_start_ms",
    out: str | None = None,
) -> DataFrame:
    """One window per key, by doubling: the plain form that tests compare the
    chunked one with.  A key is one task here; jobs use the chunked form."""
    out = out or f"ema{period}"
    a = 2.0 / (period + 1)
    w = 1.0 - a
    by_key = Window.partitionBy(*keys).orderBy(order)
    first = F.lag(F.col(order), 1).over(by_key).isNull()
    df = bars.withColumn("_A", F.when(first, F.lit(0.0)).otherwise(F.lit(w))) \
             .withColumn("_B", F.when(first, F.col(value)).otherwise(F.lit(a) * F.col(value)))
    for s in range(doubling_depth(period)):
        d = 2 ** s
        pa = F.lag("_A", d).over(by_key)
        pb = F.lag("_B", d).over(by_key)
        # earlier map first, then this row's: y -> A*(pa*y + pb) + B
        df = df.select(
            *[c for c in df.columns if c not in ("_A", "_B")],
            F.when(pa.isNull(), F.col("_A")).otherwise(F.col("_A") * pa).alias("_A"),
            F.when(pb.isNull(), F.col("_B")).otherwise(F.col("_A") * pb + F.col("_B")).alias("_B"),
        )
    return df.withColumnRenamed("_B", out).drop("_A")


def _doubling(df, by, steps: int, a: float, w: float, value: str, seed_first: bool):
    """Prefix composition of the per-row affine maps over window ``by``."""
    first = F.lag(F.lit(1), 1).over(by).isNull()
    if seed_first:
        A0 = F.when(first, F.lit(0.0)).otherwise(F.lit(w))
        B0 = F.when(first, F.col(value)).otherwise(F.lit(a) * F.col(value))
    else:
        A0, B0 = F.lit(w), F.lit(a) * F.col(value)
    df = df.withColumn("_A", A0).withColumn("_B", B0)
    for s in range(steps):
        d = 2 ** s
        pa, pb = F.lag("_A", d).over(by), F.lag("_B", d).over(by)
        df = df.select(
            *[c for c in df.columns if c not in ("_A", "_B")],
            F.when(pa.isNull(), F.col("_A")).otherwise(F.col("_A") * pa).alias("_A"),
            F.when(pb.isNull(), F.col("_B")).otherwise(F.col("_A") * pb + F.col("_B")).alias("_B"),
        )
    return df


# Largest exponent for which w^-j times a price stays far inside double
# range (e^600 ~ 1e260).
_SCALED_LOG = 600.0


def scaled_chunk_limit(period: int) -> int:
    """Longest chunk (a power of two) whose in-chunk EMA may use the scaled
    running sum: w^-(chunk-1) <= e^600."""
    w = 1.0 - 2.0 / (period + 1)
    return 2 ** math.floor(math.log2(_SCALED_LOG / -math.log(w)))


def _scaled(df, by, a: float, w: float, value: str):
    """In-chunk prefix maps in one pass: for the j-th row (from 0) the
    composition of the chunk's maps is (w^(j+1), a w^j sum_{i<=j} w^-i x_i)."""
    running = by.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = df.withColumn("_j", F.row_number().over(by) - 1)
    df = df.withColumn("_S", F.sum(F.col(value) * F.pow(F.lit(w), -F.col("_j"))).over(running))
    return (df.withColumn("_A", F.pow(F.lit(w), F.col("_j") + 1))
              .withColumn("_B", F.lit(a) * F.pow(F.lit(w), F.col("_j")) * F.col("_S"))
              .drop("_j", "_S"))


def chunk_of(order: str, step_ms: int, chunk: int):
    """Time chunk of a bar: ``chunk`` intervals, so at most ``chunk`` bars per key."""
    return F.floor(F.col(order) / F.lit(step_ms * chunk)).cast("bigint")


def chunk_carries(tot: DataFrame, keys: list[str], chunk_col: str, group: int) -> DataFrame:
    """(keys, chunk, _carry): the state entering each chunk -- the key's first
    value, so that its first bar's EMA is its close, pushed through every earlier
    chunk's total map ``_t`` in order.

    Two levels: the maps of ``group`` chunks are folded inside one row, and only
    the groups' maps are listed per key (with 2,048 one-minute bars a chunk and
    512 chunks a group, one map in two years)."""
    step = lambda x, e: e["_t"]["_A"] * x + e["_t"]["_B"]
    ident = F.struct(F.lit(1.0).alias("_A"), F.lit(0.0).alias("_B"))
    g = tot.groupBy(*keys, F.floor(F.col(chunk_col) / F.lit(group)).alias("_g")).agg(
        F.array_sort(F.collect_list(F.struct(F.col(chunk_col).alias("c"), "_t", "_x_first"))).alias("_m"))
    g = g.withColumn("_gt", F.aggregate("_m", ident, lambda acc, e: F.struct(
        (e["_t"]["_A"] * acc["_A"]).alias("_A"), (e["_t"]["_A"] * acc["_B"] + e["_t"]["_B"]).alias("_B"))))
    by_group = Window.partitionBy(*keys).orderBy("_g")
    g = g.withColumn("_x0", F.first(F.element_at("_m", 1)["_x_first"]).over(by_group.rowsBetween(Window.unboundedPreceding, 0))) \
         .withColumn("_prev", F.collect_list("_gt").over(by_group.rowsBetween(Window.unboundedPreceding, -1))) \
         .withColumn("_in", F.aggregate("_prev", F.col("_x0"), lambda x, t: t["_A"] * x + t["_B"]))
    # running fold inside the group: state entering its first, second, ... chunk
    g = g.withColumn("_ins", F.aggregate("_m", F.array("_in"), lambda acc, e: F.concat(
        acc, F.array(step(F.element_at(acc, -1), e)))))
    return g.select(*keys, F.posexplode("_m").alias("_i", "_e"), "_ins") \
            .select(*keys, F.col("_e.c").alias(chunk_col), F.col("_ins")[F.col("_i")].alias("_carry"))


def ema_chunked(
    bars: DataFrame,
    period: int = 10,
    value: str = "close",
    keys: tuple[str, ...] = ("symbol", "source"),
    order: str = "window_start_ms",
    step_ms: int = 60_000,
    chunk: int = 4096,
    chunk_col: str = "_chunk",
    out: str | None = None,
    partition_keys: tuple[str, ...] | None = None,
    group: int = 512,
) -> DataFrame:
    """The same EMA as ``ema``, evaluated per (key, time chunk); keeps
    ``chunk_col`` so a caller can partition later steps on it too.

    ``partition_keys`` (a prefix of ``keys``, e.g. ("symbol",)): the input is
    hash-partitioned on partition_keys + chunk.  The carries are then packed
    per (partition_keys, chunk) into a map keyed by the other key columns,
    so the join back uses exactly the input's partitioning and only the
    small carry table is shuffled."""
    out = out or f"ema{period}"
    a = 2.0 / (period + 1)
    w = 1.0 - a
    keys = list(keys)
    base = bars if chunk_col in bars.columns else bars.withColumn(chunk_col, chunk_of(order, step_ms, chunk))
    in_chunk = Window.partitionBy(*keys, chunk_col).orderBy(order)
    if chunk <= scaled_chunk_limit(period):
        x = _scaled(base, in_chunk, a, w, value)          # one running sum
    else:
        x = _doubling(base, in_chunk, max(1, math.ceil(math.log2(chunk))), a, w, value, seed_first=False)
    # One row per chunk: its total map, folded directly from the chunk's
    # values (at most ``chunk`` of them, in time order) -- this branch reads
    # only (key, time, value) and runs no windows.
    ident = F.struct(F.lit(1.0).alias("_A"), F.lit(0.0).alias("_B"))
    tot = base.groupBy(*keys, chunk_col).agg(
        F.array_sort(F.collect_list(F.struct(F.col(order).alias("t"), F.col(value).alias("v")))).alias("_xs"))
    tot = tot.select(
        *keys, chunk_col,
        F.aggregate("_xs", ident, lambda acc, e: F.struct((acc["_A"] * F.lit(w)).alias("_A"),
                                                          (acc["_B"] * F.lit(w) + F.lit(a) * e["v"]).alias("_B"))
                    ).alias("_t"),
        F.element_at("_xs", 1)["v"].alias("_x_first"))
    carry = chunk_carries(tot, keys, chunk_col, group)
    if partition_keys:
        rest = [k for k in keys if k not in partition_keys]
        # one small array per (partition keys, chunk): [(other keys, carry)],
        # looked up with null-safe equality (a null key value is a key too)
        packed = carry.groupBy(*partition_keys, chunk_col).agg(
            F.collect_list(F.struct(F.struct(*rest).alias("k"), F.col("_carry").alias("c"))).alias("_carries"))
        me = F.struct(*[F.col(r) for r in rest])
        res = x.join(packed, on=list(partition_keys) + [chunk_col], how="inner") \
            .withColumn("_carry", F.filter("_carries", lambda e: e["k"].eqNullSafe(me))[0]["c"]) \
            .drop("_carries")
    else:
        res = x.join(carry, on=keys + [chunk_col], how="inner")
    return res.withColumn(out, F.col("_A") * F.col("_carry") + F.col("_B")).drop("_A", "_B", "_carry")

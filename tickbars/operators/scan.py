"""Running aggregates over an ordered key without one task per key.

A running sum/max/min over all rows of a key, in order, is a prefix scan.
A window partitioned by the key alone would sort the whole key in one task,
which breaks down when one key (a hot symbol, a busy topic partition) holds
a large share of the rows.  Here rows are cut into chunks of the ordering
(e.g. seq div 65536):

1. within (key, chunk) a window gives the chunk-local running value;
2. one row per (key, chunk) holds the chunk total; an exclusive running
   aggregate over the chunks of a key gives the carry into each chunk
   (rows / chunk_size rows: small, adaptive execution broadcasts it);
3. carry and local value combine.

The result is exact (sum/max/min are associative) for any key size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_AGG = {"sum": F.sum, "max": F.max, "min": F.min}


def _safe_keys(df: DataFrame, part: list[str]) -> tuple[DataFrame, list[str]]:
    """Key columns on which a null value is a key value too: each key k
    becomes (coalesce(k, default), isnull(k)), so the equi-joins below keep
    rows whose key is null and still reuse the window's partitioning."""
    cols = []
    for k in part:
        dtype = df.schema[k].dataType.simpleString()
        default = F.lit("").cast(dtype) if dtype == "string" else F.lit(0).cast(dtype)
        df = df.withColumn(f"_nk_{k}", F.coalesce(F.col(k), default)) \
               .withColumn(f"_ni_{k}", F.col(k).isNull())
        cols += [f"_nk_{k}", f"_ni_{k}"]
    return df, cols


def _combine(how: str, a: Column, b: Column) -> Column:
    if how == "sum":
        return F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))
    if how == "max":
        return F.greatest(a, b)
    return F.least(a, b)


def chunked_running(
    df: DataFrame,
    part: list[str],
    order: list[str],
    value: Column,
    how: str,
    chunk: Column,
    out: str,
    exclusive: bool = False,
    reverse: bool = False,
) -> DataFrame:
    """Add ``out`` = ``how`` of ``value`` over the rows of ``part`` before
    (``reverse``: after) each row in ``order``; ``exclusive`` leaves the row
    itself out.  ``chunk`` must be monotone in ``order``."""
    agg = _AGG[how]
    key = [F.col(c) for c in order]
    key = [k.desc() for k in key] if reverse else key
    x = df.withColumn("_chunk", chunk).withColumn("_val", value)
    x, part_cols = _safe_keys(x, part)
    part = part_cols
    upto = -1 if exclusive else 0
    local_w = Window.partitionBy(*part, "_chunk").orderBy(*key).rowsBetween(Window.unboundedPreceding, upto)
    x = x.withColumn("_local", agg("_val").over(local_w))
    chunks = x.groupBy(*part, "_chunk").agg(agg("_val").alias("_tot"))
    ch_order = F.col("_chunk").desc() if reverse else F.col("_chunk")
    before = Window.partitionBy(*part).orderBy(ch_order).rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.select(*part, "_chunk", agg("_tot").over(before).alias("_carry"))
    x = x.join(chunks, on=[*part, "_chunk"], how="left")
    return x.withColumn(out, _combine(how, F.col("_carry"), F.col("_local"))) \
            .drop("_chunk", "_val", "_local", "_carry", *part)


def chunked_scans(df: DataFrame, part: list[str], order: list[str], chunk: Column,
                  specs: list[tuple[str, Column, str, bool, bool]]) -> DataFrame:
    """Several running aggregates over the same key and order in one pass.

    ``specs``: (out, value, how, exclusive, reverse).  A forward aggregate
    uses the frame up to the row, a reverse one the frame from the row to the
    end, in the same order -- so all share one window partition
    (part, chunk), one per-chunk total table and one join, instead of one
    round trip (and one re-read of the input) each."""
    x = df.withColumn("_chunk", chunk)
    x, part = _safe_keys(x, part)
    vals = {out: f"_v{i}" for i, (out, *_r) in enumerate(specs)}
    for out, value, *_r in specs:
        x = x.withColumn(vals[out], value)
    w = Window.partitionBy(*part, "_chunk").orderBy(*[F.col(c) for c in order])
    locals_ = []
    for out, _v, how, exclusive, reverse in specs:
        if reverse:
            frame = w.rowsBetween(1 if exclusive else 0, Window.unboundedFollowing)
        else:
            frame = w.rowsBetween(Window.unboundedPreceding, -1 if exclusive else 0)
        locals_.append(_AGG[how](vals[out]).over(frame).alias(f"_l{vals[out]}"))
    x = x.select("*", *locals_)
    chunks = x.groupBy(*part, "_chunk").agg(*[_AGG[how](vals[out]).alias(f"_t{vals[out]}")
                                             for out, _v, how, _e, _r in specs])
    by_chunk = Window.partitionBy(*part).orderBy("_chunk")
    before = by_chunk.rowsBetween(Window.unboundedPreceding, -1)
    after = by_chunk.rowsBetween(1, Window.unboundedFollowing)
    chunks = chunks.select(*part, "_chunk", *[
        _AGG[how](f"_t{vals[out]}").over(after if reverse else before).alias(f"_c{vals[out]}")
        for out, _v, how, _e, reverse in specs])
    x = x.join(chunks, on=[*part, "_chunk"], how="left")
    for out, _v, how, _e, _r in specs:
        v = vals[out]
        x = x.withColumn(out, _combine(how, F.col(f"_c{v}"), F.col(f"_l{v}")))
        x = x.drop(v, f"_l{v}", f"_c{v}")
    return x.drop("_chunk", *part)

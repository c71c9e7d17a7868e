"""Connected components by alternating large-star and small-star steps.

Every step is a grouping and a join on node ids; the edge table is written to
the shared folder after each round, so a lost executor never replays the
rounds before it.  The number of rounds grows with the logarithm of the
longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickbars import session as S


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, comp) of every node with an edge; ``comp`` is the smallest node
    reachable.  Loops, repeated and null-ended edges are ignored; no edges give
    no rows."""
    ends = edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    e = S.materialize(ends.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                      .filter("u > v").distinct(), "edges")
    state = _fingerprint(e)
    while state[0]:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .filter("u > v").distinct()
        large = S.materialize(large, "edges")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .union(low.select("u", F.col("m").alias("v"))).distinct()
        e = S.materialize(small, "edges")
        now = _fingerprint(e)
        if now == state:
            break
        state = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("comp")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())


def _fingerprint(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())

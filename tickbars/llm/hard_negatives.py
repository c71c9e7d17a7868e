"""Hard-negative mining by slot-decomposed selection.

Every row of the table is scored against every anchor by the integer inner
product of the quantised vectors.  An anchor's positives are its best rows of
the same label; each positive allows a window of negative scores

    low * positive_score <= 100 * negative_score <= high * positive_score

and the best rows of another label in that window are its hard negatives.  The
windows of one anchor overlap, so they are not searched one by one:

1. one pass over the rows keeps the top positives of each anchor (a combiner
   in every task, merged by a window over the tasks' few rows);
2. the positives' upper limits, in descending order, split the scores into
   disjoint slots; a second pass keeps the top rows of another label per
   (anchor, slot), again with a combiner in every task;
3. the rows allowed by a positive's upper limit are its slot and all below it:
   a descending suffix of the slots.  Merging that suffix and cutting it at the
   lower limit answers the window, because a lower limit only cuts the tail.

A slot's top rows suffice: a row that is not among its slot's best ones is not
among the best of any suffix that holds the slot.

Anchors are taken in blocks of about ``ANCHOR_BLOCK`` rows (the only thing sent
to the tasks), so neither memory nor the driver grows with their number; a task
holds one block's top rows and one slice of scores at a time.

Defined results: a row with a null id, label or vector, or a null or non-finite
component, takes no part (nor does one whose scaled component overflows).  A
shorter vector counts as padded with zeros.  Rows that repeat an id count once,
by their best score; of an anchor's repeated rows the one with the smallest
label, then vector, is the anchor.  Ties go to the smaller id.  Scores are
exact integers, held within +-2^56.  No anchors or no positives give no rows.
Columns beside the three named ones are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickbars import session as S

POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90
#: Anchors scored in one pass over the rows: bounds what is sent to a task.
ANCHOR_BLOCK = 8192
#: Largest absolute score; 100 times it is still a long.
SCORE_LIMIT = 1 << 56
#: Rows scored together, at first and at most: the first slices fill the top rows, later ones mostly miss them.
FIRST_SLICE, LAST_SLICE = 64, 1024


def quantised(lists: pa.Array, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """(n x width matrix of floor(scale * x), rows that take part)."""
    n = len(lists)
    ok = lists.is_valid().to_numpy(zero_copy_only=False)
    offsets = lists.offsets.to_numpy()
    lens = np.where(ok, np.diff(offsets), 0)
    values = lists.values.cast(pa.float64()).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(n), lens)
    place = np.arange(len(row)) - np.repeat(np.cumsum(lens) - lens, lens)
    with np.errstate(over="ignore", invalid="ignore"):
        x = np.floor(values[offsets[:-1][row] + place] * scale)
    ok[row[~np.isfinite(x)]] = False
    out = np.zeros((n, int(lens.max(initial=0))))
    out[row, place] = np.where(np.isfinite(x), x, 0)
    return out, ok


def scores(rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Exact integer inner products, rows x anchors, in the narrowest type that holds them."""
    width = min(rows.shape[1], anchors.shape[1])
    a, b = rows[:, :width], anchors[:, :width]
    most = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(width, 1)
    if most < 1 << 24:
        return a.astype(np.float32) @ b.astype(np.float32).T
    if most < 1 << 53:
        return a @ b.T
    whole = np.frompyfunc(int, 1, 1)
    exact = whole(a).astype(object) @ whole(b).astype(object).T
    return np.clip(exact, -SCORE_LIMIT, SCORE_LIMIT).astype(np.int64)


class TopRows:
    """The best ``k`` rows per group seen so far, each id once."""

    def __init__(self, groups: int, k: int):
        self.k = k
        self.group, self.id, self.score = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.least = np.full(groups, -SCORE_LIMIT - 1, np.int64)

    def add(self, group: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        if not len(group):
            return
        g, i = np.concatenate([self.group, group]), np.concatenate([self.id, ids])
        s = np.concatenate([self.score, score.astype(np.int64)])
        order = np.lexsort((-s, i, g))
        g, i, s = g[order], i[order], s[order]
        once = np.r_[True, (g[1:] != g[:-1]) | (i[1:] != i[:-1])]
        g, i, s = g[once], i[once], s[once]
        order = np.lexsort((i, -s, g))
        g, i, s = g[order], i[order], s[order]
        rank = np.arange(len(g)) - np.searchsorted(g, g)
        keep = rank < self.k
        self.group, self.id, self.score = g[keep], i[keep], s[keep]
        full = rank == self.k - 1
        self.least[g[full]] = s[full]


def _parts(batches: Iterator[pa.RecordBatch], scale: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, labels, vectors) of the rows that take part, in slices."""
    size = FIRST_SLICE
    for batch in batches:
        vec, ok = quantised(batch.column("vector"), scale)
        for c in ("id", "label"):
            ok &= batch.column(c).is_valid().to_numpy(zero_copy_only=False)
        ids, labels = (batch.column(c).fill_null(0).to_numpy()[ok] for c in ("id", "label"))
        vec, at = vec[ok], 0
        while at < len(ids):
            yield ids[at:at + size], labels[at:at + size], vec[at:at + size]
            at += size
            size = min(2 * size, LAST_SLICE)


def _table(anchor: np.ndarray, slot: np.ndarray, top: TopRows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(slot.astype(np.int32)), pa.array(top.id),
                                       pa.array(top.score)], ["anchor_id", "slot", "id", "score"])


_TOP_SCHEMA = "anchor_id long, slot int, id long, score long"


def _positives(rows: DataFrame, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, scale: float,
               k: int) -> DataFrame:
    def run(batches):
        top = TopRows(len(ids), k)
        for rid, rlabel, vec in _parts(batches, scale):
            s = scores(vec, vectors)
            r, a = np.nonzero((rlabel[:, None] == labels) & (rid[:, None] != ids) & (s >= top.least))
            top.add(a, rid[r], s[r, a])
        yield _table(ids[top.group], np.zeros(len(top.group)), top)

    return _merged(rows.mapInArrow(run, _TOP_SCHEMA), k)


def _slot_rows(rows: DataFrame, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, upper: np.ndarray,
               lower: np.ndarray, scale: float, k: int) -> DataFrame:
    """``upper``: anchors x slots, descending limits; ``lower``: least score that any window of the slot's
    suffixes allows.  An unused slot has its upper limit equal to the next one's."""
    n, width = upper.shape
    below = np.concatenate([upper[:, 1:], np.full((n, 1), -SCORE_LIMIT - 1)], axis=1)

    def run(batches):
        top = TopRows(n * width, k)
        group = np.arange(n) * width
        for rid, rlabel, vec in _parts(batches, scale):
            s = scores(vec, vectors)
            other = rlabel[:, None] != labels
            for j in range(width):
                floor = np.maximum(lower, top.least[group + j])
                r, a = np.nonzero(other & (s <= upper[:, j]) & (s > below[:, j]) & (s >= floor))
                top.add(group[a] + j, rid[r], s[r, a])
        yield _table(ids[top.group // width], top.group % width, top)

    return _merged(rows.mapInArrow(run, _TOP_SCHEMA), k)


def _merged(tops: DataFrame, k: int) -> DataFrame:
    """Best ``k`` ids per (anchor, slot) over all tasks' combiners."""
    best = tops.groupBy("anchor_id", "slot", "id").agg(F.max("score").alias("score"))
    w = Window.partitionBy("anchor_id", "slot").orderBy(F.col("score").desc(), "id")
    return best.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def mine(rows: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector: str = "embedding", label: str = "label",
         scale: float = 1.0, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
         anchor_block: int = ANCHOR_BLOCK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of the rows of ``is_anchor``
    (a condition on ``rows``) against all rows.  Components are ``floor(scale * x)``."""
    spark = rows.sparkSession
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    named = [F.col(id_col).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
             F.col(vector).cast("array<double>").alias("vector")]
    part = rows.select(*named)
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x * scale) == float("inf")))
    anchors = S.materialize(
        rows.filter(is_anchor).select(*named).filter("id is not null and label is not null and vector is not null")
        .filter(~bad).groupBy("id").agg(F.min(F.struct("label", "vector")).alias("a")).select("id", "a.*"), "anchors")
    n_blocks = -(-anchors.count() // anchor_block)
    block = F.pmod(F.xxhash64("id"), F.lit(max(n_blocks, 1)))
    found: list[tuple[str, str]] = []
    for b in range(n_blocks):
        held = anchors.filter(block == b).toArrow().combine_chunks()
        if not held.num_rows:
            continue
        held = held.to_batches()[0]
        ids, labels = held.column("id").to_numpy(), held.column("label").to_numpy()
        vectors, _ = quantised(held.column("vector"), scale)
        pos = S.fresh_path(spark, "positives")
        _positives(part, ids, labels, vectors, scale, positives).write.mode("overwrite").parquet(pos)
        best = spark.read.parquet(pos).select("anchor_id", "score").toArrow()
        upper, lower = limits(ids, best.column("anchor_id").to_numpy(), best.column("score").to_numpy(),
                              positives, low, high)
        slots = S.fresh_path(spark, "slots")
        _slot_rows(part, ids, labels, vectors, upper, lower, scale, negatives).write.mode("overwrite").parquet(slots)
        found.append((pos, slots))
    if not found:
        return spark.createDataFrame([], schema)
    return _windows(spark.read.parquet(*[p for p, _ in found]), spark.read.parquet(*[s for _, s in found]),
                    negatives, low, high).select(*[c.split()[0] for c in schema.split(", ")])


def limits(ids: np.ndarray, anchor: np.ndarray, score: np.ndarray, width: int, low: int,
           high: int) -> tuple[np.ndarray, np.ndarray]:
    """Upper limits of an anchor's positives in descending order (the slots' bounds; places without a positive
    repeat the last one, or lie below every score) and the least lower limit."""
    at = np.argsort(ids)
    row = at[np.searchsorted(ids, anchor, sorter=at)]
    upper = np.full((len(ids), width), -SCORE_LIMIT - 1, np.int64)
    lower = np.full(len(ids), SCORE_LIMIT + 1, np.int64)
    order = np.lexsort((-score, row))
    place = np.arange(len(row)) - np.searchsorted(row[order], row[order])
    upper[row[order], place] = score[order] * high // 100
    np.minimum.at(lower, row, -(-score * low // 100))
    return np.minimum.accumulate(np.where(upper == -SCORE_LIMIT - 1, upper[:, :1], upper), axis=1), lower


def _windows(pos: DataFrame, slots: DataFrame, k: int, low: int, high: int) -> DataFrame:
    """Suffix merges: a positive's candidates are the rows of its slot and of all lower ones."""
    p = pos.select("anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"),
                   (F.col("rank") - 1).alias("slot"))
    s = slots.select("anchor_id", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"),
                     F.col("slot").alias("in_slot"))
    pairs = p.join(s, "anchor_id").filter(
        (F.col("in_slot") >= F.col("slot"))
        & (F.col("negative_score") * 100).between(F.col("positive_score") * low, F.col("positive_score") * high))
    best = pairs.groupBy("anchor_id", "positive_id", "positive_score", "negative_id").agg(
        F.max("negative_score").alias("negative_score"))
    w = Window.partitionBy("anchor_id", "positive_id").orderBy(F.col("negative_score").desc(), "negative_id")
    return best.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)

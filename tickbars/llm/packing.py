"""Best-fit packing by minimum bin slack.

Documents are tokenised once and cut into pieces; only piece lengths matter to
the packing, and there are at most ``capacity`` of them.  The histogram of
lengths (one row per length, whatever the input) is packed on the driver: the
longest piece left opens a bin, a subset-sum over bitsets finds the fullest
combination of available lengths for the rest, and that combination is taken
out as many times as the counts allow.  Bins are thus numbered in runs of equal
content, and a piece finds its place from its rank among the pieces of its
length.  Ranks come from per-task counts, so a length that a third of all
pieces share never meets in one task.

Defined results: a null or empty text is one piece holding only the end id;
repeated rows are packed as often as they come; a null id stays null; an empty
table gives no rows; only the id and text columns are read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickbars import session as S
from tickbars.llm.common import in_turn, only, text_bytes
from tickbars.llm.word_bpe import word_bpe

CAPACITY = 2048


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The available lengths (length -> how many) whose sum is the largest not
    above ``room``: subset sums as bits of an integer, each length offered in
    parts of 1, 2, 4, ... so that any number up to its count can be taken."""
    whole = (1 << (room + 1)) - 1
    reach, parts, before = 1, [], []
    for length in sorted((x for x in counts if x <= room and counts[x]), reverse=True):
        left, part = min(counts[length], room // length), 1
        while left:
            take = min(part, left)
            before.append(reach)
            parts.append((length, take))
            reach |= (reach << (length * take)) & whole
            left -= take
            part *= 2
        if reach >> room & 1:
            break
    at = reach.bit_length() - 1
    out: dict[int, int] = {}
    for (length, take), was in zip(reversed(parts), reversed(before)):
        if not was >> at & 1:  # the sum needs this part
            out[length] = out.get(length, 0) + take
            at -= length * take
    return out


def minimum_bin_slack(histogram: dict[int, int], capacity: int = CAPACITY):
    """Rows (length, first rank, per bin, first bin, offset): pieces of a length,
    from that rank on, fill that many places a bin.  Also the number of bins."""
    counts = {x: n for x, n in histogram.items() if n}
    used = dict.fromkeys(counts, 0)
    plan, bins = [], 0
    while counts:
        longest = max(counts)
        counts[longest] -= 1
        combo = fullest(counts, capacity - longest)
        counts[longest] += 1
        combo[longest] = combo.get(longest, 0) + 1
        times = min(counts[x] // k for x, k in combo.items())
        offset = 0
        for x in sorted(combo, reverse=True):
            plan.append((x, used[x], combo[x], bins, offset))
            offset += x * combo[x]
            used[x] += times * combo[x]
            counts[x] -= times * combo[x]
            if not counts[x]:
                del counts[x]
        bins += times
    return plan, bins


def _pieces(path: str, capacity: int):
    def run(batches):
        for batch in batches:
            ids, ends = word_bpe(path).encode(batch.column(1).to_pylist())
            starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
            row, piece, start, length, crc = [], [], [], [], []
            for k, (a, b) in enumerate(zip(starts.tolist(), ends.tolist())):
                for p, s in enumerate(range(a, b, capacity)):
                    e = min(s + capacity, b)
                    row.append(k)
                    piece.append(p)
                    start.append(s - a)
                    length.append(e - s)
                    crc.append(zlib.crc32(ids[s:e].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                 *[pa.array(x, pa.int64()) for x in (start, length, crc)]],
                ["doc_id", "piece", "start", "length", "ids_crc32"])
    return in_turn(run, "word bpe")


def pieces_of(docs: DataFrame, tokenizer: str, id_col: str, text_col: str, capacity: int) -> DataFrame:
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), text_bytes(text_col).alias("t")).mapInArrow(
        _pieces(tokenizer, capacity), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) per piece;
    ``tokenizer`` is the path of the vocabulary file."""
    pieces = S.materialize(pieces_of(docs, tokenizer, id_col, text_col, capacity)
                           .withColumn("task", F.spark_partition_id()), "pieces")
    per_task = S.materialize(pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    histogram = {r.length: r.n for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan, _ = minimum_bin_slack(histogram, capacity)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("task", "length").orderBy("doc_id", "piece")
    ranked = pieces.withColumn("rank", F.row_number().over(inside) - 1).join(bases, ["task", "length"])
    place = _placer(docs.sparkSession, plan)
    out = ranked.withColumn("p", place(F.col("length"), F.col("base") + F.col("rank")))
    return out.select("doc_id", "piece", "start", "length", "ids_crc32",
                      F.col("p.sequence_id").alias("sequence_id"), F.col("p.offset").alias("offset"))


def _placer(spark, plan):
    """UDF (length, rank) -> place.  The plan has a row per length of each kind
    of bin: its size depends on the capacity, not on the input."""
    rows = np.array(sorted(plan), np.int64).reshape(-1, 5)
    shared = spark.sparkContext.broadcast(rows)

    @F.arrow_udf("struct<sequence_id: bigint, offset: bigint>")
    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        only()
        t = shared.value
        x, r = np.asarray(length), np.asarray(rank)
        at = np.searchsorted(t[:, 0] << 40 | t[:, 1], x << 40 | r, side="right") - 1
        row = t[at] if len(at) else t[:0]
        k = r - row[:, 1]
        return pa.StructArray.from_arrays(
            [pa.array(row[:, 3] + k // np.maximum(row[:, 2], 1)),
             pa.array(row[:, 4] + k % np.maximum(row[:, 2], 1) * x)], ["sequence_id", "offset"])

    return place.asNondeterministic()

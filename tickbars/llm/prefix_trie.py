"""Conversation prefix trie by SQL ROLLUP over positional turn columns.

A conversation is laid out in blocks of ``WIDTH`` positional columns t1..tW, one
row per (conversation, block).  ``GROUP BY block, prior, ROLLUP (t1, .., tW)``
with ``grouping_id`` aggregates every prefix of every conversation together: a
group that keeps j columns is the trie node at depth block * WIDTH + j.  A long
conversation goes on in further blocks, keyed by the node that its earlier
blocks end in (``prior``), so all blocks are one grouping, however long the
longest conversation is.

A node's key is (depth, z1, z2): the exclusive or, over its turns, of two
64-bit hashes of (position, turn).  It can be computed for any prefix by a
running aggregate, and a parent's key is the node's key with its last turn
taken out again.

Sums over subtrees need no walk.  The smallest member of a node owns it, and
the nodes that a conversation owns are a tail of its own path: from depth
``first`` to its end.  So over a node's members

* distinct turns below it = the members' owned turns, but for its owner the
  turns from its own depth on;
* leaves below it = members that own a childless node at their end.

Both are plain sums in a second ROLLUP, once the first one has told every
conversation which nodes it owns.

Defined results: rows with a null conv_id belong to no conversation.  A null
role or text is empty.  Turns are ordered by turn (null first); rows of equal
turn by role, then by the text's hashes.  Repeated rows are turns of their own.
An empty table gives no rows.  Only the four named columns are read.  A turn is
known by two 64-bit hashes and its length; the text itself is never shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickbars import session as S
from tickbars.operators.scan import chunked_running

#: Positional columns of a block.
WIDTH = 8
#: Turn numbers that one window task orders together (of one conversation).
TURN_CHUNK = 1 << 12
#: Parents with more than this share of all nodes as children are at most ``1 / HOT_SHARE`` rows: they are broadcast.
HOT_SHARE = 1e-3

KEY = ["depth", "z1", "z2"]


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, h1, h2, bytes) of every turn; ``pos`` counts from 0."""
    text = F.coalesce("text", F.lit(""))
    role = F.coalesce("role", F.lit(""))
    t = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
        F.xxhash64(F.lit(1), text, role).alias("h1"), F.xxhash64(F.lit(2), role, text).alias("h2"),
        F.octet_length(text).cast("long").alias("bytes"))
    t = t.withColumn("at", F.coalesce("turn", F.lit(-(1 << 63))))
    chunk = F.floor(F.col("at") / TURN_CHUNK)
    counted = chunked_running(t, ["conv_id"], ["at", "role", "h1", "h2"], F.lit(1).cast("long"), "sum", chunk, "n")
    return counted.select("conv_id", (F.col("n") - 1).alias("pos"), "h1", "h2", "bytes")


def _zobrist(seed: int, pos: Column, h1: Column, h2: Column) -> Column:
    return F.xxhash64(F.lit(seed), pos.cast("long"), h1, h2)


def block_rows(turns: DataFrame, conv_ids: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per (conversation, block): t1..tW (null beyond the end), the key of the node before the block
    (``p1``, ``p2``), the bytes before it and of the whole conversation.  A conversation without turns has a block 0."""
    slot = F.col("pos") % width
    cols = [F.max(F.when(slot == j, F.struct("h1", "h2", "bytes"))).alias(f"t{j + 1}") for j in range(width)]
    b = turns.withColumn("block", F.floor(F.col("pos") / width).cast("long")).groupBy("conv_id", "block").agg(
        *cols, F.sum("bytes").alias("in_block"), F.count(F.lit(1)).alias("n_turns"),
        F.bit_xor(_zobrist(1, F.col("pos"), F.col("h1"), F.col("h2"))).alias("x1"),
        F.bit_xor(_zobrist(2, F.col("pos"), F.col("h1"), F.col("h2"))).alias("x2"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    b = b.select("*", *[F.coalesce(f(c).over(before), zero).alias(a) for a, c, f in (
        ("p1", "x1", F.bit_xor), ("p2", "x2", F.bit_xor), ("bytes_before", "in_block", F.sum))])
    b = b.withColumn("total", F.sum("in_block").over(Window.partitionBy("conv_id")))
    b = b.withColumn("last", F.col("block") == F.max("block").over(Window.partitionBy("conv_id")))
    none = conv_ids.join(b.select("conv_id").distinct(), "conv_id", "left_anti").select("conv_id", zero.alias("block"))
    empty = none.select("*", *[F.lit(None).cast(b.schema[f"t{j + 1}"].dataType).alias(f"t{j + 1}") for j in range(width)],
                        *[zero.alias(c) for c in ("in_block", "n_turns", "x1", "x2", "p1", "p2", "bytes_before", "total")],
                        F.lit(True).alias("last"))
    return b.unionByName(empty)


def _rollup(blocks: DataFrame, aggregates: str, width: int) -> DataFrame:
    """Node rows: key, parent's key, bytes of the last turn and of all turns before it, and the aggregates."""
    cols = [f"t{j + 1}" for j in range(width)]
    grouped = blocks.sparkSession.sql(
        f"""SELECT block, p1, p2, bytes_before, {', '.join(cols)}, grouping_id() AS gid, {aggregates}
            FROM {{blocks}} GROUP BY block, p1, p2, bytes_before, ROLLUP ({', '.join(cols)})""", blocks=blocks)
    kept = F.lit(width) - F.bit_count("gid")
    g = grouped.withColumn("kept", kept)
    last = F.element_at(F.array(*cols), F.greatest("kept", F.lit(1)))
    g = g.withColumn("last", F.when(F.col("kept") > 0, last))
    g = g.filter("(kept = 0 AND block = 0) OR last IS NOT NULL")

    def key(seed: int, prior: str, until: Column) -> Column:
        z = F.col(prior)
        for j, c in enumerate(cols):
            one = _zobrist(seed, F.col("block") * width + j, F.col(f"{c}.h1"), F.col(f"{c}.h2"))
            z = z.bitwiseXOR(F.when(F.lit(j) < until, one).otherwise(F.lit(0).cast("long")))
        return z

    inner = sum((F.when(F.lit(j + 1) < F.col("kept"), F.col(f"{c}.bytes")).otherwise(F.lit(0)) for j, c in enumerate(cols)),
                F.col("bytes_before"))
    names = grouped.columns[grouped.columns.index("gid") + 1:]
    return g.select((F.col("block") * width + F.col("kept")).alias("depth"), key(1, "p1", F.col("kept")).alias("z1"),
                    key(2, "p2", F.col("kept")).alias("z2"), key(1, "p1", F.col("kept") - 1).alias("u1"),
                    key(2, "p2", F.col("kept") - 1).alias("u2"), F.coalesce("last.bytes", F.lit(0)).alias("bytes"),
                    inner.alias("bytes_above"), *names)


def prefix_trie(turns: DataFrame, conv_ids: DataFrame, width: int = WIDTH) -> tuple[DataFrame, DataFrame]:
    """(nodes, ends) of conversations given as ``turns`` (conv_id, pos, h1, h2, bytes) and all their ``conv_ids``.

    nodes: key (depth, z1, z2), conv_id (smallest member), parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens.  ends: key and conv_id of every conversation's own node."""
    blocks = S.materialize(block_rows(turns, conv_ids, width), "trie-blocks")
    nodes = S.materialize(_rollup(blocks, "count(1) AS n_convs, min(conv_id) AS conv_id", width), "trie-nodes")
    own = S.materialize(nodes.groupBy("conv_id").agg(F.min("depth").alias("first"), F.sum("bytes").alias("owned"),
                                                     F.max("depth").alias("deepest")), "trie-owners")
    children = S.materialize(
        nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("u1").alias("z1"),
                                          F.col("u2").alias("z2")).agg(F.count(F.lit(1)).alias("n_children")), "trie-children")
    # a conversation owns a leaf if the deepest node it owns is childless
    leaf = nodes.join(own.select("conv_id", F.col("deepest").alias("depth")), ["conv_id", "depth"]) \
        .join(children, KEY, "left_anti").select("conv_id", F.lit(1).cast("long").alias("leaf"))
    zero = F.lit(0).cast("long")
    valued = blocks.join(own.select("conv_id", "owned").join(leaf, "conv_id", "left"), "conv_id", "left") \
        .withColumns({"owned": F.coalesce("owned", zero), "leaf": F.coalesce("leaf", zero)})
    sums = _rollup(valued, """count(1) AS n_convs, min(conv_id) AS conv_id, sum(total) AS total, sum(owned) AS owned,
                              sum(leaf) AS n_leaves, min_by(struct(total, owned), conv_id) AS top""", width)
    every = F.col("total") - F.col("n_convs") * F.col("bytes_above")
    distinct = F.col("owned") - F.col("top.owned") + F.col("top.total") - F.col("bytes_above")
    sums = sums.withColumn("saved_tokens", every - distinct).join(children, KEY, "left") \
        .withColumn("n_children", F.coalesce("n_children", zero))
    out = S.materialize(sums.select(*KEY, "u1", "u2", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"),
                        "trie-sums")
    ends = blocks.filter("last").select(
        (F.col("block") * width + F.col("n_turns")).alias("depth"), F.col("p1").bitwiseXOR(F.col("x1")).alias("z1"),
        F.col("p2").bitwiseXOR(F.col("x2")).alias("z2"), "conv_id")
    return _with_parents(out), ends


def _with_parents(nodes: DataFrame) -> DataFrame:
    """Adds parent_conv_id.  A node below the first one that its owner owns has its owner's node as parent; the
    others look their parent up: hot parents (a bounded number) in a broadcast table, the rest in a join."""
    spark = nodes.sparkSession
    n = nodes.count()
    parents = nodes.filter("n_children > 0").select((F.col("depth") + 1).alias("depth"), F.col("z1").alias("u1"),
                                                    F.col("z2").alias("u2"), F.col("conv_id").alias("parent_conv_id"),
                                                    "n_children")
    hot = parents.filter(F.col("n_children") > n * HOT_SHARE).drop("n_children")
    held = spark.createDataFrame(hot.toArrow()) if n else hot
    on = ["depth", "u1", "u2"]
    first = nodes.join(F.broadcast(held), on, "left")
    cold = first.filter("parent_conv_id is null").drop("parent_conv_id").join(
        parents.filter(F.col("n_children") <= n * HOT_SHARE).drop("n_children"), on, "left")
    cols = [*KEY, "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    return first.filter("parent_conv_id is not null").select(*cols).unionByName(cold.select(*cols))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (key, conv_id) rows -> comma-joined ids per key and batch."""
    for batch in batches:
        rows: list[list] = []
        for depth, z1, z2, c in zip(*[batch.column(i).to_pylist() for i in range(4)]):
            if rows and rows[-1][0] == (depth, z1, z2):
                rows[-1][2].append(str(c))
            else:
                rows.append([(depth, z1, z2), c, [str(c)]])
        if rows:
            yield pa.RecordBatch.from_arrays(
                [*[pa.array([r[0][i] for r in rows], pa.int64()) for i in range(3)],
                 pa.array([r[1] for r in rows], pa.int64()), pa.array([",".join(r[2]) for r in rows])],
                [*KEY, "least", "ids"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces -> SHA-256 of each key's ids; holds one piece at a time."""
    key, state = None, None

    def row():
        return pa.RecordBatch.from_arrays([*[pa.array([k], pa.int64()) for k in key], pa.array([state.hexdigest()])],
                                          [*KEY, "ends_sha256"])

    for batch in batches:
        done = []
        for depth, z1, z2, ids in zip(*[batch.column(c).to_pylist() for c in (*KEY, "ids")]):
            if (depth, z1, z2) == key:
                state.update(b",")
            else:
                if key:
                    done.append(row())
                key, state = (depth, z1, z2), hashlib.sha256()
            state.update(ids.encode())
        yield from done
    if key:
        yield row()


def ends_digest(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256) over the ids that end in a node, ascending and comma-joined.  A digest is one chain over
    its input, so a node's ids meet in one task at last, as a stream of pieces; they are sorted by ranges before."""
    long_key = "depth long, z1 long, z2 long"
    pieces = ends.repartitionByRange(*KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id").select(*KEY, "conv_id") \
        .mapInArrow(_pieces, f"{long_key}, least long, ids string")
    return pieces.repartition(*KEY).sortWithinPartitions(*KEY, "least").mapInArrow(_digests, f"{long_key}, ends_sha256 string")


def rebuilt_turns(turns: DataFrame, every: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations: the first h turns of conversation c - c % every, then c's own turns after its first
    h, with h = crc32(c) % most.  Returns (turns, conv_ids)."""
    ids = turns.select("conv_id").distinct().select(
        "conv_id", (F.col("conv_id") - F.col("conv_id") % every).alias("base"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).alias("h"))
    head = turns.filter(F.col("pos") < most - 1).groupBy(F.col("conv_id").alias("base")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "h1", "h2", "bytes"))).alias("head"))
    taken = ids.join(head, "base", "left").select("conv_id", "h", F.coalesce(
        F.filter("head", lambda t: t["pos"] < F.col("h")), F.array().cast(head.schema["head"].dataType)).alias("head"))
    taken = S.materialize(taken, "trie-heads")
    first = taken.select("conv_id", F.inline("head"))
    # the kept tail moves up or down by the turns that the base did not have
    tail = turns.join(taken.select("conv_id", "h", F.size("head").alias("n")), "conv_id").filter("pos >= h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("n")).alias("pos"), "h1", "h2", "bytes")
    return first.unionByName(tail), taken.select("conv_id")

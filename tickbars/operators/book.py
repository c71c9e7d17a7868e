"""Order-book reconstruction from level changes (O-40, O-41, O-73).

Input rows: (source, symbol, seq, sub, lpos, kind, side, price, quantity,
keep_zero) -- one row per level change; a message is (seq, sub); its rows
are applied in ``lpos`` order; a ``snapshot`` message first clears both
sides; a zero quantity deletes the level unless ``keep_zero``.  A message has
one ``header`` row with a null side besides its levels: messages and snapshots
are counted on header rows, so a level that was left out as bad cannot hide its
message.  Input without a ``header`` column gets header rows here, from the
first row (lpos 0) of each message.

Output: the book after every message, as rows (message, side, price, qty),
the batch equivalent of the feed handlers' TreeMaps.  Per key (source,
symbol) -- the reference shares one book across a connection's symbols,
which is the same when a connection carries one symbol.

Plan (no step puts a whole symbol into one task):
1. epoch of each row = running count of snapshot messages of its key, a
   chunked prefix scan (operators/scan.py);
2. a change's validity ends at the next change of the same (key, epoch,
   side, price) or at the key's next snapshot, whichever comes first --
   two chunked suffix scans (min of the later message positions);
3. each message gets its dense rank within the key (a chunked running
   count), and live intervals are joined to the key's messages by a
   bucketed interval join in rank space: buckets of ``bucket`` consecutive
   messages of the key, each interval listed once per bucket it overlaps,
   an equi-join on (key, bucket), then the exact range test.  Every bucket
   holds exactly ``bucket`` messages of its key, so a long-lived level of a
   sparse symbol is not listed in empty buckets, and a (key, bucket) group
   holds ``bucket`` messages and the levels alive there, whatever the
   symbol's total volume.
``book_levels_asof`` lists every live level of every message that way, since
that is its result.  The published books (``replayed_books``) do not: a
checkpoint table holds the levels alive at the start of each chunk of a key's
messages, and one ordered replay per (key, chunk) emits the best levels a side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickbars.constants import NULL_KEY
from tickbars.operators.scan import chunked_running, chunked_scans

KEYS = ["source", "symbol"]
#: Messages of a key in one chunk, and chunks in one window of the per-chunk tables.
BUCKET = 1024
CHUNKS = 4096


def _pos(seq: str = "seq", sub: str = "sub", rank: str | None = "rank") -> Column:
    """Message position; struct order is (seq, sub), rank rides along."""
    fields = [F.col(seq).alias("seq"), F.col(sub).alias("sub")]
    if rank:
        fields.append(F.col(rank).alias("rank"))
    return F.struct(*fields)


def prepare(deltas: DataFrame) -> DataFrame:
    """Fill optional columns: sub, lpos (0), keep_zero (false); side
    'bid' stays, any other non-null side is an ask."""
    d = deltas
    for c, v in (("sub", 0), ("lpos", 0)):
        if c not in d.columns:
            d = d.withColumn(c, F.lit(v).cast("bigint"))
    if "keep_zero" not in d.columns:
        d = d.withColumn("keep_zero", F.lit(False))
    side = F.when(F.col("side").isNull(), F.lit(None)).when(F.col("side") == "bid", "bid").otherwise("ask")
    # a null key value is a key too: carried as NULL_KEY through the joins
    d = d.withColumns({k: F.coalesce(F.col(k), F.lit(NULL_KEY)) for k in KEYS if k in d.columns})
    d = d.withColumn("side", side)
    if "header" not in d.columns:
        row = F.struct(*[F.col(c) for c in d.columns], F.lit(False).alias("header"))
        head = row.withField("header", F.lit(True)).withField("lpos", F.lit(-1).cast("bigint")) \
            .withField("side", F.lit(None).cast("string"))
        d = d.select(F.explode(F.when(F.col("lpos") == 0, F.array(head, row)).otherwise(F.array(row))).alias("r")).select("r.*")
    return d.filter(F.col("header") | F.col("side").isNotNull())


def _restore_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.withColumns({k: F.when(F.col(k) != NULL_KEY, F.col(k)) for k in keys})


def _scanned(deltas: DataFrame, keys: list[str], chunk: int) -> DataFrame:
    """Prepared rows with ``rank`` (1-based message number within the key) and
    ``epoch`` (snapshots so far), both from one chunked pass over the key."""
    d = prepare(deltas)
    first_row = F.col("header")
    return chunked_scans(d, keys, ["seq", "sub", "lpos"], F.floor(F.col("seq") / F.lit(chunk)), [
        ("rank", F.when(first_row, 1).otherwise(0), "sum", False, False),
        ("epoch", F.when(first_row & (F.col("kind") == "snapshot"), 1).otherwise(0), "sum", False, False),
    ])


def live_intervals(scanned: DataFrame, keys: list[str] = KEYS, chunk: int = 1 << 16) -> DataFrame:
    """Each level change with its validity [start, end) in message order;
    ``end`` null means open to the end of the stream.  The end is the next
    change of the same level in the epoch (a chunked suffix scan) or the
    start of the next epoch (a small table: one row per snapshot message)."""
    order = ["seq", "sub", "lpos"]
    ch = F.floor(F.col("seq") / F.lit(chunk))
    starts = scanned.filter(F.col("header") & (F.col("kind") == "snapshot")) \
        .select(*keys, (F.col("epoch") - 1).alias("epoch"), _pos().alias("_next_epoch"))
    v = scanned.filter(F.col("side").isNotNull())
    v = chunked_running(v, keys + ["epoch", "side", "price"], order, _pos(), "min", ch, "_next_change",
                        exclusive=True, reverse=True)
    v = v.join(starts, on=keys + ["epoch"], how="left")
    end = F.least(F.col("_next_change"), F.col("_next_epoch"))
    deleted = (F.col("quantity") == 0) & ~F.col("keep_zero")
    return v.select(*keys, "epoch", "side", "price", "quantity", _pos().alias("start"), end.alias("end"),
                    deleted.alias("deleted"))


def book_levels_asof(deltas: DataFrame, keys: list[str] = KEYS, chunk: int = 1 << 16,
                     bucket: int = 1024, write_ranked: bool = True) -> DataFrame:
    """(key, seq, sub, side, price, quantity): every level alive after each message.

    ``write_ranked``: the ranked level changes are used three times (epoch
    starts, validity intervals, message list); writing them once to the
    shared folder lets each use read that table instead of re-running the
    scan."""
    ranked = _scanned(deltas, keys, chunk)
    if write_ranked:
        from tickbars.session import materialize
        ranked = materialize(ranked, "book-ranked")
    live = live_intervals(ranked, keys, chunk).filter(
        ~F.col("deleted") & (F.col("end").isNull() | (F.col("start") < F.col("end"))))
    msgs = ranked.filter("header").select(*keys, "seq", "sub", "rank")
    last = msgs.groupBy(*keys).agg(F.max("rank").alias("_last_rank"))  # one row per key
    live = live.join(last, on=keys, how="inner")
    b = F.lit(bucket)
    first_b = F.floor((F.col("start.rank") - 1) / b)
    # last message covered: the one before `end`, or the key's last message
    last_b = F.floor((F.coalesce(F.col("end.rank") - 1, F.col("_last_rank")) - 1) / b)
    spans = live.withColumn("_b", F.explode(F.sequence(first_b, last_b))).drop("_last_rank")
    m = msgs.withColumn("_b", F.floor((F.col("rank") - 1) / b))
    j = spans.join(m, on=keys + ["_b"], how="inner")
    r = F.col("rank")
    j = j.filter((r >= F.col("start.rank")) & (F.col("end").isNull() | (r < F.col("end.rank"))))
    return _restore_keys(j.select(*keys, "seq", "sub", "side", "price", "quantity"), keys)


def top_levels(levels: DataFrame, depth: int = 20, keys: list[str] = KEYS) -> DataFrame:
    """Best ``depth`` levels per message and side: bids by price descending,
    asks ascending; ``level`` 1 is the best."""
    w = Window.partitionBy(*keys, "seq", "sub", "side").orderBy(
        F.when(F.col("side") == "bid", -F.col("price")).otherwise(F.col("price")))
    return levels.withColumn("level", F.row_number().over(w).cast("int")).filter(F.col("level") <= depth)


def snapshots(top: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Top levels -> one book row per message that has a level, with bids/asks
    arrays.  Groups hold at most 2 x depth rows."""
    lv = F.struct(F.col("level"), F.col("price"), F.col("quantity"))
    g = top.groupBy(*keys, "seq", "sub").agg(
        F.array_sort(F.collect_list(F.when(F.col("side") == "bid", lv))).alias("_b"),
        F.array_sort(F.collect_list(F.when(F.col("side") == "ask", lv))).alias("_a"))
    strip = lambda c: F.transform(c, lambda x: F.struct(x["price"].alias("price"),
                                                        x["quantity"].alias("quantity")))
    return g.select(*keys, "seq", "sub", strip("_b").alias("bids"), strip("_a").alias("asks"))


def chunk_start_books(ranked: DataFrame, keys: list[str] = KEYS, bucket: int = BUCKET) -> DataFrame:
    """The checkpoint table: (key, _chunk, side, price, quantity), every level
    alive before the first message of each chunk of ``bucket`` messages.

    Only the last change of a level in a chunk reaches later chunk starts.  It is
    alive at each of them up to the chunk that changes the level next, as long as
    no snapshot lies between; a chunk with a snapshot passes on only what follows
    its last one.  ``ranked`` carries ``_chunk``."""
    ends = ranked.filter("header").groupBy(*keys, "_chunk").agg(F.max("epoch").alias("_epoch"))
    # one row per (key, chunk) from here: the last chunk start that the epoch reaches
    again = chunked_scans(ends.withColumn("_c", F.col("_chunk")).drop("_chunk"), keys, ["_c"],
                          F.floor(F.col("_c") / F.lit(CHUNKS)), [("_last", F.col("_c"), "max", False, True)])
    per_epoch = again.groupBy(*keys, "_epoch").agg(F.max("_c").alias("_held"), F.max("_last").alias("_last"))
    reach = again.drop("_last").join(per_epoch, on=[*keys, "_epoch"], how="left") \
        .select(*keys, F.col("_c").alias("_chunk"), "_epoch", F.least(F.col("_held") + 1, F.col("_last")).alias("_reach"))
    order = F.struct("rank", "lpos")
    last = ranked.filter(F.col("side").isNotNull() & F.col("price").isNotNull() & ~F.isnan("price")) \
        .groupBy(*keys, "_chunk", "side", "price") \
        .agg(F.max_by(F.struct("epoch", "quantity", "keep_zero"), order).alias("v"))
    last = chunked_running(last.withColumnRenamed("_chunk", "_c"), [*keys, "side", "price"], ["_c"], F.col("_c"), "min",
                           F.floor(F.col("_c") / F.lit(CHUNKS)), "_next", exclusive=True, reverse=True)
    gone = F.col("v.quantity").isNull() | F.isnan("v.quantity") | ((F.col("v.quantity") == 0) & ~F.col("v.keep_zero"))
    live = last.filter(~gone).withColumnRenamed("_c", "_chunk").join(reach, on=[*keys, "_chunk"]) \
        .filter(F.col("v.epoch") == F.col("_epoch")) \
        .withColumns({"_from": F.col("_chunk") + 1, "_to": F.least(F.col("_next"), F.col("_reach"))}) \
        .filter(F.col("_from") <= F.col("_to"))
    return live.select(*keys, F.explode(F.sequence("_from", "_to")).alias("_chunk"), "side", "price",
                       F.col("v.quantity").alias("quantity"))


def replayed_books(deltas: DataFrame, depth: int = 20, keys: list[str] = KEYS, chunk: int = 1 << 16,
                   bucket: int = BUCKET) -> DataFrame:
    """The published book after every message: (keys, seq, sub, timestamp_ms,
    bids, asks), the best ``depth`` levels a side, empty books included.

    Every key's messages are cut into chunks of ``bucket``; a group (key, chunk)
    is its messages' rows and the book at its start, replayed in order.  Level
    rows are shuffled by (key, chunk) or (key, chunk, level), never by the key
    alone, and a message gives at most 2 x ``depth`` levels.  A level with a null
    or NaN price is left out, one with a null or NaN quantity is not in the book;
    a message without a time has a null one."""
    from tickbars.operators.replay import LEVEL_COLUMNS, replay_chunk
    from tickbars.session import materialize

    d = deltas if "timestamp_ms" in deltas.columns else deltas.withColumn("timestamp_ms", F.lit(None).cast("long"))
    ranked = _scanned(d, keys, chunk).withColumn("_chunk", F.floor((F.col("rank") - 1) / F.lit(bucket)))
    cols = [*keys, "_chunk", "rank", "lpos", "header", "kind", "side", "price", "quantity", "keep_zero", "seq", "sub",
            "timestamp_ms"]
    ranked = materialize(ranked.select(*cols, "epoch"), "book-ranked")
    none = {c: F.lit(None).cast(ranked.schema[c].dataType) for c in ("kind", "keep_zero", "seq", "sub", "timestamp_ms")}
    at_start = chunk_start_books(ranked, keys, bucket).withColumns(
        {**none, "rank": F.lit(0).cast(ranked.schema["rank"].dataType), "lpos": F.lit(0).cast("bigint"), "header": F.lit(False)})
    schema = ", ".join([f"{k} string" for k in keys] + ["seq long, sub long, timestamp_ms long"]
                       + [f"{c} array<double>" for c in LEVEL_COLUMNS])
    out = ranked.select(*cols).unionByName(at_start.select(*cols)).groupBy(*keys, "_chunk") \
        .applyInArrow(replay_chunk(depth, keys), schema)
    return _restore_keys(with_sides(out), keys)


def with_sides(books: DataFrame) -> DataFrame:
    """Parallel price and quantity arrays -> bids and asks as arrays of structs."""
    def side(name: str) -> Column:
        return F.arrays_zip(F.col(f"{name}_price").alias("price"), F.col(f"{name}_quantity").alias("quantity")) \
            .cast("array<struct<price:double,quantity:double>>")
    return books.withColumns({"bids": side("bid"), "asks": side("ask")}) \
        .drop("bid_price", "bid_quantity", "ask_price", "ask_quantity")


def book_snapshots(deltas: DataFrame, depth: int = 20, keys: list[str] = KEYS) -> DataFrame:
    """The published book after every message (``replayed_books``)."""
    return replayed_books(deltas, depth, keys)


def book_top(deltas: DataFrame, depth: int = 20, keys: list[str] = KEYS) -> DataFrame:
    """(keys, seq, sub, side, price, quantity, level): the best ``depth`` levels a
    side after every message, from the replayed books."""
    from tickbars.operators.feeds import flatten_book

    return flatten_book(replayed_books(deltas, depth, keys), [*keys, "seq", "sub"])

"""The two streaming jobs (O-01..O-03, O-80..O-90).

Bar job: trades -> watermark (5 s) -> 1-minute tumbling window aggregate
(append: a bar is emitted once the watermark passes its end, late trades
are dropped) -> EMA in keyed ValueState -> a second windowed aggregate on
the bar's event time that matches the three sources and computes the
spread -> sink.  Both aggregates and the processor keep state in the
RocksDB state store under the query checkpoint, so a restarted query
resumes where it stopped.

Trade job: trades -> side label -> insert-ignore sink.

Sinks are ``foreachBatch`` writers keyed by batch id: a re-run of a batch
after a failure overwrites its own output, so the at-least-once retry is
idempotent.  Sources are a file folder (tests) or Kafka (production).
"""

from __future__ import annotations

import threading

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from tickbars import session as S
from tickbars.constants import PARSE_ERROR
from tickbars.operators.bars import BAR_COLUMNS, stream_ohlcv_bars
from tickbars.operators.spread import MATCH_SOURCES
from tickbars.operators.tables import BAR_TABLE_COLUMNS
from tickbars.operators.trades import TRADE_KEY, side_label
from tickbars.sources.wire import decode_trades
from tickbars.streaming.processors import EmaProcessor

# Trade rows as landed in the test folders (normalised trade + arrival).
TRADE_FILE_SCHEMA = T.StructType([
    T.StructField("trade_id", T.LongType()), T.StructField("symbol", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("trade_time_ms", T.LongType()),
    T.StructField("price", T.DoubleType()), T.StructField("quantity", T.DoubleType()),
    T.StructField("is_buyer_maker", T.BooleanType()), T.StructField("ingestion_time_ms", T.LongType()),
    T.StructField("latency_ms", T.LongType()), T.StructField("arrival", T.LongType()),
])
RECORD_FILE_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()), T.StructField("value", T.StringType()),
    T.StructField("partition", T.IntegerType()), T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])


# ----------------------------------------------------------------- landing

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


#: Files a landed slice consists of; readers take that many per micro-batch.
SLICE_FILES = 4


def land_batches(spark: SparkSession, df: DataFrame, order: str, batches: int, folder: str,
                 first: int = 0, last: int | None = None, files: int = SLICE_FILES) -> list[str]:
    """Land ``df`` as JSON files in ``folder/in``, ``files`` of them per slice
    of ``order`` and with one modification time, later slices later, so a file
    source that takes ``files`` files a micro-batch reads slice by slice.  The
    rows of a slice are dealt out over its files (and so over as many tasks, on
    both sides); slices with fewer files are filled up with empty ones.  In
    production the topic or the landing system does this."""
    import time

    bounds = df.agg(F.min(order).alias("lo"), F.max(order).alias("hi")).first()
    lo, hi = int(bounds["lo"]), int(bounds["hi"])
    step = (hi - lo) // batches + 1
    last = batches if last is None else last
    sliced = df.withColumn("_batch", F.floor((F.col(order) - F.lit(lo)) / F.lit(step)).cast("int")) \
        .filter((F.col("_batch") >= first) & (F.col("_batch") < last)) \
        .withColumn("_file", F.pmod(F.xxhash64(order), F.lit(files)).cast("int"))
    staging = f"{folder}/_staging/{first:05d}-{last:05d}"
    # a file a task: by hash, several files fell to one task and others had none
    (sliced.repartitionById(max(1, last - first) * files, (F.col("_batch") - F.lit(first)) * files + F.col("_file"))
     .write.mode("overwrite").partitionBy("_batch", "_file").json(staging))
    fs, _, jvm = _fs(spark, staging)
    Path = jvm.org.apache.hadoop.fs.Path
    fs.mkdirs(Path(f"{folder}/in"))
    stamp = int(time.time() * 1000)
    landed = []
    for i in range(first, last):
        if not fs.exists(Path(f"{staging}/_batch={i}")):
            continue
        for k in range(files):
            src_dir, dst = Path(f"{staging}/_batch={i}/_file={k}"), Path(f"{folder}/in/batch-{i:05d}-{k:03d}.json")
            parts = [st.getPath() for st in fs.listStatus(src_dir) if st.getPath().getName().startswith("part-")] \
                if fs.exists(src_dir) else []
            if len(parts) > 1:
                raise ValueError(f"{src_dir}: a file of a slice was written by {len(parts)} tasks")
            if parts:
                fs.rename(parts[0], dst)
            else:
                fs.create(dst, True).close()
            fs.setTimes(dst, stamp + 1000 * (i - first), -1)
            landed.append(str(dst))
    return landed


def batch_writer(sink: str):
    """foreachBatch sink writing each batch to its own folder (idempotent)."""
    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")
    return write


def start_with_state_partitions(spark: SparkSession, writer, state_partitions: int | None):
    """Start a streaming query with a chosen number of state partitions.

    A stateful query fixes its partition count (``spark.sql.shuffle.
    partitions``) at its first start and keeps it in the checkpoint, so it is
    stated, not guessed from the executors that happen to be there; None keeps
    the session's value.  The session value is restored once the query started."""
    if state_partitions is None:
        return writer.start()
    n = state_partitions
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    try:
        return writer.start()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def run_available(query_df: DataFrame, sink: str, checkpoint: str, writer=None,
                  state_partitions: int | None = None):
    """Process everything available now, then stop (Trigger.AvailableNow).  For
    runs over landed files, on executors that are there: the state partitions
    default to the session's cores."""
    w = (query_df.writeStream.foreachBatch(writer or batch_writer(sink))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True))
    spark = query_df.sparkSession
    q = start_with_state_partitions(spark, w, state_partitions or spark.sparkContext.defaultParallelism)
    q.awaitTermination()
    return q


class ProgressTotals(StreamingQueryListener):
    """Late rows dropped, per query run and batch, from every progress report
    (a query itself keeps only the last ``numRecentProgressUpdates``)."""

    def __init__(self):
        self.dropped: dict[tuple[str, int], int] = {}
        self.ended: dict[str, threading.Event] = {}

    def of_run(self, run: str) -> threading.Event:
        return self.ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        self.of_run(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.dropped[str(p.runId), p.batchId] = sum(op.numRowsDroppedByWatermark for op in p.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.of_run(str(event.runId)).set()

    def total(self, run: str, wait_s: float = 60) -> int:
        """Rows dropped in a finished run (reports arrive in order, the end last)."""
        self.of_run(run).wait(wait_s)
        return sum(n for (r, _), n in self.dropped.items() if r == run)


def read_sink(spark: SparkSession, sink: str, schema: T.StructType | None = None) -> DataFrame:
    fs, p, _ = _fs(spark, sink)
    if not fs.exists(p):
        if schema is None:
            raise FileNotFoundError(f"{sink}: no batch was written; pass the schema to read it as empty")
        return spark.createDataFrame([], schema)
    return spark.read.parquet(sink).drop("batch")


# -------------------------------------------------------------- bar stream

def _bar_schema_with_ema() -> T.StructType:
    fields = [T.StructField("symbol", T.StringType()), T.StructField("source", T.StringType()),
              T.StructField("window_start_ms", T.LongType()), T.StructField("window_end_ms", T.LongType())]
    fields += [T.StructField(c, T.DoubleType()) for c in
               ("open", "high", "low", "close", "volume", "vwap", "buy_volume", "sell_volume")]
    fields += [T.StructField("trade_count", T.IntegerType()), T.StructField("bar_time", T.TimestampType()),
               T.StructField("ema10", T.DoubleType())]
    return T.StructType(fields)


def bar_stream(trades: DataFrame, delay: str = "5 seconds", interval: str = "1 minute",
               period: int = 10, idle_ms: int | None = None) -> DataFrame:
    """Streaming bars with EMA (event time of a bar = its window_time).
    ``idle_ms``: see EmaProcessor."""
    bars = stream_ohlcv_bars(trades, interval=interval, delay=delay)
    bars = bars.withColumn("bar_time", F.window_time("w")).drop("w")
    return bars.groupBy("symbol", "source").transformWithStateInPandas(
        EmaProcessor(period, idle_ms=idle_ms), _bar_schema_with_ema(), "Append", "EventTime" if idle_ms else "None",
        eventTimeColumnName="bar_time")


def spread_stream(bars: DataFrame, interval: str = "1 minute",
                  sources: tuple[str, ...] = MATCH_SOURCES) -> DataFrame:
    """Second windowed aggregate: the three sources' bars of a minute, with
    spread; groups hold at most one bar per source.  Minutes that never get
    all sources expire with the watermark instead of staying in state."""
    b = bars.filter(F.col("source").isin(*sources))
    cols = BAR_COLUMNS + ["ema10"]
    g = b.groupBy("symbol", F.window("bar_time", interval).alias("w2")).agg(
        F.collect_list(F.struct(*[F.col(c) for c in cols])).alias("bars"),
        F.size(F.collect_set("source")).alias("n"),
        F.max("close").alias("_max"), F.min("close").alias("_min"), F.avg("close").alias("_avg"))
    g = g.filter(F.col("n") == len(sources))
    out = g.select(F.inline("bars"), (F.col("_max") - F.col("_min")).alias("spread_usd"), "_avg")
    return out.withColumn("spread_bps", F.try_divide(F.col("spread_usd"), F.col("_avg")) * F.lit(10000.0)) \
              .drop("_avg")


def read_trade_files(spark: SparkSession, folder: str, files_per_batch: int = SLICE_FILES) -> DataFrame:
    return (spark.readStream.schema(TRADE_FILE_SCHEMA).option("maxFilesPerTrigger", files_per_batch)
            .json(f"{folder}/in"))


def run_bar_job(spark: SparkSession, trades: DataFrame, batches: int = 4, stages: tuple[int, ...] = (),
                what: str = "spread", metrics: dict | None = None, idle_ms: int | None = None) -> DataFrame:
    """Land ``trades`` in time order and run the bar stream over them.

    ``stages``: stop-and-restart points (batch numbers) -- the query is
    stopped after landing each stage and restarted from its checkpoint.
    ``what``: 'bars' (window aggregate only), 'ema' or 'spread' (full job).
    ``metrics``: if given, receives ``dropped_late`` (rows dropped by the
    watermark).
    """
    S.configure(spark)
    S.ship_package(spark)
    base = S.fresh_path(spark, f"stream-{what}")
    sink, ckpt = f"{base}/sink", f"{base}/checkpoint"
    cuts = [0, *stages, batches]
    for a, b in zip(cuts, cuts[1:]):
        land_batches(spark, trades.select(*TRADE_FILE_SCHEMA.fieldNames()), "arrival", batches, base, a, b)
        src = read_trade_files(spark, base)
        if what == "bars":
            out = stream_ohlcv_bars(src).drop("w")
        elif what == "ema":
            out = bar_stream(src, idle_ms=idle_ms)
        else:
            out = spread_stream(bar_stream(src))
        schema = out.schema
        totals = ProgressTotals()
        spark.streams.addListener(totals)
        try:
            q = run_available(out, sink, ckpt)
            if metrics is not None:
                metrics["dropped_late"] = metrics.get("dropped_late", 0) + totals.total(str(q.runId))
        finally:
            spark.streams.removeListener(totals)
    return read_sink(spark, sink, schema)


# ------------------------------------------------------------ trade stream

def crashing_writer(write, at: int):
    """A foreachBatch writer that fails once, in batch ``at``: after the batch was
    computed (its state is committed in the stores) and before ``write``."""
    armed = [True]

    def run(df: DataFrame, batch_id: int) -> None:
        if batch_id == at and armed:
            armed.pop()
            rows = df.persist()
            try:
                rows.count()
            finally:
                rows.unpersist()
            raise RuntimeError(f"batch {batch_id} stopped before its sink")
        write(df, batch_id)
    return run


def run_crash_job(spark: SparkSession, trades: DataFrame, batches: int = 4, at: int | None = 1) -> tuple[DataFrame, str]:
    """The bar job, stopped inside batch ``at`` between state commit and sink and
    started again from its checkpoint; (bars of the sink, checkpoint).  ``at``
    None: not stopped."""
    S.configure(spark)
    S.ship_package(spark)
    base = S.fresh_path(spark, "stream-crash")
    sink, ckpt = f"{base}/sink", f"{base}/checkpoint"
    land_batches(spark, trades.select(*TRADE_FILE_SCHEMA.fieldNames()), "arrival", batches, base)
    write = batch_writer(sink) if at is None else crashing_writer(batch_writer(sink), at)
    out = spread_stream(bar_stream(read_trade_files(spark, base)))
    if at is not None:
        try:
            run_available(out, sink, ckpt, write)
        except StreamingQueryException as stopped:
            if "stopped before its sink" not in str(stopped):
                raise
        else:
            raise ValueError(f"the run has no batch {at}")
    run_available(out, sink, ckpt, write)
    return read_sink(spark, sink, out.schema), ckpt


def insert_ignore_writer(table: str):
    """foreachBatch: INSERT ... ON CONFLICT DO NOTHING into the day-partitioned
    trades table; reads only the days the batch touches; a replayed batch
    inserts nothing."""
    from tickbars.operators.tables import insert_ignore_days
    from tickbars.operators.trades import TRADE_TABLE_COLUMNS

    def write(df: DataFrame, batch_id: int) -> None:
        insert_ignore_days(df.sparkSession, df, table, "trade_time_ms", TRADE_KEY, TRADE_TABLE_COLUMNS)
    return write


def trade_rows(decoded: DataFrame) -> DataFrame:
    kept = [c for c in ("value", "timestamp", "partition", "offset") if c in decoded.columns]
    return decoded.select(*kept, "trade_time_ms", "symbol", "source", "trade_id", "price", "quantity",
                          side_label(F.col("is_buyer_maker")).alias("side"),
                          "ingestion_time_ms", "latency_ms", "arrival")


def letters(staged: DataFrame, broken: DataFrame) -> DataFrame:
    """Dead letters of decoded records: ``ParseError`` for those that do not
    decode, the constraint for rows (with ``reason``) that break one."""
    from tickbars.sources.wire import undecoded_rows

    return undecoded_rows(staged).withColumn("error", F.lit(PARSE_ERROR)).unionByName(
        broken.withColumn("error", F.concat(F.lit("ConstraintViolation: "), "reason")), allowMissingColumns=True) \
        .withColumns({"rawPayload": F.col("value"), "ingestionTimeMs": F.unix_millis("timestamp")}) \
        .select("rawPayload", "error", "ingestionTimeMs", "partition", "offset")


DECODED_SCHEMA = ("event_type string, event_time_ms long, symbol string, trade_id long, price double, quantity double, "
                  "trade_time_ms long, is_buyer_maker boolean, source string, ingestion_time_ms long, latency_ms long, "
                  "partition int, offset long, arrival_order decimal(38,0), arrival long")


def decode_hop_writer(out: str, dlq: str):
    """foreachBatch on raw topic records: one decode for every reader of the
    topic.  Trades that decode and keep the table's constraints go to ``out``,
    the rest to the dead letters, both in the batch's own folder."""
    from tickbars.operators.tables import TRADE_NOT_NULL, split_valid
    from tickbars.sources.wire import decode_stage, decoded_rows

    def write(records: DataFrame, batch_id: int) -> None:
        staged = decode_stage(records).persist()
        try:
            rows = decoded_rows(staged, keep=("value", "timestamp"))
            good, broken = split_valid(rows, [c for c in TRADE_NOT_NULL if c != "side"])
            good.drop("value", "timestamp").write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
            letters(staged, broken).write.mode("overwrite").parquet(f"{dlq}/batch={batch_id}")
        finally:
            staged.unpersist()
    return write


def start_decode_hop(records: DataFrame, out: str, dlq: str, checkpoint: str, **trigger):
    """The decode hop as a running query; ``read_decoded`` streams its trades."""
    return records.writeStream.foreachBatch(decode_hop_writer(out, dlq)) \
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()


def read_decoded(spark: SparkSession, out: str, max_files: int = 100) -> DataFrame:
    """Trades of the decode hop as a stream (``batch`` folders, oldest first)."""
    return spark.readStream.schema(DECODED_SCHEMA).option("maxFilesPerTrigger", max_files).parquet(f"{out}/batch=*")


def run_decode_hop(spark: SparkSession, records: DataFrame, batches: int = 4) -> tuple[str, str]:
    """Land topic records and run the decode hop; returns its two folders."""
    S.configure(spark)
    base = S.fresh_path(spark, "stream-hop")
    land_batches(spark, records, "offset", batches, base)
    start_decode_hop(read_records(spark, base), f"{base}/out", f"{base}/dlq", f"{base}/checkpoint",
                     availableNow=True).awaitTermination()
    return f"{base}/out", f"{base}/dlq"


def trade_job_writer(table: str, dlq: str, writer=None):
    """foreachBatch on raw topic records: decodable records go through the
    side label into the trades table (insert-ignore); records that do not
    decode go to the dead letters with error ``ParseError``, rows that break a
    constraint of the table with the constraint, instead of stopping the job.
    ``writer`` replaces the file table (e.g. by the database sink).  A batch is decoded once: the decoded records are persisted for its outputs."""
    from tickbars.operators.tables import TRADE_NOT_NULL, split_valid
    from tickbars.sources.wire import decode_stage, decoded_rows
    insert = writer or insert_ignore_writer(table)

    def write(records: DataFrame, batch_id: int) -> None:
        staged = decode_stage(records).persist()
        try:
            rows = trade_rows(decoded_rows(staged, keep=("value", "timestamp")))
            good, broken = split_valid(rows, TRADE_NOT_NULL)
            insert(good, batch_id)
            letters(staged, broken).write.mode("overwrite").parquet(f"{dlq}/batch={batch_id}")
        finally:
            staged.unpersist()
    return write


def run_trade_job(spark: SparkSession, records: DataFrame, batches: int = 4) -> DataFrame:
    """Land topic records (key, value, partition, offset, timestamp) and run
    decode -> enrich -> insert-ignore (+ dead letters)."""
    S.configure(spark)
    base = S.fresh_path(spark, "stream-trades")
    table, ckpt = f"{base}/table", f"{base}/checkpoint"
    land_batches(spark, records, "offset", batches, base)
    run_available(read_records(spark, base), table, ckpt, trade_job_writer(table, f"{base}/dlq"))
    return read_sink(spark, table).drop("d", "h")


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """Topic records landed as files (stands in for the Kafka source, which
    ``sources.wire.read_kafka`` opens in production)."""
    return spark.readStream.schema(RECORD_FILE_SCHEMA).option("maxFilesPerTrigger", SLICE_FILES).json(f"{folder}/in")


def run_decode_job(spark: SparkSession, records: DataFrame, batches: int = 4) -> DataFrame:
    """Trade-topic source (O-01): records -> decoded trades, appended per batch."""
    S.configure(spark)
    base = S.fresh_path(spark, "stream-source")
    sink, ckpt = f"{base}/sink", f"{base}/checkpoint"
    land_batches(spark, records, "offset", batches, base)
    run_available(decode_trades(read_records(spark, base)), sink, ckpt)
    return read_sink(spark, sink)


# ------------------------------------------------------------- book stream

DELTA_FILE_SCHEMA = T.StructType([
    T.StructField("source", T.StringType()), T.StructField("symbol", T.StringType()),
    T.StructField("seq", T.LongType()), T.StructField("sub", T.LongType()),
    T.StructField("lpos", T.LongType()), T.StructField("kind", T.StringType()),
    T.StructField("side", T.StringType()), T.StructField("price", T.DoubleType()),
    T.StructField("quantity", T.DoubleType()), T.StructField("keep_zero", T.BooleanType()),
    T.StructField("header", T.BooleanType()), T.StructField("timestamp_ms", T.LongType()),
])
BOOK_SCHEMA = ("source string, symbol string, seq long, sub long, timestamp_ms long, bid_price array<double>, "
               "bid_quantity array<double>, ask_price array<double>, ask_quantity array<double>")
BOOK_ROW = ["source", "symbol", "seq", "sub", "timestamp_ms", "bids", "asks"]


def book_stream(deltas: DataFrame, depth: int = 20) -> DataFrame:
    """Prepared level changes -> one book row per message (``BOOK_ROW``), empty
    books included.  The keyed state gives runs of messages with the book before
    each; the runs are dealt out over all tasks and replayed there."""
    from tickbars.constants import NULL_KEY
    from tickbars.operators.book import with_sides
    from tickbars.operators.replay import RUN_SCHEMA, replay_runs
    from tickbars.streaming.processors import BookProcessor
    keys = ["source", "symbol"]
    runs = deltas.groupBy(*keys).transformWithStateInPandas(BookProcessor(), RUN_SCHEMA, "Append", "None")
    out = runs.repartition(*keys, F.col("seq")[0], F.col("sub")[0]).mapInArrow(replay_runs(depth, keys), BOOK_SCHEMA)
    return with_sides(out).withColumns({k: F.when(F.col(k) != NULL_KEY, F.col(k)) for k in ("source", "symbol")})


def published_books(frames: DataFrame, depth: int = 20) -> DataFrame:
    """The book stream of all three feeds (O-30, O-59b): feed 1 sends whole
    books, those of feeds 2 and 3 are kept in keyed state.  Every feed's frames
    are parsed once, in their own branch of one query.

    No watermark: a message is published in the micro-batch that reads it, none
    waits for another feed and none is dropped as late.  Within a micro-batch
    the messages of a key apply in arrival order, across them in topic order."""
    from tickbars.constants import SOURCE_FEED1
    from tickbars.operators.book import prepare
    from tickbars.operators.feeds import book_rows, feed1_books

    whole = feed1_books(frames).withColumn("sub", F.lit(0).cast("long"))
    changes = prepare(book_rows(frames.filter(F.col("source") != SOURCE_FEED1)))
    return whole.select(*BOOK_ROW).unionByName(book_stream(changes, depth).select(*BOOK_ROW))


def start_book_topic(frames: DataFrame, writer, checkpoint: str, depth: int = 20, state_partitions: int | None = None,
                     **trigger):
    """Captured frames -> book records (key, value) of all feeds -> ``writer``
    (foreachBatch), as a running query."""
    from tickbars.sources.wire import encode_books

    S.ship_package(frames.sparkSession)
    return start_with_state_partitions(
        frames.sparkSession, encode_books(published_books(frames, depth)).writeStream.foreachBatch(writer)
        .option("checkpointLocation", checkpoint).trigger(**trigger), state_partitions)


def run_book_topic(spark: SparkSession, frames: DataFrame, batches: int = 4) -> DataFrame:
    """Land captured frames and publish their books; returns the records."""
    S.configure(spark)
    base = S.fresh_path(spark, "stream-book-topic")
    land_batches(spark, frames, "seq", batches, base)
    src = spark.readStream.schema(FRAME_FILE_SCHEMA).option("maxFilesPerTrigger", SLICE_FILES).json(f"{base}/in")
    start_book_topic(src, batch_writer(f"{base}/sink"), f"{base}/checkpoint",
                     state_partitions=spark.sparkContext.defaultParallelism, availableNow=True).awaitTermination()
    return read_sink(spark, f"{base}/sink")


def run_liveness(spark: SparkSession, frames: DataFrame, silence_ms: int, batches: int = 4) -> DataFrame:
    """Land captured frames in receive order and watch the feeds' silences."""
    from tickbars.operators.feeds import feed_liveness

    S.configure(spark)
    base = S.fresh_path(spark, "stream-liveness")
    land_batches(spark, frames, "recv_ms", batches, base)
    src = spark.readStream.schema(FRAME_FILE_SCHEMA).option("maxFilesPerTrigger", SLICE_FILES).json(f"{base}/in")
    out = feed_liveness(src, silence_ms)
    run_available(out, f"{base}/sink", f"{base}/checkpoint")
    return read_sink(spark, f"{base}/sink", out.schema)


def run_book_job(spark: SparkSession, deltas: DataFrame, batches: int = 4, depth: int = 20) -> DataFrame:
    """Land level changes in seq order and keep the books in keyed state."""
    from tickbars.operators.book import prepare

    S.configure(spark)
    S.ship_package(spark)
    base = S.fresh_path(spark, "stream-book")
    sink, ckpt = f"{base}/sink", f"{base}/checkpoint"
    if "timestamp_ms" not in deltas.columns:
        deltas = deltas.withColumn("timestamp_ms", F.lit(None).cast("long"))
    d = prepare(deltas).select(*DELTA_FILE_SCHEMA.fieldNames())
    land_batches(spark, d, "seq", batches, base)
    src = spark.readStream.schema(DELTA_FILE_SCHEMA).option("maxFilesPerTrigger", SLICE_FILES).json(f"{base}/in")
    run_available(book_stream(src, depth), sink, ckpt)
    return read_sink(spark, sink)


# ------------------------------------------------------- upsert replay sink

BAR_SINK_COLUMNS = BAR_TABLE_COLUMNS


def upsert_writer(table: str, dlq: str | None = None):
    """foreachBatch: ON CONFLICT upsert of the batch's bars into the bucketed
    table (``operators.buckets``, read with ``read_bars``).  Bars that break a constraint of the table are left out; with ``dlq`` they
    are written there, in the batch's own folder, with the constraint."""
    from tickbars.operators.buckets import upsert_buckets
    from tickbars.operators.tables import BAR_NOT_NULL, split_valid

    def write(df: DataFrame, batch_id: int) -> None:
        bars = df.persist()
        try:
            good, broken = split_valid(bars, BAR_NOT_NULL)
            upsert_buckets(df.sparkSession, good, table, "window_start_ms")
            if dlq:
                broken.select(F.to_json(F.struct(*df.columns)).alias("rawPayload"),
                              F.concat(F.lit("ConstraintViolation: "), "reason").alias("error")) \
                    .write.mode("overwrite").parquet(f"{dlq}/batch={batch_id}")
        finally:
            bars.unpersist()
    return write


BAR_TABLE_SCHEMA = T.StructType([
    T.StructField(c, T.StringType() if c in ("symbol", "source")
                  else T.LongType() if c == "window_start_ms" else T.IntegerType() if c == "trade_count" else T.DoubleType())
    for c in BAR_TABLE_COLUMNS])


def read_bars(spark: SparkSession, table: str, days: list[int] | None = None) -> DataFrame:
    """The bar table that ``upsert_writer`` keeps: its committed rows."""
    from tickbars.operators.buckets import read_buckets

    return read_buckets(spark, table, BAR_TABLE_SCHEMA, days)


def run_upsert_replay(spark: SparkSession, trades: DataFrame, batches: int = 4) -> DataFrame:
    """Run the bar job into an upsert table, then replay every batch from a
    fresh checkpoint into the same table: the table must not change."""
    S.configure(spark)
    S.ship_package(spark)
    base = S.fresh_path(spark, "stream-upsert")
    table = f"{base}/ohlcv"
    land_batches(spark, trades.select(*TRADE_FILE_SCHEMA.fieldNames()), "arrival", batches, base)
    for attempt in ("first", "replay"):
        out = spread_stream(bar_stream(read_trade_files(spark, base)))
        run_available(out, table, f"{base}/checkpoint-{attempt}", upsert_writer(table))
    return read_bars(spark, table)


# -------------------------------------------------------------- feed stream

FRAME_FILE_SCHEMA = T.StructType([
    T.StructField("source", T.StringType()), T.StructField("seq", T.LongType()),
    T.StructField("recv_ms", T.LongType()), T.StructField("raw", T.StringType()),
])
def feed_writer(base: str):
    """foreachBatch for parsed frames: one parse, four outputs (trades, dead
    letters, book level changes, feed-1 snapshots) and the batch's counters.
    The parsed batch is persisted for the duration of the batch so it is not
    parsed for each; every output is written to a batch-id folder (idempotent
    on retry), the counters too, so their sum is exact however long the run."""
    from tickbars.operators.feeds import counters_of, dead_letters_of, feed1_snapshots, levels_of, trades_of

    def write(parsed: DataFrame, batch_id: int) -> None:
        parsed.persist()
        try:
            trades_of(parsed).write.mode("overwrite").parquet(f"{base}/trades/batch={batch_id}")
            dead_letters_of(parsed).write.mode("overwrite").parquet(f"{base}/dlq/batch={batch_id}")
            levels_of(parsed).write.mode("overwrite").parquet(f"{base}/levels/batch={batch_id}")
            feed1_snapshots(parsed).write.mode("overwrite").parquet(f"{base}/books/batch={batch_id}")
            counters_of(parsed).write.mode("overwrite").parquet(f"{base}/counters/batch={batch_id}")
        finally:
            parsed.unpersist()
    return write


def feed_topics(o):
    """foreachBatch for parsed frames: trades and dead letters to the topics that
    the options name (needs the Kafka connector); the books of all feeds are a
    query of their own (``start_book_topic``)."""
    from tickbars.operators.feeds import dead_letters_of, trades_of
    from tickbars.sources import wire as W

    def write(parsed: DataFrame, batch_id: int) -> None:
        parsed.persist()
        try:
            W.write_kafka(W.encode_trades(trades_of(parsed)), o.bootstrap_servers, o.trade_topic)
            W.write_kafka(W.encode_dead_letters(dead_letters_of(parsed)), o.bootstrap_servers, o.dlq_topic)
        finally:
            parsed.unpersist()
    return write


def run_feed_job(spark: SparkSession, frames: DataFrame, batches: int = 4) -> tuple[str, dict]:
    """Land captured frames in seq order and run the producer side as a
    stream.  Returns the output folder and the feed counters (O-91), summed
    over the counter rows that every batch wrote."""
    from tickbars.operators.feeds import parse_frames

    S.configure(spark)
    base = S.fresh_path(spark, "stream-feeds")
    land_batches(spark, frames, "seq", batches, base)
    src = spark.readStream.schema(FRAME_FILE_SCHEMA).option("maxFilesPerTrigger", SLICE_FILES).json(f"{base}/in")
    q = start_with_state_partitions(
        spark, parse_frames(src).writeStream.foreachBatch(feed_writer(f"{base}/out"))
        .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True), None)
    q.awaitTermination()
    return f"{base}/out", feed_totals(spark, f"{base}/out")


def feed_totals(spark: SparkSession, base: str) -> dict[str, int]:
    """Counters of a producer run so far, over all its batches."""
    rows = spark.read.parquet(f"{base}/counters").drop("batch")
    return {k: int(v or 0) for k, v in rows.agg(*[F.sum(c).alias(c) for c in rows.columns]).first().asDict().items()}


# ------------------------------------------------------ production starters

def start_bar_job(records: DataFrame | None, table: str, checkpoint: str,
                  trigger: str = "500 milliseconds", delay: str = "5 seconds", period: int = 10,
                  state_partitions: int | None = None, dlq: str | None = None,
                  interval: str = "1 minute", writer=None, trades: DataFrame | None = None):
    """Bar job on a stream of topic records (``sources.wire.read_kafka`` or
    landed files), or of ``trades`` that the decode hop has decoded: bars -> EMA
    -> spread -> upsert into the bucketed ``ohlcv`` table (``read_bars``); bars that
    break a constraint go to ``dlq``.  Returns the running StreamingQuery; state
    and progress live under ``checkpoint`` (use a folder under
    ``spark.checkpoint.dir``).  Records that do not decode are dropped here: run
    the decode hop to keep them."""
    trades = decode_trades(records) if trades is None else trades
    spark = trades.sparkSession
    S.ship_package(spark)
    if "arrival_order" in trades.columns:
        trades = trades.withColumn("arrival", F.col("arrival_order"))
    out = spread_stream(bar_stream(trades, delay=delay, interval=interval, period=period), interval=interval)
    return start_with_state_partitions(
        spark, out.writeStream.foreachBatch(writer or upsert_writer(table, dlq)).option("checkpointLocation", checkpoint)
        .trigger(processingTime=trigger), state_partitions)


def start_trade_job(records: DataFrame, table: str, checkpoint: str, dlq: str | None = None,
                    trigger: str = "200 milliseconds", writer=None):
    """Trade job: decode -> side label -> insert-ignore into ``trades``,
    undecodable records to ``dlq``.  Its own checkpoint makes it an
    independent consumer of the same topic."""
    return (records.writeStream.foreachBatch(trade_job_writer(table, dlq or f"{table}_dlq", writer))
            .option("checkpointLocation", checkpoint).trigger(processingTime=trigger).start())


def run_frames_to_bars(spark: SparkSession, frames: DataFrame, batches: int = 4) -> DataFrame:
    """Producer and bar job chained in one streaming query: captured frames
    -> one parse -> normalised trades (arrival = frame seq, position) ->
    watermark + 1-minute window aggregate."""
    from tickbars.operators.feeds import frame_order, parse_frames, trades_of

    S.configure(spark)
    base = S.fresh_path(spark, "stream-frames-bars")
    sink, ckpt = f"{base}/sink", f"{base}/checkpoint"
    land_batches(spark, frames, "seq", batches, base)
    src = spark.readStream.schema(FRAME_FILE_SCHEMA).option("maxFilesPerTrigger", SLICE_FILES).json(f"{base}/in")
    trades = trades_of(parse_frames(src, want=("trades",))).withColumn("arrival", frame_order())
    run_available(stream_ohlcv_bars(trades).drop("w"), sink, ckpt)
    return read_sink(spark, sink)

"""Trade-topic wire format: decode (O-23), encode (O-24, O-59a/b/c).

Wire keys are e,E,s,t,p,q,T,m (+ source, ingestionTimeMs, latencyMs); Spark
resolves field names case-insensitively, so ``e``/``E`` and ``t``/``T``
cannot be selected by name.  The record is parsed once to a VARIANT, whose
paths are case-sensitive; the struct read from it is renamed by position to
our snake_case names.  Unknown keys are ignored; a value that is not a JSON
object is routed to the dead letters by the caller.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIRE_DDL = ("struct<e:string,E:bigint,s:string,t:bigint,p:double,q:double,T:bigint,m:boolean,"
            "source:string,ingestionTimeMs:bigint,latencyMs:bigint>")
TRADE_DDL = ("struct<event_type:string,event_time_ms:bigint,symbol:string,trade_id:bigint,"
             "price:double,quantity:double,trade_time_ms:bigint,is_buyer_maker:boolean,"
             "source:string,ingestion_time_ms:bigint,latency_ms:bigint>")
TRADE_FIELDS = ["event_type", "event_time_ms", "symbol", "trade_id", "price", "quantity",
                "trade_time_ms", "is_buyer_maker", "source", "ingestion_time_ms", "latency_ms"]


# Wire key and our name of the fields that are numbers or booleans.
TYPED_FIELDS = [("E", "event_time_ms"), ("t", "trade_id"), ("p", "price"), ("q", "quantity"), ("T", "trade_time_ms"),
                ("m", "is_buyer_maker"), ("ingestionTimeMs", "ingestion_time_ms"), ("latencyMs", "latency_ms")]


# The typed fields again, as text: whatever is present and not JSON null.
RAW_DDL = "struct<" + ",".join(f"{wire}:string" for wire, _ in TYPED_FIELDS) + ">"
RAW_NAMES_DDL = "struct<" + ",".join(f"{name}:string" for _, name in TYPED_FIELDS) + ">"
DEFAULTS = {"event_time_ms": 0, "trade_id": 0, "price": 0.0, "quantity": 0.0,
            "trade_time_ms": 0, "is_buyer_maker": False, "ingestion_time_ms": 0, "latency_ms": 0}


def decode_stage(records: DataFrame, value: str = "value") -> DataFrame:
    """Records with ``_t`` (the trade struct) and ``_ok`` (decodable: a JSON
    object whose typed fields, where present, convert -- quoted numbers and
    booleans do -- and whose price and quantity are not NaN; a field that is
    missing or JSON null is not bad: it keeps its default).

    One VARIANT parse and two struct reads per record.  An observed record
    count sits above each of the two steps, so later filters and selections
    stay above them and nothing is parsed or read again."""
    def counted(df: DataFrame) -> DataFrame:
        return df.observe(f"wire_{uuid.uuid4().hex[:8]}", F.count(F.lit(1)).alias("records"))

    parsed = counted(records.withColumn("_v", F.try_parse_json(F.col(value))))
    v = F.col("_v")
    read = counted(parsed.select(
        "*", F.try_variant_get(v, "$", WIRE_DDL).cast(TRADE_DDL).alias("_t"),
        F.try_variant_get(v, "$", RAW_DDL).cast(RAW_NAMES_DDL).alias("_raw")).drop("_v"))
    t, raw = F.col("_t"), F.col("_raw")
    bad = F.isnan(F.coalesce(t["price"], F.lit(0.0))) | F.isnan(F.coalesce(t["quantity"], F.lit(0.0)))
    for _, name in TYPED_FIELDS:
        bad = bad | (t[name].isNull() & raw[name].isNotNull())
    is_object = t.isNotNull() & F.startswith(F.ltrim(F.col(value)), F.lit("{"))
    return read.withColumn("_ok", F.coalesce(is_object & ~bad, F.lit(False))).drop("_raw")


def decode_trades(records: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Topic records -> trades.  ``arrival`` = offset when present; with
    partition and timestamp also ``arrival_order``, which compares records of
    different partitions: (timestamp, partition, offset) in one number.

    Primitive fields missing in the JSON keep their Java defaults (0/false),
    as the consumer's field defaults do; strings stay null.  The wire struct
    is read from the VARIANT (paths are case-sensitive, so e/E and t/T are
    distinct) and renamed by position.
    """
    return decoded_rows(decode_stage(records, value), keep)


def decoded_rows(staged: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Trades of the decodable records of ``decode_stage``."""
    cols = [F.col(c) for c in keep]
    extra = [F.col(c) for c in ("partition", "offset") if c in staged.columns]
    if {"partition", "offset", "timestamp"} <= set(staged.columns):
        extra.append(arrival_order().alias("arrival_order"))
    fields = [F.coalesce(F.col(f"_t.{f}"), F.lit(DEFAULTS[f])).alias(f) if f in DEFAULTS else F.col(f"_t.{f}").alias(f)
              for f in TRADE_FIELDS]
    out = staged.filter("_ok").select(*cols, *fields, *[c for c in extra])
    if "offset" in staged.columns:
        out = out.withColumn("arrival", F.col("offset"))
    return out


def arrival_order() -> Column:
    """(timestamp, partition, offset) of a topic record as one decimal, so that a
    bar's first and last trade stay a hash aggregate.  Offsets of different
    partitions are not comparable; broker time is, ties go by partition."""
    digits = F.concat(F.lpad(F.unix_millis("timestamp").cast("string"), 13, "0"),
                      F.lpad(F.col("partition").cast("string"), 6, "0"),
                      F.lpad(F.col("offset").cast("string"), 19, "0"))
    return digits.cast("decimal(38,0)")


def undecodable(records: DataFrame, value: str = "value") -> DataFrame:
    """Records the consumer could not decode: not a JSON object, or a typed
    field is present and does not convert, or a price or quantity is NaN."""
    return undecoded_rows(decode_stage(records, value))


def undecoded_rows(staged: DataFrame) -> DataFrame:
    """The records of ``decode_stage`` that do not decode."""
    return staged.filter("not _ok").drop("_t", "_ok")


def trade_value(df: DataFrame) -> Column:
    """Trade row -> wire JSON text with the short keys."""
    return F.to_json(F.struct(
        F.col("event_type").alias("e"), F.col("event_time_ms").alias("E"), F.col("symbol").alias("s"),
        F.col("trade_id").alias("t"), F.col("price").alias("p"), F.col("quantity").alias("q"),
        F.col("trade_time_ms").alias("T"), F.col("is_buyer_maker").alias("m"),
        F.col("source").alias("source"), F.col("ingestion_time_ms").alias("ingestionTimeMs"),
        F.col("latency_ms").alias("latencyMs"),
    ))


def encode_trades(trades: DataFrame) -> DataFrame:
    """Trades -> Kafka records keyed by symbol (trade topic)."""
    return trades.select(F.col("symbol").alias("key"), trade_value(trades).alias("value"))


def encode_books(books: DataFrame) -> DataFrame:
    """Book snapshots -> Kafka records keyed by symbol (book topic)."""
    return books.select(F.col("symbol").alias("key"), F.to_json(F.struct(
        "source", "symbol", F.col("timestamp_ms").alias("timestampMs"), "bids", "asks")).alias("value"))


def encode_dead_letters(dlq: DataFrame) -> DataFrame:
    """Dead letters -> Kafka records with a null key."""
    return dlq.select(F.lit(None).cast("string").alias("key"),
                      F.to_json(F.struct("rawPayload", "error", "ingestionTimeMs")).alias("value"))


def write_kafka(records: DataFrame, servers: str, topic: str, checkpoint: str | None = None):
    """Sink for batch or streaming records (needs the Kafka connector jar;
    acks=all and retries are producer options passed through)."""
    opts = {"kafka.bootstrap.servers": servers, "topic": topic,
            "kafka.acks": "all", "kafka.retries": "5", "kafka.linger.ms": "5"}
    if records.isStreaming:
        w = records.writeStream.format("kafka").options(**opts)
        return w.option("checkpointLocation", checkpoint).start()
    records.write.format("kafka").options(**opts).save()
    return None


def read_kafka(spark, servers: str, topic: str, starting: str = "latest", stream: bool = True,
               max_offsets: int | None = 1_000_000) -> DataFrame:
    """Trade-topic source (O-01/O-02): value as text plus partition/offset.
    ``max_offsets`` bounds a micro-batch, so a backlog is read in steps."""
    r = (spark.readStream if stream else spark.read).format("kafka") \
        .option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    if stream:
        r = r.option("startingOffsets", starting)
        if max_offsets:
            r = r.option("maxOffsetsPerTrigger", max_offsets)
    return r.load().select(F.col("key").cast("string"), F.col("value").cast("string"),
                           "partition", "offset", "timestamp")

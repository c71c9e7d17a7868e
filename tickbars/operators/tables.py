"""Table semantics of the sink tables (O-52, O-56, O-58).

Tables are Parquet folders partitioned by UTC day of the time key (the
hypertable's time chunks).  Reads filter the partition column as well as
the time column, so Spark prunes whole days before it opens a file, and
the remaining predicates are pushed into the Parquet reader.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DAY_MS = 86_400_000
HOUR_MS = 3_600_000
BAR_KEY = ["symbol", "source", "window_start_ms"]
BAR_TABLE_COLUMNS = ["symbol", "source", "window_start_ms", "open", "high", "low", "close",
                     "volume", "vwap", "buy_volume", "sell_volume", "ema10", "trade_count",
                     "spread_usd", "spread_bps"]
ON_CONFLICT_UPDATE = ["spread_usd", "spread_bps"]


def day_of(ms: Column | str) -> Column:
    """Partition value: UTC day number of an epoch-ms time."""
    c = F.col(ms) if isinstance(ms, str) else ms
    return F.floor(c / F.lit(DAY_MS)).cast("int")


def merge_upsert(target: DataFrame, updates: DataFrame, key: list[str] = BAR_KEY,
                 update_cols: list[str] = ON_CONFLICT_UPDATE) -> DataFrame:
    """INSERT ... ON CONFLICT (key) DO UPDATE SET <update_cols> = EXCLUDED.<col>.

    New keys are inserted whole; existing keys keep every other column and
    take the incoming ``update_cols``; target rows without an incoming row
    stay as they are.  One full outer join on the key; both sides are
    shuffled on it and the key is unique per side, so no group is hot.
    For a file table, call it on the day partitions the updates touch and
    write the result with dynamic partition overwrite.
    """
    cols = target.columns
    t = target.select(*cols, F.lit(True).alias("_in_t"))
    u = updates.select(*key, *[F.col(c).alias(f"_u_{c}") for c in cols if c not in key],
                       F.lit(True).alias("_in_u"))
    j = t.join(u, on=key, how="full_outer")
    out = []
    for c in cols:
        if c in key:
            out.append(F.col(c))
        elif c in update_cols:
            out.append(F.when(F.col("_in_u"), F.col(f"_u_{c}")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.when(F.col("_in_t"), F.col(c)).otherwise(F.col(f"_u_{c}")).alias(c))
    return j.select(*out)


def write_partitioned(df: DataFrame, path: str, time_col: str, sort_cols: list | None = None,
                      mode: str = "overwrite", files: int | None = None) -> None:
    """Write a day-partitioned table.  With ``sort_cols`` rows are dealt out by
    range of (day, sort columns), so a day is as many files as its rows ask for
    and each file covers a narrow range: Parquet min/max statistics then skip
    files and row groups, the file-table form of the (symbol, trade_time DESC)
    index (O-57).  ``files``: ranges over the whole write (default: the shuffle
    partitions, which adaptive execution leaves alone for a given number)."""
    out = df.withColumn("d", day_of(time_col))
    if sort_cols:
        n = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        out = out.repartitionByRange(n, "d", *sort_cols).sortWithinPartitions("d", *sort_cols)
    (out.write.mode(mode).option("partitionOverwriteMode", "dynamic")
        .partitionBy("d").parquet(path))


def scan_filtered(spark: SparkSession, path: str, time_col: str, symbol: str | None = None,
                  source: str | None = None, t_from: int | None = None,
                  t_to: int | None = None) -> DataFrame:
    """Filtered table scan (O-04): equality and time-range predicates plus
    the derived day-partition predicate."""
    df = spark.read.parquet(path)
    pred = F.lit(True)
    if symbol is not None:
        pred = pred & (F.col("symbol") == F.lit(symbol))
    if source is not None:
        pred = pred & (F.col("source") == F.lit(source))
    if t_from is not None:
        pred = pred & (F.col(time_col) >= F.lit(t_from)) & (F.col("d") >= F.lit(t_from // DAY_MS))
    if t_to is not None:
        pred = pred & (F.col(time_col) <= F.lit(t_to)) & (F.col("d") <= F.lit(t_to // DAY_MS))
    return df.filter(pred).drop("d")


# Column constraints of the two tables.
VARCHAR_LIMITS = {"symbol": 20, "source": 20, "side": 4}
BAR_NOT_NULL = ["symbol", "source", "window_start_ms", "open", "high", "low", "close", "volume",
                "vwap", "buy_volume", "sell_volume", "ema10", "trade_count"]
TRADE_NOT_NULL = ["trade_time_ms", "symbol", "source", "trade_id", "price", "quantity", "side",
                  "ingestion_time_ms", "latency_ms"]


def constraint_reason(df: DataFrame, not_null: list[str]) -> Column:
    """First violated constraint of a row as text, or null when valid."""
    checks = [(F.col(c).isNull(), f"{c} is null") for c in not_null if c in df.columns]
    checks += [(F.length(F.col(c)) > n, f"{c} longer than {n}")
               for c, n in VARCHAR_LIMITS.items() if c in df.columns]
    reason = F.lit(None).cast("string")
    for cond, text in reversed(checks):
        reason = F.when(cond, F.lit(text)).otherwise(reason)
    return reason


def split_valid(df: DataFrame, not_null: list[str]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, violating rows + reason) in one pass each, no shuffle."""
    tagged = df.withColumn("_reason", constraint_reason(df, not_null))
    return (tagged.filter(F.col("_reason").isNull()).drop("_reason"),
            tagged.filter(F.col("_reason").isNotNull()).withColumnRenamed("_reason", "reason"))


def constraint_report(df: DataFrame, not_null: list[str]) -> DataFrame:
    """Violations per constraint (rule, violations) -- one aggregate pass,
    zero counts included."""
    checks = [(f"{c} not null", F.col(c).isNull()) for c in not_null if c in df.columns]
    checks += [(f"{c} length <= {n}", F.length(F.col(c)) > n)
               for c, n in VARCHAR_LIMITS.items() if c in df.columns]
    counts = df.agg(*[F.count_if(cond).alias(f"c{i}") for i, (_, cond) in enumerate(checks)])
    pairs = ", ".join(f"'{name}', c{i}" for i, (name, _) in enumerate(checks))
    return counts.selectExpr(f"stack({len(checks)}, {pairs}) as (rule, violations)")


def upsert_days(spark: SparkSession, updates: DataFrame, table: str, time_col: str,
                key: list[str] = BAR_KEY, update_cols: list[str] = ON_CONFLICT_UPDATE,
                columns: list[str] = BAR_TABLE_COLUMNS) -> None:
    """Apply ``merge_upsert`` to a day-partitioned Parquet table in place.

    Only the day partitions that the updates touch are read, merged and
    rewritten, in four steps: the merged days are written to a staging folder;
    a journal file naming that folder is renamed into place (the commit); each
    day folder is replaced; journal and staging folder are removed.  A run that
    stops before the commit has changed nothing; one that stops after it is
    rolled forward by the next call, whose own updates then meet the whole
    table.  Re-applying the same updates gives the same table, so a retried or
    replayed micro-batch is harmless.
    """
    import uuid

    fs, root, jvm = _fs(spark, table)
    recover_days(spark, table)
    updates = updates.select(*columns)
    days = [r[0] for r in updates.select(day_of(time_col)).distinct().collect()]  # days of one batch
    if not days:
        return
    current = read_days(spark, table, updates.schema).filter(F.col("d").isin(days)).select(*columns)
    merged = merge_upsert(current, updates, key, update_cols).withColumn("d", day_of(time_col))
    name = uuid.uuid4().hex
    merged.write.partitionBy("d").parquet(f"{table}/_staging/{name}")
    Path = jvm.org.apache.hadoop.fs.Path
    draft = Path(f"{table}/_staging/{name}/_journal")
    fs.create(draft, True).close()
    _renamed(fs, draft, Path(f"{table}/_journal-{name}"))
    recover_days(spark, table)


def recover_days(spark: SparkSession, table: str) -> None:
    """Finish the replacement of days that a committed upsert has staged, and
    remove what an uncommitted one left behind.  One writer per table."""
    fs, root, jvm = _fs(spark, table)
    if not fs.exists(root):
        return
    Path = jvm.org.apache.hadoop.fs.Path
    journals = [st.getPath() for st in fs.listStatus(root) if st.getPath().getName().startswith("_journal-")]
    for journal in journals:
        staged = Path(f"{table}/_staging/{journal.getName()[len('_journal-'):]}")
        for st in fs.listStatus(staged) if fs.exists(staged) else []:
            src = st.getPath()
            if src.getName().startswith("d="):
                dst = Path(f"{table}/{src.getName()}")
                if fs.exists(dst):
                    fs.delete(dst, True)
                _renamed(fs, src, dst)
        fs.delete(staged, True)
        fs.delete(journal, False)
    staging = Path(f"{table}/_staging")
    if fs.exists(staging):
        fs.delete(staging, True)


def _renamed(fs, src, dst) -> None:
    if not fs.rename(src, dst):
        raise OSError(f"rename of {src} to {dst} failed")


def read_days(spark: SparkSession, table: str, schema) -> DataFrame:
    """A day-partitioned table with its schema given, so that a table without
    any file yet reads as empty."""
    from pyspark.sql import types as T

    full = T.StructType([f for f in schema.fields if f.name != "d"] + [T.StructField("d", T.IntegerType())])
    fs, root, _ = _fs(spark, table)
    if not fs.exists(root):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(table)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def insert_ignore_days(spark: SparkSession, batch: DataFrame, table: str, time_col: str,
                       key: list[str], columns: list[str], arrival: str = "arrival") -> None:
    """INSERT ... ON CONFLICT DO NOTHING into a Parquet table partitioned by day
    and, within it, by hour.

    Only the hours that the batch touches are listed and read for the anti-join
    (the key contains the time column, so a conflict is always in the same
    hour), their key columns alone; new rows are appended.  Of several rows of a
    key in one batch the first to arrive is taken, so a stream needs no
    de-duplication before this (one that keeps any copy would lose the order).
    Running the same batch again appends nothing, so a retried or replayed
    micro-batch is harmless.  Rows without a time go to a partition of their own
    and, as in SQL, never conflict.
    """
    from tickbars.operators.trades import first_arrivals

    fresh = first_arrivals(batch, key, arrival).select(*columns)
    hours = [r[0] for r in batch.select(hour_of(time_col)).distinct().collect()]  # hours of one batch
    old = read_hours(spark, table, hours, fresh.schema)
    if old is not None:
        fresh = fresh.join(old.select(*key), on=key, how="left_anti")
    fresh.withColumns({"d": day_of(time_col), "h": hour_of(time_col)}) \
        .write.mode("append").partitionBy("d", "h").parquet(table)


def hour_of(ms: Column | str) -> Column:
    """Partition value within a day: UTC hour number of an epoch-ms time."""
    c = F.col(ms) if isinstance(ms, str) else ms
    return F.floor(c / F.lit(HOUR_MS)).cast("int")


def hour_path(table: str, hour: int) -> str:
    return f"{table}/d={hour * HOUR_MS // DAY_MS}/h={hour}"


def read_hours(spark: SparkSession, table: str, hours: list[int], schema) -> DataFrame | None:
    """The rows of some hours of a table partitioned by day and hour; no other
    folder is listed.  None when the table has none of them."""
    fs, root, jvm = _fs(spark, table)
    there = [hour_path(table, h) for h in hours
             if h is not None and fs.exists(jvm.org.apache.hadoop.fs.Path(hour_path(table, h)))]
    return spark.read.schema(schema).parquet(*there) if there else None


def compact_hours(spark: SparkSession, table: str, hours: list[int], target_bytes: int = 128 << 20) -> list[int]:
    """Rewrite the given hours (closed ones: no writer appends to them any more)
    as files of about ``target_bytes``; returns the hours rewritten.

    An hour already at its number of files is left alone.  The new files are
    written beside the table, a journal naming the hour and its old files is
    renamed into place (the commit), then the new files move in and the old ones
    go.  A run that stops before the commit has changed nothing, one that stops
    after it is finished by the next call (``recover_hours``); between the two a
    reader may see rows twice, never too few."""
    import uuid

    fs, root, jvm = _fs(spark, table)
    Path = jvm.org.apache.hadoop.fs.Path
    recover_hours(spark, table)
    done = []
    for hour in hours:
        folder = hour_path(table, hour)
        old = [st for st in fs.listStatus(Path(folder)) if st.isFile() and _is_data(st)] if fs.exists(Path(folder)) else []
        files = max(1, -(-sum(st.getLen() for st in old) // target_bytes))
        if len(old) <= files:
            continue
        name = uuid.uuid4().hex
        staged = f"{table}/_compact/{name}"
        spark.read.parquet(folder).repartition(files).write.parquet(f"{staged}/new")
        lines = [str(hour), *[st.getPath().getName() for st in old]]
        draft = fs.create(Path(f"{staged}/draft"), True)
        draft.write(bytearray("\n".join(lines).encode()))
        draft.close()
        _renamed(fs, Path(f"{staged}/draft"), Path(f"{table}/_compacted-{name}"))
        recover_hours(spark, table)
        done.append(hour)
    return done


def recover_hours(spark: SparkSession, table: str) -> None:
    """Finish committed compactions; remove what an uncommitted one left."""
    fs, root, jvm = _fs(spark, table)
    if not fs.exists(root):
        return
    Path = jvm.org.apache.hadoop.fs.Path
    for st in fs.listStatus(root):
        journal = st.getPath()
        if not journal.getName().startswith("_compacted-"):
            continue
        stream = fs.open(journal)
        hour, *old = bytes(stream.readAllBytes()).decode().split("\n")
        stream.close()
        folder, staged = hour_path(table, int(hour)), f"{table}/_compact/{journal.getName()[len('_compacted-'):]}"
        if fs.exists(Path(f"{staged}/new")):
            for new in fs.listStatus(Path(f"{staged}/new")):
                if _is_data(new):
                    _renamed(fs, new.getPath(), Path(f"{folder}/{new.getPath().getName()}"))
        for name in old:
            fs.delete(Path(f"{folder}/{name}"), False)
        fs.delete(Path(staged), True)
        fs.delete(journal, False)
    if fs.exists(Path(f"{table}/_compact")):
        fs.delete(Path(f"{table}/_compact"), True)


def _is_data(status) -> bool:
    return not status.getPath().getName().startswith(("_", "."))


def newest_rows(spark: SparkSession, table: str, n: int, order: list[Column], where: Column | None = None) -> DataFrame:
    """The first ``n`` rows of a day-partitioned table in an order that starts
    with the newest time (O-72, O-57).  Days are read from the newest backwards,
    twice as many each time, until ``n`` rows are there; older days are neither
    listed nor opened.  Rows without a time are taken last."""
    fs, root, _ = _fs(spark, table)
    names = [st.getPath().getName() for st in fs.listStatus(root) if st.getPath().getName().startswith("d=")]
    dated = sorted((x for x in names if x[2:].lstrip("-").isdigit()), key=lambda x: -int(x[2:]))
    days = dated + [x for x in names if x not in dated]
    take = 1
    while True:
        rows = spark.read.option("basePath", table).parquet(*[f"{table}/{x}" for x in days[:take]]) if days \
            else spark.read.parquet(table)
        rows = rows if where is None else rows.filter(where)
        if take >= len(days) or rows.limit(n).count() >= n:
            return rows.drop("d", "h").orderBy(*order).limit(n)
        take *= 2


def drop_expired_days(spark: SparkSession, table: str, keep_ms: int, as_of_ms: int) -> list[int]:
    """Retention on a day-partitioned table: delete the day folders whose
    whole day ends before ``as_of - keep``, a metadata operation that reads
    no data.  Like chunk-wise retention it keeps the partly expired day;
    ``operators.trades.retain`` gives the exact row filter for reads."""
    fs, root, jvm = _fs(spark, table)
    cutoff = as_of_ms - keep_ms
    dropped = []
    if not fs.exists(root):
        return dropped
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("d="):
            day = int(name[2:])
            if (day + 1) * DAY_MS <= cutoff:
                fs.delete(st.getPath(), True)
                dropped.append(day)
    return sorted(dropped)

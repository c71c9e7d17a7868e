"""JDBC form of the two table sinks (O-52, O-53, O-54).

A batch (or micro-batch) is written in parallel to a staging table with
Spark's JDBC writer (``batchsize`` rows per round trip; a failed task is
retried by Spark), then one set-based statement moves it into the target on
the database: ``INSERT ... ON CONFLICT (key) DO UPDATE SET <cols> =
EXCLUDED.<cols>`` for the bar table, ``... DO NOTHING`` for trades.  The
statement is idempotent, so a retried batch is harmless.  PostgreSQL
syntax; the statement builders are plain functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def upsert_statement(target: str, staging: str, key: list[str], columns: list[str],
                     update_cols: list[str]) -> str:
    cols = ", ".join(columns)
    sets = ", ".join(f"{c} = EXCLUDED.{c}" for c in update_cols)
    return (f"INSERT INTO {target} ({cols}) SELECT {cols} FROM {staging} "
            f"ON CONFLICT ({', '.join(key)}) DO UPDATE SET {sets}")


def insert_ignore_statement(target: str, staging: str, key: list[str], columns: list[str]) -> str:
    cols = ", ".join(columns)
    return (f"INSERT INTO {target} ({cols}) SELECT {cols} FROM {staging} "
            f"ON CONFLICT ({', '.join(key)}) DO NOTHING")


def _execute(spark, url: str, props: dict[str, str], sql: list[str]) -> None:
    """Run statements on the driver through the JVM's JDBC driver manager."""
    jvm = spark.sparkContext._jvm
    jprops = jvm.java.util.Properties()
    for k, v in props.items():
        jprops.setProperty(k, v)
    conn = jvm.java.sql.DriverManager.getConnection(url, jprops)
    try:
        st = conn.createStatement()
        for s in sql:
            st.execute(s)
        st.close()
    finally:
        conn.close()


def write_table(df: DataFrame, url: str, target: str, key: list[str], columns: list[str],
                update_cols: list[str] | None, props: dict[str, str], staging: str,
                batchsize: int = 1000) -> None:
    """Stage ``df`` and merge it into ``target`` (upsert when ``update_cols``
    is given, insert-ignore otherwise).  ``staging`` should be unique per
    batch, e.g. ``f"{target}_stage_{batch_id}"``."""
    (df.select(*columns).write.format("jdbc").option("url", url).option("dbtable", staging)
     .option("batchsize", batchsize).options(**props).mode("overwrite").save())
    merge = (upsert_statement(target, staging, key, columns, update_cols) if update_cols
             else insert_ignore_statement(target, staging, key, columns))
    _execute(df.sparkSession, url, props, [merge, f"DROP TABLE {staging}"])


def jdbc_writer(url: str, target: str, key: list[str], columns: list[str],
                update_cols: list[str] | None, props: dict[str, str], batchsize: int = 1000):
    """foreachBatch sink for either table."""
    def write(df: DataFrame, batch_id: int) -> None:
        write_table(df, url, target, key, columns, update_cols, props,
                    f"{target}_stage_{batch_id}", batchsize)
    return write


def bar_table_rows(bars: DataFrame) -> DataFrame:
    """Bar rows in the SQL table's shape: window_start as a timestamp,
    window_end dropped."""
    from pyspark.sql import functions as F

    cols = [c for c in bars.columns if c not in ("window_start_ms", "window_end_ms")]
    return bars.select(F.timestamp_millis("window_start_ms").alias("window_start"), *cols)


def trade_table_rows(trades: DataFrame) -> DataFrame:
    """Trade rows in the SQL table's shape (timestamps for the two times)."""
    from pyspark.sql import functions as F

    return trades.select(F.timestamp_millis("trade_time_ms").alias("trade_time"), "symbol", "source",
                         "trade_id", "price", "quantity", "side",
                         F.timestamp_millis("ingestion_time_ms").alias("ingestion_time"), "latency_ms")


# Key and column lists of the SQL tables.
SQL_BAR_KEY = ["symbol", "source", "window_start"]
SQL_TRADE_KEY = ["symbol", "source", "trade_id", "trade_time"]
SQL_TRADE_COLUMNS = ["trade_time", "symbol", "source", "trade_id", "price", "quantity", "side", "ingestion_time", "latency_ms"]

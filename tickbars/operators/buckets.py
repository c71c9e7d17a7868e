"""Upsert table in day x hash-bucket folders (O-52, O-56).

A bucket of a day is one folder, ``d=<day>/p=b<bucket>v<version>``; the bucket is
a hash of the whole key, so no key is hot.  A merge reads and rewrites only the
buckets that its rows fall into.  It writes them as folders of a new version and
then creates one commit file: from then on the new folders count for all readers
at once, and the old ones go.  Nothing is renamed, so this holds on an object
store as well.

``read_buckets`` takes of every bucket the newest version up to the committed
one: a reader never misses a day or sees a row twice.  One that had listed a
folder before it went gets an error, not fewer rows.  One writer per table.
A bucket is always written whole, as files of at most ``rows_per_file`` rows, so
small files do not pile up however small the batches are.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickbars.operators import tables as TB

BUCKETS = 16
ROWS_PER_FILE = 4_000_000
_FOLDER = re.compile(r"p=b(\d+)v(\d+)")
_NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def bucket_of(key: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def _day_name(day: int | None) -> str:
    return f"d={_NO_DAY if day is None else day}"


def _folders(spark: SparkSession, table: str, days: list[str] | None = None) -> dict[tuple[str, int], dict[int, object]]:
    """(day folder, bucket) -> version -> path, of all days or of some."""
    fs, _, jvm = TB._fs(spark, table)
    found: dict[tuple[str, int], dict[int, object]] = {}
    for name in ["d=*"] if days is None else days:
        for st in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{table}/{name}/p=*")) or []:
            p = st.getPath()
            bucket, version = map(int, _FOLDER.fullmatch(p.getName()).groups())
            found.setdefault((p.getParent().getName(), bucket), {})[version] = p
    return found


def _marks(spark: SparkSession, table: str, kind: str) -> dict[int, object]:
    """Versions for which the table holds a file ``_<kind>-<version>``."""
    fs, _, jvm = TB._fs(spark, table)
    found = fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{table}/_{kind}-*")) or []
    return {int(st.getPath().getName().rsplit("-", 1)[1]): st.getPath() for st in found}


def _mark(spark: SparkSession, table: str, kind: str, version: int, lines: list[str] = ()) -> None:
    """Create a mark; its text is complete once it exists under its name."""
    fs, _, jvm = TB._fs(spark, table)
    out = fs.create(jvm.org.apache.hadoop.fs.Path(f"{table}/_{kind}-{version}"), False)
    out.write(bytearray("\n".join(lines).encode()))
    out.close()


def committed_version(spark: SparkSession, table: str) -> int:
    """The last committed version, 0 for a table without any."""
    return max(_marks(spark, table, "commit"), default=0)


def _current(spark: SparkSession, table: str, days: list[str] | None = None) -> dict[tuple[str, int], object]:
    last = committed_version(spark, table)
    found = {}
    for at, versions in _folders(spark, table, days).items():
        valid = [v for v in versions if v <= last]
        if valid:
            found[at] = versions[max(valid)]
    return found


def _read(spark: SparkSession, paths: list, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(*[p.toString() for p in paths]) if paths else spark.createDataFrame([], schema)


def read_buckets(spark: SparkSession, table: str, schema: T.StructType, days: list[int] | None = None) -> DataFrame:
    """The committed rows of the table, of all days or of the days given (no
    other day is listed).  A table that is not there yet reads as empty."""
    names = None if days is None else [_day_name(d) for d in days]
    return _read(spark, list(_current(spark, table, names).values()), schema)


def upsert_buckets(spark: SparkSession, updates: DataFrame, table: str, time_col: str, buckets: int = BUCKETS,
                   key: list[str] = TB.BAR_KEY, update_cols: list[str] = TB.ON_CONFLICT_UPDATE,
                   columns: list[str] = TB.BAR_TABLE_COLUMNS, rows_per_file: int = ROWS_PER_FILE) -> list[tuple[str, int]]:
    """Apply ``merge_upsert`` to the table; returns the (day folder, bucket) pairs
    rewritten.

    ``updates`` hold a key once and no null in it (the constraints of the table);
    they are read twice, so a caller persists them.  Applying the same updates
    again gives the same table: a retried or replayed micro-batch is harmless.  A
    run that stops before the commit file has changed nothing, one that stops
    after it has done all but remove old folders; either is cleared up by the next
    call.  The number of buckets is fixed by the first call.
    """
    recover_buckets(spark, table)
    fixed = _marks(spark, table, "buckets")
    if fixed and buckets not in fixed:
        raise ValueError(f"{table} has {min(fixed)} buckets, not {buckets}")
    updates = updates.select(*columns)
    at = [TB.day_of(time_col).alias("d"), bucket_of(key, buckets).alias("b")]
    touched = [(_day_name(r.d), r.b) for r in updates.select(*at).distinct().collect()]  # at most days x buckets of a batch
    if not touched:
        return []
    if not fixed:
        _mark(spark, table, "buckets", buckets)
    days = sorted({d for d, _ in touched})
    there = _current(spark, table, days)
    current = _read(spark, [there[x] for x in touched if x in there], updates.schema)
    version = committed_version(spark, table) + 1
    _mark(spark, table, "writing", version, days)
    (TB.merge_upsert(current, updates, key, update_cols).select(*columns, *at).repartition("d", "b")
     .select(*columns, "d", F.concat(F.lit("b"), "b", F.lit(f"v{version}")).alias("p"))
     .write.mode("append").option("maxRecordsPerFile", rows_per_file).partitionBy("d", "p").parquet(table))
    _mark(spark, table, "commit", version)
    recover_buckets(spark, table)
    return sorted(touched)


def recover_buckets(spark: SparkSession, table: str) -> None:
    """Remove the folders that a committed merge has replaced, or those that an
    uncommitted one left; then their marks and all but the last commit file."""
    fs, _, _ = TB._fs(spark, table)
    writing = _marks(spark, table, "writing")
    if not writing:
        return
    last = committed_version(spark, table)
    for version, mark in sorted(writing.items()):
        stream = fs.open(mark)
        days = bytes(stream.readAllBytes()).decode().split("\n")
        stream.close()
        for versions in _folders(spark, table, days).values():
            newest = max((v for v in versions if v <= last), default=0)
            for v, path in versions.items():
                if v != newest:
                    fs.delete(path, True)
        fs.delete(mark, False)
    for version, mark in _marks(spark, table, "commit").items():
        if version < last:
            fs.delete(mark, False)

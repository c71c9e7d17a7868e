"""Helpers shared by the corpus operators.

Words are runs outside ``[\\x20\\x09-\\x0D]``: exactly what ``bytes.split()``
gives on UTF-8 text, so texts travel to Python as binary columns and are
never decoded unless code points are needed.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickbars import session as S

#: Rows per Arrow batch: bounds a Python worker's memory when texts are long.
BATCH_ROWS = 1000
#: Words a worker remembers the hash of; past this the memory is emptied.
WORD_MEMORY = 150_000
#: Buckets of the bitmap that tells which rows may have one of some keys (bound of a broadcast).
KEY_BUCKETS = 1 << 24


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of the operators; makes the package importable in workers."""
    S.configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    S.ship_package(spark)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(col: str = "text"):
    """UTF-8 bytes of a text column; a null text is an empty one."""
    return F.coalesce(F.col(col).cast("binary"), F.lit(b"").cast("binary"))


def split_by_keys(docs: DataFrame, key: Column, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of ``docs`` that may have one of the ``keys``, rows that have none),
    told by a bitmap of hashed keys, so the others need no shuffle.  A null key
    is none of them.  ``keys`` is a stored table of one column."""
    bucket = lambda c: F.pmod(F.xxhash64(c), F.lit(KEY_BUCKETS))
    words = keys.select(bucket(F.col(keys.columns[0])).alias("b")).groupBy(
        F.shiftright("b", 6).alias("__word")).agg(F.bit_or(F.expr("shiftleft(1L, int(b & 63))")).alias("__bits"))
    marked = docs.withColumn("__bucket", bucket(key)).join(
        F.broadcast(words), F.shiftright("__bucket", 6) == F.col("__word"), "left")
    may = F.coalesce(F.expr("getbit(__bits, int(__bucket & 63)) = 1"), F.lit(False)) & key.isNotNull()
    return marked.filter(may).select(*docs.columns), marked.filter(~may).select(*docs.columns)


#: What operators remember in this worker from batch to batch, by name.
_REMEMBERED: dict[str, dict] = {}


def remembered(name: str, memory: dict) -> dict:
    _REMEMBERED[name] = memory
    return memory


def only(name: str | None = None) -> None:
    """Empties what operators other than ``name`` remember in this worker."""
    others = [m for k, m in _REMEMBERED.items() if k != name and m]
    for m in others:
        m.clear()
    if others:
        give_back()


def give_back() -> None:
    """Hands memory that is free inside the process back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def in_turn(run, name: str | None = None):
    """``run``, a function for mapInArrow, that shares its worker with no other
    operator's memory.  Workers outlive a stage: what the tasks of one operator
    remember would else stay beside the memory of all later ones.  The memories
    are told by name, since a task's closure holds copies of objects."""
    def turn(batches):
        only(name)
        try:
            yield from run(batches)
        finally:
            give_back()
    return turn


class WordHashes(dict):
    """word (bytes) -> 64-bit hash, remembered per worker."""

    def __missing__(self, word):
        if len(self) >= WORD_MEMORY:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


WORD_HASHES = remembered("word hashes", WordHashes())

# Odd multipliers of the window hash (fixed values; any odd 64-bit numbers do).
_MULT = [np.uint64(x) for x in (
    0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5,
    0x85EBCA77C2B2AE63, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser: spreads every input bit over the whole word."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def window_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of every window of ``width`` consecutive word hashes."""
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out += h[k:k + n] * _MULT[k]
    return mix(out)


def signed(h: int) -> int:
    """Unsigned 64-bit hash as Spark's long."""
    return h - (1 << 64) if h >= 1 << 63 else h

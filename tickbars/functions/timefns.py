"""Epoch-millisecond helpers (O-25)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def epoch_ms(df: DataFrame, name: str) -> Column:
    """Epoch ms of a timestamp column, independent of the session time zone
    for TIMESTAMP_NTZ (read as UTC wall clock)."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{name}`)")
    return F.unix_millis(F.col(name))


def ms_to_ts(c: Column | str) -> Column:
    return F.timestamp_millis(F.col(c) if isinstance(c, str) else c)


#: Instant text: date, T, time to the second, optional fraction, zone.
INSTANT = r"(?i)^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{0,9})?(Z|[+-]\d{2}:\d{2})$"


def iso_to_ms(c: Column | str) -> Column:
    """ISO-8601 instant text -> epoch ms; null when empty or not an instant.
    A bare date, a year or a time without a zone is no instant: Spark's own
    parser would fill in what is missing."""
    s = F.col(c) if isinstance(c, str) else c
    return F.when(s.rlike(INSTANT), F.unix_millis(F.try_to_timestamp(F.upper(s))))


def floor_to(c: Column | str, step_ms: int) -> Column:
    """Epoch-aligned floor, correct for negative times as well."""
    t = F.col(c) if isinstance(c, str) else c
    return t - F.pmod(t, F.lit(step_ms))

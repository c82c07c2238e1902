"""Record type and column mapping.

The reference works on one record type, a sensor reading
``(id string, timestamp bigint epoch seconds, temperature double)``.
Our operators never hard-code those names: they take a :class:`Cols`
mapping, so the fixture and the ``events`` table share all code.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

READING_SCHEMA = T.StructType([
    T.StructField("id", T.StringType(), True),
    T.StructField("timestamp", T.LongType(), True),
    T.StructField("temperature", T.DoubleType(), True),
])

LINE_SCHEMA = T.StructType([T.StructField("value", T.StringType(), True)])


@dataclass(frozen=True)
class Cols:
    """Names of the key, event-time, value and arrival-order columns."""

    key: str = "id"
    time: str = "timestamp"
    value: str = "temperature"
    order: str = "seq"


FIXTURE = Cols()
EVENTS = Cols(key="user_id", time="ts", value="value", order="event_id")


def event_time(df: DataFrame, name: str) -> Column:
    """The event-time column as a zoned TIMESTAMP (what ``withWatermark`` and
    ``window`` need). Epoch-second integers are converted, TIMESTAMP_NTZ is cast
    (the session time zone is UTC, so the wall clock is unchanged)."""
    dt = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dt, (T.LongType, T.IntegerType, T.ShortType)):
        return F.timestamp_seconds(c)
    if isinstance(dt, T.TimestampType):
        return c
    return c.cast("timestamp")


def as_ntz(c: Column) -> Column:
    """Zoned timestamp → TIMESTAMP_NTZ for output (matches DuckDB's TIMESTAMP)."""
    return c.cast("timestamp_ntz")


_UNIT_US = {"microsecond": 1, "millisecond": 1000, "second": 1_000_000, "minute": 60_000_000,
            "hour": 3_600_000_000, "day": 86_400_000_000, "week": 604_800_000_000}


def duration_us(size: str) -> int:
    """``"6 hours"`` → microseconds (fixed-length units only)."""
    n, unit = size.split()
    return int(float(n) * _UNIT_US[unit.lower().rstrip("s")])


def tumble_end(et: Column, size: str) -> Column:
    """End of the epoch-aligned tumbling window holding ``et`` (a TIMESTAMP),
    computed arithmetically: unlike ``window()``, it adds no not-null filter,
    so rows without an event time are kept (with a null window)."""
    us = duration_us(size)
    return F.timestamp_micros((F.floor(F.unix_micros(et) / F.lit(us)) + 1) * F.lit(us))

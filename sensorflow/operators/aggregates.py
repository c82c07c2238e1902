"""Grouped aggregates: word count (A-1), count/avg per key (A-5), latest per key (SNK-3 core).

All are ``groupBy().agg()`` with built-in aggregates, so Spark runs a
map-side partial aggregate before the shuffle: a hot key sends one partial
row per input partition, not its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.functions.text import java_split


def words(df: DataFrame, col: str, sep: str = " ", keep: list[str] | None = None,
          pos: str | None = None, name: str = "word") -> DataFrame:
    """Tokens of Java ``split(sep)`` (empty tokens between separators kept)."""
    keep = keep or []
    if pos:
        return df.select(*keep, F.posexplode(java_split(col, sep)).alias(pos, name))
    return df.select(*keep, F.explode(java_split(col, sep)).alias(name))


def word_count(df: DataFrame, col: str, sep: str = " ") -> DataFrame:
    """``flatMap(line -> (word, 1)).groupBy(0).sum(1)``."""
    return words(df, col, sep).groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


def mean(value: str, sum_digits: int | None = None):
    """``avg(value)``; with ``sum_digits`` the sum is rounded before dividing, so
    an average whose exact value is a rounding tie (e.g. over 32 rows) does not
    depend on summation order (which differs between plans and engines)."""
    if sum_digits is None:
        return F.avg(F.col(value))
    return F.round(F.sum(F.col(value)), sum_digits) / F.count(F.col(value))


def count_avg(df: DataFrame, key: str, value: str, sum_digits: int | None = None) -> DataFrame:
    """``groupBy(id).select(id, id.count, temperature.avg)`` (null-skipping)."""
    return df.groupBy(key).agg(F.count(F.col(key)).alias("cnt"),
                               mean(value, sum_digits).alias("avg_value"))


def latest_per_key(df: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """The value of the last row per key by ``order`` (what a keyed upsert leaves behind)."""
    return df.groupBy(key).agg(F.max_by(F.col(value), F.col(order)).alias(value),
                               F.max(F.col(order)).alias(order))

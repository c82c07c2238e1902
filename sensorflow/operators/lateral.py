"""Lateral (cross-apply) join with a table function: J-1, J-2, UDF-2.

The reference's table function ``split(sep)`` emits ``(word, length)`` per
part of a string. The hot path is built in (``posexplode`` of a Java-style
split, an inner lateral join: rows with no output disappear). A Python UDTF
with the same contract is provided for SQL users who want the function by
name; it is the slow path and is not used by the registered queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorflow.functions.text import java_split, utf16_length


def lateral_split(df: DataFrame, col: str, sep: str, keep: list[str],
                  word: str = "word", length: str = "length") -> DataFrame:
    """``joinLateral(split(col) as (word, length))``: one row per part."""
    parts = df.select(*keep, F.posexplode(java_split(col, sep)).alias("pos", word))
    return parts.withColumn(length, utf16_length(word))


def register_split_udtf(spark: SparkSession, name: str = "split_words") -> None:
    """Register ``name(str, sep)`` as a SQL table function returning ``(word, length)``."""
    import re

    from pyspark.sql.functions import udtf

    @udtf(returnType="word string, length int")
    class SplitWords:
        def eval(self, s: str, sep: str):
            if s is None:
                return
            parts = [""] if s == "" else re.split(sep, s)
            while len(parts) > 1 and parts[-1] == "":
                parts.pop()
            if s != "" and parts == [""]:
                parts = []
            for p in parts:
                yield p, len(p.encode("utf-16-le")) // 2

    spark.udtf.register(name, SplitWords)

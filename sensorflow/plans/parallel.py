"""Input parallelism.

A table stored as one Parquet row group is read by one task, and all
narrow work before the first shuffle (splitting and exploding text, say)
runs in that task. :func:`spread` hash-partitions such an input. It acts only
when asked to, by its argument or by the session setting
``spark.sensorflow.inputSpread``; a table of many files needs no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


SETTING = "spark.sensorflow.inputSpread"


def spread(df: DataFrame, *by: str, partitions: int | None = None) -> DataFrame:
    """``df`` in ``partitions`` partitions (default: the session setting; unset or 0 leaves it as it is)."""
    n = partitions if partitions is not None else int(df.sparkSession.conf.get(SETTING, "0"))
    if not n:
        return df
    return df.repartition(n, *by) if by else df.repartition(n)

"""Time windows, count windows and row-frame (OVER) windows: W-1 … W-4, W-6 … W-9.

Tumbling windows are a ``groupBy(key, window(ts, size))``: partial
aggregation runs map-side, so a hot key costs one partial row per input
partition. Count and row-frame windows never sort a whole key in one task:
they use the segments with leading copies of :mod:`sensorflow.plans.scan`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorflow.functions.fold import Fold, fold_by
from sensorflow.plans.scan import BASE, HALO, with_halo
from sensorflow.schema import as_ntz, event_time


def tumble(df: DataFrame, key: str, time: str, size: str, aggs: list[Column]) -> DataFrame:
    """Tumbling event-time window aggregate with ``window_start``/``window_end``
    flattened to TIMESTAMP_NTZ. Windows are epoch aligned, ``[start, end)``."""
    w = F.window(event_time(df, time), size)
    g = df.groupBy(F.col(key), w.alias("_sf_w")).agg(*aggs)
    rest = [c for c in g.columns if c not in (key, "_sf_w")]
    return g.select(F.col(key), as_ntz(F.col("_sf_w.start")).alias("window_start"),
                    as_ntz(F.col("_sf_w.end")).alias("window_end"), *rest)


def tumble_count(df: DataFrame, key: str, time: str, size: str) -> DataFrame:
    """``timeWindow(size).aggregate(count)`` (W-1), keeping key and window."""
    return tumble(df, key, time, size, [F.count(F.lit(1)).alias("cnt")])


def tumble_count_avg(df: DataFrame, key: str, time: str, value: str, size: str,
                     sum_digits: int | None = None) -> DataFrame:
    """Table/SQL group window: count and mean per key and window (W-6, W-7)."""
    from sensorflow.operators.aggregates import mean
    return tumble(df, key, time, size, [F.count(F.col(key)).alias("cnt"),
                                        mean(value, sum_digits).alias("avg_value")])


def tumble_fold(df: DataFrame, key: str, time: str, size: str, fold: Fold,
                inputs: list[str]) -> DataFrame:
    """A user fold per key and tumbling window (W-2 / UDF-4): the full-window
    function contract, run as map-side partial fold + merge (never a whole
    window in one Python call)."""
    w = F.window(event_time(df, time), size)
    keyed = df.select(F.col(key), as_ntz(w.end).alias("window_end"), *[F.col(c) for c in inputs])
    return fold_by(keyed, [key, "window_end"], fold, inputs)


def tumble_apply_rows(df: DataFrame, key: str, time: str, size: str, fn, schema: str) -> DataFrame:
    """``timeWindow(size).apply(fn)`` over all rows of a window (W-2): ``fn(rows)``
    gets one key's rows of one window as a pandas frame, with ``window_end``,
    and returns rows of ``schema``.

    One task holds one window of one key, as the contract asks; a result that
    can be merged belongs in :func:`tumble_fold`.
    """
    w = F.window(event_time(df, time), size)
    return df.withColumn("window_end", as_ntz(w.end)).groupBy(key, "window_end").applyInPandas(fn, schema)


def window_min_by(df: DataFrame, key: str, time: str, size: str, value: str, order: str) -> DataFrame:
    """``timeWindow(size).minBy(value)`` (W-4): the record with the smallest
    value per key and window, first record on ties, plus the window's count."""
    rec = F.struct(F.col(value).alias("v"), F.col(order).alias("o"), F.col(time).alias("t"))
    g = tumble(df, key, time, size, [F.min(rec).alias("_sf_min"), F.count(F.lit(1)).alias("cnt")])
    return g.select(key, "window_start", "window_end", "cnt",
                    F.col("_sf_min.v").alias(f"min_{value}"),
                    F.col("_sf_min.o").alias(f"min_{order}"),
                    F.col("_sf_min.t").alias(f"min_{time}"))


def count_window_avg(df: DataFrame, key: str, order: str, value: str, size: int = 5,
                     slide: int = 2, segments=None) -> DataFrame:
    """``countWindow(size, slide).aggregate(avg)`` (W-3).

    A key's window fires on every ``slide``-th row over its last ``size``
    rows (sizes 2, 4, 5, 5, … for (5, 2)); a trailing partial slide never
    fires. A row's position in its key is its position in its segment plus
    the rows of the key before the segment.
    """
    rows, part = with_halo(df, [key], [order], [value], size - 1, segments)
    w = Window.partitionBy(*part).orderBy(F.col(order).asc())
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    frame = w.rowsBetween(-(size - 1), Window.currentRow)
    rn = F.coalesce(F.max(BASE).over(so_far), F.lit(0)) + F.sum(F.when(F.col(HALO), 0).otherwise(1)).over(so_far)
    out = rows.withColumns({"_sf_rn": rn, "n": F.count(F.lit(1)).over(frame), "avg_value": F.avg(F.col(value)).over(frame)})
    return out.where(~F.col(HALO) & (F.col("_sf_rn") % slide == 0)).select(key, order, "n", "avg_value")


def over_rows(df: DataFrame, key: str, order: list[str], value: str, preceding: int = 2,
              carry: list[str] | None = None, segments=None) -> DataFrame:
    """``OVER (PARTITION BY key ORDER BY order ROWS BETWEEN n PRECEDING AND
    CURRENT ROW)`` with ``count`` and ``avg`` (W-8, W-9), skew-safe.

    ``order`` is usually ``[event_time, seq]``; segments cut on its first
    column, so they are monotone in the full order.
    """
    cols = list(dict.fromkeys([*order, *(carry or [])]))
    rows, part = with_halo(df, [key], order, [*cols, value], preceding, segments)
    frame = (Window.partitionBy(*part).orderBy(*[F.col(o).asc() for o in order])
             .rowsBetween(-preceding, Window.currentRow))
    out = rows.withColumns({"cnt": F.count(F.col(key)).over(frame), "avg_value": F.avg(F.col(value)).over(frame)})
    return out.where(~F.col(HALO)).select(key, *cols, "cnt", "avg_value")

"""Rolling (per-record) keyed aggregates: A-2, A-3, A-4, A-6, F-1, F-2.

The reference emits one output per input record, in arrival order within a
key. Arrival order is an explicit column here (``order``), and every running
value comes from the skew-safe segmented scan in :mod:`sensorflow.plans.scan`.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorflow.plans.prefix import Merge, prefix_scan
from sensorflow.plans.scan import Run, count_of_rows, scan

_CHANGE_TYPE = "array<struct<change_seq:int,is_insert:boolean,cnt:bigint,avg_value:double>>"


def running_count(df: DataFrame, keys: list[str], order: list[str], name: str = "cnt",
                  segments=None, rows: Callable[[DataFrame, list[str]], DataFrame] | None = None) -> DataFrame:
    """1, 2, 3 … per key in order (keyed ValueState counter, F-1); with
    ``keys=[]`` a global count over all rows (operator-state counter, F-2).

    With ``rows``, a function of (frame, columns to keep), it counts the rows
    that this makes of each row of ``df``; ``df`` is shuffled, they are not."""
    if rows is not None:
        return count_of_rows(df, rows, keys, order, name, segments)
    return scan(df, keys, order, [Run(name, "count")], segments)


def rolling_max_by(df: DataFrame, key: str, order: str, value: str, carry: list[str],
                   prefix: str = "max_", segments=None) -> DataFrame:
    """``keyBy(key).maxBy(value)``: for every row, the whole record holding the
    largest ``value`` so far; on ties the earlier record wins.

    The record is a struct ordered by ``(value, -order)``, so ``max`` picks the
    largest value and, among equal values, the smallest order.
    """
    rec = F.struct(F.col(value).alias("v"), (-F.col(order)).alias("neg"),
                   *[F.col(c).alias(c) for c in carry])
    out = scan(df, [key], [order], [Run("_sf_best", "max", rec)], segments)
    return out.select(
        *[c for c in df.columns],
        F.col("_sf_best.v").alias(f"{prefix}{value}"),
        (-F.col("_sf_best.neg")).alias(f"{prefix}{order}"),
        *[F.col(f"_sf_best.{c}").alias(f"{prefix}{c}") for c in carry])


def rolling_reduce_max(df: DataFrame, key: str, order: str, value: str,
                       name: str = "max_value", segments=None) -> DataFrame:
    """``reduce((acc, new) -> (acc.id, new.timestamp, max(acc.t, new.t)))``:
    the running maximum next to the current row's own fields."""
    return scan(df, [key], [order], [Run(name, "max", F.col(value))], segments)


def rolling_reduce(df: DataFrame, key: str, order: str, fields: dict[str, tuple[str, str]], segments=None) -> DataFrame:
    """``keyBy(key).reduce(f)`` for a reduce that merges field by field (A-4).

    ``fields`` maps a result column to ``(kind, input column)``, kind one of
    count, sum, max, min; the row's own columns stay next to them. The merges
    are associative, so the scan needs no key in one place.
    """
    runs = [Run(name, kind, F.col(col)) for name, (kind, col) in fields.items()]
    return scan(df, [key], [order], runs, segments)


def rolling_reduce_by(df: DataFrame, key: str, order: str, start: dict[str, Column], merge: Merge, segments=None,
                      n_segments: int | None = None) -> DataFrame:
    """``keyBy(key).reduce(f)`` for any associative ``f`` (A-4): a value next to every row.

    ``start`` gives a row's own accumulator columns, ``merge(left, right)`` takes two pandas frames of them (row by row
    the earlier and the later part) and returns the merged ones. It may use all fields together and need not commute.
    """
    return prefix_scan(df.withColumns(start), key, order, list(start), merge, segments, n_segments)


def best_stretch(name: str, value: Column) -> tuple[dict[str, Column], Merge]:
    """A reduce that is not field by field: the largest sum of consecutive rows so far, as ``name`` (whole numbers).

    A part is told by its total, its best beginning, its best ending and its best stretch; a stretch of the whole lies
    in one part or is an ending of the left with a beginning of the right.
    """
    fields = [f"{name}_total", f"{name}_begin", f"{name}_end", name]
    t, b, e, s = fields

    def merge(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({t: left[t] + right[t], b: np.maximum(left[b], left[t] + right[b]), e: np.maximum(right[e], right[t] + left[e]),
                             s: np.maximum(np.maximum(left[s], right[s]), left[e] + right[b])})
    return {f: value.cast("bigint") for f in fields}, merge


def changelog(df: DataFrame, key: str, order: str, value: str, segments=None,
              with_count: bool = True, sum_digits: int | None = None) -> DataFrame:
    """Retract/insert changelog of ``count(key), avg(value)`` per key (A-6).

    For the first row of a key: one insert. Later rows: a retraction of the
    previous result, then an insert of the new one; nothing if the result is
    unchanged. ``sum_digits`` rounds the running sum before dividing. Output columns: ``change_seq`` (0 retract, 1 insert within the
    input row), ``is_insert`` and the aggregate values.
    """
    runs = [Run("_n1", "count", F.col(key)), Run("_c1", "count", F.col(value)),
            Run("_s1", "sum", F.col(value)),
            Run("_n0", "count", F.col(key), inclusive=False),
            Run("_c0", "count", F.col(value), inclusive=False),
            Run("_s0", "sum", F.col(value), inclusive=False)]
    s = scan(df, [key], [order], runs, segments)
    s1, s0 = F.col("_s1"), F.col("_s0")
    if sum_digits is not None:
        # Running sums differ in the last bits with summation order; rounding
        # the sum first makes averages whose exact value is a rounding tie
        # (e.g. 32 rows) come out the same in every engine.
        s1, s0 = F.round(s1, sum_digits), F.round(s0, sum_digits)
    new_avg = F.when(F.col("_c1") > 0, s1 / F.col("_c1"))
    old_avg = F.when(F.col("_c0") > 0, s0 / F.col("_c0"))
    new = F.struct(F.lit(1).alias("change_seq"), F.lit(True).alias("is_insert"),
                   F.col("_n1").alias("cnt"), new_avg.alias("avg_value"))
    old = F.struct(F.lit(0).alias("change_seq"), F.lit(False).alias("is_insert"),
                   F.col("_n0").alias("cnt"), old_avg.alias("avg_value"))
    if with_count:
        same = (F.col("_n0") == F.col("_n1")) & old_avg.eqNullSafe(new_avg)
    else:
        same = old_avg.eqNullSafe(new_avg)
    changes = (F.when(F.col("_n0") == 0, F.array(new))
               .when(same, F.array().cast(_CHANGE_TYPE))
               .otherwise(F.array(old, new)))
    out = s.select(F.col(key), F.col(order), F.explode(changes).alias("_ch"))
    cols = [F.col(key), F.col(order), F.col("_ch.change_seq"), F.col("_ch.is_insert"),
            F.col("_ch.avg_value")]
    if with_count:
        cols.insert(4, F.col("_ch.cnt"))
    return out.select(*cols)

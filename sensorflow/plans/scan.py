"""Skew-safe running aggregates over an ordered, keyed DataFrame.

``Window.partitionBy(key).orderBy(seq)`` sends every row of a key to one
task; if one key holds a third of 100 TB that task never finishes. Running
aggregates that are associative (count, sum, max, min, and "last row" as a
max over a struct that leads with the order columns) are instead computed in
three steps, which is the classic two-level prefix sum:

1. Rows get a *segment*: a bucket of the first order column, cut at
   approximate quantiles so every segment holds about the same number of
   rows overall (a hot key spreads over all segments).
2. Local running aggregates per ``(key, segment)`` with a window; that
   window's hash exchange on ``(key, segment)`` is the only full shuffle.
3. Per ``(key, segment)`` totals (partial aggregation, one row per group),
   prefix-combined over the segments of a key by a window on that small
   table, joined back on ``(key, segment)``: the big side keeps its
   partitioning, and AQE broadcasts the carry table only when its measured
   size is under the broadcast threshold.

Where one input row makes many scanned rows (the words of a text),
:func:`count_of_rows` deals the input rows by segment and makes the rows
afterwards: they are never shuffled, and the carries come in as rows of the
same window instead of by a join.

Bounded row frames (``n`` preceding rows) are windows per ``(key, segment)``
over the segment's rows and copies of the last ``n`` rows before it.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEG = "_sf_seg"
_ORD = "_sf_ord"
#: Most segments of a scan, so the quantile summary on the driver has the same bound at any size.
MAX_SEGMENTS = 4096


@dataclass(frozen=True)
class Run:
    """One running aggregate. ``kind``: count | sum | max | min.

    ``reverse=True`` scans from the end (a suffix aggregate over the rows
    after the current one); ``inclusive=False`` leaves the current row out.
    ``expr=None`` with ``kind='count'`` counts rows.
    """

    name: str
    kind: str
    expr: Column | None = None
    reverse: bool = False
    inclusive: bool = True


def default_segments(df: DataFrame) -> int:
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return min(MAX_SEGMENTS, max(4, 4 * parts))


def _numeric(df: DataFrame, name: str) -> Column:
    dt = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    if isinstance(dt, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(dt, T.StringType):  # the first six bytes keep the order
        return F.conv(F.rpad(F.hex(F.substring(c.cast("binary"), 1, 6)), 12, "0"), 16, 10).cast("double")
    return c.cast("double")


def quantile_bounds(df: DataFrame, name: str, n_segments: int | None = None) -> list[float]:
    """Approximate ``n_segments``-quantiles of a column (a small driver-side list:
    its length is the segment count, never the data size)."""
    n = n_segments or default_segments(df)
    if n <= 1:
        return []
    probe = df.select(_numeric(df, name).alias(_ORD))
    qs = probe.approxQuantile(_ORD, [i / n for i in range(1, n)], 1.0 / (4 * n))
    return sorted({q for q in qs if q is not None and math.isfinite(q)})


def with_segments(df: DataFrame, order_col: str, segments=None,
                  n_segments: int | None = None) -> DataFrame:
    """Add the segment column ``SEG``.

    ``segments`` may be a Column (any expression monotone in the order),
    a list of quantile boundaries, or None to compute boundaries from ``df``.
    """
    if isinstance(segments, Column):
        return df.withColumn(SEG, segments.cast("bigint"))
    bounds = segments if segments is not None else quantile_bounds(df, order_col, n_segments)
    if not bounds:
        return df.withColumn(SEG, F.lit(0).cast("bigint"))
    from pyspark.ml.feature import Bucketizer

    tmp = df.withColumn(_ORD, F.coalesce(_numeric(df, order_col), F.lit(float("nan"))))
    b = Bucketizer(splits=[-math.inf, *bounds, math.inf], inputCol=_ORD, outputCol=SEG,
                   handleInvalid="keep")
    # null order values come first, as in a window
    seg = F.when(F.col(order_col).isNull(), F.lit(-1)).otherwise(F.col(SEG)).cast("bigint")
    return b.transform(tmp).withColumn(SEG, seg).drop(_ORD)


def _local(kind: str, c: Column) -> Column:
    return {"count": F.count, "sum": F.sum, "max": F.max, "min": F.min}[kind](c)


def _carry(kind: str, c: Column) -> Column:
    return {"count": F.sum, "sum": F.sum, "max": F.max, "min": F.min}[kind](c)


def _combine(kind: str, carry: Column, local: Column) -> Column:
    if kind == "count":
        return (F.coalesce(carry, F.lit(0)) + F.coalesce(local, F.lit(0))).cast("bigint")
    if kind == "sum":
        return F.when(carry.isNull(), local).when(local.isNull(), carry).otherwise(carry + local)
    if kind == "max":
        return F.greatest(carry, local)
    return F.least(carry, local)


def _zero(dt: T.DataType):
    if isinstance(dt, T.StringType):
        return F.lit("")
    if isinstance(dt, T.BooleanType):
        return F.lit(False)
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.lit(0).cast("timestamp").cast(dt)
    if isinstance(dt, T.BinaryType):
        return F.lit(bytearray())
    return F.lit(0).cast(dt)


def scan(df: DataFrame, keys: list[str], order: list[str], runs: list[Run],
         segments=None, n_segments: int | None = None) -> DataFrame:
    """Add one column per :class:`Run`, computed in key/order sequence."""
    sdf = with_segments(df, order[0], segments, n_segments).withColumn(
        SEG, F.coalesce(F.col(SEG), F.lit(-1).cast("bigint")))
    # Keys as (value-or-zero, is-null) column pairs: null keys form their own
    # group (as in a window) and the carry join is a plain equi-join on the
    # very columns the window is hash-partitioned by, so the big side is
    # never shuffled a second time.
    kcols = []
    for k in keys:
        sdf = (sdf.withColumn(f"_sf_kv_{k}", F.coalesce(F.col(k), _zero(df.schema[k].dataType)))
               .withColumn(f"_sf_kn_{k}", F.col(k).isNull()))
        kcols += [f"_sf_kv_{k}", f"_sf_kn_{k}"]
    keys = kcols
    part = [*keys, SEG]
    for r in runs:
        sdf = sdf.withColumn(f"_sf_in_{r.name}", r.expr if r.expr is not None else F.lit(1))

    fwd = Window.partitionBy(*part).orderBy(*[F.col(o).asc() for o in order])
    bwd = Window.partitionBy(*part).orderBy(*[F.col(o).desc() for o in order])
    local = sdf
    for r in runs:
        w = bwd if r.reverse else fwd
        end = Window.currentRow if r.inclusive else -1
        local = local.withColumn(
            f"_sf_l_{r.name}",
            _local(r.kind, F.col(f"_sf_in_{r.name}")).over(w.rowsBetween(Window.unboundedPreceding, end)))

    # Totals per (key, segment): a map-side combined aggregate, so its shuffle
    # carries one row per group and input partition (Catalyst reads the
    # source columns again rather than the windowed rows).
    totals = sdf.groupBy(*part).agg(
        *[_local(r.kind, F.col(f"_sf_in_{r.name}")).alias(f"_sf_t_{r.name}") for r in runs])
    ws = (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy(SEG)
    carries = totals.select(*part, *[
        _carry(r.kind, F.col(f"_sf_t_{r.name}")).over(
            ws.rowsBetween(1, Window.unboundedFollowing) if r.reverse
            else ws.rowsBetween(Window.unboundedPreceding, -1)).alias(f"_sf_c_{r.name}")
        for r in runs])

    out = local.join(carries, part, "inner")
    for r in runs:
        out = out.withColumn(r.name, _combine(r.kind, F.col(f"_sf_c_{r.name}"), F.col(f"_sf_l_{r.name}")))
    tmp = [SEG, *kcols] + [f"_sf_{p}_{r.name}" for r in runs for p in ("in", "l", "c")]
    return out.drop(*tmp)


def row_number(df: DataFrame, keys: list[str], order: list[str], name: str = "rn",
               segments=None, n_segments: int | None = None) -> DataFrame:
    """1-based position of each row within its key, by ``order`` (skew-safe)."""
    return scan(df, keys, order, [Run(name, "count")], segments, n_segments)


def count_of_rows(df: DataFrame, rows: Callable[[DataFrame, list[str]], DataFrame], keys: list[str], order: list[str],
                  name: str = "cnt", segments=None, n_segments: int | None = None) -> DataFrame:
    """1, 2, 3 … per key in order, of the rows that ``rows(df, keep)`` makes of each row of ``df`` alone.

    ``order[0]`` is a column of ``df`` that its rows carry on; ``keep`` are columns that ``rows`` has to carry on as well.
    Every segment's own counts lead the later segments' rows as one row per key and segment.
    """
    if segments is None:
        segments = quantile_bounds(df, order[0], n_segments)
    n = default_segments(df) if isinstance(segments, Column) else len(segments) + 1
    dealt = with_segments(df, order[0], segments).withColumn(SEG, F.coalesce(F.col(SEG), F.lit(-1).cast("bigint"))).repartition(n, SEG)
    made = rows(dealt, [SEG])
    cols = [c for c in made.columns if c != SEG]
    totals = made.groupBy(*keys, SEG).agg(F.count(F.lit(1)).alias("_sf_t"))
    before = (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy(SEG).rowsBetween(Window.unboundedPreceding, -1)
    carries = (totals.select(*keys, SEG, F.sum("_sf_t").over(before).alias("_sf_n")).where("_sf_n is not null").repartition(n, SEG)
               .select(SEG, F.lit(0).alias("_sf_own"), "_sf_n",
                       *[F.col(c) if c in keys else F.lit(None).cast(made.schema[c].dataType).alias(c) for c in cols]))
    # both sides are dealt by segment, so the window needs no shuffle
    both = made.select(SEG, F.lit(1).alias("_sf_own"), F.lit(1).cast("bigint").alias("_sf_n"), *cols).unionByName(carries)
    upto = (Window.partitionBy(*keys, SEG).orderBy("_sf_own", *[F.col(o).asc() for o in order])
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return both.withColumn(name, F.sum("_sf_n").over(upto)).where("_sf_own = 1").select(*cols, name)


HALO = "_sf_halo"
BASE = "_sf_base"


def with_halo(df: DataFrame, keys: list[str], order: list[str], cols: list[str], preceding: int,
              segments=None, n_segments: int | None = None) -> tuple[DataFrame, list[str]]:
    """Rows by (key, segment), each group led by the up to ``preceding`` rows of its key before it.

    Returns the rows (``keys``, ``order``, ``cols``, ``HALO``: whether a row is
    such a copy, ``BASE``: on copies, how many rows of the key lie before the
    group) and the columns to partition a window by. A frame of ``preceding``
    rows within a group then equals the frame within the key, so no key is
    sorted whole, and only ``preceding`` rows a group are copied.
    """
    sdf = with_segments(df, order[0], segments, n_segments).withColumn(SEG, F.coalesce(F.col(SEG), F.lit(-1).cast("bigint")))
    pairs = []
    for k in keys:
        sdf = (sdf.withColumn(f"_sf_kv_{k}", F.coalesce(F.col(k), _zero(df.schema[k].dataType)))
               .withColumn(f"_sf_kn_{k}", F.col(k).isNull()))
        pairs += [f"_sf_kv_{k}", f"_sf_kn_{k}"]
    part = [*pairs, SEG]
    row = list(dict.fromkeys([*order, *[c for c in cols if c not in keys]]))
    sdf = sdf.select(*part, *row)
    last = Window.partitionBy(*part).orderBy(*[F.col(o).desc() for o in order])
    tails = (sdf.withColumn("_sf_n", F.row_number().over(last)).where(F.col("_sf_n") <= preceding)
             .groupBy(*part).agg(F.sort_array(F.collect_list(F.struct((-F.col("_sf_n")).alias("at"), *row))).alias("_sf_tail")))
    sizes = sdf.groupBy(*part).agg(F.count(F.lit(1)).alias("_sf_size"))
    before = (Window.partitionBy(*pairs) if pairs else Window.partitionBy()).orderBy(SEG)
    carried = F.flatten(F.collect_list("_sf_tail").over(before.rowsBetween(-max(1, preceding), -1)))
    carry = (tails.join(sizes, part).withColumns({"_sf_c": carried, BASE: F.sum("_sf_size").over(before.rowsBetween(Window.unboundedPreceding, -1))})
             .where(F.size("_sf_c") > 0)
             .withColumn("_sf_c", F.slice("_sf_c", F.greatest(F.size("_sf_c") - (preceding - 1), F.lit(1)), max(1, preceding))))
    copies = carry.select(*part, BASE, F.explode("_sf_c").alias("_sf_r")).select(
        *part, *[F.col(f"_sf_r.{c}").alias(c) for c in row], F.lit(True).alias(HALO), BASE)
    rows = sdf.select(*part, *row, F.lit(False).alias(HALO), F.lit(None).cast("bigint").alias(BASE))
    both = rows.unionByName(copies)
    for k in keys:
        both = both.withColumn(k, F.when(~F.col(f"_sf_kn_{k}"), F.col(f"_sf_kv_{k}")))
    return both, part

"""Running values under any associative function: a two-level prefix scan.

:mod:`sensorflow.plans.scan` covers merges that Spark has as aggregates. Here
the merge is the user's: a function of two frames of accumulators, ``left``
and ``right``, row by row the earlier and the later part, that returns their
merged accumulators. It need not commute and may look at all fields at once.

1. Rows are dealt and sorted by (key, segment, order) and scanned locally by
   doubling steps, all rows of an Arrow batch at once; the last accumulator of
   a group is carried to its next batch. A hot key is spread over its segments.
2. Each group's last accumulator, one row per (key, segment), is scanned over
   the key's segments in the same way: these are the carries, at most
   ``scan.MAX_SEGMENTS`` a key.
3. Carries are joined back on (key, segment) and merged in front.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorflow.plans.scan import SEG, _zero, with_segments
from sensorflow.session import scratch_path

Merge = Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]


def running(acc: pd.DataFrame, group: np.ndarray, merge: Merge) -> pd.DataFrame:
    """Inclusive scan of consecutive groups of rows; after step k a row holds the merge of the 2^k rows up to it."""
    begins = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else np.zeros(0, int)
    place = np.arange(len(group)) - np.repeat(begins, np.diff(np.append(begins, len(group))))
    acc = acc.reset_index(drop=True)
    d = 1
    while d <= place.max(initial=0):
        at = np.flatnonzero(place >= d)
        got = merge(acc.iloc[at - d].reset_index(drop=True), acc.iloc[at].reset_index(drop=True))
        # rows keep their place: those without a partner first, then all in order again
        rest = np.flatnonzero(place < d)
        both = pd.concat([acc.iloc[rest], got[acc.columns].set_axis(at, axis=0)])
        acc = both.sort_index(kind="stable")
        d *= 2
    return acc


def _batched(batches: Iterator[pd.DataFrame], keys: list[str], cols: list[str], merge: Merge) -> Iterator[tuple[pd.DataFrame, pd.DataFrame]]:
    """(rows, their scanned accumulators) of batches sorted by ``keys`` and order."""
    held: tuple[tuple, pd.DataFrame] | None = None
    for pdf in batches:
        if pdf.empty:
            continue
        new = np.zeros(len(pdf), bool)
        new[0] = True
        for k in keys:
            new[1:] |= pdf[k].to_numpy()[1:] != pdf[k].to_numpy()[:-1]
        acc = running(pdf[cols], np.cumsum(new), merge)
        first, last = (tuple(pdf[k].iloc[i] for k in keys) for i in (0, -1))
        if held is not None and held[0] == first:
            n = int(np.flatnonzero(np.append(new[1:], True))[0]) + 1  # rows of the first group
            front = pd.concat([held[1]] * n, ignore_index=True)
            acc = pd.concat([merge(front, acc.iloc[:n].reset_index(drop=True))[cols], acc.iloc[n:]], ignore_index=True)
        held = last, acc.iloc[[-1]].reset_index(drop=True)
        yield pdf, acc


COUNT = "_sf_n"


def _counted(merge: Merge) -> Merge:
    """The merge with a count of rows, which tells a group's last accumulator."""
    return lambda left, right: merge(left, right).assign(**{COUNT: left[COUNT] + right[COUNT]})


def prefix_scan(df: DataFrame, key: str, order: str, cols: list[str], merge: Merge, segments=None, n_segments: int | None = None) -> DataFrame:
    """``df`` with the accumulator columns ``cols`` replaced by the merge of all rows of the key up to each row, by ``order``.

    ``merge`` must be associative and give columns of the same types. Null keys form a group of their own; null order
    values come first. Rows of equal order merge in any order.
    """
    part, acc, both = ["_sf_kv", "_sf_kn", SEG], [*cols, COUNT], _counted(merge)
    sdf = (with_segments(df, order, segments, n_segments).withColumn(SEG, F.coalesce(F.col(SEG), F.lit(-1).cast("bigint")))
           .withColumns({"_sf_kv": F.coalesce(F.col(key), _zero(df.schema[key].dataType)), "_sf_kn": F.col(key).isNull(),
                         COUNT: F.lit(1).cast("bigint")}))

    def local(batches):
        for pdf, got in _batched(batches, part, acc, both):
            yield pdf.assign(**{c: got[c].to_numpy() for c in acc})

    path = scratch_path(df.sparkSession, "prefix-scan")
    sdf.repartition(*part).sortWithinPartitions(*part, order).mapInPandas(local, sdf.schema).write.parquet(path)
    scanned = df.sparkSession.read.schema(sdf.schema).parquet(path)

    def over_segments(batches):
        for pdf, got in _batched(batches, part[:2], acc, both):
            yield pdf.assign(**{c: got[c].to_numpy() for c in acc})

    ends = scanned.groupBy(*part).agg(F.max_by(F.struct(*acc), COUNT).alias("_sf_end")).select(*part, *[F.col(f"_sf_end.{c}").alias(c) for c in acc])
    through = ends.repartition(*part[:2]).sortWithinPartitions(*part).mapInPandas(over_segments, ends.schema)
    before = Window.partitionBy(*part[:2]).orderBy(SEG)  # a row a segment
    carry = (through.select(*part, F.lag(F.struct(*acc)).over(before).alias("_sf_c")).where(F.col("_sf_c").isNotNull()))

    names = sdf.columns

    def in_front(batches):
        for pdf in batches:
            if len(pdf):
                left = pdf[[f"_sf_c_{c}" for c in acc]].set_axis(acc, axis=1)
                got = both(left.reset_index(drop=True), pdf[acc].reset_index(drop=True))
                yield pdf[names].assign(**{c: got[c].to_numpy() for c in cols})

    joined = scanned.join(carry, part, "left")
    # two branches, so that no whole number meets a null in pandas
    alone = joined.where(F.col("_sf_c").isNull()).select(*df.columns)
    led = joined.where(F.col("_sf_c").isNotNull()).select(*sdf.columns, *[F.col(f"_sf_c.{c}").alias(f"_sf_c_{c}") for c in acc])
    return alone.unionByName(led.mapInPandas(in_front, sdf.schema).select(*df.columns))

"""Mergeable user aggregates (the create / add / merge / result contract).

A :class:`Fold` is run in two vectorised phases, which is how Spark's own
partial aggregation works:

1. ``mapInPandas`` folds the rows of each input partition into one accumulator
   per group (map-side combine), merging batch by batch so memory is bounded
   by the number of distinct groups in the partition;
2. the accumulators are shuffled by key and merged, then finished.

No group is ever gathered whole into one task: a key holding a third of all
rows contributes one accumulator row per input partition.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T


@dataclass(frozen=True)
class Fold:
    """Accumulator spec. ``add``/``merge`` receive a pandas ``GroupBy`` and
    return one accumulator row per group (indexed by the keys); ``finish``
    maps a frame of accumulators to a frame of results."""

    acc: str
    result: str
    add: Callable
    merge: Callable
    finish: Callable


def _ddl(schema: T.StructType, names) -> str:
    return ", ".join(f"`{n}` {schema[n].dataType.simpleString()}" for n in names)


def _acc_cols(fold: Fold) -> list[str]:
    return [f.name for f in T._parse_datatype_string(fold.acc).fields]


#: Accumulator rows a task holds before it passes them on; a group may then come out in several parts.
MOST_GROUPS = 200_000


def _folded(batches, to_accs, merge, most: int | None):
    """Accumulators of a partition. Parts are merged once they are twice as long as the last merge's result, so merging
    costs each row a bounded number of times; with ``most``, results that long are passed on."""
    held, rows, last = [], 0, 0
    for pdf in batches:
        if pdf.empty:
            continue
        held.append(to_accs(pdf))
        rows += len(held[-1])
        if rows >= max(2 * last, 4096):
            run = merge(pd.concat(held, ignore_index=True))
            held, rows, last = [run], len(run), len(run)
            if most and last >= most:
                yield run
                held, rows, last = [], 0, 0
    if held:
        yield merge(pd.concat(held, ignore_index=True))


def _merger(keys: list[str], fold: Fold):
    cols = keys + _acc_cols(fold)
    return lambda frame: fold.merge(frame.groupby(keys, sort=False, dropna=False)).reset_index()[cols]


def fold_accumulate(df: DataFrame, keys: list[str], fold: Fold, inputs: list[str],
                    num_partitions: int | None = None, merged: bool = True) -> DataFrame:
    """Accumulators of ``fold`` per group: map-side partial fold, then (if
    ``merged``) one accumulator row per group after a shuffle by key. Already
    accumulated rows (same columns) can be unioned in before merging."""
    cols, merger = keys + _acc_cols(fold), _merger(keys, fold)

    def partial(batches):
        add = lambda pdf: fold.add(pdf.groupby(keys, sort=False, dropna=False)).reset_index()[cols]
        yield from _folded(batches, add, merger, MOST_GROUPS)

    partials = df.select(*keys, *inputs).mapInPandas(partial, f"{_ddl(df.schema, keys)}, {fold.acc}")
    return merge_accumulators(partials, keys, fold, num_partitions) if merged else partials


def merge_accumulators(accs: DataFrame, keys: list[str], fold: Fold,
                       num_partitions: int | None = None) -> DataFrame:
    """Shuffle accumulator rows by key and merge them to one row per group."""
    merger = _merger(keys, fold)

    def merge(batches):
        yield from _folded(batches, lambda pdf: pdf, merger, None)

    shuffled = accs.repartition(num_partitions, *keys) if num_partitions else accs.repartition(*keys)
    return shuffled.mapInPandas(merge, ", ".join([_ddl(accs.schema, keys), fold.acc]))


def finish_accumulators(accs: DataFrame, keys: list[str], fold: Fold) -> DataFrame:
    """Accumulator rows → result rows (a narrow, vectorised map)."""
    res_cols = [f.name for f in T._parse_datatype_string(fold.result).fields]

    def finish(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            out = fold.finish(pdf)
            yield pd.concat([pdf[keys].reset_index(drop=True), out[res_cols].reset_index(drop=True)], axis=1)

    return accs.mapInPandas(finish, f"{_ddl(accs.schema, keys)}, {fold.result}")


def fold_by(df: DataFrame, keys: list[str], fold: Fold, inputs: list[str],
            num_partitions: int | None = None) -> DataFrame:
    """Group ``df`` by ``keys`` and apply ``fold`` to ``inputs``."""
    return finish_accumulators(fold_accumulate(df, keys, fold, inputs, num_partitions), keys, fold)


def _round_half_up(s: pd.Series, digits: int) -> pd.Series:
    """Decimal HALF_UP rounding of each value's shortest repr (Spark's ``round``)."""
    from decimal import ROUND_HALF_UP, Decimal
    q = Decimal(1).scaleb(-digits)
    return s.map(lambda x: x if pd.isna(x) else float(Decimal(repr(float(x))).quantize(q, ROUND_HALF_UP)))


def count_fold(name: str = "cnt") -> Fold:
    return Fold(
        acc="n bigint", result=f"{name} bigint",
        add=lambda g: g.size().rename("n").to_frame(),
        merge=lambda g: g["n"].sum().to_frame(),
        finish=lambda a: pd.DataFrame({name: a["n"].astype("int64")}),
    )


def avg_fold(value: str, name: str = "avg_value", sum_digits: int | None = None) -> Fold:
    """``sum / count`` of the non-null values (the reference's average UDAF);
    ``sum_digits`` rounds the sum first (see :func:`operators.aggregates.mean`)."""
    def add(g):
        s = g[value].sum(min_count=0)
        n = g[value].count()
        return pd.DataFrame({"s": s.astype("float64"), "n": n.astype("int64")})

    def finish(a):
        n = a["n"].astype("float64")
        s = a["s"] if sum_digits is None else _round_half_up(a["s"], sum_digits)
        return pd.DataFrame({name: (s / n).where(n > 0)})

    return Fold(acc="s double, n bigint", result=f"{name} double", add=add,
                merge=lambda g: g[["s", "n"]].sum(), finish=finish)


def min_by_fold(value: str, order: str, time_us: str) -> Fold:
    """Rows, and the record with the smallest ``value`` (a null is smaller than any; ties: smallest ``order``):
    ``cnt``, ``min_<value>``, ``min_<order>``, ``min_time`` (from microseconds)."""
    def first(g, by: list[str]) -> pd.DataFrame:
        frame = g.obj.assign(_g=g.ngroup()).sort_values(by, na_position="first", kind="mergesort").drop_duplicates("_g").sort_values("_g")
        return frame.set_axis(g.size().index, axis=0)

    def add(g):
        f = first(g, [value, order])
        return pd.DataFrame({"cnt": g.size(), "v": f[value], "o": f[order], "t": f[time_us]})

    def merge(g):
        f = first(g, ["v", "o"])
        return pd.DataFrame({"cnt": g["cnt"].sum(), "v": f["v"], "o": f["o"], "t": f["t"]})

    def finish(a):
        return pd.DataFrame({"cnt": a["cnt"], f"min_{value}": a["v"], f"min_{order}": a["o"], "min_time": pd.to_datetime(a["t"].astype("int64"), unit="us")})

    return Fold(acc="cnt bigint, v double, o bigint, t bigint",
                result=f"cnt bigint, `min_{value}` double, `min_{order}` bigint, min_time timestamp_ntz", add=add, merge=merge, finish=finish)

"""State cells for user functions over keyed streams: F-1, F-6 and user folds (UDF-3, UDF-4).

A rich map declares its cells by name (:class:`Value`, :class:`Items`,
:class:`Table`, :class:`Reducing`) and gets them, with one key's rows of a
micro-batch in order, in a function that returns rows. A cell with a time to
live expires by processing time: Spark removes an entry that was not written
for that long, and never shows an expired one. ``opened`` and ``closed`` of
the map run once a task, around all of its keys.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from sensorflow.functions.fold import Fold
from sensorflow.plans.prefix import Merge, running
from sensorflow.session import prepare
from sensorflow.streaming.buckets import BUCKET, KEY, Frame, by_bucket, in_front, in_order, keyed
from sensorflow.streaming.event_windows import fields, plain, tuples, typed, whole_numbers


@dataclass(frozen=True)
class Value:
    """One row: ``exists``, ``get``, ``update``, ``clear``."""

    schema: str
    ttl_ms: int | None = None

    def make(self, handle: StatefulProcessorHandle, name: str):
        return handle.getValueState(name, self.schema, self.ttl_ms)

    def kept(self, handle: StatefulProcessorHandle, name: str, key: str):
        return KeptValue(handle, name, key, self.schema)


@dataclass(frozen=True)
class Items:
    """A list of rows: ``exists``, ``get``, ``put``, ``appendValue``, ``appendList``, ``clear``."""

    schema: str
    ttl_ms: int | None = None

    def make(self, handle: StatefulProcessorHandle, name: str):
        return handle.getListState(name, self.schema, self.ttl_ms)

    def kept(self, handle: StatefulProcessorHandle, name: str, key: str):
        return KeptItems(handle, name, key, self.schema)


@dataclass(frozen=True)
class Table:
    """Rows by row key: ``containsKey``, ``getValue``, ``updateValue``, ``removeKey``, ``iterator``, ``clear``."""

    key: str
    schema: str
    ttl_ms: int | None = None

    def make(self, handle: StatefulProcessorHandle, name: str):
        return handle.getMapState(name, self.key, self.schema, self.ttl_ms)

    def kept(self, handle: StatefulProcessorHandle, name: str, key: str):
        return KeptTable(handle, name, key, self.key, self.schema)


@dataclass(frozen=True)
class Reducing:
    """One row that every added row is reduced into by ``fn(held, new)``: ``get`` (None if empty), ``add``, ``clear``."""

    schema: str
    fn: Callable[[tuple, tuple], tuple]
    ttl_ms: int | None = None

    def make(self, handle: StatefulProcessorHandle, name: str) -> ReducingCell:
        return ReducingCell(handle.getValueState(name, self.schema, self.ttl_ms), self.fn)

    def kept(self, handle: StatefulProcessorHandle, name: str, key: str) -> ReducingCell:
        return ReducingCell(KeptValue(handle, name, key, self.schema), self.fn)


class ReducingCell:
    def __init__(self, cell, fn: Callable[[tuple, tuple], tuple]):
        self.cell, self.fn = cell, fn

    def get(self) -> tuple | None:
        return tuple(self.cell.get()) if self.cell.exists() else None

    def add(self, row: tuple) -> tuple:
        held = self.get()
        now = row if held is None else self.fn(held, row)
        self.cell.update(now)
        return now

    def clear(self) -> None:
        self.cell.clear()


class Kept:
    """A cell of every key of a bucket, in one list of ``(key, row)``: read at the first use in a micro-batch, written
    once after it."""

    def __init__(self, handle: StatefulProcessorHandle, name: str, key: str, schema: str):
        self.rows = handle.getListState(name, f"`{KEY}` {key}, {schema}")

    def open(self) -> None:
        self.by: dict = {}
        for key, *row in self.rows.get() if self.rows.exists() else ():
            self.by.setdefault(key, []).append(tuple(row))

    def at(self, key) -> None:
        self.key = key

    def exists(self) -> bool:
        return bool(self.by.get(self.key))

    def clear(self) -> None:
        self.by.pop(self.key, None)

    def save(self) -> None:
        rows = [(key, *row) for key, held in self.by.items() for row in held]
        if rows:
            self.rows.put(rows)
        else:
            self.rows.clear()


class KeptValue(Kept):
    def get(self) -> tuple | None:
        return self.by[self.key][0] if self.exists() else None

    def update(self, row: tuple) -> None:
        self.by[self.key] = [tuple(row)]


class KeptItems(Kept):
    def get(self) -> Iterator[tuple]:
        return iter(list(self.by.get(self.key, ())))

    def put(self, rows: list[tuple]) -> None:
        self.by[self.key] = [tuple(row) for row in rows]

    def appendValue(self, row: tuple) -> None:
        self.appendList([row])

    def appendList(self, rows: list[tuple]) -> None:
        self.by.setdefault(self.key, []).extend(tuple(row) for row in rows)


class KeptTable(Kept):
    def __init__(self, handle: StatefulProcessorHandle, name: str, key: str, entry: str, schema: str):
        super().__init__(handle, name, key, f"entry struct<{entry}>, held struct<{schema}>")

    def open(self) -> None:
        super().open()
        self.by = {key: {tuple(entry): tuple(held) for entry, held in rows} for key, rows in self.by.items()}

    def save(self) -> None:
        self.by = {key: list(rows.items()) for key, rows in self.by.items()}
        super().save()

    def _own(self) -> dict:
        return self.by.get(self.key, {})

    def containsKey(self, key: tuple) -> bool:
        return tuple(key) in self._own()

    def getValue(self, key: tuple) -> tuple | None:
        return self._own().get(tuple(key))

    def updateValue(self, key: tuple, row: tuple) -> None:
        self.by.setdefault(self.key, {})[tuple(key)] = tuple(row)

    def removeKey(self, key: tuple) -> None:
        self._own().pop(tuple(key), None)

    def iterator(self) -> Iterator[tuple]:
        return iter(list(self._own().items()))

    def keys(self) -> Iterator[tuple]:
        return iter(list(self._own()))

    def values(self) -> Iterator[tuple]:
        return iter(list(self._own().values()))


class RichMap(StatefulProcessor):
    """One call of the function a key; ``key`` None: groups are keys, else buckets of this column of type ``kind``."""

    def __init__(self, fn: Callable, cells: dict, order: list[str], out: list[str], opened: Callable | None, closed: Callable | None,
                 key: str | None = None, kind: str = ""):
        self.fn, self.specs, self.order, self.out, self.opened, self.closed = fn, cells, order, out, opened, closed
        self.key, self.kind = key, kind
        self.resource = None

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.cells = {name: spec.make(handle, name) if self.key is None else spec.kept(handle, name, self.kind) for name, spec in self.specs.items()}
        if self.opened:
            self.resource = self.opened()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frames = rows if self.key is None else keyed(key, rows, self.key)
        frame = pd.concat(list(frames), ignore_index=True).sort_values(self.order, kind="mergesort").reset_index(drop=True)
        if self.key is None:
            got = [self._mapped(key[0], frame)]
        else:
            kept = [c.cell if isinstance(c, ReducingCell) else c for c in self.cells.values()]
            for cell in kept:
                cell.open()
            got = []
            frame = frame.drop(columns=BUCKET)
            codes, distinct = pd.factorize(frame[self.key], use_na_sentinel=False)
            by = np.argsort(codes, kind="stable")
            frame = frame.take(by)
            ends = np.cumsum(np.bincount(codes)).tolist()
            for begin, end, own in zip([0, *ends], ends, distinct):
                for cell in kept:
                    cell.at(plain(own))
                got.append(self._mapped(plain(own), frame.iloc[begin:end].reset_index(drop=True)))
            for cell in kept:
                cell.save()
        got = [g[self.out] for g in got if g is not None and len(g)]
        if got:
            with warnings.catch_warnings():  # about columns that are all null for a key
                warnings.simplefilter("ignore", FutureWarning)
                whole = pd.concat(got, ignore_index=True)
            yield whole

    def _mapped(self, key, frame: pd.DataFrame) -> pd.DataFrame | None:
        args = (key, frame, self.cells) if self.opened is None else (key, frame, self.cells, self.resource)
        return self.fn(*args)

    def close(self) -> None:
        if self.closed:
            self.closed(self.resource)
            self.resource = None


def rich_map_stream(df: DataFrame, key: str, order: list[str], cells: dict, fn: Callable, schema: str,
                    opened: Callable | None = None, closed: Callable | None = None) -> DataFrame:
    """``keyBy(key).map(rich function)`` on a stream (F-1, F-6; append mode).

    ``fn(key, rows, cells)`` gets a key's rows of a micro-batch as a pandas frame in ``order``; so a task holds those rows,
    which ``maxFilesPerTrigger`` or ``maxBytesPerTrigger`` of the source bound. ``opened()`` makes a task's resource (a
    connection, say), which ``fn`` gets as a fourth argument and ``closed(resource)`` releases at the end of the task.
    Cells with a time to live are Spark's own, one per key, and need its processing-time mode, which this sets if there are
    any. Else the cells of a bucket of keys are kept together (:class:`Kept`).
    """
    prepare(df.sparkSession)
    if any(spec.ttl_ms for spec in cells.values()):
        return df.groupBy(key).transformWithStateInPandas(RichMap(fn, cells, order, fields(schema), opened, closed), schema, "Append", "ProcessingTime")
    processor = RichMap(fn, cells, order, fields(schema), opened, closed, key, df.schema[key].dataType.simpleString())
    return by_bucket(df, key).transformWithStateInPandas(processor, schema, "Append", "None")


def read_cell(spark: SparkSession, checkpoint: str, name: str) -> DataFrame:
    """What a stream's checkpoint holds in a cell (or in its timers), as Spark's state reader gives it."""
    return spark.read.format("statestore").option("path", checkpoint).option("stateVarName", name).load()


class KeyedFold(StatefulProcessor):
    """A :class:`Fold` with one accumulator per key, those of a bucket as one frame; frames are added as they come, in any
    order."""

    def __init__(self, key: str, fold: Fold):
        self.key, self.fold, self.cols, self.whole = key, fold, [KEY, *fields(fold.acc)], whole_numbers(fold.acc)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.cell = Frame(handle, "acc", self.cols)

    def _by_key(self, fn: Callable, frame: pd.DataFrame) -> pd.DataFrame:
        return typed(fn(frame.groupby(KEY, sort=False, dropna=False)).reset_index()[self.cols], self.whole)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = None
        for pdf in keyed(key, rows, self.key):
            part = self._by_key(self.fold.add, pdf.assign(**{KEY: pdf[self.key]}))
            new = part if new is None else self._by_key(self.fold.merge, pd.concat([new, part], ignore_index=True))
        held = typed(self.cell.get(), self.whole)
        own = held[KEY].isin(new[KEY])
        if own.any():
            new = self._by_key(self.fold.merge, pd.concat([held[own], new], ignore_index=True))
        self.cell.put(new if own.all() else pd.concat([held[~own], new], ignore_index=True))
        out = self.fold.finish(new).reset_index(drop=True)
        out.insert(0, self.key, [plain(k) for k in new[KEY]])
        yield out

    def close(self) -> None:
        pass


def fold_stream(df: DataFrame, key: str, fold: Fold, inputs: list[str]) -> DataFrame:
    """A user aggregate per key on a stream, under the contract of the batch form :func:`functions.fold.fold_by`; every
    batch gives the new results of its keys (update mode)."""
    prepare(df.sparkSession)
    kind = df.schema[key].dataType.simpleString()
    return by_bucket(df.select(key, *[c for c in inputs if c != key]), key).transformWithStateInPandas(
        KeyedFold(key, fold), f"`{key}` {kind}, {fold.result}", "Update", "None")


class RollingReduce(StatefulProcessor):
    """Running merges of the rows of keys (A-4 on a stream); every key's last accumulator is the only state."""

    def __init__(self, key: str, order: str, cols: list[str], ddl: str, merge: Merge, out: list[str]):
        self.key, self.order, self.cols, self.merge, self.out, self.whole = key, order, cols, merge, out, whole_numbers(ddl)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.cell = Frame(handle, "acc", [KEY, *self.cols])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = self.cell.get()
        of_held, frame, codes, keys = in_order(keyed(key, rows, self.key), held[KEY], self.key, [self.order])
        order, both, new = in_front(of_held, codes)
        acc = typed(frame[self.cols], self.whole)
        if len(held):
            acc = pd.concat([typed(held[self.cols], self.whole), acc], ignore_index=True)
        acc = running(acc.iloc[order], both, self.merge)
        last = np.append(both[1:] != both[:-1], True)
        self.cell.put(typed(acc[last], self.whole).assign(**{KEY: keys.take(both[last]).to_numpy()}))
        for c in self.cols:
            frame[c] = acc[c][new].to_numpy()
        yield frame[self.out]

    def close(self) -> None:
        pass


def rolling_reduce_by_stream(df: DataFrame, key: str, order: str, start: dict[str, Column], merge: Merge) -> DataFrame:
    """The batch form's :func:`operators.rolling.rolling_reduce_by` on a stream (append mode); a key's rows come in order
    across micro-batches."""
    prepare(df.sparkSession)
    whole = df.withColumns(start)
    ddl = lambda names: ", ".join(f"`{n}` {whole.schema[n].dataType.simpleString()}" for n in names)
    processor = RollingReduce(key, order, list(start), ddl(start), merge, whole.columns)
    return by_bucket(whole, key).transformWithStateInPandas(processor, ddl(whole.columns), "Append", "None")


class InstanceCount(StatefulProcessor):
    """Operator state (F-2 on a stream): each parallel instance counts its rows and keeps the count as a list of parts.
    On a restore an instance gets any number of parts, which it adds up."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.parts = handle.getListState("parts", "n bigint")

    def _held(self) -> int:
        return sum(p[0] for p in self.parts.get()) if self.parts.exists() else 0

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.parts.appendList([(int(n),) for n in initialState["n"].tolist()])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        total = self._held() + sum(len(pdf) for pdf in rows)
        self.parts.put([(total,)])
        yield pd.DataFrame({"instance": [key[0]], "cnt": [total]})

    def close(self) -> None:
        pass


def instance_count_stream(df: DataFrame, spread_by: list[str], parallelism: int, parts: DataFrame | None = None) -> DataFrame:
    """Rows counted by ``parallelism`` instances (update mode: ``instance``, ``cnt`` of all its rows so far).

    ``parts``: what :func:`saved_parts` found in another run's checkpoint, of whatever parallelism; the parts are dealt
    round robin to the instances, so the counts go on where that run stopped.
    """
    prepare(df.sparkSession)
    src = df.select(F.pmod(F.xxhash64(*spread_by), F.lit(parallelism)).cast("int").alias("instance"))
    begin = None
    if parts is not None:
        begin = parts.select((F.pmod(F.col("part"), F.lit(parallelism))).cast("int").alias("instance"), "n").groupBy("instance")
    return src.groupBy("instance").transformWithStateInPandas(InstanceCount(), "instance int, cnt bigint", "Update", "None", initialState=begin)


def saved_parts(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``part`` (0, 1, …; one an instance) and ``n`` of the instance counts in a checkpoint."""
    held = read_cell(spark, checkpoint, "parts").select(F.col("key.instance").alias("instance"), F.col("list_element.n").alias("n"))
    return held.select((F.row_number().over(Window.orderBy("instance", "n")) - 1).alias("part"), "n")  # a row an instance

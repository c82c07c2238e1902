"""Event-time windows of keyed streams with allowed lateness: W-2, W-4, W-5, UDF-3 and UDF-4.

Spark drops rows behind the watermark before a stateful operator sees them.
Here the watermark is set from the time column, which then leaves the stream
(:func:`clocked`): the clock still advances with it, but there is no column
that rows could be dropped by. The operator gets every row and decides itself,
so rows in equals rows out.

The clock is Spark's: in a micro-batch, the largest event time of the earlier
batches minus the delay, in milliseconds.

State is bounded by the open windows: one accumulator each for
:class:`FoldWindows`, the rows for :class:`RowWindows`. It is kept by hash
bucket of keys (:mod:`sensorflow.streaming.buckets`). A bucket has one pending
timer, at the earliest time anything is due; when it fires, everything due is
handled at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from sensorflow.functions.fold import Fold
from sensorflow.plans.prefix import running
from sensorflow.schema import duration_us, event_time
from sensorflow.session import prepare
from sensorflow.streaming.buckets import KEY, Frame, by_bucket, keyed, told

#: Microseconds that stand for a missing event time.
NO_TIME = -(2**63)
US = "sf_event_us"


def clocked(df: DataFrame, time: str, delay: str, us: str = US) -> DataFrame:
    """``df`` with a watermark ``delay`` behind ``time`` and with the event time in microseconds as ``us``
    (``NO_TIME`` for null); no row is ever dropped as late."""
    src = df.withColumn("_sf_clock", event_time(df, time)).withWatermark("_sf_clock", delay)
    return src.withColumn(us, F.coalesce(F.unix_micros("_sf_clock"), F.lit(NO_TIME))).drop("_sf_clock")


def watermark_ms(timer_values) -> float:
    """The current watermark; before the first one, minus infinity."""
    ms = timer_values.getCurrentWatermarkInMs()
    return ms if ms and ms > 0 else -np.inf


class Alarm:
    """The one pending event-time timer of a bucket, moved to earlier times as needed."""

    def __init__(self, handle: StatefulProcessorHandle, name: str = "alarm"):
        self.handle, self.at = handle, handle.getValueState(name, "ms bigint")

    def no_later_than(self, ms: int) -> None:
        if self.at.exists():
            now = self.at.get()[0]
            if now <= ms:
                return
            self.handle.deleteTimer(now)
        self.handle.registerTimer(int(ms))
        self.at.update((int(ms),))

    def went_off(self) -> None:
        self.at.clear()


def plain(v):
    """A cell of a pandas frame as state and Arrow take it."""
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and np.isnan(v)):
        return None
    return v.item() if isinstance(v, np.generic) else v


def tuples(frame: pd.DataFrame, cols: list[str]) -> list[tuple]:
    return [tuple(plain(v) for v in row) for row in zip(*[frame[c].tolist() for c in cols])]


def fields(ddl: str) -> list[str]:
    return T._parse_datatype_string(ddl).fieldNames()


def whole_numbers(ddl: str) -> list[str]:
    return [f.name for f in T._parse_datatype_string(ddl).fields if isinstance(f.dataType, (T.LongType, T.IntegerType))]


def typed(frame: pd.DataFrame, whole: list[str]) -> pd.DataFrame:
    """``whole`` columns as nullable integers, so that gaps don't make floats of them."""
    return frame.assign(**{c: pd.array([plain(v) for v in frame[c].tolist()], dtype="Int64") for c in whole if c in frame})


class FoldWindows(StatefulProcessor):
    """Tumbling windows of keys under a :class:`Fold` (state: an accumulator and the last firing by key and window start).

    With ``wm`` the watermark, a row of a window that ends at ``end`` is

    * ``late`` if ``end - 1 ms + lateness <= wm``: it comes out as it is;
    * a re-firing if ``end - 1 ms <= wm``: the window's result comes out again with this row in it (a window that was
      due in this very batch fires first);
    * else on time: it is added, and the window fires when the watermark reaches ``end - 1 ms``.

    A window's accumulator goes once it can take no more rows. Rows without an event time come out as ``untimed``.
    Results are numbered by ``firing``, 1 for the first. On-time rows are added frame by frame in any order; only
    re-firing rows of a micro-batch are sorted, by ``order``.
    """

    def __init__(self, key: str, order: str, inputs: list[str], fold: Fold, size_ms: int, lateness_ms: int, out: list[str]):
        self.key, self.order, self.inputs, self.fold = key, order, inputs, fold
        self.size_ms, self.lateness_ms, self.out = size_ms, lateness_ms, out
        self.acc, self.whole = fields(fold.acc), whole_numbers(fold.acc)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.windows = Frame(handle, "windows", [KEY, "_w", "firing", *self.acc])
        self.alarm = Alarm(handle)

    def _held(self) -> pd.DataFrame:
        held = self.windows.get()
        return typed(held, self.whole).astype({"_w": "int64", "firing": "int64"})

    def _added(self, rows: pd.DataFrame, by: list[str]) -> pd.DataFrame:
        return typed(self.fold.add(rows.groupby(by, sort=False, dropna=False)).reset_index()[[*by, *self.acc]], self.whole)

    def _merge(self, frame: pd.DataFrame, by: list[str]) -> pd.DataFrame:
        return typed(self.fold.merge(frame.groupby(by, sort=False, dropna=False)).reset_index()[[*by, *self.acc]], self.whole)

    def _told(self, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.reset_index(drop=True)
        start = frame["_w"].to_numpy("int64")
        got = self.fold.finish(frame).reset_index(drop=True)
        head = pd.DataFrame({"output": "window", self.key: told(frame[KEY]), "window_start": pd.to_datetime(start, unit="ms"),
                             "window_end": pd.to_datetime(start + self.size_ms, unit="ms"), "firing": frame["firing"]})
        return self._whole(pd.concat([head, got], axis=1))

    def _rows_out(self, rows: pd.DataFrame, tag: str) -> pd.DataFrame:
        head = {"output": tag, self.key: rows[KEY].to_numpy()}
        if tag == "late":
            start = rows["_w"].to_numpy("int64")
            head |= {"window_start": pd.to_datetime(start, unit="ms"), "window_end": pd.to_datetime(start + self.size_ms, unit="ms")}
        return self._whole(pd.DataFrame({**head, **{f"late_{c}": rows[c].to_numpy() for c in dict.fromkeys([self.order, *self.inputs])}}))

    def _whole(self, frame: pd.DataFrame) -> pd.DataFrame:
        for c in self.out:
            if c not in frame:
                frame[c] = None
        return frame[self.out]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        wm = watermark_ms(timerValues)
        added, again = [], []
        for pdf in keyed(key, rows, self.key):
            us = pdf[US].to_numpy("int64")
            start = us // (self.size_ms * 1000) * self.size_ms
            fire = start + self.size_ms - 1
            untimed = us == NO_TIME
            late = ~untimed & (fire + self.lateness_ms <= wm)
            pdf = pdf.assign(**{KEY: pdf[self.key], "_w": np.where(untimed, 0, start)})
            for tag, pick in (("untimed", untimed), ("late", late)):
                if pick.any():
                    yield self._rows_out(pdf[pick], tag)
            due = ~untimed & ~late & (fire <= wm)
            on_time = ~untimed & ~late & ~due
            if on_time.any():
                added.append(self._added(pdf[on_time], [KEY, "_w"]))
            if due.any():
                again.append(pdf[due])
        if not added and not again:
            return
        held = self._held()
        if added:
            frame = pd.concat(added, ignore_index=True).assign(firing=0)
            held = self._keep(held, frame)
        if again:
            fired, held = self._fire_again(held, pd.concat(again, ignore_index=True))
            yield self._told(fired)
        self.windows.put(held)

    def _split(self, held: pd.DataFrame, frame: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
        """The held windows that ``frame`` has rows of, and the others."""
        if not len(held):
            return held, held
        both = pd.concat([held[[KEY, "_w"]], frame[[KEY, "_w"]]], ignore_index=True)
        window = both.groupby([KEY, "_w"], sort=False, dropna=False).ngroup().to_numpy()
        own = np.isin(window[: len(held)], window[len(held):])
        return held[own], held[~own]

    def _keep(self, held: pd.DataFrame, frame: pd.DataFrame) -> pd.DataFrame:
        """The windows with accumulators merged into the open ones."""
        own, others = self._split(held, frame)
        merged = self._merge(pd.concat([own, frame], ignore_index=True) if len(own) else frame, [KEY, "_w"]).assign(firing=0)
        self.alarm.no_later_than(int(merged["_w"].min()) + self.size_ms - 1)
        return pd.concat([others, merged], ignore_index=True) if len(others) else merged

    def _pairs(self, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        pair = pd.concat([left, right], ignore_index=True).assign(_p=np.tile(np.arange(len(left)), 2))
        return self._merge(pair.sort_values("_p", kind="mergesort"), ["_p"])[self.acc]

    def _fire_again(self, held: pd.DataFrame, rows: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
        """One result a row, each with all rows of its window before it, after that of a window due in this batch; and the
        windows with these rows."""
        own, others = self._split(held, rows)
        rows = rows.sort_values(self.order, kind="mergesort").reset_index(drop=True).assign(_row=np.arange(len(rows)))
        one = pd.concat([rows[[KEY, "_w"]], self._added(rows, ["_row"])[self.acc]], axis=1).assign(firing=0, _held=False)
        frame = pd.concat([own.assign(_held=True), one], ignore_index=True) if len(own) else one
        window = frame.groupby([KEY, "_w"], sort=False, dropna=False).ngroup().to_numpy()
        by = np.argsort(window, kind="stable")
        frame, window = frame.iloc[by].reset_index(drop=True), window[by]
        frame[self.acc] = running(typed(frame[self.acc], self.whole), window, self._pairs)[self.acc]
        led, firing = frame["_held"].to_numpy(bool), frame["firing"].to_numpy("int64")
        before = np.zeros(window.max() + 1, "int64")
        before[window[led]] = np.maximum(firing[led], 1)  # due in this batch, before the first row
        new = np.ones(len(window), bool)
        new[1:] = window[1:] != window[:-1]
        at = np.arange(len(window)) - np.maximum.accumulate(np.where(new, np.arange(len(window)), 0))
        with_held = np.zeros(len(before), bool)
        with_held[window[led]] = True
        frame["firing"] = before[window] + at + ~with_held[window]
        last = np.append(new[1:], True)
        self.alarm.no_later_than(int(frame["_w"].min()) + self.size_ms - 1 + self.lateness_ms)
        left = frame.loc[last, [KEY, "_w", "firing", *self.acc]]
        return frame[~led | (firing == 0)], pd.concat([others, left], ignore_index=True) if len(others) else left

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.alarm.went_off()
        wm = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        held = self._held()
        fire = held["_w"].to_numpy("int64") + self.size_ms - 1
        due = (held["firing"].to_numpy("int64") == 0) & (fire <= wm)
        held.loc[due, "firing"] = 1
        left = fire + self.lateness_ms > wm
        self.windows.put(held[left])
        if left.any():
            self.alarm.no_later_than(int(np.where(fire > wm, fire, fire + self.lateness_ms)[left].min()))
        if due.any():
            yield self._told(held[due])

    def close(self) -> None:
        pass


def _ddl(df: DataFrame, *names: str) -> str:
    return ", ".join(f"`{n}` {df.schema[n].dataType.simpleString()}" for n in names)


def fold_windows_stream(df: DataFrame, key: str, time: str, size: str, fold: Fold, inputs: list[str], order: str,
                        delay: str, lateness: str = "0 seconds") -> DataFrame:
    """Keyed tumbling windows under a user fold on a stream, with re-firings and late rows (append mode).

    Output: ``output`` (``window``, ``late`` or ``untimed``), the key, ``window_start``, ``window_end``, ``firing``, the
    fold's result, and for the other two kinds the row itself: its ``order`` and ``inputs`` as ``late_<name>``. Every row
    is counted by exactly one window's last firing, or comes out as late or untimed.
    """
    prepare(df.sparkSession)
    keep = list(dict.fromkeys([order, *inputs]))
    head = f"output string, {_ddl(df, key)}, window_start timestamp_ntz, window_end timestamp_ntz, firing int, {fold.result}"
    schema = f"{head}, " + ", ".join(f"`late_{c}` {df.schema[c].dataType.simpleString()}" for c in keep)
    src = clocked(df.select(key, F.col(time).alias("_sf_time"), *keep), "_sf_time", delay).drop("_sf_time")
    processor = FoldWindows(key, order, inputs, fold, duration_us(size) // 1000, duration_us(lateness) // 1000, fields(schema))
    return by_bucket(src, key).transformWithStateInPandas(processor, schema, "Append", "EventTime")


class RowWindows(StatefulProcessor):
    """Tumbling windows that keep their rows for a user function (state: a list of the open windows' rows).

    When the watermark reaches a window's last millisecond, ``fn`` gets a key's rows in it as a pandas frame in ``order``. Rows of
    windows that are already done come out as ``late``, rows without an event time as ``untimed``.
    """

    def __init__(self, key: str, order: str, cols: list[str], state: str, times: list[str], fn: Callable, size_ms: int, out: list[str]):
        self.key, self.order, self.cols, self.times = key, order, cols, times
        self.fn, self.size_ms, self.out, self.whole = fn, size_ms, out, whole_numbers(state)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rows = Frame(handle, "rows", ["_w", *self.cols])
        self.alarm = Alarm(handle)

    def _aside(self, rows: pd.DataFrame, tag: str) -> pd.DataFrame:
        frame = pd.DataFrame({"output": tag, self.key: rows[self.key].to_numpy(), f"late_{self.order}": rows[self.order].to_numpy()})
        return frame.reindex(columns=self.out).astype(object).where(lambda x: x.notna(), None)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        wm = watermark_ms(timerValues)
        first = None
        for pdf in keyed(key, rows, self.key):
            us = pdf[US].to_numpy("int64")
            start = us // (self.size_ms * 1000) * self.size_ms
            untimed = us == NO_TIME
            late = ~untimed & (start + self.size_ms - 1 <= wm)
            for tag, pick in (("untimed", untimed), ("late", late)):
                if pick.any():
                    yield self._aside(pdf[pick], tag)
            keep = ~untimed & ~late
            if keep.any():
                self.rows.append(typed(pdf[keep], self.whole).assign(_w=start[keep]))
                first = int(start[keep].min()) if first is None else min(first, int(start[keep].min()))
        if first is not None:
            self.alarm.no_later_than(first + self.size_ms - 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.alarm.went_off()
        wm = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        held = self.rows.get()
        due = held["_w"].to_numpy("int64") + self.size_ms - 1 <= wm
        rest = held[~due]
        self.rows.put(rest)
        if len(rest):
            self.alarm.no_later_than(int(rest["_w"].min()) + self.size_ms - 1)
        if not due.any():
            return
        frame = typed(held[due], self.whole)
        for c in self.times:
            frame[c] = pd.to_datetime(frame[c], unit="us")
        frame["window_end"] = pd.to_datetime(frame.pop("_w").astype("int64") + self.size_ms, unit="ms")
        frame = frame.sort_values(["window_end", self.order], kind="mergesort").reset_index(drop=True)
        frame[self.key] = told(frame[self.key])
        window = frame.groupby([self.key, "window_end"], sort=False, dropna=False).ngroup().to_numpy()
        by = np.argsort(window, kind="stable")
        frame, ends = frame.take(by), np.cumsum(np.bincount(window)).tolist()
        got = [self.fn(frame.iloc[begin:end].reset_index(drop=True)) for begin, end in zip([0, *ends], ends)]
        got = pd.concat(got, ignore_index=True).assign(output="window")
        got[f"late_{self.order}"] = None
        yield got[self.out]

    def close(self) -> None:
        pass


def apply_windows_stream(df: DataFrame, key: str, time: str, size: str, fn: Callable, schema: str, order: str, delay: str) -> DataFrame:
    """``timeWindow(size).apply(fn)`` on a stream (append mode): ``fn(rows)`` gets one key's rows of one window as a pandas
    frame with ``window_end``, as in the batch form :func:`operators.windows.tumble_apply_rows`, and returns rows of
    ``schema``, which must hold the key.

    Output: ``output`` (``window``, ``late`` or ``untimed``), ``schema``, and the ``order`` of a late or untimed row as
    ``late_<order>``.
    """
    prepare(df.sparkSession)
    times = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))]
    plain_df = clocked(df.withColumn("_sf_time", F.col(time)), "_sf_time", delay).drop("_sf_time")
    for c in times:
        plain_df = plain_df.withColumn(c, F.unix_micros(F.col(c).cast("timestamp")))
    state = _ddl(plain_df, *df.columns)
    whole = f"output string, {schema}, `late_{order}` {df.schema[order].dataType.simpleString()}"
    processor = RowWindows(key, order, df.columns, state, times, fn, duration_us(size) // 1000, fields(whole))
    return by_bucket(plain_df, key).transformWithStateInPandas(processor, whole, "Append", "EventTime")

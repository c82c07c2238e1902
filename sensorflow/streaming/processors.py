"""Stateful processors for ``groupBy(key).transformWithStateInPandas``.

Each keeps O(1) or O(window) state per key (never the key's history) and
sorts the rows it receives by the order column, since Spark does not order
rows within a group. Rows of one key must arrive in order *across*
micro-batches (true for a time-ordered or sliced replay).

But for the processing-time timers, groups are hash buckets of keys
(:mod:`sensorflow.streaming.buckets`): a call works on all keys of a bucket.

Output schemas are DDL strings next to each class.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from sensorflow.operators.alerts import JAVA_DOUBLE_MIN_VALUE
from sensorflow.streaming.buckets import KEY, Frame, coded, frame_means, in_front, in_order, keyed, place, told
from sensorflow.streaming.event_windows import NO_TIME, Alarm, watermark_ms


class RunningCount(StatefulProcessor):
    """Keyed counter (F-1, and the per-record word count of A-2):
    emits ``(key, *order, cnt)`` per row."""

    def __init__(self, key: str, order):
        self.key = key
        self.order = [order] if isinstance(order, str) else list(order)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.counts = Frame(handle, "count", [KEY, "n"])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = self.counts.get()
        of_held, pdf, codes, keys = in_order(keyed(key, rows, self.key), held[KEY], self.key, self.order)
        base = np.zeros(len(keys), "int64")
        base[of_held] = held["n"].to_numpy("int64")
        self.counts.put(pd.DataFrame({KEY: keys, "n": base + np.bincount(codes, minlength=len(keys))}))
        yield pd.DataFrame({self.key: pdf[self.key], **{c: pdf[c] for c in self.order}, "cnt": base[codes] + place(codes) + 1})

    def close(self) -> None:
        pass


class JumpAlert(StatefulProcessor):
    """Change alert (F-3): ``(key, order, prev_value, value)`` when the jump
    from the previous reading is ``>= threshold``; the first reading only sets state."""

    def __init__(self, key: str, order: str, value: str, threshold: float):
        self.key, self.order, self.value, self.threshold = key, order, value, threshold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = Frame(handle, "last", [KEY, "v"])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = self.last.get()
        of_held, pdf, codes, keys = in_order(keyed(key, rows, self.key), held[KEY], self.key, [self.order])
        order, both, new = in_front(of_held, codes)
        v = np.concatenate([held["v"].to_numpy("float64"), pdf[self.value].to_numpy("float64")])[order]
        prev = np.concatenate([[np.nan], v[:-1]])
        hit = (place(both) > 0) & (np.abs(v - prev) >= self.threshold)
        last = np.append(both[1:] != both[:-1], True)
        self.last.put(pd.DataFrame({KEY: keys.take(both[last]).to_numpy(), "v": v[last]}))
        at = hit[new]  # a state row is its key's first, so never a hit
        yield pd.DataFrame({self.key: pdf[self.key][at], self.order: pdf[self.order][at], f"prev_{self.value}": prev[hit], self.value: v[hit]})

    def close(self) -> None:
        pass


class CountWindowAvg(StatefulProcessor):
    """Sliding count window (W-3): every ``slide``-th row of a key, the mean of
    its last ``size`` rows. State: a row counter and the last ``size - 1`` values."""

    def __init__(self, key: str, order: str, value: str, size: int = 5, slide: int = 2):
        self.key, self.order, self.value, self.size, self.slide = key, order, value, size, slide

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.counts = Frame(handle, "count", [KEY, "n"])
        self.tail = Frame(handle, "tail", [KEY, "v"])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held, tail = self.counts.get(), self.tail.get()
        of_held, pdf, codes, keys = in_order(keyed(key, rows, self.key), pd.concat([held[KEY], tail[KEY]], ignore_index=True), self.key, [self.order])
        of_held, of_tail = of_held[: len(held)], of_held[len(held):]
        base = np.zeros(len(keys), "int64")
        base[of_held] = held["n"].to_numpy("int64")
        avg, _, left = frame_means(tail, of_tail, pdf[self.value], codes, keys, self.size)
        rn = base[codes] + place(codes) + 1
        n = np.minimum(rn, self.size)  # rows of the frame, null values included
        fire = rn % self.slide == 0
        self.counts.put(pd.DataFrame({KEY: keys, "n": base + np.bincount(codes, minlength=len(keys))}))
        self.tail.put(left)
        yield pd.DataFrame({self.key: pdf[self.key][fire], self.order: pdf[self.order][fire],
                            "n": n[fire].astype("int64"), "avg_value": avg[fire]})

    def close(self) -> None:
        pass


class OverRows(StatefulProcessor):
    """Row-frame OVER window (W-8) on a stream (Spark rejects row frames on
    streaming DataFrames): count and mean over the current and ``preceding``
    earlier rows of the key in ``order`` (event time, then seq)."""

    def __init__(self, key: str, order: list[str], value: str, preceding: int = 2):
        self.key, self.order, self.value, self.preceding = key, order, value, preceding

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.tail = Frame(handle, "tail", [KEY, "v"])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        tail = self.tail.get()
        of_tail, pdf, codes, keys = in_order(keyed(key, rows, self.key), tail[KEY], self.key, self.order)
        avg, n, left = frame_means(tail, of_tail, pdf[self.value], codes, keys, self.preceding + 1)
        self.tail.put(left)
        # rows of the frame, null values included; a null key is not counted, as in count(key)
        yield pd.DataFrame({self.key: pdf[self.key], **{c: pdf[c] for c in self.order},
                            "cnt": n * pdf[self.key].notna().to_numpy(), "avg_value": avg})

    def close(self) -> None:
        pass


class RiseAlert(StatefulProcessor):
    """Continuous-rise alert with event-time timers (F-5).

    A rising row with no open run starts one and registers an event-time
    timer at ``row time + interval``. The run's break (next non-rising row)
    deletes the timer if its event time is at or before the deadline, and
    emits the alert at once if it is later. An expired timer emits the alert;
    so does a rising row that is later than the deadline, which then starts
    the next run.
    Times are microseconds; only the timer is rounded up to ms.
    A row behind the watermark, or without an event time, takes no part: what
    it would change may have been decided. It comes out with ``late`` set,
    its own time as ``start_ts`` and no alert.
    Output: ``(key, order of start, start_ts, alert_ts, late)``.
    """

    def __init__(self, key: str, order: str, us: str, value: str, interval_s: int):
        self.key, self.order, self.us, self.value = key, order, us, value
        self.interval_us = interval_s * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.keys = Frame(handle, "keys", [KEY, "v", "o", "t", "deadline", "timer", "fired"])  # the last value and the open run
        self.alarm = Alarm(handle)

    def _frame(self, key, order, start, alert, late: bool) -> pd.DataFrame:
        return pd.DataFrame({self.key: told(pd.Series(key)).array, self.order: order, "start_ts": pd.to_datetime(start, unit="us"),
                             "alert_ts": pd.to_datetime(alert, unit="us"), "late": late})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        wm = watermark_ms(timerValues)
        parts = []
        for pdf in keyed(key, rows, self.key):
            us = pdf[self.us].to_numpy("int64")
            late = (us == NO_TIME) | (us <= wm * 1000)
            if late.any():
                times = pd.Series(us[late]).where(us[late] != NO_TIME)
                yield self._frame(pdf[self.key][late].to_numpy(), pdf[self.order][late].to_numpy(), times, [None] * int(late.sum()), True)
            if not late.all():
                parts.append(pdf[~late])
        if not parts:
            return
        held = self.keys.get()
        of_held, pdf, codes, keys = in_order(iter(parts), held[KEY], self.key, [self.order])
        last, runs = [JAVA_DOUBLE_MIN_VALUE] * len(keys), [None] * len(keys)
        for k, v, *run in zip(of_held.tolist(), *[held[c].tolist() for c in self.keys.cols[1:]]):
            last[k], runs[k] = v, None if pd.isna(run[0]) else tuple(run)
        v, t, o = pdf[self.value].to_numpy("float64"), pdf[self.us].to_numpy("int64"), pdf[self.order].to_numpy()
        first = place(codes) == 0
        before = np.where(first, np.array(last, "float64")[codes], np.concatenate([[np.nan], v[:-1]]))
        rise = v > np.where(np.isnan(before), JAVA_DOUBLE_MIN_VALUE, before)  # after a null as at the start
        ends = np.append(np.flatnonzero(first)[1:], len(v))
        alerts = []
        for begin, end, k in zip(np.flatnonzero(first).tolist(), ends.tolist(), codes[first].tolist()):
            runs[k], due = self._rows(v[begin:end], t[begin:end], o[begin:end], rise[begin:end], runs[k])
            alerts += [(k, *x) for x in due]
            last[k] = v[end - 1]
        self._save(keys, last, runs)
        if alerts:
            k, *rest = (list(x) for x in zip(*alerts))
            yield self._frame(keys.take(k).to_numpy(), *rest, False)

    def _rows(self, v, t, o, rise, run) -> tuple[tuple | None, list[tuple]]:
        """A key's rows in order: its open run after them and the alerts that they give."""
        falls = np.append(np.flatnonzero(~rise), len(v))  # ends of rising runs
        alerts, at = [], 0
        while at < len(v):
            if rise[at]:
                end = int(falls[np.searchsorted(falls, at)])
                if run is None:
                    run = self._start(o[at], t[at])
                later = np.flatnonzero(t[at:end] > run[2])  # a rising row past the deadline
                if len(later):
                    at += int(later[0])
                    alerts += self._end(run, True)
                    run = self._start(o[at], t[at])
                    at += 1
                else:
                    at = end
            else:
                if run is not None:
                    alerts += self._end(run, t[at] > run[2])
                    run = None
                at += 1
        return run, alerts

    def _start(self, order, us) -> tuple:
        deadline = int(us) + self.interval_us
        return int(order), int(us), deadline, -(-deadline // 1000), False

    def _end(self, run: tuple, alert: bool) -> list[tuple]:
        """The run's alert, if it is due and was not given yet."""
        order, us, deadline, _, fired = run
        return [(order, us, deadline)] if alert and not fired else []

    def _save(self, keys: pd.Series, last: list, runs: list) -> None:
        """State of all keys of the bucket, with the alarm at the first deadline of a run."""
        none = (None,) * 5
        cells = zip(*[run or none for run in runs])
        frame = pd.DataFrame({KEY: keys, "v": pd.Series(last, dtype="float64")})
        for c, cell in zip(self.keys.cols[2:], cells):
            frame[c] = pd.array(cell, dtype="boolean" if c == "fired" else "Int64")
        self.keys.put(frame)
        timers = [run[3] for run in runs if run and not run[4]]
        if timers:
            self.alarm.no_later_than(min(timers))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.alarm.went_off()
        wm = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        held = self.keys.get()
        due = ((held["timer"] <= wm) & ~held["fired"]).fillna(False).to_numpy(bool)
        held.loc[due, "fired"] = True
        self.keys.put(held)
        rest = held["timer"][~held["fired"].fillna(True).to_numpy(bool)]
        if len(rest):
            self.alarm.no_later_than(int(rest.min()))
        if due.any():
            yield self._frame(*(held[c][due].to_numpy() for c in (KEY, "o")), *(held[c][due].to_numpy("int64") for c in ("t", "deadline")), False)

    def close(self) -> None:
        pass


class IdleTimer(StatefulProcessor):
    """Keyed process function with a processing-time timer (F-4): every row
    registers a timer one ``delay_ms`` later; each firing emits ``(key, fired_at)``."""

    def __init__(self, key: str, delay_ms: int = 1000):
        self.key, self.delay_ms = key, delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        for pdf in rows:
            if len(pdf):  # rows of one batch share their time, hence their timer
                self.handle.registerTimer(now + self.delay_ms)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({self.key: [key[0]],
                            "fired_at": [pd.Timestamp(expiredTimerInfo.getExpiryTimeInMs(), unit="ms")]})


class RollingMaxBy(StatefulProcessor):
    """Rolling ``maxBy(value)`` (A-3) and rolling reduce-max (A-4), one output
    per input row: the best record so far is the only state (ties keep the
    earlier record). Emits ``(key, order, max_value, max_<order>, max_<carry>…)``."""

    def __init__(self, key: str, order: str, value: str, carry: list[str], keep: list[str] | None = None):
        self.key, self.order, self.value, self.carry = key, order, value, list(carry)
        self.keep = list(keep or [])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.best = Frame(handle, "best", [KEY, "v", "o", *[f"c{i}" for i in range(len(self.carry))]])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = self.best.get()
        of_held, pdf, codes, keys = in_order(keyed(key, rows, self.key), held[KEY], self.key, [self.order])
        order, both, new = in_front(of_held, codes)
        value = pd.Series(np.concatenate([held["v"].to_numpy("float64"), pdf[self.value].to_numpy("float64")])[order])
        rank = value.fillna(-np.inf)  # a null is below every value
        first = place(both) == 0
        before = rank.groupby(both).cummax().shift().to_numpy()
        better = first | (rank.to_numpy() > before)  # the first record of a key, whatever its value
        at = np.maximum.accumulate(np.where(better, np.arange(len(rank)), 0))
        texts = [pdf[c].astype(str).where(pdf[c].notna(), None) for c in self.carry]

        def best_so_far(earlier: pd.Series, own: pd.Series) -> pd.Series:
            col = own if not len(earlier) else pd.concat([earlier, own], ignore_index=True)
            return col.take(order[at]).reset_index(drop=True)
        best = {"v": value.take(at).reset_index(drop=True), "o": best_so_far(held["o"], pdf[self.order].astype("Int64")),
                **{f"c{i}": best_so_far(held[f"c{i}"], text) for i, text in enumerate(texts)}}
        last = np.append(both[1:] != both[:-1], True)
        self.best.put(pd.DataFrame({KEY: keys.take(both[last]).to_numpy(), **{c: x[last].to_numpy() if c != "o" else x[last].array for c, x in best.items()}}))
        out = {self.key: pdf[self.key], self.order: pdf[self.order], **{c: pdf[c] for c in self.keep}}
        for name, c in zip([self.value, self.order, *self.carry], best):
            out[f"max_{name}"] = best[c][new].array
        yield pd.DataFrame(out)

    def close(self) -> None:
        pass


class Changelog(StatefulProcessor):
    """Retract/insert changelog of ``count(key), avg(value)`` per key (A-6 on a
    stream, ``toRetractStream``). State: the running ``(rows, values, sum)``,
    from which the last emitted row is known."""

    def __init__(self, key: str, order: str, value: str, sum_digits: int | None = None):
        self.key, self.order, self.value, self.sum_digits = key, order, value, sum_digits

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.acc = Frame(handle, "acc", [KEY, "n", "c", "s"])

    def _avg(self, c: np.ndarray, s: np.ndarray) -> np.ndarray:
        """The averages, null (NaN) over no values."""
        if self.sum_digits is not None:
            from decimal import ROUND_HALF_UP, Decimal
            unit = Decimal(1).scaleb(-self.sum_digits)
            s = np.array([float(Decimal(repr(x)).quantize(unit, ROUND_HALF_UP)) for x in s.tolist()], "float64")
        return np.divide(s, c, out=np.full(len(s), np.nan), where=c > 0)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = self.acc.get()
        of_held, pdf, codes, keys = in_order(keyed(key, rows, self.key), held[KEY], self.key, [self.order])
        order, both, new = in_front(of_held, codes)
        v = pdf[self.value].to_numpy("float64")
        there = ~np.isnan(v)
        # state rows lead with their totals, so running sums go on from them
        n, c, s = (np.concatenate([held[x].to_numpy(own.dtype), own])[order] for x, own in
                   (("n", np.ones(len(v), "int64")), ("c", there.astype("int64")), ("s", np.where(there, v, 0.0))))
        begins = np.flatnonzero(place(both) == 0)
        for x in (n, c, s):
            for begin, end in zip(begins.tolist(), np.append(begins[1:], len(both)).tolist()):
                np.cumsum(x[begin:end], out=x[begin:end])
        last = np.append(both[1:] != both[:-1], True)
        self.acc.put(pd.DataFrame({KEY: keys.take(both[last]).to_numpy(), "n": n[last], "c": c[last], "s": s[last]}))
        avg = self._avg(c, s)
        old_n, old_avg = np.where(place(both) > 0, np.roll(n, 1), 0)[new], np.roll(avg, 1)[new]
        n, avg = n[new], avg[new]
        insert = pd.DataFrame({self.key: pdf[self.key], self.order: pdf[self.order], "change_seq": 1, "is_insert": True, "cnt": n, "avg_value": avg})
        retract = insert.assign(change_seq=0, is_insert=False, cnt=old_n, avg_value=old_avg)[old_n > 0]
        yield pd.concat([insert, retract]).sort_index(kind="stable")

    def close(self) -> None:
        pass


class OverRowsEventTime(StatefulProcessor):
    """Row-frame OVER window in event-time order on a stream (W-8, exact).

    Rows are buffered and released by key in ``(event time, seq)`` order once
    the watermark has passed them; the frame takes the key's last ``preceding``
    released values from state. One event-time timer per bucket is pending at a
    time (at the earliest buffered row); when it fires, every buffered row
    behind the current watermark is released and the timer is re-armed at the
    next buffered row. A row that arrives behind the point its key is released to, or
    without an event time, is late: it is emitted with ``late = true`` and a
    frame of itself only. Counts are those of ``count(key)``: null values
    count, a null key does not.
    """

    def __init__(self, key: str, time: str, us: str, seq: str, value: str, preceding: int = 2):
        self.key, self.time, self.us, self.seq, self.value, self.preceding = key, time, us, seq, value, preceding

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.buf = Frame(handle, "buf", [KEY, "t", "o", "v"])
        self.tail = Frame(handle, "tail", [KEY, "v"])
        self.point = Frame(handle, "point", [KEY, "t", "o"])
        self.alarm = Alarm(handle)

    def _emit(self, rows: pd.DataFrame, cnt, avg, late) -> pd.DataFrame:
        counts = np.asarray(cnt, "int64") * rows[KEY].notna().to_numpy()
        times = rows["t"].reset_index(drop=True)
        return pd.DataFrame({self.key: told(rows[KEY]).to_numpy(), self.time: pd.to_datetime(times.where(times != NO_TIME), unit="us"),
                             self.seq: rows["o"].to_numpy(), "cnt": counts, "avg_value": avg, "late": late})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        point = self.point.get()
        first = None
        for pdf in keyed(key, rows, self.key):
            own = pd.DataFrame({KEY: pdf[self.key].to_numpy(), "t": pdf[self.us].to_numpy("int64"), "o": pdf[self.seq].to_numpy("int64"),
                                "v": pdf[self.value].to_numpy("float64")})
            of_point, codes, keys = coded(point[KEY], own[KEY])
            at, seq = np.full(len(keys), NO_TIME), np.zeros(len(keys), "int64")
            at[of_point], seq[of_point] = point["t"].to_numpy("int64"), point["o"].to_numpy("int64")
            at, seq, t, o = at[codes], seq[codes], own["t"].to_numpy(), own["o"].to_numpy()
            late = (t == NO_TIME) | (t < at) | ((t == at) & (o <= seq))
            if late.any():
                yield self._emit(own[late], np.ones(int(late.sum())), own["v"][late].to_numpy(), True)
            if not late.all():
                self.buf.append(own[~late])
                first = int(t[~late].min()) if first is None else min(first, int(t[~late].min()))
        if first is not None:
            self.alarm.no_later_than(-(-first // 1000))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.alarm.went_off()
        limit_us = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()) * 1000
        pending, tail, point = self.buf.get(), self.tail.get(), self.point.get()
        due = (pending["t"] <= limit_us).to_numpy(bool)
        rest = pending[~due]
        self.buf.put(rest)
        if len(rest):
            self.alarm.no_later_than(-(-int(rest["t"].min()) // 1000))
        if not due.any():
            return
        held = pd.concat([tail[KEY], point[KEY]], ignore_index=True)
        of_held, ready, codes, keys = in_order(iter([pending[due]]), held, KEY, ["t", "o"])
        avg, cnt, left = frame_means(tail, of_held[: len(tail)], ready["v"], codes, keys, self.preceding + 1)
        self.tail.put(left)
        last = np.append(codes[1:] != codes[:-1], True)
        others = point[~np.isin(of_held[len(tail):], codes)]
        ends = ready.loc[last, [KEY, "t", "o"]]
        self.point.put(pd.concat([others, ends], ignore_index=True) if len(others) else ends)
        yield self._emit(ready, cnt, avg, False)

    def close(self) -> None:
        pass

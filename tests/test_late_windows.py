"""Late rows, state cells and user folds on streams: nothing is dropped, and streams give what batches give."""

import random
from collections import defaultdict

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sensorflow.functions.fold import Fold, avg_fold, fold_by, min_by_fold
from sensorflow.operators import alerts, rolling, windows
from sensorflow.sinks.writers import stream_to_table
from sensorflow.sources import read_table_stream
from sensorflow.streaming import cells, event_windows as W
from sensorflow.streaming import ops as S

SCHEMA = "k string, seq bigint, ts timestamp, v double"
BASE = pd.Timestamp("2024-03-01")
END = ("end", -1, pd.Timestamp("2100-01-01").to_pydatetime(), 0.0)


def at(minutes):
    return None if minutes is None else (BASE + pd.Timedelta(minutes, "min")).to_pydatetime()


def batches(seed=0, n=240, size=40, jitter=90):
    """Micro-batches of rows whose event times advance with up to ``jitter`` minutes of disorder; nulls in every column."""
    r = random.Random(seed)
    rows = []
    for i in range(n):
        minute = None if r.random() < 0.05 else i * 2 - r.randrange(jitter) if r.random() < 0.4 else i * 2
        rows.append((None if r.random() < 0.1 else r.choice("abc"), i, at(minute), None if r.random() < 0.15 else float(r.randrange(20))))
    return [rows[a: a + size] for a in range(0, n, size)]


def replay(spark, tmp_path, parts, build, mode="append", keys=None, name="run"):
    src = str(tmp_path / name / "src")
    schema = None
    for part in [*parts, [END]]:  # one micro-batch each
        df = spark.createDataFrame(part, SCHEMA)
        schema = df.schema
        df.coalesce(1).write.mode("append").parquet(src)
    stream = read_table_stream(spark, src, schema, max_files_per_trigger=1)
    out = stream_to_table(spark, build(stream), str(tmp_path / name / "out"), str(tmp_path / name / "ckpt"), mode, keys)
    return out.where("k is null or k <> 'end'")


def simulated(parts, size, delay, lateness):
    """Firings and set-aside rows by the definition, one row after the other (minutes)."""
    wm, top = None, None
    held, fired, out = defaultdict(list), {}, []

    def told(w):
        rows = held[w]
        best = min(rows, key=lambda r: (r[3] is not None, r[3] if r[3] is not None else 0, r[1]))
        fired[w] = fired.get(w, 0) + 1
        out.append(("window", w[0], w[1], fired[w], len(rows), best[3], best[1], None))
    for part in parts:
        for k, seq, t, v in sorted(part, key=lambda r: r[1]):
            if t is None:
                out.append(("untimed", k, None, None, None, None, None, seq))
                continue
            minute = (pd.Timestamp(t) - BASE) / pd.Timedelta(1, "min")
            start = minute // size * size
            last = start + size - 1 / 60000
            w = (k, int(start))
            if wm is not None and last + lateness <= wm:
                out.append(("late", k, int(start), None, None, None, None, seq))
                continue
            if wm is not None and last <= wm:
                if held[w] and w not in fired:
                    told(w)
                held[w].append((k, seq, t, v))
                told(w)
            else:
                held[w].append((k, seq, t, v))
        for w in list(held):
            if wm is not None and w not in fired and held[w] and w[1] + size - 1 / 60000 <= wm:
                told(w)
        times = [(pd.Timestamp(t) - BASE) / pd.Timedelta(1, "min") for _, _, t, _ in part if t is not None]
        top = max([x for x in (top, *times) if x is not None], default=None)
        wm = None if top is None else top - delay
    for w in list(held):
        if held[w] and w not in fired:
            told(w)
    return sorted(out, key=str)


@pytest.mark.parametrize("seed,lateness", [(0, 30), (1, 0), (2, 200)])
def test_windows_with_refirings_and_late_rows(spark, tmp_path, seed, lateness):
    parts = batches(seed)
    fold = min_by_fold("v", "seq", W.US)
    out = replay(spark, tmp_path, parts, lambda d: W.fold_windows_stream(d, "k", "ts", "20 minutes", fold, ["v"], "seq", "10 minutes", f"{lateness} minutes"))
    start = F.expr(f"cast((unix_seconds(cast(window_start as timestamp)) - {int(BASE.timestamp())}) / 60 as int)")
    got = sorted((tuple(r) for r in out.select("output", "k", start, "firing", "cnt", "min_v", "min_seq", "late_seq").collect()), key=str)
    want = simulated(parts, 20, 10, lateness)
    assert got == want
    assert {w[0] for w in want} == ({"window", "late", "untimed"} if lateness < 200 else {"window", "untimed"})
    assert seed == 1 or any(w[0] == "window" and w[3] > 1 for w in want)
    # every row is in its window's last firing or set aside
    last = {}
    for w in got:
        if w[0] == "window":
            last[w[1:3]] = max(w[3:5], last.get(w[1:3], (0, 0)))
    assert sum(c for _, c in last.values()) + sum(w[0] != "window" for w in got) == sum(len(p) for p in parts)


def test_many_refirings_of_one_window(spark, tmp_path):
    """More re-firing rows than one doubling step, in several frames of a batch."""
    first = [("a", 0, at(0), 5.0), ("a", 1, at(100), 1.0)]
    again = [("a", 2 + k, at(5), float(90 - k)) for k in range(90)]
    out = replay(spark, tmp_path, [first, again], lambda d: W.fold_windows_stream(
        d, "k", "ts", "20 minutes", min_by_fold("v", "seq", W.US), ["v"], "seq", "10 minutes", "1 day"))
    got = sorted((r["firing"], r["cnt"], r["min_v"]) for r in out.where("cnt is not null and window_end < timestamp'2024-03-01 01:00:00'").collect())
    assert got == [(1, 1, 5.0)] + [(2 + k, 2 + k, min(5.0, 90.0 - k)) for k in range(90)]


def flat(rows):
    return [r for part in rows for r in part]


def late_of(parts, delay):
    """Rows at or behind the watermark of their micro-batch, and rows without a time."""
    out, top = set(), None
    for part in parts:
        wm = None if top is None else top - pd.Timedelta(delay, "min")
        out |= {r[1] for r in part if r[2] is None or (wm is not None and pd.Timestamp(r[2]) <= wm)}
        top = max([pd.Timestamp(r[2]) for r in part if r[2] is not None] + ([top] if top is not None else []))
    return out


def test_rise_alert_gives_late_rows(spark, tmp_path):
    parts = batches(3)
    out = replay(spark, tmp_path, parts, lambda d: S.rise_alert_stream(d, "k", "seq", "ts", "v", 8 * 60, "10 minutes"))
    late = {r["seq"] for r in out.where("late").collect()}
    assert late == late_of(parts, 10) and len(late) > 20
    kept = spark.createDataFrame([r for r in flat(parts) if r[1] not in late] + [END], SCHEMA)
    want = alerts.rise_alert(kept, "k", "seq", "ts", "v", 8 * 60).where("k is null or k <> 'end'")
    cols = ["k", "seq", "start_ts", "alert_ts"]
    assert sorted(map(str, out.where("not late").select(cols).collect())) == sorted(map(str, want.select(cols).collect()))


def test_over_rows_counts_like_the_batch_form(spark, tmp_path):
    """Null values count, null keys do not, and the rows that come too late for their place come out."""
    parts = batches(4, jitter=300)
    out = replay(spark, tmp_path, parts, lambda d: S.over_rows_event_time_stream(d, "k", "ts", "seq", "v", 2, "10 minutes"))
    assert out.count() == len(flat(parts))
    late = {r["seq"] for r in out.where("late").collect()}
    assert {r[1] for r in flat(parts) if r[2] is None} < late <= late_of(parts, 10)
    kept = spark.createDataFrame([r for r in flat(parts) if r[1] not in late], SCHEMA)
    want = windows.over_rows(kept, "k", ["ts", "seq"], "v", 2)
    got = out.where("not late")
    assert sorted((r["seq"], r["cnt"], r["avg_value"]) for r in got.collect()) == sorted((r["seq"], r["cnt"], r["avg_value"]) for r in want.collect())


def test_ascending_watermark(spark, tmp_path):
    """Without a delay (T-3) the clock is the largest event time of the earlier batches."""
    parts = [[("a", 0, at(0), 1.0)], [("a", 1, at(1), 2.0), ("a", 2, at(0), 3.0)], [("a", 3, at(1), 4.0)]]
    out = replay(spark, tmp_path, parts, lambda d: S.rise_alert_stream(d, "k", "seq", "ts", "v", 600, "0 seconds"))
    assert sorted(r["seq"] for r in out.where("late").collect()) == [2, 3]


def test_user_function_over_buffered_rows(spark, tmp_path):
    parts = batches(5)

    def spread(rows):
        return pd.DataFrame({"k": [rows["k"].iloc[0]], "window_end": [rows["window_end"].iloc[0]], "n": [len(rows)],
                             "first_seq": [rows["seq"].iloc[0]], "sum_v": [rows["v"].sum()], "last_ts": [rows["ts"].max()]})
    schema = "k string, window_end timestamp_ntz, n bigint, first_seq bigint, sum_v double, last_ts timestamp_ntz"
    out = replay(spark, tmp_path, parts, lambda d: W.apply_windows_stream(d, "k", "ts", "20 minutes", spread, schema, "seq", "10 minutes"))
    late = {r["late_seq"] for r in out.where("output <> 'window'").collect()}
    want_late = {w[-1] for w in simulated(parts, 20, 10, 0) if w[0] != "window"}
    assert late == want_late and out.where("output = 'untimed'").count() > 0
    kept = spark.createDataFrame([r for r in flat(parts) if r[1] not in late], SCHEMA)
    want = windows.tumble_apply_rows(kept.orderBy("seq"), "k", "ts", "20 minutes", lambda rows: spread(rows.sort_values("seq").reset_index(drop=True)), schema)
    assert sorted(map(str, out.where("output = 'window'").select(want.columns).collect())) == sorted(map(str, want.collect()))


def longest_run() -> Fold:
    """Rows and the longest span between first and last ``seq`` of a group: one contract for batch, windows and keys."""
    return Fold(acc="n bigint, lo bigint, hi bigint", result="n bigint, span bigint",
                add=lambda g: pd.DataFrame({"n": g.size(), "lo": g["seq"].min(), "hi": g["seq"].max()}),
                merge=lambda g: pd.DataFrame({"n": g["n"].sum(), "lo": g["lo"].min(), "hi": g["hi"].max()}),
                finish=lambda a: pd.DataFrame({"n": a["n"], "span": a["hi"] - a["lo"]}))


@pytest.mark.parametrize("fold,inputs", [(longest_run(), ["seq"]), (avg_fold("v"), ["v"])])
def test_one_fold_contract(spark, tmp_path, fold, inputs):
    parts = batches(6)
    rows = spark.createDataFrame(flat(parts), SCHEMA)
    batch = fold_by(rows, ["k"], fold, inputs)
    stream = replay(spark, tmp_path, parts, lambda d: cells.fold_stream(d, "k", fold, inputs), "update", ["k"])
    assert sorted(map(str, stream.select(batch.columns).collect())) == sorted(map(str, batch.collect()))


def test_state_cells_expire_and_close(spark, tmp_path):
    """A cell with a time to live loses what was not written for that long; resources are closed once a task."""
    import time
    mark = str(tmp_path / "closed")

    def opened():
        return []

    def closed(seen):
        with open(f"{mark}-{time.time_ns()}", "w") as f:
            f.write(",".join(seen))

    def note(key, rows, cell, seen):
        seen.append(str(key))
        had = cell["last"].get()[0] if cell["last"].exists() else None
        cell["last"].update((int(rows["seq"].iloc[-1]),))
        for s in rows["seq"].tolist():
            cell["seen"].updateValue((int(s),), (True,))
        total = cell["total"].add((float(rows["v"].sum()),))[0]
        return pd.DataFrame({"k": [key], "had": pd.array([had], dtype="Int64"), "total": [total]})
    state = {"last": cells.Value("seq bigint", ttl_ms=6_000), "seen": cells.Table("seq bigint", "yes boolean"),
             "total": cells.Reducing("v double", lambda held, new: (held[0] + new[0],))}
    src, out, ckpt = (str(tmp_path / x) for x in ("src", "out", "ckpt"))

    def run(rows):
        df = spark.createDataFrame(rows, SCHEMA)
        df.write.mode("append").parquet(src)
        build = cells.rich_map_stream(read_table_stream(spark, src, df.schema), "k", ["seq"], state, note, "k string, had bigint, total double", opened, closed)
        return stream_to_table(spark, build, out, ckpt, timeout_s=120, idle_batches=False)
    run([("a", 1, at(0), 1.0), ("b", 2, at(0), 2.0)])
    assert cells.read_cell(spark, ckpt, "last").count() == 2
    time.sleep(7)
    result = run([("a", 3, at(0), 10.0)])
    assert sorted((r["k"], r["had"], r["total"]) for r in result.collect()) == [("a", None, 1.0), ("a", None, 11.0), ("b", None, 2.0)]
    left = cells.read_cell(spark, ckpt, "last").collect()
    assert [r["key"]["k"] for r in left] == ["a"]  # the expired one has left the store, not only from sight
    assert cells.read_cell(spark, ckpt, "seen").count() == 3  # without a time to live nothing goes
    told = [p.read_text() for p in tmp_path.glob("closed-*")]
    assert sorted(x for t in told for x in t.split(",") if x) == ["a", "a", "b"]


def affine(spark_value):
    """Composition of maps x -> a x + b modulo a prime: associative, not commutative, not field by field."""
    p = 10007
    start = {"a": (F.col("seq") % 50 + 1).cast("bigint"), "b": F.coalesce(spark_value, F.lit(3)).cast("bigint")}
    return start, lambda left, right: pd.DataFrame({"a": right["a"] * left["a"] % p, "b": (right["a"] * left["b"] + right["b"]) % p}), p


@pytest.mark.parametrize("segments", [None, "every"])
def test_user_reduce_batch_and_stream(spark, tmp_path, segments):
    parts = batches(7)
    rows = flat(parts)
    start, merge, p = affine(F.col("v"))
    want, held = {}, {}
    for k, seq, _, v in rows:
        a, b = seq % 50 + 1, int(3 if v is None else v)
        if k in held:
            x, y = held[k]
            a, b = a * x % p, (a * y + b) % p
        held[k] = want[seq] = (a, b)
    df = spark.createDataFrame(rows, SCHEMA)
    batch = rolling.rolling_reduce_by(df, "k", "seq", start, merge, None if segments is None else F.col("seq"))
    assert batch.columns == ["k", "seq", "ts", "v", "a", "b"]
    assert {r["seq"]: (r["a"], r["b"]) for r in batch.collect()} == want
    if segments is None:
        stream = replay(spark, tmp_path, parts, lambda d: cells.rolling_reduce_by_stream(d, "k", "seq", start, merge))
        assert {r["seq"]: (r["a"], r["b"]) for r in stream.collect()} == want


def test_user_reduce_over_many_batches_of_one_key(spark):
    """One key over several Arrow batches and segments."""
    df = spark.range(25_000).select(F.lit("x").alias("k"), F.col("id").alias("seq"), F.lit(None).cast("double").alias("v"))
    start, merge = rolling.best_stretch("best", F.col("seq") % 7 - 3)
    got = rolling.rolling_reduce_by(df, "k", "seq", start, merge, n_segments=3).select("seq", "best").orderBy("seq").collect()
    here = best = None
    for r in got:
        x = r["seq"] % 7 - 3
        here = x if here is None else max(x, here + x)
        best = here if best is None else max(best, here)
        assert r["best"] == best
    assert rolling.rolling_reduce_by(df.limit(0), "k", "seq", start, merge).collect() == []

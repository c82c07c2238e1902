"""Streams of very many keys: state and calls are by hash bucket of keys, results are those of the batch forms."""

import pytest
from pyspark.sql import functions as F

from sensorflow.functions.fold import avg_fold, min_by_fold
from sensorflow.operators import rolling
from sensorflow.sinks.writers import stream_to_table
from sensorflow.sources import read_table_stream
from sensorflow.streaming import cells, event_windows as W
from sensorflow.streaming import ops as S
from sensorflow.streaming.buckets import BUCKETS

KEYS = 1500


def rows(spark):
    """Two rows of most keys, three of some; a null key and null values."""
    return spark.range(2 * KEYS + 300).select(
        F.when(F.col("id") % KEYS != 7, F.col("id") % KEYS).alias("k"), F.col("id").alias("seq"),
        (F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") % 5000)).cast("timestamp_ntz").alias("ts"),
        F.when(F.col("id") % 11 != 0, (F.col("id") * 37 % 101).cast("double")).alias("v"))


def replay(spark, tmp_path, build, mode="append", keys=None, end=False):
    src, df = str(tmp_path / "src"), rows(spark)
    df.where(F.col("seq") < KEYS).coalesce(1).write.parquet(src)
    df.where(F.col("seq") >= KEYS).coalesce(1).write.mode("append").parquet(src)
    if end:
        df.limit(1).select(F.lit(-1).cast("bigint").alias("k"), F.lit(-1).cast("bigint").alias("seq"),
                           F.lit("2100-01-01 00:00:00").cast("timestamp_ntz").alias("ts"), F.lit(0.0).alias("v")).coalesce(1).write.mode("append").parquet(src)
    stream = read_table_stream(spark, src, df.schema, max_files_per_trigger=1)
    return stream_to_table(spark, build(stream), str(tmp_path / "out"), str(tmp_path / "ckpt"), mode, keys)


def groups(spark, tmp_path, cell):
    """How many groups have state: one call each in a micro-batch."""
    return cells.read_cell(spark, str(tmp_path / "ckpt"), cell).select("key").distinct().count()


def same(got, want, *cols):
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted((tuple(r) for r in got.select(*cols).collect()), key=key) == sorted((tuple(r) for r in want.select(*cols).collect()), key=key)


def test_running_count(spark, tmp_path):
    out = replay(spark, tmp_path, lambda d: S.running_count_stream(d, "k", "seq"))
    same(out, rolling.running_count(rows(spark), ["k"], ["seq"]), "k", "seq", "cnt")
    assert groups(spark, tmp_path, "count") <= BUCKETS + 1


def test_rolling_max_and_changelog(spark, tmp_path):
    out = replay(spark, tmp_path / "max", lambda d: S.rolling_max_by_stream(d, "k", "seq", "v", ["ts"], keep=[]))
    want = rolling.rolling_max_by(rows(spark), "k", "seq", "v", ["ts"])
    valued = "max_v is not null"  # before a key's first value the forms name different records
    same(out.where(valued), want.where(valued), "k", "seq", "max_v", "max_seq", "max_ts")
    assert groups(spark, tmp_path / "max", "best") <= BUCKETS + 1
    out = replay(spark, tmp_path / "log", lambda d: S.changelog_stream(d, "k", "seq", "v", sum_digits=6)).where("k is not null")
    want = rolling.changelog(rows(spark).where("k is not null"), "k", "seq", "v", sum_digits=6)
    same(out, want, "k", "seq", "change_seq", "is_insert", "cnt", "avg_value")
    assert groups(spark, tmp_path / "log", "acc") <= BUCKETS + 1


@pytest.mark.parametrize("op", ["windows", "rise", "over"])
def test_event_time(spark, tmp_path, op):
    build, cell = {"windows": (lambda d: W.fold_windows_stream(d, "k", "ts", "1 day", min_by_fold("v", "seq", W.US), ["v"], "seq", "0 seconds"), "windows"),
                   "rise": (lambda d: S.rise_alert_stream(d, "k", "seq", "ts", "v", 1000, "0 seconds"), "keys"),
                   "over": (lambda d: S.over_rows_event_time_stream(d, "k", "ts", "seq", "v", 2, "0 seconds"), "tail")}[op]
    out = replay(spark, tmp_path, build, end=True).where("k is null or k >= 0").cache()
    everything = rows(spark)
    if op == "windows":
        same(out, everything.groupBy("k").agg(F.count("*").alias("cnt"), F.min("v").alias("m")).select("k", "cnt"), "k", "cnt")
    elif op == "over":
        assert out.count() == everything.count()
        same(out, everything.where("k is not null").selectExpr("k", "seq", "count(*) over (partition by k order by seq) as cnt")
             .unionByName(everything.where("k is null").selectExpr("k", "seq", "0L as cnt")), "k", "seq", "cnt")
    else:  # a key's rows are 1500 seconds apart: every rise from a known value runs out, and so does every first value
        assert out.where("alert_ts is not null").count() > KEYS / 2 and out.where("late").count() == 0
    assert groups(spark, tmp_path, cell) <= BUCKETS + 1


def test_folds_and_reduces(spark, tmp_path):
    out = replay(spark, tmp_path / "fold", lambda d: cells.fold_stream(d, "k", avg_fold("v"), ["v"]), "update", ["k"])
    same(out, rows(spark).groupBy("k").agg(F.avg("v").alias("avg_value")), "k", "avg_value")
    assert groups(spark, tmp_path / "fold", "acc") <= BUCKETS + 1
    start, merge = rolling.best_stretch("best", F.col("seq") % 7 - 3)
    out = replay(spark, tmp_path / "reduce", lambda d: cells.rolling_reduce_by_stream(d, "k", "seq", start, merge))
    same(out, rolling.rolling_reduce_by(rows(spark), "k", "seq", start, merge), "k", "seq", "best")
    assert groups(spark, tmp_path / "reduce", "acc") <= BUCKETS + 1


def test_state_cells(spark, tmp_path):
    """All kinds of cells without a time to live, across micro-batches."""
    state = {"n": cells.Value("n bigint"), "seen": cells.Items("seq bigint"), "odd": cells.Table("odd int", "seq bigint"),
             "peak": cells.Reducing("v double", lambda held, new: max(held, new))}

    def note(key, frame, cell):
        import pandas as pd
        cell["n"].update(((cell["n"].get()[0] if cell["n"].exists() else 0) + len(frame),))
        cell["seen"].appendList([(s,) for s in frame["seq"].tolist()])
        for s in frame["seq"].tolist():
            cell["odd"].updateValue((s % 2,), (s,))
        for v in frame["v"].dropna().tolist():
            cell["peak"].add((v,))
        last = frame["seq"].iloc[-1] % 2
        return pd.DataFrame({"k": [key], "n": [cell["n"].get()[0]], "seen": [len(list(cell["seen"].get()))],
                             "latest": [cell["odd"].getValue((int(last),))[0]], "peak": [(cell["peak"].get() or (None,))[0]]})
    out = replay(spark, tmp_path, lambda d: cells.rich_map_stream(d, "k", ["seq"], state, note, "k bigint, n bigint, seen bigint, latest bigint, peak double"),
                 "update", None)
    out = out.groupBy("k").agg(F.max_by(F.struct("n", "seen", "latest", "peak"), "n").alias("s")).select("k", "s.*")
    same(out, rows(spark).groupBy("k").agg(F.count("*").alias("n"), F.count("*").alias("seen"), F.max("seq").alias("latest"), F.max("v").alias("peak")),
         "k", "n", "seen", "latest", "peak")
    assert groups(spark, tmp_path, "n") <= BUCKETS + 1

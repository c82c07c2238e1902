"""Streaming forms: the same final answer as the batch operators, across micro-batches."""

import os
import sqlite3
import time

import pytest
from pyspark.sql import functions as F

from sensorflow.sinks.writers import (encode_kafka_csv, read_batches, stream_to_table, two_way_writer,
                                      upsert_dbapi, upsert_latest, upsert_state)
from sensorflow.sources import decode_kafka_value, parse_csv_value, read_table_stream
from sensorflow.streaming import ops as S
from tests.conftest import collect
from tests.test_windows import OVER


@pytest.fixture()
def sliced(spark, readings, tmp_path):
    """The fixture written as 3 Parquet files by seq range, oldest first, so a
    file stream with one file per trigger replays it in 3 micro-batches."""
    src = str(tmp_path / "src")
    for i, (lo, hi) in enumerate([(0, 6), (6, 12), (12, 17)]):
        readings.where(f"seq >= {lo} and seq < {hi}").coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)
    return src


def _stream(spark, readings, src):
    return read_table_stream(spark, src, readings.schema, max_files_per_trigger=1)


def _run(spark, stream, tmp_path, mode="append", keys=None):
    return stream_to_table(spark, stream, str(tmp_path / "out"), str(tmp_path / "ckpt"), mode, keys)


def test_running_count_stream(spark, readings, sliced, tmp_path):
    out = _run(spark, S.running_count_stream(_stream(spark, readings, sliced), "id", "seq"), tmp_path)
    assert collect(out, "seq", "cnt") == sorted(
        (r.seq, r.cnt) for r in __import__("sensorflow.operators.rolling", fromlist=["x"])
        .running_count(readings, ["id"], ["seq"]).collect())
    assert spark.read.parquet(str(tmp_path / "out")).select("_batch").distinct().count() == 3


def test_jump_alert_stream(spark, readings, sliced, tmp_path):
    out = _run(spark, S.jump_alert_stream(_stream(spark, readings, sliced), "id", "seq", "temperature", 10.0), tmp_path)
    assert [r[0] for r in collect(out, "seq")] == [3, 4, 5, 7, 8, 15, 16]


def test_count_window_stream(spark, readings, sliced, tmp_path):
    out = _run(spark, S.count_window_avg_stream(_stream(spark, readings, sliced), "id", "seq", "temperature"), tmp_path)
    assert [(s, round(a, 6)) for s, a in collect(out, "seq", "avg_value")] == [
        (1, 36.8), (3, 20.9), (5, 27.15), (7, 32.7), (10, 39.6), (12, 39.6), (14, 36.8), (16, 42.4)]


def test_over_rows_stream_single_batch(spark, readings, tmp_path):
    src = str(tmp_path / "one")
    readings.coalesce(1).write.parquet(src)
    s = read_table_stream(spark, src, readings.schema)
    out = _run(spark, S.over_rows_stream(s, "id", ["timestamp", "seq"], "temperature", 2), tmp_path)
    assert {q: (c, round(a, 6)) for q, c, a in collect(out, "seq", "cnt", "avg_value")} == OVER


def test_word_count_stream(spark, tmp_path):
    src = str(tmp_path / "lines")
    spark.read.text(os.path.join(os.path.dirname(__file__), "data", "hello.txt")).write.text(src)
    s = spark.readStream.format("text").load(src)
    out = _run(spark, S.word_count_stream(s), tmp_path, "update", ["word"])
    assert dict(collect(out, "word", "cnt"))["hello"] == 7


def test_avg_fold_stream(spark, readings, sliced, tmp_path):
    out = _run(spark, S.avg_fold_stream(_stream(spark, readings, sliced), "id", "temperature"), tmp_path,
               "update", ["id"])
    assert {i: round(a, 6) for i, a in collect(out, "id", "avg_value")} == {
        "sensor_1": 41.466667, "sensor_6": 27.15, "sensor_7": 24.366667, "sensor_10": 39.6}


def test_event_window_min_stream(spark, readings, sliced, tmp_path):
    s = S.event_window_min_stream(_stream(spark, readings, sliced), "id", "timestamp", "15 seconds",
                                  "temperature", "seq", 2, 60)
    out = _run(spark, s, tmp_path, "update", ["id", "window_start", "window_end"])
    assert collect(out, "id", "cnt", "min_temperature", "min_seq") == sorted(
        [("sensor_1", 5, 35.8, 14), ("sensor_1", 1, 36.8, 1), ("sensor_6", 4, 15.4, 2), ("sensor_7", 3, 7.7, 8),
         ("sensor_10", 4, 38.1, 10)])


def test_rise_alert_stream_with_end_marker(spark, readings, tmp_path):
    """Event-time timers fire once the watermark passes; a far-future marker row
    plays the part of the end-of-input watermark of a bounded source."""
    src = str(tmp_path / "rise")
    readings.coalesce(1).write.parquet(src)
    marker = spark.createDataFrame([(99, "__end__", 4102444800, 0.0)], readings.schema)
    marker.write.mode("append").parquet(src)
    s = read_table_stream(spark, src, readings.schema)
    out = _run(spark, S.rise_alert_stream(s, "id", "seq", "timestamp", "temperature", 10, "2 seconds"), tmp_path)
    got = collect(out.where("id != '__end__'").withColumn("s", F.unix_seconds(F.col("start_ts").cast("timestamp"))),
                  "id", "s")
    assert got == [("sensor_1", 1547718199), ("sensor_10", 1547718205)]


def test_resume_from_checkpoint(spark, readings, tmp_path):
    src, out, ckpt = str(tmp_path / "src"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    readings.where("seq < 9").write.parquet(src)
    first = stream_to_table(spark, S.running_count_stream(read_table_stream(spark, src, readings.schema), "id", "seq"),
                            out, ckpt)
    assert first.count() == 9
    readings.where("seq >= 9").write.mode("append").parquet(src)
    final = stream_to_table(spark, S.running_count_stream(read_table_stream(spark, src, readings.schema), "id", "seq"),
                            out, ckpt)
    assert collect(final.where("id = 'sensor_1'"), "seq", "cnt") == [(0, 1), (1, 2), (13, 3), (14, 4), (15, 5), (16, 6)]
    assert final.count() == 17


def test_late_split_stream(spark, tmp_path):
    """Three micro-batches of two rows; rows of a batch are split against the
    high-water mark of earlier batches."""
    schema = "seq bigint, timestamp bigint, temperature double"
    src = str(tmp_path / "late_src")
    batches = [[(0, 1547718199, 1.0), (1, 1547718300, 2.0)], [(2, 1547718100, 3.0), (3, 1547718301, 4.0)],
               [(4, 1547718100, 5.0), (5, 1547718302, 6.0)]]
    for b in batches:
        spark.createDataFrame(b, schema).coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    main, side, state = str(tmp_path / "main"), str(tmp_path / "side"), str(tmp_path / "hwm")
    fn = S.late_split_batch_writer(spark, state, main, side, "timestamp", "15 seconds", 2, 60)
    q = s.writeStream.foreachBatch(fn).option("checkpointLocation", str(tmp_path / "ck")) \
        .trigger(availableNow=True).start()
    q.awaitTermination(300)
    assert sorted(r.temperature for r in spark.read.parquet(side).collect()) == [3.0, 5.0]
    assert spark.read.parquet(main).count() == 4


def test_upsert_parquet_and_dbapi(spark, readings, sliced, tmp_path):
    target = str(tmp_path / "upsert")
    fn = upsert_latest(target, "id", "seq", ["id", "temperature"])
    q = (_stream(spark, readings, sliced).writeStream.foreachBatch(fn)
         .option("checkpointLocation", str(tmp_path / "uck")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    state = dict(collect(upsert_state(spark, target, "id", ["id", "temperature"]), "id", "temperature"))
    golden = {"sensor_1": 35.8, "sensor_6": 19.4, "sensor_7": 7.7, "sensor_10": 40.1}
    assert state == golden

    db = str(tmp_path / "sensor.db")
    with sqlite3.connect(db) as c:
        c.execute("create table sensor_temp (id text primary key, temp real)")
        c.execute("insert into sensor_temp values ('sensor_1', 0.0)")
    upsert_dbapi(readings.withColumnRenamed("temperature", "temp"), lambda: sqlite3.connect(db),
                 "sensor_temp", "id", ["temp"], order="seq")
    with sqlite3.connect(db) as c:
        assert dict(c.execute("select id, temp from sensor_temp").fetchall()) == golden


def test_two_way_writer(spark, readings, tmp_path):
    fn = two_way_writer(str(tmp_path / "high"), str(tmp_path / "low"), ~(F.col("temperature") > 30))
    fn(readings, 0)
    fn(readings, 0)  # a replayed batch rewrites the same folder
    assert spark.read.parquet(str(tmp_path / "high")).count() == 12
    assert spark.read.parquet(str(tmp_path / "low")).count() == 5
    assert read_batches(spark, str(tmp_path / "low"), ["seq"]).count() == 5


def test_kafka_value_codec(spark, readings):
    enc = encode_kafka_csv(readings, ["id", "temperature"])
    assert enc.first()["value"] == "sensor_1,36.8"
    raw = readings.select(F.concat_ws(",", "id", "timestamp", "temperature").cast("binary").alias("value"))
    back = parse_csv_value(decode_kafka_value(raw))
    assert collect(back, "id", "timestamp", "temperature") == collect(readings, "id", "timestamp", "temperature")


def test_idle_timer_processing_time(spark, readings, tmp_path):
    src = str(tmp_path / "idle")
    readings.coalesce(1).write.parquet(src)
    s = S.idle_timer_stream(read_table_stream(spark, src, readings.schema), "id", 500)
    q = (s.writeStream.foreachBatch(lambda b, i: b.write.mode("overwrite").parquet(f"{tmp_path}/idle_out/_batch={i}"))
         .option("checkpointLocation", str(tmp_path / "ick")).trigger(processingTime="1 second").start())
    try:
        deadline = time.time() + 60
        fired = 0
        while time.time() < deadline and fired < 4:
            time.sleep(1)
            try:
                fired = spark.read.parquet(f"{tmp_path}/idle_out").select("id").distinct().count()
            except Exception:  # noqa: BLE001
                fired = 0
    finally:
        q.stop()
    assert fired == 4


def test_rolling_max_by_and_changelog_stream(spark, readings, sliced, tmp_path):
    from tests.test_aggregates import A3
    out = stream_to_table(spark, S.rolling_max_by_stream(_stream(spark, readings, sliced), "id", "seq", "temperature",
                                                         ["timestamp"]),
                          str(tmp_path / "mb"), str(tmp_path / "mbck"))
    assert dict(collect(out, "seq", "max_seq")) == A3
    assert dict(collect(out, "seq", "max_timestamp"))[1] == 1547718199
    ch = stream_to_table(spark, S.changelog_stream(_stream(spark, readings, sliced), "id", "seq", "temperature"),
                         str(tmp_path / "ch"), str(tmp_path / "chck"))
    assert ch.count() == 30 and ch.where("is_insert").count() == 17


def test_window_fold_stream(spark, readings, sliced, tmp_path):
    from sensorflow.functions.fold import count_fold
    from sensorflow.streaming.event_windows import fold_windows_stream
    from tests.test_windows import W15
    # the end marker is the last file of the replay, so it arrives in the last micro-batch
    spark.createDataFrame([(99, "__end__", 4102444800, 0.0)], readings.schema).coalesce(1) \
        .write.mode("append").parquet(sliced)
    s = _stream(spark, readings, sliced)
    out = _run(spark, fold_windows_stream(s, "id", "timestamp", "15 seconds", count_fold("cnt"), [], "seq", "62 seconds"), tmp_path)
    out = out.where("id <> '__end__'").withColumn("end_s", F.unix_seconds(F.col("window_end").cast("timestamp")) - 1547718000)
    assert collect(out, "id", "end_s", "cnt") == [w[:3] for w in W15]


def test_csv_append_and_print_sinks(spark, readings, tmp_path):
    from sensorflow.sinks import print_sink, write_csv_append
    from sensorflow.sources import with_processing_time
    src = str(tmp_path / "p")
    readings.write.parquet(src)
    s = read_table_stream(spark, src, readings.schema).where("id = 'sensor_6'").select("id", "temperature")
    q = write_csv_append(s, str(tmp_path / "csv"), str(tmp_path / "csvck")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    back = spark.read.schema("id string, temperature double").csv(str(tmp_path / "csv"))
    assert sorted(r.temperature for r in back.collect()) == [15.4, 19.4, 26.4, 47.4]
    q2 = print_sink(with_processing_time(s), "sensor").trigger(availableNow=True).start()
    q2.awaitTermination(120)
    assert q2.exception() is None


def test_over_rows_event_time_stream(spark, readings, sliced, tmp_path):
    """Out-of-order rows (seq 13-16 carry an earlier event time than seq 1) are
    released in event-time order: all 17 golden frames, across 3 micro-batches."""
    spark.createDataFrame([(99, "__end__", 4102444800, 0.0)], readings.schema).coalesce(1) \
        .write.mode("append").parquet(sliced)
    s = S.over_rows_event_time_stream(_stream(spark, readings, sliced), "id", "timestamp", "seq",
                                      "temperature", 2, "62 seconds")
    out = _run(spark, s, tmp_path).where("id <> '__end__'")
    assert out.where("late").count() == 0
    assert {q: (c, round(a, 6)) for q, c, a in collect(out, "seq", "cnt", "avg_value")} == OVER


def test_a_replayed_stream_leaves_no_copy_of_its_table_and_no_shuffle_files(spark, monkeypatch):
    from pathlib import Path

    from pyspark.sql import functions as F

    from sensorflow import catalog_stream as CS
    from sensorflow.session import TIDY, checkpoint_root
    from sensorflow.streaming import ops

    seen = []

    def count(d):
        out = ops.running_count_stream(d, "user_id", "event_id")
        seen.append(spark.conf.get(TIDY))
        return out

    started = CS.tidy
    monkeypatch.setattr(CS, "tidy", lambda s: seen.append("tidy") or started(s))
    rows = spark.range(300).selectExpr("id as event_id", "id % 7 as user_id")
    out = CS._run(CS.Slices(rows, F.floor(F.col("event_id") / 100), 3), "leaves-nothing", count)
    base = next(Path(checkpoint_root(spark).removeprefix("file:")).glob("leaves-nothing-*"))
    assert sorted((r["event_id"], r["cnt"]) for r in out.collect()) == [(k, k // 7 + 1) for k in range(300)]
    assert not (base / "source").exists()
    assert seen == ["false", "tidy"] and spark.conf.get(TIDY) == "false"

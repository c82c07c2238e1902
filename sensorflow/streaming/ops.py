"""Streaming operators: the same semantics as the batch operators, on
streaming DataFrames (``readStream`` … ``writeStream``).

Built-in streaming aggregation is used where Spark has it (word count,
windowed min with a watermark); keyed per-record state goes through
``transformWithStateInPandas`` with the processors of
:mod:`sensorflow.streaming.processors`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorflow.functions.fold import avg_fold
from sensorflow.operators.aggregates import words
from sensorflow.schema import as_ntz, event_time, tumble_end
from sensorflow.session import prepare
from sensorflow.streaming import processors as P
from sensorflow.streaming.buckets import BUCKETS, by_bucket
from sensorflow.streaming.cells import fold_stream
from sensorflow.streaming.event_windows import US, clocked


def _ddl(df: DataFrame, *names: str) -> str:
    return ", ".join(f"`{n}` {df.schema[n].dataType.simpleString()}" for n in names)


def word_count_stream(lines: DataFrame, col: str = "value", sep: str = " ") -> DataFrame:
    """Streaming word count (A-2) as a running aggregate; run it in update mode."""
    return words(lines, col, sep).groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


def running_count_stream(df: DataFrame, key: str, order) -> DataFrame:
    prepare(df.sparkSession)
    order = [order] if isinstance(order, str) else list(order)
    return by_bucket(df, key).transformWithStateInPandas(
        P.RunningCount(key, order), f"{_ddl(df, key, *order)}, cnt bigint", "Append", "None")


def running_count_many_keys_stream(df: DataFrame, key: str, order: list[str], buckets: int = BUCKETS) -> DataFrame:
    """:func:`running_count_stream` in a chosen number of hash buckets of keys, for keys that are many and mostly rare,
    such as words."""
    prepare(df.sparkSession)
    return by_bucket(df.select(key, *order), key, buckets).transformWithStateInPandas(
        P.RunningCount(key, order), f"{_ddl(df, key, *order)}, cnt bigint", "Append", "None")


def rolling_max_by_stream(df: DataFrame, key: str, order: str, value: str, carry: list[str],
                          keep: list[str] | None = None) -> DataFrame:
    """Per-record rolling ``maxBy`` (A-3) and reduce-max (A-4): for each row the
    record holding the largest value so far (``carry`` fields), next to the
    row's own ``keep`` fields."""
    prepare(df.sparkSession)
    keep = list(keep or [])
    extra = "".join(f", `max_{c}` string" for c in carry)
    out = by_bucket(df, key).transformWithStateInPandas(
        P.RollingMaxBy(key, order, value, carry, keep),
        f"{_ddl(df, key, order, *keep)}, `max_{value}` double, `max_{order}` bigint{extra}", "Append", "None")
    for c in carry:  # state keeps carried fields as text; restore their types
        out = out.withColumn(f"max_{c}", F.col(f"max_{c}").cast(df.schema[c].dataType))
    return out


def changelog_stream(df: DataFrame, key: str, order: str, value: str, sum_digits: int | None = None) -> DataFrame:
    """Retract stream of ``count, avg`` per key (A-6, ``toRetractStream``)."""
    prepare(df.sparkSession)
    return by_bucket(df, key).transformWithStateInPandas(
        P.Changelog(key, order, value, sum_digits),
        f"{_ddl(df, key, order)}, change_seq int, is_insert boolean, cnt bigint, avg_value double",
        "Append", "None")


def jump_alert_stream(df: DataFrame, key: str, order: str, value: str, threshold: float) -> DataFrame:
    prepare(df.sparkSession)
    return by_bucket(df, key).transformWithStateInPandas(
        P.JumpAlert(key, order, value, threshold),
        f"{_ddl(df, key, order)}, `prev_{value}` double, `{value}` double", "Append", "None")


def count_window_avg_stream(df: DataFrame, key: str, order: str, value: str, size: int = 5,
                            slide: int = 2) -> DataFrame:
    prepare(df.sparkSession)
    return by_bucket(df, key).transformWithStateInPandas(
        P.CountWindowAvg(key, order, value, size, slide),
        f"{_ddl(df, key, order)}, n bigint, avg_value double", "Append", "None")


def over_rows_stream(df: DataFrame, key: str, order: list[str], value: str, preceding: int = 2) -> DataFrame:
    prepare(df.sparkSession)
    return by_bucket(df, key).transformWithStateInPandas(
        P.OverRows(key, order, value, preceding),
        f"{_ddl(df, key, *order)}, cnt bigint, avg_value double", "Append", "None")


def avg_fold_stream(df: DataFrame, key: str, value: str, sum_digits: int | None = None) -> DataFrame:
    """The average as a user aggregate on a stream (Spark rejects pandas UDAFs in streaming aggregation); emits the
    updated result per key each batch (update mode)."""
    return fold_stream(df, key, avg_fold(value, sum_digits=sum_digits), [value])


def rise_alert_stream(df: DataFrame, key: str, order: str, time: str, value: str,
                      interval_s: int, delay: str) -> DataFrame:
    """Event-time rise alert (F-5); the watermark (``delay``) drives the timers. Rows behind the watermark come out
    with ``late`` set instead of being dropped."""
    prepare(df.sparkSession)
    src = clocked(df.select(key, order, time, value), time, delay).drop(time)
    return by_bucket(src, key).transformWithStateInPandas(
        P.RiseAlert(key, order, US, value, interval_s),
        f"{_ddl(df, key, order)}, start_ts timestamp_ntz, alert_ts timestamp_ntz, late boolean", "Append", "EventTime")


def idle_timer_stream(df: DataFrame, key: str, delay_ms: int = 1000) -> DataFrame:
    """Processing-time timers (F-4): run with a processing-time trigger."""
    prepare(df.sparkSession)
    return df.groupBy(key).transformWithStateInPandas(
        P.IdleTimer(key, delay_ms), f"{_ddl(df, key)}, fired_at timestamp_ntz", "Append", "ProcessingTime")


def event_window_min_stream(df: DataFrame, key: str, time: str, size: str, value: str, order: str,
                            delay_s: int, lateness_s: int = 0) -> DataFrame:
    """Event-time tumbling window ``minBy(value)`` with allowed lateness (W-4).

    Spark has no allowed lateness: a window's state is dropped once the
    watermark passes its end. Keeping the state for ``lateness`` longer is a
    watermark of ``delay + lateness``; in update mode each changed window is
    re-emitted (like the reference's re-firing), and the last emission is final.
    Rows behind that watermark are dropped by Spark; where they are wanted,
    :func:`streaming.event_windows.fold_windows_stream` gives them as a second output.
    """
    src = df.withColumn("_sf_et", event_time(df, time)) \
        .withWatermark("_sf_et", f"{delay_s + lateness_s} seconds")
    rec = F.struct(F.col(value).alias("v"), F.col(order).alias("o"), F.col(time).alias("t"))
    g = src.groupBy(F.col(key), F.window("_sf_et", size).alias("_sf_w")).agg(
        F.count(F.lit(1)).alias("cnt"), F.min(rec).alias("_sf_min"))
    return g.select(key, as_ntz(F.col("_sf_w.start")).alias("window_start"),
                    as_ntz(F.col("_sf_w.end")).alias("window_end"), "cnt",
                    F.col("_sf_min.v").alias(f"min_{value}"), F.col("_sf_min.o").alias(f"min_{order}"),
                    F.col("_sf_min.t").alias(f"min_{time}"))


def late_split_batch_writer(spark: SparkSession, state_path: str, main_path: str, side_path: str,
                            time: str, size: str, delay_s: int, lateness_s: int):
    """``foreachBatch`` function for the late-data split (W-5) on a stream.

    The high-water mark of event time is kept in a small Parquet table next
    to the checkpoint, one row per batch id. Rows of batch ``b`` are split
    against ``max(event time of batches < b) - delay`` (Spark's micro-batch
    watermark, without Spark's silent drop): late rows go to the side output,
    the rest to the main output. Every write is keyed by batch id and
    overwritten on replay, so a restarted batch is harmless.
    """
    def fn(batch: DataFrame, batch_id: int) -> None:
        earlier = [v for v in _versions(spark, state_path) if v < batch_id]
        prev = spark.read.parquet(f"{state_path}/_v={earlier[-1]}").first()["hwm"] if earlier else None
        b = batch.withColumn("_sf_et", event_time(batch, time)).persist()
        try:
            wm = (F.lit(prev).cast("timestamp") - F.make_dt_interval(secs=F.lit(delay_s))) if prev is not None \
                else F.lit(None).cast("timestamp")
            fire_at = tumble_end(F.col("_sf_et"), size) - F.expr("INTERVAL 1 MILLISECOND")
            closed_at = fire_at + F.make_dt_interval(secs=F.lit(lateness_s))
            status = (F.when(wm.isNull(), "on_time").when(closed_at <= wm, "late")
                      .when(fire_at <= wm, "refire").otherwise("on_time"))
            out = b.withColumn("status", status).drop("_sf_et")
            out.where(F.col("status") != "late").write.mode("overwrite").parquet(f"{main_path}/_batch={batch_id}")
            out.where(F.col("status") == "late").write.mode("overwrite").parquet(f"{side_path}/_batch={batch_id}")
            hwm = b.agg(F.max("_sf_et").alias("m")).first()["m"]
            hwm = max(x for x in (prev, hwm) if x is not None) if (prev or hwm) else None
            spark.createDataFrame([(batch_id, hwm)], "batch_id bigint, hwm timestamp") \
                .write.mode("overwrite").parquet(f"{state_path}/_v={batch_id}")
            _retain(spark, state_path, batch_id)
        finally:
            b.unpersist()
    return fn


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Batch ids of the ``_v=<id>`` sub-folders of a state table (file-system
    listing through Hadoop, so it works on any cluster file system)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.startswith("_v="):
            out.append(int(name[3:]))
    return sorted(out)


def _retain(spark: SparkSession, path: str, batch_id: int) -> None:
    """Drop state versions older than ``batch_id - 1`` once ``batch_id`` is
    written: a replay of ``batch_id`` reads ``batch_id - 1``, nothing older,
    so storage and listing stay bounded for a long-running stream."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for v in _versions(spark, path):
        if v < batch_id - 1:
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{path}/_v={v}"), True)


def over_rows_event_time_stream(df: DataFrame, key: str, time: str, seq: str, value: str,
                                preceding: int, delay: str) -> DataFrame:
    """Exact event-time OVER window on a stream (W-8): rows are released in
    ``(time, seq)`` order once the watermark (``delay``) passes them; rows
    behind the released point come out with ``late = true``, none is dropped."""
    prepare(df.sparkSession)
    src = clocked(df.select(key, time, seq, value), time, delay).drop(time)
    return by_bucket(src, key).transformWithStateInPandas(
        P.OverRowsEventTime(key, time, US, seq, value, preceding),
        f"{_ddl(df, key)}, `{time}` timestamp_ntz, {_ddl(df, seq)}, cnt bigint, avg_value double, late boolean",
        "Append", "EventTime")

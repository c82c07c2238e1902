"""Streaming forms of the registered queries.

Each replays its table as a file stream of several micro-batches, runs to
the end of the input with ``availableNow`` through an idempotent
``foreachBatch`` into Parquet under the shared checkpoint root, and returns
the final result as a DataFrame. Its oracle is the batch operator's SQL: the
stream must give the same final answer.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorflow import catalog as C
from sensorflow.catalog import register
from sensorflow.functions.fold import count_fold, min_by_fold
from sensorflow.operators import rolling
from sensorflow.session import prepare, scratch_path, tidy
from sensorflow.sinks import tables
from sensorflow.sinks.writers import file_count, path_exists, read_batches, run_to_end, run_until, stream_to_table
from sensorflow.sources.readers import read_table_stream
from sensorflow.streaming import cells, event_windows as W
from sensorflow.streaming import ops as S

#: Micro-batches that a registered stream takes its table in, so that state, timers and watermarks carry over.
SLICES = 3
LATE_SLICES = 4

# End-of-input marker: a bounded source ends with an "infinite" watermark in the
# reference's runtime, so every event-time timer fires. A file stream has no end,
# so one row at the end of time, after the last slice, advances the watermark
# past all data; its time, which no real row has, keeps it out of the result.
_END_TS = "2262-01-01 00:00:00"  # pandas holds times up to April 2262


def _real(col: str):
    """Whether a row is not the marker's; a null time is a real row's."""
    return F.coalesce(F.col(col) < F.lit(_END_TS).cast("timestamp_ntz"), F.lit(True))


@dataclass(frozen=True)
class Slices:
    """A table as consecutive parts of ``order``; each is written by as many tasks as it takes."""

    rows: DataFrame
    no: Column
    count: int = SLICES

    def part(self, k: int) -> DataFrame:
        return self.rows.where(self.no == k)


def _slices(spark: SparkSession, sf_dir: str, name: str, cols: list[str], order: str = "event_id", count: int = SLICES) -> Slices:
    """The table in slices of ascending ``order`` (nulls in the first; every row is in exactly one slice)."""
    rows = C.table(spark, sf_dir, name).select(*dict.fromkeys([*cols, order]))
    cuts = rows.approxQuantile(order, [i / count for i in range(1, count)], 0.01)
    return Slices(rows, sum((F.when(F.col(order) >= F.lit(c), 1).otherwise(0) for c in cuts), F.lit(0)), count)


#: Files of a slice, written and read by as many tasks.
FILES = 8


def _replay(slices: Slices, name: str, start: Callable[[DataFrame, str], object], end: str | None = None) -> str:
    """Feed the slices to a stream, one micro-batch each, and wait for the end. ``start(stream, base)`` starts the query.

    A slice is ``FILES`` files (empty ones where it has fewer rows), written after the slice before, and a file stream
    takes files by age, ``FILES`` at a time. ``end`` names the time column of a last row, in the last slice, that ends
    the stream (see above). Returns the run's folder; the slices' files are gone by then.
    """
    spark = prepare(slices.rows.sparkSession)
    base, schema = scratch_path(spark, name), slices.rows.schema
    source = f"{base}/source"
    for k in range(slices.count):
        part = slices.part(k)
        if end and k == slices.count - 1:
            part = part.unionByName(spark.range(1).select(
                *[(F.lit(_END_TS) if f.name == end else F.lit(-1)).cast(f.dataType).alias(f.name) for f in schema.fields]))
        part.repartition(FILES).write.mode("append").parquet(source)
        for _ in range(FILES * (k + 1) - file_count(spark, source)):
            spark.createDataFrame([], schema).coalesce(1).write.mode("append").parquet(source)
    run_to_end(start(read_table_stream(spark, source, schema, max_files_per_trigger=FILES), base))
    tables._remove(spark, source)  # a copy of the table
    return base


#: Of a stream's result: keys come in runs and counts go up by one, which differences pack well.
COMPACT = {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0"}


def _run(slices: Slices, name: str, build: Callable[[DataFrame], DataFrame], mode: str = "append", keys: list[str] | None = None,
         end: str | None = None) -> DataFrame:
    """The result of a replayed stream: every row it gave, or with ``keys`` the last one of each key."""
    shape = {}

    def start(stream, base):
        out = build(stream)
        shape["schema"] = out.schema
        with tidy(slices.rows.sparkSession):  # a query keeps the settings it starts with
            return (out.writeStream.foreachBatch(lambda batch, k: batch.write.options(**COMPACT).mode("overwrite").parquet(f"{base}/out/_batch={k}"))
                    .outputMode(mode).option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())
    base = _replay(slices, name, start, end)
    return read_batches(slices.rows.sparkSession, f"{base}/out", shape["schema"].names, mode, keys, shape["schema"])


@register("word_count_stream", C.ORACLE["word_count"])
def q_word_count_stream(spark, sf_dir):
    docs = _slices(spark, sf_dir, "documents", ["text"], "doc_id")
    return _run(docs, "word-count", lambda d: S.word_count_stream(d, "text", " "), "update", ["word"])


@register("keyed_running_count_stream", C.ORACLE["keyed_running_count"])
def q_keyed_running_count_stream(spark, sf_dir):
    e = _slices(spark, sf_dir, "events", ["user_id", "event_id"])
    return _run(e, "running-count", lambda d: S.running_count_stream(d, "user_id", "event_id"))


@register("jump_alert_stream", C.ORACLE["jump_alert"])
def q_jump_alert_stream(spark, sf_dir):
    e = _slices(spark, sf_dir, "events", ["user_id", "event_id", "value"])
    return _run(e, "jump-alert", lambda d: S.jump_alert_stream(d, "user_id", "event_id", "value", C.JUMP_THRESHOLD))


@register("count_window_avg_stream", C.ORACLE["count_window_avg"])
def q_count_window_avg_stream(spark, sf_dir):
    e = _slices(spark, sf_dir, "events", ["user_id", "event_id", "value"])
    out = _run(e, "count-window", lambda d: S.count_window_avg_stream(d, "user_id", "event_id", "value", 5, 2))
    return out.select("user_id", "event_id", "n", C.r6("avg_value").alias("avg_value"))


@register("over_rows_stream", C.ORACLE["over_rows"])
def q_over_rows_stream(spark, sf_dir):
    e = _slices(spark, sf_dir, "events", ["user_id", "ts", "event_id", "value"])
    out = _run(e, "over-rows", lambda d: S.over_rows_stream(d, "user_id", ["ts", "event_id"], "value", 2))
    return out.select("user_id", "ts", "event_id", "cnt", C.r6("avg_value").alias("avg_value"))


@register("udaf_avg_temp_stream", C.ORACLE["udaf_avg_temp"])
def q_udaf_avg_temp_stream(spark, sf_dir):
    e = _slices(spark, sf_dir, "events", ["user_id", "value"])
    out = _run(e, "udaf-avg", lambda d: S.avg_fold_stream(d, "user_id", "value", sum_digits=6), "update", ["user_id"])
    return out.select("user_id", C.r6("avg_value").alias("avg_value"))


@register("event_window_min_stream", C.ORACLE["event_window_min"])
def q_event_window_min_stream(spark, sf_dir):
    e = _slices(spark, sf_dir, "events", ["user_id", "event_id", "ts", "value"])
    return _run(e, "window-min", lambda d: S.event_window_min_stream(d, "user_id", "ts", C.WINDOW, "value", "event_id", C.DELAY_S, C.LATENESS_S),
                "update", ["user_id", "window_start", "window_end"])


@register("resume_stream", C.ORACLE["keyed_running_count"])
def q_resume_stream(spark, sf_dir):
    """Fault tolerance (F-7): the input arrives in two halves; the query is
    stopped after the first and restarted from its checkpoint for the second.
    Counts must continue exactly where they stopped (no loss, no duplicates)."""
    prepare(spark)
    base = scratch_path(spark, "resume")
    src, out, ckpt = f"{base}/source", f"{base}/out", f"{base}/checkpoint"
    e = C.events(spark, sf_dir, "user_id", "event_id")
    mid = e.approxQuantile("event_id", [0.5], 0.001)
    mid = mid[0] if mid else 0
    later = F.coalesce(F.col("event_id") >= mid, F.lit(False))  # null ids come with the first half
    e.where(~later).write.mode("overwrite").parquet(src)
    for half in (0, 1):
        if half == 1:
            e.where(later).write.mode("append").parquet(src)
        stream = read_table_stream(spark, src, e.schema)
        result = stream_to_table(spark, S.running_count_stream(stream, "user_id", "event_id"), out, ckpt)
    return result


@register("word_count_running_stream", C.ORACLE["word_count_running"])
def q_word_count_running_stream(spark, sf_dir):
    from sensorflow.operators.aggregates import words
    docs = _slices(spark, sf_dir, "documents", ["doc_id", "text"], "doc_id")

    def counted(d):
        w = words(d, "text", " ", keep=["doc_id"], pos="pos").withColumn("pos", F.col("pos").cast("bigint"))
        return S.running_count_many_keys_stream(w, "word", ["doc_id", "pos"])
    return _run(docs, "word-running", counted).select("doc_id", "pos", "word", "cnt")


@register("rolling_max_by_stream", C.ORACLE["rolling_max_by"])
def q_rolling_max_by_stream(spark, sf_dir):
    e = _slices(spark, sf_dir, "events", ["event_id", "user_id", "ts", "value"])
    out = _run(e, "rolling-max-by", lambda d: S.rolling_max_by_stream(d, "user_id", "event_id", "value", ["ts"]))
    return out.select("event_id", "user_id", "max_value", "max_event_id", "max_ts")


@register("rolling_reduce_stream", C.ORACLE["rolling_reduce"])
def q_rolling_reduce_stream(spark, sf_dir):
    e = _slices(spark, sf_dir, "events", ["event_id", "user_id", "ts", "value"])
    out = _run(e, "rolling-reduce", lambda d: S.rolling_max_by_stream(d, "user_id", "event_id", "value", [], keep=["ts"]))
    return out.select("event_id", "user_id", "ts", "max_value")


@register("changelog_count_avg_stream", C.ORACLE["changelog_count_avg"])
def q_changelog_count_avg_stream(spark, sf_dir):
    e = _slices(spark, sf_dir, "events", ["user_id", "event_id", "value"])
    out = _run(e, "changelog", lambda d: S.changelog_stream(d, "user_id", "event_id", "value", sum_digits=6))
    return out.select("user_id", "event_id", "change_seq", "is_insert", "cnt", C.r6("avg_value").alias("avg_value"))


@register("tumble_apply_stream", C.ORACLE["tumble_apply"])
def q_tumble_apply_stream(spark, sf_dir):
    """A user fold per key and 6-hour window on a stream (W-2 / UDF-4): windows
    are emitted once the watermark passes their end; the end marker closes the rest."""
    e = _slices(spark, sf_dir, "events", ["user_id", "event_id", "ts"])
    out = _run(e, "window-fold", lambda d: W.fold_windows_stream(d, "user_id", "ts", C.WINDOW, count_fold("cnt"), [], "event_id", f"{C.DELAY_S} seconds"), end="ts")
    return out.where((F.col("output") == "window") & _real("window_end")).select("user_id", "window_end", "cnt")


@register("rise_alert_stream", C.ORACLE["rise_alert"])
def q_rise_alert_stream(spark, sf_dir):
    e = _slices(spark, sf_dir, "events", ["user_id", "event_id", "ts", "value"])
    out = _run(e, "rise-alert", lambda d: S.rise_alert_stream(d, "user_id", "event_id", "ts", "value", C.RISE_INTERVAL_S, f"{C.DELAY_S} seconds"), end="ts")
    return out.where(~F.col("late") & _real("start_ts")).select("user_id", "event_id", "start_ts", "alert_ts")


@register("late_split_stream", f"""
WITH a AS (SELECT event_id, user_id, ts, event_id + (event_id * {C.ARRIVAL_MULT}) % {C.ARRIVAL_MOD} AS arrival FROM events),
s AS (SELECT a.*, CAST(floor(arrival * {LATE_SLICES} / (SELECT max(arrival) + 1 FROM a)) AS BIGINT) AS slice FROM a),
h AS (SELECT slice, max(max(ts)) OVER (ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS hwm
      FROM s GROUP BY slice),
w AS (SELECT s.*, h.hwm - INTERVAL {C.DELAY_S} SECOND AS wm,
             time_bucket({C.WINDOW_SQL}, ts) + {C.WINDOW_SQL} AS window_end FROM s JOIN h USING (slice))
SELECT event_id, user_id, ts, arrival,
       CASE WHEN wm IS NULL THEN 'on_time'
            WHEN window_end - INTERVAL 1 MILLISECOND + INTERVAL {C.LATENESS_S} SECOND <= wm THEN 'late'
            WHEN window_end - INTERVAL 1 MILLISECOND <= wm THEN 'refire'
            ELSE 'on_time' END AS status FROM w""")
def q_late_split_stream(spark, sf_dir):
    """Late-data split on a stream (W-5): the events arrive in {LATE_SLICES}
    slices of the synthetic arrival order, one micro-batch each; rows of a
    batch are split against the high-water mark of the earlier batches."""
    prepare(spark)
    base = scratch_path(spark, "late-split")
    src, main, side, state = (f"{base}/{x}" for x in ("source", "main", "side", "hwm"))
    e = C._arrival(C.events(spark, sf_dir, "event_id", "user_id", "ts"))
    top = e.agg(F.max("arrival")).first()[0]
    sliced = e.withColumn("_slice", F.coalesce(F.floor(F.col("arrival") * LATE_SLICES / (F.lit(top) + 1)), F.lit(0)))
    fn = S.late_split_batch_writer(spark, state, main, side, "ts", C.WINDOW, C.DELAY_S, C.LATENESS_S)
    for b in range(LATE_SLICES):
        sliced.where(F.col("_slice") == b).drop("_slice").write.mode("append").parquet(src)
        q = (read_table_stream(spark, src, e.schema).writeStream.foreachBatch(fn)
             .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())
        run_to_end(q)
    cols = ["event_id", "user_id", "ts", "arrival", "status"]
    return spark.read.parquet(main).select(*cols).unionByName(spark.read.parquet(side).select(*cols))


@register("over_rows_event_time_stream", C.ORACLE["over_rows"])
def q_over_rows_event_time_stream(spark, sf_dir):
    """Exact event-time OVER window (W-8): rows released in (ts, event_id)
    order as the watermark passes them; the end marker releases the rest."""
    e = _slices(spark, sf_dir, "events", ["user_id", "ts", "event_id", "value"])
    out = _run(e, "over-rows-et", lambda d: S.over_rows_event_time_stream(d, "user_id", "ts", "event_id", "value", 2, f"{C.DELAY_S} seconds"), end="ts")
    return out.where(_real("ts")).select("user_id", "ts", "event_id", "cnt", C.r6("avg_value").alias("avg_value"))


# ------------------------------------------------- windows with late rows, over arrival order

def _arrivals(spark, sf_dir, cols) -> Slices:
    """The events in slices of the synthetic arrival order, which disturbs their time order."""
    e = C._arrival(C.events(spark, sf_dir, *cols))
    top = e.agg(F.max("arrival")).first()[0] or 0
    return Slices(e, F.coalesce(F.floor(F.col("arrival") * LATE_SLICES / (F.lit(top) + 1)), F.lit(0)), LATE_SLICES)


#: Rows with their slice, the watermark of that slice's micro-batch (whole milliseconds) and their window.
_ARRIVED = f"""
a AS (SELECT *, event_id + (event_id * {C.ARRIVAL_MULT}) % {C.ARRIVAL_MOD} AS arrival FROM events),
s AS (SELECT a.*, CAST(floor(arrival * {LATE_SLICES} / (SELECT max(arrival) + 1 FROM a)) AS BIGINT) AS slice FROM a),
h AS (SELECT slice, date_trunc('millisecond', max(max(ts)) OVER (ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
             - INTERVAL {C.DELAY_S} SECOND AS wm FROM s GROUP BY slice),
w AS (SELECT s.*, wm, time_bucket({C.WINDOW_SQL}, ts) AS window_start, time_bucket({C.WINDOW_SQL}, ts) + {C.WINDOW_SQL} AS window_end FROM s JOIN h USING (slice)),
t AS (SELECT *, CASE WHEN wm IS NULL OR window_end - INTERVAL 1 MILLISECOND > wm THEN 'on_time'
                     WHEN window_end - INTERVAL 1 MILLISECOND + INTERVAL {C.REFIRE_S} SECOND > wm THEN 'refire' ELSE 'late' END AS status FROM w)"""


@register("event_window_late_stream", f"""
WITH {_ARRIVED},
r AS (SELECT *, count(*) OVER v AS cnt, min({{'v': value, 'o': event_id, 't': ts}}) OVER v AS m,
             status = 'refire' OR row_number() OVER (PARTITION BY user_id, window_start, status ORDER BY slice DESC, event_id DESC) = 1 AS told
      FROM t WHERE status <> 'late' WINDOW v AS (PARTITION BY user_id, window_start ORDER BY status = 'refire', slice, event_id))
SELECT 'window' AS output, user_id, window_start, window_end,
       CAST(row_number() OVER (PARTITION BY user_id, window_start ORDER BY cnt) AS INTEGER) AS firing,
       cnt, m.v AS min_value, m.o AS min_event_id, m.t AS min_time, NULL::BIGINT AS late_event_id, NULL::DOUBLE AS late_value
FROM r WHERE told
UNION ALL SELECT 'late', user_id, window_start, window_end, NULL, NULL, NULL, NULL, NULL, event_id, value FROM t WHERE status = 'late'""")
def q_event_window_late_stream(spark, sf_dir):
    """Event-time window ``minBy`` with allowed lateness, re-firing and late output in one keyed operator (W-4, W-5): the
    events arrive out of order; every firing and every late row is in the result."""
    e = _arrivals(spark, sf_dir, ["event_id", "user_id", "ts", "value"])
    fold = min_by_fold("value", "event_id", W.US)
    out = _run(e, "window-late", lambda d: W.fold_windows_stream(d, "user_id", "ts", C.WINDOW, fold, ["value"], "event_id",
                                                                 f"{C.DELAY_S} seconds", f"{C.REFIRE_S} seconds"), end="ts")
    return out.where((F.col("output") != "window") | _real("min_time"))


@register("tumble_apply_rows_stream", C.ORACLE["tumble_apply_rows"])
def q_tumble_apply_rows_stream(spark, sf_dir):
    """A user function over the buffered rows of each window on a stream (W-2); the batch form's function and result."""
    e = _slices(spark, sf_dir, "events", ["user_id", "event_id", "ts", "value"])
    kind = e.rows.schema["user_id"].dataType.simpleString()
    schema = f"user_id {kind}, window_end timestamp_ntz, cnt bigint, first_value double, last_value double"
    out = _run(e, "window-rows", lambda d: W.apply_windows_stream(d, "user_id", "ts", "30 days", C._spread_of_window, schema, "event_id",
                                                                  f"{C.DELAY_S} seconds"), end="ts")
    return out.where((F.col("output") == "window") & _real("window_end")).drop("output", "late_event_id")


# ------------------------------------------------- state cells

#: A row of this type ends a user's episode.
EPISODE_END = "purchase"
RECENT = 3


def _episodes(key, rows: pd.DataFrame, cell: dict) -> pd.DataFrame:
    """Each row's number in its key, the last event of its type in the episode, the episode's largest value so far and
    the mean of the last values. A row that ends an episode still belongs to it."""
    before = cell["count"].get()[0] if cell["count"].exists() else 0
    types = {kind: event for (kind,), (event,) in cell["by_type"].iterator()}
    peak = cell["peak"].get()
    peak = None if peak is None else peak[0]
    recent = [t[0] for t in cell["recent"].get()] if cell["recent"].exists() else []
    previous, peaks, sums, over = [], [], [], False
    values = [None if pd.isna(v) else v for v in rows["value"].tolist()]
    for kind, event, v in zip(rows["event_type"].tolist(), rows["event_id"].tolist(), values):
        kind = None if pd.isna(kind) else kind
        previous.append(types.get(kind))
        types[kind] = None if pd.isna(event) else int(event)
        if v is not None:
            peak = v if peak is None else max(peak, v)
        peaks.append(peak)
        recent = [*recent[-(RECENT - 1):], v]
        there = [x for x in recent if x is not None]
        sums.append(sum(there) if there else None)
        if kind == EPISODE_END:  # the episode is over
            types, peak, over = {}, None, True
    cell["count"].update((before + len(rows),))
    cell["recent"].put([(v,) for v in recent[-(RECENT - 1):]])
    if over:  # its types go one by one, its peak at once
        for (kind,), _ in list(cell["by_type"].iterator()):
            cell["by_type"].removeKey((kind,))
        cell["peak"].clear()
    for kind, event in types.items():
        if kind is not None and event is not None:
            cell["by_type"].updateValue((kind,), (event,))
    if peak is not None:
        cell["peak"].add((float(peak),))
    return pd.DataFrame({"user_id": rows["user_id"], "event_id": rows["event_id"], "cnt": range(before + 1, before + len(rows) + 1),
                         "same_type_before": pd.array(previous, dtype="Int64"), "peak": pd.array(peaks, dtype="Float64"),
                         "recent_sum": pd.array(sums, dtype="Float64")})


@register("keyed_state_cells_stream", f"""
WITH e AS (SELECT *, coalesce(sum(CASE WHEN event_type = '{EPISODE_END}' THEN 1 ELSE 0 END)
                 OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS episode FROM events)
SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS cnt,
       lag(event_id) OVER (PARTITION BY user_id, episode, event_type ORDER BY event_id) AS same_type_before,
       max(value) OVER (PARTITION BY user_id, episode ORDER BY event_id) AS peak,
       round(sum(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS {RECENT - 1} PRECEDING), 6) AS recent_sum
FROM e""")
def q_keyed_state_cells_stream(spark, sf_dir):
    """A rich map with all kinds of keyed state (F-1): a value, a list, a map that is put, read and removed from, and a
    reducing cell that is cleared."""
    e = _slices(spark, sf_dir, "events", ["user_id", "event_id", "event_type", "value"])
    kind = e.rows.schema["user_id"].dataType.simpleString()
    state = {"count": cells.Value("n bigint"), "recent": cells.Items("v double"), "by_type": cells.Table("type string", "event_id bigint"),
             "peak": cells.Reducing("v double", lambda held, new: max(held, new))}
    out = _run(e, "state-cells", lambda d: cells.rich_map_stream(
        d, "user_id", ["event_id"], state, _episodes, f"user_id {kind}, event_id bigint, cnt bigint, same_type_before bigint, peak double, recent_sum double"))
    return out.withColumn("recent_sum", C.r6("recent_sum"))


@register("rolling_reduce_user_stream", C.ORACLE["rolling_reduce_user"])
def q_rolling_reduce_user_stream(spark, sf_dir):
    e = _slices(spark, sf_dir, "events", ["event_id", "user_id", "value"])
    start, merge = rolling.best_stretch("best", C.cents_over_mean())
    return _run(e, "reduce-user", lambda d: cells.rolling_reduce_by_stream(d, "user_id", "event_id", start, merge)).select("event_id", "user_id", "best")


# ------------------------------------------------- tables that streams keep

@register("latest_per_key_stream", C.ORACLE["latest_per_key"])
def q_latest_per_key_stream(spark, sf_dir):
    """Keyed upserts of a stream into a bucketed table (SNK-3): a batch rewrites only the buckets it touches."""
    e = _slices(spark, sf_dir, "events", ["user_id", "event_id", "value"])
    made = {}

    def start(stream, base):
        made["table"] = tables.BucketedTable(spark, f"{base}/table", stream.schema, ["user_id"], buckets=16)
        return (stream.writeStream.foreachBatch(tables.upsert_writer(made["table"], "event_id"))
                .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())
    _replay(e, "upsert", start)
    return made["table"].read()


@register("changelog_applied_stream", C.ORACLE["group_count_avg"])
def q_changelog_applied_stream(spark, sf_dir):
    """A retract stream applied to a table by its reader (SNK-7): counts and averages per user come back out of the
    stream's inserts and retractions."""
    e = _slices(spark, sf_dir, "events", ["user_id", "event_id", "value"])
    made = {}

    def start(stream, base):
        changes = S.changelog_stream(stream, "user_id", "event_id", "value", sum_digits=6)
        schema = changes.select("user_id", "cnt", "avg_value").withColumn("n", F.lit(1).cast("bigint")).schema
        made["table"] = tables.BucketedTable(spark, f"{base}/table", schema, ["user_id"], buckets=16)
        return (changes.writeStream.foreachBatch(tables.changelog_writer(made["table"])).outputMode("append")
                .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())
    _replay(e, "changelog-table", start)
    return made["table"].read().select("user_id", "cnt", C.r6("avg_value").alias("avg_value"))


# ------------------------------------------------- timers and operator state

IDLE_MS, IDLE_LIMIT_S = 500, 300


@register("idle_timer_stream", "SELECT DISTINCT user_id FROM events")
def q_idle_timer_stream(spark, sf_dir):
    """Processing-time timers (F-4): every key's timer fires some time after its rows. The stream runs on a
    processing-time trigger until each key has fired; the result is the keys, as the times are the clock's."""
    e = _slices(spark, sf_dir, "events", ["user_id"])
    keys = e.rows.select("user_id").distinct().count()

    def start(stream, base):
        q = (S.idle_timer_stream(stream, "user_id", IDLE_MS).writeStream
             .foreachBatch(lambda batch, k: batch.write.mode("overwrite").parquet(f"{base}/out/_batch={k}"))
             .option("checkpointLocation", f"{base}/checkpoint").trigger(processingTime="1 second").start())

        def fired() -> bool:
            done = [n for n in range((q.lastProgress or {"batchId": -1})["batchId"] + 1) if path_exists(spark, f"{base}/out/_batch={n}/_SUCCESS")]
            return bool(done) and spark.read.schema(e.rows.schema).parquet(*[f"{base}/out/_batch={n}" for n in done]) \
                .select("user_id").distinct().count() == keys
        run_until(q, (lambda: True) if not keys else fired, IDLE_LIMIT_S)
        return q
    base = _replay(e, "idle-timer", start)
    rows = spark.read.schema(e.rows.schema).parquet(f"{base}/out") if keys else e.rows
    return rows.select("user_id").distinct()


BEFORE, AFTER = 4, 3
HALF = "2024-01-16 00:00:00"


@register("instance_count_stream", f"""
SELECT 'before' AS run, {BEFORE} AS instances, count(*) AS total FROM events WHERE ts < TIMESTAMP '{HALF}'
UNION ALL SELECT 'after', {AFTER}, count(*) FROM events""")
def q_instance_count_stream(spark, sf_dir):
    """Operator state that survives a change of parallelism (F-2): the rows before a time are counted by four instances,
    the others by three that start from the four's parts."""
    e = C.events(spark, sf_dir, "event_id", "ts")
    base = scratch_path(prepare(spark), "operator-count")
    early = F.coalesce(F.col("ts") < F.lit(HALF).cast("timestamp_ntz"), F.lit(False))
    out, parts = None, None
    for run, pick, n in (("before", early, BEFORE), ("after", ~early, AFTER)):
        e.where(pick).write.parquet(f"{base}/{run}/source")
        stream = read_table_stream(spark, f"{base}/{run}/source", e.schema)
        got = stream_to_table(spark, cells.instance_count_stream(stream, ["event_id"], n, parts), f"{base}/{run}/out", f"{base}/{run}/checkpoint",
                              "update", ["instance"])
        told = got.agg(F.sum("cnt").alias("total")).select(F.lit(run).alias("run"), F.lit(n).alias("instances"), F.coalesce("total", F.lit(0)).alias("total"))
        out = told if out is None else out.unionByName(told)
        parts = cells.saved_parts(spark, f"{base}/{run}/checkpoint")
    return out

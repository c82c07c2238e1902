"""Registered queries over the driver tables, each with its DuckDB oracle SQL.

Column mapping (SURVEY §7.4): sensor ``id → user_id``, arrival ``seq →
event_id``, event time ``ts``, ``temperature → value``; text operators run on
the whole ``documents.text``. Window sizes scale the reference's seconds to
hours because ``events`` has one row per few minutes (15 s → 6 h,
2 s delay → 30 min, 1 min lateness → 6 h).

Every query reads the whole table; no row caps, samples or id subsets.
Averages are rounded to 6 decimals on both sides, from sums rounded to 6 decimals
(summation order differs between plans and engines; see ``aggregates.mean``).
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorflow.functions.fold import avg_fold, count_fold, fold_by
from sensorflow.functions.sqlfold import register_fold
from sensorflow.functions.text import java_hash
from sensorflow.operators import aggregates as agg
from sensorflow.operators import alerts, late, lateral, rolling, transforms, windows
from sensorflow.plans.parallel import spread
from sensorflow.plans.scan import quantile_bounds
from sensorflow.schema import READING_SCHEMA
from sensorflow.session import prepare, scratch_path
from sensorflow.sinks import tables
from sensorflow.sources import readers
from sensorflow.sqlfuncs import register_sql_functions

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Parameters of the registered queries (scaled to the events table, see module doc).
WINDOW = "6 hours"
WINDOW_SQL = "INTERVAL 6 HOUR"
DELAY_S = 30 * 60
LATENESS_S = 6 * 3600
RISE_INTERVAL_S = 6 * 3600
#: Allowed lateness of the out-of-order replay, short enough that some rows are late.
REFIRE_S = 12 * 3600
JUMP_THRESHOLD = 10.0
HASH_FACTOR = 23
FILTER_USER = 7
PREFIX = "c"
# Fixed value: synthetic arrival order for late data (FIXTURES §4).
ARRIVAL_MULT, ARRIVAL_MOD = 7919, 400


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events(spark, sf_dir, *cols) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(*cols) if cols else e


def r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def sensor_lines(e: DataFrame) -> DataFrame:
    """The reference's wire format: ``id,epoch_seconds,temperature`` lines."""
    return e.select("event_id", F.concat_ws(
        ",", F.concat(F.lit("sensor_"), F.col("user_id").cast("string")),
        F.unix_seconds(F.col("ts").cast("timestamp")).cast("string"),
        F.col("value").cast("string")).alias("value"))


# ---------------------------------------------------------------- rows

@register("parse_readings", """
SELECT event_id, 'sensor_' || CAST(user_id AS VARCHAR) AS id,
       CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS "timestamp", value AS temperature
FROM events""")
def q_parse_readings(spark, sf_dir):
    lines = sensor_lines(events(spark, sf_dir, "event_id", "user_id", "ts", "value"))
    return readers.parse_readings(lines, keep=["event_id"])


@register("map_length", """
SELECT doc_id, CAST(length(text) + length(regexp_replace(text, '[^\\x{10000}-\\x{10FFFF}]', '', 'g')) AS BIGINT) AS len
FROM documents""")
def q_map_length(spark, sf_dir):
    d = spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return transforms.line_length(d, "text", "len").select("doc_id", F.col("len").cast("bigint"))


@register("flatmap_fields", """
SELECT event_id, CAST(pos - 1 AS BIGINT) AS pos, field FROM (
  SELECT event_id, unnest(parts) AS field, unnest(generate_series(1, len(parts))) AS pos
  FROM (SELECT event_id, string_split(event_type || ',' || CAST(user_id AS VARCHAR) || ',' ||
                                      CAST(event_id AS VARCHAR), ',') AS parts FROM events))""")
def q_flatmap_fields(spark, sf_dir):
    e = events(spark, sf_dir, "event_id", "user_id", "event_type")
    lines = e.select("event_id", F.concat_ws(",", "event_type", F.col("user_id").cast("string"),
                                             F.col("event_id").cast("string")).alias("value"))
    out = transforms.split_fields(lines, "value", ",", keep=["event_id"])
    return out.select("event_id", F.col("pos").cast("bigint"), "field")


@register("filter_prefix", f"""
SELECT event_id, user_id, event_type FROM events WHERE starts_with(event_type, '{PREFIX}')""")
def q_filter_prefix(spark, sf_dir):
    e = events(spark, sf_dir, "event_id", "user_id", "event_type")
    return transforms.filter_prefix(e, "event_type", PREFIX)


@register("table_filter", f"SELECT user_id, value FROM events WHERE user_id = {FILTER_USER}")
def q_table_filter(spark, sf_dir):
    return events(spark, sf_dir).select("user_id", "value").where(f"user_id = {FILTER_USER}")


@register("sql_filter", f"SELECT user_id, value FROM events WHERE user_id = {FILTER_USER}")
def q_sql_filter(spark, sf_dir):
    events(spark, sf_dir).createOrReplaceTempView("sensor")
    return spark.sql(f"SELECT user_id, value FROM sensor WHERE user_id = {FILTER_USER}")


@register("split_high_low", """
SELECT event_id, user_id, value, CASE WHEN value > 30 THEN 'high' ELSE 'low' END AS tag FROM events""")
def q_split_high_low(spark, sf_dir):
    e = events(spark, sf_dir, "event_id", "user_id", "value")
    return transforms.select_tags(transforms.tag_high_low(e, "value"), "high", "low")


@register("side_output_low", "SELECT event_id, user_id, value FROM events WHERE NOT (value > 30) OR value IS NULL")
def q_side_output_low(spark, sf_dir):
    e = events(spark, sf_dir, "event_id", "user_id", "value")
    return transforms.side_output(e, "value")[1]


@register("side_output_both", """
SELECT event_id, user_id, value, CASE WHEN value > 30 THEN 'main' ELSE 'side' END AS output FROM events""")
def q_side_output_both(spark, sf_dir):
    """Both outputs of the split, each row in exactly one of them."""
    e = events(spark, sf_dir, "event_id", "user_id", "value")
    main, side = transforms.side_output(e, "value")
    return transforms.union_all(main.withColumn("output", F.lit("main")), side.withColumn("output", F.lit("side")))


@register("connect_status", """
SELECT event_id, user_id, value, 'high temp warning' AS status FROM events WHERE value > 30
UNION ALL
SELECT event_id, user_id, CAST(NULL AS DOUBLE) AS value, 'normal' AS status FROM events
WHERE NOT (value > 30) OR value IS NULL""")
def q_connect_status(spark, sf_dir):
    e = events(spark, sf_dir, "event_id", "user_id", "value")
    return transforms.connect_status(e, "user_id", "value", keep=["event_id"]) \
        .select("event_id", "user_id", "value", "status")


@register("union_all", """
SELECT event_id, user_id, value FROM events WHERE value > 30
UNION ALL SELECT event_id, user_id, value FROM events WHERE NOT (value > 30) OR value IS NULL
UNION ALL SELECT event_id, user_id, value FROM events""")
def q_union_all(spark, sf_dir):
    e = events(spark, sf_dir, "event_id", "user_id", "value")
    high, low = transforms.side_output(e, "value")
    return transforms.union_all(high, low, e)


@register("src_csv_table", """
SELECT 'sensor_' || CAST(user_id AS VARCHAR) AS id,
       CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS "timestamp", value AS temperature FROM events""")
def q_src_csv_table(spark, sf_dir):
    """Write the readings as a headerless CSV folder, read it back as a typed table."""
    path = scratch_path(spark, "csv-table")
    lines = sensor_lines(events(spark, sf_dir, "event_id", "user_id", "ts", "value"))
    lines.select("value").write.mode("overwrite").text(path)
    readers.read_csv_table(spark, path, READING_SCHEMA, view="sensor_csv")
    return spark.sql("SELECT id, timestamp, temperature FROM sensor_csv")


@register("shuffle_rows", "SELECT event_id, user_id, value FROM events")
def q_shuffle_rows(spark, sf_dir):
    return transforms.shuffle_rows(events(spark, sf_dir, "event_id", "user_id", "value"))


@register("key_by_rows", "SELECT event_id, user_id, value FROM events")
def q_key_by_rows(spark, sf_dir):
    return transforms.key_by(events(spark, sf_dir, "event_id", "user_id", "value"), "user_id")


@register("rebalance_rows", "SELECT event_id, user_id, value FROM events")
def q_rebalance_rows(spark, sf_dir):
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return transforms.rebalance(events(spark, sf_dir, "event_id", "user_id", "value"), n)


@register("partition_tag", "SELECT event_id, user_id, true AS tagged FROM events")
def q_partition_tag(spark, sf_dir):
    """Rich map with the subtask index; the index depends on the layout, so the result says that every row has one."""
    out = transforms.tag_partition(events(spark, sf_dir, "event_id", "user_id"))
    return out.select("event_id", "user_id", (F.col("subtask") >= 0).alias("tagged"))


# ---------------------------------------------------------------- aggregates

_WORDS_SQL = """
SELECT doc_id, unnest(parts) AS word, unnest(generate_series(0, len(parts) - 1)) AS pos FROM (
  SELECT doc_id, CASE WHEN text <> '' AND rtrim(text, ' ') = '' THEN []::VARCHAR[]
                      ELSE string_split(rtrim(text, ' '), ' ') END AS parts FROM documents)"""


@register("word_count", f"SELECT word, count(*) AS cnt FROM ({_WORDS_SQL}) GROUP BY word")
def q_word_count(spark, sf_dir):
    d = spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return agg.word_count(d.select("text"), "text", " ")


@register("word_count_running", f"""
SELECT doc_id, pos, word, count(*) OVER (PARTITION BY word ORDER BY doc_id, pos
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cnt FROM ({_WORDS_SQL})""")
def q_word_count_running(spark, sf_dir):
    d = spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    # Segment bounds from the documents (one small column), not from the exploded words.
    bounds = quantile_bounds(d, "doc_id")

    def words(docs, keep):
        return agg.words(docs, "text", " ", keep=["doc_id", *keep], pos="pos").withColumn("pos", F.col("pos").cast("bigint"))
    return rolling.running_count(d, ["word"], ["doc_id", "pos"], segments=bounds, rows=words) \
        .select("doc_id", "pos", "word", "cnt")


@register("group_count_avg", """
SELECT user_id, count(user_id) AS cnt, round(round(sum(value), 6) / count(value), 6) AS avg_value FROM events GROUP BY user_id""")
def q_group_count_avg(spark, sf_dir):
    g = agg.count_avg(events(spark, sf_dir, "user_id", "value"), "user_id", "value", sum_digits=6)
    return g.select("user_id", "cnt", r6("avg_value").alias("avg_value"))


@register("sql_group_count_avg", """
SELECT user_id, count(user_id) AS cnt, round(round(sum(value), 6) / count(value), 6) AS avg_value FROM events GROUP BY user_id""")
def q_sql_group_count_avg(spark, sf_dir):
    events(spark, sf_dir).createOrReplaceTempView("sensor")
    return spark.sql("SELECT user_id, count(user_id) AS cnt, round(round(sum(value), 6) / count(value), 6) AS avg_value "
                     "FROM sensor GROUP BY user_id")


@register("udaf_avg_temp", "SELECT user_id, round(round(sum(value), 6) / count(value), 6) AS avg_value FROM events GROUP BY user_id")
def q_udaf_avg_temp(spark, sf_dir):
    f = fold_by(events(spark, sf_dir, "user_id", "value"), ["user_id"], avg_fold("value", sum_digits=6), ["value"])
    return f.select("user_id", r6("avg_value").alias("avg_value"))


@register("sql_udaf_avg", ORACLE["udaf_avg_temp"])
def q_sql_udaf_avg(spark, sf_dir):
    """A user aggregate called from SQL (UDF-3), folded where the rows are and merged by key."""
    e = events(spark, sf_dir, "user_id", "value")
    register_fold(prepare(spark), "avg_temp", avg_fold("value", sum_digits=6), "user_id", e.schema["user_id"].dataType.simpleString())
    e.createOrReplaceTempView("sf_readings")
    out = spark.sql("SELECT * FROM avg_temp(TABLE(SELECT * FROM avg_temp_partial(TABLE(SELECT user_id, value FROM sf_readings))) PARTITION BY user_id)")
    return out.select("user_id", r6("avg_value").alias("avg_value"))


@register("latest_per_key", """
SELECT user_id, arg_max(value, event_id) AS value, max(event_id) AS event_id FROM events GROUP BY user_id""")
def q_latest_per_key(spark, sf_dir):
    return agg.latest_per_key(events(spark, sf_dir, "user_id", "event_id", "value"),
                              "user_id", "event_id", "value")


# ---------------------------------------------------------------- rolling

@register("rolling_max_by", """
SELECT event_id, user_id, m.v AS max_value, -m.neg AS max_event_id, m.t AS max_ts FROM (
  SELECT event_id, user_id, max({'v': value, 'neg': -event_id, 't': ts}) OVER (
    PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS m
  FROM events)""")
def q_rolling_max_by(spark, sf_dir):
    e = events(spark, sf_dir, "event_id", "user_id", "ts", "value")
    r = rolling.rolling_max_by(e, "user_id", "event_id", "value", carry=["ts"])
    return r.select("event_id", "user_id", "max_value", "max_event_id", "max_ts")


@register("rolling_reduce", """
SELECT event_id, user_id, ts, max(value) OVER (PARTITION BY user_id ORDER BY event_id
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS max_value FROM events""")
def q_rolling_reduce(spark, sf_dir):
    e = events(spark, sf_dir, "event_id", "user_id", "ts", "value")
    return rolling.rolling_reduce_max(e, "user_id", "event_id", "value") \
        .select("event_id", "user_id", "ts", "max_value")


@register("keyed_running_count", """
SELECT user_id, event_id, count(*) OVER (PARTITION BY user_id ORDER BY event_id
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cnt FROM events""")
def q_keyed_running_count(spark, sf_dir):
    e = events(spark, sf_dir, "user_id", "event_id")
    return rolling.running_count(e, ["user_id"], ["event_id"]).select("user_id", "event_id", "cnt")


@register("global_running_count", """
SELECT event_id, count(*) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cnt
FROM events""")
def q_global_running_count(spark, sf_dir):
    e = events(spark, sf_dir, "event_id")
    return rolling.running_count(e, [], ["event_id"]).select("event_id", "cnt")


@register("changelog_count_avg", """
WITH r AS (
  SELECT user_id, event_id,
    count(user_id) OVER w AS n1, round(sum(value) OVER w, 6) AS s1, count(value) OVER w AS c1,
    coalesce(count(user_id) OVER wx, 0) AS n0, round(sum(value) OVER wx, 6) AS s0, coalesce(count(value) OVER wx, 0) AS c0
  FROM events
  WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         wx AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT user_id, event_id, 0 AS change_seq, false AS is_insert, n0 AS cnt,
       round(CASE WHEN c0 > 0 THEN s0 / c0 END, 6) AS avg_value
FROM r WHERE n0 > 0 AND NOT (n0 = n1 AND (CASE WHEN c0 > 0 THEN s0 / c0 END) IS NOT DISTINCT FROM (CASE WHEN c1 > 0 THEN s1 / c1 END))
UNION ALL
SELECT user_id, event_id, 1 AS change_seq, true AS is_insert, n1 AS cnt,
       round(CASE WHEN c1 > 0 THEN s1 / c1 END, 6) AS avg_value
FROM r WHERE n0 = 0 OR NOT (n0 = n1 AND (CASE WHEN c0 > 0 THEN s0 / c0 END) IS NOT DISTINCT FROM (CASE WHEN c1 > 0 THEN s1 / c1 END))""")
def q_changelog_count_avg(spark, sf_dir):
    e = events(spark, sf_dir, "user_id", "event_id", "value")
    c = rolling.changelog(e, "user_id", "event_id", "value", sum_digits=6)
    return c.select("user_id", "event_id", "change_seq", "is_insert", "cnt", r6("avg_value").alias("avg_value"))


@register("changelog_applied", ORACLE["group_count_avg"])
def q_changelog_applied(spark, sf_dir):
    """The changelog read back into the table it describes (SNK-7)."""
    e = events(spark, sf_dir, "user_id", "event_id", "value")
    c = rolling.changelog(e, "user_id", "event_id", "value", sum_digits=6).withColumn("avg_value", r6("avg_value"))
    return tables.apply_changelog(c, ["user_id", "cnt", "avg_value"])


def cents_over_mean() -> Column:
    """A value as whole hundredths, less 50."""
    return (F.round(F.col("value") * 100) - 5000).cast("bigint")


@register("rolling_reduce_user", """
WITH x AS (SELECT event_id, user_id, CAST(round(value * 100) AS BIGINT) - 5000 AS x FROM events),
s AS (SELECT *, sum(x) OVER w AS s FROM x WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
m AS (SELECT *, least(0, coalesce(min(s) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS low FROM s)
SELECT event_id, user_id, CAST(max(s - low) OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS best FROM m""")
def q_rolling_reduce_user(spark, sf_dir):
    """A user's reduce that is not field by field (A-4): the best stretch of consecutive events so far."""
    start, merge = rolling.best_stretch("best", cents_over_mean())
    e = events(spark, sf_dir, "event_id", "user_id", "value")
    return rolling.rolling_reduce_by(e, "user_id", "event_id", start, merge).select("event_id", "user_id", "best")


# ---------------------------------------------------------------- windows

@register("tumble_count", f"""
SELECT user_id, time_bucket({WINDOW_SQL}, ts) AS window_start, time_bucket({WINDOW_SQL}, ts) + {WINDOW_SQL} AS window_end,
       count(*) AS cnt FROM events GROUP BY ALL""")
def q_tumble_count(spark, sf_dir):
    return windows.tumble_count(events(spark, sf_dir, "user_id", "ts"), "user_id", "ts", WINDOW)


@register("tumble_apply", f"""
SELECT user_id, time_bucket({WINDOW_SQL}, ts) + {WINDOW_SQL} AS window_end, count(*) AS cnt
FROM events GROUP BY ALL""")
def q_tumble_apply(spark, sf_dir):
    e = events(spark, sf_dir, "user_id", "ts")
    return windows.tumble_fold(e, "user_id", "ts", WINDOW, count_fold("cnt"), [])


@register("table_tumble", f"""
SELECT user_id, time_bucket({WINDOW_SQL}, ts) + {WINDOW_SQL} AS window_end, count(user_id) AS cnt,
       round(round(sum(value), 6) / count(value), 6) AS avg_value FROM events GROUP BY ALL""")
def q_table_tumble(spark, sf_dir):
    t = windows.tumble_count_avg(events(spark, sf_dir, "user_id", "ts", "value"), "user_id", "ts", "value",
                                 WINDOW, sum_digits=6)
    return t.select("user_id", "window_end", "cnt", r6("avg_value").alias("avg_value"))


@register("sql_tumble", f"""
SELECT user_id, time_bucket({WINDOW_SQL}, ts) + {WINDOW_SQL} AS window_end, count(user_id) AS cnt,
       round(round(sum(value), 6) / count(value), 6) AS avg_value FROM events GROUP BY ALL""")
def q_sql_tumble(spark, sf_dir):
    events(spark, sf_dir).selectExpr("user_id", "CAST(ts AS TIMESTAMP) AS rt", "value") \
        .createOrReplaceTempView("sensor_rt")
    return spark.sql(f"""
        SELECT user_id, CAST(window(rt, '{WINDOW}').end AS TIMESTAMP_NTZ) AS window_end,
               count(user_id) AS cnt, round(round(sum(value), 6) / count(value), 6) AS avg_value
        FROM sensor_rt GROUP BY user_id, window(rt, '{WINDOW}')""")


@register("event_window_min", f"""
SELECT user_id, time_bucket({WINDOW_SQL}, ts) AS window_start, time_bucket({WINDOW_SQL}, ts) + {WINDOW_SQL} AS window_end,
       count(*) AS cnt, m.v AS min_value, m.o AS min_event_id, m.t AS min_ts FROM (
  SELECT *, min({{'v': value, 'o': event_id, 't': ts}}) OVER (PARTITION BY user_id, time_bucket({WINDOW_SQL}, ts)) AS m
  FROM events) GROUP BY ALL""")
def q_event_window_min(spark, sf_dir):
    e = events(spark, sf_dir, "user_id", "event_id", "ts", "value")
    return windows.window_min_by(e, "user_id", "ts", WINDOW, "value", "event_id")


@register("count_window_avg", """
SELECT user_id, event_id, n, round(a, 6) AS avg_value FROM (
  SELECT user_id, event_id, row_number() OVER w AS rn, count(*) OVER w5 AS n, avg(value) OVER w5 AS a
  FROM events
  WINDOW w AS (PARTITION BY user_id ORDER BY event_id),
         w5 AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))
WHERE rn % 2 = 0""")
def q_count_window_avg(spark, sf_dir):
    e = events(spark, sf_dir, "user_id", "event_id", "value")
    c = windows.count_window_avg(e, "user_id", "event_id", "value", 5, 2)
    return c.select("user_id", "event_id", "n", r6("avg_value").alias("avg_value"))


_OVER_SQL = """
SELECT user_id, ts, event_id, count(user_id) OVER ow AS cnt, round(avg(value) OVER ow, 6) AS avg_value
FROM events WINDOW ow AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""


@register("over_rows", _OVER_SQL)
def q_over_rows(spark, sf_dir):
    e = events(spark, sf_dir, "user_id", "event_id", "ts", "value")
    o = windows.over_rows(e, "user_id", ["ts", "event_id"], "value", 2)
    return o.select("user_id", "ts", "event_id", "cnt", r6("avg_value").alias("avg_value"))


@register("sql_over_rows", _OVER_SQL)
def q_sql_over_rows(spark, sf_dir):
    """The SQL named-window form (Spark runs it as a per-key window; the
    DataFrame form ``over_rows`` is the skew-safe plan)."""
    events(spark, sf_dir).createOrReplaceTempView("sensor")
    return spark.sql("""
        SELECT user_id, ts, event_id, count(user_id) OVER ow AS cnt, round(avg(value) OVER ow, 6) AS avg_value
        FROM sensor
        WINDOW ow AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""")


@register("rolling_reduce_fields", """
SELECT event_id, user_id, ts, max(value) OVER w AS max_value, min(value) OVER w AS min_value, max(ts) OVER w AS last_ts,
       count(value) OVER w AS cnt
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def q_rolling_reduce_fields(spark, sf_dir):
    e = events(spark, sf_dir, "event_id", "user_id", "ts", "value")
    out = rolling.rolling_reduce(e, "user_id", "event_id", {"max_value": ("max", "value"), "min_value": ("min", "value"),
                                                            "last_ts": ("max", "ts"), "cnt": ("count", "value")})
    return out.select("event_id", "user_id", "ts", "max_value", "min_value", "last_ts", "cnt")


def _spread_of_window(rows):
    """First and last reading of a window and its range, which needs the rows in order."""
    import pandas as pd

    rows = rows.sort_values("event_id")
    return pd.DataFrame({"user_id": rows["user_id"].iloc[:1], "window_end": rows["window_end"].iloc[:1], "cnt": [len(rows)],
                         "first_value": rows["value"].iloc[0], "last_value": rows["value"].iloc[-1]})


@register("tumble_apply_rows", """
SELECT user_id, time_bucket(INTERVAL 30 DAY, ts, TIMESTAMP '1970-01-01') + INTERVAL 30 DAY AS window_end, count(*) AS cnt,
       arg_min(value, event_id) AS first_value, arg_max(value, event_id) AS last_value
FROM events GROUP BY 1, 2""")
def q_tumble_apply_rows(spark, sf_dir):
    e = events(spark, sf_dir, "user_id", "event_id", "ts", "value")
    kind = e.schema["user_id"].dataType.simpleString()
    return windows.tumble_apply_rows(e, "user_id", "ts", "30 days", _spread_of_window,
                                     f"user_id {kind}, window_end timestamp_ntz, cnt bigint, first_value double, last_value double")


# ---------------------------------------------------------------- functions

@register("java_hash", f"""
SELECT event_id, id, CAST(CASE WHEN u >= 2147483648 THEN u - 4294967296 ELSE u END AS INTEGER) AS hash_code FROM (
  SELECT event_id, id, (list_reduce(list_transform(range(1, length(id) + 1), lambda i: unicode(substr(id, i, 1))),
                                    lambda a, c: (a * 31 + c) % 4294967296, CAST(0 AS BIGINT)) * {HASH_FACTOR}) % 4294967296 AS u
  FROM (SELECT event_id, 'sensor_' || CAST(user_id AS VARCHAR) AS id FROM events))""")
def q_java_hash(spark, sf_dir):
    e = events(spark, sf_dir, "event_id", "user_id")
    ids = e.select("event_id", F.concat(F.lit("sensor_"), F.col("user_id").cast("string")).alias("id"))
    return ids.select("event_id", "id", java_hash("id", HASH_FACTOR).alias("hash_code"))


@register("sql_java_hash", ORACLE["java_hash"])
def q_sql_java_hash(spark, sf_dir):
    """The hash as a SQL function (UDF-1 on the SQL surface)."""
    register_sql_functions(spark)
    events(spark, sf_dir, "event_id", "user_id").createOrReplaceTempView("sensor_hash")
    return spark.sql(f"""SELECT event_id, id, java_hash(id, {HASH_FACTOR}) AS hash_code
                         FROM (SELECT event_id, concat('sensor_', CAST(user_id AS STRING)) AS id FROM sensor_hash)""")


@register("lateral_split", f"""
SELECT doc_id, pos, word, CAST(length(word) AS INTEGER) AS length FROM ({_WORDS_SQL})""")
def q_lateral_split(spark, sf_dir):
    d = spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    s = lateral.lateral_split(d, "text", " ", keep=["doc_id"])
    return s.select("doc_id", F.col("pos").cast("bigint"), "word", "length")


@register("sql_lateral_split", """
SELECT event_id, id, CAST(pos - 1 AS BIGINT) AS pos, word, CAST(length(word) AS INTEGER) AS length FROM (
  SELECT event_id, id, unnest(parts) AS word, unnest(generate_series(1, len(parts))) AS pos FROM (
    SELECT event_id, id, CASE WHEN id <> '' AND rtrim(id, '_') = '' THEN []::VARCHAR[]
                               ELSE string_split(rtrim(id, '_'), '_') END AS parts
    FROM (SELECT event_id, 'sensor_' || CAST(user_id AS VARCHAR) AS id FROM events)))""")
def q_sql_lateral_split(spark, sf_dir):
    register_sql_functions(spark)
    events(spark, sf_dir).createOrReplaceTempView("sensor")
    return spark.sql("""
        SELECT s.event_id, s.id, CAST(p.pos AS BIGINT) AS pos, p.word, length(p.word) AS length
        FROM (SELECT event_id, concat('sensor_', CAST(user_id AS STRING)) AS id,
                     java_split(concat('sensor_', CAST(user_id AS STRING)), '_') AS parts FROM sensor) s,
             LATERAL posexplode(s.parts) AS p(pos, word)""")


# ---------------------------------------------------------------- alerts and late data

@register("jump_alert", f"""
SELECT user_id, event_id, prev_value, value FROM (
  SELECT user_id, event_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS prev_value,
         row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events)
WHERE rn > 1 AND abs(value - prev_value) >= {JUMP_THRESHOLD}""")
def q_jump_alert(spark, sf_dir):
    e = events(spark, sf_dir, "user_id", "event_id", "value")
    return alerts.jump_alert(e, "user_id", "event_id", "value", JUMP_THRESHOLD)


@register("rise_alert", f"""
WITH RECURSIVE a AS (
  SELECT user_id, event_id, ts, value,
         value > coalesce(lag(value) OVER (PARTITION BY user_id ORDER BY event_id), 4.9e-324) AS rise
  FROM events),
b AS (
  SELECT *, max(CASE WHEN NOT rise THEN event_id END) OVER (PARTITION BY user_id ORDER BY event_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS run,
         min(CASE WHEN NOT rise THEN {{'o': event_id, 't': ts}} END) OVER (PARTITION BY user_id ORDER BY event_id
             ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS brk
  FROM a),
r AS (SELECT user_id, event_id, ts, brk.t AS brk, coalesce(run, -1) AS run FROM b WHERE rise),
nxt AS (SELECT x.user_id, x.event_id, min(y.event_id) AS next_id FROM r x JOIN r y
        ON x.user_id = y.user_id AND x.run = y.run AND y.event_id > x.event_id
           AND y.ts > x.ts + INTERVAL {RISE_INTERVAL_S} SECOND GROUP BY ALL),
c AS (SELECT user_id, min(event_id) AS event_id FROM r GROUP BY user_id, run
      UNION ALL SELECT c.user_id, nxt.next_id FROM c JOIN nxt USING (user_id, event_id))
SELECT user_id, event_id, ts AS start_ts, ts + INTERVAL {RISE_INTERVAL_S} SECOND AS alert_ts
FROM r JOIN c USING (user_id, event_id)
WHERE brk IS NULL OR brk > ts + INTERVAL {RISE_INTERVAL_S} SECOND""")
def q_rise_alert(spark, sf_dir):
    e = events(spark, sf_dir, "user_id", "event_id", "ts", "value")
    return alerts.rise_alert(e, "user_id", "event_id", "ts", "value", RISE_INTERVAL_S)


def _arrival(e: DataFrame) -> DataFrame:
    return e.withColumn("arrival", F.col("event_id") + (F.col("event_id") * ARRIVAL_MULT) % ARRIVAL_MOD)


@register("late_split", f"""
WITH a AS (SELECT event_id, user_id, ts, event_id + (event_id * {ARRIVAL_MULT}) % {ARRIVAL_MOD} AS arrival FROM events),
b AS (SELECT *, max(ts) OVER (ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                 - INTERVAL {DELAY_S} SECOND AS wm,
             time_bucket({WINDOW_SQL}, ts) + {WINDOW_SQL} AS window_end FROM a)
SELECT event_id, user_id, ts, arrival, window_end, wm AS watermark,
       CASE WHEN wm IS NULL THEN 'on_time'
            WHEN window_end - INTERVAL 1 MILLISECOND + INTERVAL {LATENESS_S} SECOND <= wm THEN 'late'
            WHEN window_end - INTERVAL 1 MILLISECOND <= wm THEN 'refire'
            ELSE 'on_time' END AS status FROM b""")
def q_late_split(spark, sf_dir):
    e = _arrival(events(spark, sf_dir, "event_id", "user_id", "ts"))
    return late.late_split(e, ["arrival", "event_id"], "ts", WINDOW, DELAY_S, LATENESS_S)

"""Golden values: tumbling, count and row-frame windows; late-data split; alerts."""

from pyspark.sql import functions as F

from sensorflow.functions.fold import count_fold
from sensorflow.operators import alerts, late, windows
from tests.conftest import collect

def _end_secs(df):
    return df.withColumn("end_s", F.unix_seconds(F.col("window_end").cast("timestamp")) - 1547718000)


def test_tumble_10s_count_avg(readings):
    out = _end_secs(windows.tumble_count_avg(readings, "id", "timestamp", "temperature", "10 seconds"))
    got = [(i, e, c, round(a, 6)) for i, e, c, a in collect(out, "id", "end_s", "cnt", "avg_value")]
    assert got == sorted([("sensor_1", 200, 5, 42.4), ("sensor_1", 220, 1, 36.8), ("sensor_6", 210, 4, 27.15),
                          ("sensor_7", 210, 3, 24.366667), ("sensor_10", 210, 4, 39.6)])


def test_sql_tumble_10s(spark, readings):
    readings.selectExpr("id", "temperature as temp", "timestamp_seconds(timestamp) as rt").createOrReplaceTempView("s")
    rows = spark.sql("select id, count(id) as cnt, avg(temp) as a, window(rt, '10 seconds').end as e "
                     "from s group by id, window(rt, '10 seconds')").collect()
    assert sorted((r.id, r.cnt) for r in rows) == sorted(
        [("sensor_1", 5), ("sensor_1", 1), ("sensor_6", 4), ("sensor_7", 3), ("sensor_10", 4)])


W15 = sorted([("sensor_1", 210, 5, 35.8, 14), ("sensor_1", 225, 1, 36.8, 1), ("sensor_6", 210, 4, 15.4, 2),
              ("sensor_7", 210, 3, 7.7, 8), ("sensor_10", 210, 4, 38.1, 10)])


def test_window_min_by_15s(readings):
    out = _end_secs(windows.window_min_by(readings, "id", "timestamp", "15 seconds", "temperature", "seq"))
    assert collect(out, "id", "end_s", "cnt", "min_temperature", "min_seq") == W15


def test_tumble_count_and_fold(readings):
    c = _end_secs(windows.tumble_count(readings, "id", "timestamp", "15 seconds"))
    assert collect(c, "id", "end_s", "cnt") == [w[:3] for w in W15]
    f = _end_secs(windows.tumble_fold(readings.repartition(3), "id", "timestamp", "15 seconds", count_fold(), []))
    assert collect(f, "id", "end_s", "cnt") == [w[:3] for w in W15]


def test_count_window(readings):
    out = windows.count_window_avg(readings, "id", "seq", "temperature", 5, 2)
    got = [(s, n, round(a, 6)) for s, n, a in collect(out, "seq", "n", "avg_value")]
    assert [(s, round(a, 6)) for s, _, a in got] == [(1, 36.8), (3, 20.9), (5, 27.15), (7, 32.7), (10, 39.6),
                                                      (12, 39.6), (14, 36.8), (16, 42.4)]
    assert [n for _, n, _ in got] == [2, 2, 4, 2, 2, 4, 4, 5]


OVER = {0: (1, 36.8), 13: (2, 37.3), 14: (3, 36.8), 15: (3, 46.466667), 16: (3, 45.8), 1: (3, 46.133333),
        2: (1, 15.4), 3: (2, 20.9), 4: (3, 29.733333), 5: (3, 31.066667), 6: (1, 8.7), 7: (2, 32.7),
        8: (3, 24.366667), 9: (1, 41.1), 10: (2, 39.6), 11: (3, 39.433333), 12: (3, 39.1)}


def test_over_rows(readings):
    out = windows.over_rows(readings, "id", ["timestamp", "seq"], "temperature", 2)
    assert {s: (c, round(a, 6)) for s, c, a in collect(out, "seq", "cnt", "avg_value")} == OVER


def test_sql_named_window(spark, readings):
    readings.createOrReplaceTempView("sensor_w")
    rows = spark.sql("""select seq, count(id) over ow as cnt, avg(temperature) over ow as a from sensor_w
                        window ow as (partition by id order by timestamp, seq
                                      rows between 2 preceding and current row)""").collect()
    assert {r.seq: (r.cnt, round(r.a, 6)) for r in rows} == OVER


def test_late_split_fixture(readings):
    out = late.late_split(readings, ["seq"], "timestamp", "15 seconds", 2, 60)
    st = dict(collect(out, "seq", "status"))
    assert [s for s in range(17) if st[s] == "on_time"] == [0, 1]
    assert all(st[s] == "refire" for s in range(2, 17))


def test_late_split_drops(spark):
    rows = [(0, 1547718199, 1.0), (1, 1547718300, 2.0), (2, 1547718100, 3.0), (3, 1547718301, 4.0),
            (4, 1547718100, 5.0), (5, 1547718302, 6.0)]
    df = spark.createDataFrame(rows, "seq bigint, timestamp bigint, temperature double")
    out = late.late_split(df, ["seq"], "timestamp", "15 seconds", 2, 60)
    late_rows = [r.temperature for r in out.where("status = 'late'").collect()]
    assert sorted(late_rows) == [3.0, 5.0]


def test_jump_alert(readings):
    out = alerts.jump_alert(readings, "id", "seq", "temperature", 10.0)
    assert [r[0] for r in collect(out, "seq")] == [3, 4, 5, 7, 8, 15, 16]


def test_rise_alert(readings):
    out = alerts.rise_alert(readings, "id", "seq", "timestamp", "temperature", 10)
    got = collect(out.withColumn("s", F.unix_seconds(F.col("start_ts").cast("timestamp"))), "id", "s")
    assert got == [("sensor_1", 1547718199), ("sensor_10", 1547718205)]


def test_late_split_keeps_rows_without_time(spark):
    df = spark.createDataFrame([(0, 1547718199, 1.0), (1, None, 2.0), (2, 1547718300, 3.0)],
                               "seq bigint, timestamp bigint, temperature double")
    out = late.late_split(df, ["seq"], "timestamp", "15 seconds", 2, 60)
    assert dict(collect(out, "seq", "status")) == {0: "on_time", 1: "on_time", 2: "on_time"}

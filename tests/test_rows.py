"""Golden values on the 17-reading fixture: parsing, projections, routing, unions."""

import os

import pytest
from pyspark.sql import functions as F

from sensorflow.functions.text import java_split, java_split_py
from sensorflow.operators import aggregates as agg
from sensorflow.operators import transforms as T
from sensorflow.sources import parse_readings, read_csv_table
from tests.conftest import DATA, collect


def test_parse_readings(readings):
    rows = collect(readings, "seq", "id", "timestamp", "temperature")
    assert len(rows) == 17
    assert rows[0] == (0, "sensor_1", 1547718199, 36.8)
    assert rows[9] == (9, "sensor_10", 1547718205, 41.1)


@pytest.mark.parametrize("line", ["sensor_1,1547718199", "sensor_1,abc,36.8", "sensor_1,1547718199,x"])
def test_malformed_line_fails(spark, line):
    df = spark.createDataFrame([(line,)], "value string")
    with pytest.raises(Exception):
        parse_readings(df).collect()


def test_malformed_dropped_on_request(spark):
    df = spark.createDataFrame([("sensor_1,1,2.0",), ("bad",), ("s,1,x",), ("s,2,3.5,extra",)], "value string")
    out = collect(parse_readings(df, mode="DROPMALFORMED"), "id", "timestamp", "temperature")
    assert out == [("s", 2, 3.5), ("sensor_1", 1, 2.0)]


def test_java_split_edge_cases(spark):
    cases = ["a b  ", "", "  ", " a", "a  b", "hello world"]
    df = spark.createDataFrame([(c,) for c in cases], "s string")
    got = [r[0] for r in df.select(java_split("s", " ")).collect()]
    assert got == [java_split_py(c, " ") for c in cases]
    assert got[:4] == [["a", "b"], [""], [], ["", "a"]]


def test_line_length(lines):
    out = [r["len"] for r in T.line_length(lines).orderBy("seq").collect()]
    assert out == [24] * 6 + [23, 24, 23] + [25] * 4 + [24] * 4


def test_flatmap_fields(lines):
    assert T.split_fields(lines, keep=["seq"]).count() == 51


def test_word_count(hello):
    got = dict(collect(agg.word_count(hello, "value", " "), "word", "cnt"))
    assert got.pop("hello") == 7
    assert sorted(got) == sorted("world flink spark scala spring hibernate pytorch".split())
    assert set(got.values()) == {1}


def test_filter_prefix(readings):
    out = T.filter_prefix(readings, "id", "sensor_1")
    ids = [r["id"] for r in out.collect()]
    assert len(ids) == 10 and ids.count("sensor_1") == 6 and ids.count("sensor_10") == 4


def test_table_and_sql_filter(spark, readings):
    assert readings.select("id", "temperature").where("id = 'sensor_1'").count() == 6
    readings.createOrReplaceTempView("sensor")
    got = [r[1] for r in spark.sql("select id, temperature from sensor where id = 'sensor_6' order by seq").collect()]
    with open(os.path.join(DATA, "output.txt")) as f:
        golden = [float(line.split(",")[1]) for line in f.read().split()]
    assert got == golden


def test_split_select_and_side_output(readings):
    tagged = T.tag_high_low(readings, "temperature")
    assert T.select_tags(tagged, "high").count() == 12
    assert T.select_tags(tagged, "low").count() == 5
    assert T.select_tags(tagged, "high", "low").count() == 17
    main, side = T.side_output(readings, "temperature")
    assert (main.count(), side.count()) == (12, 5)


def test_exactly_30_is_low(spark):
    df = spark.createDataFrame([("a", 1, 30.0), ("b", 1, 30.01)], "id string, timestamp bigint, temperature double")
    assert collect(T.tag_high_low(df, "temperature"), "id", "tag") == [("a", "low"), ("b", "high")]


def test_connect_status(readings):
    out = T.connect_status(readings, "id", "temperature")
    got = collect(out.groupBy("status").agg(F.count("*").alias("n"), F.count("temperature").alias("t")),
                  "status", "n", "t")
    assert got == [("high temp warning", 12, 12), ("normal", 5, 0)]


def test_union_all(readings):
    high, low = T.side_output(readings, "temperature")
    assert T.union_all(high, low, readings).count() == 34


def test_partitioning_keeps_rows(readings):
    for df in (T.shuffle_rows(readings, 3), T.key_by(readings, "id", n=3), T.rebalance(readings, 3),
               T.global_partition(readings)):
        assert collect(df, "seq") == collect(readings, "seq")
    assert T.global_partition(readings).rdd.getNumPartitions() == 1


def test_partition_tag_runs_setup_and_teardown(readings):
    out = T.tag_partition(readings.repartition(3), setup=lambda: {"opened": True}, teardown=lambda ctx: None)
    rows = out.collect()
    assert len(rows) == 17 and {r["subtask"] for r in rows} <= {0, 1, 2}


def test_csv_table_source(spark, tmp_path):
    p = str(tmp_path / "sensor")
    os.makedirs(p)
    with open(os.path.join(DATA, "sensor.txt")) as src, open(os.path.join(p, "part.csv"), "w") as dst:
        dst.write(src.read())
    t = read_csv_table(spark, p, view="input_table")
    assert t.count() == 17
    assert spark.sql("select count(*) from input_table where id = 'sensor_6'").first()[0] == 4

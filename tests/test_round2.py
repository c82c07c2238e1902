"""Java string semantics, null handling, and streams that must be whole or fail."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sensorflow.functions.text import java_hash, java_hash_py, java_split, java_split_py
from sensorflow.operators import transforms, windows
from sensorflow.plans.scan import Run, row_number, scan
from sensorflow.sinks import writers
from sensorflow.sources import readers
from sensorflow.sqlfuncs import register_sql_functions
from sensorflow.streaming import ops as S

FIX = [HealthCheck.function_scoped_fixture]


@settings(max_examples=6, deadline=None, suppress_health_check=FIX)
@given(st.lists(st.text("ab ,\n\U0001F600é", max_size=8), min_size=20, max_size=40))
def test_java_split_and_hash_equal_their_python_twins(spark, texts):
    texts = [*texts, "", "a b \n", "xaaa", ",,", None]
    register_sql_functions(spark)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    seps = [" ", ",", "aa", "a|b"]
    cols = [java_split("s", p).alias(f"p{k}") for k, p in enumerate(seps)] + [F.expr(f"java_split(s, '{p}')").alias(f"q{k}") for k, p in enumerate(seps)]
    df.createOrReplaceTempView("texts_")
    sql = {r["i"]: r["h"] for r in spark.sql("SELECT i, java_hash(s, 23) AS h FROM texts_").collect()}
    for r in df.select("i", "s", java_hash("s", 23).alias("h"), *cols).collect():
        if r["s"] is None:
            assert r["h"] is None and r["p0"] is None and r["q0"] is None and sql[r["i"]] is None
            continue
        assert r["h"] == sql[r["i"]] == java_hash_py(r["s"], 23)
        for k, p in enumerate(seps):
            assert r[f"p{k}"] == r[f"q{k}"] == java_split_py(r["s"], p), (r["s"], p)


def test_malformed_lines_fail_whatever_is_selected(spark):
    lines = spark.createDataFrame([("a,1,2.5",), ("b, 1 ,2.5",)], "value string")
    for use in (lambda d: d.count(), lambda d: d.select("id").collect()):
        with pytest.raises(Exception, match="malformed"):
            use(readers.parse_readings(lines))
    assert readers.parse_readings(lines, mode="DROPMALFORMED").count() == 1


def test_shuffle_spreads_equal_rows(spark):
    parts = transforms.shuffle_rows(spark.createDataFrame([(1,)] * 1000, "x int"), 8).withColumn("p", F.spark_partition_id())
    sizes = [r["count"] for r in parts.groupBy("p").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 125


@pytest.mark.parametrize("segments", [None, 1, 7])
def test_null_order_comes_first_for_any_segment_count(spark, segments):
    rows = [("k", v) for v in (3, 1, None, 2, 5, 4)]
    df = spark.createDataFrame(rows, "k string, o int")
    got = {r["o"]: r["rn"] for r in row_number(df, ["k"], ["o"], n_segments=segments).collect()}
    assert got == {None: 1, 1: 2, 2: 3, 3: 4, 4: 5, 5: 6}


def test_string_order(spark):
    df = spark.createDataFrame([("k", c) for c in ("pear", "apple", "zebra", "é", "fig", "figs")], "k string, o string")
    got = {r["o"]: r["rn"] for r in scan(df, ["k"], ["o"], [Run("rn", "count")], n_segments=4).collect()}
    assert got == {"apple": 1, "fig": 2, "figs": 3, "pear": 4, "zebra": 5, "é": 6}


def test_two_way_writer_keeps_null_predicates(spark, tmp_path):
    df = spark.createDataFrame([(1, 40.0), (2, 10.0), (3, None)], "i int, v double")
    writers.two_way_writer(str(tmp_path / "m"), str(tmp_path / "s"), F.col("v") > 30)(df, 0)
    both = [spark.read.parquet(str(tmp_path / x)).count() for x in "ms"]
    assert both == [2, 1]


def slices(spark, path, frames):
    for f in frames:
        f.coalesce(1).write.mode("append").parquet(path)
    return readers.read_table_stream(spark, path, frames[0].schema, max_files_per_trigger=1)


ROWS = "k string, seq bigint, v double, c string"
DATA = [("a", 1, None, "x"), ("a", 2, 2.0, None), ("a", 3, None, "y"), ("a", 4, 3.0, "z"), (None, 5, 1.0, "n"), (None, 6, None, "n"), ("a", 7, 1.0, "w"), (None, 8, 4.0, "m")]


def stream_of(spark, tmp_path, name):
    frames = [spark.createDataFrame(DATA[i: i + 3], ROWS) for i in range(0, len(DATA), 3)]
    return slices(spark, str(tmp_path / name), frames)


def same(a, b, cols):
    key = lambda r: str(tuple(r[c] for c in cols))
    assert sorted(map(key, a.collect())) == sorted(map(key, b.collect()))


def test_stream_equals_batch_with_nulls_over_batches(spark, tmp_path):
    df = spark.createDataFrame(DATA, ROWS)
    run = lambda s, n: writers.stream_to_table(spark, s, str(tmp_path / f"{n}-o"), str(tmp_path / f"{n}-c"))
    out = run(S.over_rows_stream(stream_of(spark, tmp_path, "a"), "k", ["seq"], "v", 2), "a")
    same(out, windows.over_rows(df, "k", ["seq"], "v", 2), ["k", "seq", "cnt", "avg_value"])
    out = run(S.count_window_avg_stream(stream_of(spark, tmp_path, "b"), "k", "seq", "v", 5, 2), "b")
    same(out, windows.count_window_avg(df, "k", "seq", "v", 5, 2), ["k", "seq", "n", "avg_value"])
    out = run(S.rolling_max_by_stream(stream_of(spark, tmp_path, "c"), "k", "seq", "v", ["c"]), "c")
    best = {(r["k"], r["seq"]): (r["max_v"], r["max_seq"], r["max_c"]) for r in out.collect()}
    assert best == {("a", 1): (None, 1, "x"), ("a", 2): (2.0, 2, None), ("a", 3): (2.0, 2, None), ("a", 4): (3.0, 4, "z"), ("a", 7): (3.0, 4, "z"),
                    (None, 5): (1.0, 5, "n"), (None, 6): (1.0, 5, "n"), (None, 8): (4.0, 8, "m")}


def test_a_stream_that_is_not_done_in_time_raises(spark, tmp_path):
    frames = [spark.createDataFrame(DATA[i: i + 1], ROWS) for i in range(8)]
    s = S.running_count_stream(slices(spark, str(tmp_path / "src"), frames), "k", "seq")
    with pytest.raises(TimeoutError):
        writers.stream_to_table(spark, s, str(tmp_path / "o"), str(tmp_path / "c"), timeout_s=0.01)


def test_folder_tables_and_empty_streams(spark, tmp_path):
    df = spark.createDataFrame(DATA, ROWS)
    df.repartition(4).write.parquet(str(tmp_path / "t.parquet"))
    s = readers.table_stream(spark, str(tmp_path), "t", 1)
    out = writers.stream_to_table(spark, s, str(tmp_path / "o"), str(tmp_path / "c"))
    assert out.count() == len(DATA)
    (tmp_path / "none").mkdir()
    empty = readers.read_table_stream(spark, str(tmp_path / "none"), df.schema)
    assert writers.stream_to_table(spark, empty, str(tmp_path / "eo"), str(tmp_path / "ec")).collect() == []


def test_text_stream_and_table_with_rowtime(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("s1,10,1.5\ns2,20,2.5\n")
    lines = readers.read_lines_stream(spark, str(tmp_path / "in"), "*.txt", 1)
    rows = readers.parse_readings(lines)
    table = readers.to_table(rows, {"id": "id", "timestamp": "ts", "temperature": "temp"}, ("rt", "timestamp"))
    out = writers.stream_to_table(spark, table, str(tmp_path / "o"), str(tmp_path / "c"))
    assert out.columns == ["id", "ts", "temp", "rt"]
    assert sorted((r["id"], r["ts"], r["temp"], r["rt"].second) for r in out.collect()) == [("s1", 10, 1.5, 10), ("s2", 20, 2.5, 20)]


def test_rise_alert_rearms_after_an_alert(spark, tmp_path):
    """One rising run of 40 s with a timer of 10 s: alerts set at 0, 12, 24; the timer set at 36 is cancelled at 40."""
    from sensorflow.operators import alerts

    rows = [("a", i, 1000 + 4 * i, float(i + 1)) for i in range(10)] + [("a", 10, 1040, 0.0), ("b", 11, 1041, 1.0), ("b", 12, 1060, 2.0)]
    df = spark.createDataFrame(rows, "k string, seq bigint, ts bigint, v double")
    got = sorted((r["k"], r["seq"]) for r in alerts.rise_alert(df, "k", "seq", "ts", "v", 10).collect())
    assert got == [("a", 0), ("a", 3), ("a", 6), ("b", 11), ("b", 12)]
    end = spark.createDataFrame([("zz", 99, 10**6, -1.0)], df.schema)
    for name, step in (("one", 13), ("many", 3)):
        frames = [df.where((F.col("seq") >= i) & (F.col("seq") < i + step)) for i in range(0, 13, step)]
        s = slices(spark, str(tmp_path / name), [*frames, end])
        out = writers.stream_to_table(spark, S.rise_alert_stream(s, "k", "seq", "ts", "v", 10, "5 seconds"), str(tmp_path / f"{name}-o"), str(tmp_path / f"{name}-c"))
        assert sorted((r["k"], r["seq"]) for r in out.collect()) == got

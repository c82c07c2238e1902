"""Scalar, table and aggregate functions."""

from sensorflow.functions.text import java_hash, java_hash_py, java_split, java_split_py
from sensorflow.operators.lateral import lateral_split, register_split_udtf
from tests.conftest import collect

HASHES = {"sensor_1": -1036124876, "sensor_6": -1036124761, "sensor_7": -1036124738, "sensor_10": -2055098980}


def test_java_hash(readings):
    got = dict(collect(readings.select("id", java_hash("id", 23).alias("h")).distinct(), "id", "h"))
    assert got == HASHES
    assert {k: java_hash_py(k, 23) for k in HASHES} == HASHES


def test_java_hash_edge(spark):
    df = spark.createDataFrame([("",), ("a",), ("é漢",), ("x" * 100,)], "s string")
    got = [r[0] for r in df.select(java_hash("s")).collect()]
    assert got == [java_hash_py(s) for s in ["", "a", "é漢", "x" * 100]]


def test_lateral_split(readings):
    out = lateral_split(readings, "id", "_", keep=["seq"])
    rows = collect(out, "seq", "word", "length")
    assert len(rows) == 34
    assert sum(1 for r in rows if r[1:] == ("sensor", 6)) == 17


def test_sql_lateral_split_udtf(spark, readings):
    register_split_udtf(spark)
    readings.createOrReplaceTempView("sensor_u")
    rows = spark.sql("select s.id, t.word, t.length from sensor_u s, lateral split_words(s.id, '_') t").collect()
    assert len(rows) == 34 and {(r.word, r.length) for r in rows if r.id == "sensor_10"} == {("sensor", 6), ("10", 2)}


def test_java_split_of_plain_separators(spark):
    texts = ["", " ", "  ", "a", "a ", " a", "a  b  ", " a b", "_", "a__b_", "é 漢 ", "a,b,,", ",", "a.b.", None]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    for sep in [" ", "_", ",", "[.]", "\\."]:
        parts = df.select("s", java_split("s", sep).alias("p"))
        got = [r["p"] for r in parts.collect()]
        assert got == [None if t is None else java_split_py(t, sep) for t in texts], sep
        assert ("transform" in parts._jdf.queryExecution().executedPlan().toString()) == (len(sep) > 1)

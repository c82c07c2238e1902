"""Tables that streams keep, and readers of changelogs."""

import os
import sqlite3

import pytest
from pyspark.sql import functions as F

from sensorflow.operators import rolling
from sensorflow.sinks.tables import BucketedTable, apply_changelog, changelog_writer, upsert_writer
from sensorflow.sinks.writers import upsert_dbapi

SCHEMA = "k string, seq bigint, v double"


def folders(path):
    return {(v, b) for v in os.listdir(path) if v.startswith("_v=") for b in os.listdir(f"{path}/{v}") if b.startswith("_bucket")}


def test_upserts_touch_their_buckets_only(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = spark.createDataFrame([], SCHEMA).schema
    table = BucketedTable(spark, path, schema, ["k"], buckets=8)
    write = upsert_writer(table, "seq")
    assert table.read().collect() == []
    rows = lambda part: spark.createDataFrame(part, SCHEMA)
    write(rows([(f"k{i}", i, 1.0) for i in range(60)] + [(None, 5, 1.0), ("k1", None, 9.0), ("k2", -1, 9.0)]), 0)
    state = {r["k"]: (r["seq"], r["v"]) for r in table.read().collect()}
    assert len(state) == 61 and state["k1"] == (1, 1.0) and state["k2"] == (2, 1.0) and state[None] == (5, 1.0)
    first = folders(path)
    write(rows([("k7", 100, 2.0), ("k7", 99, 3.0), ("new", 1, 4.0)]), 1)
    changed = {b for v, b in folders(path) if v == "_v=1"}
    assert 1 <= len(changed) <= 2 and {x for x in folders(path) if x[0] == "_v=0"} == first  # the version before stays whole
    write(rows([("k7", 100, 5.0)]), 1)  # the same batch again, from the same start
    state = {r["k"]: (r["seq"], r["v"]) for r in table.read().collect()}
    assert state["k7"] == (100, 5.0) and "new" not in state and len(state) == 61
    for b in range(2, 6):
        write(rows([(f"k{i}", 1000 + b, float(b)) for i in range(60)]), b)
    assert {v for v, _ in folders(path)} == {"_v=4", "_v=5"} | {v for v, b in folders(path) if v in ("_v=0", "_v=1")}
    assert len(table.read().collect()) == 61
    assert sorted(n for n in os.listdir(f"{path}/_manifest") if n.startswith("v=")) == ["v=4", "v=5"]


def test_changelog_gives_the_table_back(spark, readings, tmp_path):
    changes = rolling.changelog(readings, "id", "seq", "temperature", sum_digits=6)
    want = sorted((r["id"], r["cnt"], round(r["a"], 6)) for r in readings.groupBy("id").agg(F.count("id").alias("cnt"), F.avg("temperature").alias("a")).collect())
    rounded = changes.withColumn("avg_value", F.round("avg_value", 6))
    got = apply_changelog(rounded, ["id", "cnt", "avg_value"])
    assert sorted(map(tuple, got.collect())) == want
    # in several batches, with a retraction before its insert, and one batch twice
    schema = rounded.select("id", "cnt", "avg_value").withColumn("n", F.lit(1).cast("bigint")).schema
    table = BucketedTable(spark, str(tmp_path / "c"), schema, ["id"], buckets=4)
    write = changelog_writer(table)
    parts = [rounded.where("seq >= 10"), rounded.where("seq < 4"), rounded.where("seq between 4 and 9")]
    for k, part in enumerate(parts):
        write(part, k)
    write(parts[2], 2)
    assert sorted((r["id"], r["cnt"], r["avg_value"]) for r in table.read().collect()) == want
    assert {r["n"] for r in table.read().collect()} == {1}


def test_changelog_of_repeated_rows_and_faults(spark):
    ch = spark.createDataFrame([("a", 1, True), ("a", 1, True), (None, 2, True), ("b", 1, True), ("b", 1, False)], "k string, x int, is_insert boolean")
    assert sorted(map(tuple, apply_changelog(ch, ["k", "x"]).collect()), key=str) == [("a", 1), ("a", 1), (None, 2)]
    with pytest.raises(Exception, match="never inserted"):
        apply_changelog(ch.unionByName(spark.createDataFrame([("c", 1, False)], ch.schema)), ["k", "x"]).collect()


def test_batched_dbapi_upsert(spark, tmp_path):
    db = str(tmp_path / "t.db")
    with sqlite3.connect(db) as c:
        c.execute("create table t (k integer primary key, v real)")
        c.executemany("insert into t values (?, ?)", [(k, 0.0) for k in range(0, 900, 3)])
    df = spark.createDataFrame([(k, float(k)) for k in range(1200)] + [(5, 7.5), (5, 6.5)], "k int, v double")
    upsert_dbapi(df.coalesce(1), lambda: sqlite3.connect(db), "t", "k", ["v"], rows_per_call=70)  # no order: the largest row
    with sqlite3.connect(db) as c:
        assert c.execute("select count(*), sum(v) from t").fetchall() == [(1200, sum(range(1200)) + 2.5)]
    with pytest.raises(Exception, match="null k"):
        upsert_dbapi(spark.createDataFrame([(None, 1.0)], "k int, v double"), lambda: sqlite3.connect(db), "t", "k", ["v"])

"""Golden values: grouped and rolling aggregates, changelog, keyed and global counts."""

from pyspark.sql import functions as F

from sensorflow.functions.fold import avg_fold, fold_by
from sensorflow.operators import aggregates as agg
from sensorflow.operators import rolling
from tests.conftest import collect

A5 = {"sensor_1": (6, 41.466667), "sensor_6": (4, 27.15), "sensor_7": (3, 24.366667), "sensor_10": (4, 39.6)}
A3 = {0: 0, 1: 0, 2: 2, 3: 3, 4: 4, 5: 4, 6: 6, 7: 7, 8: 7, 9: 9, 10: 9, 11: 9, 12: 9, 13: 13, 14: 13, 15: 15, 16: 15}


def test_group_count_avg(readings):
    got = {r["id"]: (r["cnt"], round(r["avg_value"], 6)) for r in agg.count_avg(readings, "id", "temperature").collect()}
    assert got == A5


def test_udaf_fold_matches_avg(readings):
    out = fold_by(readings.repartition(3), ["id"], avg_fold("temperature"), ["temperature"])
    assert {r["id"]: round(r["avg_value"], 6) for r in out.collect()} == {k: v[1] for k, v in A5.items()}


def test_rolling_max_by(readings):
    out = rolling.rolling_max_by(readings, "id", "seq", "temperature", carry=["timestamp"], segments=None)
    got = dict(collect(out, "seq", "max_seq"))
    assert got == A3


def test_rolling_max_by_many_segments(readings):
    """Same answer when every row is its own segment (the carry path does all the work)."""
    out = rolling.rolling_max_by(readings, "id", "seq", "temperature", carry=[], segments=F.col("seq"))
    assert dict(collect(out, "seq", "max_seq")) == A3


def test_rolling_reduce(readings):
    out = rolling.rolling_reduce_max(readings, "id", "seq", "temperature")
    temps = dict(collect(readings, "seq", "temperature"))
    got = collect(out, "seq", "timestamp", "max_value")
    ts = dict(collect(readings, "seq", "timestamp"))
    assert got == sorted((s, ts[s], temps[A3[s]]) for s in A3)


def test_keyed_and_global_running_count(readings):
    kc = collect(rolling.running_count(readings, ["id"], ["seq"]), "id", "seq", "cnt")
    per = {}
    for i, _s, c in kc:
        per.setdefault(i, []).append(c)
    assert {k: sorted(v) for k, v in per.items()} == {
        "sensor_1": [1, 2, 3, 4, 5, 6], "sensor_6": [1, 2, 3, 4], "sensor_7": [1, 2, 3], "sensor_10": [1, 2, 3, 4]}
    g = collect(rolling.running_count(readings, [], ["seq"], segments=F.floor(F.col("seq") / 4)),
                "seq", "cnt")
    assert g == [(s, s + 1) for s in range(17)]


def test_changelog_counts(readings):
    both = rolling.changelog(readings, "id", "seq", "temperature")
    assert both.count() == 30
    assert both.where("is_insert").count() == 17
    first = both.where("id = 'sensor_1' and seq = 0").collect()
    assert [(r.is_insert, r.cnt, r.avg_value) for r in first] == [(True, 1, 36.8)]
    avg_only = rolling.changelog(readings, "id", "seq", "temperature", with_count=False)
    assert avg_only.count() == 28


def test_latest_per_key(readings):
    got = dict(collect(agg.latest_per_key(readings, "id", "seq", "temperature"), "id", "temperature"))
    assert got == {"sensor_1": 35.8, "sensor_6": 19.4, "sensor_7": 7.7, "sensor_10": 40.1}


def test_word_count_running(hello):
    w = agg.words(hello.withColumn("line", F.monotonically_increasing_id()), "value", " ", keep=["line"], pos="pos")
    out = rolling.running_count(w, ["word"], ["line", "pos"])
    assert sorted(r["cnt"] for r in out.where("word = 'hello'").collect()) == list(range(1, 8))


def test_word_count_running_does_not_shuffle_words(spark):
    docs = spark.createDataFrame([(k, "a b a" if k % 3 else "c a") for k in range(60)] + [(None, "a z"), (7, "a"), (7, None), (8, ""), (9, "  ")],
                                 "doc_id bigint, text string")

    def words(d, keep):
        return agg.words(d, "text", " ", keep=["doc_id", *keep], pos="pos")
    out = rolling.running_count(docs, ["word"], ["doc_id", "pos"], segments=[10.0, 20.0, 45.0], rows=words)
    old = rolling.running_count(words(docs, []), ["word"], ["doc_id", "pos"], segments=[10.0, 20.0, 45.0])
    key = lambda r: tuple((x is not None, x) for x in r)
    assert out.columns == old.columns and out.schema["cnt"].dataType == old.schema["cnt"].dataType
    # rows of equal order (document 7) share their numbers in either order
    got, want = (sorted([(r["doc_id"], r["word"], r["cnt"]) for r in x.collect()], key=key) for x in (out, old))
    assert got == want
    assert sorted(r["cnt"] for r in out.where("word = 'a'").collect()) == list(range(1, 103))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan[plan.index("Window"): plan.index("Generate")]

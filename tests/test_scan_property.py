"""The segmented scan equals a plain per-key window, whatever the segmentation
and however skewed the keys (one key may hold most rows)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from sensorflow.plans.scan import Run, scan
from sensorflow.operators import windows

rows_st = st.lists(
    st.tuples(st.sampled_from([0, 0, 0, 0, 1, 2, None]), st.one_of(st.none(), st.floats(-50, 50, allow_nan=False))),
    min_size=1, max_size=60)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_st, n_seg=st.integers(1, 9))
def test_scan_matches_window(spark, rows, n_seg):
    data = [(i, k, v) for i, (k, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "seq bigint, k int, v double")
    runs = [Run("cnt", "count"), Run("s", "sum", F.col("v")), Run("mx", "max", F.col("v")),
            Run("prev", "max", F.struct("seq", "v"), inclusive=False),
            Run("nxt_min", "min", F.col("v"), reverse=True, inclusive=False)]
    got = scan(df, ["k"], ["seq"], runs, n_segments=n_seg).select("seq", "cnt", "s", "mx", "prev", "nxt_min")
    w = Window.partitionBy("k").orderBy("seq")
    want = df.select(
        "seq",
        F.count(F.lit(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cnt"),
        F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s"),
        F.max("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("mx"),
        F.max(F.struct("seq", "v")).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("prev"),
        F.min("v").over(w.rowsBetween(1, Window.unboundedFollowing)).alias("nxt_min"))

    def norm(df_):
        return sorted((r.seq, r.cnt, None if r.s is None else round(r.s, 6), r.mx,
                       None if r.prev is None else tuple(r.prev), r.nxt_min) for r in df_.collect())

    assert norm(got) == norm(want)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_st, n_seg=st.integers(1, 7))
def test_count_window_matches_frame(spark, rows, n_seg):
    data = [(i, k if k is not None else 9, v if v is not None else 0.0) for i, (k, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "seq bigint, k int, v double")
    from sensorflow.plans.scan import quantile_bounds
    got = windows.count_window_avg(df, "k", "seq", "v", 5, 2, segments=quantile_bounds(df, "seq", n_seg))
    w = Window.partitionBy("k").orderBy("seq")
    want = (df.select("seq", F.row_number().over(w).alias("rn"),
                      F.count(F.lit(1)).over(w.rowsBetween(-4, 0)).alias("n"),
                      F.avg("v").over(w.rowsBetween(-4, 0)).alias("a"))
            .where("rn % 2 = 0"))
    assert sorted((r.seq, r.n, round(r.avg_value, 6)) for r in got.collect()) == \
        sorted((r.seq, r.n, round(r.a, 6)) for r in want.collect())

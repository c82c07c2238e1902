"""Keyed alerts: jump (F-3) and continuous rise (F-5), batch form.

Both need the previous row of a key. "Previous row" is an exclusive running
``max(struct(order, value))``, an associative scan, so it runs through the
skew-safe segmented scan rather than a per-key ``lag`` window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.plans.scan import Run, quantile_bounds, scan
from sensorflow.schema import as_ntz, event_time

# Fixed value: the reference's initial "last temperature" is Java's
# Double.MIN_VALUE, the smallest positive double.
JAVA_DOUBLE_MIN_VALUE = 4.9e-324


def jump_alert(df: DataFrame, key: str, order: str, value: str, threshold: float = 10.0,
               segments=None) -> DataFrame:
    """Emit ``(key, order, prev_value, value)`` when ``|value - previous| >=
    threshold`` (inclusive); the first row of a key only sets the state."""
    prev = Run("_sf_prev", "max", F.struct(F.col(order).alias("o"), F.col(value).alias("v")),
               inclusive=False)
    s = scan(df, [key], [order], [prev], segments)
    return (s.where(F.col("_sf_prev").isNotNull()
                    & (F.abs(F.col(value) - F.col("_sf_prev.v")) >= F.lit(threshold)))
            .select(key, order, F.col("_sf_prev.v").alias(f"prev_{value}"), value))


def rise_alert(df: DataFrame, key: str, order: str, time: str, value: str,
               interval_seconds: int, segments=None) -> DataFrame:
    """Continuous-rise alert (F-5).

    Per key in ``order``: a row *rises* if its value is strictly above the
    previous row's (the first row compares with Double.MIN_VALUE). A rising
    row without a pending timer sets one at ``its time + interval``. The next
    non-rising row is the run's *break*; the timer fires unless the break's
    event time is at or before it. After an alert, the next rising row of the
    run that is later than the alert sets a new timer. Output: ``(key, order
    of the row that set the timer, its time, alert time)``.

    A run of rising rows is folded in one place; keys are not.
    """
    et = event_time(df, time)
    base = df.select(F.col(key), F.col(order), et.alias("_sf_t"), F.col(value))
    if segments is None:  # one quantile pass over the input, shared by both scans
        segments = quantile_bounds(base, order)
    p1 = scan(base, [key], [order], [Run("_sf_prev", "max", F.struct(
        F.col(order).alias("o"), F.col(value).alias("v")), inclusive=False)], segments)
    p1 = p1.withColumn("_sf_rise", F.col(value) > F.coalesce(F.col("_sf_prev.v"),
                                                             F.lit(JAVA_DOUBLE_MIN_VALUE)))
    p1 = p1.withColumn("_sf_rise", F.coalesce("_sf_rise", F.lit(False)))
    here = F.struct(F.col(order).alias("o"), F.col("_sf_t").alias("t"))
    runs = [
        Run("_sf_run", "max", F.when(~F.col("_sf_rise"), here), inclusive=False),
        Run("_sf_brk", "min", F.when(~F.col("_sf_rise"), here), reverse=True, inclusive=False),
    ]
    p2 = scan(p1.drop("_sf_prev"), [key], [order], runs, segments).where("_sf_rise")
    # the rows between two non-rising ones are a run, named by the first of these
    rows = p2.groupBy(key, F.col("_sf_run.o").alias("_sf_run")).agg(
        F.first("_sf_brk.t").alias("_sf_brk"), F.sort_array(F.collect_list(here)).alias("_sf_rows"))
    wait = F.make_dt_interval(secs=F.lit(interval_seconds))
    kind = rows.schema["_sf_rows"].dataType.simpleString()
    starts = F.aggregate("_sf_rows", F.array().cast(kind), lambda done, r: F.when(
        (F.size(done) == 0) | (r["t"] > F.element_at(done, -1)["t"] + wait), F.concat(done, F.array(r))).otherwise(done))
    # a row that sets the next timer is later than this one's deadline; only the last timer depends on the break
    fired = (rows.withColumn("_sf_starts", starts).select(key, "_sf_brk", F.size("_sf_starts").alias("_sf_n"), F.posexplode("_sf_starts").alias("i", "s"))
             .where((F.col("i") < F.col("_sf_n") - 1) | F.col("_sf_brk").isNull() | (F.col("_sf_brk") > F.col("s.t") + wait)))
    return fired.select(key, F.col("s.o").alias(order), as_ntz(F.col("s.t")).alias("start_ts"),
                        as_ntz(F.col("s.t") + wait).alias("alert_ts"))

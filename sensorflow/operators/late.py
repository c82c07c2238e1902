"""Late-data split for event-time windows with allowed lateness (W-5), batch form.

With ``wm`` = max event time of the rows that arrived *before* this one,
minus the out-of-orderness delay, a row is

* ``late``    if ``window_end - 1 ms + lateness <= wm`` (side output),
* ``refire``  if ``window_end - 1 ms <= wm`` (updates a fired window),
* ``on_time`` otherwise.

The running max over arrival order is global (no key), so it is a segmented
scan with ``keys=[]``: segment maxima are prefix-combined over a table with
one row per segment, never a single-partition window over all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.plans.scan import Run, scan
from sensorflow.schema import as_ntz, event_time, tumble_end


def late_split(df: DataFrame, arrival: list[str], time: str, size: str,
               delay_seconds: int, lateness_seconds: int, segments=None) -> DataFrame:
    et = event_time(df, time)
    base = df.withColumn("_sf_et", et)
    s = scan(base, [], arrival, [Run("_sf_max", "max", F.col("_sf_et"), inclusive=False)], segments)
    wm = F.col("_sf_max") - F.make_dt_interval(secs=F.lit(delay_seconds))
    end = tumble_end(F.col("_sf_et"), size)
    fire_at = end - F.expr("INTERVAL 1 MILLISECOND")
    closed_at = fire_at + F.make_dt_interval(secs=F.lit(lateness_seconds))
    status = (F.when(wm.isNull(), F.lit("on_time"))
              .when(closed_at <= wm, F.lit("late"))
              .when(fire_at <= wm, F.lit("refire"))
              .otherwise(F.lit("on_time")))
    return s.select(*[c for c in df.columns],
                    as_ntz(end).alias("window_end"),
                    as_ntz(wm).alias("watermark"), status.alias("status"))


def split_late(df_with_status: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(main output rows, late side output rows)."""
    return (df_with_status.where(F.col("status") != "late"),
            df_with_status.where(F.col("status") == "late"))

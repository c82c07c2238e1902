"""Row-level operators: projections, filters, routing, unions, partitioning.

PRJ-2/3/5/8/9, RT-1/2/3, U-1, PT-1…5. All are narrow (no shuffle) except
the explicit repartitioning helpers.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.functions.text import java_split, utf16_length

# The reference's split tags, threshold and messages.
HIGH_TAG = "high"
LOW_TAG = "low"
HIGH_THRESHOLD = 30.0
HIGH_MESSAGE = "high temp warning"
NORMAL_MESSAGE = "normal"


def line_length(df: DataFrame, col: str = "value", name: str = "len") -> DataFrame:
    """``map(line -> line.length())``: UTF-16 length of each line (PRJ-2)."""
    return df.withColumn(name, utf16_length(col))


def split_fields(df: DataFrame, col: str = "value", sep: str = ",", keep: list[str] | None = None,
                 pos: str = "pos", name: str = "field") -> DataFrame:
    """``flatMap(line -> line.split(sep))``: one row per field with its index (PRJ-3/4)."""
    keep = keep or []
    return df.select(*keep, F.posexplode(java_split(col, sep)).alias(pos, name))


def filter_prefix(df: DataFrame, col: str, prefix: str) -> DataFrame:
    """``filter(s -> s.startsWith(prefix))`` (PRJ-5); pushed to Parquet as StringStartsWith."""
    return df.where(F.col(col).startswith(prefix))


def tag_high_low(df: DataFrame, value: str, threshold: float = HIGH_THRESHOLD,
                 name: str = "tag") -> DataFrame:
    """``split(OutputSelector)``: tag ``high`` when ``value > threshold`` (strict), else ``low`` (RT-1)."""
    return df.withColumn(name, F.when(F.col(value) > F.lit(threshold), F.lit(HIGH_TAG))
                         .otherwise(F.lit(LOW_TAG)))


def select_tags(tagged: DataFrame, *tags: str, name: str = "tag") -> DataFrame:
    """``select("high", "low")``: rows carrying any of the tags, each once."""
    return tagged.where(F.col(name).isin(*tags))


def side_output(df: DataFrame, value: str, threshold: float = HIGH_THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Process function with a side output (RT-2): ``(main > threshold, side: the rest)``.

    Both outputs share one lazily evaluated source; write them from one
    ``foreachBatch`` (see :mod:`sensorflow.sinks`) to read the input once.
    """
    hot = F.col(value) > F.lit(threshold)
    return df.where(hot), df.where(~hot | F.col(value).isNull())


def connect_status(df: DataFrame, key: str, value: str, threshold: float = HIGH_THRESHOLD,
                   keep: list[str] | None = None) -> DataFrame:
    """connect + CoMap of two stream types (RT-3): high rows become
    ``(key, value, "high temp warning")``, low rows ``(key, "normal")`` with a
    null value column; both sides come from one read of the input."""
    keep = keep or []
    hot = F.coalesce(F.col(value) > F.lit(threshold), F.lit(False))
    return df.select(*keep, key, F.when(hot, F.col(value)).alias(value),
                     F.when(hot, F.lit(HIGH_MESSAGE)).otherwise(F.lit(NORMAL_MESSAGE)).alias("status"))


def union_all(*frames: DataFrame) -> DataFrame:
    """n-ary bag union (UNION ALL) by column name (U-1)."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def shuffle_rows(df: DataFrame, n: int | None = None) -> DataFrame:
    """``shuffle()`` (PT-1): uniform redistribution, equal rows included.

    Spark deals rows round-robin from a task-dependent start after sorting
    them by hash, so a retried task sends every row to the same place (safe
    on executor loss).
    """
    return df.repartition(n or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def key_by(df: DataFrame, *keys: str, n: int | None = None) -> DataFrame:
    """``keyBy(field)`` (PT-2): hash partitioning on the key columns."""
    return df.repartition(n, *keys) if n else df.repartition(*keys)


def rebalance(df: DataFrame, n: int) -> DataFrame:
    """``rebalance()`` (PT-3): round-robin into ``n`` partitions (Spark sorts
    before a round-robin repartition, so retries are deterministic)."""
    return df.repartition(n)


def global_partition(df: DataFrame) -> DataFrame:
    """``global()`` (PT-4): everything to one partition. Provided for parity;
    no operator of this package depends on it (it does not scale)."""
    return df.coalesce(1)


def tag_partition(df: DataFrame, setup=None, teardown=None, name: str = "subtask") -> DataFrame:
    """Rich map with ``open``/``close`` and the subtask index (PRJ-9).

    ``setup()`` runs once per partition before the first batch, ``teardown``
    in ``finally``; every row is tagged with the partition id. The tag is
    nondeterministic by nature (it depends on the physical layout).
    """
    if setup is None and teardown is None:
        return df.withColumn(name, F.spark_partition_id())
    from pyspark import TaskContext

    schema = df.schema.simpleString()[len("struct<"):-1]

    def run(batches):
        ctx = setup() if setup else None
        try:
            pid = TaskContext.get().partitionId()
            for pdf in batches:
                yield pdf.assign(**{name: pid})
        finally:
            if teardown:
                teardown(ctx)

    return df.mapInPandas(run, f"{schema}, {name} int")

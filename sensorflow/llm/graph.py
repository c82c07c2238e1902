"""Connected components of a large edge list, by alternating large-star and small-star steps.

Each step is two aggregations and joins on the node; tables between rounds are
written to the shared scratch folder, so the lineage stays short and a lost
executor costs one round at most. A round's table goes when the next one is
written. Before the first round every task joins what its own edges connect, so
few rounds are left. Null nodes are ignored; loops vanish.
"""

from __future__ import annotations

from collections.abc import Iterator
from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.session import TIDY, scratch_path, tidy  # noqa: F401

#: Edges that a task joins at once, about.
EDGES = 1 << 19
#: The folder of each table of the scratch folder.
_FOLDERS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def saved(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with tidy(spark):
        df.write.parquet(path)
    out = spark.read.parquet(path)
    _FOLDERS[out] = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Removes tables that :func:`saved` or :func:`components` returned, when all that reads them is written."""
    for table in tables:
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(_FOLDERS.pop(table))
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def _stars(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (a, b) -> for some of them after the others an edge from every node to the smallest that they connect it with."""
    def out(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        ends = np.stack([np.concatenate([b.column(k).to_numpy() for b in held]) for k in (0, 1)])
        nodes, at = np.unique(ends, return_inverse=True)
        a, b = at.reshape(2, -1)
        root, before = np.arange(len(nodes)), None
        while before is None or (root != before).any():
            before = root.copy()
            low = np.minimum(root[a], root[b])
            np.minimum.at(root, before[a], low)
            np.minimum.at(root, before[b], low)
            root = root[root]
        far = np.flatnonzero(root != np.arange(len(root)))
        return pa.RecordBatch.from_arrays([pa.array(nodes[far]), pa.array(nodes[root[far]])], names=["a", "b"])

    held, n = [], 0
    for batch in it:
        held.append(batch)
        n += batch.num_rows
        if n >= EDGES:
            yield out(held)
            held, n = [], 0
    if n:
        yield out(held)


def _mark(df: DataFrame) -> tuple:
    r = df.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node``, ``root`` (the smallest node of its component) of every node that has an edge."""
    e = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
    for _ in range(2):
        e = e.where(F.col("a") != F.col("b")).distinct().mapInArrow(_stars, e.schema)
    e = saved(e.distinct(), "edges")
    mark = _mark(e)
    while mark[0]:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = (both.where(F.col("b") > F.col("a")).join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where(F.col("a") != F.col("b")).distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where(F.col("a") != F.col("b"))
        e, old = saved(small.unionByName(least.withColumnRenamed("m", "b")).distinct(), "edges"), e
        dropped(old)
        mark, before = _mark(e), mark
        if mark == before:
            break
    out = e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
    _FOLDERS[out] = _FOLDERS[e]
    return out

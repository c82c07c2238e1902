"""Keyed tables that a stream keeps up to date: SNK-3 (upserts) and the reader of a retract stream (SNK-7).

A table is cut into hash buckets of its key. A batch reads and rewrites only
the buckets it touches: the merged rows of a touched bucket go to a new
folder ``_v=<batch>/_bucket=<b>``, then a small manifest that names the current
folder of every bucket is written, which makes the batch visible at once. So
the cost of a batch depends on the buckets it touches, not on the batches
before it. A batch that is run again starts from the same earlier manifest
and rewrites its own folders. Folders that the last two manifests don't name
are removed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorflow.sinks.writers import path_exists

BUCKET = "_bucket"
_MANIFEST = "bucket int, version bigint"


def _names(spark: SparkSession, path: str, lead: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    return [n for n in (st.getPath().getName() for st in fs.listStatus(p)) if n.startswith(lead)]


def _remove(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


class BucketedTable:
    """Rows of ``schema`` by ``keys``, at ``path``, in ``buckets`` buckets (fixed when the table is made)."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str], buckets: int = 32):
        self.spark, self.path, self.schema, self.keys, self.buckets = spark, path.rstrip("/"), schema, keys, buckets

    def _versions(self) -> list[int]:
        """Batches with a whole manifest."""
        names = _names(self.spark, f"{self.path}/_manifest", "v=")
        return sorted(int(n[2:]) for n in names if path_exists(self.spark, f"{self.path}/_manifest/{n}/_SUCCESS"))

    def _manifest(self, version: int) -> dict[int, int]:
        """Current folder of each bucket: at most ``buckets`` rows."""
        return {r["bucket"]: r["version"] for r in self.spark.read.schema(_MANIFEST).parquet(f"{self.path}/_manifest/v={version}").collect()}

    def _folders(self, manifest: dict[int, int]) -> list[str]:
        return [f"{self.path}/_v={v}/{BUCKET}={b}" for b, v in sorted(manifest.items())]

    def _read(self, folders: list[str]) -> DataFrame:
        folders = [f for f in folders if path_exists(self.spark, f)]  # a bucket whose rows all went has none
        return self.spark.read.schema(self.schema).parquet(*folders) if folders else self.spark.createDataFrame([], self.schema)

    def read(self) -> DataFrame:
        """The table as of the last whole batch."""
        done = self._versions()
        return self._read(self._folders(self._manifest(done[-1]))) if done else self.spark.createDataFrame([], self.schema)

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def merge(self, batch: DataFrame, batch_id: int, merged: Callable[[DataFrame], DataFrame]) -> None:
        """Apply a micro-batch: ``merged`` makes the new rows of the touched buckets from their rows and the batch's,
        which come together with ``_new`` telling them apart."""
        done = [v for v in self._versions() if v < batch_id]
        now = self._manifest(done[-1]) if done else {}
        rows = batch.select(*self.schema.names).persist()
        try:
            touched = sorted(r[0] for r in rows.select(self.bucket().alias("b")).distinct().collect())  # at most ``buckets``
            held = self._read(self._folders({b: now[b] for b in touched if b in now}))
            both = held.withColumn("_new", F.lit(False)).unionByName(rows.withColumn("_new", F.lit(True)))
            new = merged(both).select(*self.schema.names).withColumn(BUCKET, self.bucket())
            new.repartition(max(1, len(touched)), BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.path}/_v={batch_id}")
            now |= {b: batch_id for b in touched}
            self.spark.createDataFrame(sorted(now.items()), _MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/_manifest/v={batch_id}")
        finally:
            rows.unpersist()
        self._clean(done[-1:] + [batch_id])

    def _clean(self, keep: list[int]) -> None:
        used = {v for m in keep for v in self._manifest(m).values()} | set(keep)
        for v in (int(n[3:]) for n in _names(self.spark, self.path, "_v=")):
            if v not in used and v < keep[-1]:
                _remove(self.spark, f"{self.path}/_v={v}")
        for v in self._versions():
            if v < keep[0]:
                _remove(self.spark, f"{self.path}/_manifest/v={v}")


def upsert_writer(table: BucketedTable, order: str) -> Callable:
    """``foreachBatch`` function: the row with the largest ``order`` of each key stays (SNK-3). Rows with a null order
    come before all others; among equal orders the batch's row wins."""
    rest = [c for c in table.schema.names if c not in table.keys]

    def newest(both: DataFrame) -> DataFrame:
        last = F.max_by(F.struct(*rest), F.struct(F.col(order).isNotNull(), F.col(order), F.col("_new")))
        return both.groupBy(*table.keys).agg(last.alias("_last")).select(*table.keys, *[F.col(f"_last.{c}").alias(c) for c in rest])

    return lambda batch, batch_id: table.merge(batch, batch_id, newest)


def net_rows(changes: DataFrame, cols: list[str], insert: str, weight: str = "_n") -> DataFrame:
    """A changelog's rows with how often each is there in the end: an insert counts 1, a retraction -1.

    A sum per distinct row, combined before the shuffle: the order of the changes does not matter, and a retraction may
    even arrive before the insert it takes back.
    """
    sign = F.when(F.col(insert), 1).otherwise(-1)
    return changes.groupBy(*cols).agg(F.sum(sign).cast("bigint").alias(weight)).where(F.col(weight) != 0)


def apply_changelog(changes: DataFrame, cols: list[str], insert: str = "is_insert") -> DataFrame:
    """The table that a retract stream describes (SNK-7): every row as often as its inserts exceed its retractions.

    A row that is retracted more often than inserted fails the job, as the changes are then not those of a table.
    """
    net = net_rows(changes, cols, insert)
    fail = F.raise_error(F.concat(F.lit("retracted but never inserted: "), F.to_json(F.struct(*cols)))).cast("bigint")
    times = F.when(F.col("_n") > 0, F.col("_n")).otherwise(fail)
    return net.select(*cols, F.explode(F.sequence(F.lit(1).cast("bigint"), times)).alias("_i")).drop("_i")


def changelog_writer(table: BucketedTable, insert: str = "is_insert", weight: str = "n") -> Callable:
    """``foreachBatch`` function that keeps a table up to date with a retract stream. The table's schema is the rows'
    columns and ``weight``, how often a row is there (below zero while its insert has not arrived)."""
    cols = [c for c in table.schema.names if c != weight]

    def add(both: DataFrame) -> DataFrame:
        return both.groupBy(*cols).agg(F.sum(weight).cast("bigint").alias(weight)).where(F.col(weight) != 0)

    return lambda batch, batch_id: table.merge(net_rows(batch, cols, insert, weight), batch_id, add)

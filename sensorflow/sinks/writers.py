"""Sinks (SNK-1 … SNK-7) and the idempotent ``foreachBatch`` table writer.

Streaming results land in Parquet folders under the shared checkpoint root,
one sub-folder per micro-batch (``_batch=<id>``), written in overwrite mode:
a replayed batch after a failure rewrites the same folder, so output is
exactly-once without any driver-side collection.
"""

from __future__ import annotations

import itertools
import time
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorflow.session import prepare

BATCH = "_batch"
_IDLE = "spark.sql.streaming.noDataMicroBatches.enabled"


def print_sink(df: DataFrame, label: str | None = None, output_mode: str = "append"):
    """``print(prefix)`` (SNK-1): console sink, the label as a leading column."""
    out = df.select(F.lit(label).alias("label"), "*") if label else df
    return out.writeStream.format("console").option("truncate", "false").outputMode(output_mode)


def write_csv_append(df: DataFrame, path: str, checkpoint: str):
    """CSV file sink table + ``insertInto`` (SNK-4). Append-only, as in the reference."""
    return (df.writeStream.format("csv").option("header", "false").option("path", path)
            .option("checkpointLocation", checkpoint).outputMode("append"))


def encode_kafka_csv(df: DataFrame, cols: list[str]) -> DataFrame:
    """Kafka CSV sink table (SNK-2/5): a ``value`` column holding ``to_csv(struct(cols))``."""
    return df.select(F.to_csv(F.struct(*[F.col(c) for c in cols])).alias("value"))


def kafka_sink(df: DataFrame, servers: str, topic: str, checkpoint: str):
    """``FlinkKafkaProducer(brokers, topic, SimpleStringSchema)``; needs the
    spark-sql-kafka connector on the classpath."""
    return (df.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("topic", topic).option("checkpointLocation", checkpoint))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in whatever file system it names."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def file_count(spark: SparkSession, path: str) -> int:
    """Data files right under a path."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    names = [st.getPath().getName() for st in p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)]
    return sum(not n.startswith(("_", ".")) for n in names)


def _write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")


def run_to_end(query, timeout_s: float | None = None) -> None:
    """Wait until a query has processed all of its input. A query that fails
    raises; one that is not done after ``timeout_s`` is stopped and raises
    too, so a part of a result is never taken for the whole."""
    try:
        done = query.awaitTermination() if timeout_s is None else query.awaitTermination(timeout_s)
    finally:
        if query.isActive:
            query.stop()
    if query.exception() is not None:
        raise query.exception()
    if timeout_s is not None and not done:
        raise TimeoutError(f"the stream did not reach the end of its input in {timeout_s} s")


def run_until(query, done: Callable[[], bool], timeout_s: float, every_s: float = 0.5) -> None:
    """Let a query without an end run until ``done()``, then stop it. A query that fails raises, and so does one that is
    not done after ``timeout_s``."""
    end = time.monotonic() + timeout_s
    try:
        while not done():
            if query.exception() is not None:
                raise query.exception()
            if time.monotonic() > end:
                raise TimeoutError(f"the stream did not meet its stop condition in {timeout_s} s")
            time.sleep(every_s)
    finally:
        query.stop()


def stream_to_table(spark: SparkSession, stream: DataFrame, path: str, checkpoint: str,
                    output_mode: str = "append", keys: list[str] | None = None,
                    timeout_s: float | None = None, idle_batches: bool = True) -> DataFrame:
    """Run ``stream`` to the end of its input (``availableNow``) through an
    idempotent ``foreachBatch`` and return the result as a batch DataFrame.
    A stream in processing-time mode (timers, cells with a time to live) always
    asks for one more batch without data; ``idle_batches=False`` ends it.

    ``append``: every emitted row. ``update``: the last emitted row per
    ``keys`` (max by batch id; a partial aggregate, so no key is gathered
    whole), i.e. the final state of an update-mode query.
    """
    prepare(spark)

    def sink(batch: DataFrame, batch_id: int) -> None:
        _write_batch(batch, path, batch_id)

    before = spark.conf.get(_IDLE)
    spark.conf.set(_IDLE, str(idle_batches).lower())  # a query keeps the settings it starts with
    try:
        q = (stream.writeStream.foreachBatch(sink).outputMode(output_mode)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    finally:
        spark.conf.set(_IDLE, before)
    run_to_end(q, timeout_s)
    return read_batches(spark, path, stream.columns, output_mode, keys, stream.schema)


def read_batches(spark: SparkSession, path: str, columns: list[str], output_mode: str = "append",
                 keys: list[str] | None = None, schema=None) -> DataFrame:
    """``schema``: that of the rows, for a stream that may have had no batch at all."""
    if schema is not None and not path_exists(spark, path):
        return spark.createDataFrame([], schema).select(*columns)
    out = spark.read.parquet(path)
    if output_mode == "append" or not keys:
        return out.select(*columns)
    rest = [c for c in columns if c not in keys]
    last = out.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(BATCH)).alias("_sf_last"))
    return last.select(*keys, *[F.col(f"_sf_last.{c}").alias(c) for c in rest])


def latest_in_batch(df: DataFrame, key: str, order: str, cols: list[str]) -> DataFrame:
    """Last row per key inside one batch (deduplicate before an upsert, else
    two tasks may race on one key)."""
    rest = [c for c in cols if c != key]
    g = df.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_sf_last"))
    return g.select(key, *[F.col(f"_sf_last.{c}").alias(c) for c in rest])


def upsert_latest(target: str, key: str, order: str, cols: list[str]) -> Callable:
    """Keyed upsert (SNK-3) into a Parquet table folder, as a ``foreachBatch`` function.

    Each batch writes its latest row per key to ``_batch=<id>`` (overwrite:
    a replay is harmless). The table's current state is
    :func:`upsert_state`: the newest row per key across batches.
    """
    def fn(batch: DataFrame, batch_id: int) -> None:
        _write_batch(latest_in_batch(batch, key, order, cols), target, batch_id)
    return fn


def upsert_state(spark: SparkSession, target: str, key: str, cols: list[str]) -> DataFrame:
    return read_batches(spark, target, cols, "update", [key])


def upsert_dbapi(df: DataFrame, connect: Callable, table: str, key: str, cols: list[str],
                 order: str | None = None, rows_per_call: int = 500) -> None:
    """Keyed upsert into a DB-API database (SNK-3 with a real connection).

    Rows are first reduced to one per key (the latest by ``order``, else the
    largest), so no two tasks touch the same key. A task then goes by
    ``rows_per_call`` rows: one query for which of their keys exist, one batched
    ``UPDATE`` for those, one batched ``INSERT`` for the others. The connection
    is opened once per partition and closed in ``finally``. ``connect`` must be
    picklable and build its own connection on the executor; credentials come
    from the caller. Rows with a null key are an error, as a key cannot match them.
    """
    if order:
        rows = latest_in_batch(df, key, order, [key, *cols])
    else:
        g = df.groupBy(key).agg(F.max(F.struct(*cols)).alias("_sf_last"))
        rows = g.select(key, *[F.col(f"_sf_last.{c}").alias(c) for c in cols])
    upd = f"UPDATE {table} SET {', '.join(f'{c} = ?' for c in cols)} WHERE {key} = ?"
    ins = f"INSERT INTO {table} ({', '.join(cols)}, {key}) VALUES ({', '.join('?' * (len(cols) + 1))})"

    def run(it):
        conn = connect()
        try:
            cur = conn.cursor()
            while part := [tuple(r) for r in itertools.islice(it, rows_per_call)]:
                if any(r[-1] is None for r in part):
                    raise ValueError(f"null {key} in an upsert into {table}")
                cur.execute(f"SELECT {key} FROM {table} WHERE {key} IN ({', '.join('?' * len(part))})", [r[-1] for r in part])
                there = {r[0] for r in cur.fetchall()}
                for sql, own in ((upd, [r for r in part if r[-1] in there]), (ins, [r for r in part if r[-1] not in there])):
                    if own:
                        cur.executemany(sql, own)
            conn.commit()
        finally:
            conn.close()

    rows.select(*cols, key).foreachPartition(run)


def two_way_writer(main_path: str, side_path: str, is_side: Column) -> Callable:
    """``foreachBatch`` that writes a main and a side output (RT-2, W-5) from
    one read of the batch (persisted for the two writes). A row whose
    predicate is null belongs to the main output."""
    side = F.coalesce(is_side, F.lit(False))

    def fn(batch: DataFrame, batch_id: int) -> None:
        b = batch.persist()
        try:
            _write_batch(b.where(~side), main_path, batch_id)
            _write_batch(b.where(side), side_path, batch_id)
        finally:
            b.unpersist()
    return fn

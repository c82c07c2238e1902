"""Session helpers: a configured SparkSession and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Whether Spark (from 4.1 on) removes a query's shuffle files as soon as the query ends.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def get_spark(master: str | None = None, app: str = "sensorflow",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings every operator assumes.

    UTC session time (windows are epoch aligned), AQE on (coalescing and
    skew-join splitting at run time), Arrow for pandas exchange, and the
    RocksDB state store that ``transformWithStateInPandas`` needs.
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    b = (SparkSession.builder.master(master or f"local[{cpus}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
         .config("spark.sensorflow.inputSpread", cpus)  # the local tables are single files
         .config("spark.driver.memory", "16g"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the session settings our results depend on (safe to call repeatedly)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != ROCKSDB_PROVIDER:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a shared
    file system); a cluster session without it is an error. A local session
    that leaves it unset, as in tests, gets a private folder.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None) \
        or sc.getConf().get("spark.checkpoint.dir", None)
    if not root and not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not root:
        root = tempfile.mkdtemp(prefix="sensorflow-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query that is run in here, or of the micro-batches of a stream that is started in here, go at its
    end, not when the driver collects its garbage."""
    before = spark.conf.get(TIDY, None)
    spark.conf.set(TIDY, "true")
    try:
        yield
    finally:
        spark.conf.unset(TIDY) if before is None else spark.conf.set(TIDY, before)

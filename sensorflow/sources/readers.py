"""Sources (SRC-1 … SRC-10) and the line → reading parser (PRJ-1).

Schemas are always explicit (no inference), as in the reference.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorflow.functions.text import java_split
from sensorflow.schema import READING_SCHEMA


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``readTextFile(path)``: one row per line in column ``value`` (SRC-1)."""
    return spark.read.text(path)


def read_lines_stream(spark: SparkSession, directory: str, glob: str | None = None,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming text scan of a *directory* (SRC-2/3). Run it with
    ``trigger(availableNow=True)`` for the reference's one-pass file read."""
    r = spark.readStream.format("text")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(directory)


def socket_stream(spark: SparkSession, host: str, port: int) -> DataFrame:
    """``socketTextStream(host, port)`` (SRC-3): live lines in ``value``. Every
    operator here takes any line DataFrame, so tests replay files instead."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def with_processing_time(df: DataFrame, name: str = "proc_time") -> DataFrame:
    """Processing-time attribute (T-1, ``proctime``): the time a row is seen."""
    return df.withColumn(name, F.current_timestamp())


def read_table_stream(spark: SparkSession, directory: str, schema: T.StructType,
                      glob: str | None = None, fmt: str = "parquet",
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Replay a table folder as a stream (Parquet by default), schema given."""
    r = spark.readStream.format(fmt).schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(directory)


def table_stream(spark: SparkSession, directory: str, name: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Replay table ``name`` of a folder, stored as one file or as a folder of part files."""
    path = f"{directory.rstrip('/')}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.getFileStatus(p).isDirectory():
        return read_table_stream(spark, path, schema, max_files_per_trigger=max_files_per_trigger)
    return read_table_stream(spark, directory, schema, glob=f"{name}.parquet", max_files_per_trigger=max_files_per_trigger)


def from_collection(spark: SparkSession, rows, schema: T.StructType = READING_SCHEMA) -> DataFrame:
    """``fromCollection`` / ``fromElements`` (SRC-4/5)."""
    return spark.createDataFrame(rows, schema)


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType = READING_SCHEMA,
                   mode: str = "FAILFAST", view: str | None = None) -> DataFrame:
    """Headerless CSV file as a typed table, optionally registered as a view (SRC-7)."""
    df = spark.read.schema(schema).option("header", "false").option("mode", mode).csv(path)
    if view:
        df.createOrReplaceTempView(view)
    return df


def register_view(df: DataFrame, name: str) -> DataFrame:
    """``createTemporaryView`` (SRC-10)."""
    df.createOrReplaceTempView(name)
    return df


def to_table(df: DataFrame, mapping: dict[str, str], rowtime: tuple[str, str] | None = None) -> DataFrame:
    """A stream or batch as a table (SRC-9): the columns of ``mapping`` under their new names;
    ``rowtime=(name, epoch_seconds_col)`` appends an event-time TIMESTAMP column."""
    cols = [F.col(src).alias(dst) for src, dst in mapping.items()]
    if rowtime:
        cols.append(F.timestamp_seconds(F.col(rowtime[1])).alias(rowtime[0]))
    return df.select(*cols)


def parse_readings(lines: DataFrame, col: str = "value", sep: str = ",", keep: list[str] | None = None,
                   mode: str = "FAILFAST") -> DataFrame:
    """``map(line -> new SensorReading(f[0], new Long(f[1]), new Double(f[2])))`` (PRJ-1).

    Extra fields are ignored. A line with fewer than three fields or a
    non-numeric timestamp/temperature fails the job (``FAILFAST``, the
    reference behaviour, independent of the ANSI setting) or is dropped
    (``DROPMALFORMED``).
    """
    keep = keep or []
    parts = java_split(col, sep)
    f0 = F.element_at(parts, 1)
    f1, f2 = F.try_element_at(parts, F.lit(2)), F.try_element_at(parts, F.lit(3))
    ts, temp = F.expr("try_cast(_sf_f1 as bigint)"), F.expr("try_cast(_sf_f2 as double)")
    staged = lines.select(*keep, F.col(col).alias("_sf_line"), parts.alias("_sf_parts"),
                          f1.alias("_sf_f1"), f2.alias("_sf_f2"))
    whole = F.col("_sf_f1").rlike("^[+-]?[0-9]+$")  # a cast would trim spaces
    bad = ts.isNull() | temp.isNull() | ~F.coalesce(whole, F.lit(False))
    if mode.upper() == "DROPMALFORMED":
        return staged.where(~bad).select(*keep, F.element_at("_sf_parts", 1).alias("id"),
                                         ts.alias("timestamp"), temp.alias("temperature"))
    # a filter, so that the check runs whichever columns are selected later
    fail = F.raise_error(F.concat(F.lit("malformed reading: "), F.col("_sf_line"))).cast("boolean")
    return staged.where(F.when(bad, fail).otherwise(F.lit(True))).select(
        *keep, F.element_at("_sf_parts", 1).alias("id"), ts.alias("timestamp"), temp.alias("temperature"))


def csv_lines(df: DataFrame, cols: list[Column | str], name: str = "value") -> DataFrame:
    """Render rows as comma-joined text lines (the reference's wire format)."""
    return df.select(F.concat_ws(",", *[F.col(c).cast("string") if isinstance(c, str) else c.cast("string")
                                        for c in cols]).alias(name))


def decode_kafka_value(df: DataFrame, name: str = "value") -> DataFrame:
    """``SimpleStringSchema``: Kafka's binary ``value`` → string lines (SRC-6)."""
    return df.select(F.col("value").cast("string").alias(name))


def parse_csv_value(df: DataFrame, schema: T.StructType = READING_SCHEMA, col: str = "value") -> DataFrame:
    """Kafka CSV table (SRC-8): ``from_csv(value, schema)`` expanded to columns."""
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return df.select(F.from_csv(F.col(col), ddl, {"mode": "FAILFAST"}).alias("_sf_r")).select("_sf_r.*")


def kafka_stream(spark: SparkSession, servers: str, topic: str, group_id: str | None = None,
                 starting_offsets: str = "latest") -> DataFrame:
    """``FlinkKafkaConsumer(topic, SimpleStringSchema, props)``: topic → string ``value`` lines.

    Needs the spark-sql-kafka connector on the classpath (not bundled)."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", starting_offsets))
    if group_id:
        r = r.option("kafka.group.id", group_id)
    return decode_kafka_value(r.load())

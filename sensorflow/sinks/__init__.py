"""Sinks: console/label, CSV append, Kafka value encoding, keyed upsert, two-way writers."""

from sensorflow.sinks.writers import (  # noqa: F401
    encode_kafka_csv, kafka_sink, print_sink, stream_to_table, upsert_dbapi, upsert_latest,
    write_csv_append,
)

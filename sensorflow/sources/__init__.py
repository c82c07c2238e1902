"""Sources: text lines, CSV tables, collections, Kafka values, stream replay, reading parser."""

from sensorflow.sources.readers import (  # noqa: F401
    csv_lines, decode_kafka_value, from_collection, kafka_stream, parse_csv_value,
    parse_readings, read_csv_table, read_lines, read_lines_stream, read_table_stream,
    register_view, socket_stream, to_table, with_processing_time,
)

"""sensorflow: keyed event-stream and table analytics as Spark DataFrame plans.

Every operator takes and returns Spark DataFrames and works on named key,
time, value and order columns, so the same code runs on the 17-row sensor
fixture (id, timestamp, temperature, seq) and on the ``events`` table
(user_id, ts, value, event_id).
"""

from sensorflow.schema import EVENTS, FIXTURE, READING_SCHEMA, Cols  # noqa: F401
from sensorflow.session import checkpoint_root, get_spark  # noqa: F401

__all__ = ["Cols", "EVENTS", "FIXTURE", "READING_SCHEMA", "checkpoint_root", "get_spark"]

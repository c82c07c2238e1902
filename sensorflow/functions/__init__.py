"""Scalar, table and aggregate functions (all JVM-side expressions where possible)."""

from sensorflow.functions.text import java_hash, java_split, utf16_length  # noqa: F401
from sensorflow.functions.fold import Fold, avg_fold, count_fold, fold_by  # noqa: F401

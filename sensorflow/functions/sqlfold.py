"""User folds in SQL (UDF-3): an aggregate as two table functions that run on Arrow batches.

``<name>_partial(TABLE(rows))`` folds what each task reads into one accumulator
a group, passing them on when there are many, and ``<name>(TABLE(parts)
PARTITION BY key)`` merges a group's accumulators and gives its result. So a
group's rows never meet in one place and memory is bounded by the number of
groups, as in :func:`sensorflow.functions.fold.fold_by`, whose :class:`Fold`
contract this uses:

    SELECT * FROM avg_temp(TABLE(SELECT * FROM avg_temp_partial(TABLE(SELECT id, temp FROM readings))) PARTITION BY id)
"""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udtf

from sensorflow.functions.fold import MOST_GROUPS, Fold, _acc_cols


def register_fold(spark: SparkSession, name: str, fold: Fold, key: str, key_type: str) -> None:
    """Make ``<name>_partial`` (rows of ``key`` and the fold's inputs) and ``<name>`` SQL functions of the session."""
    acc = _acc_cols(fold)
    out = [key, *T._parse_datatype_string(fold.result).fieldNames()]

    def merged(frames: list[pd.DataFrame]) -> pd.DataFrame:
        return fold.merge(pd.concat(frames, ignore_index=True).groupby([key], sort=False, dropna=False)).reset_index()[[key, *acc]]

    @arrow_udtf(returnType=f"`{key}` {key_type}, {fold.acc}")
    class Partial:
        def __init__(self):
            self.held, self.rows, self.last = [], 0, 0

        def eval(self, rows: pa.RecordBatch):
            frame = rows.to_pandas()
            if len(frame):
                self.held.append(fold.add(frame.groupby([key], sort=False, dropna=False)).reset_index()[[key, *acc]])
                self.rows += len(self.held[-1])
                if self.rows >= max(2 * self.last, 4096):
                    self.held = [merged(self.held)]
                    self.rows = self.last = len(self.held[0])
            if self.last >= MOST_GROUPS:
                yield pa.Table.from_pandas(self.held[0], preserve_index=False)
                self.held, self.rows, self.last = [], 0, 0

        def terminate(self):
            if self.held:
                yield pa.Table.from_pandas(merged(self.held), preserve_index=False)

    @arrow_udtf(returnType=f"`{key}` {key_type}, {fold.result}")
    class Final:
        def __init__(self):
            self.held = None

        def eval(self, parts: pa.RecordBatch):
            frame = parts.to_pandas()
            if len(frame):
                self.held = merged([frame] if self.held is None else [self.held, frame])
            return iter(())

        def terminate(self):
            if self.held is not None:
                got = pd.concat([self.held[[key]], fold.finish(self.held).reset_index(drop=True)], axis=1)
                yield pa.Table.from_pandas(got[out], preserve_index=False)

    spark.udtf.register(f"{name}_partial", Partial)
    spark.udtf.register(name, Final)

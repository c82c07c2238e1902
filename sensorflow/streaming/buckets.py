"""Keyed state in hash buckets of keys.

A call of a stateful operator, and every read or write of its state, costs
milliseconds. With one call a key and micro-batch, a stream of very many keys
spends nearly all its time there. Here keys are dealt to ``BUCKETS`` buckets;
a call gets the rows of all keys of a bucket and works on them as one frame.
State is a frame as well, with a key column, kept as Arrow data
(:class:`Frame`): it is read and written as a whole, or only appended to.

Null keys have a bucket of their own and travel as another value, so that no
key that is a whole number meets a null in pandas. A task holds a bucket's rows of one micro-batch and its state.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessorHandle

from sensorflow.plans.scan import _zero

BUCKET = "sf_bucket"
BUCKETS = 256
#: Key column of state.
KEY = "_k"


#: The bucket of null keys.
NULLS = -1


def by_bucket(df: DataFrame, key: str, buckets: int = BUCKETS) -> GroupedData:
    """``df`` grouped by hash bucket of ``key``; :func:`keyed` gives a bucket's rows."""
    no = F.when(F.col(key).isNull(), F.lit(NULLS)).otherwise(F.pmod(F.xxhash64(key), F.lit(buckets)))
    return df.withColumn(BUCKET, no).withColumn(key, F.coalesce(key, _zero(df.schema[key].dataType))).groupBy(BUCKET)


def keyed(bucket: tuple, frames: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """A bucket's frames with their keys, null ones again null."""
    for pdf in frames:
        yield pdf.assign(**{key: pd.Series([None] * len(pdf), index=pdf.index, dtype=object)}) if bucket[0] == NULLS else pdf


class Frame:
    """A frame as the state of a bucket, in one or more parts."""

    def __init__(self, handle: StatefulProcessorHandle, name: str, cols: list[str]):
        self.parts, self.cols = handle.getListState(name, "part binary"), cols

    def get(self) -> pd.DataFrame:
        got = [pa.ipc.open_stream(part).read_pandas() for (part,) in self.parts.get()] if self.parts.exists() else []
        return pd.concat(got, ignore_index=True) if got else pd.DataFrame(columns=self.cols)

    def _packed(self, frame: pd.DataFrame) -> tuple[bytes]:
        table = pa.Table.from_pandas(frame[self.cols], preserve_index=False)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table)
        return (sink.getvalue().to_pybytes(),)

    def put(self, frame: pd.DataFrame) -> None:
        if len(frame):
            self.parts.put([self._packed(frame)])
        else:
            self.parts.clear()

    def append(self, frame: pd.DataFrame) -> None:
        if len(frame):
            self.parts.appendValue(self._packed(frame))


def coded(held: pd.Series, keys: pd.Series) -> tuple[np.ndarray, np.ndarray, pd.Series]:
    """Numbers 0, 1, … for the keys of the state and of the rows, and the keys by number."""
    both = pd.concat([held, keys], ignore_index=True) if len(held) else keys.reset_index(drop=True)
    codes, distinct = pd.factorize(both, use_na_sentinel=False)
    return codes[: len(held)], codes[len(held):], pd.Series(distinct)


def told(keys: pd.Series) -> pd.Series:
    """Keys for a result: pandas makes numbers of null strings, for one."""
    return keys.astype(object).where(keys.notna(), None) if keys.isna().any() else keys


def in_order(frames: Iterator[pd.DataFrame], held: pd.Series, key: str, order: list[str]):
    """A bucket's rows by key and ``order``: ``(numbers of the held keys, rows, their keys' numbers, keys by number)``."""
    rows = pd.concat(list(frames), ignore_index=True)
    of_held, of_rows, keys = coded(held, rows[key])
    rows = rows.assign(_code=of_rows).sort_values(["_code", *order], kind="mergesort").reset_index(drop=True)
    return of_held, rows, rows.pop("_code").to_numpy(), keys


def place(codes: np.ndarray) -> np.ndarray:
    """Every row's place in its run of equal codes, from 0."""
    at = np.arange(len(codes))
    new = np.ones(len(codes), bool)
    new[1:] = codes[1:] != codes[:-1]
    return at - np.maximum.accumulate(np.where(new, at, 0))


def in_front(of_held: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """State rows in front of their key's rows: the order of both (state rows are numbered first), the codes in that order
    and which are rows."""
    both = np.concatenate([of_held, codes])
    order = np.argsort(both, kind="stable")
    return order, both[order], order >= len(of_held)


def frame_means(tail: pd.DataFrame, of_tail: np.ndarray, values: pd.Series, codes: np.ndarray, keys: pd.Series, size: int):
    """Means over every row and up to ``size`` - 1 before it of its key, nulls left out; how many rows each frame has; and
    the last values of every key (columns ``KEY``, ``v``) for the next batch."""
    order, both, new = in_front(of_tail, codes)
    v = pd.Series(np.concatenate([tail["v"].to_numpy("float64"), values.to_numpy("float64")])[order])
    mean = v.groupby(both).rolling(size, min_periods=1).mean().to_numpy()
    n = np.minimum(place(both) + 1, size)
    keep = place(both[::-1])[::-1] < size - 1
    left = pd.DataFrame({KEY: keys.take(both[keep]).to_numpy(), "v": v.to_numpy()[keep]})
    return mean[new], n[new], left

"""Packing of documents into training sequences by patterns of lengths.

Documents are tokenised, ended with ``end_id`` and, if longer than a sequence,
cut into full pieces after a shorter first one. Only the histogram of piece
lengths, ``capacity`` numbers however large the corpus is, comes to the
driver. There, patterns of two to four lengths that fill a sequence exactly
are enumerated, a non-negative least-squares fit gives each a repeat count,
the counts are rounded down to what the histogram holds, and the residual
lengths are packed by filling the largest remaining one as tightly as three
more can. The plan maps (length, rank among pieces of that length) to
(sequence, offset); ranks come from counts per task and length, so no length
is ever gathered or sorted, however many pieces share it.

Edge cases: a null or empty text is one piece that holds the end id only;
repeated rows, also with null ids, are packed as often as they occur; an empty
table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorflow.llm import textbatch as tb
from sensorflow.llm import tokens
from sensorflow.session import scratch_path

CAPACITY = 1024
SWEEPS = 30


def enumerate_patterns(capacity: int, present: np.ndarray) -> list[tuple[int, ...]]:
    """Exact fills of two, three or four pieces; triples and quadruples on a grid of about ``8 * capacity`` combinations."""
    have = np.zeros(capacity + 1, bool)
    have[present] = True
    out = [(a, capacity - a) for a in range(1, capacity // 2 + 1)]
    for a in range(1, capacity // 3 + 1):
        span = range(a, (capacity - a) // 2 + 1)
        out += [(a, b, capacity - a - b) for b in span[:: max(1, len(span) // 16)]]
    out += [(a, a, b, capacity - 2 * a - b) for a in range(1, capacity // 4 + 1)
            for b in range(a, (capacity - 2 * a) // 2 + 1, max(1, capacity // 8)) if capacity - 2 * a - b > 0]
    return sorted({tuple(sorted(p)) for p in out if all(have[x] for x in p)})


def nnls_counts(patterns: list[tuple[int, ...]], hist: np.ndarray, sweeps: int = SWEEPS) -> np.ndarray:
    """Non-negative least squares of repeat counts against the histogram, by cyclic coordinate descent."""
    cols = [np.unique(p, return_counts=True) for p in patterns]
    x = np.zeros(len(patterns))
    left = hist.astype(float)
    for _ in range(sweeps):
        moved = 0.0
        for j, (at, k) in enumerate(cols):
            step = max(-x[j], float(k @ left[at]) / float(k @ k))
            if step:
                x[j] += step
                left[at] -= step * k
                moved = max(moved, abs(step))
        if moved < 0.25:
            break
    return x


def _largest_up_to(have: np.ndarray) -> np.ndarray:
    """For every r the largest length <= r that is left, or 0."""
    return np.maximum.accumulate(np.where(have, np.arange(len(have)), 0))


def _fill(room: int, left: np.ndarray) -> list[int]:
    """Up to three remaining lengths whose sum is as close to ``room`` as possible, larger ones first."""
    if room <= 0:
        return []
    le = _largest_up_to(left > 0)
    a = np.flatnonzero(left[: room + 1])
    a = a[a > 0]
    if not len(a):
        return []
    b = le[room - a]
    b = np.where((b == a) & (left[a] < 2), le[np.maximum(a - 1, 0)], b)
    b = np.where(a + b > room, 0, b)
    rest = room - a - b
    c = le[rest]
    clash = ((c == a) & (left[a] < 2 + (b == a))) | ((c == b) & (b > 0) & (left[b] < 2 + (a == b)))
    c = np.where(clash, 0, c)
    total = a + b + c
    best = np.flatnonzero(total == total.max())
    i = best[np.argmax(a[best])]
    return [int(v) for v in (a[i], b[i], c[i]) if v]


def plan(hist: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """``hist[l]`` pieces of length l (0..capacity) -> (pattern, repeats); every piece is used exactly once."""
    capacity = len(hist) - 1
    left = hist.astype(np.int64).copy()
    out = [((capacity,), int(left[capacity]))] if left[capacity] else []
    left[capacity] = 0
    patterns = enumerate_patterns(capacity, np.flatnonzero(left))
    x = nnls_counts(patterns, left)
    for j in np.argsort(-x, kind="stable"):
        at, k = np.unique(patterns[j], return_counts=True)
        n = min(int(np.floor(x[j] + 1e-9)), int((left[at] // k).min()))
        if n > 0:
            left[at] -= n * k
            out.append((patterns[j], n))
    while left.any():
        top = int(np.flatnonzero(left)[-1])
        left[top] -= 1
        got = [top]
        while more := _fill(capacity - sum(got), left - np.bincount(got[1:], minlength=capacity + 1)):
            got += more
        left[top] += 1
        at, k = np.unique(got, return_counts=True)
        n = int((left[at] // k).min())
        left[at] -= n * k
        out.append((tuple(got), n))
    return out


def slots(planned: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Rows (length, first rank, sequence of that rank, offset), sorted."""
    rows, used, seq = [], {}, 0
    for pattern, n in planned:
        at = 0
        for length in pattern:
            rows.append((length, used.get(length, 0), seq, at))
            used[length] = used.get(length, 0) + n
            at += length
        seq += n
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def pieces(docs: DataFrame, vocabulary: str, id_col: str, text_col: str, end_id: int, capacity: int, with_ids: bool) -> DataFrame:
    """Pieces of all documents with their task (``_task``) and their rank among the task's pieces of that length (``_rank``)."""
    fields = f"{id_col} long, piece int, start long, length long, ids_crc32 long, _task int, _rank long" + ", ids binary" * with_ids

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, task = np.zeros(capacity + 1, np.int64), TaskContext.get().partitionId()
        for batch in it:
            doc = batch.column(0)
            for a, z, ids, off in tokens.encoded_slices(batch.column(1), vocabulary, end_id):
                size = np.diff(off)
                first = np.where(size % capacity, size % capacity, capacity)
                n = (size - first) // capacity + 1
                row = np.repeat(np.arange(z - a), n)
                no = tb.ranges(np.zeros(z - a, np.int64), n)
                start = np.where(no > 0, first[row] + (no - 1) * capacity, 0)
                length = np.where(no > 0, capacity, first[row])
                begin = off[row] + start
                data = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(data[4 * b: 4 * (b + w)]) for b, w in zip(begin.tolist(), length.tolist())]
                order = np.argsort(length, kind="stable")
                counts = np.bincount(length, minlength=capacity + 1)
                rank = np.empty(len(length), np.int64)
                rank[order] = tb.ranges(seen, counts)
                seen += counts
                out = [doc.slice(a, z - a).cast(pa.int64()).take(pa.array(row)), pa.array(no, pa.int32()), pa.array(start), pa.array(length),
                       pa.array(crc, pa.int64()), pa.array(np.full(len(row), task, np.int32)), pa.array(rank)]
                if with_ids:
                    out.append(pa.array([bytes(data[4 * b: 4 * (b + w)]) for b, w in zip(begin.tolist(), length.tolist())], pa.binary()))
                names = [id_col, "piece", "start", "length", "ids_crc32", "_task", "_rank"] + ["ids"] * with_ids
                yield pa.RecordBatch.from_arrays(out, names=names)

    return docs.select(id_col, text_col).mapInArrow(run, fields)


def pack(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2,
         capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """``<id_col>``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset`` and, if asked for,
    ``ids`` (little-endian unsigned 32-bit) of every piece."""
    spark = docs.sparkSession
    path = scratch_path(spark, "packing")
    pieces(docs, vocabulary, id_col, text_col, end_id, capacity, with_ids).write.parquet(path)
    cut = spark.read.parquet(path)
    per_task = cut.groupBy("_task", "length").agg(F.count("*").alias("_n"))
    hist = np.zeros(capacity + 1, np.int64)
    for r in per_task.groupBy("length").agg(F.sum("_n").alias("n")).collect():  # at most `capacity` rows
        hist[r["length"]] = r["n"]
    table = slots(plan(hist))
    w = Window.partitionBy("length").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    base = per_task.select("_task", "length", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_base"))
    ranked = cut.join(base, ["_task", "length"]).withColumn("_rank", F.col("_rank") + F.col("_base")).drop("_base", "_task")
    cols = [id_col, "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    ranked = ranked.select(*cols, "_rank")
    # a slot is found by one search over (length, first rank) pairs; the table has a few rows per length
    keys = table[:, 0] * (1 << 50) + table[:, 1]

    def place(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            length, rank = b.column(3).to_numpy(), b.column(b.num_columns - 1).to_numpy()
            at = np.searchsorted(keys, length * (1 << 50) + rank, side="right") - 1
            seq = table[at, 2] + rank - table[at, 1]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(seq), pa.array(table[at, 3])], names=[*cols, "sequence_id", "offset"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema.fields[:-1])
    return ranked.mapInArrow(place, f"{fields}, sequence_id long, offset long")

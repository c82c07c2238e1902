"""SimHash near-duplicates by a segment-popcount embedding.

A document's fingerprint has a bit set where over half of its shingles'
hashes have it. Fingerprints that differ in at most ``RADIUS`` bits link.

* Documents with one fingerprint form a class, a node of the link graph, so
  copies cost one row however many there are.
* A fingerprint is embedded as its bit counts per segment of two bits. The
  Manhattan distance of two embeddings is at most the number of differing bits.
  The segments form two halves, and a pair within 4 is within 2 in at least one
  of them. In that half's grid, two points at a distance of 2 or less have a
  point within 1 of both: so every fingerprint goes to its own cell and to all
  cells at distance 1, and similar ones share a cell.
* The fingerprints of a cell are compared exactly, by the differing bits. A
  small cell gives its links; in a larger one a search from link to link
  compares each newly found fingerprint with those not found yet and gives a
  spanning forest, so a cell of near copies gives one link a member.
* Cells that may hold more than ``CELL`` fingerprints (found from counts over
  the embedded points) are cut into blocks, and pairs of blocks go to tasks.

Words are runs of bytes other than 0x20 and 0x09-0x0D, A-Z lower-cased; texts
of fewer than ``WIDTH`` words have their whole sequence as one shingle. A null
or wordless text has fingerprint zero, which links like any other. Repeated
rows give a row each. A row with a null id takes part, and its component is
named by the smallest id in it (null if there is none). An empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorflow.llm import graph
from sensorflow.llm import textbatch as tb
from sensorflow.llm import xxh64

WIDTH = 4
SEED = 42
#: Differing bits of a link. The grid's halves and neighbours are made for this many.
RADIUS = 4
#: Fingerprints a task compares at once: two blocks of about this size.
CELL = 16_384
#: Cells of up to so many fingerprints compare all pairs.
SMALL = 16
SLICE = 4 << 20
U = np.uint64
#: Byte b of entry v is bit b of v.
SPREAD = ((np.arange(256, dtype=U)[:, None] >> np.arange(8, dtype=U)) & U(1)).astype(np.uint8).view("<u8")[:, 0]
#: Cells within Manhattan distance 1 of a point of 16 dimensions.
NEAR = 33


def normal(raw: np.ndarray, off: np.ndarray):
    """Texts with one space after each word: bytes, starts, ends and each text's first word."""
    start, end, _, first = tb.words(raw, off)
    low = tb.LOWER[raw]
    keep = ~tb.IS_SPACE[low]
    after = end[end < len(low)]
    after = after[~keep[after]]
    low[after] = 32
    keep[after] = True
    at = np.cumsum(keep) - keep
    new = at[start] if len(start) else start
    return low[keep], new, new + (end - start), first


def fingerprints(raw: np.ndarray, off: np.ndarray, width: int = WIDTH, seed: int = SEED) -> np.ndarray:
    """One unsigned 64-bit fingerprint a text."""
    low, start, end, first = normal(raw, off)
    count = np.diff(first)
    many = np.where(count >= width, count - width + 1, (count > 0).astype(np.int64))
    out = np.zeros(len(count), U)
    some = np.flatnonzero(many)
    if not len(some):
        return out
    begin = tb.ranges(first[:-1][some], many[some])
    last = begin + np.repeat(np.minimum(count[some], width) - 1, many[some])
    h = xxh64.hashes(low, start[begin], end[last] - start[begin], seed)
    # bits are counted in byte lanes, over at most 255 shingles at a time
    ends = np.cumsum(many[some])
    parts = -(-many[some] // 255)
    cut = np.repeat(ends - many[some], parts) + 255 * tb.ranges(np.zeros(len(some), np.int64), parts)
    lanes = [np.add.reduceat(SPREAD[(h >> U(8 * b)) & U(255)], cut).astype("<u8").view(np.uint8).reshape(-1, 8) for b in range(8)]
    ones = np.add.reduceat(np.concatenate(lanes, axis=1).astype(np.int64), np.cumsum(parts) - parts, axis=0)
    out[some] = np.packbits(2 * ones > many[some][:, None], axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def with_fingerprints(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``<id_col>``, ``fp`` (the fingerprint as a signed long)."""
    src = docs.select(id_col, text_col)
    schema = T.StructType([src.schema[0], T.StructField("fp", T.LongType())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            raw, off = tb.text_buffers(batch.column(1))
            for a, z in tb.slices(off, SLICE):
                fp = fingerprints(raw[off[a]: off[z]], off[a: z + 1] - off[a])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, z - a), pa.array(fp.view(np.int64))], names=schema.names)

    return src.mapInArrow(run, schema)


def embedded(fps: DataFrame) -> DataFrame:
    """``cell``, ``fp``: each fingerprint's two points, one a half: a field of two bits per segment holds its bit count; bit 32 tells the half."""
    def point(half: int):
        x = F.shiftrightunsigned("fp", 32) if half else F.col("fp").bitwiseAND(0xFFFFFFFF)
        return x - F.shiftright(x, 1).bitwiseAND(0x55555555) + (half << 32)
    return fps.select(F.explode(F.array(point(0), point(1))).alias("cell"), "fp")


def neighbours(points: DataFrame) -> DataFrame:
    """Every row (``cell`` and one more long) at its cell and at all cells at Manhattan distance 1."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            c, other = (x.to_numpy(zero_copy_only=False) for x in batch.columns)
            cells, rows = [c], [np.arange(len(c))]
            for j in range(16):
                step, field = np.int64(1 << 2 * j), (c >> (2 * j)) & 3
                for at, by in ((np.flatnonzero(field < 2), step), (np.flatnonzero(field > 0), -step)):
                    cells.append(c[at] + by)
                    rows.append(at)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(cells)), pa.array(other[np.concatenate(rows)])], names=batch.schema.names)

    return points.mapInArrow(run, points.schema)


def crowded(points: DataFrame, most: int) -> DataFrame:
    """``cell``, ``blocks``: cells that may have more than ``most`` fingerprints.

    Such a cell is near a point that holds more than ``most / NEAR`` of them; the others add no more than ``most``.
    """
    heavy = points.groupBy("cell").agg(F.count("*").alias("n")).where(F.col("n") > most // NEAR)
    return (neighbours(heavy).groupBy("cell").agg(F.sum("n").alias("n")).where(F.col("n") > most)
            .select("cell", (F.floor(F.col("n") / most) + 1).cast("int").alias("blocks")))


def forest(fp: np.ndarray, radius: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that connect what all links among ``fp`` connect: each found fingerprint looks among those not found yet."""
    out = []
    left = fp
    while len(left) > 1:
        reached, left = [left[:1]], left[1:]
        while reached and len(left):
            now = reached.pop()
            for f in now:
                near = np.bitwise_count(left ^ f) <= radius
                if near.any():
                    got = left[near]
                    out.append((np.full(len(got), f), got))
                    reached.append(got)
                    left = left[~near]
    return out


def links(cells: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``cell``, ``i``, ``j``, ``fp``, sorted by the first three in each task -> ``a``, ``b``: links that connect each group."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def compare(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1)]))
            size = np.diff(np.append(new, len(fp)))
            found = []
            small = np.repeat((size > 1) & (size <= SMALL), size)
            f, run_no = fp[small], np.repeat(np.arange(len(size)), size)[small]
            for d in range(1, SMALL):
                at = np.flatnonzero(run_no[d:] == run_no[:-d])
                if not len(at):
                    break
                at = at[np.bitwise_count(f[at] ^ f[at + d]) <= radius]
                found.append((f[at], f[at + d]))
            for k in np.flatnonzero(size > SMALL):
                found += forest(fp[new[k]: new[k] + size[k]], radius)
            a, b = (np.concatenate(x) for x in zip(*found)) if found else (fp[:0], fp[:0])
            pair = np.unique(np.stack([a, b], 1).view(np.int64), axis=0) if len(a) else np.zeros((0, 2), np.int64)
            return pa.RecordBatch.from_arrays([pa.array(pair[:, 0]), pa.array(pair[:, 1])], names=["a", "b"])

        keys, fps, rows = [], [], 0
        for batch in it:
            key = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)], 1)
            if not len(key):
                continue
            keys.append(key)
            fps.append(batch.column(3).to_numpy(zero_copy_only=False).view(U))
            rows += len(key)
            if rows < 1 << 16 or (keys[0][0] == key[-1]).all():
                continue
            key, fp = np.concatenate(keys), np.concatenate(fps)
            last = int(np.flatnonzero((key != key[-1]).any(axis=1))[-1]) + 1  # the last group may go on
            yield compare(key[:last], fp[:last])
            keys, fps, rows = [key[last:]], [fp[last:]], len(key) - last
        if rows:
            yield compare(np.concatenate(keys), np.concatenate(fps))

    return cells.select("cell", "i", "j", "fp").mapInArrow(run, "a long, b long")


def linked(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``fps``: distinct fingerprints -> ``a``, ``b``: links with the components of all links."""
    if radius > RADIUS:
        raise ValueError(f"the grid is made for at most {RADIUS} differing bits")
    points = embedded(fps)
    hot = graph.saved(crowded(points, CELL), "simhash-crowded")
    dealt = (neighbours(points).join(hot, "cell", "left").withColumn("_n", F.coalesce("blocks", F.lit(1)))
             .withColumn("_own", F.pmod(F.xxhash64("fp"), F.col("_n")).cast("int"))
             .select("cell", "fp", "_own", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("_o"))
             .select("cell", F.least("_own", "_o").alias("i"), F.greatest("_own", "_o").alias("j"), "fp"))
    keys = ["cell", "i", "j"]
    return links(dealt.repartition(*keys).sortWithinPartitions(*keys), radius)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row per document: ``<id_col>``, ``fingerprint`` (16 hex digits), ``component_id``."""
    seen = graph.saved(with_fingerprints(docs, id_col, text_col), "simhash-fingerprints")
    classes = graph.saved(seen.groupBy("fp").agg(F.min(id_col).alias("first")), "simhash-classes")
    comp = graph.components(linked(classes.select("fp"), radius))
    named = classes.join(comp, F.col("node") == F.col("fp"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    told = graph.saved(named.join(least, "root").select("fp", "component_id"), "simhash-named")
    return seen.join(told, "fp").select(id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

"""Lloyd's k-means on integer vectors, sharded by dimension.

The vectors are stored once in blocks: a chunk of some thousand rows by a
shard of neighbouring dimensions. A round has three steps, all exact:

1. A task takes blocks of one shard and that shard's slice of the centroids
   and gives the partial squared distances of the chunk's rows.
2. Per chunk, the shards' partial distances are added and the nearest
   centroid taken (equal distances: the smaller number).
3. Each shard reads its own blocks with the chunks' assignments, adds up its
   columns per cluster (partial sums per task, then one aggregation) and
   makes its next slice; an empty cluster keeps its slice.

No task needs whole vectors or whole centroids, chunks have one size whatever
the data, and equal vectors fall in different chunks, so no group is hot. What
is broadcast is the centroid table, ``k * dims`` integers. Blocks, assignments
and centroids are tables in the shared folder, so a lost executor costs one step.

Vectors that are null, have another length, or hold a null or non-finite
component take no part and give no row. A component beyond ``LIMIT`` after
scaling raises an error, as squared distances would not fit a long. A null id
takes part; as a first centroid it comes after all others. Repeated rows count
as often as they occur; of several vectors under one id the smallest is taken
first as a centroid. Fewer vectors than ``k`` give as many clusters; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorflow.llm.graph import saved
from sensorflow.session import scratch_path

#: Rows of a chunk.
CHUNK = 2048
SHARDS = 4
#: Largest magnitude of a scaled component: 2^27 keeps 64 squared differences below 2^63.
LIMIT = 1 << 27


def shard_ends(dims: int, shards: int) -> list[int]:
    return [dims * s // shards for s in range(shards + 1)]


def scaled(batch: pa.RecordBatch, dims: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Kept rows of a batch (column 1 holds the vectors) and their integer components."""
    col = batch.column(1)
    right = pc.fill_null(pc.equal(pc.list_value_length(col), dims), False)
    rows = np.flatnonzero(right.to_numpy(zero_copy_only=False))
    x = pc.cast(pc.list_flatten(col.take(pa.array(rows))), pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(-1, dims)
    fine = np.isfinite(x).all(axis=1)
    y = np.floor(scale * x[fine])
    if y.size and np.abs(y).max() > LIMIT:
        raise ValueError(f"a vector component is beyond {LIMIT} after scaling; distances would not fit a long")
    return rows[fine], y.astype("<i4")


def blocks(vectors: DataFrame, id_col: str, vec_col: str, dims: int, scale: float, shards: int) -> DataFrame:
    """The vectors as ``chunk``, ``n`` (its rows), ``ids`` (with shard 0 only), ``data`` (row-major 32-bit integers),
    ``shard``; written once, a folder a shard."""
    ends = shard_ends(dims, shards)
    src = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec"))
    id_type = src.schema["id"].dataType
    schema = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("n", T.IntegerType()), T.StructField("ids", T.ArrayType(id_type)),
                           T.StructField("data", T.BinaryType()), T.StructField("shard", T.IntegerType())])

    def cut(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for batch in it:
            rows, x = scaled(batch, dims, scale)
            ids = batch.column(0).take(pa.array(rows))
            for a in range(0, len(rows), CHUNK):
                part, own = x[a: a + CHUNK], ids.slice(a, CHUNK)
                lists = pa.ListArray.from_arrays(pa.array([0, *[None] * (shards - 1), len(own)], pa.int32()), own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk] * shards, pa.int64()), pa.array([len(own)] * shards, pa.int32()), lists,
                     pa.array([np.ascontiguousarray(part[:, p:q]).tobytes() for p, q in zip(ends[:-1], ends[1:])], pa.binary()),
                     pa.array(range(shards), pa.int32())], names=schema.names)
                chunk += 1

    path = scratch_path(vectors.sparkSession, "lloyd-blocks")
    src.mapInArrow(cut, schema).write.partitionBy("shard").parquet(path)
    return vectors.sparkSession.read.schema(schema).parquet(path)


def first_centroids(vectors: DataFrame, id_col: str, vec_col: str, k: int, dims: int, scale: float, seed: int, shards: int) -> DataFrame:
    """``shard``, ``cluster``, ``c``: the ``k`` vectors with the smallest sha256 of ``seed:id``."""
    id_, vec = F.col(id_col), F.col(vec_col)
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    fine = F.coalesce((F.size(vec) == dims) & finite, F.lit(False))
    whole = F.transform(vec, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    order = F.sha2(F.concat(F.lit(f"{seed}:"), id_.cast("string")), 256)
    rows = (vectors.where(fine).select(order.alias("h"), whole.alias("v")).orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect())
    ends = shard_ends(dims, shards)
    return vectors.sparkSession.createDataFrame(
        [(s, i, r["v"][p:q]) for i, r in enumerate(rows) for s, (p, q) in enumerate(zip(ends[:-1], ends[1:]))],
        "shard int, cluster int, c array<bigint>")


def slices(centroids: DataFrame) -> DataFrame:
    """One row a shard: its slices of all centroids, in order."""
    return centroids.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("cluster", "c"))).alias("_s")).select("shard", F.col("_s.c").alias("slice"))


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows."""
    most = int(np.abs(x).max(initial=0)) + int(np.abs(c).max(initial=0))
    if x.shape[1] * most * most < 1 << 53:  # every term is an integer that a double holds
        a, b = x.astype(np.float64), c.astype(np.float64)
        return ((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)).astype(np.int64)
    a = x.astype(np.int64)
    return np.stack([((a - row) ** 2).sum(1) for row in c.astype(np.int64)], 1)


def partial_distances(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``chunk``, ``n``, ``data``, ``slice`` -> ``chunk``, ``n``, ``partial`` (n x k 64-bit integers)."""
    for batch in it:
        for i in range(batch.num_rows):  # a row is a chunk
            c = np.array(batch.column(3)[i].as_py(), np.int64)
            x = np.frombuffer(batch.column(2)[i].as_buffer(), "<i4").reshape(-1, c.shape[1])
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), batch.column(1).slice(i, 1), pa.array([squared(x, c).astype("<i8").tobytes()], pa.binary())],
                                             names=["chunk", "n", "partial"])


def add_and_choose(group: pa.Table) -> pa.Table:
    """All shards' partial distances of one chunk -> the chunk's clusters and distances."""
    n = group.column("n")[0].as_py()
    total = sum(np.frombuffer(p.as_buffer(), "<i8") for p in group.column("partial")).reshape(n, -1)
    best = total.argmin(axis=1)
    return pa.table({"chunk": group.column("chunk").slice(0, 1), "cluster": pa.array([best.astype(np.int32)], pa.list_(pa.int32())),
                     "distance": pa.array([total[np.arange(n), best]], pa.list_(pa.int64()))})


def assign(table: DataFrame, centroids: DataFrame) -> DataFrame:
    """``chunk``, ``cluster`` and ``distance`` (arrays over the chunk's rows)."""
    partial = (table.join(F.broadcast(slices(centroids)), "shard").select("chunk", "n", "data", "slice")
               .mapInArrow(partial_distances, "chunk long, n int, partial binary"))
    return saved(partial.groupBy("chunk").applyInArrow(add_and_choose, "chunk long, cluster array<int>, distance array<bigint>"), "lloyd-assigned")


def column_sums(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``shard``, ``data``, ``cluster`` -> a task's ``shard``, ``cluster``, ``n``, ``s`` (sums of the shard's columns)."""
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in it:
        for i in range(batch.num_rows):
            shard, own = batch.column(0)[i].as_py(), batch.column(2)[i].values.to_numpy()
            x = np.frombuffer(batch.column(1)[i].as_buffer(), "<i4").reshape(len(own), -1).astype(np.int64)
            count = np.bincount(own)
            order = np.argsort(own, kind="stable")
            some = np.flatnonzero(count)
            sums = np.add.reduceat(x[order], np.concatenate([[0], np.cumsum(count[some])[:-1]]), axis=0)
            n, s = held.get(shard, (np.zeros(0, np.int64), np.zeros((0, x.shape[1]), np.int64)))
            if len(n) < len(count):
                n, s = np.pad(n, (0, len(count) - len(n))), np.pad(s, ((0, len(count) - len(s)), (0, 0)))
            n[some] += count[some]
            s[some] += sums
            held[shard] = n, s
    for shard, (n, s) in held.items():
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), shard), pa.int32()), pa.array(some, pa.int32()), pa.array(n[some]), pa.array(list(s[some]), pa.list_(pa.int64()))],
                                         names=["shard", "cluster", "n", "s"])


def floor_div(a: Column, n: Column) -> Column:
    """Exact floor of a long over a positive long."""
    return F.call_function("div", a - F.pmod(a, n), n)


def update(table: DataFrame, centroids: DataFrame, assigned: DataFrame, width: int) -> DataFrame:
    """Every shard's next slices: floored means of its columns; empty clusters keep theirs."""
    sums = (table.join(assigned.select("chunk", "cluster"), "chunk").select("shard", "data", "cluster")
            .mapInArrow(column_sums, "shard int, cluster int, n bigint, s array<bigint>"))
    total = sums.groupBy("shard", "cluster").agg(F.sum("n").alias("n"), *[F.sum(F.get("s", F.lit(i))).alias(f"s{i}") for i in range(width)])
    mean = F.filter(F.array(*[floor_div(F.col(f"s{i}"), F.col("n")) for i in range(width)]), lambda x: x.isNotNull())
    new = total.select("shard", "cluster", mean.alias("new"))
    return saved(centroids.join(new, ["shard", "cluster"], "left").select("shard", "cluster", F.coalesce("new", "c").alias("c")), "lloyd-centroids")


def lloyd(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 40, rounds: int = 5, dims: int = 64,
          scale: float = 256.0, seed: int = 2, shards: int = SHARDS) -> tuple[DataFrame, DataFrame]:
    """Members (``<id_col>``, ``cluster``, ``distance``) and final centroids (``cluster``, ``centroid``)."""
    table = blocks(vectors, id_col, vec_col, dims, scale, shards)
    ends = shard_ends(dims, shards)
    width = max(q - p for p, q in zip(ends[:-1], ends[1:]))
    centroids = saved(first_centroids(vectors, id_col, vec_col, k, dims, scale, seed, shards), "lloyd-centroids")
    for _ in range(rounds):
        centroids = update(table, centroids, assign(table, centroids), width)
    final = assign(table, centroids)
    rows = table.where("shard = 0").select("chunk", "ids").join(final, "chunk")
    members = rows.select(F.inline(F.arrays_zip("ids", "cluster", "distance"))).withColumnRenamed("ids", id_col)
    whole = centroids.groupBy("cluster").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("shard", "c"))), lambda x: x["c"])).alias("centroid"))
    return members, whole


def cluster_report(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", **options) -> DataFrame:
    """One row per kept vector: ``<id_col>``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``, ``centroid_sha256``."""
    members, centroids = lloyd(vectors, id_col, vec_col, **options)
    whole = F.sum(F.col("distance").cast("decimal(38,0)"))
    per = members.groupBy("cluster").agg(whole.alias("_d"))
    total = per.agg(F.sum("_d").cast("bigint").alias("inertia"))
    told = (centroids.join(per, "cluster").crossJoin(F.broadcast(total))  # one row
            .select("cluster", F.col("_d").cast("bigint").alias("cluster_inertia"), "inertia",
                    F.sha2(F.concat_ws(",", F.col("centroid").cast("array<string>")), 256).alias("centroid_sha256")))
    return members.join(F.broadcast(told), "cluster").select(id_col, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")

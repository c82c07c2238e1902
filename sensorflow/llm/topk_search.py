"""Exact top-k inner-product search by block-at-a-time pruning.

Candidates are dealt into shards, each shard into blocks of similar vectors.
A block keeps its forward index (the vectors) and, per term (dimension), the
largest and smallest value. For a query the sum over terms of the best
product bounds every score in the block. Blocks are visited in descending
order of that bound and scored through the forward index until the bound
falls below the query's k-th score, so nothing that could enter the top k is
skipped. Spark deals (shard, query chunk) pairs to tasks: a task holds at most
about ``SHARD_ROWS`` vectors and ``CHUNK_QUERIES`` queries however large the
table is. Each returns k rows per query, merged by one window per query.

Edge cases: a null vector, or one holding a null or non-finite component,
takes no part, as query or candidate. Vectors of different lengths are
compared as if padded with zeros (an empty vector scores 0). Repeated rows
are separate candidates; repeated query rows are one query; a candidate with
the query's own id is the query itself. Rows with a null id take no part.
Components are expected to satisfy ``|64 x| < 2**31``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARD_ROWS = 16_384
CHUNK_QUERIES = 4_096
BLOCK = 128
SCALE = 64


def quantised(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``_id``, ``_v``: vectors as integers floor(64 * x), invalid ones removed."""
    x = F.col(vec_col)
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == F.lit(float("inf"))))
    ok = x.isNotNull() & F.col(id_col).isNotNull() & ~F.coalesce(bad, F.lit(True))
    v = F.transform(x, lambda e: F.floor(e.cast("double") * SCALE).cast("long"))
    return vectors.where(ok).select(F.col(id_col).cast("long").alias("_id"), v.alias("_v"))


def _matrix(col, width: int) -> np.ndarray:
    """A list column as a matrix of ``width`` columns, short rows padded with zeros."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks() if col.num_chunks != 1 else col.chunk(0)
    lens = np.diff(col.offsets.to_numpy())
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(lens) and (lens == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(lens), width), np.int64)
    out[np.arange(width)[None, :] < lens[:, None]] = flat
    return out


def _width(col) -> int:
    lens = pc.list_value_length(col)
    return pc.max(lens).as_py() or 0


def search_shard(qid, q, did, d, k: int, block: int = BLOCK):
    """Top k of ``d`` for every row of ``q``: (query index, candidate id, score) arrays."""
    n, width = d.shape
    lead = np.abs(d).argmax(1) if width else np.zeros(n, np.int64)
    sign = d[np.arange(n), lead] < 0 if width else np.zeros(n, bool)
    order = np.lexsort((did, lead * 2 + sign))
    did, d = did[order], d[order]
    top = max(np.abs(d).max(initial=0), np.abs(q).max(initial=0))
    # products of doubles are exact below 2**53; integer arithmetic beyond
    kind = np.float64 if float(top) ** 2 * max(1, width) < 2**53 else np.int64
    q, d = q.astype(kind), d.astype(kind)
    cuts = np.arange(0, n, block)
    hi, lo = np.maximum.reduceat(d, cuts), np.minimum.reduceat(d, cuts)
    bound = np.maximum(q, 0) @ hi.T + np.minimum(q, 0) @ lo.T
    visit = np.argsort(-bound, axis=1, kind="stable")
    nq = len(q)
    least = np.iinfo(np.int64).min
    best = np.full((nq, k), least, np.int64)
    ids = np.full((nq, k), np.iinfo(np.int64).max, np.int64)
    alive = np.arange(nq)
    for r in range(len(cuts)):
        b = visit[alive, r]
        # a bound equal to the k-th score may still bring a smaller id
        go = bound[alive, b] >= best[alive, -1]
        alive, b = alive[go], b[go]
        if not len(alive):
            break
        by = np.argsort(b, kind="stable")
        for part in np.split(by, np.flatnonzero(np.diff(b[by])) + 1):
            rows, s = alive[part], slice(cuts[b[part[0]]], cuts[b[part[0]]] + block)
            score = (q[rows] @ d[s].T).astype(np.int64)
            own = qid[rows][:, None] == did[s][None, :]
            may = (score >= best[rows, -1][:, None]) & ~own
            some = np.flatnonzero(may.any(1))
            if not len(some):
                continue
            rows = rows[some]
            ok = may[some]
            s_all = np.concatenate([best[rows], np.where(ok, score[some], least)], 1)
            i_all = np.concatenate([ids[rows], np.where(ok, did[s][None, :], np.iinfo(np.int64).max)], 1)
            pick = np.lexsort((i_all, -s_all.astype(np.float64) if kind is np.float64 else ~s_all), axis=1)[:, :k]
            best[rows] = np.take_along_axis(s_all, pick, 1)
            ids[rows] = np.take_along_axis(i_all, pick, 1)
    found = best != least
    at = np.nonzero(found)
    return at[0], ids[at], best[at]


def topk_search(vectors: DataFrame, id_col: str, vec_col: str, is_query: Column, k: int = 20,
                shard_rows: int = SHARD_ROWS, chunk_queries: int = CHUNK_QUERIES) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: each query's k best other rows, ties to the smaller id."""
    v = quantised(vectors, id_col, vec_col)
    q = quantised(vectors.where(is_query), id_col, vec_col).dropDuplicates(["_id", "_v"])
    sizes = v.agg(F.count("*").alias("n")).first()["n"], q.agg(F.count("*").alias("n")).first()["n"]
    shards, chunks = (max(1, -(-n // most)) for n, most in zip(sizes, (shard_rows, chunk_queries)))
    # the row number spreads repeated ids; a file scan gives the same numbers when a task is repeated
    d = v.withColumn("_shard", F.pmod(F.xxhash64("_id", F.monotonically_increasing_id()), F.lit(shards)))
    d = d.withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)).cast("array<bigint>")))
    q = q.withColumn("_chunk", F.pmod(F.xxhash64("_id"), F.lit(chunks)))
    q = q.withColumn("_shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)).cast("array<bigint>")))

    def run(queries: pa.Table, docs: pa.Table) -> pa.Table:
        kinds = [("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())]
        if not queries.num_rows or not docs.num_rows:
            return pa.schema(kinds).empty_table()
        qc, dc = queries.column("_v").combine_chunks(), docs.column("_v").combine_chunks()
        width = max(_width(qc), _width(dc))
        qid = queries.column("_id").to_numpy()
        at, ids, score = search_shard(qid, _matrix(qc, width), docs.column("_id").to_numpy(), _matrix(dc, width), k)
        return pa.table({"query_id": qid[at], "vec_id": ids, "score": score})

    keys = ["_shard", "_chunk"]
    part = q.groupBy(*keys).cogroup(d.groupBy(*keys)).applyInArrow(run, "query_id long, vec_id long, score long")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return part.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

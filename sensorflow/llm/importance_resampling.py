"""Importance resampling of documents towards a target distribution.

Features of a text are its runs of consecutive words, hashed into buckets by
crc32. A bucket's gain says how much more frequent it is in the target than
in the documents; a document's weight is its features' mean gain, its score
the weight plus Gumbel noise from a hash of its id, and the documents with the
highest scores are drawn.

* Bucket counts are one array a task, added up per bucket; the gains, one
  number a bucket, go to the tasks that score texts. Texts are read twice and
  never shuffled.
* The cutoff is not found by sorting all scores. A quantile sketch gives a
  bracket around it; exact counts of the scores above and inside confirm that
  the cutoff lies inside or the bracket is widened until it does. Only the
  bracket's rows are sorted to find the last drawn one.
* Ranks come from a segmented running count over the drawn rows.

A null or wordless text has no features, weight 0 and a score, but is drawn
only if ``least_words`` is 0. The noise of a row with a null id is that of an
empty id; among equal scores such rows come last. Repeated rows score and rank
each for itself (rows with equal score, id and feature count in any order).
An empty target gives gains from the documents alone; an empty table no rows.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorflow.llm import textbatch as tb
from sensorflow.llm.graph import saved
from sensorflow.plans.scan import row_number

BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 10
#: Relative rank error of the quantile sketch; its size on the driver is bounded by this.
SKETCH_ERROR = 0.001
#: Longer words go to zlib one by one.
LONG = 64
CRC_TABLE = np.arange(256, dtype=np.uint32)
for _ in range(8):
    CRC_TABLE = (CRC_TABLE >> np.uint32(1)) ^ (np.uint32(0xEDB88320) * (CRC_TABLE & np.uint32(1)))


def crc_on(state: np.ndarray, low: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Unsigned crc32 values carried on over one byte run each."""
    out = state.copy()
    order = np.argsort(-length, kind="stable")
    sizes = -length[order]
    long = int(np.searchsorted(sizes, -LONG, side="left"))
    for i in order[:long]:
        out[i] = zlib.crc32(low[start[i]: start[i] + length[i]].tobytes(), int(out[i]))
    order, sizes = order[long:], sizes[long:]
    at, crc = start[order], ~out[order]
    for k in range(int(-sizes[0]) if len(sizes) else 0):
        m = int(np.searchsorted(sizes, -k, side="left"))  # runs of more than k bytes
        crc[:m] = CRC_TABLE[(crc[:m] ^ low[at[:m] + k]) & np.uint32(255)] ^ (crc[:m] >> np.uint32(8))
    out[order] = ~crc
    return out


def features(raw: np.ndarray, off: np.ndarray, runs: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(text, bucket)`` of every feature of every text, and the texts' word counts."""
    start, end, _, first = tb.words(raw, off, tb.IS_SIGN)
    low, length, words = tb.LOWER[raw], end - start, np.diff(first)
    text = np.repeat(np.arange(len(words)), words)
    texts, found = [], []
    state = np.zeros(len(start), np.uint32)
    at = np.arange(len(start))
    for k in range(runs):
        if k:  # runs that go on with one more word
            goes = at + k < np.take(first[1:], text[at])
            at, state = at[goes], state[goes]
            state = crc_on(state, np.full(1, 32, np.uint8), np.zeros(len(at), np.int64), np.ones(len(at), np.int64))
        state = crc_on(state, low, start[at + k], length[at + k])
        texts.append(text[at])
        found.append(state % np.uint32(buckets))
    return np.concatenate(texts), np.concatenate(found).astype(np.int64), words


def bucket_counts(texts: DataFrame, text_col: str, runs: int, buckets: int) -> DataFrame:
    """``bucket``, ``n``: how often each bucket occurs in all texts."""
    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in it:
            raw, off = tb.text_buffers(batch.column(0))
            for a, z in tb.slices(off):
                _, b, _ = features(raw[off[a]: off[z]], off[a: z + 1] - off[a], runs, buckets)
                total += np.bincount(b, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], names=["bucket", "n"])

    return texts.select(text_col).mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def _array(counts: DataFrame, buckets: int) -> list[int]:
    """The counts as a list; its length is the number of buckets."""
    out = [0] * buckets
    for r in counts.collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: list[int], target: list[int]) -> np.ndarray:
    """Per bucket floor(1000 ln of the smoothed ratio of its shares in target and source), in doubles."""
    n, s_all, t_all = len(source), float(sum(source)), float(sum(target))
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + n) / ((s + 1.0) * (t_all + n)))) for s, t in zip(source, target)], np.int64)


def weights(docs: DataFrame, id_col: str, text_col: str, gain: np.ndarray, runs: int) -> DataFrame:
    """``<id_col>``, ``n_features``, ``weight``, ``n_words``."""
    src = docs.select(id_col, text_col)
    schema = T.StructType([src.schema[0], *[T.StructField(c, T.LongType()) for c in ("n_features", "weight", "n_words")]])

    def score(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            raw, off = tb.text_buffers(batch.column(1))
            for a, z in tb.slices(off):
                text, bucket, words = features(raw[off[a]: off[z]], off[a: z + 1] - off[a], runs, len(gain))
                n = np.bincount(text, minlength=z - a)
                total = np.zeros(z - a, np.int64)
                np.add.at(total, text, gain[bucket])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, z - a), pa.array(n), pa.array(total // np.maximum(n, 1)), pa.array(words)], names=schema.names)

    return src.mapInArrow(score, schema)


def scored(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text",
           runs: int = 1, buckets: int = BUCKETS, seed: int = 2024) -> DataFrame:
    """``weights`` with ``score``: the weight plus Gumbel noise that only the id decides."""
    gain = gains(_array(bucket_counts(docs, text_col, runs, buckets), buckets), _array(bucket_counts(target, target_text, runs, buckets), buckets))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return weights(docs, id_col, text_col, gain, runs).withColumn("score", F.col("weight") + noise)


def bracket(scores: DataFrame, col: str, n: int, k: int, error: float = SKETCH_ERROR) -> tuple[int, int, int]:
    """``(low, high, above)``: the ``k``-th highest of ``n`` scores lies in ``[low, high]``, and ``above`` scores exceed ``high``.

    The sketch proposes, exact counts decide: while the cutoff is outside, the bracket is widened on that side.
    """
    far = error
    at = 1 - k / n
    while True:
        p, q = max(0.0, at - 2 * far), min(1.0, at + 2 * far)
        low, high = (int(x) for x in scores.approxQuantile(col, [p, q], min(error, far)))
        # the ends of the sketch are exact only up to its error
        if p == 0.0 or q == 1.0:
            ends = scores.agg(F.min(col).alias("a"), F.max(col).alias("b")).first()
            low, high = (ends["a"] if p == 0.0 else low), (ends["b"] if q == 1.0 else high)
        found = scores.agg(F.count(F.when(F.col(col) > high, 1)).alias("above"),
                           F.count(F.when(F.col(col).between(low, high), 1)).alias("inside")).first()
        if found["above"] < k <= found["above"] + found["inside"]:
            return low, high, found["above"]
        far *= 4


def draw(scores: DataFrame, id_col: str, eligible, percent: int = PERCENT, error: float = SKETCH_ERROR) -> DataFrame:
    """Adds ``rank``: 1, 2, 3 … for the floor(``percent`` / 100) highest scores of the eligible rows (ties: smaller id), else null."""
    some = scores.where(eligible)
    n = some.count()
    k = n * percent // 100
    none = F.lit(None).cast("bigint")
    if not k:
        return scores.withColumn("rank", none)
    order = {"_down": -F.col("score"), "_no": F.col(id_col).isNull(), "_id": F.col(id_col), "_n": F.col("n_features")}
    names = list(order)
    low, high, above = bracket(some, "score", n, k, error)
    inside = some.where(F.col("score").between(low, high)).select(*[c.alias(a) for a, c in order.items()])
    last = row_number(inside, [], names, "_rn").where(F.col("_rn") == k - above).first()
    key = F.struct(*[c.alias(a) for a, c in order.items()])
    end = F.struct(*[F.lit(last[a]).cast(inside.schema[a].dataType).alias(a) for a in names])
    drawn = eligible & (key <= end)  # rows equal to the last one may exceed k
    ranked = row_number(scores.where(drawn).withColumns(order), [], names, "_rn")
    ranked = ranked.withColumn("rank", F.when(F.col("_rn") <= k, F.col("_rn"))).drop(*names, "_rn")
    return ranked.unionByName(scores.where(~drawn).withColumn("rank", none))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text", runs: int = 1,
             buckets: int = BUCKETS, seed: int = 2024, least_words: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """One row a document: ``<id_col>``, ``n_features``, ``weight``, ``score``, ``rank`` (null if not drawn)."""
    scores = saved(scored(docs, target, id_col, text_col, target_text, runs, buckets, seed), "resampling-scores")
    return draw(scores, id_col, F.col("n_words") >= least_words, percent).select(id_col, "n_features", "weight", "score", "rank")

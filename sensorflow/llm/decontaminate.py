"""Benchmark decontamination by pigeonhole edit matching.

Texts and test items become sequences of words: runs of letters, digits and
non-ASCII characters of the lower-cased text. An item of m words may occur
with up to ``k = floor(ERROR_RATE * m)`` word edits. It is split into k + 1
pieces; at least one of them occurs unchanged in any such occurrence. Exact
piece hits are found by rolling hashes of all piece lengths against the
items' piece table, and each hit's surroundings are verified with Myers'
bit-parallel edit distance over words (arbitrarily long bit vectors).

The items are dealt into blocks of at most ``ITEM_BLOCK_BYTES`` of text, sized
by a count; a pass over the documents takes one block as a broadcast, so its
size is bounded whatever the benchmark's, and no item is left out.

Edge cases: null and wordless texts and items match nothing; repeated
documents are judged alike, repeated items count once; items with a null id
are reported with a null id. Overlapping occurrences of one item are reported
once, at the best end of the first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.llm import textbatch as tb
from sensorflow.llm.columns import fresh

ERROR_RATE = 0.15
ITEM_BLOCK_BYTES = 16 << 20
FILTER_BITS = 22
U = np.uint64


def budget(m: int, rate: float = ERROR_RATE) -> int:
    return int(m * rate + 1e-9)


class Pattern:
    """An item as bit masks of its words' positions."""

    def __init__(self, hashes: list[int], k: int):
        self.m, self.k = len(hashes), k
        self.masks: dict[int, int] = {}
        self.back: dict[int, int] = {}
        for i, h in enumerate(hashes):
            self.masks[h] = self.masks.get(h, 0) | 1 << i
            self.back[h] = self.back.get(h, 0) | 1 << (self.m - 1 - i)

    def _scan(self, masks: dict[int, int], text, anywhere: bool) -> tuple[int, int]:
        """(smallest distance, words read at its first occurrence) of the pattern against a stretch of ``text``;
        the stretch starts anywhere, or at the first word."""
        m = self.m
        full, top = (1 << m) - 1, 1 << (m - 1)
        pv, mv, score = full, 0, m
        best, at = m, 0
        for j, h in enumerate(text, 1):
            eq = masks.get(h, 0)
            xv = eq | mv
            xh = (((eq & pv) + pv) ^ pv) | eq
            ph = mv | (full & ~(xh | pv))
            mh = pv & xh
            if ph & top:
                score += 1
            elif mh & top:
                score -= 1
            ph = ph << 1 | (0 if anywhere else 1)
            pv = ((mh << 1) | (full & ~(xv | ph))) & full
            mv = ph & xv & full
            if score < best:
                best, at = score, j
        return best, at

    def find(self, text: list[int]) -> tuple[int, int, int] | None:
        """(start, end, distance) of the best occurrence with at most k edits."""
        best, end = self._scan(self.masks, text, True)
        if best > self.k or not end:
            return None
        _, back = self._scan(self.back, text[max(0, end - self.m - self.k): end][::-1], False)
        return end - back, end, best


class Items:
    """The piece table of one block of items."""

    def __init__(self, rows: list[tuple[int | None, str]], rate: float = ERROR_RATE):
        raw, off = tb.text_buffers(pa.array([t for _, t in rows], pa.string()))
        _, _, h, first = tb.words(raw, off, tb.IS_SIGN)
        self.ids, self.patterns = [], []
        by_length: dict[int, list[tuple[int, int, int]]] = {}
        for r, (name, _) in enumerate(rows):
            own = h[first[r]: first[r + 1]]
            m = len(own)
            if not m:
                continue
            k = budget(m, rate)
            item = len(self.ids)
            self.ids.append(name)
            self.patterns.append(Pattern(own.tolist(), k))
            cuts = [m * i // (k + 1) for i in range(k + 2)]
            for a, z in zip(cuts, cuts[1:]):
                by_length.setdefault(z - a, []).append((int(rolled(own[a:z], z - a)[0]), item, a))
        self.tables = []
        for length, found in sorted(by_length.items()):
            found.sort()
            key = np.array([f[0] for f in found], U)
            seen = np.zeros(1 << FILTER_BITS, bool)
            seen[key >> U(64 - FILTER_BITS)] = True
            self.tables.append((length, key, np.array([f[1:] for f in found], np.int64), np.packbits(seen)))


def rolled(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` words."""
    n = len(h)
    if n < width:
        return np.zeros(0, U)
    p, q = tb.powers(n + 1)
    total = np.zeros(n + 1, U)
    np.cumsum(h * p[:n], dtype=U, out=total[1:])
    return tb.mix((total[width:] - total[:-width]) * q[: n - width + 1])


def matches(items: Items, h: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(text, item, start, end, distance) of all occurrences in a batch of texts."""
    hits = []
    for length, key, where, packed in items.tables:
        x = rolled(h, length)
        cell = (x >> U(64 - FILTER_BITS)).astype(np.int64)
        at = np.flatnonzero((packed[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1)
        lo = np.searchsorted(key, x[at], "left")
        n = np.searchsorted(key, x[at], "right") - lo
        pos = np.repeat(at, n)
        which = where[tb.ranges(lo, n)]
        text = np.searchsorted(first, pos, "right") - 1
        ok = pos + length <= first[text + 1]
        hits.append(np.stack([text[ok], which[ok, 0], pos[ok] - which[ok, 1], pos[ok], pos[ok] + length], 1))
    if not hits:
        return []
    hits = np.unique(np.concatenate(hits), axis=0)
    out, done, tried = [], (-1, -1, -1), (-1, -1, -1)
    for t, item, begin, p, z in hits.tolist():
        if done[:2] == (t, item) and p < done[2]:
            continue
        pat = items.patterns[item]
        if tried == (t, item, begin):
            continue
        tried = (t, item, begin)
        a, b = max(first[t], begin - pat.k), min(first[t + 1], begin + pat.m + pat.k)
        got = pat.find(h[a:b].tolist())
        if got:
            out.append((t, item, int(a + got[0] - first[t]), int(a + got[1] - first[t]), got[2]))
            done = (t, item, int(a + got[1]))
    return out


HITS = "array<struct<item_id:bigint,start:bigint,end:bigint,distance:bigint>>"
_HIT_TYPE = pa.list_(pa.struct([(n, pa.int64()) for n in ("item_id", "start", "end", "distance")]))


def item_blocks(items: DataFrame, id_col: str, text_col: str, most: int = ITEM_BLOCK_BYTES) -> Iterator[list[tuple[int | None, str]]]:
    """The distinct items in blocks of about ``most`` bytes."""
    rows = items.select(F.col(id_col).cast("long").alias("id"), F.lower(text_col).alias("text")).where("text is not null").distinct()
    size = rows.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    blocks = max(1, -(-int(size) // most))
    for i in range(blocks):
        own = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == i) if blocks > 1 else rows
        got = [(r["id"], r["text"]) for r in own.collect()]  # about ITEM_BLOCK_BYTES by construction
        yield sorted(got, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def with_hits(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
              rate: float = ERROR_RATE, hits_col: str = "hits", most: int = ITEM_BLOCK_BYTES) -> DataFrame:
    """All columns of ``docs`` and ``hits_col``: occurrences of items, as word spans of the text."""
    spark = docs.sparkSession
    out = docs.select(F.struct("*").alias("row"), F.array().cast(HITS).alias("hits"), F.lower(F.col(text_col)).alias("low"))
    schema = out.schema
    for rows in item_blocks(items, item_id, item_text, most):
        shared = spark.sparkContext.broadcast(Items(rows, rate))

        def run(it: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            table = shared.value
            for batch in it:
                low = batch.column(2)
                found: list[list[dict]] = [x or [] for x in batch.column(1).to_pylist()]
                raw, off = tb.text_buffers(low)
                for a, z in tb.slices(off):
                    _, _, h, first = tb.words(raw[off[a]: off[z]], off[a: z + 1] - off[a], tb.IS_SIGN)
                    for t, item, start, end, d in matches(table, h, first):
                        found[a + t].append({"item_id": table.ids[item], "start": start, "end": end, "distance": d})
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, _HIT_TYPE), low], names=["row", "hits", "low"])

        out = out.mapInArrow(run, schema)
    return out.select(*[F.col("row")[c].alias(c) for c in docs.columns], F.col("hits").alias(hits_col))


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **more) -> DataFrame:
    """``<id_col>``, ``item_id``, ``start_word``, ``end_word``, ``distance`` of every occurrence of an item in a document."""
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = with_hits(narrow, items, "text", hits_col="h", **more)
    return (found.where(F.size("h") > 0).select("id", F.explode("h").alias("x"))
            .select(F.col("id").alias(id_col), "x.item_id", F.col("x.start").alias("start_word"), F.col("x.end").alias("end_word"), "x.distance"))


def without_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", **more) -> DataFrame:
    """The documents in which no item occurs, unchanged."""
    hits = fresh(docs.columns, "hits")
    return with_hits(docs, items, text_col, hits_col=hits, **more).where(F.size(hits) == 0).drop(hits)

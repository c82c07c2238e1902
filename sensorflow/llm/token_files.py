"""Token-id files: an adaptive range coder that mixes order-0 to order-2 predictions.

A section holds up to ``SECTION`` ids of documents in order. Its header lists
the documents and the section's order-0 distribution (each id's share of
2^18). The ids follow in blocks of ``BLOCK``; every block starts from reset
adaptive state, has its own byte range and a crc32, and can be decoded alone.

In a block the last two ids select an order-2 and an order-1 prediction.
Adaptive probabilities, by recent success and by whether the two agree, mix
the predictions with the order-0 distribution: an id costs the arithmetic code of "order-2 right / order-1 right / neither" and,
for neither, its order-0 code. All blocks of a section are coded in lockstep,
one array operation for a step of all blocks.

Spark range-partitions the documents by id; each task writes the sections of
its range as rows of a Parquet table in the shared folder, so a repeated task
replaces its output as any Spark write does. ``decode_sections`` reads them
back and checks every block. First ids come from section totals: prefix sums
over one row per range, then inside each range.

Edge cases: a null or empty text has only the end id; rows with a null id come
first; repeated ids keep every row, in a fixed order of the input; an empty
table makes no section.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorflow.llm import graph, tokens
from sensorflow.session import scratch_path

MAGIC = b"CMRC"
SECTION = 1 << 22
BLOCK = 1024
SLOT_BITS = 9
TOTAL_BITS = 18
EVENT = 1 << 16
TOP = 1 << 48
LOW_EDGE = 1 << 32
RATE = 4
#: Bounds of an adaptive share, so that no event's share of EVENT falls below 4.
LEAST, MOST = 64, 65000


def order0(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Present ids and their frequencies, which sum to 2^TOTAL_BITS; each is at least 1."""
    present, n = np.unique(ids, return_counts=True)
    bits = max(TOTAL_BITS, int(len(present)).bit_length() + 1)
    total = 1 << bits
    freq = 1 + (n * (total - len(present)) // n.sum())
    freq[np.argmax(freq)] += total - freq.sum()
    return present.astype(np.uint32), freq.astype(np.uint32)


class _Model:
    """Adaptive state of all blocks of a section; row i of every table belongs to block i.

    A prediction is the id + 1 that last followed the same context. The share of each order has 8 contexts: whether the
    last two ids were predicted, and whether both orders say the same.
    """

    def __init__(self, lanes: int, distinct: int):
        x = np.arange(distinct + 1, dtype=np.int64)
        mask = (1 << SLOT_BITS) - 1
        self.of1, self.of2, self.of3 = ((x * 40503) >> 5) & mask, ((x * 60493) >> 4) & mask, ((x * 48271) >> 3) & mask
        self.slot = np.arange(lanes) << SLOT_BITS
        self.row = np.arange(lanes) << 3
        self.t1, self.t2 = (np.zeros(lanes << SLOT_BITS, np.int32) for _ in range(2))
        self.q2, self.q1 = (np.full(lanes << 3, EVENT // k, np.int64) for k in (2, 3))
        self.i1 = self.of1[-1] + self.slot
        self.i2 = self.i1.copy()
        self.before = np.full(lanes, self.of3[-1])
        self.past = np.zeros(lanes, np.int64)  # 2 * (the last two hits as bits)

    def predict(self, n: int):
        """Shares of the order-2 and the order-1 prediction out of EVENT, and the predictions (id + 1)."""
        i1, i2 = self.i1[:n], self.i2[:n]
        p1, p2 = self.t1.take(i1), self.t2.take(i2)
        self.at = self.row[:n] + self.past[:n]
        self.at += p1 == p2
        self.v2, self.v1 = self.q2.take(self.at), self.q1.take(self.at)
        f1 = EVENT - self.v2
        f1 *= self.v1
        f1 >>= 16
        return self.v2, f1, p2, p1

    def update(self, n: int, x: np.ndarray, y: np.ndarray, hit2: np.ndarray, hit1: np.ndarray, hit: np.ndarray):
        self.q2[self.at] = self.v2 + ((np.where(hit2, MOST, LEAST) - self.v2) >> RATE)
        new = (np.where(hit1, MOST, LEAST) - self.v1) >> RATE
        new *= ~hit2  # order 1 was not asked
        new += self.v1
        self.q1[self.at] = new
        self.t1[self.i1[:n]] = y
        self.t2[self.i2[:n]] = y
        past = self.past[:n]
        past += hit
        past <<= 1
        past &= 6
        np.add(self.of1.take(x), self.slot[:n], out=self.i1[:n])
        both = self.of2.take(x)
        both ^= self.before[:n]
        np.add(both, self.slot[:n], out=self.i2[:n])
        self.before[:n] = self.of3.take(x)


def encode_section(ids: np.ndarray, doc_meta: bytes = b"", block: int = BLOCK) -> bytes:
    """One section's bytes; ``doc_meta`` is kept as it is."""
    n = len(ids)
    lanes = -(-n // block)
    present, freq = order0(ids) if n else (np.zeros(0, np.uint32), np.zeros(0, np.uint32))
    last = n - (lanes - 1) * block
    grid = np.zeros(lanes * block, np.int64)
    grid[:n] = np.searchsorted(present, ids)
    grid = np.ascontiguousarray(grid.reshape(lanes, block).T) if lanes else grid.reshape(0, 0)
    fr = freq.astype(np.int64)
    cum = np.concatenate([[0], np.cumsum(fr)])
    bits = int(cum[-1]).bit_length() - 1
    m = _Model(lanes, len(present))
    low, rng = np.zeros(lanes, np.int64), np.full(lanes, TOP - 1, np.int64)
    width = 3 * block + 8
    out, base = np.zeros(lanes * width, np.int32), np.arange(lanes) * width
    at = base.copy()
    for t in range(min(n, block)):
        k = lanes if t < last else lanes - 1
        x, lo, rg, to = grid[t, :k], low[:k], rng[:k], at[:k]
        y = (x + 1).astype(np.int32)
        f2, f1, p2, p1 = m.predict(k)
        hit2, right1 = p2 == y, p1 == y
        hit = hit2 | right1
        hit1 = right1 > hit2
        f12 = f2 + f1
        r = rg >> 16
        lo += np.where(hit, f2 * hit1, f12) * r
        share = np.where(hit2, f2, f1)
        share = np.where(hit, share, EVENT - f12)
        share *= r
        r = share >> bits
        r *= ~hit
        lo += cum.take(x) * r
        r *= fr.take(x)
        rg[:] = np.where(hit, share, r)
        over = np.flatnonzero(lo >= TOP)
        if len(over):  # carry into the words already out
            lo[over] -= TOP
            back = to[over] - 1
            while len(back):
                out[back] += 1
                back = back[out[back] > 0xFFFF]
                out[back] = 0
                back = back - 1
        small = rg < LOW_EDGE
        out[to] = lo >> 32  # stays only where the position moves on
        to += small
        lo[:] = np.where(small, (lo << 16) & (TOP - 1), lo)
        rg[:] = np.where(small, rg << 16, rg)
        rest = np.flatnonzero(rg < LOW_EDGE)
        while len(rest):
            out[to[rest]] = lo[rest] >> 32
            to[rest] += 1
            lo[rest] = (lo[rest] << 16) & (TOP - 1)
            rg[rest] <<= 16
            rest = rest[rg[rest] < LOW_EDGE]
        m.update(k, x, y, hit2, hit1, hit)
    for k in (32, 16, 0):
        out[at] = (low >> k) & 0xFFFF
        at += 1
    size = at - base
    le = ids.astype("<u4").tobytes()
    crc = np.array([zlib.crc32(le[4 * i * block: 4 * min(n, (i + 1) * block)]) for i in range(lanes)], "<u4")
    data = out.reshape(lanes, width)[np.arange(width)[None, :] < size[:, None]].astype("<u2")
    head = zlib.compress(present.astype("<u4").tobytes() + freq.astype("<u4").tobytes() + size.astype("<u4").tobytes() + crc.tobytes() + doc_meta)
    return struct.pack("<4sIQIII", MAGIC, 1, n, block, len(present), len(head)) + head + data.tobytes()


def decode_section(payload: bytes) -> tuple[np.ndarray, bytes]:
    """The ids and the document table; raises on a damaged block."""
    magic, version, n, block, distinct, head_size = struct.unpack_from("<4sIQIII", payload)
    if magic != MAGIC or version != 1:
        raise ValueError("not a token section")
    at = struct.calcsize("<4sIQIII")
    head = zlib.decompress(payload[at: at + head_size])
    lanes = -(-n // block)
    arr = np.frombuffer(head[: 4 * (2 * distinct + 2 * lanes)], "<u4")
    present, freq, words, crc = np.split(arr, np.cumsum([distinct, distinct, lanes]))
    meta = head[4 * (2 * distinct + 2 * lanes):]
    if not lanes:
        return np.zeros(0, np.uint32), meta
    data = np.append(np.frombuffer(payload, "<u2", offset=at + head_size).astype(np.int64), np.zeros(4, np.int64))
    edge = len(data) - 1
    pos = np.concatenate([[0], np.cumsum(words.astype(np.int64))])[:-1]
    code = (data[pos] << 32) | (data[pos + 1] << 16) | data[pos + 2]
    pos = pos + 3
    rng = np.full(lanes, TOP - 1, np.int64)
    fr = freq.astype(np.int64)
    cum = np.concatenate([[0], np.cumsum(fr)])
    bits = int(cum[-1]).bit_length() - 1
    slot = np.repeat(np.arange(distinct), fr)
    m, last = _Model(lanes, distinct), n - (lanes - 1) * block
    grid = np.zeros((min(n, block), lanes), np.int64)
    for t in range(len(grid)):
        k = lanes if t < last else lanes - 1
        cd, rg, frm, x = code[:k], rng[:k], pos[:k], grid[t, :k]
        f2, f1, p2, p1 = m.predict(k)
        f12 = f2 + f1
        r = rg >> 16
        v = cd / r  # exact enough: both below 2^48, the quotient below 2^17
        hit2, hit = v < f2, v < f12
        hit1 = hit > hit2
        cd -= np.where(hit, f2 * hit1, f12) * r
        share = np.where(hit2, f2, f1)
        share = np.where(hit, share, EVENT - f12)
        share *= r
        r = share >> bits
        v = np.minimum(cd / np.maximum(r, 1), (1 << bits) - 1).astype(np.int64)
        v *= ~hit
        x[:] = np.where(hit, np.where(hit2, p2, p1) - 1, slot.take(v))
        np.maximum(x, 0, out=x)  # damaged data may say anything; the checksum tells
        r *= ~hit
        cd -= cum.take(x) * r
        r *= fr.take(x)
        rg[:] = np.maximum(np.where(hit, share, r), 1)
        small = rg < LOW_EDGE
        cd[:] = np.where(small, (cd << 16) | data.take(frm, mode="clip"), cd) & (TOP - 1)
        frm += small
        rg[:] = np.where(small, rg << 16, rg)
        rest = np.flatnonzero(rg < LOW_EDGE)
        while len(rest):
            cd[rest] = ((cd[rest] << 16) | data.take(np.minimum(frm[rest], edge))) & (TOP - 1)
            frm[rest] += 1
            rg[rest] <<= 16
            rest = rest[rg[rest] < LOW_EDGE]
        m.update(k, x, (x + 1).astype(np.int32), hit2, hit1, hit)
    ids = present[grid.T.reshape(-1)[:n]]
    le = ids.astype("<u4").tobytes()
    for i in range(lanes):
        if zlib.crc32(le[4 * i * block: 4 * min(n, (i + 1) * block)]) != crc[i]:
            raise ValueError(f"block {i} is damaged")
    return ids, meta


def crc32_join(parts: list[tuple[int, int]]) -> int:
    """crc32 of bytes from the (crc32, length) of its consecutive parts."""
    def times(a: int, b: int) -> int:  # product of polynomials modulo crc32's, bits reflected
        out = 0
        for k in range(31, -1, -1):
            if a >> k & 1:
                out ^= b
            b = (b >> 1) ^ (0xEDB88320 if b & 1 else 0)
        return out

    total = 0
    for crc, length in parts:
        shift, power, n = 1 << 31, 1 << 23, length  # 1 and x^8
        while n:
            if n & 1:
                shift = times(shift, power)
            power, n = times(power, power), n >> 1
        total = times(shift, total) ^ crc
    return total


META = np.dtype([("doc", "<i8"), ("null", "u1"), ("row", "<i8"), ("from", "<i8"), ("n", "<i8"), ("last", "u1")])


def write_sections(docs: DataFrame, vocabulary: str, path: str, id_col: str, text_col: str, end_id: int,
                   section: int = SECTION, block: int = BLOCK) -> None:
    """Write the documents' ids, in ascending id order, as rows (part, section, n_tokens, payload) of a Parquet table."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
                       F.monotonically_increasing_id().alias("_in"))  # parts a repeated id's rows, in a fixed order
    ranged = rows.repartitionByRange("id", "_in").sortWithinPartitions("id", "_in").select("id", "text")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, no, row = TaskContext.get().partitionId(), 0, 0
        held: list[np.ndarray] = []
        meta: list[tuple] = []
        have = 0

        def flush():
            nonlocal held, meta, have, no
            ids = np.concatenate(held)
            payload = encode_section(ids, np.array(meta, META).tobytes(), block)
            out = pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([no], pa.int64()), pa.array([len(ids)], pa.int64()),
                                              pa.array([payload], pa.binary())], names=["part", "section", "n_tokens", "payload"])
            held, meta, have, no = [], [], 0, no + 1
            return out

        for b in it:
            doc = b.column(0).to_pylist()
            for a, z, ids, off in tokens.encoded_slices(b.column(1), vocabulary, end_id):
                for i in range(z - a):
                    at, stop, name = int(off[i]), int(off[i + 1]), doc[a + i]
                    begin = at
                    while at < stop:
                        take = min(stop - at, section - have)
                        held.append(ids[at: at + take])
                        meta.append((name or 0, name is None, row, at - begin, take, at + take == stop))
                        have, at = have + take, at + take
                        if have == section:
                            yield flush()
                    row += 1
                held = [np.concatenate(held)] if held else held
        if have:
            yield flush()

    ranged.mapInArrow(run, "part int, section long, n_tokens long, payload binary").write.parquet(path)


def read_documents(sections: DataFrame) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens``, ``ids_crc32`` of every document, decoded from the sections."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for part, no, payload in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                ids, raw = decode_section(payload.as_buffer().to_pybytes())
                m = np.frombuffer(raw, META)
                cut = np.concatenate([[0], np.cumsum(m["n"])])
                le = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(le[4 * x: 4 * y]) for x, y in zip(cut[:-1].tolist(), cut[1:].tolist())]
                k = len(m)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(k, part, np.int32)), pa.array(np.full(k, no, np.int64)), pa.array(m["doc"], pa.int64(), mask=m["null"] == 1),
                     pa.array(m["row"]), pa.array(m["from"]), pa.array(cut[:-1]), pa.array(m["n"]), pa.array(m["last"] == 1), pa.array(crc, pa.int64())],
                    names=["part", "section", "doc_id", "row", "from", "at", "n", "last", "crc"])

    totals = sections.groupBy("part", "section").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    parts = totals.groupBy("part").agg(F.sum("n").alias("pn")).select("part", F.coalesce(F.sum("pn").over(before), F.lit(0)).alias("pbase"))
    inside = Window.partitionBy("part").orderBy("section").rowsBetween(Window.unboundedPreceding, -1)
    base = (totals.withColumn("sbase", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(parts, "part")
            .select("part", "section", (F.col("pbase") + F.col("sbase")).alias("base")))
    got = sections.select("part", "section", "payload").mapInArrow(
        run, "part int, section long, doc_id long, row long, `from` long, at long, n long, last boolean, crc long")
    got = graph.saved(got, "decoded-documents")  # read by both branches below, decoded once
    got = got.join(base, ["part", "section"]).withColumn("start", F.col("base") + F.col("at") - F.col("from"))
    whole = (F.col("from") == 0) & F.col("last")
    one = got.where(whole).select("doc_id", "start", F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32"))

    @F.udf("long")
    def join_crc(pieces):
        return crc32_join([(p["crc"], 4 * p["n"]) for p in pieces])

    split = (got.where(~whole).groupBy("part", "row")
             .agg(F.first("doc_id").alias("doc_id"), F.min("start").alias("start"), F.sum("n").alias("n_tokens"),
                  F.sort_array(F.collect_list(F.struct("section", "crc", "n"))).alias("p")))
    return one.unionByName(split.select("doc_id", "start", "n_tokens", join_crc("p").alias("ids_crc32")))


def token_files(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2,
                path: str | None = None) -> DataFrame:
    """Write the token files (to ``path`` or the shared scratch folder) and return what is read back from them."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "token-files")
    write_sections(docs, vocabulary, path, id_col, text_col, end_id)
    return read_documents(spark.read.parquet(path))

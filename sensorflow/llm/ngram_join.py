"""Exact Jaccard self-join on 5-word shingles with PartEnum signatures.

Set sizes fall into bands such that sets of a similar pair lie in one band or
in neighbouring ones; index p serves the pairs whose smaller set lies in band
p. In an index the shingle domain is cut by hash into a fixed number of parts
(``PARTS_PER_SHINGLE`` times the band's smallest size). A similar pair differs
in at most k shingles, hence in at most k parts, so of a set's N non-empty
parts at least ``N - k`` agree with any partner. A signature is the content of
one non-empty part; a pair must share at least ``N - k`` of them.

* Documents with equal sets form a class, a node of the link graph.
* Signatures travel as packed arrays, a row per (batch, bucket).
* A signature of up to ``SMALL_RUN`` classes gives pairs, counted over all
  signatures and kept if they share enough. More frequent ones ("hot") give no
  pairs: a class needs its hot signatures only if it may agree with a partner
  in nothing else (hot signatures >= N - k); those classes are joined to the
  smallest such class of the signature.
* The kept pairs form candidate clusters. A cluster is verified in blocks of
  about ``BLOCK`` classes; a task holds two blocks, and links are counted and
  reduced to a spanning forest there, so no list of all pairs ever exists.

Two sets whose non-empty parts both number at most k share the index's "weak"
signature instead, so nothing is lost. 64-bit hashes stand for shingles.

Edge cases: a text with fewer than five words has its whole sequence as one
shingle; a null or wordless text has an empty set, links with nothing and is
its own component. Repeated rows count as separate equal documents. A row
with a null id takes part and is named by its component's smallest id (null
if there is none).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from sensorflow.llm import graph
from sensorflow.llm import textbatch as tb

WIDTH = 5
PERCENT = 75
PARTS_PER_SHINGLE = 0.6
SMALL_RUN = 16
BLOCK = 256
#: Bytes of text a bucket of signatures stands for.
BUCKET_BYTES = 8 << 20
U = np.uint64


def bands(top: int, percent: int = PERCENT) -> np.ndarray:
    """Smallest set size of every band, up to sizes of ``top``."""
    out = [1]
    while out[-1] <= top:
        out.append(out[-1] * 100 // percent + 1)
    return np.array(out, np.int64)


def parts_of(low: np.ndarray) -> np.ndarray:
    return np.ceil(PARTS_PER_SHINGLE * low + 2 * np.sqrt(np.minimum(low, 100))).astype(np.int64)


def signatures(u: np.ndarray, off: np.ndarray, percent: int = PERCENT):
    """Signatures of sorted sets: ``(signature, entry)`` and per entry (set, upper, N - k).

    A set of band b has an entry in index b and, as the larger partner, one in
    index b - 1 if its size can be reached from there.
    """
    size = np.diff(off)
    low = bands(int(size.max(initial=1)), percent)
    band = np.searchsorted(low, size, side="right") - 1
    out_s, out_e, doc, upper, need = [], [], [], [], []
    count = 0
    for up in (0, 1):
        p = band - up
        top = np.where(p >= 0, low[np.maximum(p, 0) + 1] - 1, 0)  # largest size of the index's own band
        use = np.flatnonzero((size > 0) & (p >= 0) & ((size * percent <= top * 100) if up else True))
        if not len(use):
            continue
        n, ps, parts = size[use], p[use], parts_of(low[p[use]])
        # most differing shingles of a pair: (1 - t) / (1 + t) of the summed sizes
        partner = top[use] if up else n * 100 // percent
        k = (n + partner) * (100 - percent) // (100 + percent)
        at = tb.ranges(off[use], n)
        x = u[at]
        e = np.repeat(np.arange(len(use)), n)
        part = ((x >> U(32)) * parts[e].astype(U)) >> U(32)
        new = np.ones(len(x), bool)
        new[1:] = (part[1:] != part[:-1]) | (e[1:] != e[:-1])
        first = np.flatnonzero(new)
        total = np.add.reduceat(tb.mix(x ^ U(0x5851F42D4C957F2D)), first)
        ef = e[first]
        sig = tb.mix(total + part[first] * U(0xD1342543DE82EF95) + (ps[ef].astype(U) + U(1)) * U(0x2545F4914F6CDD1D))
        filled = np.bincount(ef, minlength=len(use))
        weak = np.flatnonzero(filled <= k)
        if len(weak):
            sig = np.concatenate([sig, tb.mix((ps[weak].astype(U) + U(7)) * U(0x9E3779B97F4A7C15))])
            ef = np.concatenate([ef, weak])
        out_s.append(sig)
        out_e.append(ef + count)
        doc.append(use)
        upper.append(np.full(len(use), up))
        need.append(np.maximum(filled - k, 0))
        count += len(use)
    cat = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
    return cat(out_s, U), cat(out_e, np.int64), cat(doc, np.int64), cat(upper, np.int64), cat(need, np.int64)


def _sets(batch: pa.RecordBatch, text: int):
    """Slices of a batch: (first row, last row, sorted shingles, offsets)."""
    raw, off = tb.text_buffers(batch.column(text))
    for a, z in tb.slices(off):
        _, _, h, first = tb.words(raw[off[a]: off[z]], off[a: z + 1] - off[a])
        u, at = tb.distinct_sets(*tb.shingles(h, first, WIDTH))
        yield a, z, u, at


def set_hash(u: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One 64-bit number per set (0 for an empty one)."""
    total = np.zeros(len(u) + 1, U)
    np.cumsum(tb.mix(u ^ U(0xA0761D6478BD642F)), dtype=U, out=total[1:])
    n = np.diff(at).astype(U)
    return np.where(n > 0, tb.mix(total[at[1:]] - total[at[:-1]] + n * U(0xE7037ED1A0B428DB)), U(0))


def _pack5(x: np.ndarray) -> bytes:
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _unpack5(b: bytes | pa.Buffer) -> np.ndarray:
    raw = np.frombuffer(b, np.uint8).reshape(-1, 5)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :5] = raw
    return out.view("<u8").reshape(-1)


def _entities(node: np.ndarray, info: np.ndarray):
    """Distinct (node, info), in order, and the number of each row's: (number, nodes, infos)."""
    order = np.lexsort((info, node))
    n, i = node[order], info[order]
    new = np.ones(len(n), bool)
    new[1:] = (n[1:] != n[:-1]) | (i[1:] != i[:-1])
    number = np.empty(len(n), np.uint32)
    number[order] = (np.cumsum(new) - 1).astype(np.uint32)
    return number, n[new], i[new]


def _runs(sig: np.ndarray, own: np.ndarray, nodes: np.ndarray, infos: np.ndarray):
    """Candidates of one bucket; ``own`` numbers each signature's (node, info), info = need * 2 + upper.

    Returns pairs of numbers with their counts, and hot signatures with the numbers of their members.
    """
    order = np.lexsort((own, sig))
    sig, own = sig[order], own[order]
    del order
    keep = np.ones(len(sig), bool)
    keep[1:] = (sig[1:] != sig[:-1]) | (nodes[own[1:]] != nodes[own[:-1]])
    sig, own = sig[keep], own[keep]
    keep = np.ones(len(sig), bool)
    keep[1:] = sig[1:] != sig[:-1]
    size = np.diff(np.append(np.flatnonzero(keep), len(sig)))
    hot = np.repeat(size > SMALL_RUN, size)
    some = np.repeat((size > 1) & (size <= SMALL_RUN), size)
    s, e = sig[some], own[some]
    upper = (infos & 1).astype(bool)
    found = []
    for d in range(1, SMALL_RUN):
        at = np.flatnonzero(s[d:] == s[:-d])
        if not len(at):
            break
        at = at[~(upper[e[at]] & upper[e[at + d]])]  # two larger partners meet in their own index
        found.append(e[at].astype(U) << U(32) | e[at + d].astype(U))
    pairs, count = np.unique(np.concatenate(found) if found else np.zeros(0, U), return_counts=True)
    return (pairs >> U(32)).astype(np.int64), (pairs & U(0xFFFFFFFF)).astype(np.int64), count, sig[hot], own[hot]


def candidates(texts: DataFrame, buckets: int) -> DataFrame:
    """``texts``: one text column -> candidate edges (a, b) between classes.

    Every row emits, but of equal sets in a batch only one does; a bucket drops the rest. So copies need no shuffle
    of texts, and as a text's signatures go to all buckets, a large class makes none of them larger than others.
    """
    def emit(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for _, _, u, at in _sets(batch, 0):
                node = set_hash(u, at).astype(np.int64)
                _, first = np.unique(node, return_index=True)
                keep = np.sort(first)
                size = np.diff(at)
                u, at = u[tb.ranges(at[keep], size[keep])], np.concatenate([[0], np.cumsum(size[keep])])
                node = node[keep]
                sig, e, doc, upper, need = signatures(u, at)
                bucket = (sig >> U(40)).astype(np.int64) % buckets
                order = np.argsort(bucket, kind="stable")
                sig, e, bucket = sig[order], e[order], bucket[order]
                cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]]) if len(bucket) else np.zeros(1, np.int64)
                rows = []
                for x, y in zip(cuts[:-1], cuts[1:]):
                    own, n = np.unique(e[x:y], return_counts=True)  # entries are in order within a bucket
                    rows.append((int(bucket[x]), _pack5(sig[x:y]), node[doc[own]].astype("<i8").tobytes(),
                                 n.astype("<u4").tobytes(), (need[own] * 2 + upper[own]).astype("<i8").tobytes()))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), *[pa.binary()] * 4))],
                                                     names=["bucket", "sig", "node", "n", "info"])

    def meet(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        now = None

        def out():
            sig = np.concatenate([_unpack5(x[0]) for x in held])
            n = np.concatenate([np.frombuffer(x[2], "<u4") for x in held])
            own, nodes, infos = _entities(*(np.concatenate([np.frombuffer(x[k], "<i8") for x in held]) for k in (1, 3)))
            held.clear()
            a, b, count, hs, he = _runs(sig, np.repeat(own, n), nodes, infos)
            m, k = len(a), len(hs)
            col = lambda p, h: pa.array(np.concatenate([p, h]).astype(np.int64))
            full = hs.astype(np.int64) * np.int64(buckets) + np.int64(now)
            zero = np.zeros(k, np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.arange(m + k) >= m), col(nodes[a], nodes[he]), col(nodes[b], full), col(infos[a], infos[he]), col(infos[b], zero), col(count, zero)],
                names=["hot", "a", "b", "ia", "ib", "n"])

        for batch in it:
            for i, bucket in enumerate(batch.column(0).to_pylist()):
                if bucket != now and held:
                    yield out()
                now = bucket
                held.append(tuple(c[i].as_buffer() for c in batch.columns[1:]))
        if held:
            yield out()

    packed = texts.mapInArrow(emit, "bucket int, sig binary, node binary, n binary, info binary")
    found = graph.saved(packed.repartition(buckets, "bucket").sortWithinPartitions("bucket")
                        .mapInArrow(meet, "hot boolean, a long, b long, ia long, ib long, n long"), "ngram-candidates")
    # info = need * 2 + upper; (class, info) names a class in an index
    hot = found.where("hot").select(F.col("a").alias("c"), F.col("ia").alias("i"), F.col("b").alias("sig"))
    heat = hot.groupBy("c", "i").agg(F.count("*").alias("h"))
    pairs = (found.where("not hot").groupBy("a", "b", "ia", "ib").agg(F.sum("n").alias("n"))
             .join(heat.select(F.col("c").alias("a"), F.col("i").alias("ia"), F.col("h").alias("ha")), ["a", "ia"], "left")
             .join(heat.select(F.col("c").alias("b"), F.col("i").alias("ib"), F.col("h").alias("hb")), ["b", "ib"], "left"))

    def least(info: str, heat_: str) -> Column:
        return F.shiftright(F.col(info), 1) - F.coalesce(F.col(heat_), F.lit(0))
    kept = pairs.where((F.col("n") >= least("ia", "ha")) & (F.col("n") >= least("ib", "hb"))).select("a", "b")
    needy = heat.where(F.col("h") >= F.shiftright(F.col("i"), 1)).select("c", "i")
    member = hot.join(needy, ["c", "i"]).select("sig", "c")
    centre = member.groupBy("sig").agg(F.min("c").alias("m"))
    stars = member.join(centre, "sig").where(F.col("c") != F.col("m")).select(F.col("m").alias("a"), F.col("c").alias("b")).distinct()
    edges = graph.saved(kept.unionByName(stars), "ngram-edges")
    graph.dropped(found)
    return edges


def _similar(sets: list[np.ndarray], other: list[np.ndarray] | None, percent: int):
    """Index pairs of similar sets, within ``sets`` or between ``sets`` and ``other``."""
    size = np.array([len(s) for s in sets])
    right = sets if other is None else other
    rsize = np.array([len(s) for s in right])
    if len(sets) * len(right) <= 64:
        inter = np.zeros((len(sets), len(right)))
        for i in range(len(sets)):
            for j in range(i + 1 if other is None else 0, len(right)):
                inter[i, j] = len(np.intersect1d(sets[i], right[j], assume_unique=True))
    else:
        every = sets if other is None else sets + right
        flat = np.concatenate(every)
        row = np.repeat(np.arange(len(every)), [len(s) for s in every])
        _, inv, df = np.unique(flat, return_inverse=True, return_counts=True)
        keep = df[inv] > 1
        row, inv = row[keep], np.unique(inv[keep], return_inverse=True)[1]
        order = np.argsort(inv, kind="stable")
        row, inv = row[order], inv[order]
        inter = np.zeros((len(sets), len(right)))
        step = 4096
        for c in range(0, int(inv.max(initial=-1)) + 1, step):
            x, y = np.searchsorted(inv, (c, c + step))
            m = np.zeros((len(every), step), np.float32)
            m[row[x:y], inv[x:y] - c] = 1
            inter += m[: len(sets)] @ (m if other is None else m[len(sets):]).T
    union = size[:, None] + rsize[None, :] - inter
    ok = (100 * inter >= percent * union) & (inter > 0)
    if other is None:
        ok = np.triu(ok, 1)
    return np.nonzero(ok)


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    up = list(range(n))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x
    out = []
    for x, y in zip(a.tolist(), b.tolist()):
        rx, ry = find(x), find(y)
        if rx != ry:
            up[rx] = ry
            out.append((x, y))
    return out


def verified(members: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``members``: class, weight, cluster, blocks, text -> rows (a, null, links of a) and (a, b, null): a forest of the links."""
    def shingle(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for a, z, u, at in _sets(batch, 4):
                part = batch.slice(a, z - a)
                # an id may have several texts; the class's own is meant
                own = set_hash(u, at).astype(np.int64) == part.column(0).to_numpy()
                data = [u[x:y].astype("<u8").tobytes() for x, y, ok in zip(at[:-1], at[1:], own) if ok]
                part = part.filter(pa.array(own))
                yield pa.RecordBatch.from_arrays([*part.columns[:4], pa.array(data, pa.binary())], names=["c", "w", "cluster", "blocks", "set"])

    sets = members.mapInArrow(shingle, "c long, w long, cluster long, blocks long, set binary")
    own = F.pmod(F.xxhash64("c"), F.col("blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    dealt = (sets.withColumn("own", own).withColumn("_o", other)
             .withColumns({"i": F.least("own", "_o"), "j": F.greatest("own", "_o")}).drop("_o", "blocks"))

    def check(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, seen = None, [], set()

        def out():
            i, j = now[1], now[2]
            left = [r for r in held if r[2] == i]
            right = [r for r in held if r[2] == j] if i != j else None
            read = lambda rows: [np.frombuffer(r[3], "<u8") for r in rows]
            a, b = _similar(read(left), None if right is None else read(right), percent) if left and right != [] else ((), ())
            if not len(a):
                return None
            rows = left + (right or [])
            b = b + (len(left) if right is not None else 0)
            node = np.array([r[0] for r in rows], np.int64)
            w = np.array([r[1] for r in rows], np.int64)
            links = np.bincount(a, w[b], len(rows)) + np.bincount(b, w[a], len(rows))
            some = np.flatnonzero(links)
            f = np.array(_forest(len(rows), a, b), np.int64).reshape(-1, 2)
            none = [None] * len(some)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([node[some], node[f[:, 0]]])), pa.array([*none, *node[f[:, 1]].tolist()], pa.int64()),
                 pa.array([*links[some].astype(int).tolist(), *[None] * len(f)], pa.int64())], names=["a", "b", "links"])

        for batch in it:
            for c, w, cluster, data, o, i, j in zip(*[x.to_pylist() for x in batch.columns]):
                if (cluster, i, j) != now:
                    if len(held) > 1 and (got := out()) is not None:
                        yield got
                    now, held, seen = (cluster, i, j), [], set()
                if c not in seen:  # a repeated row brings its text again
                    seen.add(c)
                    held.append((c, w, o, data))
        if len(held) > 1 and (got := out()) is not None:
            yield got

    keys = ["cluster", "i", "j"]
    return dealt.select("c", "w", "cluster", "set", "own", "i", "j").repartition(*keys).sortWithinPartitions(*keys) \
        .mapInArrow(check, "a long, b long, links long")


def _with_sets(docs: DataFrame, id_col: str, text_col: str, row: Column) -> DataFrame:
    """``row``, ``no`` and ``key`` (whether the id is null; the id or a number of the text), ``n``, ``c`` (size and number of
    the shingle set), ``bytes``."""
    base = docs.select(row.alias("row"), F.col(id_col).isNull().alias("no"),
                       F.coalesce(F.col(id_col).cast("long"), F.xxhash64(text_col)).alias("key"), F.col(text_col).alias("text"))
    schema = StructType([*base.schema.fields[:3], *[StructField(x, LongType()) for x in ("n", "c", "bytes")]])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for a, z, u, at in _sets(batch, 3):
                part = batch.slice(a, z - a)
                size = pa.array(np.diff(tb.text_buffers(part.column(3))[1]))
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(np.diff(at)), pa.array(set_hash(u, at).astype(np.int64)), size],
                                                 names=["row", "no", "key", "n", "c", "bytes"])

    return base.mapInArrow(run, schema)


def _solved(docs: DataFrame, id_col: str, text_col: str, percent: int) -> tuple[DataFrame, DataFrame]:
    """All rows with their classes (row = id, no, key, n, c), and all classes (c, w, links, root, no, key).

    ``no`` and ``key`` of a class name its first row: ids before null ids, smaller ones first.
    """
    seen = graph.saved(_with_sets(docs, id_col, text_col, F.col(id_col)), "ngram-sets")
    classes = (seen.where("n > 0").groupBy("c").agg(F.min(F.struct("no", "key")).alias("rep"), F.count("*").alias("w"), F.max("bytes").alias("bytes")))
    classes = graph.saved(classes.select("c", "w", "bytes", F.col("rep.no").alias("no"), F.col("rep.key").alias("key")), "ngram-classes")
    volume = classes.agg(F.sum("bytes").alias("b")).first()["b"] or 0
    buckets = max(1, -(-int(volume) // BUCKET_BYTES))
    texts = docs.select(F.col(id_col).isNull().alias("no"), F.coalesce(F.col(id_col).cast("long"), F.xxhash64(text_col)).alias("key"),
                        F.col(text_col).alias("text")).where("text is not null")

    edges = candidates(texts.select("text"), buckets)
    cluster = graph.components(edges)
    graph.dropped(edges)
    sizes = cluster.groupBy("root").agg(F.count("*").alias("n"))
    members = (cluster.join(sizes, "root").withColumn("blocks", F.ceil(F.col("n") / BLOCK))
               .join(classes, F.col("node") == F.col("c")).select("no", "key", "c", "w", F.col("root").alias("cluster"), "blocks"))
    member_texts = members.join(texts, ["no", "key"]).select("c", "w", "cluster", "blocks", "text")
    checked = graph.saved(verified(member_texts, percent), "ngram-links")
    graph.dropped(cluster)
    comp = graph.components(checked.where("b is not null"))
    degree = checked.where("links is not null").groupBy("a").agg(F.sum("links").alias("links"))
    named = (classes.join(degree, F.col("a") == F.col("c"), "left").join(comp, F.col("node") == F.col("c"), "left")
             .select("c", "w", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "c").alias("root"), "no", "key"))
    named = graph.saved(named, "ngram-named")
    graph.dropped(classes, checked, comp)
    return seen, named


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per document: ``<id_col>``, ``n_shingles``, ``component_id``, ``n_links``, ``class_id`` (equal sets)."""
    kind = docs.schema[id_col].dataType
    seen, named = _solved(docs, id_col, text_col, percent)
    first = named.groupBy("root").agg(F.min(F.when(~F.col("no"), F.col("key"))).alias("component"))
    told = named.join(first, "root").select("c", "component", (F.col("links") + F.col("w") - 1).alias("n_links"))
    # documents without words have class 0 and don't join
    return seen.join(told, "c", "left").select(
        F.col("row").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component").cast(kind)).otherwise(F.col("row")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"), F.col("c").alias("class_id"))


def one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """The first document (smallest id) of every component, all columns kept; documents without words all stay."""
    seen, named = _solved(docs, id_col, text_col, percent)
    graph.dropped(seen)
    first = named.groupBy("root").agg(F.min(F.struct("no", "key", "c")).alias("x")).select("x.no", "x.key", "x.c")
    rows = _with_sets(docs, id_col, text_col, F.struct("*"))
    found = rows.join(first.withColumn("first", F.lit(True)), ["no", "key", "c"], "left").where("n = 0 or first")
    # a repeated row counts once; documents without words are told apart by their place
    place = F.when(F.col("n") == 0, F.monotonically_increasing_id()).otherwise(F.lit(-1))
    out = found.withColumn("place", place).dropDuplicates(["no", "key", "c", "place"])
    return out.select(*[F.col("row")[c].alias(c) for c in docs.columns])

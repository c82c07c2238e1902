"""Language-model scores of whole texts, and a word-unigram baseline.

The model is one layer of causal self-attention over subword ids, written in
numpy. It predicts a class of the next id (frequent ids are classes of their
own) in two steps, a group of classes and the class in it; the id within its
class comes from the ids' counts over all training documents. Windows of ``2 * STEP`` inputs advance by ``STEP``; each scores the
inputs of its second half (the first window of a text all of its inputs), so
every token is scored once, with between STEP and 2 * STEP inputs of context.
All windows of a batch go through masked attention together. The weights
start from a fit on the ``FIT_DOCS`` training documents with the smallest hash
of id, then learn from every token of all training documents: in each of
``ROUNDS`` rounds every task goes through its share of a part of the documents
from the same weights, and Spark averages the tasks' weights by tokens. Classes
and everything else counted cover the whole corpus.

The baseline needs the training count of each word of each text. A task turns
its documents into chunks of about ``CHUNK_WORDS`` words; a chunk asks for the
counts of its distinct words, packed by hash range. A bucket adds up all
chunks' counts and answers each chunk in the order it asked. Neither the
vocabulary nor a document list ever exists in one place.

Edge cases: a null or empty text has one token, the end. Rows with a null id
are training rows; repeated rows count each. With no training rows counts are
0 and the model is uniform over classes. Words are compared by 64-bit hash.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.llm import textbatch as tb
from sensorflow.llm import tokens
from sensorflow.llm.language_id import held_out
from sensorflow.session import scratch_path

STEP = 16
DIM = 16
OWN_CLASSES = 480
SHARED_CLASSES = 32
GROUP = 16  # classes in a group; divides their number
OWN_INPUTS = 4096
SHARED_INPUTS = 256
FIT_DOCS = 400
FIT_STEPS = 400
FIT_BLOCKS = 128
#: Rounds of learning from all training documents, each from its part of them; blocks of one of its steps.
ROUNDS = 4
ROUND_BLOCKS = 512
#: Weights of a piece that one row carries.
PIECE = 1 << 14
CHUNK_WORDS = 1 << 18
#: Distinct words of one chunk that a bucket answers, about.
BUCKET_WORDS = 1 << 13
END_WORD = np.uint64(0x9D39247E33776D41)
U = np.uint64


# ---- the model -----------------------------------------------------------

@dataclass
class Layout:
    """How ids map to input rows and to classes; ``vocab`` counts all ids, the end included."""
    vocab: int
    row: np.ndarray
    cls: np.ndarray

    @classmethod
    def of(cls, counts: np.ndarray) -> "Layout":
        vocab = len(counts)
        order = np.argsort(-counts, kind="stable")
        rank = np.empty(vocab, np.int64)
        rank[order] = np.arange(vocab)
        every = np.arange(vocab)
        row = np.where(rank < OWN_INPUTS, rank, OWN_INPUTS + every % SHARED_INPUTS)
        own = np.where(rank < OWN_CLASSES, rank, OWN_CLASSES + every % SHARED_CLASSES)
        return cls(vocab, row.astype(np.int32), own.astype(np.int32))

    @property
    def rows(self) -> int:  # the last row is the start of a text
        return OWN_INPUTS + SHARED_INPUTS + 1

    @property
    def classes(self) -> int:
        return OWN_CLASSES + SHARED_CLASSES


def blocks_of(layout: Layout, ids: np.ndarray, off: np.ndarray):
    """Inputs, targets (class, -1 for padding) and "has a block before", in blocks of STEP; and each text's first block."""
    size = np.diff(off)
    count = -(-size // STEP)
    first = np.concatenate([[0], np.cumsum(count)])
    total = int(first[-1])
    start = layout.rows - 1
    x = np.full(total * STEP, start, np.int32)
    y = np.full(total * STEP, -1, np.int32)
    at = tb.ranges(first[:-1] * STEP, size)
    y[at] = layout.cls[ids]
    inner = size - 1
    x[tb.ranges(first[:-1] * STEP + 1, inner)] = layout.row[ids[tb.ranges(off[:-1], inner)]]
    before = np.ones(total, bool)
    before[first[:-1][count > 0]] = False
    return x.reshape(-1, STEP), y.reshape(-1, STEP), before, first


def _mask(before: np.ndarray) -> np.ndarray:
    """(blocks, STEP, 2 STEP): whether an input may see another; the first half is the block before."""
    causal = np.tril(np.ones((STEP, 2 * STEP), bool), STEP)
    return causal[None] & (before[:, None, None] | (np.arange(2 * STEP) >= STEP)[None, None, :])


_DISTANCE = np.clip(STEP + np.arange(STEP)[:, None] - np.arange(2 * STEP)[None, :], 0, 2 * STEP - 1)


class Attention:
    names = ("e", "q", "k", "v", "o", "out", "bias", "top", "top_bias", "rel")

    def __init__(self, rows: int, classes: int, seed: int = 7):
        r = np.random.default_rng(seed)
        w = lambda *s: (r.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.e = (0.3 * r.standard_normal((rows, DIM))).astype(np.float32)
        self.q, self.k, self.v, self.o = (w(DIM, DIM) for _ in range(4))
        self.out = (0.1 * w(DIM, classes)).astype(np.float32)
        self.bias = np.zeros(classes, np.float32)
        self.top = (0.1 * w(DIM, classes // GROUP)).astype(np.float32)
        self.top_bias = np.zeros(classes // GROUP, np.float32)
        self.rel = np.zeros(2 * STEP, np.float32)

    def forward(self, x: np.ndarray, past: np.ndarray, mask: np.ndarray):
        """States of the blocks' inputs ``x``; ``past`` are the inputs of the blocks before."""
        own = self.e[x]
        ctx = np.concatenate([self.e[past], own], 1)
        q, k, v = own @ self.q / np.sqrt(DIM).astype(np.float32), ctx @ self.k, ctx @ self.v
        s = np.where(mask, q @ k.transpose(0, 2, 1) + self.rel[_DISTANCE], np.float32(-1e9))
        a = np.exp(s - s.max(-1, keepdims=True))
        a /= a.sum(-1, keepdims=True)
        z = a @ v
        h = own + z @ self.o
        return h, (own, ctx, q, k, v, a, z)

    def log_probs(self, h: np.ndarray) -> np.ndarray:
        """Log probabilities of all classes after the given states."""
        top, low = log_softmax(h @ self.top + self.top_bias), h @ self.out + self.bias
        low = log_softmax(low.reshape(*h.shape[:-1], -1, GROUP))
        return (top[..., None] + low).reshape(*h.shape[:-1], -1)

    def gradients(self, x, past, mask, y):
        h, (own, ctx, q, k, v, a, z) = self.forward(x, past, mask)
        flat = lambda m: m.reshape(-1, m.shape[-1])
        real = np.flatnonzero(y >= 0)
        n = max(1, len(real))
        order = real[np.argsort((y.reshape(-1)[real] // GROUP).astype(np.uint16), kind="stable")]
        hr, group, rest = flat(h)[order], y.reshape(-1)[order] // GROUP, y.reshape(-1)[order] % GROUP
        row = np.arange(len(real))
        pt = log_softmax(hr @ self.top + self.top_bias)
        dt = np.exp(pt) / np.float32(n)
        dt[row, group] -= np.float32(1 / n)
        g = {"out": np.zeros_like(self.out), "bias": np.zeros_like(self.bias), "top": hr.T @ dt, "top_bias": dt.sum(0)}
        down, total = dt @ self.top.T, pt[row, group].sum()
        cuts = np.searchsorted(group, np.arange(self.top.shape[1] + 1))
        for j in np.flatnonzero(np.diff(cuts)):
            s, c = slice(cuts[j], cuts[j + 1]), slice(j * GROUP, (j + 1) * GROUP)
            pl = log_softmax(hr[s] @ self.out[:, c] + self.bias[c])
            one = np.arange(len(pl))
            total += pl[one, rest[s]].sum()
            dl = np.exp(pl) / np.float32(n)
            dl[one, rest[s]] -= np.float32(1 / n)
            g["out"][:, c], g["bias"][c] = hr[s].T @ dl, dl.sum(0)
            down[s] += dl @ self.out[:, c].T
        loss = -total / n
        dh = np.zeros_like(h)
        flat(dh)[order] = down
        g["o"] = flat(z).T @ flat(dh)
        dz = dh @ self.o.T
        da = dz @ v.transpose(0, 2, 1)
        dv = a.transpose(0, 2, 1) @ dz
        ds = a * (da - (da * a).sum(-1, keepdims=True))
        g["rel"] = np.bincount(_DISTANCE.reshape(-1), ds.sum(0).reshape(-1), 2 * STEP).astype(np.float32)
        dq = ds @ k / np.sqrt(DIM).astype(np.float32)
        dk = ds.transpose(0, 2, 1) @ q * np.float32(1.0)
        g["q"], g["k"], g["v"] = flat(own).T @ flat(dq), flat(ctx).T @ flat(dk), flat(ctx).T @ flat(dv)
        dctx = dk @ self.k.T + dv @ self.v.T
        down = dh + dq @ self.q.T + dctx[:, STEP:]
        seen, moved = np.concatenate([x.reshape(-1), past.reshape(-1)]), np.concatenate([flat(down), flat(dctx[:, :STEP])])
        g["e"] = np.stack([np.bincount(seen, moved[:, j], len(self.e)) for j in range(DIM)], 1).astype(self.e.dtype)
        return loss, g


def log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(-1, keepdims=True)
    return x - np.log(np.exp(x).sum(-1, keepdims=True))


class _Adam:
    def __init__(self, m: Attention):
        self.m, self.t = m, 0
        self.first, self.second = ({n: np.zeros_like(getattr(m, n)) for n in m.names} for _ in range(2))

    def step(self, g: dict[str, np.ndarray], rate: float) -> None:
        self.t += 1
        for n in self.m.names:
            self.first[n] = 0.9 * self.first[n] + 0.1 * g[n]
            self.second[n] = 0.99 * self.second[n] + 0.01 * g[n] ** 2
            move = rate * (self.first[n] / (1 - 0.9**self.t)) / (np.sqrt(self.second[n] / (1 - 0.99**self.t)) + 1e-8)
            setattr(self.m, n, (getattr(self.m, n) - move).astype(np.float32))


def fit_attention(layout: Layout, ids: np.ndarray, off: np.ndarray, steps: int = FIT_STEPS, seed: int = 11) -> Attention:
    """Adam on random blocks of the sample."""
    m = Attention(layout.rows, layout.classes)
    x, y, before, _ = blocks_of(layout, ids, off)
    if not len(x):
        return m
    past = np.concatenate([x[:1], x[:-1]])
    r, adam = np.random.default_rng(seed), _Adam(m)
    for t in range(1, steps + 1):
        pick = r.integers(0, len(x), min(FIT_BLOCKS, len(x)))
        _, g = m.gradients(x[pick], past[pick], _mask(before[pick]), y[pick])
        adam.step(g, 0.02 * min(1, t / 20) * (1 - 0.9 * t / steps))
    return m


def learn_round(chunks: DataFrame, layout: Layout, model: Attention, kind: str, no: int) -> Attention:
    """The model after one round; ``chunks``: chunk, b, c, d of the ``ids`` rows. Every block of a part of the training
    documents is in one step of its task; the driver sees one model, added up from the tasks' by piece."""
    shared = chunks.sparkSession.sparkContext.broadcast((layout, model))
    rate = 0.004 * (1 - no / ROUNDS)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layout, start = shared.value
        m = copy.copy(start)
        adam, weight = _Adam(m), 0
        for batch in it:
            for chunk, b, c, d in zip(*[x.to_pylist() for x in batch.columns]):
                size, ids, mark = _unplanes(b), np.frombuffer(c, kind), np.frombuffer(d, np.uint8)
                use = (mark & 1 == 1) & ((np.arange(len(size)) + chunk) % ROUNDS == no)
                if not use.any():
                    continue
                first = np.concatenate([[0], np.cumsum(size)])[:-1]
                own = ids[tb.ranges(first[use], size[use])].astype(np.int64)
                x, y, before, _ = blocks_of(layout, own, np.concatenate([[0], np.cumsum(size[use])]))
                past = np.concatenate([x[:1], x[:-1]])
                order = np.random.default_rng([chunk, no]).permutation(len(x))
                for pick in np.split(order, range(ROUND_BLOCKS, len(order), ROUND_BLOCKS)):
                    _, g = m.gradients(x[pick], past[pick], _mask(before[pick]), y[pick])
                    adam.step(g, rate * min(1, (adam.t + 1) / 10))
                weight += len(own)
        if weight:
            flat = np.concatenate([getattr(m, n).reshape(-1) for n in m.names])
            cut = range(0, len(flat), PIECE)
            yield pa.RecordBatch.from_arrays([pa.array(range(len(cut)), pa.int32()), pa.array([weight] * len(cut), pa.int64()),
                                              pa.array([flat[x: x + PIECE].astype("<f8").tobytes() for x in cut], pa.binary())], names=["piece", "weight", "v"])

    def add_up(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}  # by piece, of one model
        for batch in it:
            for piece, weight, v in zip(*[x.to_pylist() for x in batch.columns]):
                t = total.setdefault(piece, [0, 0.0])
                t[0], t[1] = t[0] + weight, t[1] + weight * np.frombuffer(v, "<f8")
        for piece, (weight, v) in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([piece], pa.int32()), pa.array([weight], pa.int64()), pa.array([v.astype("<f8").tobytes()], pa.binary())],
                                             names=["piece", "weight", "v"])

    schema = "piece int, weight long, v binary"
    parts = sorted(chunks.mapInArrow(run, schema).repartition("piece").mapInArrow(add_up, schema).collect())
    if not parts:
        return model
    flat, m, at = np.concatenate([np.frombuffer(p["v"], "<f8") / p["weight"] for p in parts]), copy.copy(model), 0
    for n in m.names:
        w = getattr(model, n)
        setattr(m, n, flat[at: at + w.size].reshape(w.shape).astype(np.float32))
        at += w.size
    return m


class Scorer:
    """Log10 probabilities of texts: the class by attention, the id in its class by corpus counts (add one)."""

    def __init__(self, layout: Layout, model: Attention, counts: np.ndarray):
        self.layout, self.m = layout, model
        total = np.bincount(layout.cls, counts + 1.0, layout.classes)
        self.within = np.log10((counts + 1.0) / total[layout.cls])

    def _classes(self, h: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Natural log probabilities of classes ``y`` after states ``h``."""
        m, n = self.m, len(y)
        group = y // GROUP
        order = np.argsort(group.astype(np.uint16), kind="stable")
        h, group, rest = h[order], group[order], (y % GROUP)[order]
        cuts = np.searchsorted(group, np.arange(self.layout.classes // GROUP + 1))
        low = np.empty((n, GROUP), np.float32)
        for k, (a, z) in enumerate(zip(cuts[:-1], cuts[1:])):
            if z > a:
                np.matmul(h[a:z], m.out[:, k * GROUP: (k + 1) * GROUP], out=low[a:z])
                low[a:z] += m.bias[k * GROUP: (k + 1) * GROUP]
        out, row = np.empty(n, np.float32), np.arange(n)
        top = h @ m.top
        top += m.top_bias
        got = top[row, group] + low[row, rest]
        for x in (top, low):
            most = x.max(-1)
            x -= most[:, None]
            np.exp(x, out=x)
            got -= most + np.log(x.sum(-1))
        out[order] = got
        return out

    def score(self, ids: np.ndarray, off: np.ndarray, most: int = 1024) -> np.ndarray:
        x, y, before, first = blocks_of(self.layout, ids, off)
        if not len(x):
            return np.zeros(len(off) - 1)
        m = self.m
        scale = np.float32(1 / np.sqrt(DIM))
        qt, kt, vt = m.e @ m.q * scale, m.e @ m.k, m.e @ m.v @ m.o
        past = np.concatenate([x[:1], x[:-1]])
        value = np.empty(len(x))
        rel = m.rel[_DISTANCE]
        dark = np.where(_mask(np.array([False, True])), rel, np.float32(-1e9)).astype(np.float32)
        for a in range(0, len(x), most):
            s = slice(a, a + most)
            own, old, t = x[s], past[s], y[s]
            both = np.concatenate([old, own], 1)
            att = qt[own] @ kt[both].transpose(0, 2, 1)
            att += dark[before[s].astype(np.int64)]
            att -= att.max(-1, keepdims=True)
            np.exp(att, out=att)
            att /= att.sum(-1, keepdims=True)
            h = (m.e[own] + att @ vt[both]).reshape(-1, DIM)
            real = np.flatnonzero(t.reshape(-1) >= 0)
            p = np.zeros(t.size)
            p[real] = self._classes(h[real], t.reshape(-1)[real])
            value[s] = p.reshape(-1, STEP).sum(1)
        out = np.add.reduceat(value, first[:-1]) / np.log(10)
        return out + np.add.reduceat(self.within[ids], off[:-1])


# ---- the corpus ----------------------------------------------------------

def _planes(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _unplanes(b: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(4, -1).T).view("<u4").reshape(-1).astype(np.int64)


_COLUMNS = [("kind", pa.string()), ("chunk", pa.int64()), ("bucket", pa.int64()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary()), ("d", pa.binary())]
_SCHEMA = "kind string, chunk long, bucket long, a binary, b binary, c binary, d binary"


def _chunks(docs: DataFrame, vocabulary: str, vocab: int, end_id: int, bits: int) -> DataFrame:
    """``docs``: id, train, text -> rows of four kinds.

    ``words``: a chunk's documents (a: ids, d: null marks and training marks) with their word numbers (b: counts, c: numbers).
    ``ask``: distinct words of a chunk in a hash range (a) and their training counts (b).
    ``ids``: the same documents' subword ids (b: counts, c: ids).
    ``seen``: a task's subword counts in training documents (a: ids, b: counts).
    """
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, no = TaskContext.get().partitionId() << 32, 0
        enc = tokens.encoder(vocabulary)
        seen = np.zeros(vocab, np.int64)
        held: list[tuple] = []
        have = 0

        def rows(found):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*found), _COLUMNS)], names=[n for n, _ in _COLUMNS])

        def flush():
            nonlocal held, have, no
            name, null, train, size, h, ids, idn = (np.concatenate(x) for x in zip(*held))
            chunk, out = base + no, []
            uniq, inv = np.unique(h, return_inverse=True)
            learnt = np.bincount(inv[np.repeat(train, size)], minlength=len(uniq))
            about = name.astype("<i8").tobytes()
            marks = (null * 2 + train).astype(np.uint8).tobytes()
            out.append(("words", chunk, 0, about, _planes(size), _planes(inv), marks))
            out.append(("ids", chunk, 0, about, _planes(idn), ids.astype("<u4").tobytes() if vocab > 1 << 16 else ids.astype("<u2").tobytes(), marks))
            bucket = (uniq >> U(64 - bits)).astype(np.int64) if bits else np.zeros(len(uniq), np.int64)
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]])
            for x, y in zip(cuts[:-1], cuts[1:]):
                out.append(("ask", chunk, int(bucket[x]), uniq[x:y].astype("<u8").tobytes(), _planes(learnt[x:y]), b"", b""))
            held, have, no = [], 0, no + 1
            return rows(out)

        for batch in it:
            names = batch.column(0)
            null = np.asarray(names.is_null())
            name = names.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            train = np.asarray(batch.column(1).to_numpy(zero_copy_only=False), bool)
            raw, off = tb.text_buffers(batch.column(2))
            for a, z in tb.slices(off):
                _, _, h, first = tb.words(raw[off[a]: off[z]], off[a: z + 1] - off[a])
                h = np.insert(h, first[1:], END_WORD)
                ids, at = tokens.with_end(*enc.encode_bytes(raw[off[a]: off[z]], off[a: z + 1] - off[a]), end_id)
                seen += np.bincount(ids[np.repeat(train[a:z], np.diff(at))], minlength=vocab)
                held.append((name[a:z], null[a:z], train[a:z], np.diff(first) + 1, h, ids.astype(np.uint32), np.diff(at)))
                have += len(h)
                if have >= CHUNK_WORDS:
                    yield flush()
        if held:
            yield flush()
        some = np.flatnonzero(seen)
        yield rows([("seen", base, 0, some.astype("<u4").tobytes(), seen[some].astype("<u8").tobytes(), b"", b"")])

    return docs.mapInArrow(run, _SCHEMA)


def _answers(asked: DataFrame) -> DataFrame:
    """Per (chunk, bucket) the corpus counts of the words asked for; and per bucket (chunk -1) its training tokens and distinct words."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(bucket, held):
            h = [np.frombuffer(x[1], "<u8") for x in held]
            size = np.array([len(x) for x in h])
            _, inv = np.unique(np.concatenate(h), return_inverse=True)
            total = np.bincount(inv, np.concatenate([_unplanes(x[2]) for x in held])).astype(np.int64)
            got = np.split(total[inv], np.cumsum(size)[:-1])
            tokens_, distinct = int(total.sum()), int((total > 0).sum())
            return pa.RecordBatch.from_arrays(
                [pa.array([*[x[0] for x in held], -1], pa.int64()), pa.array([bucket] * (len(held) + 1), pa.int64()),
                 pa.array([*[_planes(np.minimum(x, 2**32 - 1)) for x in got], None], pa.binary()),
                 pa.array([None] * len(held) + [tokens_], pa.int64()), pa.array([None] * len(held) + [distinct], pa.int64())],
                names=["chunk", "bucket", "counts", "n", "v"])
        now, held = None, []
        for batch in it:
            for bucket, chunk, a, b in zip(*[c.to_pylist() for c in batch.columns]):
                if bucket != now and held:
                    yield out(now, held)
                    held = []
                now = bucket
                held.append((chunk, a, b))
        if held:
            yield out(now, held)

    return (asked.select("bucket", "chunk", "a", "b").repartition("bucket").sortWithinPartitions("bucket", "chunk")
            .mapInArrow(run, "chunk long, bucket long, counts binary, n long, v long"))


def _documents(a: bytes, d: bytes):
    mark = np.frombuffer(d, np.uint8)
    return pa.array(np.frombuffer(a, "<i8"), pa.int64(), mask=mark >= 2), (mark & 1) == 0


def score_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", fit_docs: int = FIT_DOCS) -> DataFrame:
    """``<id_col>``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``, ``n_subwords``."""
    spark = docs.sparkSession
    from tokenizers import Tokenizer

    end_id = Tokenizer.from_file(vocabulary).get_vocab_size()  # an id of its own
    vocab = end_id + 1
    base = docs.select(F.col(id_col).cast("long").alias("id"), (~held_out(id_col, 7, 2)).alias("train"), F.col(text_col).alias("text"))

    def sample_ids(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for a, z, ids, off in tokens.encoded_slices(batch.column(1), vocabulary, end_id):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, z - a),
                                                  pa.array([ids[x:y].astype("<u4").tobytes() for x, y in zip(off[:-1], off[1:])], pa.binary())], names=["h", "ids"])

    chosen = (base.where("train and id is not null").select("id", F.xxhash64("id").alias("h")).distinct().orderBy("h", "id").limit(fit_docs))
    sample = base.join(F.broadcast(chosen), "id").select("h", "text").repartition(8)
    got = sorted((r["h"], bytes(r["ids"])) for r in sample.mapInArrow(sample_ids, "h long, ids binary").collect())[: 2 * fit_docs]
    ids = [np.frombuffer(b, "<u4") for _, b in got]
    flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
    off = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64)

    words = base.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    # distinct words of all chunks, at a sixth of a word per six bytes, in buckets of a few thousand a chunk
    bits = max(0, min(20, int(np.ceil(np.log2(max(1, words / (BUCKET_WORDS * 512)))))))
    path = scratch_path(spark, "lm-chunks")
    # a writer for each kind, so that no task sorts its rows by kind first
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", "4")
    _chunks(base, vocabulary, vocab, end_id, bits).write.partitionBy("kind").parquet(path)
    table = spark.read.schema(_SCHEMA.replace("kind string, ", "") + ", kind string").parquet(path)

    seen = np.zeros(vocab, np.float64)
    one = table.where("kind = 'seen'").select("a", "b")

    def unpacked(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for a, b in zip(*[c.to_pylist() for c in batch.columns]):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(a, "<u4").astype(np.int64)), pa.array(np.frombuffer(b, "<u8").astype(np.int64))], names=["i", "n"])

    for r in one.mapInArrow(unpacked, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).collect():  # at most the vocabulary
        seen[r["i"]] = r["n"]

    layout = Layout.of(seen)
    model = fit_attention(layout, flat, off)
    kind = "<u4" if vocab > 1 << 16 else "<u2"
    for no in range(ROUNDS):
        model = learn_round(table.where("kind = 'ids'").select("chunk", "b", "c", "d"), layout, model, kind, no)

    answered = scratch_path(spark, "lm-answers")
    _answers(table.where("kind = 'ask'")).write.parquet(answered)
    answers = spark.read.parquet(answered)
    sums = answers.where("chunk = -1").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    n_train, n_distinct = int(sums["n"] or 0), int(sums["v"] or 0)
    share = np.log10(n_train + n_distinct + 1.0)

    def baseline(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for chunk, a, b, c, d, replies in zip(*[x.to_pylist() for x in batch.columns]):
                doc, out = _documents(a, d)
                size, inv = _unplanes(b), _unplanes(c)
                count = np.concatenate([_unplanes(r["counts"]) for r in replies])
                first = np.concatenate([[0], np.cumsum(size)[:-1]])
                p = np.log10(count + 1.0) - share
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(size), chunk)), pa.array(np.arange(len(size))), doc, pa.array(out), pa.array(size),
                     pa.array(np.add.reduceat((count > 0).astype(np.int64)[inv], first)), pa.array(np.add.reduceat(p[inv], first))],
                    names=["chunk", "no", "id", "held_out", "n_tokens", "n_known", "base_score"])

    replies = (answers.where("chunk >= 0").groupBy("chunk")  # the distinct words of one chunk
               .agg(F.sort_array(F.collect_list(F.struct("bucket", "counts"))).alias("replies")))
    words_of = table.where("kind = 'words'").join(replies, "chunk").select("chunk", "a", "b", "c", "d", "replies")
    counted = words_of.mapInArrow(baseline, "chunk long, no long, id long, held_out boolean, n_tokens long, n_known long, base_score double")

    shared = spark.sparkContext.broadcast(Scorer(layout, model, seen))

    def attention(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = shared.value
        for batch in it:
            for chunk, b, c in zip(*[x.to_pylist() for x in batch.columns]):
                size, ids = _unplanes(b), np.frombuffer(c, kind).astype(np.int64)
                off = np.concatenate([[0], np.cumsum(size)])
                score = np.empty(len(size))
                for a, z in tb.slices(off, 1 << 18):
                    score[a:z] = scorer.score(ids[off[a]: off[z]], off[a: z + 1] - off[a])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(size), chunk)), pa.array(np.arange(len(size))), pa.array(score), pa.array(size)],
                                                 names=["chunk", "no", "score", "n_subwords"])

    scored = table.where("kind = 'ids'").select("chunk", "b", "c").mapInArrow(attention, "chunk long, no long, score double, n_subwords long")
    return counted.join(scored, ["chunk", "no"]).select(
        F.col("id").alias(id_col), "held_out", "n_tokens", "n_known", F.lit(n_train).cast("long").alias("train_tokens"), "base_score", "score", "n_subwords")

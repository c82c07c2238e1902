"""Hierarchical language identification with linear support vector machines.

Languages are grouped into families by the similarity of their mean n-gram
profiles. One-versus-rest machines pick the family; inside it a machine for
every two languages casts a soft vote. Features are counts of letter 2- and
3-grams (with word borders) of the lower-cased UTF-8 text, hashed into
``DIM`` cells and divided by their number; as a machine is linear, a text's
value is the mean weight of its n-grams, so whole texts of any length are
judged in one pass and in bounded memory.

Only fitting uses a sample: the ``SAMPLE_PER_LANG`` labelled rows of each
language with the smallest hash of id. The model is a few hundred kB.

Edge cases: a null text or one without a letter is ``und`` with score 0; with
no labelled rows every text is ``und``; with one language every text with a
letter has that language and score 1. Rows with a null label are never learnt
from; repeated rows are judged alike.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from sensorflow.llm import textbatch as tb
from sensorflow.llm.columns import fresh

DIM = 1 << 13
SAMPLE_PER_LANG = 200
EPOCHS = 12
LEAST_SCORE = 0.3
LETTER = re.compile(r"[^\W\d_]")


def grams(raw: np.ndarray, off: np.ndarray):
    """Feature cell of every 2- and 3-gram, and each text's offsets among them.

    Runs of bytes that are neither ASCII letters nor part of a non-ASCII
    character count as one border, so counts of digits and signs don't matter.
    """
    low = tb.LOWER[raw].astype(np.uint32)
    plain = ~(((low >= 97) & (low <= 122)) | (low >= 128))
    low[plain] = 32
    n = len(low)
    keep = np.ones(n, bool)
    keep[1:] = ~(plain[1:] & plain[:-1])
    keep[off[:-1][off[:-1] < n]] = True
    pos = np.zeros(n + 1, np.int64)
    np.cumsum(keep, out=pos[1:])
    low, at = low[keep], pos[off]
    m = len(low)
    two = low[:-1] * np.uint32(256) + low[1:] if m > 1 else low[:0]
    three = two[:-1] * np.uint32(256) + low[2:] if m > 2 else low[:0]
    cell = lambda x, k: ((x * np.uint32(2654435761) + np.uint32(k)) >> np.uint32(19)).astype(np.int64)

    def span(w):  # an n-gram never leaves its text
        top = max(0, m - w + 1)
        return np.minimum(at[:-1], top), np.minimum(np.maximum(at[1:] - w + 1, at[:-1]), top)
    return (cell(two, 1), *span(2)), (cell(three, 2 << 20), *span(3))


def _totals(w: np.ndarray, cells: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    c = np.zeros(len(cells) + 1)
    np.cumsum(w[cells], out=c[1:])
    return c[b] - c[a]


@dataclass
class Model:
    langs: list[str]
    family: list[int]
    top: np.ndarray  # families x (DIM + 1), last column the bias
    inner: dict[int, np.ndarray]  # family -> pairs of its languages x (DIM + 1), pairs in order of combinations()

    def margins(self, raw, off) -> tuple[np.ndarray, dict[int, np.ndarray]]:
        sets = grams(raw, off)
        size = np.maximum(sum(b - a for _, a, b in sets), 1)

        def of(w):
            return np.stack([sum(_totals(v[:-1], *s) for s in sets) / size + v[-1] for v in w], 1)
        return of(self.top) if len(self.top) else np.zeros((len(size), 1)), {f: of(w) for f, w in self.inner.items()}

    def predict(self, raw, off) -> tuple[np.ndarray, np.ndarray]:
        """Index of the language and a score in 0..1: the family's share times the language's mean vote."""
        top, inner = self.margins(raw, off)
        soft = lambda m: (lambda e: e / e.sum(1, keepdims=True))(np.exp(4 * (m - m.max(1, keepdims=True))))
        share = soft(top)
        fam = share.argmax(1)
        score = share.max(1)
        lang = np.zeros(len(fam), np.int64)
        for f in range(max(self.family) + 1):
            own = [i for i, x in enumerate(self.family) if x == f]
            rows = fam == f
            if f in inner:
                votes = np.zeros((rows.sum(), len(own)))
                for k, (i, j) in enumerate(combinations(range(len(own)), 2)):
                    first = 1 / (1 + np.exp(-8 * inner[f][rows, k]))
                    votes[:, i] += first
                    votes[:, j] += 1 - first
                votes /= len(own) - 1
                lang[rows] = np.array(own)[votes.argmax(1)]
                score[rows] *= votes.max(1)
            else:
                lang[rows] = own[0]
        return lang, score


def _svm(x: np.ndarray, of: np.ndarray, y: np.ndarray, seed: int, lam: float = 1e-4, epochs: int = EPOCHS) -> np.ndarray:
    """A linear machine on rows ``of`` of x by averaged stochastic sub-gradient steps on the hinge loss, classes weighted
    evenly; the last weight is the bias."""
    rng, n = np.random.default_rng(seed), len(y)
    w, avg, t = np.zeros(x.shape[1] + 1), np.zeros(x.shape[1] + 1), 0
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())) * n
    for _ in range(epochs):
        order = rng.permutation(n)
        for rows in np.array_split(order, max(1, n // 16)):
            t += 1
            step = 1 / (lam * (t + 100))
            part = x[of[rows]]
            hit = (part @ w[:-1] + 0.1 * w[-1]) * y[rows] < 1
            w *= 1 - step * lam
            if hit.any():
                r = rows[hit]
                pull = y[r] * weight[r] * step / len(rows)
                w[:-1] += pull @ part[hit]
                w[-1] += 0.1 * pull.sum()
            norm = np.sqrt(lam) * np.linalg.norm(w)
            if norm > 1:
                w /= norm
            avg += (w - avg) / t
    return avg


def families(mean: np.ndarray) -> list[int]:
    """Group languages: average-link merging of mean profiles (cosine) down to about the square root of their number."""
    n = len(mean)
    unit = mean - mean.mean(0)
    unit /= np.maximum(np.linalg.norm(unit, axis=1, keepdims=True), 1e-12)
    sim, groups = unit @ unit.T, [[i] for i in range(n)]
    while len(groups) > max(1, round(np.sqrt(n))):
        pairs = [(sim[np.ix_(a, b)].mean(), i, j) for i, a in enumerate(groups) for j, b in enumerate(groups) if i < j]
        _, i, j = max(pairs)
        groups[i] += groups.pop(j)
    out = [0] * n
    for f, g in enumerate(groups):
        for i in g:
            out[i] = f
    return out


def features(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    sets = grams(raw, off)
    out = np.zeros((len(off) - 1, DIM))
    for cells, a, b in sets:
        for d in range(len(a)):
            out[d] += np.bincount(cells[a[d]: b[d]], minlength=DIM)
    return out / np.maximum(out.sum(1, keepdims=True), 1)


def fit(x: np.ndarray, lang: list[str]) -> Model | None:
    langs = sorted(set(lang))
    if not langs:
        return None
    y = np.array([langs.index(v) for v in lang])
    scale = 1 / max(1e-9, np.sqrt(np.einsum("ij,ij->i", x, x).mean()))
    fam = families(np.stack([x[y == i].mean(0) for i in range(len(langs))]))

    x = x * np.float32(scale)

    def machine(rows, positive, seed):
        w = _svm(x, rows, np.where(positive[rows], 1.0, -1.0), seed)
        w[:-1] *= scale
        w[-1] *= 0.1
        return w
    fy = np.array(fam)[y]
    every = np.arange(len(y))
    top = np.stack([machine(every, fy == f, f) for f in range(max(fam) + 1)]) if max(fam) else np.zeros((0, DIM + 1))
    inner = {}
    for f in range(max(fam) + 1):
        pairs = list(combinations([i for i, g in enumerate(fam) if g == f], 2))
        if pairs:
            inner[f] = np.stack([machine(np.flatnonzero((y == i) | (y == j)), y == i, i * len(langs) + j) for i, j in pairs])
    return Model(langs, fam, top, inner)


def fit_model(labelled: DataFrame, id_col: str, text_col: str, lang_col: str, per_lang: int = SAMPLE_PER_LANG) -> Model | None:
    """Fit on at most ``per_lang`` rows of each language that have a label and a text (smallest hash of the id); of equal
    rows one counts."""
    w = Window.partitionBy(lang_col).orderBy("_h", id_col, "_t")
    named = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).withColumn("_t", F.xxhash64(text_col))
    row = [lang_col, "_no", "_id", "_t"]
    named = named.withColumns({"_no": F.col(id_col).isNull(), "_id": F.coalesce(F.col(id_col).cast("string"), F.lit(""))})
    chosen = (named.withColumn("_h", F.xxhash64("_id")).select(*row, id_col, "_h")
              .withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= per_lang).select(*row).distinct())
    # at most per_lang rows a language are chosen; equal rows are one before they are shuffled
    rows = named.join(F.broadcast(chosen), row).groupBy(*row).agg(F.first(text_col).alias(text_col)).select(F.col(lang_col).alias("_lang"), text_col)

    def vectors(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            raw, off = tb.text_buffers(b.column(1))
            x = features(raw, off)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([v.astype(np.float32).tobytes() for v in x], pa.binary())], ["lang", "x"])

    got = rows.repartition(8).mapInArrow(vectors, "lang string, x binary").collect()  # at most per_lang rows a language
    got.sort(key=lambda r: (r["lang"], bytes(r["x"])))
    if not got:
        return None
    x = np.empty((len(got), DIM), np.float32)
    for i, r in enumerate(got):
        x[i] = np.frombuffer(r["x"], np.float32)
    lang = [r["lang"] for r in got]
    del got
    return fit(x, lang)


def identify(docs: DataFrame, model: Model | None, text_col: str = "text", pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """All columns of ``docs`` with the predicted language and its score under the given names."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text"))
    out = StructType([rows.schema["row"], StructField("pred", StringType()), StructField("score", DoubleType())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in it:
            col = b.column(1)
            texts = col.to_pylist()
            letter = np.array([t is not None and LETTER.search(t) is not None for t in texts], bool)
            lang, value = np.zeros(len(texts), np.int64), np.zeros(len(texts))
            if m is not None:
                raw, off = tb.text_buffers(col)
                for a, z in tb.slices(off):
                    lang[a:z], value[a:z] = m.predict(raw[off[a]: off[z]], off[a: z + 1] - off[a])
            names = np.array([*(m.langs if m else []), "und"], object)
            known = letter & (m is not None)
            named = names[np.where(known, lang, len(names) - 1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(named, pa.string()), pa.array(np.where(known, value, 0.0), pa.float64())],
                                             names=["row", "pred", "score"])

    found = rows.mapInArrow(run, out)
    return found.select(*[F.col("row")[c].alias(c) for c in docs.columns], F.col("pred").alias(pred), F.col("score").alias(score))


def held_out(id_col: str, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves ``remainder``; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learn from rows that are not held out, judge all: id, ``held_out``, ``lang_pred``, ``score``."""
    out = held_out(id_col, 4, 2)
    model = fit_model(docs.select(id_col, text_col, lang_col).where(~out), id_col, text_col, lang_col)
    return identify(docs.select(id_col, text_col), model, text_col).select(id_col, out.alias("held_out"), "lang_pred", "score")


def recognised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", least: float = LEAST_SCORE) -> DataFrame:
    """The documents whose language is recognised (a learned language, with a score of at least ``least``), unchanged."""
    model = fit_model(docs.select(id_col, text_col, lang_col), id_col, text_col, lang_col)
    pred, score = fresh(docs.columns, "pred"), fresh(docs.columns, "score")
    told = identify(docs, model, text_col, pred, score)
    return told.where((F.col(pred) != "und") & (F.col(score) >= least)).drop(pred, score)

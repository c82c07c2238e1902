import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sensorflow.llm import centroid_clustering as cc
from sensorflow.llm import importance_resampling as ir
from sensorflow.llm import simhash_dedup as sd
from sensorflow.llm import textbatch as tb
from sensorflow.llm import xxh64
from tests.llm.helpers import ODD, documents, edited, prose, words


def fingerprint(text):
    w = [x.encode() for x in words(text)]
    runs = [b" ".join(w[i: i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(x, 42) for x in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(rows, radius=4):
    fps = [fingerprint(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for i in range(len(rows)):
        for j in range(i + 1, len(rows)):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                up[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[find(i)] = min(k, least.get(find(i), k))
    return sorted(((k, f"{f:016x}", least.get(find(i))) for i, ((k, _), f) in enumerate(zip(rows, fps))), key=str)


def test_hash_equals_library():
    r = random.Random(3)
    raw = np.frombuffer(r.randbytes(20000), np.uint8)
    size = np.array([r.randrange(0, 100) for _ in range(4000)] + [600, 5000])
    start = np.array([r.randrange(0, 15000) for _ in size])
    assert xxh64.hashes(raw, start, size).tolist() == [xxhash.xxh64_intdigest(raw[s: s + n].tobytes(), 42) for s, n in zip(start, size)]


def near_copies():
    base = prose(5, 900)
    rows = [(1000 + k, " ".join(edited(base, k, 1 + k % 30))) for k in range(150)]  # one large group of near copies
    rows += [(3000 + k, " ".join(base).upper()) for k in range(30)] + [(20 + k, "\t " + " \n".join(prose(k, 300)) + "\x0b") for k in range(40)]
    rows += [(200 + k, " ".join(edited(prose(k, 300), k, 2))) for k in range(40)]
    return rows + [(7, "a b c"), (8, "A  b\tc"), (9, "a b c d")] + ODD


@pytest.mark.parametrize("cell", [sd.CELL, 20])
def test_simhash_equals_brute_force(spark, monkeypatch, cell):
    monkeypatch.setattr(sd, "CELL", cell)  # at 20, crowded cells are cut into blocks
    rows = near_copies()
    out = sd.near_duplicates(documents(spark, rows))
    assert out.columns == ["doc_id", "fingerprint", "component_id"]
    want = components(rows)
    assert sorted(map(tuple, out.collect()), key=str) == want
    assert 30 < len({c for _, _, c in want}) < len(rows)


def test_simhash_cells_find_all_pairs(spark):
    """Every pair at four bits shares a cell, wherever the bits are."""
    r = random.Random(9)
    fps = set()
    for _ in range(300):
        x = r.getrandbits(64)
        y = x
        for b in r.sample(range(64), r.randint(1, 4)):
            y ^= 1 << b
        fps |= {x, y}
    fps |= {0, 2**64 - 1, 15, 2**64 - 16, 2**63}
    df = spark.createDataFrame([(x - 2**64 if x >> 63 else x,) for x in fps], "fp bigint")
    got = {tuple(sorted(p)) for p in sd.linked(df).distinct().collect()}
    signed = sorted(x - 2**64 if x >> 63 else x for x in fps)
    want = {(a, b) for i, a in enumerate(signed) for b in signed[i + 1:] if ((a ^ b) & (2**64 - 1)).bit_count() <= 4}
    assert got == want
    with pytest.raises(ValueError):
        sd.linked(df, 5)


def test_simhash_empty_and_clashing_columns(spark):
    assert sd.near_duplicates(documents(spark, [])).collect() == []
    df = spark.createDataFrame([(1, "x y z", 5, "q"), (2, None, 6, None)], "doc_id int, text string, fp int, component_id string")
    assert sorted(map(tuple, sd.near_duplicates(df).collect())) == sorted((k, f"{fingerprint(t):016x}", k) for k, t in ((1, "x y z"), (2, None)))


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, runs):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return [" ".join(w[i: i + n]) for n in range(1, runs + 1) for i in range(len(w) - n + 1)], len(w)


def resampled(rows, target, runs=1, buckets=10_000, least=20, percent=10):
    count = [[0] * buckets, [0] * buckets]
    for side, texts in enumerate(([t for _, t in rows], target)):
        for t in texts:
            for f in features(t, runs)[0]:
                count[side][zlib.crc32(f.encode()) % buckets] += 1
    s_all, t_all = (float(sum(c)) for c in count)
    gain = [math.floor(1000 * math.log((t + 1.0) * (s_all + buckets) / ((s + 1.0) * (t_all + buckets)))) for s, t in zip(*count)]
    out = []
    for k, t in rows:
        f, n = features(t, runs)
        w = sum(gain[zlib.crc32(x.encode()) % buckets] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if k is None else k}".encode()).hexdigest()[:8], 16)
        out.append([k, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    best = sorted((x for x in out if x[5] >= least), key=lambda x: (-x[3], x[0] is None, x[0], x[1]))
    for i, x in enumerate(best[: len(best) * percent // 100]):
        x[4] = i + 1
    return sorted((tuple(x[:5]) for x in out), key=str)


def texts():
    rows = [(k, " ".join(prose(k, 15 + k % 40)) + " Ärger, 42nd-STREET x" * (k % 3)) for k in range(400)]
    rows += [(5, rows[5][1])] * 30 + [(600 + k, " ".join(prose(1, 30))) for k in range(50)]  # repeated rows, equal texts
    return rows + ODD + [(9010, "w" * 70 + " " + "é" * 200 + " " + "z1 " * 4000)]


@pytest.mark.parametrize("runs,buckets,least,percent", [(1, 10_000, 20, 10), (2, 300, 0, 55), (3, 1000, 20, 100), (1, 50, 10_000, 10)])
def test_resampling_equals_brute_force(spark, runs, buckets, least, percent):
    rows, target = texts(), [" ".join(prose(k, 60)) for k in range(0, 40, 2)] + [None, ""]
    got = ir.resample(documents(spark, rows), spark.createDataFrame([(t,) for t in target], "text string"), runs=runs, buckets=buckets, least_words=least, percent=percent)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=str) == resampled(rows, target, runs, buckets, least, percent)


def test_resampling_empty_tables(spark):
    docs, none = documents(spark, texts()), documents(spark, [])
    assert ir.resample(none, docs).collect() == []
    assert sorted(map(tuple, ir.resample(docs, none).collect()), key=str) == resampled(texts(), [])


@pytest.mark.parametrize("values", [list(range(1000)), [5] * 900 + [9] * 30 + [1] * 70, [1, 2]])
@pytest.mark.parametrize("error", [0.001, 0.05, 0.4])
def test_bracket_holds_the_cutoff(spark, values, error):
    df = spark.createDataFrame([(v,) for v in values], "score bigint")
    down = sorted(values, reverse=True)
    for k in {1, 2, len(values) // 10 or 1, len(values) // 2, len(values)}:
        low, high, above = ir.bracket(df, "score", len(values), k, error)
        assert low <= down[k - 1] <= high and above == sum(v > high for v in values) < k


def test_bracket_is_widened_when_counts_refute_it():
    """A sketch that proposes the wrong end first."""
    class Wrong:
        def __init__(self, df):
            self.df, self.asked = df, 0

        def approxQuantile(self, *a):
            self.asked += 1
            return [0, 3] if self.asked == 1 else self.df.approxQuantile(*a)

        def agg(self, *a):
            return self.df.agg(*a)
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    w = Wrong(spark.range(1000).withColumnRenamed("id", "score"))
    low, high, above = ir.bracket(w, "score", 1000, 100)
    assert w.asked > 1 and low <= 900 <= high and above == 999 - high


def lloyd(rows, k, rounds, dims, scale, seed):
    ok = [(i, np.floor(scale * np.array(v, float)).astype(int)) for i, v in rows if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    x = np.array([v for _, v in ok])
    first = sorted(range(len(ok)), key=lambda i: (ok[i][0] is None, hashlib.sha256(f"{seed}:{ok[i][0]}".encode()).hexdigest(), x[i].tolist()))
    c = x[first[:k]].copy()

    def nearest():
        d = np.stack([((x - row) ** 2).sum(1) for row in c], 1)
        return d.argmin(1), d.min(1)
    for _ in range(rounds):
        a, _d = nearest()
        for j in range(len(c)):
            if (a == j).any():
                c[j] = np.floor_divide(x[a == j].sum(0), (a == j).sum())
    a, d = nearest()
    return sorted(((i, int(j), int(e), int(d[a == j].sum()), int(d.sum()), hashlib.sha256(",".join(map(str, c[j])).encode()).hexdigest())
                   for (i, _), j, e in zip(ok, a, d)), key=str)


@pytest.mark.parametrize("big", [1.0, 100_000.0])
@pytest.mark.parametrize("shards", [1, 3])
def test_lloyd_equals_brute_force(spark, monkeypatch, big, shards):
    monkeypatch.setattr(cc, "CHUNK", 64)
    r = np.random.default_rng(4)
    rows = [(k, (big * r.normal(k % 5, 0.3, 10)).tolist()) for k in range(500)] + [(1000 + k, [big * 0.5] * 10) for k in range(200)]
    rows += [(3, rows[3][1]), (3, [0.1] * 10), (None, [1.0] * 10), (2000, None), (2001, [1.0] * 9), (2002, [1.0] * 9 + [None]), (2003, [float("nan")] * 10),
             (2004, [float("-inf")] + [0.0] * 9), (2005, [])]
    df = spark.createDataFrame([(*x, 1, "z") for x in rows], "vec_id bigint, embedding array<double>, chunk int, shard string").repartition(3)
    for k, rounds in ((7, 3), (5000, 0)):
        got = cc.cluster_report(df, k=k, rounds=rounds, dims=10, shards=shards).collect()
        assert sorted(map(tuple, got), key=str) == lloyd(rows, k, rounds, 10, 256.0, 2)


def test_lloyd_empty_and_too_large(spark):
    df = spark.createDataFrame([(1, [float(1 << 20)] * 64)], "vec_id bigint, embedding array<float>")
    assert cc.cluster_report(df.limit(0)).collect() == []
    assert cc.cluster_report(df.select("vec_id", F.array(F.lit(1.0)).alias("embedding"))).collect() == []
    with pytest.raises(Exception, match="beyond"):
        cc.cluster_report(df)


def test_crc_runs_equal_library():
    raw = b"one two  Three " + b"x" * 300 + " ünd".encode()
    r, off = np.frombuffer(raw, np.uint8), np.array([0, len(raw)])
    text, bucket, n = ir.features(r, off, 2, 1000)
    f, count = features(raw.decode(), 2)
    assert n.tolist() == [count] and sorted(bucket.tolist()) == sorted(zlib.crc32(x.encode()) % 1000 for x in f) and not text.any()
    assert tb.words(r, off, tb.IS_SIGN)[0].tolist()[:2] == [0, 4]

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from sensorflow.llm import language_id, lm_scoring
from tests.llm.helpers import ODD, documents, prose, words

BYTE = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.01"


def test_gradients_and_scores_match_the_plain_form():
    lay = lm_scoring.Layout.of(np.arange(300)[::-1].copy())
    r = np.random.default_rng(0)
    ids, off = r.integers(0, 300, 200), np.array([0, 50, 51, 120, 200])
    m = lm_scoring.Attention(lay.rows, lay.classes)
    for n in m.names:
        setattr(m, n, getattr(m, n).astype(float))
    x, y, before, first = lm_scoring.blocks_of(lay, ids, off)
    past, mask = np.concatenate([x[:1], x[:-1]]), lm_scoring._mask(before)
    _, g = m.gradients(x, past, mask, y)
    for n in m.names:
        w = getattr(m, n)
        i = (int(x[3, 2]), 3) if n == "e" else (2, 5) if w.ndim == 2 else (3,)
        keep, loss = w[i], []
        for d in (1e-5, -1e-5):
            w[i] = keep + d
            loss.append(m.gradients(x, past, mask, y)[0])
        w[i] = keep
        assert (loss[0] - loss[1]) / 2e-5 == pytest.approx(g[n][i], rel=1e-2, abs=1e-7)
    counts = r.integers(0, 50, 300).astype(float)
    scorer = lm_scoring.Scorer(lay, m, counts)
    p = m.log_probs(m.forward(x, past, mask)[0])
    assert np.allclose(np.exp(p).sum(-1), 1)
    for t, got in enumerate(scorer.score(ids, off)):
        real = sum(p[b, j, y[b, j]] for b in range(first[t], first[t + 1]) for j in range(lm_scoring.STEP) if y[b, j] >= 0)
        assert got == pytest.approx(real / np.log(10) + scorer.within[ids[off[t]: off[t + 1]]].sum(), rel=1e-5)


def test_probabilities_of_the_next_token_sum_to_one():
    n = 2000  # more ids than classes, so that no class is empty
    lay = lm_scoring.Layout.of(np.arange(n)[::-1].copy())
    scorer = lm_scoring.Scorer(lay, lm_scoring.Attention(lay.rows, lay.classes), np.ones(n))
    prefix = [5, 250, 17]
    before = scorer.score(np.array(prefix), np.array([0, 3]))[0]
    texts = np.array([[*prefix, k] for k in range(n)]).reshape(-1)
    assert (10 ** (scorer.score(texts, np.arange(n + 1) * 4) - before)).sum() == pytest.approx(1, abs=1e-3)


def test_baseline_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "CHUNK_WORDS", 500)
    monkeypatch.setattr(lm_scoring, "BUCKET_WORDS", 1)
    rows = [(k, " ".join(prose(k % 9, 10 + k))) for k in range(60)] + ODD
    got = lm_scoring.score_documents(documents(spark, rows), BYTE, fit_docs=20).collect()
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    c = Counter(w for i, t in rows if not out(i) for w in [*words(t), None])
    n, v = sum(c.values()), len(c)
    want = Counter()
    for i, t in rows:
        ws = [*words(t), None]
        want[str((i, out(i), len(ws), sum(c[w] > 0 for w in ws), n, round(sum(np.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6)))] += 1
    have = Counter(str((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6))) for r in got)
    assert have == Counter({k.replace("np.float64(", "").replace("))", ")"): x for k, x in want.items()})
    assert all(r["score"] < 0 and np.isfinite(r["score"]) for r in got)


def test_attention_learns_order(spark):
    """A trained model prefers real texts to the same words shuffled."""
    rows = [(k, " ".join(["alpha beta gamma delta epsilon zeta"] * 20)) for k in range(40)]
    mixed = [(100 + k, " ".join(["epsilon alpha zeta gamma beta delta"] * 20)) for k in range(3) if zlib.crc32(str(100 + k).encode()) % 7 == 2] or [(2, "")]
    held = next(k for k in range(1000, 2000) if zlib.crc32(str(k).encode()) % 7 == 2)
    mixed = [(held, " ".join(["epsilon alpha zeta gamma beta delta"] * 20))]
    got = {r["doc_id"]: r["score"] for r in lm_scoring.score_documents(documents(spark, rows + mixed), BYTE).collect()}
    assert got[0] > got[held] + 10


def test_weights_learn_from_documents_outside_the_sample(spark, monkeypatch):
    """Without any sample the rounds over all training documents teach the order of words."""
    monkeypatch.setattr(lm_scoring, "ROUND_BLOCKS", 2)
    held = [k for k in range(1000, 2000) if zlib.crc32(str(k).encode()) % 7 == 2][:2]
    real, mixed = "alpha beta gamma delta epsilon zeta", "epsilon alpha zeta gamma beta delta"
    rows = [(k, " ".join([real] * 20)) for k in range(300) if zlib.crc32(str(k).encode()) % 7 != 2]
    rows += [(held[0], " ".join([real] * 20)), (held[1], " ".join([mixed] * 20))]
    got = {r["doc_id"]: r["score"] for r in lm_scoring.score_documents(documents(spark, rows), BYTE, fit_docs=0).collect()}
    assert got[held[0]] > got[held[1]] + 10


def test_empty_tables(spark):
    none = documents(spark, [])
    assert lm_scoring.score_documents(none, BYTE).collect() == []
    assert language_id.language_id(none).collect() == []
    assert language_id.recognised(none).collect() == []


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = language_id.language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    held = got[got.held_out]
    assert len(held) > 100 and (held.lang == held.lang_pred).mean() >= 0.98
    assert got.score.between(0, 1).all()


def test_language_edge_cases(spark):
    rows = [(k, " ".join(prose(k, 60, "zq" if k % 2 else "")), "aa" if k % 2 else "bb", "s", 0) for k in range(40)]
    rows += [(50, None, "aa", "s", 0), (51, "123 !!", "aa", "s", 0), (52, "zqba zqke", None, "s", 0), (None, "bakeli", "bb", "s", 0), (53, "", None, None, None)]
    docs = documents(spark, rows)
    got = {r["doc_id"]: r for r in language_id.language_id(docs).collect()}
    assert {got[k]["lang_pred"] for k in (50, 51, 53)} == {"und"} and got[51]["score"] == 0
    assert all(got[k]["lang_pred"] == ("aa" if k % 2 else "bb") for k in range(40)) and got[None]["held_out"] is False
    kept = language_id.recognised(docs.withColumnRenamed("source", "pred").withColumnRenamed("n_chars", "score"))
    assert kept.columns == ["doc_id", "text", "lang", "pred", "score"]
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r[0]) for r in rows if r[0] not in (50, 51, 53))


def test_unlabelled_and_single_language(spark):
    none = documents(spark, [(1, "some words", None, "s", 1)])
    assert [r["lang_pred"] for r in language_id.language_id(none).collect()] == ["und"]
    one = documents(spark, [(k, "some words here", "xx", "s", 1) for k in range(6)])
    assert {(r["lang_pred"], r["score"]) for r in language_id.language_id(one).collect()} == {("xx", 1.0)}


def test_families_join_related_languages():
    r = np.random.default_rng(0)
    a, b = r.random(50), r.random(50)
    f = language_id.families(np.stack([a, b, a + 0.05 * r.random(50), b + 0.05 * r.random(50)]))
    assert f[0] == f[2] and f[1] == f[3] and f[0] != f[1]


def test_language_learns_from_labelled_rows_only(spark, monkeypatch):
    """Rows under a chosen id without a label or text, or with another label, are not learnt from."""
    from sensorflow.llm import language_id
    from tests.llm.helpers import documents, prose

    seen = []
    monkeypatch.setattr(language_id, "fit", lambda x, lang: seen.append((len(x), sorted(lang))))
    rows = [(1, " ".join(prose(1, 30)), "en", "s", 1), (1, " ".join(prose(2, 30)), None, "s", 1), (1, None, "en", "s", 1)]
    rows += [(1, rows[0][1], "en", "s", 1)] * 20 + [(None, " ".join(prose(3, 30)), "fr", "s", 1), (2, None, None, "s", 1)]
    language_id.fit_model(documents(spark, rows), "doc_id", "text", "lang")
    assert seen == [(2, ["en", "fr"])]

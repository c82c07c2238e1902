import numpy as np
import pytest

from sensorflow.llm import graph, ngram_join
from sensorflow.llm import textbatch as tb
from tests.llm.helpers import ODD, documents, edited, jaccard_brute, prose


def corpus():
    rows = []
    for g in range(12):  # groups of near copies, some at the edge of the threshold
        base = prose(g, 20 + 13 * g)
        rows += [(100 * g + k, " ".join(edited(base, 50 * g + k, k))) for k in range(4)]
        rows.append((100 * g + 50, " ".join(base)))
        rows.append((100 * g + 60, " ".join(base).upper()))
    shared = prose(999, 60)  # one passage in many documents that are not similar
    rows += [(5000 + k, " ".join(prose(2000 + k, 80) + shared)) for k in range(40)]
    many = prose(77, 120)  # more near copies than a small run or a block holds
    rows += [(7000 + k, " ".join(edited(many, 8000 + k, k % 6))) for k in range(60)]
    rows += [(20 + k, " ".join(prose(31, 4)[: 1 + k % 4])) for k in range(8)]
    return rows + ODD


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    monkeypatch.setattr(ngram_join, "BUCKET_BYTES", 20_000)
    rows = corpus()
    got = ngram_join.jaccard_components(documents(spark, rows)).collect()
    want = sorted(((r[0], *w) for r, w in zip(rows, jaccard_brute(rows))), key=str)
    have = sorted(((r["doc_id"], r["n_shingles"], r["component_id"] if r["doc_id"] is not None else None, r["n_links"]) for r in got), key=str)
    assert have == want


def test_one_per_component_keeps_columns_and_first(spark):
    rows = corpus()
    schema = "doc_id bigint, text string, `c` int, `row` string, `key` double"
    full = [(i, t, k, "x", 0.5) for k, (i, t) in enumerate(rows)]
    out = ngram_join.one_per_component(spark.createDataFrame(full, schema))
    assert out.columns == ["doc_id", "text", "c", "row", "key"]
    got = sorted((str(r["doc_id"]), r["text"] or "") for r in out.collect())
    seen, want = set(), []
    for (i, t), (n, comp, _) in zip(rows, jaccard_brute(rows)):
        if n == 0:
            want.append((str(i), t or ""))
        elif i == comp and i not in seen:
            seen.add(i)
            want.append((str(i), t or ""))
    assert got == sorted(want)


def test_empty_table(spark):
    assert ngram_join.jaccard_components(documents(spark, [])).collect() == []
    assert ngram_join.one_per_component(documents(spark, [])).collect() == []


@pytest.mark.parametrize("size", [3, 4, 7, 20, 60, 200])
def test_signatures_of_similar_sets_meet(size):
    """A pair at the threshold shares at least the promised number of signatures in its index."""
    r = np.random.default_rng(size)
    for _ in range(60):
        common = r.integers(1, 2**63, size, dtype=np.uint64)
        a = np.unique(np.concatenate([common, r.integers(1, 2**63, r.integers(0, size // 6 + 1), dtype=np.uint64)]))
        b = np.unique(np.concatenate([common, r.integers(1, 2**63, r.integers(0, size // 6 + 1), dtype=np.uint64)]))
        inter = len(np.intersect1d(a, b))
        if 100 * inter < 75 * (len(a) + len(b) - inter):
            continue
        u, off = np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)])
        sig, e, doc, upper, need = ngram_join.signatures(u, off)
        node = doc[e]
        own, nodes, infos = ngram_join._entities(node, need[e] * 2 + upper[e])
        x, y, count, _, _ = ngram_join._runs(sig, own, nodes, infos)
        if (nodes[x] == nodes[y]).all():
            pytest.fail("similar sets share no signature")
        assert max(c - max(p >> 1, q >> 1) for p, q, c in zip(infos[x], infos[y], count)) >= 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 105), (105, 103), (200, 200), (None, 3)] + [(300, k) for k in range(301, 330)]
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    want = {**{i: 1 for i in range(1, 41)}, 100: 100, 105: 100, 103: 100, **{k: 300 for k in range(300, 330)}}
    assert got == want


def test_words_and_shingles_match_plain_python():
    import pyarrow as pa

    from tests.llm.helpers import words
    texts = ["A b\tC", "", None, "x", "é É ab ab ab ab ab ab", " lead", "trail ", "one two three four five six", "a\x0bb\x1cc"]
    raw, off = tb.text_buffers(pa.array(texts))
    start, end, h, first = tb.words(raw, off)
    spelled = [bytes(tb.LOWER[raw[a:b]]).decode() for a, b in zip(start, end)]
    assert [spelled[a:b] for a, b in zip(first, first[1:])] == [words(t) for t in texts]
    assert len(set(h.tolist())) == len(set(spelled))
    s, at = tb.shingles(h, first)
    assert np.diff(at).tolist() == [max(len(words(t)) - 4, min(1, len(words(t)))) for t in texts]


def test_several_texts_of_one_id(spark):
    """Rows are told apart by id and text; equal rows of one id count as copies."""
    a, b = " ".join(prose(1, 40)), " ".join(prose(2, 40))
    rows = [(5, a), (5, b), (5, b), (7, " ".join(edited(a.split(), 3, 1))), (8, b + " more")]
    got = ngram_join.jaccard_components(documents(spark, rows)).collect()
    want = sorted((r[0], *w) for r, w in zip(rows, jaccard_brute(rows)))
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["n_links"]) for r in got) == want
    kept = ngram_join.one_per_component(documents(spark, rows)).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == sorted([(5, a), (5, b)])


def test_finished_tables_leave_the_disk(spark):
    from pathlib import Path

    from sensorflow.session import checkpoint_root

    root = Path(checkpoint_root(spark).removeprefix("file:"))
    before = set(root.iterdir())
    texts = [" ".join(prose(k // 2, 60) + [f"end{k}"]) for k in range(40)]
    got = ngram_join.one_per_component(documents(spark, list(enumerate(texts))))
    assert sorted(r["doc_id"] for r in got.collect()) == list(range(0, 40, 2))
    assert sorted(p.name.rpartition("-")[0] for p in set(root.iterdir()) - before) == ["ngram-named"]

import numpy as np

from sensorflow.llm import preference_format as pf
from sensorflow.llm import queries as q
from sensorflow.llm import topk_search as tk
from sensorflow.llm import url_filters as uf
from pyspark.sql import functions as F


def test_topk_equals_brute_force_with_ties(spark):
    r = np.random.default_rng(0)
    rows = [(int(k), r.normal(0, 0.2, 8).astype(float).tolist()) for k in range(700)]
    rows += [(k, [0.25] * 8) for k in range(1000, 1100)]  # one very common vector
    rows += [(40, [0.5] * 8), (2000, None), (2020, [float("nan")] * 8), (2040, [1.0, None]), (2060, []), (2080, [0.1, 0.2]), (2100, [float("inf")] * 8), (None, [0.5] * 8)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = tk.topk_search(df, "vec_id", "embedding", F.col("vec_id") % 20 == 0, 20, shard_rows=300, chunk_queries=16).collect()
    ok = [(i, np.floor(64 * np.array(v)).astype(int)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]

    def dot(a, b):
        n = min(len(a), len(b))
        return int(a[:n] @ b[:n])
    want = set()
    for i, v in ok:
        if i % 20 == 0:
            best = sorted(((-dot(v, w), j) for j, w in ok if j != i))[:20]
            want |= {(i, tuple((j, -s) for s, j in best))}
    have = {}
    for x in sorted(got, key=lambda x: (x["query_id"], x["rank"])):
        have.setdefault(x["query_id"], []).append((x["rank"], x["vec_id"], x["score"]))
    lists = {}
    for i, best in want:
        lists.setdefault(i, []).append(best)
    for i, one in lists.items():
        if len(one) == 1:
            assert [(a, b) for _, a, b in have[i]] == list(one[0])
            assert [a for a, _, _ in have[i]] == list(range(1, len(one[0]) + 1))
    assert set(have) == set(lists)
    assert tk.topk_search(df.limit(0), "vec_id", "embedding", F.lit(True)).collect() == []


def test_search_shard_with_large_integers():
    r = np.random.default_rng(1)
    d = r.integers(-(2**26), 2**26, (500, 16))
    qs, ids = d[:10], np.arange(500)
    at, got, score = tk.search_shard(ids[:10], qs, ids, d, 5, block=32)
    for i in range(10):
        s = sorted((-int(qs[i] @ d[j]), j) for j in range(500) if j != i)[:5]
        assert sorted(zip((-score[at == i]).tolist(), got[at == i].tolist())) == s


def pages(spark, urls):
    return spark.createDataFrame([(k, u) for k, u in enumerate(urls)], "page_id bigint, url string")


def test_hosts_paths_and_rules(spark):
    urls = ["http://A.Example.ORG/es/1?x#y", "https://example.org/en/12/", "http://b.org", "http://b.org/", "https://x.com/fr/a", "https://x.com/de/1",
            "x.com/de/1", None, "", "://", "http://notorg/x", "http://u@h.com:80/fr/?q=://z", "http://org/a", "http://x.net?u=/a", "ftp://EXAMPLE.org/en/2"]
    got = [(r["host"], r["path"], r["rule"]) for r in uf.url_filter(pages(spark, urls), q.URL_RULES).orderBy("page_id").collect()]
    assert got == [("a.example.org", "/es/1", "example.org/es/"), ("example.org", "/en/12/", "example.org/en/1"), ("b.org", "", None), ("b.org", "/", "org/"),
                   ("x.com", "/fr/a", "com/fr/"), ("x.com", "/de/1", "com/de/"), ("", "", None), ("", "", None), ("", "", None), ("", "", None),
                   ("notorg", "/x", None), ("u@h.com:80", "/fr/", None), ("org", "/a", "org/"), ("x.net", "", None), ("example.org", "/en/2", "org/")]


def test_template_tree(spark):
    paths = [("h", f"/user/{n}", 0, 0) for n in ("ann", "bob")] + [("h", f"/tag/t{k}", 1, 1) for k in range(30)] + [("h", f"/item/{k}", 1, 0) for k in range(30)]
    paths += [("h", "/tag/never-seen", 0, 0), ("g", "/x/1.html", 0, 0), ("h", "/" + "/".join("abcdefghijkl"), 0, 0)]
    df = spark.createDataFrame(paths, "host string, path string, n_labelled bigint, n_bad bigint")
    got = {(r["host"], r["path"]): (r["template"], r["rejected"]) for r in uf.judged_paths(df).collect()}
    assert got[("h", "/tag/never-seen")] == ("/tag/{any}", True)
    assert got[("h", "/item/7")] == ("/item/{num}", False)
    assert got[("h", "/user/ann")][0] == "/user/ann" and got[("g", "/x/1.html")][0] == "/x/{num}.html"
    assert got[("h", "/a/b/c/d/e/f/g/h/i/j/k/l")][0] == "/a/b/c/d/e/f/g/h/i/j/k/l"
    assert len(got) == len(paths)


def test_deep_branches_are_told_apart(spark):
    rows = [("h", f"/a/b/c/d/e/f/g/{c}/{k}", 1, int(c == "bad")) for c in ("good", "bad") for k in range(20)]
    df = spark.createDataFrame(rows, "host string, path string, n_labelled bigint, n_bad bigint")
    got = {r["path"].split("/")[8]: (r["template"], r["rejected"]) for r in uf.judged_paths(df).collect()}
    assert got == {"good": ("/a/b/c/d/e/f/g/good/{num}", False), "bad": ("/a/b/c/d/e/f/g/bad/{num}", True)}


def test_similar_branches_are_merged(spark):
    rows = [("h", f"/{c}/{k}", 1, int(k < bad)) for c, bad in (("a", 29), ("b", 28), ("c", 1)) for k in range(30)] + [("h", "/d/1", 0, 0)]
    df = spark.createDataFrame(rows, "host string, path string, n_labelled bigint, n_bad bigint")
    got = {r["path"][1]: r["rejected"] for r in uf.judged_paths(df).collect()}
    assert got["a"] and got["b"] and not got["c"]


def test_url_filter_edge_cases(spark):
    df = pages(spark, ["http://a.com/fr/1"] * 3 + [None]).withColumn("host", F.lit("clash"))
    assert uf.url_filter(df, q.URL_RULES).count() == 4
    assert uf.url_filter(df.limit(0), q.URL_RULES).collect() == []


def test_preferences(spark):
    long = [(6, t, "user" if t % 2 == 0 else "assistant", f"t{t}") for t in range(7)] + [(7, t, "user" if t % 2 == 0 else "assistant", f"t{t}" if t < 5 else f"x{t}") for t in range(9)]
    rows = [(0, 0, "user", "hi"), (0, 1, "assistant", "good"), (1, 0, "user", "hi"), (1, 1, "assistant", "bad"), (1, 1, "assistant", "bad"),
            (2, 0, "user", "same"), (3, 0, "user", "same"), (4, 0, None, None), (8, None, "user", "x"), *long]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    pair, side = F.floor(F.col("conv_id") / 2).cast("long"), F.col("conv_id") % 2 == 0
    got = {r["pair_id"]: r for r in pf.format_preferences(df, pair, side).collect()}
    assert got[0]["prompt"] == "<|user|>\nhi<|end|>\n" and got[0]["chosen"] == "<|assistant|>\ngood<|end|>\n"
    assert got[0]["rejected_mask"] == f"{len(got[0]['rejected'])}:1"
    assert (got[1]["chosen"], got[1]["rejected"], got[1]["prompt_turns"]) == ("", "", 1)
    assert got[2]["rejected"] is None and got[2]["chosen"] == "<|unknown|>\n<|end|>\n" and got[2]["chosen_mask"].endswith(":0")
    assert got[3]["prompt_turns"] == 5 and got[3]["rejected_mask"].count(":1") == 2
    whole = {r["pair_id"]: r for r in pf.format_preferences(df, pair, side, block_turns=2).collect()}
    assert whole == got  # blocks don't show
    parts = pf.format_preferences(df, pair, side, block_turns=2, split_rows=True).where("pair_id = 3").orderBy("part").collect()
    assert "".join(r["prompt"] for r in parts) == got[3]["prompt"] and "".join(r["rejected"] for r in parts) == got[3]["rejected"]
    assert pf.format_preferences(df.limit(0), pair, side).collect() == []


def test_long_conversations_give_one_row(spark):
    rows = [(c, t, "assistant" if t % 2 else "user", f"t{t}" if t < 600 else f"{c}t{t}") for c in (0, 1) for t in range(1300)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    (r,) = pf.format_preferences(df, F.floor(F.col("conv_id") / 2).cast("long"), F.col("conv_id") % 2 == 0).collect()
    line = lambda t, text: f"<|{'assistant' if t % 2 else 'user'}|>\n{text}<|end|>\n"
    assert r["prompt"] == "".join(line(t, f"t{t}") for t in range(600)) and r["prompt_turns"] == 600
    assert r["chosen"] == "".join(line(t, f"0t{t}") for t in range(600, 1300)) and r["chosen_mask"].count(":1") == 350
    assert r["rejected"] == "".join(line(t, f"1t{t}") for t in range(600, 1300))

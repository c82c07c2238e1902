import random

from hypothesis import given, settings
from hypothesis import strategies as st

from sensorflow.llm import decontaminate as dc
from tests.llm.helpers import ODD, documents, edited, prose


def brute(p, t):
    prev = [0] * (len(t) + 1)
    for i in range(1, len(p) + 1):
        cur = [i]
        for j in range(1, len(t) + 1):
            cur.append(min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (p[i - 1] != t[j - 1])))
        prev = cur
    return min(prev)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=80), st.lists(st.integers(0, 3), max_size=90))
def test_bit_parallel_distance(p, t):
    x = dc.Pattern(p, len(p))
    assert min(x._scan(x.masks, t, True)[0], len(p)) == brute(p, t)


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id bigint, text string")


BENCH = [(k, " ".join(prose(k, 20 + k)).capitalize() + ".") for k in range(20)] + [(30, None), (31, ""), (32, "!!"), (None, " ".join(prose(77, 30))), (3, " ".join(prose(3, 23)).capitalize() + ".")]


def test_occurrences_within_the_budget(spark):
    r, rows, want = random.Random(5), [], set()
    for k in range(20):
        base = prose(k, 20 + k)
        budget = dc.budget(len(base))
        for e in (0, budget, budget + 3):
            doc = 100 * k + e
            body = edited(base, doc, e)
            rows.append((doc, " ".join(prose(7000 + doc, 40)) + " " + ", ".join(body).upper() + " " + " ".join(prose(8000 + doc, r.randint(0, 30)))))
            if e <= budget:
                want.add((doc, k, e))
    rows.append((5000, " ".join(prose(77, 30))))
    want.add((5000, None, 0))
    rows += ODD + [(6000 + k, " ".join(prose(9000 + k, 100))) for k in range(20)]
    docs = documents(spark, rows)
    for most in (dc.ITEM_BLOCK_BYTES, 1000):  # one block of items, or several
        got = dc.contaminated(docs, items(spark, BENCH), most=most).collect()
        assert {(x["doc_id"], x["item_id"], x["distance"]) for x in got} == want
        assert all(abs(x["start_word"] - 40) <= 2 for x in got if x["doc_id"] < 5000)
    kept = dc.without_contaminated(documents(spark, rows).withColumnRenamed("lang", "hits"), items(spark, BENCH))
    assert kept.columns == ["doc_id", "text", "hits", "source", "n_chars"]
    leaks = {d for d, _, _ in want}
    assert sorted(str(x["doc_id"]) for x in kept.collect()) == sorted(str(d) for d, _ in rows if d not in leaks)


def test_empty_tables(spark):
    docs, none = documents(spark, [(1, "a b c d e f")]), items(spark, [])
    assert dc.contaminated(docs, none).collect() == []
    assert dc.without_contaminated(docs, none).count() == 1
    assert dc.contaminated(documents(spark, []), items(spark, BENCH)).collect() == []

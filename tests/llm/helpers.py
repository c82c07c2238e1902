"""Small fixtures and brute-force versions for the llm operators."""

import random
import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def prose(seed, n, stem=""):
    r = random.Random(seed)
    return [stem + "".join(r.choice(("ba", "ke", "li", "mo", "nu", "ri", "so", "ta")) for _ in range(r.randint(2, 4))) for _ in range(n)]


def edited(ws, seed, n):
    r = random.Random(seed)
    out = list(ws)
    for i in r.sample(range(len(out)), n):
        out[i] = f"edit{r.randint(0, 10**6)}"
    return out


def documents(spark, rows, schema=DOC):
    """Rows (doc_id, text) or full ones."""
    full = [r if len(r) > 2 else (r[0], r[1], "en", "src0", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, schema)


def shingle_set(text, width=5):
    w = words(text)
    if len(w) < width:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i: i + width]) for i in range(len(w) - width + 1))


def jaccard_brute(rows, percent=75):
    """Per row: (set size, smallest id of its component, links)."""
    sets = [shingle_set(t) for _, t in rows]
    n = len(rows)
    up, links = list(range(n)), [0] * n

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for i in range(n):
        for j in range(i + 1, n):
            inter = len(sets[i] & sets[j])
            if inter and 100 * inter >= percent * (len(sets[i]) + len(sets[j]) - inter):
                links[i] += 1
                links[j] += 1
                up[find(i)] = find(j)
    least = defaultdict(list)
    for i in range(n):
        if rows[i][0] is not None:
            least[find(i)].append(rows[i][0])
    comp = [min(least[find(i)]) if least[find(i)] else None for i in range(n)]
    return [(len(sets[i]), comp[i], links[i]) for i in range(n)]


ODD = [(9001, None), (9002, ""), (9003, " \n\t "), (9004, "one"), (9004, "one"), (None, "no id at all here"), (9005, "é ü ñ"), (9006, "x" * 50000), (9007, "a b c d")]

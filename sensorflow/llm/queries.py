"""The registered ``opN_*`` queries and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorflow.llm import (centroid_clustering, decontaminate, importance_resampling, language_id, lm_scoring, ngram_join, packing,
                            preference_format, simhash_dedup, substring_dedup, token_files, topk_search, url_filters)
from sensorflow.llm.oracles import clustering_sql, resampling_sql
from sensorflow.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


#: Rows of an Arrow batch: whole texts travel in them, and the operators work slice by slice anyway.
ARROW_ROWS = 2000


def register(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return add


def bounded_batches(spark: SparkSession) -> None:
    """Session settings of the operators; they must still hold when a returned DataFrame is run."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Fixed by the contract of op6.
URL_RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]


def url_filter_sql(rules: list[tuple[str, str]]) -> str:
    """The template tree in DuckDB's SQL, with the operator's parameters."""
    def fits(text):
        host, path = text[: text.find("/")].lower(), text[text.find("/"):]
        return f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}')"
    order = sorted(rules, key=lambda r: (-len(r[0]), r[0]))
    rule = " ".join(f"WHEN {fits(t)} THEN '{t}'" for t, _ in order)
    says = " ".join(f"WHEN {fits(t)} THEN '{v}'" for t, v in order)
    u = url_filters
    literal = "NOT starts_with(c, '{') AND c <> ''"
    return rf"""
WITH u AS (SELECT page_id, coalesce(CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END, '') AS rest FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM u),
b0 AS (SELECT page_id, translate(raw, '{u.UPPER}', '{u.LOWER}') AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
b AS (SELECT *, CASE {rule} END AS rule, CASE {says} END AS says FROM b0),
paths AS (SELECT host, path, count(rule) AS lab, count(*) FILTER (says = 'block') AS bad FROM b GROUP BY ALL),
s1 AS (SELECT host, path, string_split(path, '/') AS s FROM paths),
s2 AS (SELECT host, path, list_transform(s, lambda x: CASE
         WHEN regexp_matches(x, '^[0-9]+$') THEN '{{num}}'
         WHEN regexp_matches(x, '^[0-9]+[.][A-Za-z0-9]+$') THEN '{{num}}.' || regexp_extract(x, '[.](.*)$', 1)
         WHEN regexp_matches(x, '^[0-9a-fA-F-]{{16,}}$') THEN '{{hex}}' ELSE x END) AS s FROM s1),
nodes AS (SELECT host, path, s, unnest(range(1, len(s) + 1)) AS d FROM s2),
n AS (SELECT host, path, d, s[d] AS c, array_to_string(s[1:d - 1], '/') AS p FROM nodes),
wide AS (SELECT host, d, p, true AS wide FROM n WHERE {literal} GROUP BY host, d, p HAVING count(DISTINCT c) > {u.MAX_CHILDREN}),
t0 AS (SELECT n.host, n.path, n.d, CASE WHEN wide AND {literal} THEN '{{any}}' ELSE c END AS c FROM n LEFT JOIN wide USING (host, d, p)),
t1 AS (SELECT *, max(d) FILTER ({literal}) OVER (PARTITION BY host, path) AS last FROM t0),
t AS (SELECT host, path, string_agg(c, '/' ORDER BY d) AS template,
             string_agg(CASE WHEN d = last THEN '{{*}}' ELSE c END, '/' ORDER BY d) AS family FROM t1 GROUP BY host, path),
stats AS (SELECT host, family, template, sum(lab) AS lab, sum(bad) AS bad FROM paths JOIN t USING (host, path) GROUP BY ALL),
total AS (SELECT (coalesce(sum(bad), 0) + 1)::DOUBLE / (coalesce(sum(lab), 0) + 2)::DOUBLE AS overall FROM paths),
rated AS (SELECT *, CASE WHEN lab > 0 THEN bad::DOUBLE / lab::DOUBLE ELSE -1 END AS rate FROM stats),
near AS (SELECT *, lag(lab) OVER w AS lab0, lag(bad) OVER w AS bad0, lag(rate) OVER w AS rate0
         FROM rated WINDOW w AS (PARTITION BY host, family ORDER BY rate, template)),
z AS (SELECT *, CASE WHEN lab0 IS NULL THEN false WHEN lab = 0 OR lab0 = 0 THEN lab = lab0
             ELSE (rate - rate0) * (rate - rate0) <= {u.Z * u.Z}::DOUBLE * (
               (bad + bad0)::DOUBLE / (lab + lab0)::DOUBLE * (1 - (bad + bad0)::DOUBLE / (lab + lab0)::DOUBLE) * (1::DOUBLE / lab::DOUBLE + 1::DOUBLE / lab0::DOUBLE)) END AS same FROM near),
g AS (SELECT *, sum(CASE WHEN same THEN 0 ELSE 1 END) OVER (PARTITION BY host, family ORDER BY rate, template) AS branch FROM z),
merged AS (SELECT host, family, branch, sum(lab)::DOUBLE AS lab, sum(bad)::DOUBLE AS bad FROM g GROUP BY ALL),
hosts AS (SELECT host, sum(lab)::DOUBLE AS hlab, sum(bad)::DOUBLE AS hbad FROM stats GROUP BY host),
judged AS (SELECT g.host, g.template, (m.bad + {u.PRIOR_WEIGHT}::DOUBLE * ((hbad + {u.PRIOR_WEIGHT}::DOUBLE * overall) / (hlab + {u.PRIOR_WEIGHT}::DOUBLE)))
             / (m.lab + {u.PRIOR_WEIGHT}::DOUBLE) > {u.REJECT_OVER}::DOUBLE AS rejected
           FROM g JOIN merged m USING (host, family, branch) JOIN hosts USING (host) CROSS JOIN total)
SELECT page_id, b.host, b.path, rule, coalesce(says, CASE WHEN rejected THEN 'block' ELSE 'allow' END) AS verdict, t.template
FROM b JOIN t USING (host, path) JOIN judged ON judged.host = t.host AND judged.template = t.template"""


@register("op6_url_filters", url_filter_sql(URL_RULES))
def op6(spark, sf_dir):
    """Every page's host, path, longest fitting rule and verdict; unruled pages are judged by the template tree,
    which learns from the pages that a rule decides."""
    return url_filters.url_filter(table(spark, sf_dir, "pages"), URL_RULES)


@register("op8_topk_search", """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, d.vec_id,
             CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * d.e[i])) AS BIGINT) AS score
      FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""")
def op8(spark, sf_dir):
    """The 20 best inner products of every vector whose id is divisible by 20, against all other rows."""
    return topk_search.topk_search(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 20 == 0, 20)


@register("op10_preference_formatting", r"""
WITH b AS (SELECT DISTINCT CAST(floor(conv_id / 2) AS BIGINT) AS pair_id, conv_id % 2 = 0 AS side, CAST(coalesce(turn, -1) AS BIGINT) AS turn,
                  coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations),
x AS (SELECT *, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS line FROM b),
m AS (SELECT pair_id, side, turn, string_agg(line, '' ORDER BY role, text) AS line,
             string_agg(length(line) || CASE WHEN role = 'assistant' THEN ':1' ELSE ':0' END, ',' ORDER BY role, text) AS mask
      FROM x GROUP BY ALL),
s AS (SELECT pair_id, turn, max(line) FILTER (side) AS c, max(line) FILTER (NOT side) AS r,
             max(mask) FILTER (side) AS cm, max(mask) FILTER (NOT side) AS rm FROM m GROUP BY ALL),
e AS (SELECT pair_id, min(turn) FILTER (c IS DISTINCT FROM r) AS cut, count(c) AS nc, count(r) AS nr FROM s GROUP BY ALL),
t AS (SELECT s.*, cut, nc, nr, cut IS NULL OR turn < cut AS shared FROM s JOIN e USING (pair_id))
SELECT pair_id, count(*) FILTER (shared AND c IS NOT NULL) AS prompt_turns,
       coalesce(string_agg(c, '' ORDER BY turn) FILTER (shared), '') AS prompt,
       CASE WHEN max(nc) > 0 THEN coalesce(string_agg(c, '' ORDER BY turn) FILTER (NOT shared), '') END AS chosen,
       CASE WHEN max(nr) > 0 THEN coalesce(string_agg(r, '' ORDER BY turn) FILTER (NOT shared), '') END AS rejected,
       CASE WHEN max(nc) > 0 THEN coalesce(string_agg(cm, ',' ORDER BY turn) FILTER (NOT shared), '') END AS chosen_mask,
       CASE WHEN max(nr) > 0 THEN coalesce(string_agg(rm, ',' ORDER BY turn) FILTER (NOT shared), '') END AS rejected_mask
FROM t GROUP BY pair_id""")
def op10(spark, sf_dir):
    """Conversations 2i (chosen) and 2i + 1 (rejected) form pair i."""
    t = table(spark, sf_dir, "conversations")
    return preference_format.format_preferences(t, F.floor(F.col("conv_id") / 2).cast("long"), F.coalesce(F.col("conv_id") % 2 == 0, F.lit(True)))


@register("op2_language_id")
def op2(spark, sf_dir):
    """Language of every document, learnt from documents that are not held out."""
    return language_id.language_id(table(spark, sf_dir, "documents"))


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@register("op4_best_fit_packing")
def op4(spark, sf_dir):
    """All documents' pieces packed into sequences of 1024 ids."""
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


@register("op9_token_id_output")
def op9(spark, sf_dir):
    """Token files of all documents, written and read back."""
    return token_files.token_files(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


@register("op3_ngram_jaccard_join")
def op3(spark, sf_dir):
    """Near-duplicate component and number of links of every document."""
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


@register("op7_benchmark_decontamination")
def op7(spark, sf_dir):
    """Occurrences of benchmark items in all documents, with up to 15 % of an item's words edited."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op5_substring_dedup")
def op5(spark, sf_dir):
    """Passages of 50 words or more that occur in several documents."""
    return substring_dedup.repeats(table(spark, sf_dir, "documents"))


@register("op1_lm_scoring")
def op1(spark, sf_dir):
    """Attention-model and word-unigram scores of all documents."""
    return lm_scoring.score_documents(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


@register("op11_simhash_near_dedup")
def op11(spark, sf_dir):
    """Fingerprint and near-duplicate component of every document."""
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


#: Fixed by the contract of op12: documents of so many words may be drawn, a percentage of them is.
RESAMPLING = {"buckets": 10_000, "least_words": 20, "percent": 10, "seed": 2024}


@register("op12_importance_resampling", resampling_sql(**RESAMPLING))
def op12(spark, sf_dir):
    """Every document's weight towards the benchmark's word distribution, and its rank in the draw."""
    return importance_resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), runs=1, **RESAMPLING)


#: Fixed by the contract of op13.
CLUSTERING = {"k": 40, "rounds": 5, "dims": 64, "scale": 256, "seed": 2}


@register("op13_centroid_clustering", clustering_sql(**CLUSTERING))
def op13(spark, sf_dir):
    """Cluster of every vector after five rounds, with the clusters' inertia and a digest of the centroids."""
    return centroid_clustering.cluster_report(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", **CLUSTERING)

"""DuckDB SQL of the importance resampling and of the sharded clustering."""

from __future__ import annotations


def resampling_sql(buckets: int, least_words: int, percent: int, seed: int) -> str:
    """Words' crc32 by a table of 256 entries, made from the polynomial, and all steps of the contract."""
    letters = "translate(coalesce({t}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = rf"regexp_extract_all({letters}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return rf"""
WITH tab AS (SELECT list_transform(range(256), lambda v: list_reduce(range(8),
               lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, v)) AS t),
d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {words.format(t='text')} AS w FROM documents),
dw AS (SELECT r, unnest(w) AS word FROM d),
bw AS (SELECT unnest({words.format(t='text')}) AS word FROM benchmark),
vocab AS (SELECT word, hex(encode(word)) AS x FROM (SELECT word FROM dw UNION SELECT word FROM bw)),
crc AS MATERIALIZED (SELECT word, xor(list_reduce(list_transform(range(1, length(x), 2), lambda i: CAST('0x' || substr(x, i, 2) AS BIGINT)),
               lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295) % {buckets} AS bucket
        FROM vocab, tab),
sb AS (SELECT bucket, count(*) AS s FROM dw JOIN crc USING (word) GROUP BY bucket),
tb AS (SELECT bucket, count(*) AS t FROM bw JOIN crc USING (word) GROUP BY bucket),
tot AS (SELECT (SELECT coalesce(sum(s), 0) FROM sb)::DOUBLE AS s_all, (SELECT coalesce(sum(t), 0) FROM tb)::DOUBLE AS t_all),
gain AS (SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (s_all + {buckets}) / ((coalesce(s, 0) + 1)::DOUBLE * (t_all + {buckets})))) AS BIGINT) AS gain
         FROM sb LEFT JOIN tb USING (bucket), tot),
w AS (SELECT r, count(*) AS n, CAST(sum(gain) AS BIGINT) AS g FROM dw JOIN crc USING (word) JOIN gain USING (bucket) GROUP BY r),
f AS (SELECT r, doc_id, coalesce(n, 0) AS n_features,
             CASE WHEN n > 0 THEN (g - ((g % n) + n) % n) // n ELSE 0 END AS weight,
             CAST('0x' || substr(sha256('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT)::DOUBLE AS h
      FROM d LEFT JOIN w USING (r)),
sc AS MATERIALIZED (SELECT r, doc_id, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM f),
el AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features) AS rank, count(*) OVER () AS n FROM sc WHERE n_features >= {least_words})
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
       CASE WHEN rank <= n * {percent} // 100 THEN rank END AS rank
FROM sc LEFT JOIN el USING (r)"""


def clustering_sql(k: int, rounds: int, dims: int, scale: int, seed: int) -> str:
    """The rounds of Lloyd's algorithm one after the other."""
    steps = [f"""v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS e
       FROM embeddings WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY sha256('{seed}:' || vec_id) NULLS LAST, e) - 1 AS INTEGER) AS cluster, e AS c FROM v
       QUALIFY row_number() OVER (ORDER BY sha256('{seed}:' || vec_id) NULLS LAST, e) <= {k})"""]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (SELECT r, min_by(cluster, (d, cluster)) AS cluster, min(d) AS distance
       FROM (SELECT r, cluster, CAST(list_sum(list_transform(range(1, {dims + 1}), lambda i: (e[i] - c[i]) * (e[i] - c[i]))) AS BIGINT) AS d FROM v, c{i}) GROUP BY r)""")
        if i < rounds:
            steps.append(f"""u{i} AS (SELECT cluster, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
       FROM (SELECT cluster, unnest(range(1, {dims + 1})) AS i, unnest(e) AS x FROM v JOIN a{i} USING (r)) GROUP BY ALL),
m{i} AS (SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS m FROM u{i} GROUP BY cluster),
c{i + 1} AS MATERIALIZED (SELECT cluster, coalesce(m, c) AS c FROM c{i} LEFT JOIN m{i} USING (cluster))""")
    return f"""WITH {','.join(steps)}
SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN v USING (r) JOIN c{rounds} USING (cluster)"""

"""DuckDB SQL for the training-data queries that SQL can express, over ``documents`` and ``embeddings``."""

from __future__ import annotations

from emberline.llm import secret_scan

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

JACCARD_JOIN = rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
         [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[\x20\x09-\x0D]+') IF x <> ''] AS w
  FROM documents),
s AS (
  SELECT DISTINCT r, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT r, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
p AS (SELECT a.r AS x, b.r AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.r < b.r GROUP BY ALL),
l AS (
  SELECT x, y FROM p JOIN n nx ON nx.r = x JOIN n ny ON ny.r = y WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
reach(r, o) AS (SELECT r, r FROM n UNION SELECT reach.r, e.y FROM reach JOIN e ON e.x = reach.o),
least_id AS (SELECT reach.r, min(o.doc_id) AS c FROM reach JOIN d o ON o.r = reach.o GROUP BY reach.r)
SELECT doc_id, coalesce(n, 0) AS n_shingles, CASE WHEN n IS NULL THEN doc_id ELSE c END AS component_id
FROM d LEFT JOIN n USING (r) LEFT JOIN least_id USING (r)"""

SUBSTRING_DEDUP = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS w FROM documents),
starts AS (SELECT r, w, unnest(generate_series(1, len(w) - 34)) AS i FROM d WHERE len(w) >= 35),
win AS (SELECT r, i, count(*) OVER (PARTITION BY array_to_string(w[i:i + 34], ' ')) AS n FROM starts),
gone AS (SELECT DISTINCT r, unnest(generate_series(i, i + 34)) AS p FROM win WHERE n > 1),
words AS (SELECT r, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM d),
left_over AS (
  SELECT words.r, count(gone.p) AS g, string_agg(x, ' ' ORDER BY words.p) FILTER (gone.p IS NULL) AS t
  FROM words LEFT JOIN gone ON gone.r = words.r AND gone.p = words.p GROUP BY words.r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(g, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN left_over USING (r)"""

HARD_NEGATIVES = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS l,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS c
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.r AS a, b.r AS b, a.vec_id AS anchor_id, b.vec_id AS other_id, a.l = b.l AS same,
         CAST(list_inner_product(a.c, b.c) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.r <> b.r AND len(a.c) = len(b.c)),
p AS (
  SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, other_id NULLS LAST) <= 5),
n AS (
  SELECT p.anchor_id, p.other_id AS positive_id, s.other_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.other_id NULLS LAST) AS rank
  FROM p JOIN s ON p.a = s.a AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3"""

ORACLE = {
    "op1_secret_scan": secret_scan.scan_sql(),
    "op2_jaccard_join": JACCARD_JOIN,
    "op9_substring_dedup": SUBSTRING_DEDUP,
    "op11_hard_negatives": HARD_NEGATIVES,
}

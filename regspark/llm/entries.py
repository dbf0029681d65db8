"""The registered queries of this subpackage, with SQL for those that SQL can express."""

from __future__ import annotations

from .additive_ann import op1_additive_ann
from .cross_polytope import op13_embedding_near_dedup
from .decontaminate import op10_decontamination
from .filter_audit import op11_filter_audit
from .language import op4_language_id
from .packing import op5_best_fit_packing
from .quality import op6_quality_ranking
from .secrets import op7_secret_scan
from .similarity_join import op9_ngram_jaccard_join
from .spelling import op12_spelling_variants
from .substring_dedup import op8_substring_dedup
from .token_files import op2_token_files
from .wrappers import op3_html_wrappers

QUERIES = {
    f.__name__: f
    for f in (
        op1_additive_ann, op2_token_files, op3_html_wrappers, op4_language_id, op5_best_fit_packing,
        op6_quality_ranking, op7_secret_scan, op8_substring_dedup, op9_ngram_jaccard_join, op10_decontamination,
        op11_filter_audit, op12_spelling_variants, op13_embedding_near_dedup,
    )
}

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL = {
    "op9_ngram_jaccard_join": rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
c AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM p JOIN c c1 ON c1.doc_id = x JOIN c c2 ON c2.doc_id = y WHERE 100 * k >= 90 * (c1.n + c2.n - k)),
t(x, y) AS (SELECT doc_id, doc_id FROM d UNION SELECT t.x, e.y FROM t JOIN e ON e.x = t.y)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, min(y) AS component_id FROM d LEFT JOIN c USING (doc_id) JOIN t ON t.x = d.doc_id GROUP BY d.doc_id, n""",
    "op10_decontamination": rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT row_number() OVER () AS q, item_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bi AS (SELECT q, item_id, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win FROM bi),
ns AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS win FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, ns WHERE len(w) >= n)),
h AS MATERIALIZED (SELECT dw.r, dw.i, dw.n, item_id FROM dw JOIN bw USING (n, win)),
pos AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM h) GROUP BY r),
it AS (SELECT r, count(*) AS n_items, string_agg(v, ',' ORDER BY v) AS s FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS v FROM h) GROUP BY r),
dp AS MATERIALIZED (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
cnt AS (SELECT word, count(*) AS c FROM dp GROUP BY 1),
bp AS (SELECT q, item_id, i, n, j, w[j] AS word FROM (SELECT *, unnest(range(i, i + n)) AS j FROM bi)),
rk AS (SELECT bp.*, coalesce(c, 0) AS c, row_number() OVER (PARTITION BY q, i ORDER BY coalesce(c, 0), j) AS rn FROM bp LEFT JOIN cnt USING (word)),
pr AS MATERIALIZED (SELECT DISTINCT x.item_id, x.word AS one, y.word AS two, y.j - x.j AS apart FROM rk x JOIN rk y ON x.q = y.q AND x.i = y.i AND x.rn = 1 AND y.rn = least(2, x.n) WHERE x.c > 0),
n1 AS MATERIALIZED (SELECT x.r, x.p, pr.* FROM pr JOIN dp x ON x.word = one),
nr AS MATERIALIZED (SELECT n1.r, count(DISTINCT CAST(item_id AS VARCHAR)) AS n_near FROM n1 JOIN dp y ON y.r = n1.r AND y.word = two WHERE abs(y.p - n1.p - apart) <= 3 AND (y.p <> n1.p OR apart = 0) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated, coalesce(n_near, 0) AS n_near FROM d LEFT JOIN pos USING (r) LEFT JOIN it USING (r) LEFT JOIN nr USING (r)""",
    "op11_filter_audit": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS part, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY 1),
f AS (SELECT d.doc_id, part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
  CASE WHEN len(w) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
  || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 'C' ELSE '' END || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
  || CASE WHEN d.doc_id > min(d.doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails FROM d LEFT JOIN l ON l.doc_id = d.doc_id),
m AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY 1, 2),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS v),
o AS (SELECT a.v || b.v || c.v || d.v || e.v AS filter_order FROM x a JOIN x b ON b.v <> a.v JOIN x c ON c.v NOT IN (a.v, b.v) JOIN x d ON d.v NOT IN (a.v, b.v, c.v) JOIN x e ON e.v NOT IN (a.v, b.v, c.v, d.v)),
s AS (SELECT filter_order, step, filter_order[step] AS own, CASE WHEN step = 1 THEN '' ELSE filter_order[1:step - 1] END AS before FROM o, (SELECT unnest(range(1, 6)) AS step)),
h AS (SELECT m.*, s.*, contains(fails, own) AS is_own, length(translate(before, fails, '')) < length(before) AS gone FROM m, s),
g AS (SELECT part, filter_order, step, own, coalesce(sum(n) FILTER (NOT gone AND NOT is_own), 0) AS kept, coalesce(sum(n) FILTER (NOT gone AND is_own), 0) AS removed, coalesce(sum(n) FILTER (gone AND is_own), 0) AS redundant,
  coalesce(sum(n) FILTER (fails = own), 0) AS unique_fails, coalesce(sum(good) FILTER (NOT gone AND is_own), 0) AS good_lost, coalesce(sum(toxic) FILTER (NOT gone AND is_own), 0) AS toxic_lost FROM h GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM g""",
}

"""DuckDB SQL for the operators that SQL can express."""
from __future__ import annotations

from tidewell.llm.quality_rules import RuleParams

LINE_DEDUP = r"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM split),
k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
o AS (
  SELECT key, min(doc_id) AS owner FROM k WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) > 1),
j AS (
  SELECT k.doc_id, k.i, k.line, o.key IS NOT NULL AND k.doc_id <> o.owner AS lost
  FROM k LEFT JOIN o ON k.key = o.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""

WARC = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (
  SELECT page_id, octet_length(b) AS payload_bytes, sha1(b) AS payload_digest FROM p),
r AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS top FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN top END AS refers_to
FROM r
"""

DECONTAMINATION = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
g AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS m, array_to_string(w[a : a + least(len(w), 10) - 1], ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS a FROM i WHERE len(w) > 0)),
c AS (
  SELECT doc_id, m, a, array_to_string(w[a : a + m - 1], ' ') AS gram
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS a FROM d, (SELECT DISTINCT m FROM g))),
h AS (SELECT c.doc_id, c.m, c.a, g.item_id FROM c JOIN g ON c.gram = g.gram AND c.m = g.m),
n AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(a, a + m)) AS p FROM h) GROUP BY doc_id),
k AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN k USING (doc_id)
"""

NEAR_DEDUP = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[a : a + 1], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 1) + 1)) AS a FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
r AS MATERIALIZED (
  SELECT s.doc_id, g, row_number() OVER (PARTITION BY s.doc_id ORDER BY f, g) AS k
  FROM s JOIN (SELECT g, count(*) AS f FROM s GROUP BY g) USING (g)),
-- similar sets share one of the rarest fifth of their shingles
p AS (SELECT r.doc_id, g FROM r JOIN n USING (doc_id) WHERE k <= n - ceil(n * 0.8) + 1),
c AS (
  SELECT DISTINCT a.doc_id AS a, b.doc_id AS b FROM p a JOIN p b ON a.g = b.g AND a.doc_id < b.doc_id
  JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  WHERE 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)),
i AS (SELECT c.a, c.b, count(*) AS i FROM c JOIN s x ON x.doc_id = c.a JOIN s y ON y.doc_id = c.b AND y.g = x.g
      GROUP BY c.a, c.b),
l AS MATERIALIZED (
  SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 80 * (x.n + y.n - i)),
e AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
t AS (SELECT doc_id AS node, doc_id AS seen FROM n UNION SELECT t.node, e.b FROM t JOIN e ON e.a = t.seen)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(m.c, d.doc_id) AS component_id,
       coalesce(m.c, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT node, min(seen) AS c FROM t GROUP BY node) m ON m.node = d.doc_id
"""

SUBSTRING_DEDUP = r"""
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS MATERIALIZED (
  SELECT doc_id, i, md5(substr(h, 2 * i + 1, 800)) AS k
  FROM (SELECT doc_id, h, unnest(range(n - 399)) AS i FROM d WHERE n >= 400)),
s AS (
  SELECT doc_id, i, i > coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), -401) + 400 AS first
  FROM w WHERE k IN (SELECT k FROM w GROUP BY k HAVING count(*) > 1)),
r AS (
  SELECT doc_id, min(i) AS a, max(i) + 400 AS b
  FROM (SELECT doc_id, i, sum(CAST(first AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM s) GROUP BY doc_id, g),
p AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS prev FROM r),
c AS (
  SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last,
         string_agg(substr(h, 2 * prev + 1, 2 * (a - prev)), '' ORDER BY a) AS head
  FROM p JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(n_spans, 0) AS n_spans,
       sha256(from_hex(CASE WHEN head IS NULL THEN h ELSE head || substr(h, 2 * last + 1) END)) AS kept_sha256
FROM d LEFT JOIN c USING (doc_id)
"""

TOP_K = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.r, q.vec_id AS query_id, v.vec_id, CAST(list_dot_product(q.e, v.e) AS BIGINT) AS score
  FROM v q JOIN v ON q.r <> v.r WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""

FILTER_AUDIT = r"""
WITH d AS (
  SELECT doc_id, coalesce(CAST(source AS VARCHAR), '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (
  SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
  FROM labels GROUP BY doc_id),
f AS MATERIALIZED (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, [
    len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
    100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t),
    regexp_matches(t, '[#$%&*|]'), coalesce(min(d.doc_id) OVER (PARTITION BY t) < d.doc_id, false)] AS fail
  FROM d LEFT JOIN l ON l.doc_id = d.doc_id),
b AS (SELECT unnest([1, 2, 3, 4, 5]) AS k),
o AS (
  SELECT p.k AS k1, q.k AS k2, r.k AS k3, s.k AS k4, t.k AS k5 FROM b p JOIN b q ON q.k <> p.k
  JOIN b r ON r.k NOT IN (p.k, q.k) JOIN b s ON s.k NOT IN (p.k, q.k, r.k) JOIN b t ON t.k NOT IN (p.k, q.k, r.k, s.k)),
c AS (SELECT part, good, toxic, fail, count(*) AS n FROM f GROUP BY ALL),
x AS (
  SELECT part, [k1, k2, k3, k4, k5] AS ks, b.k AS step, good, toxic, n,
         fail[[k1, k2, k3, k4, k5][b.k]] AS own, list_bool_or([false] || list_transform(range(1, b.k),
           lambda i: fail[[k1, k2, k3, k4, k5][i]])) AS before,
         len(list_filter(fail, lambda z: z)) AS many FROM c, o, b),
a AS (
  SELECT part, ks, step, coalesce(sum(n) FILTER (WHERE NOT own AND NOT before), 0) AS kept,
         coalesce(sum(n) FILTER (WHERE own AND NOT before), 0) AS removed,
         coalesce(sum(n) FILTER (WHERE own AND before), 0) AS redundant,
         coalesce(sum(n) FILTER (WHERE own AND many = 1), 0) AS unique_fails,
         coalesce(sum(n) FILTER (WHERE own AND NOT before AND good), 0) AS good_lost,
         coalesce(sum(n) FILTER (WHERE own AND NOT before AND toxic), 0) AS toxic_lost
  FROM x GROUP BY part, ks, step)
SELECT part, list_reduce(list_transform(ks, lambda k: substr('ABCDE', k, 1)), lambda u, v: u || v) AS filter_order,
       CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, ks[step]) AS BIGINT) AS shapley
FROM a
"""

def quality_rules(params: RuleParams = RuleParams()) -> str:
    strata = ", ".join(f"'{x}'" for x in params.strata)
    grid = ", ".join(f"('{name}', {k}, {cut})" for name, cuts in params.grid.items() for k, cut in enumerate(cuts))
    level, risk = params.level / ((len(params.strata) + 1) * len(params.grid)), params.metric_risk
    return rf"""
WITH d AS MATERIALIZED (
  SELECT doc_id, CASE WHEN lang IN ({strata}) THEN lang ELSE 'other' END AS stratum, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS MATERIALIZED (
  SELECT doc_id, i, array_to_string(w[i : i + 4], ' ') AS gram
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
r AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p
        FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM g) WHERE c > 1) GROUP BY doc_id),
l AS (
  SELECT doc_id, count(*) AS n_word_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
f AS MATERIALIZED (
  SELECT d.doc_id, stratum, CAST(len(w) AS BIGINT) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         coalesce(n_word_lines, 0) AS n_word_lines,
         len(w) < {params.min_words} OR 100 * coalesce(n_repeat_words, 0) > {params.max_repeat_pct} * len(w) AS base_failed
  FROM d LEFT JOIN r USING (doc_id) LEFT JOIN l USING (doc_id)),
m AS (
  SELECT doc_id, stratum, base_failed, unnest(['symbols', 'dup_lines', 'word_length']) AS metric, unnest([
    CASE WHEN n_words > 0 THEN 1000 * n_symbols // n_words ELSE 0 END,
    CASE WHEN n_word_lines > 0 THEN 1000 * n_dup_lines // n_word_lines ELSE 0 END,
    CASE WHEN n_words > 0 THEN 1000 * word_chars // n_words ELSE 0 END]) AS value FROM f),
grid(metric, pos, cut) AS (VALUES {grid}),
h AS (
  SELECT m.*, good FROM m
  JOIN (SELECT doc_id, max(quality) > 0 AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id) USING (doc_id)
  WHERE NOT base_failed),
c AS (
  SELECT stratum, metric, pos, cut, count(*) FILTER (WHERE good) AS n,
         count(*) FILTER (WHERE good AND value > cut) AS k, count(*) FILTER (WHERE NOT good AND value > cut) AS bad
  FROM h JOIN grid USING (metric) GROUP BY ALL),
t AS (
  SELECT *, n > 0 AND k <= {risk!r} * n AND list_sum(list_transform(range(k + 1), lambda i: exp(
    lgamma(n + 1.0) - lgamma(i + 1.0) - lgamma(n - i + 1.0) + i * ln({risk!r}) + (n - i) * ln(1 - {risk!r})
    ))) <= {level!r} AS passed FROM c),
o AS (
  SELECT *, bool_and(passed) OVER (PARTITION BY stratum, metric ORDER BY pos) AS certified,
         bad - {params.cost} * k AS gain FROM t),
u AS (
  SELECT stratum, metric, cut FROM o WHERE certified AND gain > 0
  QUALIFY row_number() OVER (PARTITION BY stratum, metric ORDER BY gain DESC, pos) = 1),
x AS (SELECT DISTINCT m.doc_id FROM m JOIN u ON u.stratum = m.stratum AND u.metric = m.metric AND m.value > u.cut)
SELECT f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND x.doc_id IS NULL AS kept
FROM f LEFT JOIN x USING (doc_id)
"""

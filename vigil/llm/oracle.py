"""DuckDB SQL of the corpus queries that SQL can express."""

from __future__ import annotations

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACE = r"[\x20\x09-\x0D]+"
_NOT_SPACE = r"[^\x20\x09-\x0D]+"

DECONTAMINATION = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id,
         regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[p:p + least(10, len(w)) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS p FROM b WHERE len(w) > 0)),
dw AS (
  SELECT r, p, n, array_to_string(w[p:p + n - 1], ' ') AS g
  FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS p
        FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
hits AS (SELECT dw.r, dw.p, dw.n, bw.item_id FROM dw JOIN bw ON dw.g = bw.g AND dw.n = bw.n),
covered AS (
  SELECT r, count(DISTINCT q) AS n_hit
  FROM (SELECT r, unnest(generate_series(p, p + n - 1)) AS q FROM (SELECT DISTINCT r, p, n FROM hits)) GROUP BY r),
items AS (
  SELECT r, count(DISTINCT item_id) AS n_items,
         string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM hits GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN items USING (r)
"""

URL_FILTER = r"""
WITH rules(rhost, rpath, rverdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
p AS (
  SELECT row_number() OVER () AS r, page_id,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
q AS (
  SELECT r, page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM p),
m AS (
  SELECT r, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(rverdict, length(rhost || rpath)) AS rverdict
  FROM q JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY r)
SELECT page_id, host, path, rule, coalesce(rverdict, 'allow') AS verdict FROM q LEFT JOIN m USING (r)
"""

QUALITY = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '{_NOT_SPACE}') AS w,
         [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '{_NOT_SPACE}')] AS l
  FROM documents),
g AS (
  SELECT r, p, array_to_string(w[p:p + 2], ' ') AS gram
  FROM (SELECT r, w, unnest(generate_series(1, len(w) - 2)) AS p FROM d WHERE len(w) >= 3)),
twice AS (SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, gram) AS c FROM g) WHERE c > 1),
rep AS (SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest([p, p + 1, p + 2]) AS q FROM twice) GROUP BY r),
m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '{_SPACE}', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) AS BIGINT) AS n_lines,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
         length(regexp_replace(t, '[^\pL]+', '', 'g')) AS n_letters,
         length(regexp_replace(t, '[^\p{{Lu}}]+', '', 'g')) AS n_upper,
         length(regexp_replace(t, '[^!]+', '', 'g')) AS n_exclaim
  FROM d LEFT JOIN rep USING (r)),
f AS (
  SELECT *, CAST(n_words < 50 AS BIGINT) + 2 * CAST(100 * n_repeat_words > 50 * n_words AS BIGINT)
         + 4 * CAST(10 * n_symbols > n_words AS BIGINT) + 8 * CAST(word_chars < 3 * n_words AS BIGINT)
         + 16 * CAST(word_chars > 10 * n_words AS BIGINT) + 32 * CAST(100 * n_dup_lines > 40 * n_lines AS BIGINT)
         + 64 * CAST(2 * n_upper > n_letters AND n_letters > 0 AS BIGINT)
         + 128 * CAST(4 * n_exclaim > n_words AS BIGINT) AS failed
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       failed & 3 <> 0 AS base_failed, failed = 0 AS kept, CAST(failed AS BIGINT) AS failed
FROM f
"""

MIXING = rf"""
WITH d AS (
  SELECT doc_id, CAST(source AS VARCHAR) AS source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '{_NOT_SPACE}')) AS BIGINT) AS size,
         CAST('0x' || substr(md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) AS u,
         coalesce(CAST(doc_id AS VARCHAR), '') AS id
  FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
s1 AS (
  SELECT *, row_number() OVER (ORDER BY source IS NULL, source) AS rn, 2.0::DOUBLE * source_size AS cap,
         1.5::DOUBLE * sum(source_size) OVER () AS total FROM s0),
s2 AS (SELECT *, [3.0::DOUBLE, 1.0, 2.0][(rn - 1) % 3 + 1] AS w FROM s1),
s3 AS (
  SELECT *, row_number() OVER o AS k,
         coalesce(sum(cap) OVER (ORDER BY cap / w, rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
         sum(w) OVER (ORDER BY cap / w, rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_left
  FROM s2 WINDOW o AS (ORDER BY cap / w, rn)),
lev AS (SELECT k, total - used AS num, w_left FROM s3 WHERE w * (total - used) <= cap * w_left ORDER BY k LIMIT 1),
s AS (
  SELECT s3.source, s3.source_size,
         CASE WHEN s3.k >= lev.k THEN s3.w * lev.num / lev.w_left ELSE s3.cap END AS target
  FROM s3 LEFT JOIN lev ON true),
plan AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM s),
o AS (
  SELECT d.*, plan.source_size, plan.target, plan.whole, plan.target - plan.whole * plan.source_size AS need,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY u, id, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior
  FROM d JOIN plan ON d.source IS NOT DISTINCT FROM plan.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (whole + CASE WHEN prior + size / 2.0 <= need THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM o
"""

_STRIP = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_KEY = _LOWER.format(f"trim(line, {_STRIP})")

LINE_DEDUP = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
x AS (
  SELECT r, doc_id, p, line, {_KEY} AS key
  FROM (SELECT r, doc_id, unnest(l) AS line, unnest(generate_series(1, len(l))) AS p FROM d)),
rep AS (
  SELECT key, max(doc_id) AS last FROM x WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
y AS (
  SELECT r, doc_id, p, line, rep.key IS NOT NULL AND x.doc_id <> rep.last AS gone FROM x LEFT JOIN rep USING (key))
SELECT any_value(doc_id) AS doc_id, CAST(count(*) AS BIGINT) AS n_lines,
       CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM y GROUP BY r
"""

_TERMS = _LOWER.format("coalesce(text, '')")

RANKED_SEARCH = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all({_TERMS}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents),
q AS (
  SELECT DISTINCT no, item_id, unnest(regexp_extract_all({_TERMS}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS no, item_id, text FROM (SELECT DISTINCT item_id, text FROM benchmark))),
s AS (SELECT CAST(count(*) AS BIGINT) AS nd, CAST(sum(len(t)) AS BIGINT) AS nt FROM d WHERE len(t) > 0),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) GROUP BY r, term),
w AS (
  SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * nd + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), s),
part AS (
  SELECT no, item_id, r, doc_id,
         w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * CAST(len(t) AS BIGINT) * nd) // nt))) AS impact
  FROM q JOIN tf USING (term) JOIN w USING (term) JOIN d USING (r), s),
total AS (
  SELECT no, item_id, doc_id, CAST(sum(impact) AS BIGINT) AS score FROM part GROUP BY no, item_id, r, doc_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY no ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank
  FROM total WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""

HARD_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_sum(list_transform(list_zip(a.x, b.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
pos AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) AS place
  FROM s WHERE same),
neg AS (
  SELECT pos.anchor_id, positive_id, other_id AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY pos.anchor_id, positive_id ORDER BY score DESC, other_id) AS rank
  FROM pos JOIN s ON s.anchor_id = pos.anchor_id AND NOT same
   AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
  WHERE place <= 5)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM neg WHERE rank <= 10
"""

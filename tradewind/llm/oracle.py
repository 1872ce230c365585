"""SQL for the operators that SQL can express."""

from __future__ import annotations

_WORD = r"[\x20\x09-\x0D]+"

NEAR_DUPLICATES = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}'), lambda x: x <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 3 THEN list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
  FROM words
), shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS (
  SELECT a.doc_id AS u, b.doc_id AS v FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id, doc_id AS c FROM documents UNION SELECT r.doc_id, l.v FROM reach r JOIN links l ON r.c = l.u
), least AS (SELECT doc_id, min(c) AS component_id FROM reach GROUP BY doc_id)
SELECT s.doc_id, len(s.s) AS n_shingles, l.component_id, s.doc_id = l.component_id AS kept FROM sets s JOIN least l ON s.doc_id = l.doc_id
"""

REPEATED = """
WITH bytes AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
strings AS (SELECT doc_id, s, substr(x, 2 * s + 1, 200) AS b FROM (SELECT doc_id, x, unnest(range(0, greatest(len(x) // 2 - 99, 0))) AS s FROM bytes)),
later AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY b ORDER BY doc_id, s) AS r FROM strings) WHERE r > 1),
marked AS (SELECT doc_id, s, CASE WHEN s - lag(s) OVER (PARTITION BY doc_id ORDER BY s) <= 100 THEN 0 ELSE 1 END AS opens FROM later),
numbered AS (SELECT doc_id, s, sum(opens) OVER (PARTITION BY doc_id ORDER BY s) AS k FROM marked),
spans AS (SELECT doc_id, min(s) AS low, max(s) + 100 AS high FROM numbered GROUP BY doc_id, k),
ends AS (SELECT doc_id, low, high, 1 AS span FROM spans UNION ALL SELECT doc_id, len(x) // 2, len(x) // 2, 0 FROM bytes),
cuts AS (SELECT *, lag(high, 1, 0) OVER (PARTITION BY doc_id ORDER BY low, high) AS before FROM ends),
pieces AS (SELECT c.doc_id, c.low, c.high, c.span, substr(b.x, 2 * before + 1, 2 * (low - before)) AS piece FROM cuts c JOIN bytes b ON c.doc_id = b.doc_id)
SELECT p.doc_id, any_value(len(b.x) // 2) AS n_bytes, CAST(sum(high - low) AS BIGINT) AS n_removed, CAST(sum(span) AS BIGINT) AS n_spans,
  sha256(unhex(string_agg(piece, '' ORDER BY low, high))) AS kept_sha256
FROM pieces p JOIN bytes b ON p.doc_id = b.doc_id GROUP BY p.doc_id
"""

MIXING = r"""
WITH RECURSIVE counted AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS tokens, md5(coalesce(text, '')) AS digest FROM documents
), sizes AS (SELECT source, CAST(sum(tokens) AS BIGINT) AS tokens FROM counted GROUP BY source),
total AS (SELECT CAST(sum(tokens) AS DOUBLE) AS total, list_sort(list(CAST(tokens AS DOUBLE)) FILTER (tokens > 0)) AS l FROM sizes),
shares AS (SELECT total, list_transform(l, lambda t: t / total) AS p, len(l) AS n FROM total),
even AS (
  SELECT 0 AS i, CAST(0 AS DOUBLE) AS low, CAST(1 AS DOUBLE) AS high, p, n FROM shares UNION ALL
  SELECT i + 1, CASE WHEN h >= 0.97 * ln(n) THEN mid ELSE low END, CASE WHEN h >= 0.97 * ln(n) THEN high ELSE mid END, p, n FROM (
    SELECT *, (low + high) / 2 AS mid, ln(list_sum(list_transform(p, lambda q: pow(q, (low + high) / 2))))
      - (low + high) / 2 * list_sum(list_transform(p, lambda q: pow(q, (low + high) / 2) * ln(q))) / list_sum(list_transform(p, lambda q: pow(q, (low + high) / 2))) AS h
    FROM even WHERE i < 50)
), often AS (
  SELECT 0 AS i, CAST(0 AS DOUBLE) AS low, CAST(1 AS DOUBLE) AS high, p FROM shares UNION ALL
  SELECT i + 1, CASE WHEN r > 4 THEN mid ELSE low END, CASE WHEN r > 4 THEN high ELSE mid END, p FROM (
    SELECT *, (low + high) / 2 AS mid, pow(p[1], (low + high) / 2) / list_sum(list_transform(p, lambda q: pow(q, (low + high) / 2))) / p[1] AS r
    FROM often WHERE i < 50)
), exponent AS (
  SELECT greatest(
    CASE WHEN -list_sum(list_transform(s.p, lambda q: q * ln(q))) >= 0.97 * ln(s.n) THEN 1 ELSE (SELECT low FROM even WHERE i = 50) END,
    CASE WHEN 1.0 / s.n / s.p[1] <= 4 THEN 0 ELSE (SELECT high FROM often WHERE i = 50) END) AS x, s.p, s.total FROM shares s
), weights AS (
  SELECT z.source, z.tokens, CASE WHEN z.tokens > 0 THEN pow(z.tokens / e.total, e.x) / list_sum(list_transform(e.p, lambda q: pow(q, e.x))) ELSE 0 END AS weight, e.total
  FROM sizes z, exponent e
), plan AS (
  SELECT *, CAST(ceil(weight * total) AS BIGINT) AS target, CASE WHEN tokens > 0 THEN CAST(floor(ceil(weight * total) / tokens) AS BIGINT) ELSE 1 END AS whole FROM weights
), given AS (
  SELECT c.doc_id, c.digest, c.source, c.tokens AS n_tokens, p.weight, p.target, p.whole, p.tokens, unnest(range(0, p.whole + 1)) AS block
  FROM counted c JOIN plan p ON c.source IS NOT DISTINCT FROM p.source
), placed AS (SELECT *, md5('7:' || block || ':' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || digest) AS key FROM given),
summed AS (
  SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY source, block ORDER BY key RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS upto,
    sum(n_tokens) OVER (PARTITION BY source, block, key) AS own FROM placed
)
SELECT doc_id, source, CAST(n_tokens AS BIGINT) AS n_tokens, round(weight, 9) AS weight, target, block, key FROM summed
WHERE block < whole OR (target > whole * tokens AND upto - own < target - whole * tokens)
"""

COLLOCATIONS = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), split AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda w: w <> '') AS w FROM pieces),
placed AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM split),
grams AS (SELECT lang, w[i:i + k - 1] AS p, k FROM placed, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE i + k - 1 <= len(w)),
counted AS (SELECT lang, p, k, count(*) AS f FROM grams GROUP BY lang, p, k HAVING count(*) >= 30),
cuts AS (
  SELECT c.lang, c.p, c.k, c.f AS a, j, x.f AS l, y.f AS r, CAST(2000000::HUGEINT * c.f // (x.f + y.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM counted WHERE k > 1) c
  JOIN counted x ON x.lang = c.lang AND x.p = c.p[1:j] JOIN counted y ON y.lang = c.lang AND y.p = c.p[j + 1:]
), best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, j) = 1),
inner_parts AS (
  SELECT lang, p[s:s + m - 1] AS p, max(f) AS longer
  FROM (SELECT *, unnest(range(1, k - m + 2)) AS s FROM (SELECT *, unnest(range(2, k)) AS m FROM counted WHERE k > 2)) GROUP BY 1, 2
), kept AS (
  SELECT b.lang, array_to_string(b.p, ' ') AS phrase, b.a, b.l, b.r, b.score FROM best b LEFT JOIN inner_parts i ON i.lang = b.lang AND i.p = b.p
  WHERE i.longer IS NULL OR 100::HUGEINT * i.longer < 80::HUGEINT * b.a
), ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, n.n, r.score
FROM ranked r JOIN (SELECT lang, count(*) AS n FROM placed GROUP BY lang) n ON n.lang = r.lang WHERE r.rank <= 2000
"""

SQL = {"op11_collocations": COLLOCATIONS, "op2_minhash_near_dedup": NEAR_DUPLICATES, "op5_suffix_array_dedup": REPEATED, "op7_mixing": MIXING}

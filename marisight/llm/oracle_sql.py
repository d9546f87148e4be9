"""DuckDB SQL for corpus queries that SQL can express over whole small tables."""

_WORDS = "regexp_extract_all({0}, '[^\\x20\\x09-\\x0D]+')"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS ws FROM documents
), w AS (SELECT doc_id, generate_subscripts(ws, 1) AS i, unnest(ws) AS word FROM d
), v AS (
  SELECT *, string_agg(word, ' ') OVER x AS run, count(*) OVER x AS n FROM w
  WINDOW x AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)
), r AS (
  SELECT doc_id, i, word, n = 20 AND row_number() OVER (PARTITION BY n, run ORDER BY doc_id, i) > 1 AS later FROM v
), c AS (
  SELECT doc_id, i, word, bool_or(later) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone FROM r
), g AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS kept FROM c GROUP BY 1
)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN g USING (doc_id)
"""

OP3_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format(f"coalesce({_LOWER}, '')")} AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i : i + 3], ' ') AS shingle
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 2))) AS i FROM d WHERE len(ws) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1
), p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2
), l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 85 * (x.n + y.n - common)
), t(a, b) AS (SELECT a, b FROM l UNION SELECT t.a, l.b FROM t JOIN l ON l.a = t.b
), m AS (SELECT a, min(b) AS b FROM t GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m.b, d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m ON m.a = d.doc_id
"""

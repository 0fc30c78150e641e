"""DuckDB SQL of the corpus queries that SQL can express; the others are compared with brute force in tests/llm.

op2 and op4 need the tokenizer's merges, op5's verdicts and op8's learned models, op10 is approximate.
"""

from __future__ import annotations

from concordat.llm import url_filter

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LOWERED = f"translate(COALESCE(text, ''), '{UPPER}', '{LOWER}')"


def _escaped_length(column: str) -> str:
    """Characters of a text in op1's template: a doubled backslash, and two more for each control string."""
    controls = ("<s>", "</s>", "[INST]", "[/INST]")
    count = lambda part: f"(length({column}) - length(replace({column}, '{part}', ''))) // {len(part)}"
    return f"length({column}) + length({column}) - length(replace({column}, '\\', '')) + 2 * (" + " + ".join(count(c) for c in controls) + ")"


OP1 = f"""
WITH t AS (SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM (
  SELECT conv_id, turn, role, text FROM conversations UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, COUNT(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(COALESCE(SUM(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(COALESCE(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(SUM(length('<s>[INST]  [/INST]  </s>') + 1 + {_escaped_length("role")} + {_escaped_length("text")}) AS BIGINT) AS formatted_chars, FALSE AS rewrites
FROM t GROUP BY conv_id"""

_DIGITS = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (CAST('0x' || substr(h, {5 * i + 1}, 5) AS BIGINT) // {32 ** (3 - j)}) % 32, 1)" for i in range(8) for j in range(4))
OP3 = f"""
WITH p AS (SELECT page_id, url, strlen(COALESCE(html, '')) AS payload_bytes, sha1(COALESCE(html, '')) AS h, MAX(page_id) OVER (PARTITION BY COALESCE(html, '')) AS last FROM pages),
k AS (SELECT *, CASE WHEN url IS NOT NULL AND contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END AS rest FROM p)
SELECT page_id, payload_bytes, {_DIGITS} AS payload_digest, CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> last THEN last END AS refers_to,
  CASE WHEN rest IS NULL THEN COALESCE(url, '') ELSE array_to_string(list_reverse(string_split(lower(regexp_extract(rest, '^[^/?#]*')), '.')), ',') || ')' ||
    CASE WHEN regexp_replace(rest, '^[^/?#]*', '') = '' THEN '/' ELSE regexp_replace(rest, '^[^/?#]*', '') END END AS url_key,
  strftime(TIMESTAMP '2026-01-01 00:00:00' + to_seconds(page_id % 2147483648), '%Y-%m-%dT%H:%M:%SZ') AS warc_date
FROM k"""

OP6 = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({LOWERED}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) END AS s FROM w),
grams AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS MATERIALIZED (SELECT a.doc_id AS x, b.doc_id AS y FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * COUNT(*) >= 90 * (a.n + b.n - COUNT(*))),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, edges.y FROM reach JOIN edges ON edges.x = reach.r)
SELECT doc_id, len(s) AS n_shingles, component_id FROM sets JOIN (SELECT doc_id, MIN(r) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)"""

_RULES = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in url_filter.RULES)
_LISTED = ", ".join(f"('{h}')" for h in url_filter.LISTED)
OP9 = f"""
WITH rules(verdict, h, p) AS (VALUES {_RULES}), listed(l) AS (VALUES {_LISTED}),
u AS (SELECT page_id, CASE WHEN contains(COALESCE(url, ''), '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
v AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
hosts AS (SELECT DISTINCT host, path FROM v WHERE host <> ''),
fits AS (SELECT host, path, max_by(h || p, length(h || p)) AS rule, max_by(verdict, length(h || p)) AS said FROM hosts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY ALL),
hits AS (SELECT host, max_by(l, length(l)) AS listed_host FROM (SELECT DISTINCT host FROM hosts) JOIN listed ON host = l OR ends_with(host, '.' || l) GROUP BY ALL)
SELECT page_id, host, path, rule, COALESCE(said, CASE WHEN listed_host IS NULL THEN 'allow' ELSE 'block' END) AS verdict, listed_host
FROM v LEFT JOIN fits USING (host, path) LEFT JOIN hits USING (host)"""

_ROUNDS = 10


def _assigned(r: int) -> str:
    """The rows of round r: every vector with its nearest of the centroids c<r>."""
    return f"""n{r} AS MATERIALIZED (SELECT vid, min_by(k, d * 8 + k) AS k, MIN(d) AS d FROM (
  SELECT vid, k, SUM((v.x - c{r}.x) * (v.x - c{r}.x)) AS d FROM v JOIN c{r} USING (i) GROUP BY vid, k) GROUP BY vid)"""


def _moved(r: int) -> str:
    """The centroids of round r + 1; floor of a quotient whose sum may be negative."""
    return f"""c{r + 1} AS MATERIALIZED (SELECT k, i, CASE WHEN n IS NULL THEN c{r}.x ELSE CAST((s - ((s % n) + n) % n) // n AS BIGINT) END AS x
  FROM c{r} LEFT JOIN (SELECT k, i, SUM(x) AS s, COUNT(*) AS n FROM v JOIN n{r} USING (vid) GROUP BY k, i) USING (k, i))"""


OP11 = f"""
WITH kept AS MATERIALIZED (SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS vid, embedding FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: isfinite(e))) = 64),
v AS MATERIALIZED (SELECT vid, i, CAST(floor(1024 * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS x FROM (SELECT vid, embedding, unnest(range(1, 65)) AS i FROM kept)),
first AS (SELECT vid, row_number() OVER (ORDER BY sha256('3:' || CAST(vec_id AS VARCHAR))) - 1 AS k FROM kept),
c0 AS MATERIALIZED (SELECT k, i, x FROM v JOIN first USING (vid) WHERE k < 8),
{", ".join(f"{_assigned(r)}, {_moved(r)}" for r in range(_ROUNDS))}, {_assigned(_ROUNDS)},
names AS (SELECT k, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{_ROUNDS} GROUP BY k)
SELECT vec_id, CAST(k AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(SUM(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
  CAST(SUM(d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM n{_ROUNDS} JOIN kept USING (vid) JOIN names USING (k)"""

OP12 = """
WITH RECURSIVE bits(b, n, c) AS (SELECT b, 0, b FROM (SELECT unnest(range(0, 256)) AS b) UNION ALL
  SELECT b, n + 1, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END FROM bits WHERE n < 8),
crc_table AS MATERIALIZED (SELECT b, c AS t FROM bits WHERE n = 8),
crcs(doc_id, s, c) AS (SELECT doc_id, CAST(doc_id AS VARCHAR), 4294967295 FROM documents UNION ALL
  SELECT doc_id, substr(s, 2), xor(c // 256, t) FROM crcs JOIN crc_table ON b = xor(c % 256, ascii(s)) WHERE s <> ''),
crc AS MATERIALIZED (SELECT doc_id, 4294967295 - c AS h FROM crcs WHERE s = ''),
split AS MATERIALIZED (SELECT doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS made, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) ELSE 0 END AS a, 3 + (h // 10) % 8 AS parts
  FROM (SELECT doc_id, regexp_extract_all(COALESCE(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents) JOIN crc USING (doc_id)),
words AS MATERIALIZED (SELECT doc_id, n, i, CASE WHEN made AND i >= a THEN w[1 + a + (i - a) % (1 + (n - a) // parts)] ELSE w[1 + i] END AS word
  FROM (SELECT doc_id, n, w, made, a, parts, unnest(range(0, n)) AS i FROM split)),
equal AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM words x JOIN words y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
islands AS (SELECT doc_id, q, MIN(i) AS start, COUNT(*) + q AS length FROM (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS g FROM equal)
  GROUP BY doc_id, q, g HAVING COUNT(*) + q >= GREATEST(6, 4 * q)),
runs AS MATERIALIZED (SELECT doc_id, start, length, MIN(q) AS period FROM islands GROUP BY doc_id, start, length),
best AS (SELECT doc_id, COUNT(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed FROM runs GROUP BY doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY CAST(length AS DOUBLE) / period DESC, start, period) AS r FROM runs),
dropped AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t FROM words ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, COALESCE(n_runs, 0) AS n_runs, CAST(start AS BIGINT) AS start, CAST(length AS BIGINT) AS length, CAST(period AS BIGINT) AS period, CAST(1000 * length // period AS BIGINT) AS exponent_milli,
  sha256(COALESCE(listed, '')) AS runs_sha256, sha256(COALESCE(t, '')) AS collapsed_sha256
FROM documents d LEFT JOIN best ON best.doc_id = d.doc_id LEFT JOIN ranked ON ranked.doc_id = d.doc_id AND r = 1 LEFT JOIN kept ON kept.doc_id = d.doc_id"""

ORACLES = {"op11_centroid_clustering": OP11, "op12_periodic_runs": OP12, "op1_chat_formatting": OP1, "op3_warc": OP3, "op6_ngram_jaccard_join": OP6, "op9_url_filter": OP9}

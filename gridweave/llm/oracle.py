"""SQL of the queries that SQL can express."""


def _centroid_rounds(rounds: int = 10) -> str:
    """Points and centroids with a row per component; a round is an assignment and its means."""
    start = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS p
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS MATERIALIZED (SELECT r, unnest(range(64)) AS d, unnest(p) AS x FROM v),
s AS (
  SELECT r, (row_number() OVER (ORDER BY sha256('3:' || vec_id), r) - 1)::INTEGER AS c
  FROM v WHERE vec_id IS NOT NULL QUALIFY c < 8),
c0 AS MATERIALIZED (SELECT c, d, x AS y FROM s JOIN x USING (r))"""
    assign = """,
a{0} AS MATERIALIZED (
  SELECT r, arg_min(c, (t, c)) AS c, min(t) AS t
  FROM (SELECT r, c, sum((x - y) * (x - y))::BIGINT AS t FROM x JOIN c{0} USING (d) GROUP BY r, c) GROUP BY r)"""
    move = """,
c{1} AS MATERIALIZED (
  SELECT c, d, coalesce(z, y) AS y FROM c{0} LEFT JOIN (
    SELECT c, d, ((s - ((s % n) + n) % n) // n)::BIGINT AS z
    FROM (SELECT c, d, sum(x) AS s, count(*) AS n FROM a{0} JOIN x USING (r) GROUP BY c, d)) USING (c, d))"""
    end = """,
n AS (SELECT c, sha256(string_agg(y::VARCHAR, ',' ORDER BY d)) AS h FROM c{0} GROUP BY c)
SELECT vec_id, c AS cluster, t AS distance, (sum(t) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
  (sum(t) OVER ())::BIGINT AS inertia, h AS centroid_sha256
FROM v JOIN a{0} USING (r) JOIN n USING (c)"""
    steps = [assign.format(i) + move.format(i, i + 1) for i in range(rounds)]
    return start + "".join(steps) + assign.format(rounds) + end.format(rounds)


ORACLE = {
    "op12_centroids": _centroid_rounds(),
    "op2_pivot_topk": """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, x.vec_id, list_dot_product(q.v, x.v)::BIGINT AS score
  FROM v q JOIN v x ON q.vec_id % 20 = 0 AND q.vec_id <> x.vec_id),
r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
""",
    "op4_url_templates": r"""
WITH u AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
r AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR suffix(host, '.example.net')) AND prefix(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND prefix(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR suffix(host, '.org')) AND prefix(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR suffix(host, '.net')) AND prefix(path, '/') THEN 'net/' END AS rule
  FROM u),
s AS (
  SELECT *, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' END AS said
  FROM r),
t0 AS (
  SELECT page_id, host, path, rule, said,
    CASE said WHEN 'block' THEN 1 WHEN 'allow' THEN 0 END AS known,
    CASE WHEN path = '' THEN [] ELSE string_split(substr(path, 2), '/') END AS segments,
    host AS parent, host AS template
  FROM s),
c1 AS (SELECT template, segments[1] AS value, count(*) AS n FROM t0 WHERE len(segments) >= 1 GROUP BY 1, 2),
k1 AS (SELECT template, value FROM (SELECT *, sum(n) OVER (PARTITION BY template) AS total FROM c1)
  WHERE n >= 5 AND 50 * n >= total),
t1 AS (
  SELECT page_id, host, path, rule, said, known, segments,
    CASE WHEN len(segments) < 1 THEN t0.parent ELSE t0.template END AS parent,
    CASE WHEN len(segments) < 1 THEN t0.template
         ELSE t0.template || '/' || CASE WHEN k1.value IS NULL THEN '*' ELSE k1.value END END AS template
  FROM t0 LEFT JOIN k1 ON t0.template = k1.template AND t0.segments[1] = k1.value),
c2 AS (SELECT template, segments[2] AS value, count(*) AS n FROM t1 WHERE len(segments) >= 2 GROUP BY 1, 2),
k2 AS (SELECT template, value FROM (SELECT *, sum(n) OVER (PARTITION BY template) AS total FROM c2)
  WHERE n >= 5 AND 50 * n >= total),
t2 AS (
  SELECT page_id, host, path, rule, said, known, segments,
    CASE WHEN len(segments) < 2 THEN t1.parent ELSE t1.template END AS parent,
    CASE WHEN len(segments) < 2 THEN t1.template
         ELSE t1.template || '/' || CASE WHEN k2.value IS NULL THEN '*' ELSE k2.value END END AS template
  FROM t1 LEFT JOIN k2 ON t1.template = k2.template AND t1.segments[2] = k2.value),
c3 AS (SELECT template, segments[3] AS value, count(*) AS n FROM t2 WHERE len(segments) >= 3 GROUP BY 1, 2),
k3 AS (SELECT template, value FROM (SELECT *, sum(n) OVER (PARTITION BY template) AS total FROM c3)
  WHERE n >= 5 AND 50 * n >= total),
t3 AS (
  SELECT page_id, host, path, rule, said, known, segments,
    CASE WHEN len(segments) < 3 THEN t2.parent ELSE t2.template END AS parent,
    CASE WHEN len(segments) < 3 THEN t2.template
         ELSE t2.template || '/' || CASE WHEN k3.value IS NULL THEN '*' ELSE k3.value END END AS template
  FROM t2 LEFT JOIN k3 ON t2.template = k3.template AND t2.segments[3] = k3.value),
t AS (
  SELECT page_id, host, path, rule, said, known,
    CASE WHEN len(segments) > 3 THEN template ELSE parent END AS parent,
    CASE WHEN len(segments) > 3 THEN template || '/**' ELSE template END AS template
  FROM t3),
o AS (SELECT parent, template, count(known) AS n, coalesce(sum(known), 0) AS b FROM t GROUP BY 1, 2),
a AS (SELECT *, sum(n) OVER (PARTITION BY parent) AS an, sum(b) OVER (PARTITION BY parent) AS ab FROM o),
m AS (
  SELECT *, n > 0 AND NOT (an::DOUBLE * (b * (an - n) - (ab - b) * n)::DOUBLE * (b * (an - n) - (ab - b) * n)::DOUBLE
    > 3.84 * (n::DOUBLE * (an - n) * ab * (an - ab))) AS merged
  FROM a),
g AS (
  SELECT parent, template,
    CASE WHEN merged THEN sum(n) FILTER (merged) OVER (PARTITION BY parent) ELSE n END AS labelled,
    CASE WHEN merged THEN sum(b) FILTER (merged) OVER (PARTITION BY parent) ELSE b END AS blocked
  FROM m)
SELECT page_id, host, path, rule, template,
  coalesce(said, CASE WHEN 10 * (2 * blocked + 4) >= 16 * (labelled + 4) THEN 'block' ELSE 'allow' END) AS verdict
FROM t JOIN g USING (parent, template)
""",
    "op8_ngram_jaccard": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[ \t\n\x0B\x0C\r]+'), lambda x: x <> '') AS ws
  FROM documents),
s AS (
  SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []
    WHEN len(ws) < 5 THEN [list_aggregate(ws, 'string_agg', ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 3),
           lambda i: list_aggregate(ws[i:i + 4], 'string_agg', ' '))) END) AS g
  FROM w WHERE ws IS NOT NULL),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o
  FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
e AS (
  SELECT a, b FROM o JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
  WHERE 100 * o >= 75 * (p.n + q.n - o)),
u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r(doc_id, other) AS (
  SELECT a, b FROM u UNION SELECT r.doc_id, u.b FROM r JOIN u ON r.other = u.a),
c AS (SELECT doc_id, min(other) AS low FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(c.low, d.doc_id)) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
""",
    "op9_warc": """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha1(coalesce(html, '')) AS hex, sha256(coalesce(html, '')) AS strong
  FROM pages),
h AS (SELECT strong, max(page_id) AS head FROM p GROUP BY strong)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(hex, (5 * (i // 4) + 1)::INTEGER, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INTEGER + 1, 1)),
    'string_agg', '') AS payload_digest,
  CASE WHEN page_id = head THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = head THEN NULL ELSE head END AS refers_to
FROM p JOIN h USING (strong)
""",
}

"""SQL for the queries that SQL can express, for DuckDB over the same tables."""

SUFFIX_DEDUP = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n FROM documents),
w AS (SELECT doc_id, p, substr(h, 2 * p + 1, 200) AS s FROM (SELECT doc_id, h, unnest(range(0, n - 99)) AS p FROM d)),
hits AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) AS r FROM w) WHERE r > 1),
runs AS (
    SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS g
    FROM (SELECT doc_id, p, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 100 THEN 0 ELSE 1 END AS fresh FROM hits)),
spans AS (SELECT doc_id, min(p) AS a, max(p) + 100 AS b FROM runs GROUP BY doc_id, g),
gaps AS (
    SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b FROM spans
    UNION ALL SELECT doc_id, max(b), NULL FROM spans GROUP BY doc_id
    UNION ALL SELECT doc_id, 0, NULL FROM d WHERE doc_id NOT IN (SELECT doc_id FROM spans)),
kept AS (
    SELECT g.doc_id, string_agg(substr(h, 2 * a + 1, 2 * (coalesce(b, n) - a)), '' ORDER BY a) AS h
    FROM gaps g JOIN d USING (doc_id) GROUP BY g.doc_id),
sizes AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT d.doc_id, d.n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(kept.h)) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest FROM p),
t AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN top END AS refers_to
FROM t
"""

NEAR_DUPLICATES = """
WITH RECURSIVE w AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words
    FROM documents),
s AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) = 1 THEN [words[1]]
        ELSE list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n, md5(string_agg(g, chr(10) ORDER BY g)) AS k FROM s GROUP BY doc_id),
c AS (SELECT k, min(doc_id) AS rep, any_value(n) AS n FROM n GROUP BY k),
f AS (SELECT g, count(*) AS df FROM s JOIN c ON s.doc_id = c.rep GROUP BY g),
r AS (SELECT s.doc_id, c.n, s.g, row_number() OVER (PARTITION BY s.doc_id ORDER BY f.df, s.g) AS i FROM s JOIN c ON s.doc_id = c.rep JOIN f USING (g)),
p AS (SELECT doc_id, g, n FROM r WHERE i <= n - CAST(ceil(0.8 * n) AS BIGINT) + 1),
cand AS (SELECT DISTINCT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb FROM p a JOIN p b ON a.g = b.g AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
common AS (SELECT a, b, na, nb, count(*) AS m FROM cand JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b AND y.g = x.g GROUP BY a, b, na, nb),
e AS (SELECT a, b FROM common WHERE 100 * m >= 80 * (na + nb - m)),
two AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
walk(node, seen) AS (SELECT rep, rep FROM c UNION SELECT two.b, walk.seen FROM walk JOIN two ON two.a = walk.node),
root AS (SELECT node, min(seen) AS root FROM walk GROUP BY node)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(root.root, w.doc_id) AS component_id,
       w.doc_id = coalesce(root.root, w.doc_id) AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN c USING (k) LEFT JOIN root ON root.node = c.rep
"""

EXACT_DEDUP = """
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS s FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, sha256(s) AS text_sha256
FROM t WINDOW w AS (PARTITION BY s)
"""

_NEAREST = """
a{k} AS MATERIALIZED (
    SELECT vec_id, part, any_value(x) AS x, min(dist) AS dist, arg_min(entry, dist * 16 + entry) AS entry
    FROM (SELECT vec_id, p.part, b.entry, p.x, list_sum(list_transform(range(1, len(p.x) + 1), lambda i: (p.x[i] - b.x[i]) * (p.x[i] - b.x[i])))::BIGINT AS dist
          FROM p JOIN b{k} b ON b.part = p.part)
    GROUP BY vec_id, part)"""

_MOVED = """
s{k} AS (SELECT part, entry, i, sum(x[i]) AS s, count(*) AS n FROM a{k}, (SELECT unnest(range(1, (SELECT max(len(x)) + 1 FROM p))) AS i) GROUP BY part, entry, i),
m{k} AS (SELECT part, entry, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS x FROM s{k} GROUP BY part, entry),
b{n} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.x, b.x) AS x FROM b{k} b LEFT JOIN m{k} m USING (part, entry))"""

VECTOR_CODES = (
    """
WITH v AS MATERIALIZED (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS q, row_number() OVER (ORDER BY vec_id) - 1 AS r
    FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT vec_id, r, part, q[part * len(q) // 8 + 1 : (part + 1) * len(q) // 8] AS x FROM (SELECT *, unnest(range(8)) AS part FROM v)),
b0 AS (SELECT part, r AS entry, x FROM p WHERE r < 16),"""
    + ",".join(_NEAREST.format(k=k) + "," + _MOVED.format(k=k, n=k + 1) for k in range(6))
    + ","
    + _NEAREST.format(k=6)
    + """,
c AS (SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(dist) AS BIGINT) AS error FROM a6 GROUP BY vec_id),
d AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b6)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM c JOIN v USING (vec_id), d
"""
)

ORACLES: dict[str, str] = {
    "op4_suffix_dedup": SUFFIX_DEDUP,
    "op7_warc": WARC,
    "op10_near_duplicates": NEAR_DUPLICATES,
    "op12_exact_dedup": EXACT_DEDUP,
    "op13_vector_codes": VECTOR_CODES,
}

"""DuckDB SQL of the queries that SQL can express."""


def _codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Product codes: one assignment and one update per round, written out."""
    sql = [f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label,
    [floor(4096 * x::DOUBLE)::BIGINT FOR x IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
w AS MATERIALIZED (SELECT max(len(e)) // {parts} AS width FROM v),
p AS MATERIALIZED (SELECT r, part, e[part * width + 1 : (part + 1) * width] AS x FROM v, w, range({parts}) t(part)),
c0 AS MATERIALIZED (SELECT part, r - 1 AS entry, x AS c FROM p WHERE r <= {entries})"""]
    for k in range(rounds + 1):
        sql.append(f"""
a{k} AS MATERIALIZED (SELECT r, part, x, min({{'d': d, 'entry': entry}}) AS best FROM (SELECT r, p.part, x, entry,
    list_sum([(a[1] - a[2]) * (a[1] - a[2]) FOR a IN list_zip(x, c)])::BIGINT AS d FROM p JOIN c{k} c ON c.part = p.part)
  GROUP BY r, part, x)""")
        if k < rounds:
            sql.append(f"""
m{k} AS (SELECT part, entry, list(f ORDER BY i) AS c FROM (SELECT part, best.entry AS entry, i,
      (sum(x[i]) - ((sum(x[i]) % count(*)) + count(*)) % count(*))::BIGINT // count(*) AS f
    FROM a{k}, w, range(1, width + 1) t(i) GROUP BY part, best.entry, i) GROUP BY part, entry),
c{k + 1} AS MATERIALIZED (SELECT c.part, c.entry, coalesce(m.c, c.c) AS c FROM c{k} c LEFT JOIN m{k} m ON m.part = c.part AND m.entry = c.entry)""")
    return ",".join(sql) + f""",
s AS (SELECT r, string_agg(printf('%02x', best.entry), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error FROM a{rounds} GROUP BY r)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) FROM c{rounds}) AS codebooks_sha256
FROM s JOIN v USING (r)
"""


ORACLE = {
    "op4_pivot_topk": """
WITH v AS (SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e::DOUBLE[], c.e::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
""",
    "op10_url_filters": r"""
WITH r(rule, host, path, verdict) AS (VALUES
  ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'),
  ('example.org/en/1', 'example.org', '/en/1', 'block'), ('com/fr/', 'com', '/fr/', 'allow'),
  ('com/de/', 'com', '/de/', 'block')),
p(pattern, verdict) AS (VALUES
  ('[?&]utm_source=(feed|mail)', 'block'), ('[?&]ref=x(&|$)', 'block'),
  ('[?&]sessionid=[0-9a-f]+', 'block'), ('/print/[0-9]+', 'block'), ('://ads\.', 'block'),
  ('/tag/[^/?#]+/?$', 'block'), ('[?&]page=1(&|$)', 'allow'), ('/es/[0-9]*7\.html$', 'block'),
  ('/archive/', 'block')),
u AS (SELECT page_id, url, CASE WHEN contains(coalesce(url, ''), '://')
        THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, url, translate(regexp_extract(rest, '^([^/?#]*)', 1),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u)
SELECT h.page_id, h.host, h.path, b.rule, q.pattern,
       coalesce(b.verdict, q.verdict, 'allow') AS verdict
FROM h
LEFT JOIN LATERAL (SELECT rule, verdict FROM r
   WHERE (h.host = r.host OR ends_with(h.host, '.' || r.host)) AND starts_with(h.path, r.path)
   ORDER BY length(rule) DESC LIMIT 1) b ON true
LEFT JOIN LATERAL (SELECT pattern, verdict FROM p WHERE regexp_matches(lower(h.url), p.pattern)
   ORDER BY verdict, pattern LIMIT 1) q ON true
""",
    "op11_ranked_search": r"""
WITH words AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
d AS (SELECT r, doc_id, t, len(t)::BIGINT AS n FROM words WHERE len(t) > 0),
c AS (SELECT count(*)::BIGINT AS N, sum(n)::BIGINT AS L FROM d),
tf AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(t) AS term FROM d) GROUP BY r, term),
q AS (SELECT item_id, term, count(*)::BIGINT AS qf FROM (SELECT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark) GROUP BY item_id, term),
w AS (SELECT term, floor(1000 * ln((2 * c.N + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, c
  WHERE term IN (SELECT term FROM q) GROUP BY term, c.N),
i AS (SELECT tf.r, d.doc_id, tf.term, w.w, (1000000000 * tf.tf) // (1000 * tf.tf + 12 * (100 - 25 + ((25 * d.n * c.N) // c.L))) AS impact
  FROM tf JOIN w ON w.term = tf.term JOIN d ON d.r = tf.r, c),
s AS (SELECT q.item_id, i.r, i.doc_id, sum(q.qf * i.w * i.impact)::BIGINT AS score FROM q JOIN i ON i.term = q.term
  GROUP BY q.item_id, i.r, i.doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 20
""",
    "op13_vector_codes": _codes_sql(),
}

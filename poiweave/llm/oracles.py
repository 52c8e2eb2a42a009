"""DuckDB counterparts of the queries that SQL can express over whole tables."""

from __future__ import annotations

_EXACT = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

_WARC = """
WITH measured AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest,
         min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
  FROM pages
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id > first THEN first END AS refers_to
FROM measured
"""

_URLS = """
WITH cut AS (
  SELECT page_id, regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 1) AS given,
         regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages
), parted AS (
  SELECT page_id, path, translate(given, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host FROM cut
), ruled AS (
  SELECT page_id, host, path,
         CASE WHEN ends_with('.' || host, '.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
              WHEN ends_with('.' || host, '.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
              WHEN ends_with('.' || host, '.net') AND starts_with(path, '/es/') THEN 'net/es/'
              WHEN ends_with('.' || host, '.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
              WHEN ends_with('.' || host, '.com') AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM parted
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""

_DIVERGENCE = """
WITH rows_ AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS body FROM documents
), words AS (
  SELECT r, lang, source, unnest(regexp_extract_all(
           translate(body, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM rows_
), kept AS (SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
counts AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
in_lang AS (SELECT lang, term, sum(n)::HUGEINT AS n FROM counts GROUP BY lang, term),
sizes AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS n FROM in_lang GROUP BY lang),
groups AS (
  SELECT g.lang, g.source, coalesce(c.n, 0)::HUGEINT AS n, coalesce(s.v, 0)::HUGEINT AS v, coalesce(s.n, 0)::HUGEINT AS lang_n
  FROM (SELECT DISTINCT lang, source FROM rows_) g
  LEFT JOIN (SELECT lang, source, sum(n) AS n FROM counts GROUP BY lang, source) c ON g.lang = c.lang AND g.source = c.source
  LEFT JOIN sizes s ON g.lang = s.lang
), share AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.n + g.v) AS p,
         1 + (1000000000::HUGEINT * (l.n + 1)) // (g.lang_n + g.v) AS q
  FROM groups g JOIN kept k ON g.lang = k.lang JOIN in_lang l ON l.lang = k.lang AND l.term = k.term
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
         CAST(coalesce(s.value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source AS one, y.source AS other, sum(((x.p - y.p) * (x.p - y.p)) // y.p) AS value
    FROM share x JOIN share y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source
    GROUP BY x.lang, x.source, y.source
  ) s ON s.lang = a.lang AND s.one = a.source AND s.other = b.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, CAST(((p - q) * (p - q)) // q AS BIGINT) AS value FROM share WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""

_VECTORS = """
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label, len(embedding) // 4 AS w,
         list_transform(embedding, lambda v: CAST(floor(CAST(v AS DOUBLE) * 1024) AS BIGINT)) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
), cut AS MATERIALIZED (
  SELECT r, p, x[p * w + 1 : (p + 1) * w] AS x, w FROM kept, (SELECT unnest(range(4)) AS p)
), book0 AS MATERIALIZED (SELECT p, CAST(r - 1 AS BIGINT) AS e, x AS c FROM cut WHERE r <= 256),
{rounds}
found AS (SELECT r, string_agg(printf('%02x', CAST(best % 256 AS INTEGER)), '' ORDER BY p) AS code, CAST(sum(best // 256) AS BIGINT) AS error FROM near{last} GROUP BY r),
digest AS (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY p, e, i)) AS codebooks_sha256
           FROM (SELECT p, e, unnest(c) AS v, unnest(range(len(c))) AS i FROM book{last}))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN found USING (r), digest
"""

_NEAR = """near{k} AS MATERIALIZED (
  SELECT r, p, min(CAST(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS HUGEINT) * 256 + e) AS best
  FROM cut JOIN book{k} USING (p) GROUP BY r, p
),"""

_BOOK = """mean{k} AS (
  SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c
  FROM (SELECT p, e, i, sum(v) AS s, count(*) AS n
        FROM (SELECT p, CAST(best % 256 AS BIGINT) AS e, unnest(x) AS v, unnest(range(w)) AS i FROM cut JOIN near{before} USING (r, p))
        GROUP BY p, e, i)
  GROUP BY p, e
), book{k} AS MATERIALIZED (SELECT p, e, coalesce(m.c, b.c) AS c FROM book{before} b LEFT JOIN mean{k} m USING (p, e)),"""


def _vector_rounds(rounds: int = 4) -> str:
    """The rounds one after another: SQL has no loop over two tables."""
    steps = [_NEAR.format(k=0)] + [_BOOK.format(k=k, before=k - 1) + _NEAR.format(k=k) for k in range(1, rounds + 1)]
    return _VECTORS.format(rounds="\n".join(steps), last=rounds)


def oracles() -> dict[str, str]:
    return {"op5_warc": _WARC, "op9_exact_dedup": _EXACT, "op11_url_filters": _URLS, "op12_source_divergence": _DIVERGENCE, "op13_vector_codes": _vector_rounds()}

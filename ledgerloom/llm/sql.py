"""DuckDB SQL of the corpus queries that SQL can express."""

from __future__ import annotations

ORACLES = {
    "op4_warc_archive": r"""
WITH bits AS (
  SELECT page_id, sha1(coalesce(html, '')) AS sha1, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
         list_reduce(list_prepend('', list_transform(range(40), lambda i: lpad(bin(('0x' || substr(sha1(coalesce(html, '')), i + 1, 1))::INTEGER), 4, '0'))),
                     lambda a, b: a || b) AS bits
  FROM pages
), named AS (
  SELECT page_id, sha1, payload_bytes,
         list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           list_sum(list_transform(range(5), lambda j: (CASE WHEN substr(bits, 5 * i + j + 1, 1) = '1' THEN 16 >> j ELSE 0 END)))::BIGINT + 1, 1)),
           'string_agg', '') AS payload_digest,
         max(page_id) OVER (PARTITION BY sha1) AS newest
  FROM bits
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = newest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> newest THEN newest END AS refers_to
FROM named
""",
    "op5_source_mix": r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS n FROM documents WHERE doc_id IS NOT NULL
), sources AS (
  SELECT source, sum(n)::BIGINT AS tokens FROM docs GROUP BY source HAVING sum(n) > 0
), shares AS (
  SELECT source, tokens, tokens::DOUBLE / sum(tokens) OVER () AS share, sum(tokens) OVER () AS total FROM sources
), search(i, lo, hi) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT i + 1, CASE WHEN repeated <= 1.25 THEN lo ELSE mid END, CASE WHEN repeated <= 1.25 THEN mid ELSE hi END
  FROM (SELECT i, lo, hi, (lo + hi) / 2 AS mid,
               (SELECT max(pow(share, (lo + hi) / 2 - 1)) / sum(pow(share, (lo + hi) / 2)) FROM shares) AS repeated
        FROM search WHERE i < 50)
), chosen AS (
  SELECT CASE WHEN (SELECT max(1 / share) / count(*) FROM shares) <= 1.25 THEN 0.0 ELSE hi END AS exponent FROM search WHERE i = 50
), weights AS (
  SELECT source, tokens, total, pow(share, (SELECT exponent FROM chosen)) / (SELECT sum(pow(share, (SELECT exponent FROM chosen))) FROM shares) AS weight FROM shares
), plan AS (
  SELECT source, tokens, weight, floor(weight * total + 1e-6)::BIGINT AS quota FROM weights
), passes AS (
  SELECT *, unnest(range(greatest(ceil(quota / tokens), 1)::BIGINT)) AS pass FROM plan
), dealt AS (
  SELECT doc_id, p.source, n, pass, tokens, weight, quota, md5('mix/' || pass || '/' || doc_id) AS place
  FROM docs d JOIN passes p ON d.source IS NOT DISTINCT FROM p.source
), started AS (
  SELECT *, pass * tokens + coalesce(sum(n) OVER (PARTITION BY source, pass ORDER BY place, doc_id
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM dealt
)
SELECT doc_id, source, n AS n_tokens, pass::INTEGER AS pass, start::BIGINT AS start,
       floor(start / greatest(weight * 1000000, 1))::BIGINT AS block
FROM started WHERE start + n <= quota
""",
    "op8_url_rules": r"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), named AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), listed AS (
  SELECT *, CASE
    WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule,
  CASE
    WHEN regexp_matches(host, '^(?:.*\.)?(?:spam|link|content)-farm\.') THEN 'farm host'
    WHEN regexp_matches(host, '^(?:.*[.-])?casino[.-]') THEN 'casino host'
    WHEN regexp_matches(host, '^(?:.*[.-])?bets?[.-]') THEN 'bets host'
    WHEN regexp_matches(host, '^(?:.*[.-])?(?:adult|xxx)-videos?[.-]') THEN 'adult host'
    WHEN regexp_matches(path, '^/(?:.*/)?(?:sid|sessionid)/[0-9a-f]{16,}') THEN 'session path' END AS free
  FROM named
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
            WHEN free IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
       CASE WHEN rule IS NULL THEN free END AS pattern
FROM listed
""",
    "op11_lexical_search": r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), asked AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL
), tfs AS (
  SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL
), lengths AS (
  SELECT doc_id, sum(tf)::BIGINT AS n FROM tfs GROUP BY doc_id
), totals AS (
  SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM lengths
), weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tfs, totals GROUP BY term
), scored AS (
  SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // terms))))::BIGINT AS score
  FROM asked JOIN tfs USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id), totals GROUP BY item_id, doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 20
""",
    # Every given page marks its article; SQL takes what lies between the marks.
    "op12_html_text": r"""
WITH inner_html AS (
  SELECT page_id, url, regexp_replace(regexp_extract(coalesce(html, ''), '<article>(.*?)(?:</article>|$)', 1, 's'), '</?b>', '', 'g') AS h FROM pages
), plain AS (
  SELECT page_id, url, replace(regexp_replace(replace(replace(replace(regexp_replace(h, '<[^>]*>', ' ', 'g'), '&quot;', '"'), '&lt;', '<'), '&gt;', '>'),
                       '&amp;?', chr(1), 'g'), chr(1), '&') AS t FROM inner_html
), spaced AS (
  SELECT page_id, url, trim(regexp_replace(t, '[\s\p{Z}]+', ' ', 'g')) AS text FROM plain
)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM spaced
""",
    "op13_prefix_trie": r"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT DISTINCT conv_id, conv_id - conv_id % 5 AS first,
         xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda i: ord(substr(conv_id::VARCHAR, i::INTEGER, 1))::UBIGINT)),
           lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)::UBIGINT[]), lambda x, k: xor(x >> 1, (x & 1) * 3988292384::UBIGINT))),
           4294967295::UBIGINT) % 9 AS h
  FROM turns
), rebuilt AS (
  SELECT c.conv_id, row_number() OVER (PARTITION BY c.conv_id ORDER BY part, place) AS d, role, text
  FROM (SELECT c.conv_id, 0 AS part, place, role, text FROM convs c JOIN turns t ON t.conv_id = c.first AND t.place <= c.h
        UNION ALL
        SELECT c.conv_id, 1, place, role, text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.place > c.h) c
), steps AS (
  SELECT conv_id, d, strlen(text) AS bytes,
         sha256(string_agg(sha256(strlen(role) || ':' || role || text), '' ORDER BY d) OVER (PARTITION BY conv_id ORDER BY d)) AS node
  FROM rebuilt
), members AS (
  SELECT conv_id, 0 AS d, 0 AS bytes, '' AS node FROM convs
  UNION ALL SELECT conv_id, d, bytes, node FROM steps
), placed AS (
  SELECT *, lag(node) OVER (PARTITION BY conv_id ORDER BY d) AS parent, d = max(d) OVER (PARTITION BY conv_id) AS ends FROM members
), nodes AS (
  SELECT node, any_value(parent) AS parent, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM placed GROUP BY node
), family AS (
  SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent
), within AS (
  SELECT DISTINCT a.node, b.node AS below FROM placed a JOIN placed b ON a.conv_id = b.conv_id AND b.d >= a.d
), sums AS (
  SELECT w.node, count(*) FILTER (WHERE f.node IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.bytes)::BIGINT AS saved_tokens
  FROM within w JOIN nodes n ON n.node = w.below LEFT JOIN family f ON f.node = w.below GROUP BY w.node
)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(f.n_children, 0) AS n_children,
       s.n_leaves, s.saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s ON s.node = n.node LEFT JOIN family f ON f.node = n.node LEFT JOIN nodes p ON p.node = n.parent
""",
}

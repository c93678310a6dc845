"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

SPACES = r"[^\x20\x09-\x0D]+"

# Level filling, once over the sources and once over the length classes of each source; then draws by rank.
MIX = rf"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{SPACES}')), 0)::BIGINT AS size,
         (('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, md5(coalesce(text, '')))), 1, 13))::BIGINT::DOUBLE + 0.5)
           / 4503599627370496.0 AS u
  FROM documents),
docs AS (SELECT *, length(bin(size)) AS class FROM sized),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY 1),
weighed AS (
  SELECT source, source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight,
         (sum(source_size) OVER ())::DOUBLE AS total
  FROM totals),
filled AS (
  SELECT *, (total - coalesce(sum((source_size * 3)::DOUBLE) OVER (ORDER BY source_size / weight, source NULLS LAST
                                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight::DOUBLE) OVER (ORDER BY source_size / weight, source NULLS LAST
                                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
targets AS (
  SELECT source, source_size,
         least((source_size * 3)::DOUBLE, coalesce(max(CASE WHEN level * weight <= source_size * 3 THEN level END) OVER (), 0.0) * weight)
           AS target
  FROM filled),
classes AS (SELECT source, class, sum(size)::BIGINT AS words FROM docs GROUP BY 1, 2),
shared AS (
  SELECT c.source, class, words, source_size, target,
         (target - coalesce(sum((words * 3)::DOUBLE) OVER (PARTITION BY c.source ORDER BY class DESC
                                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
           / sum((words * class)::DOUBLE) OVER (PARTITION BY c.source ORDER BY class DESC
                                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM classes c JOIN targets t ON c.source IS NOT DISTINCT FROM t.source),
expected AS (
  SELECT source, class, source_size, target,
         round(least(3.0::DOUBLE, coalesce(max(CASE WHEN level * class <= 3 THEN level END) OVER (PARTITION BY source), 0.0) * class), 9) AS e
  FROM shared),
ranked AS (
  SELECT d.doc_id, d.source, d.size, x.source_size, x.target, floor(e)::BIGINT AS whole,
         CASE WHEN e - floor(e) > 0 AND d.size > 0
              THEN u * (1 - (e - floor(e))) / (u * (1 - (e - floor(e))) + (1 - u) * (e - floor(e))) END AS rank
  FROM docs d JOIN expected x ON d.source IS NOT DISTINCT FROM x.source AND d.class = x.class),
gap1 AS (SELECT source, max(target) - sum(whole * size)::DOUBLE AS gap FROM ranked GROUP BY 1),
draw1 AS (
  SELECT r.*, coalesce(rank IS NOT NULL AND size <= gap
         AND sum(CASE WHEN rank IS NOT NULL AND size <= gap THEN size ELSE 0 END) OVER (PARTITION BY r.source ORDER BY rank NULLS LAST) <= gap,
         FALSE)::BIGINT AS one
  FROM ranked r JOIN gap1 g ON r.source IS NOT DISTINCT FROM g.source),
gap2 AS (SELECT source, max(target) - sum((whole + one) * size)::DOUBLE AS gap FROM draw1 GROUP BY 1),
draw2 AS (
  SELECT r.* EXCLUDE (one), CASE WHEN one = 1 THEN 1 ELSE coalesce(rank IS NOT NULL AND size <= gap
         AND sum(CASE WHEN rank IS NOT NULL AND one = 0 AND size <= gap THEN size ELSE 0 END)
             OVER (PARTITION BY r.source ORDER BY rank NULLS LAST) <= gap, FALSE)::BIGINT END AS one
  FROM draw1 r JOIN gap2 g ON r.source IS NOT DISTINCT FROM g.source),
gap3 AS (SELECT source, max(target) - sum((whole + one) * size)::DOUBLE AS gap FROM draw2 GROUP BY 1),
closing AS (
  SELECT r.source, min({{'miss': abs(size - gap), 'rank': rank, 'doc_id': doc_id, 'size': size}}) AS last
  FROM draw2 r JOIN gap3 g ON r.source IS NOT DISTINCT FROM g.source
  WHERE one = 0 AND rank IS NOT NULL AND abs(size - gap) < gap GROUP BY 1)
SELECT r.doc_id, r.source, r.size, r.source_size, round(r.target, 6) AS target,
       whole + one + coalesce(r.rank = last.rank AND r.doc_id IS NOT DISTINCT FROM last.doc_id AND r.size = last.size, FALSE)::BIGINT AS copies,
       copies * r.size AS taken
FROM draw2 r LEFT JOIN closing c ON r.source IS NOT DISTINCT FROM c.source
"""

ROUND_TRIP = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes FROM pages),
d AS (SELECT page_id, payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT payload_digest AS digest, min(page_id) AS first_id FROM d WHERE payload_bytes >= 100 GROUP BY 1 HAVING count(*) > 1)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first_id THEN first_id END AS refers_to
FROM d LEFT JOIN f ON payload_digest = digest AND payload_bytes >= 100
"""

CAPTURES = r"""
WITH c AS (
  SELECT page_id, url, lower(nullif(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1), '')) AS host,
         lower(nullif(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*/([^/?#]+)', 1), '')) AS segment,
         DATE '2024-01-01' + CAST(page_id * 7919 % 365 AS INTEGER) AS fetched
  FROM pages),
h AS (SELECT DISTINCT host, ('0x' || substr(md5(host), 1, 6))::INTEGER AS n FROM c WHERE host IS NOT NULL),
parents AS (SELECT DISTINCT regexp_replace(host, '^[^.]*\.', '') AS entry FROM h WHERE host LIKE '%.%'),
p AS (SELECT entry, ('0x' || substr(md5(entry), 1, 6))::INTEGER AS n FROM parents),
s AS (SELECT DISTINCT host || '/' || segment AS entry FROM c WHERE host IS NOT NULL AND segment IS NOT NULL),
q AS (SELECT entry, ('0x' || substr(md5(entry), 1, 6))::INTEGER AS n FROM s),
events AS (
  SELECT 'hosts' AS list, FALSE AS allows, host AS entry, DATE '2024-01-01' + n % 200 AS day, TRUE AS adds FROM h WHERE n % 3 = 0
  UNION ALL SELECT 'hosts', FALSE, host, DATE '2024-01-01' + n % 200 + 60, FALSE FROM h WHERE n % 3 = 0 AND n % 2 = 0
  UNION ALL SELECT 'hosts', FALSE, host, DATE '2024-01-01' + n % 200 + 120, TRUE FROM h WHERE n % 3 = 0 AND n % 4 = 0
  UNION ALL SELECT 'domains', FALSE, entry, DATE '2024-01-01' + n % 300, TRUE FROM p WHERE n % 5 = 0
  UNION ALL SELECT 'sections', TRUE, entry, DATE '2024-01-01' + n % 250, TRUE FROM q WHERE n % 4 = 0
  UNION ALL SELECT 'sections', TRUE, entry, DATE '2024-01-01' + n % 250 + 90, FALSE FROM q WHERE n % 4 = 0),
days AS (SELECT list, allows, entry, day, bool_and(adds) AS adds FROM events GROUP BY ALL),
was AS (SELECT *, coalesce(lag(adds) OVER (PARTITION BY list, allows, entry ORDER BY day), FALSE) AS was FROM days),
changes AS (SELECT *, lead(day) OVER (PARTITION BY list, allows, entry ORDER BY day) AS valid_to FROM was WHERE adds <> was),
intervals AS (SELECT list, allows, entry, day AS valid_from, valid_to FROM changes WHERE adds),
hits AS (
  SELECT c.page_id, i.* FROM c JOIN intervals i
    ON (c.host = i.entry OR ends_with(c.host, '.' || i.entry) OR c.host || '/' || c.segment = i.entry)
   AND i.valid_from <= c.fetched AND (i.valid_to IS NULL OR c.fetched < i.valid_to)),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY length(entry) DESC, allows DESC, list DESC, entry DESC, valid_from DESC) AS place,
         count(*) OVER (PARTITION BY page_id) AS n_active
  FROM hits)
SELECT c.page_id, c.url, c.host, c.fetched, coalesce(n_active, 0) AS n_active,
       CASE WHEN o.page_id IS NULL THEN 'keep' WHEN allows THEN 'allow' ELSE 'block' END AS verdict, o.list, o.entry, o.valid_from
FROM c LEFT JOIN (SELECT * FROM ordered WHERE place = 1) o ON c.page_id = o.page_id
"""

REPEATS = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{SPACES}') AS words FROM documents),
w AS (
  SELECT doc_id, i, md5(array_to_string(words[i : i + 49], ' ')) AS h
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM d WHERE len(words) >= 50)),
m AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY h) AS first_doc FROM w),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS k FROM m WHERE first_doc < doc_id),
lists AS (SELECT doc_id, list(k) AS ks FROM gone GROUP BY 1),
stay AS (
  SELECT d.doc_id, len(words) AS n, words, coalesce(ks, []) AS ks FROM d LEFT JOIN lists l ON d.doc_id = l.doc_id),
left_ AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY k) AS kept, count(*) AS n_kept
  FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS k FROM d) x
  WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = x.doc_id AND g.k = x.k) GROUP BY 1)
SELECT d.doc_id, len(words)::BIGINT AS n_words, len(words) - coalesce(n_kept, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN left_ l ON d.doc_id = l.doc_id
"""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

CONTAINED = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce({_LOWER.format('text')}, ''), '{SPACES}') AS words FROM documents),
b AS (SELECT item_id, regexp_extract_all(coalesce({_LOWER.format('text')}, ''), '{SPACES}') AS words FROM benchmark),
i AS (
  SELECT DISTINCT item_id, k, array_to_string(words[j : j + k - 1], ' ') AS s
  FROM (SELECT item_id, words, least(5, len(words)) AS k, unnest(range(1, len(words) - least(5, len(words)) + 2)) AS j FROM b WHERE len(words) > 0)),
n AS (SELECT item_id, count(*) AS n_shingles FROM i GROUP BY 1),
s AS (
  SELECT doc_id, k, array_to_string(words[j : j + k - 1], ' ') AS s
  FROM (SELECT doc_id, words, k, unnest(range(1, len(words) - k + 2)) AS j FROM d, (SELECT DISTINCT k FROM i) WHERE len(words) >= k)),
m AS (SELECT doc_id, item_id, count(DISTINCT i.s) AS n_shared FROM s JOIN i ON s.k = i.k AND s.s = i.s GROUP BY 1, 2)
SELECT doc_id, item_id, n_shingles, n_shared, round(n_shared / n_shingles, 9) AS containment
FROM m JOIN n USING (item_id) WHERE n_shared >= 0.8 * n_shingles - 1e-9
"""

SHARDS = r"""
WITH steps AS (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v
               FROM (SELECT unnest(range(256))::BIGINT AS i)),
codes AS (SELECT list(v ORDER BY i) AS t FROM steps),
sized AS (
  SELECT doc_id, octet_length(encode(coalesce(text, '')))::BIGINT + 1 AS size,
         xor(list_reduce([4294967295::BIGINT] || list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT),
                         lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1])), 4294967295) AS text_crc32
  FROM documents, codes),
placed AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS before,
         row_number() OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size) AS n, sum(size) OVER () AS total
  FROM sized),
numbered AS (SELECT *, least((before * 2 + size) * 16 // (2 * total), 15)::INTEGER AS shard FROM placed)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, n - min(n) OVER (PARTITION BY shard) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM numbered
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Pairs that share a shingle, then the least id over their links, as far as they reach.
JACCARD = rf"""
WITH RECURSIVE split AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{SPACES}') AS ws FROM documents),
tokens AS (
  SELECT doc_id, unnest(list_distinct([array_to_string(ws[i:i + 3], ' ') FOR i IN range(1, greatest(len(ws) - 3, 1) + 1)])) AS t
  FROM split WHERE len(ws) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM tokens GROUP BY 1),
same AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM tokens a JOIN tokens b ON a.t = b.t AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM same JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * shared >= 85 * (a.n + b.n - shared)),
edges AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reached AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, e.y FROM reached r JOIN edges e ON r.y = e.x)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
JOIN (SELECT x, min(y) AS component_id FROM reached GROUP BY 1) c ON c.x = d.doc_id
"""

DIVERGENCE = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all({_LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents),
occurring AS (SELECT id, lang, source, unnest(ts) AS term FROM docs),
kept AS (SELECT lang, term, count(*)::HUGEINT AS total FROM occurring GROUP BY 1, 2 HAVING count(DISTINCT id) >= 3),
langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(total)::HUGEINT AS alls FROM kept GROUP BY 1),
counts AS (SELECT lang, source, term, count(*)::HUGEINT AS c FROM occurring JOIN kept USING (lang, term) GROUP BY 1, 2, 3),
groups AS (
  SELECT g.lang, g.source, coalesce(sum(c), 0)::HUGEINT AS n
  FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN counts USING (lang, source) GROUP BY 1, 2),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c, 0) AS c, (1 + 1000000000 * (coalesce(c, 0) + 1) // (n + v))::HUGEINT AS p,
         (1 + 1000000000 * (total + 1) // (alls + v))::HUGEINT AS q
  FROM groups g JOIN kept k USING (lang) JOIN langs USING (lang) LEFT JOIN counts USING (lang, source, term)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM shares WHERE c > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
SELECT lang, source, part, item, value, rank::INT AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""

COLLOCATIONS = rf"""
WITH parts AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS part FROM documents),
split AS (SELECT lang, regexp_extract_all(part, '[^\x20\x09]+') AS ws FROM parts),
totals AS (SELECT lang, sum(len(ws))::HUGEINT AS n FROM split GROUP BY 1),
placed AS (SELECT lang, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM split, unnest(range(1, 6)) t(m)),
grams AS (SELECT lang, ws[i:i + m - 1] AS g, count(*)::HUGEINT AS a FROM placed GROUP BY 1, 2 HAVING count(*) >= 100),
cuts AS (SELECT lang, g, a, unnest(range(1, len(g))) AS k FROM grams WHERE len(g) > 1),
scored AS (
  SELECT c.lang, c.g, c.a, k, x.a AS l, y.a AS r, 1000 * c.a * n // (x.a * y.a) AS score
  FROM cuts c JOIN totals USING (lang) JOIN grams x ON x.lang = c.lang AND x.g = c.g[1:k] JOIN grams y ON y.lang = c.lang AND y.g = c.g[k + 1:]),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, k) AS place FROM scored),
covered AS (
  SELECT DISTINCT x.lang, x.g FROM (SELECT lang, a, g[i:i + m - 1] AS g FROM (
    SELECT lang, a, g, m, unnest(range(1, len(g) - m + 2)) AS i FROM grams, unnest(range(2, 5)) t(m) WHERE len(g) > m)) x
  JOIN grams y ON y.lang = x.lang AND y.g = x.g WHERE x.a >= y.a),
ranked AS (
  SELECT b.*, array_to_string(g, ' ') AS phrase,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank
  FROM best b ANTI JOIN covered USING (lang, g) WHERE place = 1)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

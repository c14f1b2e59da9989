"""DuckDB statements for the operators that SQL can express."""

from __future__ import annotations

from cardpanel.llm.url_rules import CONFIDENCE, DEFAULT, RULES, SUPPORT

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DECONTAMINATION = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
patterns AS (
  SELECT DISTINCT item_id, k, w[i:i + k - 1] AS p
  FROM (SELECT item_id, w, least(13, len(w)) AS k, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i
        FROM b WHERE len(w) > 0)),
places AS (
  SELECT rid, i, k, w[i:i + k - 1] AS p
  FROM (SELECT rid, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM d, (SELECT DISTINCT k FROM patterns) WHERE len(w) >= k)),
found AS (SELECT rid, i, k, item_id FROM places JOIN patterns USING (k, p)),
hit AS (
  SELECT rid, count(DISTINCT place) AS n_hit
  FROM (SELECT rid, unnest(range(i, i + k)) AS place FROM found) GROUP BY rid),
items AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM found WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN items USING (rid)
"""

_RULES = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)

# The mined rules by plain counting: every subset of a labelled URL's tokens.
URL_RULES = rf"""
WITH given(verdict, rule_host, rule_path) AS (VALUES {_RULES}),
cut AS (
  SELECT row_number() OVER () AS rid, page_id, url,
         CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT rid, page_id, url, {_LOWER.format("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut),
fit AS (
  SELECT rid, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         arg_max(verdict, length(rule_host || rule_path)) AS verdict
  FROM parts JOIN given ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY rid),
split AS (
  SELECT parts.*, fit.rule, fit.verdict, string_split(host, '.') AS l, string_split(path, '/') AS s
  FROM parts LEFT JOIN fit USING (rid)),
slots AS (
  SELECT rid, unnest([
    ['scheme', {_LOWER.format("regexp_extract(url, '^([^:/?#]*)://', 1)")}],
    ['host1', array_to_string(l[-1:], '.')],
    ['host2', CASE WHEN len(l) >= 2 THEN array_to_string(l[-2:], '.') ELSE '' END],
    ['host3', CASE WHEN len(l) >= 3 THEN array_to_string(l[-3:], '.') ELSE '' END],
    ['label', l[1]], ['path1', coalesce(s[2], '')], ['path2', coalesce(s[3], '')],
    ['ext', regexp_extract(s[-1], '\.([A-Za-z0-9]+)$', 1)],
    ['query', regexp_extract(url, '\?([^=&#]+)', 1)]]) AS kv
  FROM split WHERE host <> ''),
tokens AS (
  SELECT rid, list_sort(list(DISTINCT kv[1] || '=' || regexp_replace(kv[2], '[0-9]+', '#', 'g'))) AS t
  FROM slots WHERE kv[2] <> '' GROUP BY rid),
labelled AS (SELECT rid, t, verdict FROM tokens JOIN split USING (rid) WHERE verdict IS NOT NULL),
total AS (SELECT count(*) AS n FROM labelled),
subsets AS (
  SELECT verdict, list_filter(t, lambda x, i: (m >> (i - 1)) & 1 = 1) AS needs
  FROM (SELECT t, verdict, unnest(range(1, CAST(pow(2, len(t)) AS BIGINT))) AS m FROM labelled)),
counted AS (
  SELECT needs, count(*) AS n_all, count(*) FILTER (verdict = 'allow') AS n_allow,
         count(*) FILTER (verdict = 'block') AS n_block
  FROM subsets GROUP BY needs),
mined AS (
  SELECT needs, verdict, n_with / n_all AS confidence, n_with / n AS support
  FROM (SELECT needs, n_all, 'allow' AS verdict, n_allow AS n_with FROM counted
        UNION ALL SELECT needs, n_all, 'block', n_block FROM counted), total
  WHERE n_with >= ceil({SUPPORT} * n) AND n_with / n_all >= {CONFIDENCE}),
best AS (
  SELECT rid, first(mined.verdict ORDER BY confidence DESC, support DESC, needs, mined.verdict) AS verdict
  FROM split JOIN tokens USING (rid) JOIN mined ON list_has_all(t, needs)
  WHERE split.verdict IS NULL GROUP BY rid)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule,
       coalesce(split.verdict, best.verdict, '{DEFAULT}') AS verdict
FROM split LEFT JOIN best USING (rid)
"""

_CANONICAL = r"""regexp_replace(lower(regexp_extract(rest, '^([^/?]*)', 1)), ':(80|443)$', '')
    || CASE WHEN regexp_extract(rest, '^[^/?]*([^?]*)', 1) = '' THEN '/' ELSE regexp_extract(rest, '^[^/?]*([^?]*)', 1) END
    || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END"""

REVISITS = rf"""
WITH visits AS (
  SELECT page_id, url, sha256(coalesce(html, '')) AS sha, length(html) AS chars, unnest(range(0, 5)) AS v FROM pages),
kinds AS (
  SELECT *, coalesce((v = 0 AND page_id % 11 <> 0) OR (page_id + v) % 4 = 3, true) AS is_full,
         coalesce(list_max(list_filter(range(0, 5), lambda x: x <= v AND ((x = 0 AND page_id % 11 <> 0) OR (page_id + x) % 4 = 3))), 0) AS version,
         coalesce(page_id, 0) + v AS key
  FROM visits),
fields AS (
  SELECT *, DATE '2024-01-01' + CAST(v * 7 + coalesce(page_id, 0) % 5 AS INTEGER) AS day,
         CAST(DATE '2023-01-01' + CAST(version * 3 AS INTEGER) AS VARCHAR) AS seen,
         '"' || substr(sha, 1, 16) || '-' || version || '"' AS version_tag
  FROM kinds),
records AS (
  SELECT page_id * 5 + v AS record_id, is_full, day,
         CASE v WHEN 1 THEN url || '#seen' WHEN 3 THEN regexp_replace(url, '^http://', 'https://') ELSE url END AS url,
         CASE WHEN is_full THEN version_tag WHEN key % 17 = 0 THEN NULL WHEN key % 7 = 0 THEN '"stale"'
              WHEN key % 13 <> 0 THEN 'W/' || version_tag END AS etag,
         CASE WHEN is_full OR key % 17 <> 0 THEN seen END AS changed,
         'max-age=' || (v * 60) AS cached, CAST(coalesce(chars, 0) AS VARCHAR) AS chars, sha || '-' || version AS digest
  FROM fields),
keyed AS (
  SELECT *, list_sort(list_filter(string_split(regexp_extract(rest, '\?(.*)$', 1, 's'), '&'),
                                  lambda p: p <> '' AND NOT starts_with(p, 'utm_'))) AS q
  FROM (SELECT *, regexp_replace(regexp_replace(trim(url), '#.*$', '', 's'), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS rest FROM records)),
urls AS (SELECT *, {_CANONICAL} AS url_key FROM keyed),
met AS (
  SELECT a.record_id, a.url_key, a.day, a.etag, a.changed, a.cached, b.record_id AS response_id, b.day AS old_day,
         b.etag AS old_etag, b.changed AS old_changed, b.cached AS old_cached, b.chars, b.digest,
         row_number() OVER (PARTITION BY a.record_id, a.url_key ORDER BY b.day DESC NULLS LAST, b.record_id DESC) AS nth
  FROM (SELECT * FROM urls WHERE NOT is_full) a
  LEFT JOIN (SELECT * FROM urls WHERE is_full) b ON a.url_key = b.url_key AND b.day < a.day),
judged AS (
  SELECT *, CASE WHEN response_id IS NULL THEN 'no_response'
                 WHEN etag IS NOT NULL AND old_etag IS NOT NULL
                   THEN CASE WHEN regexp_replace(etag, '^W/', '') = old_etag THEN 'matched' ELSE 'mismatch' END
                 WHEN changed IS NOT NULL AND old_changed IS NOT NULL
                   THEN CASE WHEN changed = old_changed THEN 'matched' ELSE 'mismatch' END
                 ELSE 'no_validator' END AS status
  FROM met WHERE nth = 1)
SELECT record_id, url_key, status, CASE WHEN status = 'matched' THEN response_id END AS response_id,
       CASE WHEN status = 'matched' THEN digest END AS payload_digest,
       CASE WHEN status = 'matched' THEN
         'cache-control: ' || cached || chr(10) || 'content-length: ' || chars || chr(10) || 'content-type: text/html'
         || chr(10) || 'date: ' || CAST(day AS VARCHAR) || chr(10) || 'etag: ' || coalesce(etag, old_etag)
         || chr(10) || 'last-modified: ' || coalesce(changed, old_changed) END AS headers
FROM judged
"""

NEAR_DEDUP = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + k - 1], ' ') AS shingle
  FROM (SELECT doc_id, w, least(4, len(w)) AS k, unnest(range(1, len(w) - least(4, len(w)) + 2)) AS i FROM d WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT a, b
  FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM s x JOIN s y USING (shingle)
        WHERE x.doc_id <> y.doc_id GROUP BY ALL)
  JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * common >= 80 * (p.n + q.n - common)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM d
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""

NEAR_VECTORS = r"""
WITH RECURSIVE e AS (
  SELECT row_number() OVER () AS rid, vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
usable AS (
  SELECT * FROM e
  WHERE label IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    AND len(list_filter(v, lambda c: c <> 0)) > 0),
links AS (
  SELECT x.rid AS a, y.rid AS b, y.vec_id AS to_id
  FROM usable x JOIN usable y ON x.label = y.label AND len(x.v) = len(y.v) AND x.rid <> y.rid
  WHERE list_cosine_similarity(x.v, y.v) >= 0.98),
reach AS (
  SELECT rid AS a, rid AS b FROM e
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT e.vec_id, coalesce(n, 0) AS n_links, component_id, e.vec_id IS NOT DISTINCT FROM component_id AS kept
FROM e JOIN (SELECT a AS rid, min(vec_id) AS component_id FROM reach JOIN e ON e.rid = reach.b GROUP BY a) USING (rid)
LEFT JOIN (SELECT a AS rid, count(*) AS n FROM links GROUP BY a) USING (rid)
"""

_TERMS = rf"""regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

RANKED_SEARCH = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS w FROM documents),
sizes AS (SELECT rid, doc_id, CAST(len(w) AS BIGINT) AS n FROM d WHERE len(w) > 0),
total AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS length FROM sizes),
tfs AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(w) AS term FROM d) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tfs, total GROUP BY term),
items AS (SELECT row_number() OVER () AS qid, item_id, {_TERMS} AS w FROM benchmark),
wanted AS (SELECT DISTINCT qid, item_id, unnest(w) AS term FROM items),
scored AS (
  SELECT qid, item_id, doc_id, rid,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * n_docs) // length))))) AS BIGINT) AS score
  FROM wanted JOIN tfs USING (term) JOIN weights USING (term) JOIN sizes USING (rid), total
  GROUP BY qid, item_id, doc_id, rid),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id NULLS LAST, rid) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM placed WHERE rank <= 50
"""

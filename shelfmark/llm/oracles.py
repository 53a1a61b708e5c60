"""DuckDB SQL for the training-data queries that SQL can express."""

_NORM = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP6 = f"""
WITH d AS (SELECT doc_id, {_NORM} AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g ON d.t = g.t
"""

# Records, digests and damage of the archives; the damage follows from the page's number.
OP9 = """
WITH p AS (SELECT page_id, page_id // 512 AS archive, url, coalesce(html, '') AS html,
    page_id % 101 = 7 AS lost,
    CASE WHEN page_id % 97 = 13 THEN substr(html, 1, 19) || '#' || substr(html, 21)
         WHEN page_id % 103 = 5 THEN substr(html, 1, 100) ELSE html END AS other FROM pages),
r AS (SELECT *, 'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10)
    || 'WARC-Record-ID: <urn:page:' || page_id || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url
    || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: '
    || strlen(html) || chr(13) || chr(10) || chr(13) || chr(10) || html || chr(13) || chr(10) || chr(13) || chr(10)
    AS record FROM p),
m AS (SELECT archive, row_number() OVER w - 1 AS place, page_id, sum(strlen(record)) OVER w AS stop,
    strlen(record) AS bytes, sha256(record) AS sha256,
    CASE WHEN lost THEN 'missing' WHEN other <> html THEN 'altered' ELSE 'intact' END AS status
    FROM r WINDOW w AS (PARTITION BY archive ORDER BY page_id)),
n0 AS (SELECT archive, place, stop - bytes AS begin, stop,
    sha256(sha256 || ':' || (stop - bytes)::bigint || ':' || stop::bigint) AS digest FROM m),
n1 AS (SELECT archive, place // 16 AS place, min(begin) AS begin, max(stop) AS stop,
    sha256(string_agg(digest, '' ORDER BY place) || ':' || min(begin)::bigint || ':' || max(stop)::bigint) AS digest
    FROM n0 GROUP BY archive, place // 16),
n2 AS (SELECT archive, place // 16 AS place, min(begin) AS begin, max(stop) AS stop,
    sha256(string_agg(digest, '' ORDER BY place) || ':' || min(begin)::bigint || ':' || max(stop)::bigint) AS digest
    FROM n1 GROUP BY archive, place // 16),
n3 AS (SELECT archive, min(begin) AS begin, max(stop) AS stop,
    sha256(string_agg(digest, '' ORDER BY place) || ':' || min(begin)::bigint || ':' || max(stop)::bigint) AS digest
    FROM n2 GROUP BY archive),
-- Trees end at the first level on which every archive has one node.
top AS (SELECT CASE WHEN (SELECT max(place) FROM n0) = 0 THEN 0 WHEN (SELECT max(place) FROM n1) = 0 THEN 1
    WHEN (SELECT max(place) FROM n2) = 0 THEN 2 ELSE 3 END AS level),
roots AS (SELECT archive, digest FROM n3, top WHERE level = 3
    UNION ALL SELECT archive, digest FROM n2, top WHERE level = 2
    UNION ALL SELECT archive, digest FROM n1, top WHERE level = 1
    UNION ALL SELECT archive, digest FROM n0, top WHERE level = 0)
SELECT m.archive, place, page_id, (stop - bytes)::bigint AS begin, stop::bigint AS stop, sha256, status, digest AS root
FROM m JOIN roots USING (archive)
"""

# Offsets behind a number of lines: their lengths and line feeds, at most the whole text.
OP12 = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(doc_id::varchar, '')) AS h FROM documents),
u AS (SELECT doc_id, t, string_split(t, chr(10)) AS l, CASE WHEN t = '' OR ends_with(t, chr(10)) THEN 0 ELSE 1 END
    + length(t) - length(replace(t, chr(10), '')) AS n, ('0x' || substr(h, 1, 8))::bigint AS h1,
    ('0x' || substr(h, 9, 8))::bigint AS h2, ('0x' || substr(h, 17, 8))::bigint AS h3,
    ('0x' || substr(h, 25, 8))::bigint AS h4 FROM d),
f AS (SELECT doc_id, t, n, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
    OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
    [length(x) + 1 for x in l] AS sizes, least(h1 % (n + 1), h2 % (n + 1)) AS a,
    greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM u),
c AS (SELECT doc_id, t, n, form,
    CASE WHEN a = 0 THEN 0 ELSE least(length(t), list_sum(sizes[1:a])) END AS p,
    CASE WHEN b = 0 THEN 0 ELSE least(length(t), list_sum(sizes[1:b])) END AS m FROM f),
o AS (SELECT doc_id, n, form, p, m, t, substr(t, 1, p::bigint) AS prefix, substr(t, p::bigint + 1, (m - p)::bigint) AS middle,
    substr(t, m::bigint + 1) AS suffix FROM c)
SELECT doc_id, n::bigint AS n, form, CASE WHEN form <> 'plain' THEN p::bigint END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN (m - p)::bigint END AS middle_chars,
    sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE t END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM o
"""

_PARTS = r"'(?s)^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?'"
OP13 = f"""
WITH p AS (SELECT page_id, url, translate(coalesce(regexp_extract(url, {_PARTS}, 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS host, coalesce(regexp_extract(url, {_PARTS}, 2), '') AS path,
    coalesce(regexp_extract(url, {_PARTS}, 3), '') AS query FROM pages),
k AS (SELECT *, array_to_string([x for x in string_split(query, '&') if x <> '' AND NOT starts_with(x, 'utm_')], '&')
    AS kept FROM p),
c AS (SELECT page_id, host, path, CASE WHEN contains(url, '://') THEN regexp_replace(regexp_replace(host, '^www\\.', ''),
    ':(80|443)$', '') || regexp_replace(path, '/+$', '') || CASE WHEN kept <> '' THEN '?' || kept ELSE '' END END
    AS canonical FROM k),
r AS (SELECT *, CASE
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule FROM c),
l AS (SELECT DISTINCT canonical FROM c WHERE regexp_matches(host, '(^|[.-])(ads|adult|bets|casino|pills|spam)([.-]|$)'))
SELECT page_id, host, path, rule, l.canonical IS NOT NULL AS listed, CASE
    WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN l.canonical IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM r LEFT JOIN l ON r.canonical = l.canonical
"""

ORACLES = {"op6_exact_dedup": OP6, "op9_warc_fixity": OP9, "op12_fill_middle": OP12, "op13_url_filter": OP13}

"""DuckDB statements that give the same rows as the queries of the same name."""

MIXING_TARGETS = r"""
sized AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM {docs}),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
turns AS (SELECT *, ([5, 2, 1])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight,
  source_size * 3 AS cap, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS turn FROM sources),
levels AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER soon, 0))::DOUBLE
    / (sum(weight) OVER () - coalesce(sum(weight) OVER soon, 0))::DOUBLE AS level,
  row_number() OVER (ORDER BY cap / weight, turn) AS place
  FROM turns WINDOW soon AS (ORDER BY cap / weight, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
common AS (SELECT arg_min(level, place) AS level FROM levels WHERE level * weight <= cap),
targets AS (SELECT source, source_size, least(weight * common.level, cap::DOUBLE) AS target FROM levels, common),
drawn AS (SELECT doc_id, size, source_size, target,
  CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
  ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source),
taking AS (SELECT *, (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS copies FROM drawn)
"""

MIXING = "WITH " + MIXING_TARGETS.format(docs="documents") + """
SELECT doc_id, size, source_size, target, size * copies AS taken, copies FROM taking
"""

URLS = r"""
WITH parts AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
ruled AS (SELECT *, CASE
  WHEN ('.' || host) LIKE '%.www.example.com' AND path LIKE '/en/%' THEN 'www.example.com/en/'
  WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/en/%' THEN 'example.com/en/'
  WHEN ('.' || host) LIKE '%.net' AND path LIKE '/es/%' THEN 'net/es/'
  WHEN ('.' || host) LIKE '%.net' AND path LIKE '/fr/%' THEN 'net/fr/'
  WHEN ('.' || host) LIKE '%.com' AND path LIKE '/%' THEN 'com/' END AS rule FROM parts)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict FROM ruled
"""

# Units as arrays; parts are joined from them.
MIDDLES = r"""
WITH cut AS (SELECT doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
    sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS digest FROM documents),
drawn AS (SELECT *, len(units)::BIGINT AS n, ('0x' || digest[1:8])::BIGINT % (len(units) + 1) AS one,
    ('0x' || digest[9:16])::BIGINT % (len(units) + 1) AS two,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
        OR ('0x' || digest[17:24])::BIGINT % 100 >= 50 THEN 'plain'
      WHEN ('0x' || digest[25:32])::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM cut),
parts AS (SELECT doc_id, text, n, form, array_to_string(units[1:least(one, two)], '') AS prefix,
    array_to_string(units[least(one, two) + 1:greatest(one, two)], '') AS middle,
    array_to_string(units[greatest(one, two) + 1:], '') AS suffix FROM drawn)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256 FROM parts
"""

DIVERGENCE = r"""
WITH docs AS (SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
found AS (SELECT doc, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term FROM found GROUP BY ALL HAVING count(DISTINCT doc) >= 30),
sizes AS (SELECT lang, count(*)::HUGEINT AS v FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
counted AS (SELECT lang, source, term, count(*) AS n FROM found JOIN kept USING (lang, term) GROUP BY ALL),
dense AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0)::HUGEINT AS n FROM groups g JOIN kept k USING (lang)
  LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
summed AS (SELECT *, sum(n) OVER (PARTITION BY lang, source) AS total, sum(n) OVER (PARTITION BY lang) AS all_total,
  sum(n) OVER (PARTITION BY lang, term) AS all_n FROM dense),
rated AS (SELECT lang, source, term, n, 1 + (1000000000 * (n + 5)) // (total + 5 * v) AS p,
  1 + (1000000000 * (all_n + 5)) // (all_total + 5 * v) AS q FROM summed JOIN sizes USING (lang)),
apart AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM rated a JOIN rated b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
parts AS (SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(value, 0)::BIGINT AS value
    FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source
    LEFT JOIN apart a ON a.lang = g.lang AND a.source = g.source AND a.item = h.source
  UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM rated WHERE n > 0 AND p > q)
SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM parts
QUALIFY part = 'pair' OR rank <= 50
"""

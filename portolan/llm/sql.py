"""DuckDB equivalents of the queries that SQL can express, over whole tables."""

WORD = r"[^\x20\x09-\x0D]+"

_REACH = """
reach(node, root) AS (
  SELECT id, id FROM nodes UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.node),
component AS (SELECT node, min(root) AS component_id FROM reach GROUP BY node)
"""

NEAR_VECTORS = f"""
WITH RECURSIVE usable AS (
  SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
nodes AS (SELECT vec_id AS id FROM embeddings),
links AS (
  SELECT a.id AS a, b.id AS b FROM usable a JOIN usable b ON a.id <> b.id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.95), {_REACH}
SELECT n.id AS vec_id, (SELECT count(*) FROM links l WHERE l.a = n.id) AS n_links, c.component_id,
       n.id = c.component_id AS kept
FROM nodes n JOIN component c ON c.node = n.id
"""

URL_VERDICTS = r"""
WITH rules(host, path, verdict) AS (VALUES
  ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
parts AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
fits AS (
  SELECT p.*, r.host || r.path AS rule, r.verdict,
    row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.host || r.path) DESC) AS place
  FROM parts p LEFT JOIN rules r
    ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE place = 1
"""

SHINGLE_JOIN = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents),
nodes AS (SELECT doc_id AS id FROM documents),
places AS (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0),
grams AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS gram FROM places),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 10 * k >= 8 * (x.n + y.n - k)), {_REACH}
SELECT n.id AS doc_id, (SELECT count(*) FROM links l WHERE l.a = n.id) AS n_links, c.component_id AS class_id,
       n.id = c.component_id AS kept
FROM nodes n JOIN component c ON c.node = n.id
"""

_OFFSET = """(('0x' || substr(md5('mix' || d || ':' || coalesce('=' || source, 'null')), 1, 8))::BIGINT::DOUBLE
  / 4294967296.0)"""

SOURCE_MIX = rf"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
listed AS (
  SELECT *, row_number() OVER (ORDER BY encode(source) ASC NULLS LAST) AS place FROM per),
weighed AS (
  SELECT *, [5, 2, 1][((place - 1) % 3 + 1)::INT] AS weight, 3.0::DOUBLE * source_size AS most FROM listed),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(most) OVER (
      ORDER BY most / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
    / sum(weight) OVER (ORDER BY most / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
settled AS (SELECT arg_min(level, place2) AS level FROM (
  SELECT level, row_number() OVER (ORDER BY most / weight, place) AS place2 FROM levels WHERE level * weight < most)),
goals AS (
  SELECT source, source_size, coalesce(least(most, s.level * weight), most) AS target FROM levels, settled s),
ranked AS (
  SELECT z.*, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS expected,
    row_number() OVER (PARTITION BY z.source ORDER BY size DESC, doc_id) AS place
  FROM sized z JOIN goals g ON z.source IS NOT DISTINCT FROM g.source),
draws AS (SELECT source, d, {_OFFSET} AS shift FROM per, range(16) t(d)),
tried AS (
  SELECT r.source, shift, abs(sum((floor(expected * place + shift) - floor(expected * (place - 1) + shift)) * size)
    - any_value(target)) AS miss
  FROM ranked r JOIN draws d ON r.source IS NOT DISTINCT FROM d.source GROUP BY r.source, shift),
chosen AS (SELECT source, arg_min(shift, {{'miss': miss, 'shift': shift}}) AS shift FROM tried GROUP BY source)
SELECT doc_id, r.source, size, source_size, target,
  (floor(expected * place + shift) - floor(expected * (place - 1) + shift))::BIGINT AS copies,
  ((floor(expected * place + shift) - floor(expected * (place - 1) + shift)) * size)::BIGINT AS taken
FROM ranked r JOIN chosen c ON r.source IS NOT DISTINCT FROM c.source
"""

LINE_RULES = rf"""
WITH w AS (SELECT doc_id, source, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents),
counts AS (
  SELECT doc_id, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols FROM w),
lines AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM w),
worded AS (SELECT *, regexp_extract_all(line, '{WORD}') AS ws FROM lines WHERE regexp_matches(line, '{WORD}')),
dups AS (SELECT doc_id, sum(n - 1)::BIGINT AS n_dup_lines FROM (
  SELECT doc_id, line, count(*) AS n FROM worded GROUP BY 1, 2) GROUP BY 1),
places AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) > 2),
windows AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(ws[i:i + 2], ' ')) AS n FROM places),
repeats AS (SELECT doc_id, count(DISTINCT i + d) AS n_repeat_words
  FROM windows, range(3) t(d) WHERE n > 1 GROUP BY doc_id),
plain AS (
  SELECT doc_id, coalesce('=' || source, '') AS host, len(ws) AS n,
    translate(array_to_string(ws, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line
  FROM worded),
hosts AS (SELECT coalesce('=' || source, '') AS host, greatest(20.0, count(*) * 0.1) AS most FROM documents GROUP BY 1),
often AS (SELECT p.host, line FROM plain p JOIN hosts h ON h.host = p.host
  GROUP BY p.host, line, most HAVING count(DISTINCT doc_id) > most),
lost AS (SELECT doc_id, sum(n)::BIGINT AS n FROM plain JOIN often USING (host, line) GROUP BY doc_id)
SELECT *, NOT base_failed AND n_words - n_common_words >= 0.2 * n_words AS kept FROM (
  SELECT c.doc_id, n_words, word_chars, n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words,
    n_words < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * n_words AS base_failed,
    coalesce(lost.n, 0) AS n_common_words
  FROM counts c LEFT JOIN dups USING (doc_id) LEFT JOIN repeats USING (doc_id) LEFT JOIN lost USING (doc_id))
"""

PASSAGES = rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents),
starts AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM w WHERE len(ws) >= 35),
edges AS (SELECT doc_id, i, count(*) OVER (PARTITION BY md5(array_to_string(ws[i:i + 34], ' '))) AS n FROM starts),
gone AS (SELECT DISTINCT doc_id, i + d AS i FROM edges, range(35) t(d) WHERE n > 1),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w),
left_over AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS kept FROM words ANTI JOIN gone USING (doc_id, i)
  GROUP BY doc_id)
SELECT w.doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN left_over USING (doc_id)
"""

WARC_RECORDS = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS hex,
  min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(hex, (i // 4 * 5 + 1)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31)::INT + 1, 1)), '')
    AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM h
"""

HARD_NEGATIVES = """
WITH q AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
    list_dot_product(a.v, b.v)::BIGINT AS score
  FROM q a JOIN q b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0),
positives AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER best AS rank, n.id AS negative_id, positive_score,
  n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 30 * positive_score <= 100 * n.score AND 100 * n.score <= 90 * positive_score
WINDOW best AS (PARTITION BY p.anchor_id, positive_id ORDER BY n.score DESC, n.id)
QUALIFY row_number() OVER best <= 10
"""

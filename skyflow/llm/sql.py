"""DuckDB SQL of those queries that SQL can express."""

from .licenses import TEMPLATES

NEAR_DUPLICATES = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
shingles AS (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END) AS s
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a)
SELECT d.doc_id, coalesce(max(s.n), 0)::BIGINT AS n_shingles, min(r.b) AS component_id, d.doc_id = min(r.b) AS kept
FROM documents d JOIN reach r ON r.a = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id GROUP BY d.doc_id
"""

SUBSTRING_DEDUP = r"""
WITH words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
starts AS (SELECT doc_id, unnest(range(1, len(w) - 33)) AS i FROM words WHERE len(w) >= 35),
windows AS (SELECT s.doc_id, i, array_to_string(w[i:i + 34], ' ') AS x FROM starts s JOIN words USING (doc_id)),
again AS (SELECT x FROM windows GROUP BY x HAVING count(*) > 1),
covered AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM windows JOIN again USING (x)),
removed AS (SELECT doc_id, list(i) AS r FROM covered GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(r), 0)::BIGINT AS n_removed,
  sha256(array_to_string(CASE WHEN r IS NULL THEN w ELSE list_transform(list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(r, i)), lambda i: w[i]) END, ' ')) AS kept_sha256
FROM words LEFT JOIN removed USING (doc_id)
"""

SEARCH = r"""
WITH words AS (
  SELECT doc_id, unnest(list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                         '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS t FROM documents),
tf AS (SELECT doc_id, t, count(*) AS c FROM words GROUP BY ALL),
lengths AS (SELECT d.doc_id, coalesce(sum(c), 0) AS dl FROM documents d LEFT JOIN tf USING (doc_id) GROUP BY d.doc_id),
stats AS (SELECT count(*) AS n, avg(dl) AS mean FROM lengths),
df AS (SELECT t, ln(1 + ((SELECT n FROM stats) - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM tf GROUP BY t),
scores AS (
  SELECT q.doc_id AS query_id, x.doc_id, round(sum(idf * x.c * 2.2 / (x.c + 1.2 * (0.25 + 0.75 * dl / (SELECT mean FROM stats)))), 6) AS score
  FROM tf q JOIN tf x USING (t) JOIN df USING (t) JOIN lengths l ON l.doc_id = x.doc_id WHERE q.doc_id % 50 = 0 GROUP BY 1, 2)
SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id)::INTEGER AS rank, score FROM scores
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) <= 10
"""

#: A paragraph names a licence if it has at least 0.6 of the word pairs of one of its templates.
LICENSES = r"""
WITH templates(family, t) AS (VALUES {templates}),
lines AS (SELECT doc_id, unnest(regexp_split_to_array(coalesce(text, ''), '[\r\n]+')) AS line FROM documents),
numbered AS (SELECT doc_id, row_number() OVER () AS n, line FROM lines),
tokens AS (SELECT doc_id, n, list_transform(regexp_extract_all(lower(line), '[\p{{L}}\p{{N}}][\p{{L}}\p{{N}}.\-]*'), lambda w: rtrim(w, '.-')) AS w FROM numbered),
pairs AS (SELECT DISTINCT doc_id, n, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS p FROM tokens WHERE len(w) > 1),
own AS (SELECT family, t, list_transform(regexp_extract_all(lower(t), '[\p{{L}}\p{{N}}][\p{{L}}\p{{N}}.\-]*'), lambda w: rtrim(w, '.-')) AS w FROM templates),
wanted AS (SELECT DISTINCT family, t, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS p FROM own),
sizes AS (SELECT family, t, count(*) AS n_pairs FROM wanted GROUP BY ALL),
shares AS (
  SELECT doc_id, n, s.family, count(*) / any_value(n_pairs) AS share FROM pairs JOIN wanted w USING (p) JOIN sizes s ON s.family = w.family AND s.t = w.t
  GROUP BY doc_id, n, s.family, s.t HAVING count(*) >= 0.6 * any_value(n_pairs)),
best AS (SELECT doc_id, n, arg_max(family, share) AS family FROM shares GROUP BY doc_id, n),
found AS (SELECT doc_id, string_agg(DISTINCT family, ',' ORDER BY family) AS licenses, count(*) AS n_paragraphs FROM best GROUP BY doc_id)
SELECT d.doc_id, coalesce(licenses, '') AS licenses, coalesce(n_paragraphs, 0)::BIGINT AS n_paragraphs FROM documents d LEFT JOIN found USING (doc_id)
"""

LICENSES = LICENSES.format(templates=", ".join("('{}', '{}')".format(f, t.replace("'", "''")) for f, texts in TEMPLATES.items() for t in texts))

_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({0}, ''), lambda c: ascii(c)::BIGINT)),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""
_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

#: Row by row, the cheapest edits up to each state (0 nothing said, 1 system, 2 user, 3 assistant).
CONVERSATION_REPAIR = rf"""
WITH RECURSIVE base AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_CRC32.format("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS h FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
    CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE WHEN h = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM base WHERE h <> 0),
ordered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
marked AS (
  SELECT *, left(role, 1) AS c, rtrim(text, {_SPACE}) AS t, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS seen,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM ordered),
coded AS (
  SELECT conv_id, i, turn, role, text, c, t = '' AS blank, t <> '' AND seen > 1 AS duplicate,
    t <> '' AND seen = 1 AND NOT regexp_matches(right(t, 1), '[.!?]') AS truncated, before IS NOT NULL AND before || c NOT IN ('su', 'ua', 'au') AS illegal,
    CASE WHEN t = '' OR seen > 1 THEN 'd' ELSE CASE WHEN c IN ('s', 'u', 'a') THEN c ELSE 'x' END || CASE WHEN regexp_matches(right(t, 1), '[.!?]') THEN '' ELSE '+' END END AS code
  FROM marked),
says(r, s, t) AS (VALUES ('s', 0, 1), ('u', 0, 2), ('u', 1, 2), ('u', 3, 2), ('a', 2, 3)),
step(s, t) AS (VALUES (0, 2), (1, 2), (2, 3), (3, 2)),
codes(code, r, more) AS (VALUES ('d', '-', 0), ('s', 's', 0), ('u', 'u', 0), ('a', 'a', 0), ('x', '-', 0), ('s+', 's', 1), ('u+', 'u', 1), ('a+', 'a', 1), ('x+', '-', 1)),
edits AS (
  SELECT code, s, s AS t, 3 AS cost, 'D' AS letters FROM codes, step
  UNION ALL SELECT code, s, t, more, 'K' FROM codes JOIN says USING (r)
  UNION ALL SELECT code, s, t, 2 + more, 'R' FROM codes, step WHERE code <> 'd'),
inserts AS (
  SELECT s, s AS t, 0 AS cost, '' AS letters FROM step UNION ALL SELECT s, t, 2, 'I' FROM step
  UNION ALL SELECT a.s, b.t, 4, 'II' FROM step a JOIN step b ON a.t = b.s),
moves AS (SELECT e.code, i.s, e.t, i.cost + e.cost AS cost, i.letters || e.letters AS letters FROM inserts i JOIN edits e ON e.s = i.t),
best AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, 0 AS s, {{'cost': 0::BIGINT, 'audit': ''}} AS way FROM coded
  UNION ALL
  SELECT b.conv_id, b.i + 1, m.t, min({{'cost': b.way.cost + m.cost, 'audit': b.way.audit || m.letters}})
  FROM best b JOIN coded c ON c.conv_id IS NOT DISTINCT FROM b.conv_id AND c.i = b.i + 1 JOIN moves m ON m.code = c.code AND m.s = b.s GROUP BY 1, 2, 3),
counts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank, count_if(duplicate) AS duplicate,
    count_if(truncated) AS truncated, count_if(illegal) AS illegal FROM coded GROUP BY conv_id),
ended AS (
  SELECT b.conv_id, min({{'cost': b.way.cost + e.cost, 'audit': b.way.audit || e.letters}}) AS way
  FROM best b JOIN counts n ON n.conv_id IS NOT DISTINCT FROM b.conv_id AND n.n = b.i JOIN inserts e ON e.s = b.s AND e.t IN (0, 3) GROUP BY 1),
letters AS (SELECT conv_id, way.audit AS audit, unnest(range(1, len(way.audit) + 1)) AS k FROM ended),
placed AS (
  SELECT conv_id, k, audit[k] AS letter, len(replace(audit[1:k], 'I', '')) AS i, len(replace(audit[1:k], 'D', '')) AS j FROM letters),
said AS (
  SELECT p.*, c.role, c.text, c.c, max(CASE WHEN j = 1 AND letter = 'K' AND c.c = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY p.conv_id) AS led
  FROM placed p LEFT JOIN coded c ON c.conv_id IS NOT DISTINCT FROM p.conv_id AND c.i = p.i AND p.letter <> 'I'),
lines AS (
  SELECT conv_id, k, CASE WHEN letter = 'K' THEN role WHEN (j - led) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END AS line
  FROM said WHERE letter <> 'D'),
repaired AS (SELECT conv_id, string_agg(line, chr(10) ORDER BY k) AS body FROM lines GROUP BY conv_id)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(way.cost, 0)::BIGINT AS cost, coalesce(way.audit, '') AS audit,
  sha256(coalesce(body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) e
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id LEFT JOIN ended w ON w.conv_id IS NOT DISTINCT FROM e.conv_id
LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM e.conv_id
"""

LEXICAL_SEARCH = r"""
WITH words AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
docs AS (SELECT r, doc_id, len(w)::BIGINT AS n FROM words WHERE len(w) > 0),
whole AS (SELECT count(*)::BIGINT AS N_docs, sum(n)::BIGINT AS L FROM docs),
items AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
tf AS (SELECT r, t, count(*)::BIGINT AS tf FROM (SELECT r, unnest(w) AS t FROM words) WHERE t IN (SELECT t FROM items) GROUP BY r, t),
weights AS (SELECT t, floor(1000 * ln((2.0::DOUBLE * N_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, whole GROUP BY t, N_docs),
scores AS (
  SELECT item_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * N_docs) // L))))::BIGINT AS score
  FROM items JOIN tf USING (t) JOIN weights USING (t) JOIN docs USING (r), whole GROUP BY item_id, r),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
  FROM scores JOIN docs USING (r) WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 50
"""

#: Each turn has 15 characters of marks and line breaks.
CHAT_FORMATTING = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')) v(conv_id, turn, role, text)),
sized AS (
  SELECT *, len(replace(replace(replace(role, '\', '\\'), '<', '\<'), chr(10), '\n')) + len(replace(replace(text, '\', '\\'), '<', '\<')) AS escaped FROM said)
SELECT conv_id::BIGINT AS conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(len(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(escaped + 15)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""

"""What the registered queries must equal, as SQL over the same tables."""

from __future__ import annotations

MIXING = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '') || '|'), 1, 15))::BIGINT AS place
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS HUGEINT) AS source_size,
    (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1 AS weight
  FROM sized GROUP BY source
), ranked AS (
  SELECT *, coalesce(sum(3 * source_size) OVER b, 0) AS full_before, coalesce(sum(weight) OVER b, 0) AS weight_before,
    sum(source_size) OVER () AS total, sum(weight) OVER () AS weights
  FROM sources
  WINDOW b AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), marked AS (
  SELECT *, 3 * source_size * (weights - weight_before) <= (total - full_before) * weight AS is_full FROM ranked
), wanted AS (
  SELECT source, source_size, CASE WHEN is_full THEN CAST(3 * source_size AS DOUBLE) ELSE
    CAST(weight AS DOUBLE) * CAST(total - coalesce(sum(CASE WHEN is_full THEN 3 * source_size END) OVER (), 0) AS DOUBLE)
      / CAST(sum(CASE WHEN NOT is_full THEN weight END) OVER () AS DOUBLE) END AS target
  FROM marked
), rounds AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / CAST(source_size AS DOUBLE)) ELSE 0 END AS rounds FROM wanted
), budgets AS (
  SELECT *, target - rounds * CAST(source_size AS DOUBLE) AS rest FROM rounds
), places AS (
  SELECT source, place, size, sum(size) OVER (PARTITION BY source ORDER BY place) AS after
  FROM (SELECT source, place, sum(size) AS size FROM sized GROUP BY ALL)
)
SELECT d.doc_id, CAST(d.size AS BIGINT) AS size, CAST(b.source_size AS BIGINT) AS source_size, b.target,
  CAST(d.size * (b.rounds + CASE WHEN 2 * (p.after - p.size) + p.size < 2 * b.rest THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM sized d JOIN budgets b ON d.source IS NOT DISTINCT FROM b.source
JOIN places p ON d.source IS NOT DISTINCT FROM p.source AND d.place = p.place
"""

# the template's own strings, as the formatted length counts them
CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked AS (
  SELECT *, lag(role) OVER w IS NOT DISTINCT FROM role AS follows,
    length(role) + length(regexp_replace(role, '[^\\\x{2402}<\[]', '', 'g')) AS role_chars,
    length(text) + length(regexp_replace(text, '[^\\\x{2402}<\[]', '', 'g')) AS text_chars
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(text_chars + CASE WHEN follows THEN length('\u2402part:') ELSE role_chars + length('\u2402role:') + length('\u2402text:') + length('\u2402end:') END) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
""".replace("\\u2402", "\u2402")

ARCHIVE = """
WITH sized AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), first AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM sized
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND first <> page_id THEN first END AS refers_to
FROM first
"""

# crc32 byte by byte, with the table of its polynomial
SPELLING = r"""
WITH RECURSIVE crc AS MATERIALIZED (
  SELECT list_transform(range(256), lambda x: list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), runs AS (
  SELECT id, run, count(*) AS times FROM (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run
    FROM documents
  ) WHERE length(run) >= 6 GROUP BY ALL
), hashed AS (
  SELECT run, times, xor(4294967295, list_reduce([4294967295] || flatten(list_transform(string_split(id || ':' || run, ''),
    lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [192 | (unicode(c) >> 6), 128 | (unicode(c) & 63)] END)),
    lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1]))) AS h
  FROM runs, crc
), words AS MATERIALIZED (
  SELECT word, CAST(sum(times) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word, times
    FROM hashed
  ) WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5
), cut AS MATERIALIZED (
  SELECT word, i, substr(word, 1, i - 1) AS head, substr(word, i + 1) AS tail
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS MATERIALIZED (
  SELECT x.word AS a, y.word AS b FROM cut x JOIN cut y ON x.i = y.i AND x.head = y.head AND x.tail = y.tail AND x.word <> y.word
  UNION SELECT c.word, w.word FROM cut c JOIN words w ON c.head || c.tail = w.word
  UNION SELECT w.word, c.word FROM cut c JOIN words w ON c.head || c.tail = w.word
), best AS (
  SELECT a AS word, count(*) AS n_near, first(b ORDER BY n DESC, b) AS b, max(n) AS most FROM near JOIN words ON b = word GROUP BY a
), formed AS MATERIALIZED (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 5 * n THEN b END AS form, CASE WHEN most >= 5 * n THEN most END AS form_n
  FROM words LEFT JOIN best USING (word)
), path AS (
  SELECT word, word AS root, form AS further FROM formed
  UNION ALL SELECT p.word, f.word, f.form FROM path p JOIN formed f ON p.further = f.word
)
SELECT f.word, f.form, p.root, f.n, CAST(f.n_near AS BIGINT) AS n_near, CAST(f.form_n AS BIGINT) AS form_n
FROM formed f JOIN path p ON f.word = p.word AND p.further IS NULL
"""

COLLOCATIONS = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS ws
  FROM documents
), counts AS MATERIALIZED (
  SELECT lang, k, phrase, count(*) AS f FROM (
    SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i : i + k - 1], ' '))) AS phrase
    FROM pieces, (SELECT unnest([1, 2, 3]) AS k)
  ) GROUP BY ALL
), candidates AS MATERIALIZED (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM counts WHERE k > 1 AND f >= 10
), cuts AS (
  SELECT c.lang, c.k AS size, c.phrase, c.a, p.k AS cut, p.f AS l, q.f AS r,
    (1000000::HUGEINT * c.a * c.a) // (p.f::HUGEINT * q.f) AS score
  FROM candidates c
  JOIN counts p ON p.lang = c.lang AND p.k < c.k AND p.phrase = array_to_string(c.ws[1 : p.k], ' ')
  JOIN counts q ON q.lang = c.lang AND q.k = c.k - p.k AND q.phrase = array_to_string(c.ws[p.k + 1 :], ' ')
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), covered AS (
  SELECT lang, phrase, max(a) AS most FROM (
    SELECT lang, a, unnest([array_to_string(ws[1 : 2], ' '), array_to_string(ws[2 : 3], ' ')]) AS phrase FROM candidates WHERE k = 3
  ) GROUP BY ALL
), ranked AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
  FROM best b LEFT JOIN covered c ON c.lang = b.lang AND c.phrase = b.phrase
  WHERE size = 3 OR most IS NULL OR 100 * most < 50 * a
), totals AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE k = 1 GROUP BY lang
)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

SQL: dict[str, str] = {
    "op1_chat_formatting": CHAT,
    "op7_mixing": MIXING,
    "op8_warc": ARCHIVE,
    "op11_spelling_variants": SPELLING,
    "op12_collocations": COLLOCATIONS,
}

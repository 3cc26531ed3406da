"""SQL that DuckDB runs to give the result each query must have."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

WORDS = r"len(regexp_extract_all(coalesce({0}, ''), '[^\x20\x09-\x0D]+'))"

ORACLES["op7_mixing"] = f"""
WITH sized AS (
  SELECT doc_id, source, {WORDS.format('text')}::bigint AS size FROM documents),
totals AS (SELECT source, sum(size)::bigint AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, source_size * 3.0::double AS cap,
    ([5.0::double, 2.0::double, 1.0::double])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM totals),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0::double))
    / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighted),
targets AS (
  SELECT source, source_size, least(cap, max(level) OVER () * weight) AS target FROM levels),
rates AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
    ('0x' || left(md5('mix-1:' || coalesce(s.doc_id::varchar, '')), 13))::bigint / (2.0::double ** 52) AS draw
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  size * (floor(rate)::bigint + (draw < rate - floor(rate))::bigint) AS taken FROM rates"""

CONTROL = r"(<<|<|\[)(\\*)(/?(?:s>|INST\]|SYS>>))"
ORACLES["op9_chat"] = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos,
    {WORDS.format('text')} + {WORDS.format('role')} + 3 AS tokens FROM turns),
costs AS (
  SELECT *, CASE WHEN pos = 0 AND role = 'system' THEN 0 ELSE tokens END AS cost,
    coalesce(sum(CASE WHEN pos = 0 AND role = 'system' THEN tokens END) OVER (PARTITION BY conv_id), 0) AS system_tokens
  FROM placed),
starts AS (
  SELECT *, greatest(1, floor((768 - system_tokens) / 2.0::double)) AS cell_size,
    coalesce(sum(cost) OVER (PARTITION BY conv_id ORDER BY pos
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM costs),
cells AS (SELECT *, floor(start / cell_size) AS cell, cost > cell_size AS is_long FROM starts),
breaks AS (
  SELECT *, pos > (system_tokens > 0)::int AND (cell <> lag(cell) OVER o OR is_long OR lag(is_long) OVER o) AS breaks
  FROM cells WINDOW o AS (PARTITION BY conv_id ORDER BY pos)),
windows AS (SELECT *, sum(breaks::int) OVER (PARTITION BY conv_id ORDER BY pos) AS w FROM breaks),
begins AS (SELECT conv_id, w, min(start) AS begins FROM windows GROUP BY conv_id, w),
counted AS (
  SELECT t.*, CASE WHEN pos = 0 AND role = 'system'
      THEN (SELECT count(*) FROM begins b WHERE b.conv_id IS NOT DISTINCT FROM t.conv_id)
      ELSE 1 + (SELECT count(*) FROM begins b WHERE b.conv_id IS NOT DISTINCT FROM t.conv_id
        AND b.w > t.w AND b.begins - t.start <= least(256, t.cell_size)) END AS times,
    8 + length(regexp_replace(text, '{CONTROL}', '\1\\\2\3', 'g'))
      + length(regexp_replace(replace(replace(role, '\', '\e'), chr(10), '\l'), '{CONTROL}', '\1\\\2\3', 'g')) AS chars
  FROM windows t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::bigint AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(chars * times)::bigint AS formatted_chars, max(w)::bigint + 1 AS n_windows
FROM counted GROUP BY conv_id"""

ORACLES["op11_prefix_trie"] = r"""
WITH RECURSIVE crc AS (
  SELECT conv_id, list_reduce(list_concat([4294967295::bigint], list_transform(string_split(conv_id::varchar, ''), lambda x: ascii(x)::bigint)),
    lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))) AS r
  FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)),
convs AS (SELECT conv_id, conv_id - conv_id % 100 AS base, xor(r, 4294967295) % 6 AS h FROM crc),
ranked AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
rebuilt AS (
  SELECT c.conv_id, 0 AS part, r.pos, r.role, r.text FROM convs c JOIN ranked r ON r.conv_id = c.base AND r.pos <= c.h
  UNION ALL
  SELECT c.conv_id, 1, r.pos, r.role, r.text FROM convs c JOIN ranked r ON r.conv_id = c.conv_id AND r.pos > c.h),
steps AS (
  SELECT conv_id, row_number() OVER w AS depth, list({'r': role, 't': text}) OVER w AS path, length(text) AS chars
  FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos)),
paths AS (
  SELECT conv_id, depth, sha256(path::varchar) AS p,
    CASE WHEN depth = 1 THEN '' ELSE lag(sha256(path::varchar)) OVER (PARTITION BY conv_id ORDER BY depth) END AS q, chars
  FROM steps
  UNION ALL SELECT conv_id, 0, '', NULL, 0 FROM convs),
lasts AS (SELECT conv_id, max(depth) AS depth FROM paths GROUP BY conv_id),
nodes AS (
  SELECT depth, p, any_value(q) AS q, min(conv_id) AS conv_id, count(*) AS n, any_value(chars) AS chars,
    string_agg(CASE WHEN ends THEN conv_id::varchar END, ',' ORDER BY conv_id) AS ended
  FROM (SELECT p.*, l.depth = p.depth AS ends FROM paths p JOIN lasts l USING (conv_id)) GROUP BY depth, p),
kids AS (SELECT q AS p, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY q, depth - 1),
full_nodes AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM nodes n LEFT JOIN kids k USING (depth, p)),
below AS (
  SELECT a.depth, a.p, sum((u.n - 1) * u.chars) AS saved, count(*) FILTER (WHERE u.n_children = 0) AS n_leaves
  FROM full_nodes u JOIN paths a ON a.conv_id = u.conv_id AND a.depth <= u.depth GROUP BY a.depth, a.p)
SELECT n.conv_id, n.depth::bigint AS depth, up.conv_id AS parent_conv_id, n.n AS n_convs, n.n_children, b.n_leaves,
  b.saved::bigint AS saved_tokens, sha256(coalesce(n.ended, '')) AS ends_sha256
FROM full_nodes n JOIN below b USING (depth, p) LEFT JOIN full_nodes up ON up.depth = n.depth - 1 AND up.p = n.q"""

ORACLES["op12_collocations"] = r"""
WITH pieces AS (
  SELECT doc_id, coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
sizes AS (SELECT lang, sum(len(w))::bigint AS n FROM words GROUP BY lang),
grams AS (
  SELECT lang, array_to_string(w[i : i + k - 1], ' ') AS phrase, k AS size
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k)),
f AS (SELECT lang, phrase, size, count(*) AS n FROM grams GROUP BY lang, phrase, size HAVING count(*) >= 30),
candidates AS (SELECT lang, phrase, n AS a, size, string_split(phrase, ' ') AS w FROM f WHERE size > 1),
cuts AS (
  SELECT c.lang, c.phrase, c.a, k, l.n AS l, r.n AS r, ((c.a::hugeint * 2000000) // (l.n + r.n))::bigint AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates) c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:k], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1:], ' ')),
weakest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_phrases AS (
  SELECT lang, array_to_string(w[i : i + k - 1], ' ') AS phrase, max(a) AS around
  FROM (SELECT lang, w, a, size, k, unnest(range(1, size - k + 2)) AS i
        FROM candidates, (SELECT unnest([2, 3]) AS k) WHERE k < size)
  GROUP BY 1, 2),
kept AS (
  SELECT w.* FROM weakest w LEFT JOIN inner_phrases i USING (lang, phrase)
  WHERE i.around IS NULL OR 100::hugeint * i.around < 80::hugeint * w.a)
SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, s.n, score
FROM kept k JOIN sizes s USING (lang)
QUALIFY rank <= 2000"""

"""SQL that states the rows of the queries that SQL can express (DuckDB dialect)."""

from __future__ import annotations

EXACT_TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.w, c.w) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 20
"""

CONVERSATION_REPAIR = r"""
WITH RECURSIVE crc AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i] || range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c FROM range(256) r(i))),
dealt AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS was_role, coalesce(text, ' ') AS was_text, xor(list_reduce(
    [4294967295] || list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
      lambda x: CAST(ascii(x) AS BIGINT)), lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1])), 4294967295) % 20 AS d
  FROM conversations, crc),
damaged AS (
  SELECT conv_id, turn, was_role, was_text, copy, CASE d WHEN 4 THEN 'user' ELSE was_role END AS role,
    CASE d WHEN 1 THEN '' WHEN 2 THEN translate(was_text, '.!?', '') ELSE was_text END AS text
  FROM dealt, (VALUES (0), (1)) AS copies(copy) WHERE d <> 0 AND (copy = 0 OR d = 3)),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, was_role, was_text, copy, role, text) AS i FROM damaged),
faults AS (
  SELECT *, substr(role, 1, 1) AS initial, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault,
    lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) || substr(role, 1, 1) AS pair
  FROM numbered),
conversation AS (SELECT conv_id, row_number() OVER () AS c FROM (SELECT DISTINCT conv_id FROM conversations)),
line AS (SELECT c, i, role, text, initial, fault FROM faults JOIN conversation ON faults.conv_id IS NOT DISTINCT FROM conversation.conv_id),
edge(state, initial, next, name) AS (
  VALUES (0, 's', 1, 'system'), (0, 'u', 2, 'user'), (1, 'u', 2, 'user'), (2, 'a', 3, 'assistant'), (3, 'u', 2, 'user')),
walk AS (
  SELECT c, CAST(0 AS BIGINT) AS i, state, cost, audit, body FROM conversation,
    (VALUES (0, CAST(0 AS BIGINT), '', CAST([] AS VARCHAR[])), (2, CAST(5 AS BIGINT), 'I', ['user:'])) AS s(state, cost, audit, body)
  UNION ALL
  SELECT c, i, state, b.cost, b.audit, b.body FROM (
    SELECT c, i, state, min(b) AS b FROM (
      SELECT c, i, CASE WHEN yes THEN next ELSE m.state END AS state,
        CASE WHEN yes THEN {'cost': b.cost + 5, 'audit': b.audit || 'I', 'body': list_append(b.body, name || ':')} ELSE b END AS b
      FROM (
        SELECT c, i, state, min(b) AS b FROM (
          SELECT w.c, l.i, w.state, {'cost': w.cost + 2, 'audit': w.audit || 'D', 'body': w.body} AS b
          FROM walk w JOIN line l ON l.c = w.c AND l.i = w.i + 1
          UNION ALL
          SELECT w.c, l.i, e.next, {'cost': w.cost + CASE WHEN e.initial = l.initial THEN 0 ELSE 1 END + CASE l.fault WHEN 'truncated' THEN 5 ELSE 0 END,
            'audit': w.audit || CASE WHEN e.initial = l.initial THEN 'K' ELSE 'R' END,
            'body': list_append(w.body, CASE WHEN e.initial = l.initial THEN l.role ELSE e.name END || ':' || l.text)} AS b
          FROM walk w JOIN line l ON l.c = w.c AND l.i = w.i + 1 JOIN edge e ON e.state = w.state
          WHERE l.fault NOT IN ('blank', 'duplicate') AND (e.initial = l.initial OR e.initial <> 's'))
        GROUP BY c, i, state) m JOIN edge e ON e.state = m.state AND e.initial <> 's', (VALUES (false), (true)) AS inserted(yes))
    GROUP BY c, i, state)),
best AS (
  SELECT c, min({'cost': cost, 'audit': audit, 'body': body}) AS b FROM walk w
  WHERE state IN (0, 3) AND i = (SELECT coalesce(max(i), 0) FROM line l WHERE l.c = w.c) GROUP BY c),
counts AS (
  SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM conversation LEFT JOIN faults ON faults.conv_id IS NOT DISTINCT FROM conversation.conv_id AND faults.i IS NOT NULL GROUP BY c)
SELECT conv_id, CAST(gaps AS BIGINT) AS gaps, blank, duplicate, truncated, illegal, CAST(b.cost AS BIGINT) AS cost, b.audit AS audit,
  sha256(array_to_string(b.body, chr(10))) AS repaired_sha256
FROM conversation JOIN counts USING (c) JOIN best USING (c)
"""

PHRASE_COLLOCATIONS = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w
  FROM documents),
gram AS (
  SELECT lang, 1 AS size, unnest(w) AS phrase FROM piece
  UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM piece
  UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM piece),
f AS (SELECT lang, size, phrase, count(*) AS a FROM gram GROUP BY ALL),
total AS (SELECT lang, sum(a) AS n FROM f WHERE size = 1 GROUP BY lang),
candidate AS (SELECT lang, size, phrase, string_split(phrase, ' ') AS w, a FROM f WHERE size > 1 AND a >= 10),
cut AS (
  SELECT lang, size, phrase, w, a, k, array_to_string(w[1:k], ' ') AS lp, array_to_string(w[k + 1:], ' ') AS rp
  FROM candidate, (VALUES (1), (2)) AS ks(k) WHERE k < size),
rated AS (
  SELECT c.lang, c.size, c.phrase, c.a, min({'score': CAST(1000000 AS HUGEINT) * c.a * c.a // (CAST(x.a AS HUGEINT) * y.a), 'k': k, 'l': x.a, 'r': y.a}) AS b
  FROM cut c JOIN f x ON x.lang = c.lang AND x.phrase = c.lp JOIN f y ON y.lang = c.lang AND y.phrase = c.rp GROUP BY ALL),
longer AS (
  SELECT lang, phrase, max(a) AS a FROM (
    SELECT lang, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase, a FROM candidate WHERE size = 3) GROUP BY ALL),
kept AS (
  SELECT r.*, row_number() OVER (PARTITION BY r.lang ORDER BY b.score DESC, r.a DESC, r.phrase) AS rank
  FROM rated r LEFT JOIN longer l ON r.size = 2 AND l.lang = r.lang AND l.phrase = r.phrase WHERE l.a IS NULL OR 100 * l.a < 50 * r.a)
SELECT lang, rank, phrase, a, CAST(b.l AS BIGINT) AS l, CAST(b.r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(b.score AS BIGINT) AS score
FROM kept JOIN total USING (lang) WHERE rank <= 2000
"""

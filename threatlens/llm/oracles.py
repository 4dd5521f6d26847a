"""DuckDB SQL for the queries that SQL can express."""

#: Every conversation in turn order; texts are escaped only to count the formatted characters.
REPLY_TREES = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), sized AS (
  SELECT *, length(regexp_replace(regexp_replace(replace(role, '\', '\\'), '<(/?s>)', '<\\\1', 'g'), '\[(/?INST\])', '[\\\1', 'g'))
    + length(regexp_replace(regexp_replace(replace(text, '\', '\\'), '<(/?s>)', '<\\\1', 'g'), '\[(/?INST\])', '[\\\1', 'g'))
    + length('<s>[INST][/INST]</s>') AS chars
  FROM said
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

#: The CRC-32 of the UTF-8 bytes of a text column `said`, bit by bit from its polynomial.
_CRC_TABLE = """
crc_steps(i, c, step) AS (
  SELECT i, i, 0 FROM range(256) t(i)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, step + 1 FROM crc_steps WHERE step < 8
), crc_table AS (SELECT list(c ORDER BY i) AS t FROM crc_steps WHERE step = 8)
"""
_CRC = """xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(octet_length(encode({said}))),
      lambda k: ('0x' || substr(hex(encode({said})), CAST(2 * k + 1 AS BIGINT), 2))::BIGINT)),
    lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])))"""

#: One row a step, the lightest of each state kept; insertions go before a row or at the end.
REPAIR = (
    "WITH RECURSIVE " + _CRC_TABLE + r""", said AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS said
  FROM conversations
), kinds AS (
  SELECT conv_id, turn, role, text, """ + _CRC.format(said="said") + r""" % 20 AS kind FROM said, crc_table
), left_over AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM kinds, range(CASE WHEN kind = 3 THEN 2 ELSE 1 END) WHERE kind <> 0
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i FROM left_over
), judged AS (
  SELECT *, left(role, 1) AS initial, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS copy,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS earlier
  FROM numbered
), faults AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN copy > 1 THEN 'duplicate'
    WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM judged
), step(q, x, nxt) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)
), inserted(q, nxt, price, letters, lines) AS (
  SELECT DISTINCT q, q, 0, '', CAST([] AS VARCHAR[]) FROM step
  UNION ALL SELECT q, nxt, 3, 'I', [CASE x WHEN 'u' THEN 'user:' ELSE 'assistant:' END] FROM step WHERE x <> 's'
  UNION ALL SELECT a.q, b.nxt, 6, 'II', list_transform([a.x, b.x], lambda x: CASE x WHEN 'u' THEN 'user:' ELSE 'assistant:' END)
    FROM step a JOIN step b ON b.q = a.nxt WHERE a.x <> 's' AND b.x <> 's'
), edit AS (
  SELECT conv_id, i, 'D' AS letter, '-' AS x, 4 AS price, CAST([] AS VARCHAR[]) AS lines FROM faults
  UNION ALL SELECT conv_id, i, 'K', initial, CASE fault WHEN 'truncated' THEN 3 ELSE 0 END, [role || ':' || text]
    FROM faults WHERE fault NOT IN ('blank', 'duplicate') AND initial IN ('s', 'u', 'a')
  UNION ALL SELECT conv_id, i, 'R', x, CASE fault WHEN 'truncated' THEN 6 ELSE 3 END,
    [CASE x WHEN 'u' THEN 'user:' ELSE 'assistant:' END || text]
    FROM faults, (VALUES ('u'), ('a')) r(x) WHERE fault NOT IN ('blank', 'duplicate')
), moves AS (
  SELECT e.conv_id, e.i, n.q, coalesce(s.nxt, n.nxt) AS nxt, n.price + e.price AS price,
    n.letters || e.letter AS letters, n.lines || e.lines AS lines
  FROM edit e CROSS JOIN inserted n LEFT JOIN step s ON s.q = n.nxt AND s.x = e.x
  WHERE e.x = '-' OR s.x IS NOT NULL
), derived(conv_id, i, q, cost, audit, lines) AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT), 0, 0, '', CAST([] AS VARCHAR[]) FROM numbered
  UNION ALL
  SELECT conv_id, i, q, cost, audit, lines FROM (
    SELECT d.conv_id, m.i, m.nxt AS q, d.cost + m.price AS cost, d.audit || m.letters AS audit, d.lines || m.lines AS lines
    FROM derived d JOIN moves m ON m.conv_id IS NOT DISTINCT FROM d.conv_id AND m.i = d.i + 1 AND m.q = d.q
    QUALIFY row_number() OVER (PARTITION BY d.conv_id, m.nxt ORDER BY d.cost + m.price, d.audit || m.letters) = 1
  )
), counted AS (
  SELECT conv_id, count(*) AS n, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (i > 1 AND earlier || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY conv_id
), whole AS (
  SELECT c.*, d.cost + f.price AS cost, d.audit || f.letters AS audit, array_to_string(d.lines || f.lines, chr(10)) AS said
  FROM counted c JOIN derived d ON d.conv_id IS NOT DISTINCT FROM c.conv_id AND d.i = c.n
    JOIN inserted f ON f.q = d.q AND f.nxt IN (0, 3)
  QUALIFY row_number() OVER (PARTITION BY c.conv_id ORDER BY d.cost + f.price, d.audit || f.letters) = 1
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
  coalesce(audit, '') AS audit, sha256(coalesce(said, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN whole w ON w.conv_id IS NOT DISTINCT FROM o.conv_id
"""
)

#: Words meet in patterns with one letter replaced by a mark, or left out.
SPELLING = (
    "WITH RECURSIVE " + _CRC_TABLE + r""", runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
    unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run
  FROM documents
), counted AS (SELECT id, run, id || ':' || run AS said, count(*) AS n FROM runs GROUP BY id, run
), hashed AS (SELECT run, n, """ + _CRC.format(said="said") + r""" AS h FROM counted, crc_table
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
    FROM hashed
  ) GROUP BY word HAVING length(word) >= 5 AND sum(n) >= 3
), cut AS (
  SELECT DISTINCT word, n, left(word, k) || '*' || substr(word, k + 2) AS marked, left(word, k) || substr(word, k + 2) AS shorter
  FROM (SELECT word, n, unnest(range(length(word))) AS k FROM words)
), near AS (
  SELECT a.word, b.word AS other, b.n AS m FROM cut a JOIN cut b ON a.marked = b.marked AND a.word <> b.word
  UNION SELECT c.word, w.word, w.n FROM cut c JOIN words w ON c.shorter = w.word
  UNION SELECT w.word, c.word, c.n FROM cut c JOIN words w ON c.shorter = w.word
), best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY m DESC, other) AS other, max(m) AS m FROM near GROUP BY word
), forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * w.n THEN other END AS form,
    CASE WHEN m >= 2 * w.n THEN m END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word
), chain(word, reached) AS (
  SELECT word, word FROM forms
  UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.reached WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, c.reached AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN chain c ON c.word = f.word JOIN forms e ON e.word = c.reached AND e.form IS NULL
"""
)

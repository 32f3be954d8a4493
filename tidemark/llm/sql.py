"""DuckDB SQL that gives the same rows as the queries, where SQL can express them."""

OP3_LINE_DEDUP = r"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
    FROM documents
), keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), frequent AS (
    SELECT key, max(doc_id) AS top FROM keyed WHERE length(key) >= 20
    GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
    SELECT k.doc_id, k.line, k.pos, f.key IS NOT NULL AND k.doc_id <> f.top AS gone
    FROM keyed k LEFT JOIN frequent f USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP9_MIXING = r"""
WITH sized AS (
    SELECT doc_id, source, md5(CAST(doc_id AS VARCHAR)) AS h,
           CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
    FROM documents
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
    FROM sized GROUP BY source
), ranked AS (
    SELECT *, 3 * source_size AS most,
           sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER w, 0) AS words_left,
           sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS weight_left
    FROM sources
    WINDOW w AS (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), shared AS (
    SELECT *, most * weight_left <= weight * words_left AS limited FROM ranked
), targets AS (
    SELECT source, source_size, CASE WHEN limited THEN CAST(most AS DOUBLE)
           ELSE CAST(weight * max(words_left) FILTER (NOT limited) OVER () AS DOUBLE)
                / CAST(max(weight_left) FILTER (NOT limited) OVER () AS DOUBLE) END AS target
    FROM shared
), queued AS (
    SELECT d.*, t.source_size, t.target,
           sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto
    FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), copies AS (
    SELECT *, CAST(turn * source_size + upto AS DOUBLE) / target AS finish
    FROM queued, (SELECT unnest([0, 1, 2]) AS turn) WHERE size > 0
), served AS (
    SELECT *, sum(size) OVER (ORDER BY finish, source NULLS FIRST, upto ROWS UNBOUNDED PRECEDING) AS after FROM copies
), taken AS (
    SELECT doc_id, source, upto, count(*) AS n FROM served
    WHERE after <= (SELECT sum(size) FROM sized) GROUP BY ALL
)
SELECT q.doc_id, q.size, q.source_size, q.target, CAST(coalesce(t.n, 0) * q.size AS BIGINT) AS taken
FROM queued q LEFT JOIN taken t ON q.doc_id = t.doc_id AND q.upto = t.upto AND q.source IS NOT DISTINCT FROM t.source
"""

OP11_CONVERSATIONS = r"""
WITH RECURSIVE keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(list_reduce(list_prepend(4294967295,
               list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ascii(x) AS BIGINT))),
               lambda c, b: list_reduce(list_prepend(xor(c, b), [CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0]), lambda d, z: xor(d >> 1, (d & 1) * 3988292384))), 4294967295) % 20 AS kind
    FROM conversations
), damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
           CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
           unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
    FROM keyed
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(role || chr(0) || text), copy) AS i,
           trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body
    FROM damaged
), marked AS (
    SELECT *, CASE WHEN body = '' THEN 'blank' WHEN i > min(i) OVER (PARTITION BY conv_id, role, text) THEN 'duplicate'
              WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
           lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair
    FROM placed
), counted AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) AS n, count(*) FILTER (fault = 'blank') AS blank,
           count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM marked GROUP BY conv_id
), moves AS (
    SELECT * FROM (VALUES (0, 2), (1, 2), (2, 3), (3, 2)) m(state, put)
), inserted AS (
    SELECT state, state AS at, 0 AS spent, '' AS letters, CAST([] AS VARCHAR[]) AS lines FROM moves
    UNION ALL SELECT state, put, 3, 'I', [CASE put WHEN 2 THEN 'user:' ELSE 'assistant:' END] FROM moves
    UNION ALL SELECT a.state, b.put, 6, 'II', CASE b.put WHEN 2 THEN ['assistant:', 'user:'] ELSE ['user:', 'assistant:'] END FROM moves a JOIN moves b ON a.put = b.state
), edits AS (
    SELECT v.*, m.put FROM inserted v JOIN moves m ON v.at = m.state
), solved AS (
    SELECT conv_id, n, CAST(0 AS BIGINT) AS i, 0 AS state, {'cost': 0, 'audit': '', 'lines': CAST([] AS VARCHAR[])} AS best FROM counted
    UNION ALL
    SELECT conv_id, any_value(n), i, state, min({'cost': cost, 'audit': audit, 'lines': lines}) FROM (
        SELECT s.conv_id, s.n, s.i + 1 AS i, s.best.cost + e.spent + CASE x.edit WHEN 'D' THEN 4 ELSE CASE r.fault WHEN 'truncated' THEN 3 ELSE 0 END END
                   + CASE x.edit WHEN 'R' THEN 3 ELSE 0 END AS cost,
               s.best.audit || e.letters || x.edit AS audit,
               CASE x.edit WHEN 'D' THEN e.at WHEN 'R' THEN e.put ELSE CASE WHEN r.role LIKE 's%' THEN 1 ELSE e.put END END AS state,
               s.best.lines || e.lines || CASE x.edit WHEN 'D' THEN CAST([] AS VARCHAR[]) WHEN 'K' THEN [r.role || ':' || r.text]
                   ELSE [CASE e.put WHEN 2 THEN 'user:' ELSE 'assistant:' END || r.text] END AS lines
        FROM solved s JOIN marked r ON s.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = s.i + 1
        JOIN edits e ON e.state = s.state CROSS JOIN (VALUES ('D'), ('K'), ('R')) x(edit)
        WHERE x.edit = 'D' OR (r.fault NOT IN ('blank', 'duplicate') AND (x.edit = 'R'
            OR (left(r.role, 1) = 's' AND e.at = 0) OR (left(r.role, 1) = 'u' AND e.put = 2) OR (left(r.role, 1) = 'a' AND e.put = 3)))
    ) GROUP BY conv_id, i, state
), ended AS (
    SELECT s.conv_id, min({'cost': s.best.cost + e.spent, 'audit': s.best.audit || e.letters, 'lines': s.best.lines || e.lines}) AS best
    FROM solved s JOIN edits e ON e.state = s.state WHERE s.i = s.n AND e.at IN (0, 3) GROUP BY s.conv_id
)
SELECT k.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate, coalesce(c.truncated, 0) AS truncated,
       coalesce(c.illegal, 0) AS illegal, CAST(coalesce(e.best.cost, 0) AS BIGINT) AS cost, coalesce(e.best.audit, '') AS audit,
       sha256(coalesce(array_to_string(e.best.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM keyed) k LEFT JOIN counted c ON k.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ended e ON k.conv_id IS NOT DISTINCT FROM e.conv_id
"""

OP13_FILL_MIDDLE = r"""
WITH units AS (
    SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
           sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
    FROM documents
), drawn AS (
    SELECT *, CAST(len(u) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
           CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
    FROM units
), formed AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
           CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM drawn
), cut AS (
    SELECT doc_id, n, form, t, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s
    FROM formed
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN t ELSE p || m || s END) AS restored_sha256
FROM cut
"""

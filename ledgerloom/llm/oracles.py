"""The operators' results as DuckDB computes them, where SQL can express them."""

from __future__ import annotations

FILL_IN_MIDDLE = r"""
WITH hashed AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || doc_id) AS h,
           regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS tokens
    FROM documents WHERE doc_id IS NOT NULL
), drawn AS (
    SELECT doc_id, text, tokens, len(tokens) AS n,
           ('0x' || substr(h, 1, 8))::UBIGINT::BIGINT % (len(tokens) + 1) AS one,
           ('0x' || substr(h, 9, 8))::UBIGINT::BIGINT % (len(tokens) + 1) AS two,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                     OR ('0x' || substr(h, 17, 8))::UBIGINT % 100 >= 90 THEN 'plain'
                WHEN ('0x' || substr(h, 25, 8))::UBIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM hashed
), cut AS (
    SELECT doc_id, text, n, form,
           array_to_string(tokens[1:least(one, two)], '') AS prefix,
           array_to_string(tokens[least(one, two) + 1:greatest(one, two)], '') AS middle,
           array_to_string(tokens[greatest(one, two) + 1:], '') AS suffix
    FROM drawn
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
              WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut
"""

# A CRC-32 is a fold over the bytes, each followed by eight steps of one bit. The repair is a
# recursion over the rows of a conversation that keeps the least (cost, audit) per state
# (0 nothing kept, 1 system, 2 user, 3 assistant last); `moves` holds what may stand before and
# at a row: inserts, then the row's own edit.
REPAIR_CONVERSATIONS = r"""
WITH RECURSIVE numbered AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           xor(list_reduce(
               list_prepend(4294967295::BIGINT, flatten(list_transform(
                   string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
                   lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
               lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x) ELSE xor(crc >> 1, 3988292384 * (crc & 1)) END
           ), 4294967295) % 20 AS damage
    FROM conversations
), damaged AS (
    SELECT conv_id, turn, CASE damage WHEN 4 THEN 'user' ELSE role END AS role,
           CASE damage WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(range(CASE damage WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
    FROM numbered
), placed AS (
    SELECT conv_id, turn, role, text, left(role, 1) AS initial,
           regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS stripped,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
           row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS seen
    FROM damaged
), faulty AS (
    SELECT conv_id, turn, role, text, initial, i,
           CASE WHEN stripped = '' THEN 'blank' WHEN seen THEN 'duplicate'
                WHEN right(stripped, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
           lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before
    FROM placed
), counted AS (
    SELECT conv_id, count(*) AS n,
           coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
           count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
    FROM faulty GROUP BY conv_id
), inserts(a, b, letters, cost) AS (
    VALUES (0, 0, '', 0), (1, 1, '', 0), (2, 2, '', 0), (3, 3, '', 0), (0, 2, 'I', 3), (1, 2, 'I', 3), (3, 2, 'I', 3),
           (2, 3, 'I', 3), (0, 3, 'II', 6), (1, 3, 'II', 6)
), edits(a, b, letter, initial, cost) AS (
    VALUES (0, 0, 'D', NULL, 4), (1, 1, 'D', NULL, 4), (2, 2, 'D', NULL, 4), (3, 3, 'D', NULL, 4),
           (0, 2, 'R', NULL, 3), (1, 2, 'R', NULL, 3), (3, 2, 'R', NULL, 3), (2, 3, 'R', NULL, 3),
           (0, 1, 'K', 's', 0), (0, 2, 'K', 'u', 0), (1, 2, 'K', 'u', 0), (3, 2, 'K', 'u', 0), (2, 3, 'K', 'a', 0)
), moves AS (
    SELECT i.a, e.b, i.letters || e.letter AS letters, e.letter, e.initial, i.cost + e.cost AS cost
    FROM inserts i JOIN edits e ON i.b = e.a
), path AS (
    SELECT conv_id, 0::BIGINT AS i, 0 AS state, {'cost': 0::BIGINT, 'audit': ''} AS best FROM counted
    UNION ALL
    SELECT p.conv_id, p.i + 1, m.b,
           min({'cost': p.best.cost + m.cost + CASE WHEN f.fault = 'truncated' AND m.letter <> 'D' THEN 3 ELSE 0 END,
                'audit': p.best.audit || m.letters})
    FROM path p
    JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.i = p.i + 1
    JOIN moves m ON m.a = p.state
        AND (m.letter = 'D' OR f.fault NOT IN ('blank', 'duplicate'))
        AND (m.initial IS NULL OR m.initial = f.initial)
    GROUP BY p.conv_id, p.i, m.b
), chosen AS (
    SELECT c.conv_id, min({'cost': p.best.cost + s.cost, 'audit': p.best.audit || s.letters}) AS best
    FROM counted c JOIN path p ON p.conv_id IS NOT DISTINCT FROM c.conv_id AND p.i = c.n
    JOIN inserts s ON s.a = p.state AND s.b IN (0, 3)
    GROUP BY c.conv_id
), letters AS (
    SELECT conv_id, unnest(range(1, length(best.audit) + 1)) AS spot, best.audit AS audit FROM chosen
), consumed AS (
    SELECT conv_id, spot, audit[spot] AS letter,
           spot - (length(audit[:spot]) - length(replace(audit[:spot], 'I', ''))) AS i
    FROM letters
), repaired AS (
    SELECT c.conv_id, c.spot, c.letter,
           CASE WHEN c.letter = 'I' THEN '' ELSE f.text END AS text, f.role, f.initial,
           max(CASE WHEN c.letter = 'K' AND f.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY c.conv_id) AS system,
           row_number() OVER (PARTITION BY c.conv_id ORDER BY c.spot) AS place
    FROM consumed c LEFT JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM c.conv_id AND f.i = c.i
    WHERE c.letter <> 'D'
), hashed AS (
    SELECT conv_id, sha256(string_agg(
        CASE WHEN letter = 'K' THEN role WHEN (place - system) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY spot
    )) AS repaired_sha256
    FROM repaired GROUP BY conv_id
)
SELECT o.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
       coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal, coalesce(b.best.cost, 0) AS cost,
       coalesce(b.best.audit, '') AS audit, coalesce(h.repaired_sha256, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN chosen b ON b.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN hashed h ON h.conv_id IS NOT DISTINCT FROM o.conv_id
"""

ORACLES: dict[str, str] = {
    "op11_repair_conversations": REPAIR_CONVERSATIONS,
    "op12_fill_in_middle": FILL_IN_MIDDLE,
}

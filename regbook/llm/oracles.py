"""DuckDB SQL for the operators that SQL can express, over the same tables.

The others rest on hashes, estimated models or vocabularies that SQL does not have; the
tests hold them against brute force."""

from __future__ import annotations

OP5 = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT doc_id, pos, line,
         translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), frequent AS (
  SELECT key FROM keyed WHERE length(key) >= 1
  GROUP BY key HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM keyed k LEFT JOIN frequent f USING (key)
GROUP BY doc_id
"""

# CRC-32 bit by bit; then one step per row of a conversation. A step holds the cheapest
# (cost, audit, repaired rows) that end in each role: s[1] nothing kept so far, s[2] after
# system, s[3] after user, s[4] after assistant.
OP13 = r"""
WITH RECURSIVE plain AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         concat(coalesce(conv_id::varchar, ' '), ':', coalesce(turn::varchar, ' ')) AS name
  FROM conversations
), crc AS (
  SELECT *, xor(list_reduce(list_transform(string_split(name, ''), lambda x: ascii(x)::ubigint),
           lambda c, b: list_reduce([xor(c, b)] || [0::ubigint FOR i IN range(8)],
                                    lambda x, y: xor(x >> 1, 3988292384::ubigint * (x & 1))),
           4294967295::ubigint), 4294967295::ubigint) % 20 AS kind
  FROM plain
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM crc, range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place FROM damaged
), judged AS (
  SELECT conv_id, turn, role, text, place, left(role, 1) AS initial,
         NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 AS again,
         NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AS broken,
         place > 1 AND (lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY place) || left(role, 1)
                        NOT IN ('su', 'ua', 'au')) AS illegal
  FROM placed
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (blank) AS blank, count(*) FILTER (NOT blank AND again) AS duplicate,
         count(*) FILTER (NOT blank AND NOT again AND broken) AS truncated,
         count(*) FILTER (illegal) AS illegal, count(*) AS n_rows
  FROM judged GROUP BY conv_id
), ids AS (
  SELECT DISTINCT conv_id FROM conversations
), steps(conv_id, place, s) AS (
  SELECT conv_id, 0::bigint, [{'c': 0, 'a': '', 't': ''}, NULL, NULL, NULL] FROM ids
  UNION ALL
  SELECT conv_id, place,
    [ CASE WHEN e[1] IS NULL THEN NULL ELSE {'c': e[1].c + 2, 'a': e[1].a || 'D', 't': e[1].t} END,
      list_min(list_filter([
        CASE WHEN e[2] IS NOT NULL THEN {'c': e[2].c + 2, 'a': e[2].a || 'D', 't': e[2].t} END,
        CASE WHEN stay AND initial = 's' AND e[1] IS NOT NULL
             THEN {'c': e[1].c + more, 'a': e[1].a || 'K', 't': e[1].t || line} END], lambda x: x IS NOT NULL)),
      list_min(list_filter([
        CASE WHEN e[3] IS NOT NULL THEN {'c': e[3].c + 2, 'a': e[3].a || 'D', 't': e[3].t} END,
        CASE WHEN stay AND f IS NOT NULL AND initial = 'u'
             THEN {'c': f.c + more, 'a': f.a || 'K', 't': f.t || line} END,
        CASE WHEN stay AND f IS NOT NULL
             THEN {'c': f.c + 1 + more, 'a': f.a || 'R', 't': f.t || chr(10) || 'user:' || text} END
        ], lambda x: x IS NOT NULL)),
      list_min(list_filter([
        CASE WHEN e[4] IS NOT NULL THEN {'c': e[4].c + 2, 'a': e[4].a || 'D', 't': e[4].t} END,
        CASE WHEN stay AND e[3] IS NOT NULL AND initial = 'a'
             THEN {'c': e[3].c + more, 'a': e[3].a || 'K', 't': e[3].t || line} END,
        CASE WHEN stay AND e[3] IS NOT NULL
             THEN {'c': e[3].c + 1 + more, 'a': e[3].a || 'R', 't': e[3].t || chr(10) || 'assistant:' || text} END
        ], lambda x: x IS NOT NULL)) ]
  FROM (
    SELECT *, list_min(list_filter([e[1], e[2], e[4]], lambda x: x IS NOT NULL)) AS f
    FROM (
      SELECT j.conv_id, j.place, j.initial, j.text, chr(10) || j.role || ':' || j.text AS line,
             NOT blank AND NOT again AS stay, CASE WHEN broken THEN 5 ELSE 0 END AS more,
             opened AS e
      FROM (
        SELECT conv_id, place,
          [ s[1], s[2],
            list_min(list_filter([s[3]] || list_transform(
              list_filter([s[1], s[2], s[4]], lambda x: x IS NOT NULL),
              lambda x: {'c': x.c + 5, 'a': x.a || 'I', 't': x.t || chr(10) || 'user:'}), lambda x: x IS NOT NULL)),
            list_min(list_filter([s[4], CASE WHEN s[3] IS NOT NULL
              THEN {'c': s[3].c + 5, 'a': s[3].a || 'I', 't': s[3].t || chr(10) || 'assistant:'} END],
              lambda x: x IS NOT NULL)) ] AS opened
        FROM steps
      ) o JOIN judged j ON j.conv_id IS NOT DISTINCT FROM o.conv_id AND j.place = o.place + 1
    )
  )
), ended AS (
  SELECT t.conv_id, list_min(list_filter([s[1], s[4], CASE WHEN s[3] IS NOT NULL
           THEN {'c': s[3].c + 5, 'a': s[3].a || 'I', 't': s[3].t || chr(10) || 'assistant:'} END],
           lambda x: x IS NOT NULL)) AS best
  FROM steps t LEFT JOIN counted n ON n.conv_id IS NOT DISTINCT FROM t.conv_id
  WHERE t.place = coalesce(n.n_rows, 0)
)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.c::bigint AS cost, best.a AS audit,
       sha256(best.t[2:]) AS repaired_sha256
FROM ended e LEFT JOIN counted n ON n.conv_id IS NOT DISTINCT FROM e.conv_id
"""


def all_oracles() -> dict[str, str]:
    return {"op5_line_dedup": OP5, "op13_conversation_repair": OP13}

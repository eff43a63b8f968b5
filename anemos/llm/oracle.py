"""The queries that SQL can express, for DuckDB. The others are tested by brute force."""

from __future__ import annotations

OP1 = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER same AS kept, sha256(body) AS text_sha256
FROM d WINDOW same AS (PARTITION BY body)
"""

OP7 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
r AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha256(html) AS payload_digest,
             min(page_id) OVER (PARTITION BY html) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM r
"""

# The template, its control strings and the sizes of windows, in SQL's own words.
_ESCAPED = (
    r"regexp_replace({0}, '([<\[])(\\*)(\|im_start\|>|\|im_sep\|>|\|im_end\|>|\|endoftext\|>|s>|/s>|SYS>>|/SYS>>|INST\]|/INST\])',"
    r" '\1\\\2\3', 'g')")
OP9 = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
p AS (SELECT *, '<|im_start|>' || {_ESCAPED.format('role')} || '<|im_sep|>' || {_ESCAPED.format('text')} || '<|im_end|>' AS piece FROM t),
q AS (SELECT *, length(piece) AS chars, (length(piece) + 3) // 4 AS tokens FROM p),
r AS (SELECT *, CAST(sum(tokens) OVER (PARTITION BY conv_id ORDER BY turn, role, piece ROWS UNBOUNDED PRECEDING) AS BIGINT) AS e FROM q),
s AS (SELECT *, e - tokens AS s FROM r),
w AS (SELECT *, (s // 1536) * 2 + (s // 1536 <> (e - 1) // 1536)::INT AS w FROM s),
windows AS (SELECT conv_id, w, min(s) AS ws FROM w GROUP BY conv_id, w),
again AS (
  SELECT x.conv_id, x.chars FROM w x JOIN windows y ON x.conv_id = y.conv_id AND x.e <= y.ws AND x.s >= y.ws - 256
  WHERE NOT (x.s = 0 AND x.role = 'system')
  UNION ALL
  SELECT x.conv_id, x.chars FROM w x JOIN windows y ON x.conv_id = y.conv_id AND y.ws > 0 WHERE x.s = 0 AND x.role = 'system'),
extra AS (SELECT conv_id, sum(chars) AS chars FROM again GROUP BY conv_id)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, piece)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, piece) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(w.chars) + coalesce(any_value(extra.chars), 0) AS BIGINT) AS formatted_chars
FROM w LEFT JOIN extra USING (conv_id) GROUP BY conv_id
"""

OP13 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS lines FROM d),
n AS (SELECT *, CAST(len(lines) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
             CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM u),
p AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS lo, greatest(h1 % (n + 1), h2 % (n + 1)) AS hi,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
                  WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM n),
q AS (SELECT *, array_to_string(lines[1:lo], '') AS pre, array_to_string(lines[lo + 1:hi], '') AS mid,
             array_to_string(lines[hi + 1:n], '') AS suf FROM p)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN t ELSE pre || mid || suf END) AS restored_sha256
FROM q
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_exact_dedup": OP1, "op7_warc": OP7, "op9_chat": OP9, "op13_fill_middle": OP13}

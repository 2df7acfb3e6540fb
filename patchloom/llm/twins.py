"""SQL twins of the queries that SQL can express, written for DuckDB."""

from __future__ import annotations

# Words are split at ASCII white space, as the operator does.
_SPACE = "'[ \\t\\n\\r' || chr(11) || chr(12) || ']+'"
_WORDS = f"list_filter(string_split_regex(coalesce(text, ''), {_SPACE}), lambda x: x <> '')"

SUBSTRINGS = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i : i + 49], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)
),
opening AS (SELECT s, min(doc_id) AS m FROM win GROUP BY s),
hit AS (SELECT win.doc_id, i FROM win JOIN opening USING (s) WHERE m < win.doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM hit),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n
  FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

# The template's marks and its escape: a backslash before the bar of a control string.
_ESCAPED = r"regexp_replace({}, '<(\\*)\|(turn|text|end|image|audio|document)', '<\\\1|\2', 'g')"

CHATS = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(r || chr(10) || x || chr(10), '' ORDER BY turn, r, x)) AS turns_sha256,
  coalesce(sum(length(x)) FILTER (r = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(x, '' ORDER BY turn, r, x) FILTER (r = 'assistant'), '')) AS loss_sha256,
  sum(length('<|turn|><|text|><|end|>') + length({_ESCAPED.format('r')}) + length({_ESCAPED.format('x')}))::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_SPACE}), lambda x: x <> '') AS w
  FROM documents
),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)
),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
met AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
),
link AS (
  SELECT x, y FROM met JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * k >= 85 * (p.n + q.n - k)
),
reach AS (SELECT x, y FROM link UNION SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x)
SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, least(d.doc_id, min(y))::BIGINT AS component_id,
  d.doc_id = least(d.doc_id, min(y)) AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN reach ON reach.x = d.doc_id GROUP BY d.doc_id
"""

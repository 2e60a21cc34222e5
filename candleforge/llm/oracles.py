"""The same results in plain SQL, for the text operators that SQL can express on whole tables."""

from __future__ import annotations

_DIVERGENCE = r"""
WITH given AS (
  SELECT coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         row_number() OVER () AS doc
  FROM documents
), words AS (
  SELECT lang, source, doc,
         unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM given
), kept AS (
  SELECT lang, term, count(*) AS term_n FROM words GROUP BY ALL HAVING count(DISTINCT doc) >= 30
), langs AS (
  SELECT lang, count(*) AS v, sum(term_n)::HUGEINT AS lang_total FROM kept GROUP BY lang
), grouped AS (
  SELECT DISTINCT lang, source FROM given
), counted AS (
  SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL
), totals AS (
  SELECT lang, source, sum(n)::HUGEINT AS total FROM counted GROUP BY ALL
), shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (coalesce(t.total, 0) + 5 * l.v) AS p,
         1 + (1000000000::HUGEINT * (k.term_n + 5)) // (l.lang_total + 5 * l.v) AS lang_p
  FROM grouped g JOIN kept k USING (lang) JOIN langs l USING (lang)
  LEFT JOIN totals t USING (lang, source) LEFT JOIN counted c USING (lang, source, term)
), apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL
), found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
  FROM grouped a JOIN grouped b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - lang_p FROM shares WHERE n > 0 AND p > lang_p
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS place
  FROM found
)
SELECT lang, source, part, item, value::BIGINT AS value, place::INTEGER AS "rank"
FROM ranked WHERE part = 'pair' OR place <= 50
"""

# Escaping adds a character for each backslash and for the first of each control string.
_CONTROLS = ["<|", "|>", "<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]"]


def _escaped(value: str) -> str:
    """Characters of a text after escaping."""
    added = [f"(length({value}) - length(replace({value}, '{c}', ''))) // {len(c)}" for c in ["\\", *_CONTROLS]]
    return " + ".join([f"length({value})", *added])


_CHAT = f"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), joined AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
         string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, ''
                    ORDER BY turn NULLS FIRST, role, text) AS loss,
         string_agg(role || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS roles,
         sum(2 + {_escaped("role")} + 3 + {_escaped("text")} + 5)::BIGINT AS formatted_chars
  FROM given GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars,
       sha256(loss) AS loss_sha256, formatted_chars,
       regexp_full_match(roles, '(system\\n)?(user\\nassistant\\n)+') AS valid_order
FROM joined
"""

ORACLES = {"op8_chat_format": _CHAT, "op11_divergence": _DIVERGENCE}

"""DuckDB SQL of the operators that SQL can express; every value is spelled out here or taken
from the fixed word and rule tables, never computed by the code under test."""

from __future__ import annotations

from footfall.llm.quality import STOP_WORDS

_WORD = r"[^\x20\x09-\x0D]+"

OP3 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
p AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM d),
v AS (SELECT doc_id, i, list(x) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS g FROM p),
r AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM v WHERE len(g) = 8),
c AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM r, range(8) AS s(k) WHERE r.n >= 2 GROUP BY 1),
l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM d),
ld AS (SELECT doc_id, count(*) AS n, count(DISTINCT x) AS u FROM l WHERE regexp_matches(x, '{_WORD}') GROUP BY 1),
s AS (SELECT doc_id, count(DISTINCT translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS n FROM p
      WHERE translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') IN ({", ".join(f"'{x}'" for x in STOP_WORDS)}) GROUP BY 1),
m AS (SELECT doc_id, len(w) AS n_words,
  len(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g')) AS word_chars,
  len(t) - len(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
  coalesce(ld.n, 0) AS n_lines, coalesce(ld.n - ld.u, 0) AS n_dup_lines,
  coalesce(c.n, 0) AS n_repeat_words, coalesce(s.n, 0) AS n_stop,
  len(t) - len(regexp_replace(t, '[A-ZÀ-ÖØ-Þ]', '', 'g')) AS up,
  len(t) - len(regexp_replace(t, '[a-zß-öø-ÿ]', '', 'g')) AS lo
  FROM d LEFT JOIN c USING (doc_id) LEFT JOIN ld USING (doc_id) LEFT JOIN s USING (doc_id))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
  (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
  (n_words >= 20 AND 100 * n_repeat_words <= 30 * n_words
   AND word_chars >= 2 * n_words AND word_chars <= 14 * n_words
   AND 100 * n_symbols <= 20 * n_words AND 100 * n_dup_lines <= 50 * n_lines
   AND n_stop >= 1 AND 100 * up <= 60 * (up + lo)) AS kept
FROM m
"""

OP9 = r"""
WITH d AS (SELECT doc_id, text, coalesce(source, '') AS site FROM documents),
l AS (SELECT doc_id, site, unnest(string_split(text, chr(10))) AS x,
        generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d),
b AS (SELECT x, min(doc_id) AS first FROM l WHERE trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) <> ''
      GROUP BY x HAVING count(DISTINCT site) >= 10),
k AS (SELECT doc_id, i, l.x, trim(l.x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) <> '' AS has,
        b.x IS NOT NULL AND b.first <> doc_id AS gone FROM l LEFT JOIN b ON l.x = b.x),
g AS (SELECT doc_id, coalesce(string_agg(x, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '') AS text,
        count(*) FILTER (WHERE has) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed FROM k GROUP BY 1)
SELECT d.doc_id, g.text, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed
FROM d LEFT JOIN g USING (doc_id)
"""

OP11 = rf"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
u AS (SELECT t, min(doc_id) AS first FROM d GROUP BY 1),
l AS (SELECT doc_id, max((coalesce(quality, 0) = 1)::INT) AS good, max((coalesce(toxic, 0) = 1)::INT) AS toxic FROM labels GROUP BY 1),
m AS (SELECT doc_id, part, t, regexp_extract_all(t, '{_WORD}') AS w FROM d),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
  (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
  + 4 * (100 * (len(t) - len(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * len(t))::INT
  + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * (doc_id > first)::INT AS mask
  FROM m JOIN u USING (t) LEFT JOIN l USING (doc_id)),
c AS (SELECT part, mask, good, toxic, count(*) AS n FROM f GROUP BY part, mask, good, toxic),
s AS (SELECT x, v FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS y(x, v)),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, a.v AS v1, b.v AS v2, c.v AS v3, d.v AS v4, e.v AS v5
  FROM s AS a, s AS b, s AS c, s AS d, s AS e WHERE a.v + b.v + c.v + d.v + e.v = 31),
p AS (SELECT filter_order, 1 AS step, v1 AS bit, 0 AS prior FROM o
  UNION ALL SELECT filter_order, 2, v2, v1 FROM o
  UNION ALL SELECT filter_order, 3, v3, v1 + v2 FROM o
  UNION ALL SELECT filter_order, 4, v4, v1 + v2 + v3 FROM o
  UNION ALL SELECT filter_order, 5, v5, v1 + v2 + v3 + v4 FROM o),
g AS (SELECT part, filter_order, step, bit,
  sum(CASE WHEN (mask & (bit + prior)) = 0 THEN n ELSE 0 END) AS kept,
  sum(CASE WHEN (mask & bit) <> 0 AND (mask & prior) = 0 THEN n ELSE 0 END) AS removed,
  sum(CASE WHEN (mask & bit) <> 0 AND (mask & prior) <> 0 THEN n ELSE 0 END) AS redundant,
  sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
  sum(CASE WHEN (mask & bit) <> 0 AND (mask & prior) = 0 THEN n * good ELSE 0 END) AS good_lost,
  sum(CASE WHEN (mask & bit) <> 0 AND (mask & prior) = 0 THEN n * toxic ELSE 0 END) AS toxic_lost
  FROM p, c GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM g
"""


def oracle():
    return {"op3_quality_rules": OP3, "op9_line_dedup": OP9, "op11_filter_audit": OP11}

"""DuckDB SQL for the queries that SQL can express over whole tables."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BLANK = r"[^\x20\x09-\x0D]+"

DECONTAMINATE = f"""WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_ALNUM}') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_ALNUM}') AS w FROM benchmark),
windows AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, unnest(CASE WHEN len(w) >= 13
    THEN list_transform(range(1, len(w) - 11), lambda s: array_to_string(w[s:s + 12], ' ')) ELSE [array_to_string(w, ' ')] END) AS g
  FROM i WHERE len(w) > 0),
starts AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS s, w FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n),
met AS (SELECT p.doc_id, p.s, p.n, x.item_id FROM (SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS g FROM starts) p JOIN windows x USING (n, g)),
hit AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS place FROM met) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM met) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)"""

LINE_FREQUENCY = f"""WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_BLANK}') AS w FROM documents),
lines AS (SELECT * FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '{_BLANK}')),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines GROUP BY doc_id),
grams AS (SELECT doc_id, s, array_to_string(w[s:s + 2], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS s FROM d)),
twice AS (SELECT doc_id, s FROM (SELECT doc_id, s, count(*) OVER (PARTITION BY doc_id, g) AS c FROM grams) WHERE c > 1),
again AS (SELECT doc_id, count(DISTINCT place) AS n_repeat_words FROM (SELECT doc_id, unnest([s, s + 1, s + 2]) AS place FROM twice) GROUP BY doc_id),
normal AS (SELECT doc_id, source, len(lw) AS n, regexp_replace(translate(array_to_string(lw, ' '), '{_UPPER}', '{_LOWER}'), '[0-9]', '0', 'g') AS line
  FROM (SELECT doc_id, source, regexp_extract_all(line, '{_BLANK}') AS lw FROM lines)),
common AS (SELECT source, line FROM normal GROUP BY source, line HAVING count(DISTINCT doc_id) > 20),
lost AS (SELECT doc_id, count(*) AS n_lines, sum(n) AS n_lost FROM normal x JOIN common c ON x.line = c.line AND x.source IS NOT DISTINCT FROM c.source GROUP BY doc_id),
base AS (SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(n_lines, 0)::BIGINT AS n_frequent_lines, coalesce(n_lost, 0)::BIGINT AS n_lost_words
  FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN again USING (doc_id) LEFT JOIN lost USING (doc_id)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND n_lost_words <= 0.5 * n_words AS kept, n_frequent_lines, n_lost_words FROM judged"""

COLLOCATIONS = f"""WITH t AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS x FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(x, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM t),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM p),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
grams AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase FROM places, (SELECT unnest([1, 2, 3, 4, 5]) AS m) WHERE i + m - 1 <= len(w)),
f AS (SELECT lang, m, phrase, count(*)::BIGINT AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS s FROM f WHERE m > 1),
inner_phrases AS (SELECT lang, array_to_string(s[i:i + k - 1], ' ') AS phrase, a FROM (SELECT lang, s, m, a, k, unnest(range(1, m - k + 2)) AS i FROM c, (SELECT unnest([2, 3, 4]) AS k) WHERE k < m)),
gone AS (SELECT DISTINCT c.lang, c.phrase FROM c JOIN inner_phrases x ON c.lang = x.lang AND c.phrase = x.phrase WHERE 100 * x.a >= 100 * c.a),
cuts AS (SELECT lang, phrase, a, k, array_to_string(s[1:k], ' ') AS first, array_to_string(s[k + 1:], ' ') AS rest FROM (SELECT *, unnest(range(1, m)) AS k FROM c)),
scored AS (SELECT x.lang, x.phrase, x.a, x.k, p.f AS l, q.f AS r, n, ((1000::HUGEINT * x.a * n) // (p.f::HUGEINT * q.f))::BIGINT AS score
  FROM cuts x JOIN f p ON p.lang = x.lang AND p.phrase = x.first JOIN f q ON q.lang = x.lang AND q.phrase = x.rest JOIN total o ON o.lang = x.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::BIGINT AS rank, phrase, a, l, r, n, score
  FROM best ANTI JOIN gone USING (lang, phrase))
SELECT * FROM ranked WHERE rank <= 2000"""

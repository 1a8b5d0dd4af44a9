"""DuckDB SQL for the operators that SQL can express, written from their contracts.

Rule limits, thresholds and the licence statements are fixed values of the operators.
"""

from __future__ import annotations

from lakestrata.llm.license_scan import TEMPLATES

EXACT_DEDUP = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t FROM documents)
SELECT doc_id, first_value(doc_id) OVER (PARTITION BY t ORDER BY n DESC, doc_id NULLS LAST) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY n DESC, doc_id NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM d"""

QUALITY_RULES = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                  list_filter(string_split(coalesce(text, ''), chr(10)),
                              lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS g
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM windows)
          WHERE c >= 2),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM again, range(5) AS r(k) GROUP BY doc_id),
f AS (SELECT d.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, len(lines) AS n_lines,
             len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
             len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_same_words,
             length(regexp_replace(t, '\P{L}+', '', 'g')) AS n_letters,
             length(regexp_replace(t, '\P{Lu}+', '', 'g')) AS n_capitals
      FROM d LEFT JOIN covered USING (doc_id)),
v AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
             10 * n_symbols > 3 * n_words OR word_chars < 2 * n_words OR word_chars > 15 * n_words
             OR (n_dup_lines >= 3 AND 10 * n_dup_lines > 3 * n_lines) OR 4 * n_same_words > n_words
             OR 2 * n_capitals > n_letters OR 2 * n_letters < word_chars AS rule_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT rule_failed AS kept FROM v"""


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


LICENSE_SCAN = r"""
WITH templates(name, license, wording) AS (VALUES """ + ", ".join(
    f"({_text(a)}, {_text(b)}, {_text(c)})" for a, b, c in TEMPLATES) + r"""),
tw AS (SELECT name, license, list_filter(regexp_split_to_array(lower(wording), '[^a-z0-9]+'), lambda x: x <> '') AS w
       FROM templates),
tg AS (SELECT DISTINCT name, license, w[i] || ' ' || w[i + 1] AS g
       FROM (SELECT name, license, w, unnest(range(1, len(w))) AS i FROM tw)),
ts AS (SELECT name, license, count(*) AS size FROM tg GROUP BY ALL),
d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
u AS (SELECT row_number() OVER () AS uid, doc_id, unit FROM (
        SELECT doc_id, unnest(list_distinct(list_concat(string_split(t, chr(10)),
               string_split_regex(t, '\n(?:[^\p{L}\p{N}\n]*\n)+'),
               string_split_regex(regexp_replace(t, '([.!?])[\x20\x09-\x0D]+', concat('\1', chr(10), chr(10)), 'g'),
                                  '\n(?:[^\p{L}\p{N}\n]*\n)+'), [t]))) AS unit FROM d)),
uw AS (SELECT uid, doc_id, list_filter(regexp_split_to_array(lower(unit), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM u),
ug AS (SELECT DISTINCT uid, doc_id, w[i] || ' ' || w[i + 1] AS g
       FROM (SELECT uid, doc_id, w, unnest(range(1, len(w))) AS i FROM uw)),
us AS (SELECT uid, count(*) AS size FROM ug GROUP BY uid),
m AS (SELECT doc_id, license, name, 2 * CAST(shared AS DOUBLE) / (us.size + ts.size) AS dice
      FROM (SELECT uid, doc_id, license, name, count(*) AS shared FROM ug JOIN tg USING (g) GROUP BY ALL)
      JOIN us USING (uid) JOIN ts USING (license, name)),
hits AS (SELECT doc_id, count(*) AS n_matches, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses,
                min(struct_pack(minus := -dice, name := name, license := license)) AS best
         FROM m WHERE dice >= 0.8 GROUP BY doc_id)
SELECT doc_id, best.license AS license, best.name AS template, coalesce(-best.minus, 0.0::DOUBLE) AS dice,
       coalesce(n_matches, 0) AS n_matches, coalesce(licenses, '') AS licenses
FROM d LEFT JOIN hits USING (doc_id)"""

#: Fixed values of the audit: least documents of a kept term, scale of a share, listed terms.
SOURCE_DIVERGENCE = r"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(text, '') AS t, coalesce(lang, '') AS lang,
                  coalesce(source, '') AS source FROM documents),
w AS (SELECT row, lang, source, translate(unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
kept AS (SELECT lang, term, count(*) AS of_lang FROM w GROUP BY ALL HAVING count(DISTINCT row) >= 10),
n AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
total AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM n GROUP BY ALL),
l AS (SELECT lang, count(*)::HUGEINT AS v, sum(of_lang)::HUGEINT AS lang_total FROM kept GROUP BY lang),
g AS (SELECT lang, source, coalesce(total, 0) AS total, coalesce(v, 0) AS v, coalesce(lang_total, 0) AS lang_total
      FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN total USING (lang, source) LEFT JOIN l USING (lang)),
p AS (SELECT g.lang, g.source, kept.term, coalesce(n.n, 0) AS n,
             1 + 1000000000 * (coalesce(n.n, 0) + 2)::HUGEINT // (g.total + 2 * g.v) AS p,
             1 + 1000000000 * (kept.of_lang + 2)::HUGEINT // (g.lang_total + 2 * g.v) AS q
      FROM g JOIN kept USING (lang) LEFT JOIN n USING (lang, source, term)),
shared AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS f
         FROM p AS a JOIN p AS b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(f, 0)::BIGINT AS value
          FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN shared ON shared.lang = a.lang AND shared.source = a.source AND shared.item = b.source),
terms AS (SELECT lang, source, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value
          FROM p WHERE n > 0 AND p > q),
parts AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs
          UNION ALL SELECT lang, source, 'term', item, value FROM terms)
SELECT lang, source, part, item, value, rank::INTEGER AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
WHERE part = 'pair' OR rank <= 10"""

#: SHA-1 is 40 hex digits; five of them make four base32 letters.
WARC = r"""
WITH p AS (SELECT row_number() OVER () AS row, page_id, coalesce(html, '') AS h FROM pages),
f AS (SELECT *, first_value(page_id) OVER w AS first_id, row_number() OVER w AS place, sha1(h) AS hex
      FROM p WINDOW w AS (PARTITION BY h ORDER BY page_id NULLS LAST, row)),
d AS (SELECT *, list_transform(range(8), lambda k: ('0x' || substr(hex, 5 * k + 1, 5))::BIGINT) AS five FROM f)
SELECT page_id, strlen(h) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           ((five[k // 4 + 1] >> (15 - 5 * (k % 4))) & 31)::BIGINT + 1, 1)), '') AS payload_digest,
       CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN place > 1 THEN first_id END AS refers_to FROM d"""

#: Costs and the wanted role sequence are fixed values; states: 0 start, 1 after s, 2 after u, 3 after a.
CONVERSATION_REPAIR = r"""
WITH RECURSIVE c AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
crc AS (SELECT *, xor(list_reduce(list_transform(range(1, length(key) + 1), lambda i: ascii(substr(key, i, 1))::BIGINT),
          lambda x, b: list_reduce(range(8),
            lambda y, z: CASE WHEN y % 2 = 1 THEN xor(y // 2, 3988292384) ELSE y // 2 END, xor(x, b)),
          4294967295::BIGINT), 4294967295) % 20 AS what FROM c),
rows AS (SELECT conv_id, turn, CASE WHEN what = 4 THEN 'user' ELSE role END AS role,
                CASE WHEN what = 1 THEN '' WHEN what = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
         FROM crc, range(2) AS copy(i) WHERE what <> 0 AND (i = 0 OR what = 3)),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k FROM rows),
r AS (SELECT conv_id, turn, role, text, substr(role, 1, 1) AS first, k,
             CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                  WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 THEN 'duplicate'
                  WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault
      FROM o),
neighbours AS (SELECT conv_id, lag(first) OVER (PARTITION BY conv_id ORDER BY k) || first AS pair FROM r),
inserts(p, q, cost, audit) AS (VALUES (0, 0, 0, ''), (1, 1, 0, ''), (2, 2, 0, ''), (3, 3, 0, ''), (0, 2, 3, 'I'),
  (1, 2, 3, 'I'), (3, 2, 3, 'I'), (2, 3, 3, 'I'), (0, 3, 6, 'II'), (1, 3, 6, 'II')),
edits(p, q, edit, first, cost) AS (VALUES (0, 0, 'D', NULL, 4), (1, 1, 'D', NULL, 4), (2, 2, 'D', NULL, 4),
  (3, 3, 'D', NULL, 4), (0, 1, 'K', 's', 0), (0, 2, 'K', 'u', 0), (1, 2, 'K', 'u', 0), (3, 2, 'K', 'u', 0),
  (2, 3, 'K', 'a', 0), (0, 2, 'R', NULL, 3), (1, 2, 'R', NULL, 3), (3, 2, 'R', NULL, 3), (2, 3, 'R', NULL, 3)),
heads AS (SELECT DISTINCT conv_id FROM conversations),
dp(conv_id, k, state, best) AS (
  SELECT conv_id, 0::BIGINT, 0, {'cost': 0::BIGINT, 'audit': ''} FROM heads
  UNION ALL
  SELECT dp.conv_id, dp.k + 1, e.q,
         min({'cost': best.cost + i.cost + e.cost + CASE WHEN r.fault = 'truncated' AND e.edit <> 'D' THEN 3 ELSE 0 END,
              'audit': best.audit || i.audit || e.edit})
  FROM dp JOIN r ON r.conv_id IS NOT DISTINCT FROM dp.conv_id AND r.k = dp.k + 1 JOIN inserts AS i ON i.p = dp.state
  JOIN edits AS e ON e.p = i.q AND (e.first IS NULL OR e.first = r.first)
       AND (e.edit = 'D' OR r.fault NOT IN ('blank', 'duplicate'))
  GROUP BY dp.conv_id, dp.k, e.q),
n AS (SELECT conv_id, count(*) AS n, count(*) FILTER (fault = 'blank') AS blank,
             count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
             max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps FROM r GROUP BY conv_id),
ends AS (SELECT dp.conv_id, min({'cost': best.cost + i.cost, 'audit': best.audit || i.audit}) AS best
         FROM dp LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM dp.conv_id JOIN inserts AS i ON i.p = dp.state
         WHERE dp.k = coalesce(n.n, 0) AND i.q IN (0, 3) GROUP BY dp.conv_id),
letters AS (SELECT conv_id, pos, substr(best.audit, pos, 1) AS edit,
                   length(replace(substr(best.audit, 1, pos), 'I', '')) AS k
            FROM (SELECT conv_id, best, unnest(range(1, length(best.audit) + 1)) AS pos FROM ends)),
kept AS (SELECT l.conv_id, l.pos, l.edit, r.role, r.text, r.first,
                row_number() OVER (PARTITION BY l.conv_id ORDER BY pos) AS place
         FROM letters AS l LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM l.conv_id AND r.k = l.k WHERE edit <> 'D'),
lines AS (SELECT conv_id, pos, CASE WHEN edit = 'K' THEN role
                   WHEN (place + bool_or(place = 1 AND edit = 'K' AND first = 's') OVER (PARTITION BY conv_id)::INT) % 2 = 1
                   THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END AS line FROM kept),
whole AS (SELECT conv_id, sha256(string_agg(line, chr(10) ORDER BY pos)) AS hash FROM lines GROUP BY conv_id),
bad AS (SELECT conv_id, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM neighbours GROUP BY conv_id)
SELECT ends.conv_id, coalesce(n.gaps, 0) AS gaps, coalesce(n.blank, 0) AS blank, coalesce(n.duplicate, 0) AS duplicate,
       coalesce(n.truncated, 0) AS truncated, coalesce(bad.illegal, 0) AS illegal, ends.best.cost AS cost,
       ends.best.audit AS audit, coalesce(whole.hash, sha256('')) AS repaired_sha256
FROM ends LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM ends.conv_id
LEFT JOIN bad ON bad.conv_id IS NOT DISTINCT FROM ends.conv_id
LEFT JOIN whole ON whole.conv_id IS NOT DISTINCT FROM ends.conv_id"""

ORACLE: dict[str, str] = {
    "op3_exact_dedup": EXACT_DEDUP,
    "op4_license_scan": LICENSE_SCAN,
    "op8_quality_rules": QUALITY_RULES,
    "op11_conversation_repair": CONVERSATION_REPAIR,
    "op12_source_divergence": SOURCE_DIVERGENCE,
    "op13_warc": WARC,
}

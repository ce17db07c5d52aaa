"""DuckDB SQL of the queries over conversations, n-gram sets and ranked search."""

from __future__ import annotations

LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORD_RE = "[^\\x20\\x09-\\x0D]+"
TERM_RE = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"


def _way(add: str, of: str, edit: str) -> str:
    """Cost (nine digits) and audit of an edit before the rest ``of``."""
    return f"printf('%09d', substr({of}, 1, 9)::INT + {add}) || '{edit}' || substr({of}, 10)"


def _plain(state: str, to: str, letter: str, system: bool = False) -> str:
    ways = [_way("3", state, "D"), f"CASE WHEN fault IN ('o', 't') THEN {_way('2 + cut', to, 'R')} END",
            f"CASE WHEN fault IN ('o', 't') AND left(role, 1) = '{letter}' THEN {_way('cut', to, 'K')} END"]
    if system:
        ways.append(f"CASE WHEN fault IN ('o', 't') AND left(role, 1) = 's' THEN {_way('cut', 's', 'K')} END")
    return f"least({', '.join(ways)})"


REPAIR_SQL = f"""
WITH RECURSIVE bits(i, c, k) AS (
  SELECT i, i::BIGINT, 0 FROM range(256) r(i)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS tab FROM bits WHERE k = 8),
spaced AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
  FROM conversations),
kinds AS (
  SELECT s.*, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(key, ''), lambda x: ord(x)::BIGINT)),
                              lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind
  FROM spaced s, crc),
hurt AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM kinds, range(2) c(copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS pos,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body
  FROM hurt),
judged AS (
  SELECT conv_id, turn, pos, role, text, 0 AS cut,
         CASE WHEN body = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'd'
              WHEN right(body, 1) IN ('.', '!', '?') THEN 'o' ELSE 't' END AS fault,
         left(role, 1) || lead(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS pair
  FROM placed),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
         count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(pos) AS n
  FROM judged GROUP BY conv_id),
back(conv_id, place, e, s, u, p) AS (
  SELECT conv_id, n + 1, '000000000', '000000004II', '000000002I', '000000000' FROM counts
  UNION ALL
  SELECT conv_id, place, least(pe, {_way('2', 'pu', 'I')}), least(ps, {_way('2', 'pu', 'I')}),
         least(pu, {_way('2', 'pp', 'I')}), least(pp, {_way('2', 'pu', 'I')})
  FROM (SELECT b.conv_id, b.place - 1 AS place, {_plain('e', 'u', 'u', True)} AS pe, {_plain('s', 'u', 'u')} AS ps,
               {_plain('u', 'p', 'a')} AS pu, {_plain('p', 'u', 'u')} AS pp
        FROM back b JOIN (SELECT * REPLACE (CASE WHEN fault = 't' THEN 1 ELSE 0 END AS cut) FROM judged) j
          ON b.conv_id IS NOT DISTINCT FROM j.conv_id AND j.pos = b.place - 1)),
best AS (SELECT conv_id, substr(e, 1, 9)::BIGINT AS cost, substr(e, 10) AS audit FROM back WHERE place = 1),
letters AS (SELECT conv_id, i, substr(audit, i, 1) AS edit FROM best, range(1, length(audit) + 1) r(i)),
steps AS (
  SELECT *, count(*) FILTER (edit <> 'I') OVER w AS pos, count(*) FILTER (edit <> 'D') OVER w AS nth
  FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY i)),
kept AS (
  SELECT s.conv_id, s.i, s.edit, s.nth, j.role, CASE WHEN s.edit = 'I' THEN '' ELSE j.text END AS text,
         max(CASE WHEN s.nth = 1 AND s.edit = 'K' AND left(j.role, 1) = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY s.conv_id) AS led
  FROM steps s LEFT JOIN judged j ON s.conv_id IS NOT DISTINCT FROM j.conv_id AND s.pos = j.pos WHERE s.edit <> 'D'),
hashes AS (
  SELECT conv_id, sha256(string_agg(CASE WHEN edit = 'K' THEN role WHEN (nth - led) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY i)) AS h
  FROM kept GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
       coalesce(audit, '') AS audit, coalesce(h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts c ON o.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN best b ON o.conv_id IS NOT DISTINCT FROM b.conv_id LEFT JOIN hashes h ON o.conv_id IS NOT DISTINCT FROM h.conv_id"""


JACCARD_SQL = f"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '{WORD_RE}') AS words FROM documents),
s AS (
  SELECT r, doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
         ELSE list_distinct(list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' '))) END AS grams
  FROM w),
g AS (SELECT r, len(grams) AS n, unnest(list_transform(grams, lambda x: hash(x))) AS gram FROM s),
b AS (
  SELECT x.r AS a, y.r AS b, x.n + y.n AS n, count(*) AS shared FROM g x JOIN g y USING (gram)
  WHERE x.r < y.r AND 100 * x.n >= 85 * y.n AND 100 * y.n >= 85 * x.n GROUP BY ALL),
h AS (SELECT a, b FROM b WHERE 100 * shared >= 85 * (n - shared)),
l AS (SELECT a, b FROM h UNION ALL SELECT b, a FROM h),
reach(a, b) AS (SELECT r, r FROM s UNION SELECT reach.a, l.b FROM reach JOIN l ON l.a = reach.b)
SELECT x.doc_id, any_value(len(x.grams)) AS n_shingles, min(y.doc_id) AS component_id
FROM reach JOIN s x ON x.r = a JOIN s y ON y.r = b GROUP BY x.r, x.doc_id"""


SEARCH_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, unnest(regexp_extract_all({LOWER.format('text')}, '{TERM_RE}')) AS term FROM documents),
tf AS (SELECT r, doc_id, term, count(*) AS tf FROM d GROUP BY ALL),
n AS (SELECT r, sum(tf)::BIGINT AS n FROM tf GROUP BY r),
c AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM n),
m AS (SELECT r, 100 - 25 + (25 * n * docs) // words AS m FROM n, c),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, c GROUP BY term, docs),
q AS (
  SELECT i, item_id, term, count(*) AS many
  FROM (SELECT row_number() OVER () AS i, item_id, unnest(regexp_extract_all({LOWER.format('text')}, '{TERM_RE}')) AS term FROM benchmark) GROUP BY ALL),
s AS (
  SELECT i, item_id, r, doc_id, sum(many * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM q JOIN w USING (term) JOIN tf USING (term) JOIN m USING (r) GROUP BY i, item_id, r, doc_id),
k AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM k WHERE rank <= 20"""

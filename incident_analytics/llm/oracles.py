"""SQL of the queries that SQL can express, on whole tables."""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

SOURCE_MIX = rf"""
WITH d AS (SELECT doc_id, source, CAST(len({WORDS}) AS BIGINT) AS size FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source IS NULL, source) - 1 AS turn
  FROM d GROUP BY source
),
w AS (
  SELECT *, CASE turn % 3 WHEN 0 THEN 5.0e0 WHEN 1 THEN 2.0e0 ELSE 1.0e0 END AS weight,
         source_size * 2.0e0 AS top
  FROM s
),
o AS (
  SELECT *, top / weight AS full_at,
         (sum(source_size) OVER () * 1.5e0
          - coalesce(sum(top) OVER (ORDER BY top / weight, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / (sum(weight) OVER ()
            - coalesce(sum(weight) OVER (ORDER BY top / weight, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM w
),
l AS (SELECT level AS reached FROM o WHERE level <= full_at ORDER BY full_at, turn LIMIT 1),
t AS (
  SELECT source, source_size,
         CASE WHEN (SELECT reached FROM l) IS NULL THEN top ELSE least(top, weight * (SELECT reached FROM l)) END AS target
  FROM o
),
r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         CAST('0x' || substr(md5('42:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) / 4503599627370496.0e0 AS draw
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM r"""

SUBSTRING_DEDUP = rf"""
WITH d AS (SELECT doc_id, {WORDS} AS words FROM documents),
s AS (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM d WHERE len(words) >= 20),
k AS (SELECT doc_id, i, array_to_string(words[i : i + 19], ' ') AS seq FROM s),
later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY seq ORDER BY doc_id, i) AS n FROM k) x
  WHERE n > 1
),
gone AS (SELECT DISTINCT doc_id, i + j AS at FROM later, (SELECT unnest(range(0, 20)) AS j) y),
w AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS at FROM d),
kept AS (
  SELECT w.doc_id, string_agg(w.word, ' ' ORDER BY w.at) AS text, count(*) AS n
  FROM w LEFT JOIN gone g ON w.doc_id = g.doc_id AND w.at = g.at WHERE g.at IS NULL GROUP BY w.doc_id
)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words,
       CAST(len(d.words) - coalesce(kept.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id"""

MINHASH_DEDUP = rf"""
WITH RECURSIVE low AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
),
s AS (
  SELECT DISTINCT doc_id, array_to_string(words[i : i + 3], ' ') AS k
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, 2))) AS i FROM low WHERE len(words) > 0) x
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.k = b.k AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)
),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a
),
c AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT c.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id,
       c.doc_id = c.component_id AS kept
FROM c LEFT JOIN n ON n.doc_id = c.doc_id"""

#: A table of the CRC-32 of each byte, from its rule.
CRC = """crc_bits AS (
  SELECT list_transform(range(256), lambda x:
    list_reduce([x] || range(8), lambda c, i: xor(c >> 1, 3988292384 * (c & 1)))) AS made
)"""


def crc(text: str) -> str:
    """The crc32 of an ASCII text as SQL, over `crc_bits`."""
    return (
        f"xor(list_reduce([4294967295::BIGINT] || list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT), "
        "lambda c, b: xor(c >> 8, made[1 + (xor(c, b) & 255)])), 4294967295)"
    )


def field(column: str) -> str:
    """A value after its number of UTF-8 bytes and a colon, or a dash for null."""
    text = f"CAST({column} AS VARCHAR)"
    return f"coalesce(CAST(octet_length(encode({text})) AS VARCHAR) || ':' || {text}, '-')"


MERKLE = f"""
WITH RECURSIVE {CRC},
made AS (
  SELECT doc_id, lang, {crc("CAST(doc_id AS VARCHAR)")} AS crc,
    {" || ".join(field(c) for c in ("doc_id", "source", "lang"))} AS head, n_chars, {field("n_chars")} AS n, {field("CAST(n_chars AS HUGEINT) + 1")} AS more, {field("text")} AS body
  FROM documents, crc_bits
),
leaves AS (
  SELECT doc_id, lang, sha256(head || n || body) AS leaf,
    sha256(head || CASE WHEN crc % 7 = 0 AND n_chars IS NOT NULL THEN more ELSE n END || body) AS claim
  FROM made
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY lang) AS n
  FROM leaves
),
tree AS (
  SELECT lang, 0 AS lev, pos, leaf AS h, n FROM placed
  UNION ALL
  SELECT lang, lev + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), any_value((n + 1) // 2)
  FROM tree WHERE n > 1 GROUP BY lang, lev, pos // 2
),
subs AS (
  SELECT lang, lev AS height, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
  FROM tree WHERE n = 1
),
forest AS (
  SELECT 0 AS lev, pos, subroot AS h, n FROM subs
  UNION ALL
  SELECT lev + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), any_value((n + 1) // 2)
  FROM forest WHERE n > 1 GROUP BY lev, pos // 2
),
top AS (SELECT h AS root, lev AS height FROM forest WHERE n = 1),
walk AS (
  SELECT p.doc_id, p.lang, p.leaf, s.subroot, s.height, s.pos AS place, p.pos, 0 AS lev, p.claim AS cur, '' AS proof
  FROM placed p JOIN subs s ON s.lang IS NOT DISTINCT FROM p.lang
  UNION ALL
  SELECT w.doc_id, w.lang, w.leaf, w.subroot, w.height, w.place, w.pos // 2, w.lev + 1,
    sha256(CASE WHEN t.h IS NULL THEN cur WHEN w.pos % 2 = 1 THEN t.h || cur ELSE cur || t.h END), proof || coalesce(t.h, '')
  FROM walk w LEFT JOIN tree t ON t.lang IS NOT DISTINCT FROM w.lang AND t.lev = w.lev AND t.pos = xor(w.pos, 1)
  WHERE w.lev < w.height
),
climb AS (
  SELECT doc_id, leaf, subroot, root, top.height, place AS pos, 0 AS lev, cur, proof
  FROM walk, top WHERE walk.lev = walk.height
  UNION ALL
  SELECT c.doc_id, c.leaf, c.subroot, c.root, c.height, c.pos // 2, c.lev + 1,
    sha256(CASE WHEN f.h IS NULL THEN cur WHEN c.pos % 2 = 1 THEN f.h || cur ELSE cur || f.h END), proof || coalesce(f.h, '')
  FROM climb c LEFT JOIN forest f ON f.lev = c.lev AND f.pos = xor(c.pos, 1)
  WHERE c.lev < c.height
)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = root AS verified
FROM climb WHERE lev = height"""

REPAIR = rf"""
WITH RECURSIVE {CRC},
drawn AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {crc("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS k
  FROM conversations, crc_bits
),
hurt AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
    CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN k = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM drawn WHERE k <> 0
),
listed AS (
  SELECT conv_id, turn, role, text, substr(role, 1, 1) AS c,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS solid
  FROM hurt
),
faulty AS (
  SELECT *, CASE WHEN solid = '' THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN right(solid, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(c) OVER (PARTITION BY conv_id ORDER BY i) || c AS pair
  FROM listed
),
counted AS (
  SELECT conv_id, max(i) AS n,
    CAST(coalesce(CAST(max(turn) AS HUGEINT) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps,
    count(CASE WHEN fault = 'blank' THEN 1 END) AS blank, count(CASE WHEN fault = 'duplicate' THEN 1 END) AS duplicate,
    count(CASE WHEN fault = 'truncated' THEN 1 END) AS truncated,
    count(CASE WHEN pair NOT IN ('su', 'ua', 'au') THEN 1 END) AS illegal
  FROM faulty GROUP BY conv_id
),
-- The best (cost, audit, lines) of the first i rows by the state that they end in; one insertion before a row at most.
best AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, '' AS s, {{'cost': CAST(0 AS BIGINT), 'audit': '', 'lines': CAST([] AS VARCHAR[])}} AS b FROM counted
  UNION ALL
  SELECT conv_id, i, move.s, min(move.b) FROM (
    SELECT f.conv_id, f.i, unnest([
        {{'s': a.s, 'b': {{'cost': a.cost + 3, 'audit': a.audit || 'D', 'lines': a.lines}}}},
        {{'s': CASE WHEN fault NOT IN ('blank', 'duplicate') AND (a.s || c) IN ('s', 'u', 'su', 'ua', 'au') THEN c END,
          'b': {{'cost': a.cost + CASE fault WHEN 'truncated' THEN 1 ELSE 0 END, 'audit': a.audit || 'K', 'lines': list_append(a.lines, role || ':' || text)}}}},
        {{'s': CASE WHEN fault NOT IN ('blank', 'duplicate') THEN CASE a.s WHEN 'u' THEN 'a' ELSE 'u' END END,
          'b': {{'cost': a.cost + 2 + CASE fault WHEN 'truncated' THEN 1 ELSE 0 END, 'audit': a.audit || 'R',
            'lines': list_append(a.lines, CASE a.s WHEN 'u' THEN 'assistant:' ELSE 'user:' END || text)}}}}
      ]) AS move
    FROM (
      SELECT conv_id, i, s, b.cost AS cost, b.audit AS audit, b.lines AS lines FROM best
      UNION ALL
      SELECT conv_id, i, CASE s WHEN 'u' THEN 'a' ELSE 'u' END, b.cost + 2, b.audit || 'I',
        list_append(b.lines, CASE s WHEN 'u' THEN 'assistant:' ELSE 'user:' END) FROM best
    ) a JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM a.conv_id AND f.i = a.i + 1
  ) m WHERE move.s IS NOT NULL GROUP BY conv_id, i, move.s
),
ended AS (
  SELECT b.conv_id, min({{'cost': b.b.cost + 2 * len(t.tail), 'audit': b.b.audit || repeat('I', len(t.tail)), 'lines': list_concat(b.b.lines, t.tail)}}) AS e
  FROM best b JOIN counted c ON c.conv_id IS NOT DISTINCT FROM b.conv_id AND c.n = b.i,
    LATERAL (SELECT CASE b.s WHEN 's' THEN ['user:', 'assistant:'] WHEN 'u' THEN ['assistant:'] ELSE CAST([] AS VARCHAR[]) END AS tail) t
  GROUP BY b.conv_id
),
every AS (SELECT DISTINCT conv_id FROM conversations)
SELECT v.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(e.cost, 0) AS cost, coalesce(e.audit, '') AS audit,
  sha256(coalesce(array_to_string(e.lines, chr(10)), '')) AS repaired_sha256
FROM every v LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM v.conv_id LEFT JOIN ended x ON x.conv_id IS NOT DISTINCT FROM v.conv_id"""

"""DuckDB SQL for the queries that SQL can express."""

WARC = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM f
"""

CHAT_FORMAT = """
WITH own AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -1, t.turn, t.role, '<|im_end|><|im_start|>assistant ok'
  FROM (VALUES (0, 'user'), (1, 'assistant')) AS t(turn, role)
), e AS (
  SELECT *, regexp_replace(text, '<(\\|+)', '<|\\1', 'g') AS escaped,
         lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before
  FROM own
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text))
         AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
                       FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(escaped) + CASE WHEN before IS NOT DISTINCT FROM role THEN 10
                                       ELSE 12 + length(role) + 1 + 11 END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

# Per rule: kind, its place in the order, regex, group of the value, least length of the value.
_RULES = (
    ("assign", 0, r'''((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)''', 2, 6),
    ("access", 1, r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", 2, r"[0-9a-f]{24,}", 0, 24),
    ("github", 3, r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 0),
    ("slack", 4, r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 0),
    ("google", 5, r"AIza[0-9A-Za-z_-]{35}", 0, 0),
    ("jwt", 6, r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 0),
    ("private_key", 7, r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----", 0, 0),
)

_FOUND = " UNION ALL ".join(f"""
  SELECT row_id, '{kind}' AS kind, {place} AS place, {least} AS least,
         string_split_regex(t, '{pattern}') AS gaps, regexp_extract_all(t, '{pattern}', 0) AS hits,
         regexp_extract_all(t, '{pattern}', {group}) AS vals
  FROM d WHERE regexp_matches(t, '{pattern}')""" for kind, place, pattern, group, least in _RULES)

SECRET_SCAN = f"""
WITH d AS (
  SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS t FROM documents
), found AS ({_FOUND}
), hit AS (
  SELECT row_id, kind, place, least, unnest(hits) AS hit, unnest(vals) AS val, generate_subscripts(hits, 1) AS i,
         gaps, hits FROM found
), span AS (
  SELECT row_id, kind, place,
         list_sum(list_transform(gaps[:i], lambda x: length(x)))
           + coalesce(list_sum(list_transform(hits[:i - 1], lambda x: length(x))), 0) AS s, length(hit) AS n
  FROM hit WHERE length(val) >= least
), listed AS (
  SELECT row_id, kind, place, CAST(s AS BIGINT) AS s,
         kind || ':' || CAST(s AS BIGINT) || ':' || CAST(s + n AS BIGINT) AS shown FROM span
), per AS (
  SELECT row_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign,
         count(*) FILTER (WHERE kind = 'access') AS n_access, count(*) FILTER (WHERE kind = 'hex') AS n_hex,
         coalesce(string_agg(shown, ',' ORDER BY s, place) FILTER (WHERE place < 3), '') AS base,
         string_agg(shown, ',' ORDER BY s, place) AS spans
  FROM listed GROUP BY row_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN per USING (row_id)
"""

# CRC-32 of a number's decimal digits, bit by bit (polynomial 0xEDB88320).
_CRC32 = """xor(4294967295, list_reduce(
  list_concat([4294967295::BIGINT], list_transform(string_split(CAST({c} AS VARCHAR), ''), lambda d: ascii(d)::BIGINT)),
  lambda crc, byte: list_reduce([xor(crc, byte), 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT,
                                 0::BIGINT, 0::BIGINT],
    lambda x, b: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)))"""

PREFIX_TRIE = f"""
WITH turns AS (
  SELECT conv_id AS c, length(r) || ':' || r || length(t) || ':' || t AS said,
         len(list_filter(string_split_regex(t, '[ \t-\r]+'), lambda w: w <> '')) AS words,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                            substring(sha256(length(r) || ':' || r || t), 1, 32)) AS pos
  FROM (SELECT *, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL)
), convs AS (
  SELECT c, c - c % 20 AS base, {_CRC32.format(c="c")} % 4 AS h FROM (SELECT DISTINCT c FROM turns)
), kept AS (
  SELECT convs.c, pos, said, words FROM convs JOIN turns USING (c) WHERE convs.c = base OR pos > h
  UNION ALL
  SELECT convs.c, pos, said, words FROM convs JOIN turns ON turns.c = base WHERE convs.c <> base AND pos <= h
), steps AS (
  SELECT c, 0 AS depth, '' AS node, NULL AS parent, 0 AS words FROM convs
  UNION ALL
  SELECT c, row_number() OVER w, string_agg(said, '') OVER w,
         coalesce(string_agg(said, '') OVER (PARTITION BY c ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), ''),
         words
  FROM kept WINDOW w AS (PARTITION BY c ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), nodes AS (
  SELECT node, depth, parent, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(words) AS again
  FROM steps GROUP BY node, depth, parent
), ends AS (
  SELECT node, depth, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS ends_sha256
  FROM (SELECT *, max(depth) OVER (PARTITION BY c) AS whole FROM steps) WHERE depth = whole GROUP BY node, depth
), children AS (
  SELECT parent AS node, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL
), below AS (
  SELECT DISTINCT a.node, a.depth, b.node AS lower_node, b.depth AS lower_depth
  FROM steps a JOIN steps b ON a.c = b.c AND b.depth >= a.depth
), sums AS (
  SELECT below.node, below.depth, sum(again) AS saved, count(*) FILTER (WHERE n_children IS NULL) AS n_leaves
  FROM below JOIN nodes l ON l.node = lower_node AND l.depth = lower_depth
  LEFT JOIN children k ON k.node = lower_node AND k.depth = lower_depth
  GROUP BY below.node, below.depth
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs,
       coalesce(k.n_children, 0) AS n_children, s.n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens,
       coalesce(e.ends_sha256, sha256('')) AS ends_sha256
FROM nodes n JOIN sums s ON s.node = n.node AND s.depth = n.depth
LEFT JOIN nodes p ON p.node = n.parent AND p.depth = n.depth - 1
LEFT JOIN children k ON k.node = n.node AND k.depth = n.depth
LEFT JOIN ends e ON e.node = n.node AND e.depth = n.depth
"""

COLLOCATIONS = """
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\n-\r]')) AS piece
  FROM documents
), w AS (
  SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS w FROM piece
), phrase AS (
  SELECT lang, size, phrase, count(*) AS f FROM (
    SELECT lang, 1 AS size, unnest(w) AS phrase FROM w
    UNION ALL
    SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM w
    UNION ALL
    SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM w)
  GROUP BY lang, size, phrase
), total AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM phrase WHERE size = 1 GROUP BY lang
), often AS (
  SELECT * FROM phrase WHERE f >= 10
), cand AS (
  SELECT *, string_split(phrase, ' ') AS w FROM often WHERE size > 1
), cut AS (
  SELECT c.lang, c.phrase, c.f AS a, k, x.f AS l, y.f AS r, 1000000::HUGEINT * c.f * c.f // (x.f::HUGEINT * y.f) AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM cand) c
  JOIN often x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[:k], ' ')
  JOIN often y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1:], ' ')
), best AS (
  SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
  SELECT lang, phrase, max(f) AS longer FROM (
    SELECT lang, w[1] || ' ' || w[2] AS phrase, f FROM cand WHERE size = 3
    UNION ALL SELECT lang, w[2] || ' ' || w[3], f FROM cand WHERE size = 3) GROUP BY lang, phrase
), kept AS (
  SELECT b.* FROM best b LEFT JOIN inside i USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score, k AS cut
FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""

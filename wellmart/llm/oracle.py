"""DuckDB SQL of the queries that SQL can express."""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
ALNUM = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
         r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

OP3 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {WORDS} AS w FROM documents),
l AS (SELECT *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT doc_id, generate_subscripts(gs, 1) AS i, unnest(gs) AS g FROM (
  SELECT doc_id, list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) AS gs FROM d)),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g) WHERE n > 1),
cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id),
m AS (SELECT l.doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
  (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
  (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words, len(ls)::BIGINT AS n_lines,
  length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_upper,
  length(t) - length(regexp_replace(t, '[A-Za-z]', '', 'g')) AS n_letters
  FROM l LEFT JOIN cov USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > 3 * n_words OR word_chars < 2 * n_words OR word_chars > 15 * n_words
    OR 10 * n_dup_lines > 7 * n_lines OR (n_letters > 0 AND 10 * n_upper > 6 * n_letters)) AS kept
FROM b
"""

OP7 = rf"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
g AS (SELECT doc_id, generate_subscripts(gs, 1) AS i, unnest(gs) AS g FROM (
  SELECT doc_id, list_transform(range(1, len(w) - 11), lambda i: array_to_string(w[i:i + 12], ' ')) AS gs FROM d)),
dup AS (SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY g) AS m FROM g) WHERE m < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM dup),
words AS (SELECT doc_id, generate_subscripts(w, 1) AS p, unnest(w) AS x FROM d),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

OP9 = rf"""
WITH b AS (SELECT item_id, {ALNUM} AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS g
  FROM (SELECT *, least(13, len(w)) AS n FROM b WHERE len(w) > 0)),
d AS (SELECT doc_id, {ALNUM} AS w FROM documents),
dw AS (SELECT doc_id, n, generate_subscripts(gs, 1) AS i, unnest(gs) AS g FROM (
  SELECT doc_id, n, list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' ')) AS gs
  FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
hits AS (SELECT doc_id, i, n, item_id FROM dw JOIN iw USING (n, g)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

# crc32 bit by bit; four states (nothing, s, u, a) with cost and letters, one row after the other.
OP13 = r"""
WITH RECURSIVE k AS (
  SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
crc AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(list_reduce(
    flatten(list_transform(range(1, len(key) + 1), lambda i: [ascii(key[i])::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, 4294967295::BIGINT), 4294967295) % 20 AS kind
  FROM k),
d AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN kind = 0 THEN 0 WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM crc),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i, left(role, 1) AS ini FROM d),
f AS (
  SELECT *, lag(ini) OVER (PARTITION BY conv_id ORDER BY i) AS before,
    CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 't' ELSE '' END AS fault
  FROM o),
p AS (
  SELECT conv_id, 0::BIGINT AS i, {'c': 0, 'a': ''} AS n, {'c': 1000000000, 'a': ''} AS s, {'c': 1000000000, 'a': ''} AS u, {'c': 1000000000, 'a': ''} AS e
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, i, {'c': n.c + 3, 'a': n.a || 'D'},
    list_min([{'c': s.c + 3, 'a': s.a || 'D'}, {'c': n.c + t + CASE WHEN ini = 's' THEN x ELSE 1000000000 END, 'a': n.a || 'K'}]),
    list_min([{'c': u.c + 3, 'a': u.a || 'D'}, {'c': w.c + t + CASE WHEN ini = 'u' THEN x ELSE 1000000000 END, 'a': w.a || 'K'},
      {'c': u.c + t + 2 + CASE WHEN ini = 'u' THEN x ELSE 1000000000 END, 'a': u.a || 'IK'},
      {'c': w.c + t + 2 + x, 'a': w.a || 'R'}, {'c': u.c + t + 4 + x, 'a': u.a || 'IR'}]),
    list_min([{'c': e.c + 3, 'a': e.a || 'D'}, {'c': u.c + t + CASE WHEN ini = 'a' THEN x ELSE 1000000000 END, 'a': u.a || 'K'},
      {'c': w.c + t + 2 + CASE WHEN ini = 'a' THEN x ELSE 1000000000 END, 'a': w.a || 'IK'},
      {'c': u.c + t + 2 + x, 'a': u.a || 'R'}, {'c': w.c + t + 4 + x, 'a': w.a || 'IR'}])
  FROM (SELECT p.conv_id, f.i, n, s, u, e, list_min([n, s, e]) AS w, ini, CASE WHEN fault = 't' THEN 1 ELSE 0 END AS t,
      CASE WHEN fault IN ('b', 'd') THEN 1000000000 ELSE 0 END AS x
    FROM p JOIN f ON f.conv_id = p.conv_id AND f.i = p.i + 1)),
z AS (
  SELECT conv_id, list_min([n, e, {'c': u.c + 2, 'a': u.a || 'I'}, {'c': s.c + 4, 'a': s.a || 'II'}]) AS z
  FROM p QUALIFY i = max(i) OVER (PARTITION BY conv_id)),
steps AS (
  SELECT conv_id, l, j, sum(CASE WHEN l <> 'I' THEN 1 ELSE 0 END) OVER w AS i, sum(CASE WHEN l <> 'D' THEN 1 ELSE 0 END) OVER w AS pos
  FROM (SELECT conv_id, unnest(string_split(z.a, '')) AS l, unnest(range(1, len(z.a) + 1)) AS j FROM z WHERE z.a <> '')
  WINDOW w AS (PARTITION BY conv_id ORDER BY j)),
kept AS (
  SELECT steps.conv_id, pos, l, f.role, CASE WHEN l = 'I' THEN '' ELSE f.text END AS text,
    max(CASE WHEN pos = 1 AND l = 'K' AND ini = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY steps.conv_id) AS sys
  FROM steps LEFT JOIN f ON f.conv_id = steps.conv_id AND f.i = steps.i AND l <> 'I' WHERE l <> 'D'),
rep AS (
  SELECT conv_id, string_agg(CASE WHEN l = 'K' THEN role WHEN (pos - sys) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY pos) AS t
  FROM kept GROUP BY conv_id),
c AS (
  SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (fault = 'b') AS blank,
    count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal
  FROM f GROUP BY conv_id)
SELECT z.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, z.c::BIGINT AS cost, z.a AS audit, sha256(coalesce(t, '')) AS repaired_sha256
FROM z LEFT JOIN c USING (conv_id) LEFT JOIN rep USING (conv_id)
"""

# The whole matrix, zeros included.
OP12 = r"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
o AS (SELECT row, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term, count(*) AS c FROM o GROUP BY lang, term HAVING count(DISTINCT row) >= 3),
v AS (SELECT lang, count(*) AS v, sum(c) AS n FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS c FROM o SEMI JOIN k USING (lang, term) GROUP BY lang, source, term),
g AS (SELECT lang, source, coalesce(n, 0) AS n FROM (SELECT DISTINCT lang, source FROM d)
  LEFT JOIN (SELECT lang, source, sum(c) AS n FROM c GROUP BY lang, source) USING (lang, source)),
m AS (SELECT lang, source, term, coalesce(c.c, 0) AS c, (1 + 1000000000::HUGEINT * (coalesce(c.c, 0) + 1) // (g.n + v.v))::BIGINT AS p,
    (1 + 1000000000::HUGEINT * (k.c + 1) // (v.n + v.v))::BIGINT AS q
  FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term)),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM m a JOIN m b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM m WHERE c > 0 AND p > q)
SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
FROM parts QUALIFY part = 'pair' OR rank <= 200
"""

# All 100-byte strings (as hex) in order of their starts; removed runs are the islands of covered bytes.
OP11 = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
p AS (SELECT doc_id, o, n, substring(h, 2 * o + 1, 1222) AS h FROM (SELECT doc_id, h, n, unnest(range(0, n - 99, 512)) AS o FROM d)),
g AS (SELECT doc_id, o + j AS i, md5(substring(h, 2 * j + 1, 200)) AS g FROM (SELECT *, unnest(range(least(512, n - 99 - o))) AS j FROM p)),
dup AS (SELECT doc_id, i FROM g QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id, i) > 1),
e AS (SELECT doc_id, i, coalesce(i > lag(i) OVER w + 100, true) AS new FROM dup WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
island AS (SELECT doc_id, min(i) AS a, max(i) + 100 AS b FROM (SELECT *, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM e) GROUP BY doc_id, k),
gap AS (SELECT doc_id, coalesce(lag(b) OVER w, 0) AS a, a AS b FROM island WINDOW w AS (PARTITION BY doc_id ORDER BY a)
  UNION ALL SELECT doc_id, coalesce(max(b), 0), any_value(n) FROM d LEFT JOIN island USING (doc_id) GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(substring(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS h FROM gap JOIN d USING (doc_id) GROUP BY doc_id),
sums AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM island GROUP BY doc_id)
SELECT d.doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(kept.h)) AS kept_sha256
FROM d LEFT JOIN sums USING (doc_id) JOIN kept USING (doc_id)
"""

ORACLE = {"op3_quality_rules": OP3, "op7_substring_dedup": OP7, "op9_decontamination": OP9,
          "op11_suffix_array_dedup": OP11, "op12_source_divergence": OP12, "op13_conversation_repair": OP13}

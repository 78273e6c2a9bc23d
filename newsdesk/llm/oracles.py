"""DuckDB SQL of the queries whose rows SQL can express."""

_WORDS = r"list_filter(string_split_regex({}, '[ \t\n\x0B\f\r]+'), lambda x: x <> '')"

# crc32 of a number's decimals, bit by bit
_CRC = """xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST({} AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
  lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"""

PREFIX_TRIE = f"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, max(i) AS len, conv_id - conv_id % 20 AS base, {_CRC.format('conv_id')} % 4 AS h FROM turns GROUP BY conv_id),
heads AS (SELECT c.*, least(c.h, coalesce(b.len, 0)) AS got FROM convs c LEFT JOIN convs b ON b.conv_id = c.base),
rebuilt AS (
  SELECT c.conv_id, t.i AS depth, t.role, t.text FROM heads c JOIN turns t ON t.conv_id = c.base AND t.i <= c.h
  UNION ALL
  SELECT c.conv_id, t.i - c.h + c.got, t.role, t.text FROM heads c JOIN turns t ON t.conv_id = c.conv_id AND t.i > c.h),
paths AS (
  SELECT c.conv_id, coalesce(list({{'role': r.role, 'text': r.text}} ORDER BY r.depth) FILTER (WHERE r.depth IS NOT NULL), []) AS path
  FROM convs c LEFT JOIN rebuilt r ON r.conv_id = c.conv_id GROUP BY c.conv_id),
members AS (SELECT conv_id, len(path) AS whole, unnest(range(len(path) + 1)) AS depth, path FROM paths),
nodes AS (
  SELECT depth, path[1:depth] AS key, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE whole = depth), '')) AS ends_sha256
  FROM members GROUP BY 1, 2),
children AS (SELECT depth - 1 AS depth, key[1:depth - 1] AS key, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1, 2),
whole AS (
  SELECT n.*, coalesce(c.n_children, 0) AS n_children,
    CASE WHEN n.depth = 0 THEN 0 ELSE (n.n_convs - 1) * len({_WORDS.format('n.key[n.depth].text')}) END AS saved
  FROM nodes n LEFT JOIN children c ON c.depth = n.depth AND c.key = n.key),
above AS (SELECT unnest(range(depth + 1)) AS upto, key, n_children, saved FROM whole),
sums AS (SELECT upto AS depth, key[1:upto] AS key, count_if(n_children = 0) AS n_leaves, sum(saved) AS saved_tokens FROM above GROUP BY 1, 2)
SELECT w.conv_id, w.depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves,
  CAST(s.saved_tokens AS BIGINT) AS saved_tokens, w.ends_sha256
FROM whole w JOIN sums s ON s.depth = w.depth AND s.key = w.key
LEFT JOIN nodes p ON w.depth > 0 AND p.depth = w.depth - 1 AND p.key = w.key[1:w.depth - 1]"""

COLLOCATIONS = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS w FROM pieces),
total AS (SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM words, (VALUES (1), (2), (3), (4)) AS t(k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 30),
own AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2),
inner_ AS (
  SELECT lang, array_to_string(w[s:s + m - 1], ' ') AS phrase, max(a) AS longer
  FROM own, (VALUES (2), (3)) AS t(m), (VALUES (1), (2), (3)) AS u(s) WHERE m < k AND s + m - 1 <= k GROUP BY ALL),
kept AS (SELECT o.* FROM own o LEFT JOIN inner_ i USING (lang, phrase) WHERE i.longer IS NULL OR 100 * i.longer < 80 * o.a),
cuts AS (
  SELECT o.lang, o.phrase, o.a, c, x.a AS l, y.a AS r, CAST(2000000 * CAST(o.a AS HUGEINT) // (x.a + y.a) AS BIGINT) AS score
  FROM kept o, (VALUES (1), (2), (3)) AS t(c), f x, f y
  WHERE c < o.k AND x.lang = o.lang AND x.phrase = array_to_string(o.w[1:c], ' ') AND y.lang = o.lang AND y.phrase = array_to_string(o.w[c + 1:], ' ')),
low AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) AS least FROM cuts),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, score
  FROM low WHERE least = 1)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000"""

SUFFIX_DEDUP = f"""
WITH d AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 18)) AS pos, unnest(list_transform(range(1, len(w) - 18), lambda i: array_to_string(w[i:i + 19], ' '))) AS said
  FROM d WHERE len(w) >= 20),
firsts AS (SELECT said, min({{'doc_id': doc_id, 'pos': pos}}) AS first FROM windows GROUP BY said),
later AS (SELECT doc_id, pos FROM windows JOIN firsts USING (said) WHERE first <> {{'doc_id': doc_id, 'pos': pos}}),
gone AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 20)) AS pos FROM later),
placed AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM d),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS text, count(*) AS n FROM placed p
  WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = p.doc_id AND g.pos = p.pos) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(k.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM d LEFT JOIN kept k USING (doc_id)"""

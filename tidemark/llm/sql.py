"""SQL twins for DuckDB of the operators that SQL can express."""

# crc32 bit by bit: DuckDB has no such function.
_CRC = """xor(list_reduce(
    list_concat([4294967295::BIGINT], list_transform(string_split({x}, ''), lambda ch: ascii(ch)::BIGINT)),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0],
                             lambda c, i: xor(c >> 1, 3988292384 * (c & 1)))), 4294967295::BIGINT)"""

PREFIX_TRIE = f"""
WITH own AS (
  SELECT conv_id, list(struct_pack(role := coalesce(role, ''), words := coalesce(text, ''))
                       ORDER BY turn NULLS FIRST) AS turns,
         {_CRC.format(x='conv_id::VARCHAR')} % 4 AS h
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
rebuilt AS (
  SELECT o.conv_id, list_concat(coalesce(b.turns[1:o.h], o.turns[1:0]), o.turns[o.h + 1:]) AS turns
  FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 20),
member AS (
  SELECT conv_id, d AS depth, turns[1:d] AS node, d = len(turns) AS ends
  FROM rebuilt, unnest(range(0, len(turns) + 1)) AS r(d)),
node AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256,
         CASE WHEN depth > 0 THEN (count(*) - 1) * len(regexp_extract_all(node[depth].words,
              '[^\\x20\\x09-\\x0D]+')) ELSE 0 END AS saved
  FROM member GROUP BY node, depth),
kids AS (
  SELECT node[1:depth - 1] AS node, depth - 1 AS depth, count(*) AS n FROM node WHERE depth > 0 GROUP BY ALL),
below AS (
  SELECT n.node[1:d] AS node, d AS depth, sum(saved) AS saved,
         count(*) FILTER (NOT EXISTS (SELECT 1 FROM kids k WHERE k.depth = n.depth AND k.node = n.node)) AS leaves
  FROM node n, unnest(range(0, n.depth + 1)) AS r(d) GROUP BY ALL)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children,
       b.leaves AS n_leaves, b.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM node n
JOIN below b ON b.depth = n.depth AND b.node = n.node
LEFT JOIN kids k ON k.depth = n.depth AND k.node = n.node
LEFT JOIN node p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.node = n.node[1:n.depth - 1]
"""

COLLOCATIONS = """
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL),
spoken AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM piece),
gram AS (
  SELECT lang, w[i:i + k - 1] AS g, k
  FROM spoken, unnest([1, 2, 3]) AS ks(k), unnest(range(1, len(w) - k + 2)) AS r(i)),
f AS (SELECT lang, g, k, count(*) AS n FROM gram GROUP BY ALL),
total AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
cut AS (
  SELECT c.lang, c.g, c.k, c.n AS a, p AS place, l.n AS l, r.n AS r,
         (1000000::HUGEINT * c.n * c.n // (l.n::HUGEINT * r.n))::BIGINT AS score
  FROM f c, unnest(range(1, c.k)) AS ps(p)
  JOIN f l ON l.lang = c.lang AND l.g = c.g[1:p]
  JOIN f r ON r.lang = c.lang AND r.g = c.g[p + 1:]
  WHERE c.k >= 2 AND c.n >= 10),
scored AS (
  SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, place) = 1),
inner_most AS (
  SELECT lang, g[i:i + 1] AS g, max(n) AS most
  FROM f, unnest([1, 2]) AS r(i) WHERE k = 3 AND n >= 10 GROUP BY ALL)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, list_aggregate(s.g, 'string_agg', ' '))
         AS rank, list_aggregate(s.g, 'string_agg', ' ') AS phrase, a, l, r, t.n, score
FROM scored s JOIN total t ON t.lang = s.lang
LEFT JOIN inner_most m ON m.lang = s.lang AND m.g = s.g
WHERE m.most IS NULL OR 100 * m.most < 50 * a
QUALIFY rank <= 2000
"""

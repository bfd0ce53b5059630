"""SQL giving the same rows, for the operators SQL can express in reasonable time."""

OP1 = r"""
WITH d AS (
  SELECT doc_id, source,
         md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS k,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
n AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS no FROM s),
w AS (SELECT *, CASE (no - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w, 3 * source_size AS lim FROM n),
r AS (SELECT *, CAST(lim AS DOUBLE) / w AS ratio FROM w),
f AS (SELECT *, ratio <=
        CAST(sum(source_size) OVER () - coalesce(sum(lim) OVER before, 0) AS DOUBLE)
        / CAST(sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS DOUBLE) AS is_full
      FROM r WINDOW before AS (ORDER BY ratio, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size,
        CASE WHEN is_full THEN CAST(lim AS DOUBLE)
             ELSE CAST(sum(source_size) OVER () - sum(CASE WHEN is_full THEN lim ELSE 0 END) OVER () AS DOUBLE)
                  / CAST(sum(w) OVER () - sum(CASE WHEN is_full THEN w ELSE 0 END) OVER () AS DOUBLE) * w END AS target
      FROM f),
b AS (SELECT *, CAST(floor(target) AS BIGINT) AS budget,
        coalesce(CAST(floor(target) AS BIGINT) // nullif(source_size, 0), 0) AS epochs FROM t),
o AS (SELECT d.doc_id, d.size, b.source_size, b.target, b.epochs, b.budget - b.epochs * b.source_size AS rest,
        coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.size
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, rest - before)) AS BIGINT) AS taken
FROM o
"""

OP5 = """
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
q AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40
      GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.*, q.key IS NOT NULL AND k.doc_id <> q.keeper AS gone FROM k LEFT JOIN q USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

# CRC-32 of the decimal number, bit by bit, for the number of turns taken from the first of a family.
OP11 = r"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS place
           FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT DISTINCT conv_id FROM t),
h AS (SELECT conv_id, xor(4294967295,
        list_reduce([CAST(4294967295 AS BIGINT)] || [CAST(ord(x) AS BIGINT) FOR x IN string_split(CAST(conv_id AS VARCHAR), '')],
          lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
            lambda x, bit: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)))) % 4 AS h FROM c),
r AS (SELECT h.conv_id, t.place, t.role, t.text FROM h JOIN t ON t.conv_id = h.conv_id AND t.place >= h.h
      UNION ALL
      SELECT h.conv_id, t.place, t.role, t.text FROM h JOIN t ON t.conv_id = h.conv_id - h.conv_id % 20 AND t.place < h.h),
k AS (SELECT conv_id, list(md5(role || chr(10) || text) ORDER BY place) AS turns,
             list(CAST(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS BIGINT) ORDER BY place) AS words
      FROM r GROUP BY conv_id),
q AS (SELECT c.conv_id, coalesce(turns, []) AS turns, coalesce(words, []) AS words FROM c LEFT JOIN k USING (conv_id)),
p AS (SELECT conv_id, len(turns) AS n, turns, words, unnest(range(0, len(turns) + 1)) AS depth FROM q),
m AS (SELECT depth, md5(array_to_string(turns[1:depth], ',')) AS key, min(conv_id) AS conv_id, count(*) AS n_convs,
             any_value(turns[1:depth]) AS turns, coalesce(any_value(words[depth]), 0) AS words,
             coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = depth), '') AS ends
      FROM p GROUP BY 1, 2),
f AS (SELECT m.*, o.conv_id AS parent_conv_id, o.key AS parent_key
      FROM m LEFT JOIN m o ON o.depth = m.depth - 1 AND o.key = md5(array_to_string(m.turns[1:m.depth - 1], ','))),
n AS (SELECT f.*, (SELECT count(*) FROM f x WHERE x.depth = f.depth + 1 AND x.parent_key = f.key) AS n_children FROM f),
a AS (SELECT n_children, (n_convs - 1) * words AS saved, turns, unnest(range(0, depth + 1)) AS above FROM n),
s AS (SELECT above AS depth, md5(array_to_string(turns[1:above], ',')) AS key,
             count(*) FILTER (n_children = 0) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens
      FROM a GROUP BY 1, 2)
SELECT n.conv_id, n.depth, n.parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens, sha256(n.ends) AS ends_sha256
FROM n JOIN s USING (depth, key)
"""

ORACLE = {"op1_mix_sources": OP1, "op5_line_dedup": OP5, "op11_prefix_trie": OP11}

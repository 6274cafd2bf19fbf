"""DuckDB SQL for the queries that SQL can express on whole tables in reasonable time."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACE_WORDS = r"[^\x20\x09-\x0D]+"
_ALNUM_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

SUBSTRING_DEDUP = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_SPACE_WORDS}') AS w FROM documents WHERE doc_id IS NOT NULL),
win AS (SELECT doc_id, unnest(range(1, len(w) - 18)) AS s, unnest([array_to_string(w[s:s + 19], ' ') FOR s IN range(1, len(w) - 18)]) AS win
        FROM d WHERE len(w) >= 20),
ranked AS (SELECT doc_id, s, row_number() OVER (PARTITION BY win ORDER BY doc_id, s) AS place FROM win),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS p FROM ranked WHERE place > 1),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, COUNT(*) AS n FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, len(w) - coalesce(kept.n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_ALNUM_WORDS}') AS w FROM documents WHERE doc_id IS NOT NULL),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all({_LOWER}, '{_ALNUM_WORDS}') AS w FROM benchmark WHERE item_id IS NOT NULL),
sized AS (SELECT item_id, w, least(len(w), 10) AS m FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, m, unnest([array_to_string(w[s:s + m - 1], ' ') FOR s IN range(1, len(w) - m + 2)]) AS win FROM sized),
ms AS (SELECT DISTINCT m FROM sized),
dw AS (SELECT doc_id, m, unnest(range(1, len(w) - m + 2)) AS s, unnest([array_to_string(w[s:s + m - 1], ' ') FOR s IN range(1, len(w) - m + 2)]) AS win
       FROM d, ms WHERE len(w) >= m),
hit AS (SELECT doc_id, item_id, s, m FROM dw JOIN bw USING (m, win)),
places AS (SELECT doc_id, COUNT(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(s, s + m)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, COUNT(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(places.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
       sha256(coalesce(items.ids, '')) AS items_sha256, coalesce(places.n, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)"""

CHAT = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
t AS (SELECT *, CASE WHEN role = 'assistant' THEN text ELSE '' END AS loss,
             length(regexp_replace(role, '[\\#<:]', '..', 'g')) + length(regexp_replace(text, '[\\#<:]', '..', 'g')) + 14 AS chars FROM c)
SELECT conv_id, COUNT(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(SUM(length(loss)) AS BIGINT) AS loss_chars, sha256(string_agg(loss, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
       CAST(SUM(chars) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id"""

NGRAM_JOIN = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_SPACE_WORDS}') AS w FROM documents WHERE doc_id IS NOT NULL),
each AS (SELECT doc_id, unnest([array_to_string(w[s:s + 4], ' ') FOR s IN range(1, greatest(len(w) - 4, 1) + 1)]) AS shingle FROM d WHERE len(w) > 0),
sh AS (SELECT DISTINCT doc_id, shingle FROM each),
n AS (SELECT doc_id, COUNT(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, COUNT(*) AS c FROM sh a JOIN sh b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
linked AS (SELECT x, y FROM pairs JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
e AS (SELECT x, y FROM linked UNION ALL SELECT y, x FROM linked),
reach AS (SELECT doc_id, doc_id AS other FROM d UNION SELECT reach.doc_id, e.y FROM reach JOIN e ON e.x = reach.other)
SELECT doc_id, coalesce(any_value(n.n), 0) AS n_shingles, MIN(other) AS component_id FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id"""

# crc32 (reflected polynomial 0xEDB88320) of the decimal digits, byte by byte and bit by bit
_CRC32 = """xor(list_reduce(list_concat([4294967295::BIGINT], [ascii(x)::BIGINT FOR x IN string_split(CAST(conv_id AS VARCHAR), '')]),
  lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], [0::BIGINT FOR x IN range(8)]),
    lambda v, z: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384::BIGINT) ELSE v // 2 END)), 4294967295::BIGINT)"""

PREFIX_TRIE = f"""
WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS i,
             sha256(length(role) || ':' || role || text) AS turn, len(regexp_extract_all(text, '{_SPACE_WORDS}')) AS words FROM r),
c AS (SELECT conv_id, {_CRC32} % 4 AS h, conv_id - conv_id % 20 AS head FROM (SELECT DISTINCT conv_id FROM r)),
built AS (SELECT c.conv_id, i, turn, words FROM c JOIN t ON t.conv_id = c.head AND i < h
          UNION ALL SELECT c.conv_id, i, turn, words FROM c JOIN t USING (conv_id) WHERE i >= h),
seq AS (SELECT c.conv_id, coalesce(s, []) AS s, coalesce(w, []) AS w
        FROM c LEFT JOIN (SELECT conv_id, list(turn ORDER BY i) AS s, list(words ORDER BY i) AS w FROM built GROUP BY conv_id) USING (conv_id)),
p AS (SELECT conv_id, s, w, unnest(range(0, len(s) + 1)) AS d FROM seq),
n AS (SELECT array_to_string(s[1:d], ',') AS node, d, MIN(conv_id) AS conv_id, COUNT(*) AS n_convs, any_value(s[1:d]) AS path,
             any_value(CASE WHEN d = 0 THEN 0 ELSE w[d] END) AS words,
             coalesce(string_agg(CASE WHEN len(s) = d THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '') AS ends
      FROM p GROUP BY 1, 2),
kids AS (SELECT array_to_string(path[1:d - 1], ',') AS node, d - 1 AS d, COUNT(*) AS n FROM n WHERE d > 0 GROUP BY 1, 2),
own AS (SELECT n.*, coalesce(kids.n, 0) AS n_children FROM n LEFT JOIN kids USING (node, d)),
up AS (SELECT unnest(range(0, d + 1)) AS d, path, n_children, (n_convs - 1) * words AS saved FROM own),
sums AS (SELECT array_to_string(path[1:d], ',') AS node, d, SUM(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, SUM(saved) AS saved
         FROM up GROUP BY 1, 2)
SELECT own.conv_id, own.d AS depth, above.conv_id AS parent_conv_id, own.n_convs, own.n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, sha256(own.ends) AS ends_sha256
FROM own JOIN sums USING (node, d) LEFT JOIN n above ON above.d = own.d - 1 AND above.node = array_to_string(own.path[1:own.d - 1], ',')"""

SQL = {
    "op2_substring_dedup": SUBSTRING_DEDUP,
    "op3_benchmark_decontamination": DECONTAMINATION,
    "op7_chat_formatting": CHAT,
    "op10_ngram_jaccard_join": NGRAM_JOIN,
    "op13_conversation_prefix_trie": PREFIX_TRIE,
}

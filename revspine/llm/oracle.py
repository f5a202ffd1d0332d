"""DuckDB SQL of the queries that SQL can express on whole tables."""

EXACT_DEDUP = r"""
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, sha256(body) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
WINDOW same AS (PARTITION BY body)
"""


#: Every word span of an item's length, for every document and item that share a shingle.
DECONTAMINATION = r"""
WITH cut AS (
    SELECT kind, id, list_filter(string_split(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+', ' ', 'g'), ' '), lambda x: x <> '') AS words
    FROM (SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark)
),
shingles AS (
    SELECT kind, id, i, array_to_string(words[i + 1 : i + 5], ' ') AS s
    FROM (SELECT kind, id, words, unnest(range(len(words) - 4)) AS i FROM cut)
),
d AS (SELECT id AS doc_id, i, s, count(*) OVER (PARTITION BY id) AS n FROM shingles WHERE kind = 'd'),
b AS (SELECT id AS item_id, s, count(*) AS c, sum(count(*)) OVER (PARTITION BY id) AS size FROM shingles WHERE kind = 'b' GROUP BY id, s),
shared AS (SELECT doc_id, item_id, i, s, c, size, n, least(size, n)::BIGINT AS span FROM d JOIN b USING (s)),
placed AS (
    SELECT doc_id, item_id, s, c, size, span, unnest(range(greatest(0, i - span + 1), least(i, n - span) + 1)) AS start_word
    FROM shared
),
common AS (
    SELECT doc_id, item_id, size, span, start_word, sum(least(here, c)) AS met
    FROM (SELECT doc_id, item_id, size, span, start_word, s, c, count(*) AS here FROM placed GROUP BY ALL) GROUP BY ALL
)
SELECT doc_id, item_id, met / (size + span - met) AS similarity, start_word, span + 4 AS n_words
FROM common WHERE met / (size + span - met) >= 0.8
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start_word) = 1
"""

#: Every window of 400 bytes as hexadecimal digits, counted; then each byte's last repeated start before it.
REPEATS = r"""
WITH coded AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
blocks AS (  -- 400 starts each, so that no window is sought far into a long text
    SELECT r, j, substr(h, 800 * j + 1, 1600) AS part, least(400, length(h) // 2 - 400 * j) AS n
    FROM (SELECT r, h, unnest(range((length(h) + 799) // 800)) AS j FROM coded)
),
each AS (
    SELECT r, 400 * j + o AS i, substr(part, 2 * o + 1, 2) AS b, CASE WHEN 2 * o + 800 <= length(part) THEN md5_number(substr(part, 2 * o + 1, 800)) END AS w
    FROM (SELECT r, j, part, unnest(range(n)) AS o FROM blocks)
),
twice AS (SELECT w FROM each WHERE w IS NOT NULL GROUP BY w HAVING count(*) > 1),
marked AS (
    SELECT r, i, b, coalesce(max(CASE WHEN twice.w IS NOT NULL THEN i END) OVER (PARTITION BY r ORDER BY i) > i - 400, FALSE) AS gone
    FROM each LEFT JOIN twice USING (w)
),
runs AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY r ORDER BY i), FALSE) AS opens FROM marked),
kept AS (
    SELECT r, count_if(gone) AS n_removed, count_if(opens) AS n_spans, string_agg(b, '' ORDER BY i) FILTER (NOT gone) AS rest
    FROM runs GROUP BY r
)
SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(rest, ''))) AS kept_sha256
FROM coded LEFT JOIN kept USING (r)
"""

#: Prefixes as strings of hashes; a node's subtree is found through the rebuilt turns of its smallest member.
PREFIX_TRIE = r"""
WITH turns AS (
    SELECT conv_id AS c, md5(coalesce(role, '')) || md5(coalesce(text, '')) AS word, strlen(coalesce(text, '')) AS size,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS n
    FROM conversations WHERE conv_id IS NOT NULL
),
convs AS (  -- the checksum, bit by bit
    SELECT c, c - c % 5 AS base, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(c::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
               lambda crc, b: list_reduce(list_concat([xor(crc, b)], range(8)), lambda x, step: xor(x >> 1, 3988292384::BIGINT * (x & 1))))) % 9 AS h
    FROM (SELECT DISTINCT c FROM turns)
),
rebuilt AS (
    SELECT convs.c, n AS place, word, size FROM convs JOIN turns ON turns.c = base WHERE n <= h
    UNION ALL
    SELECT convs.c, 9 + n, word, size FROM convs JOIN turns USING (c) WHERE n > h
),
prefixes AS (
    SELECT c, row_number() OVER own AS d, string_agg(word, '') OVER own AS name, size FROM rebuilt
    WINDOW own AS (PARTITION BY c ORDER BY place ROWS UNBOUNDED PRECEDING)
    UNION ALL
    SELECT c, 0, '', 0 FROM convs
),
members AS (SELECT *, d = max(d) OVER (PARTITION BY c) AS ends FROM prefixes),
nodes AS (
    SELECT d, name, min(c) AS conv_id, count(*) AS n_convs, max(size) AS size, substr(name, 1, 64 * (d - 1)) AS up,
           sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
    FROM members GROUP BY d, name
),
children AS (SELECT d - 1 AS d, up AS name, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
below AS (
    SELECT a.d, a.name, count(*) FILTER (n_children IS NULL) AS n_leaves, sum((u.n_convs - 1) * u.size) AS saved
    FROM nodes u LEFT JOIN children USING (d, name) JOIN members a ON a.c = u.conv_id AND a.d <= u.d GROUP BY ALL
)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN below USING (d, name) LEFT JOIN children USING (d, name) LEFT JOIN nodes p ON p.d = n.d - 1 AND p.name = n.up
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_exact_dedup": EXACT_DEDUP, "op6_decontamination": DECONTAMINATION, "op8_repeats": REPEATS, "op13_prefix_trie": PREFIX_TRIE}

"""SQL that gives what the queries of this folder give, where SQL can."""

from __future__ import annotations

EXACT_DEDUP = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept,
    sha256(text) AS text_sha256
FROM t JOIN g USING (text)
"""

CHAT = r"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
    SELECT *, len(text) + len(regexp_extract_all(text, '<\\*/?s>|\[\\*/?INST\]')) AS chars,
        len(role) + len(regexp_extract_all(role, '<\\*/?s>|\[\\*/?INST\]')) AS role_chars
    FROM t
), c AS (
    SELECT conv_id, count(*) AS n_turns,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
        coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
            FILTER (role = 'assistant'), '') AS learned,
        sum(len('<s>[INST][/INST]</s>') + role_chars + chars) AS formatted_chars
    FROM e GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, len(learned) AS loss_chars,
    sha256(learned) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM c
"""


PREFIX_TRIE = """
WITH t AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
            md5(coalesce(text, ''))) - 1 AS place
    FROM conversations WHERE conv_id IS NOT NULL
), c AS (
    SELECT conv_id, conv_id - conv_id % 5 AS base, crc32_of % 9 AS h
    FROM (SELECT DISTINCT conv_id, ({crc}) AS crc32_of FROM t)
), r AS (
    SELECT c.conv_id, t.place AS spot, role, text FROM c JOIN t ON t.conv_id = c.base WHERE t.place < h
    UNION ALL
    SELECT c.conv_id, t.place, role, text FROM c JOIN t ON t.conv_id = c.conv_id WHERE t.place >= h
), n AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY spot) AS depth,
        md5(role) || md5(text) AS digest, strlen(text) AS bytes FROM r
), w AS (
    SELECT conv_id, depth, bytes,
        md5(string_agg(digest, '') OVER (PARTITION BY conv_id ORDER BY depth)) AS prefix FROM n
    UNION ALL SELECT conv_id, 0, 0, '' FROM c
), k AS (
    SELECT depth, prefix, min(conv_id) AS node, count(*) AS n_convs, any_value(bytes) AS bytes
    FROM w GROUP BY depth, prefix
), v AS (
    SELECT w.conv_id, w.depth, k.node, lag(k.node) OVER (PARTITION BY w.conv_id ORDER BY w.depth) AS parent,
        k.n_convs, k.bytes, w.depth = max(w.depth) OVER (PARTITION BY w.conv_id) AS is_end
    FROM w JOIN k USING (depth, prefix)
), own AS (
    SELECT node, depth, parent, n_convs, (n_convs - 1) * bytes AS saved FROM v WHERE conv_id = node
), kids AS (SELECT parent AS node, depth - 1 AS depth, count(*) AS n FROM own WHERE depth > 0 GROUP BY ALL),
ended AS (
    SELECT node, depth, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends_sha256
    FROM v WHERE is_end GROUP BY node, depth
), below AS (
    SELECT a.node, a.depth, count(*) FILTER (k.n IS NULL) AS n_leaves, sum(o.saved) AS saved_tokens
    FROM own o JOIN v a ON a.conv_id = o.node AND a.depth <= o.depth
    LEFT JOIN kids k ON k.node = o.node AND k.depth = o.depth GROUP BY a.node, a.depth
)
SELECT o.node AS conv_id, CAST(o.depth AS BIGINT) AS depth, o.parent AS parent_conv_id, o.n_convs,
    CAST(coalesce(k.n, 0) AS BIGINT) AS n_children, b.n_leaves, CAST(b.saved_tokens AS BIGINT) AS saved_tokens,
    coalesce(e.ends_sha256, sha256('')) AS ends_sha256
FROM own o JOIN below b USING (node, depth) LEFT JOIN kids k USING (node, depth)
LEFT JOIN ended e USING (node, depth)
"""

#: crc32 of conv_id in decimal: bytes from the left, eight steps of the polynomial for each.
_CRC = """
SELECT xor(c, 4294967295) FROM (
    SELECT list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
        flatten(list_transform(CAST(string_split(CAST(conv_id AS VARCHAR), '') AS VARCHAR[]),
            lambda d: [CAST(ascii(d) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
        lambda x, y: CASE WHEN y >= 0 THEN xor(x, y)
            WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END) AS c)
"""

LINE_DEDUP = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM d),
k AS (
    SELECT r, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
),
often AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10),
kept AS (
    SELECT r, count(*) AS n_lines, count(o.key) AS n_dropped,
        coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (o.key IS NULL), '') AS text
    FROM k LEFT JOIN often o USING (key) GROUP BY r
)
SELECT doc_id, n_lines, n_dropped, sha256(text) AS kept_sha256 FROM d JOIN kept USING (r)
"""

HARD_NEGATIVES = """
WITH q AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
    FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
        CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
    FROM q a JOIN q b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), p AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id,
    CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
    other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""


def all_oracles() -> dict[str, str]:
    return {
        "op2_exact_dedup": EXACT_DEDUP, "op5_chat": CHAT,
        "op11_prefix_trie": PREFIX_TRIE.format(crc=_CRC), "op12_line_dedup": LINE_DEDUP,
        "op13_hard_negatives": HARD_NEGATIVES,
    }

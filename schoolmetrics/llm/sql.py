"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

from schoolmetrics.llm.common import UPPER

OP5 = f"""
WITH texts AS (
    SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}') AS body FROM documents
)
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(body) AS text_sha256
FROM texts
WINDOW same AS (PARTITION BY body)
"""


OP3 = """
WITH vectors AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
           CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
    FROM vectors q JOIN vectors c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 5
"""

# Five bits of the hexadecimal digest at a time give a base-32 digit.
OP4 = """
WITH payloads AS (
    SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), coded AS (
    SELECT page_id, payload, sha1(payload) || '0' AS hex FROM payloads
), digits AS (
    SELECT page_id, payload,
           list_transform(range(0, 32), lambda i:
               ((strpos('0123456789abcdef', hex[5 * i // 4 + 1]) - 1) * 16
                 + strpos('0123456789abcdef', hex[5 * i // 4 + 2]) - 1) // CAST(pow(2, 3 - (5 * i) % 4) AS BIGINT) % 32
           ) AS fives
    FROM coded
), named AS (
    SELECT page_id, payload,
           array_to_string(list_transform(fives, lambda d: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[d + 1]), '') AS code,
           max(page_id) OVER (PARTITION BY payload) AS response_id
    FROM digits
)
SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, code AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM response_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM response_id THEN response_id END AS refers_to
FROM named
"""

# crc32 bit by bit; a member's ancestors are its prefixes, so a node's subtree is what its members have below it.
OP12 = """
WITH given AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, turn FROM conversations WHERE conv_id IS NOT NULL
), turns AS (
    SELECT conv_id, octet_length(encode(text)) AS size, digest,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS place
    FROM (SELECT *, md5(octet_length(encode(role)) || ':' || role || text) AS digest FROM given)
), convs AS (
    SELECT conv_id, conv_id - conv_id % 5 AS base,
           xor(4294967295, list_reduce(
               list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
               lambda crc, byte: list_reduce(range(8), lambda x, i:
                   CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END, xor(crc, byte)), 4294967295)) % 9 AS h
    FROM (SELECT DISTINCT conv_id FROM given)
), rebuilt AS (
    SELECT c.conv_id, t.place, t.digest, t.size FROM convs c JOIN turns t ON t.conv_id = c.base AND t.place <= c.h
    UNION ALL
    SELECT c.conv_id, t.place, t.digest, t.size FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.place > c.h
), members AS MATERIALIZED (
    SELECT conv_id, row_number() OVER turn AS depth, string_agg(digest, '/') OVER turn AS path, size
    FROM rebuilt WINDOW turn AS (PARTITION BY conv_id ORDER BY place)
    UNION ALL
    SELECT conv_id, 0, '', 0 FROM convs
), linked AS (
    SELECT *, lag(path) OVER (PARTITION BY conv_id ORDER BY depth) AS parent,
           lead(path) OVER (PARTITION BY conv_id ORDER BY depth) IS NULL AS ends
    FROM members
), nodes AS MATERIALIZED (
    SELECT path, any_value(parent) AS parent, any_value(depth) AS depth, any_value(size) AS size, min(conv_id) AS conv_id,
           count(*) AS n_convs, sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
    FROM linked GROUP BY path
), children AS (SELECT parent AS path, count(*) AS n_children FROM nodes GROUP BY parent
), below AS (
    SELECT DISTINCT a.path, d.path AS inner_path FROM members a JOIN members d ON a.conv_id = d.conv_id AND a.depth <= d.depth
), subtrees AS (
    SELECT b.path, count(*) FILTER (c.path IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.size) AS saved_tokens
    FROM below b JOIN nodes n ON n.path = b.inner_path LEFT JOIN children c ON c.path = n.path GROUP BY b.path
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children, s.n_leaves,
       CAST(s.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN subtrees s USING (path) LEFT JOIN children c USING (path) LEFT JOIN nodes p ON p.path = n.parent
"""

# The tables' pages mark the article as such; references are decoded last, & after the others.
OP13 = r"""
WITH cut AS (
    SELECT page_id, url, string_split_regex(
        regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1), '</?(?:h1|p)>') AS pieces
    FROM pages
), plain AS (
    SELECT page_id, url, list_transform(pieces, lambda x: trim(regexp_replace(
        regexp_replace(replace(regexp_replace(replace(x, '<br>', ' '), '</?b>', '', 'g'), '&quot;', '"'), '&amp;?', '&', 'g'),
        '\s+', ' ', 'g'))) AS lines
    FROM cut
)
SELECT page_id, url, array_to_string(list_filter(lines, lambda x: x <> ''), chr(10)) AS text,
       CAST(length(array_to_string(list_filter(lines, lambda x: x <> ''), chr(10))) AS BIGINT) AS n_chars
FROM plain
"""


def _lloyd(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """OP11: every round as two tables, all parts held against the whole codebook."""
    distance = "list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - y[i]) * (x[i] - y[i])))"

    def assigned(r: int) -> str:
        return f"""assigned{r} AS MATERIALIZED (
    SELECT p, k, any_value(x) AS x, min({{'d': CAST({distance} AS BIGINT), 'e': e}}) AS best
    FROM parts JOIN book{r} USING (p) GROUP BY p, k
)"""

    def moved(r: int) -> str:
        return f"""sums{r} AS (
    SELECT p, best.e AS e, i, CAST(floor(sum(x[i]) / count(*)) AS BIGINT) AS c
    FROM assigned{r}, LATERAL (SELECT unnest(range(1, len(x) + 1)) AS i) GROUP BY p, best.e, i
), means{r} AS (SELECT p, e, list(c ORDER BY i) AS y FROM sums{r} GROUP BY p, e
), book{r + 1} AS MATERIALIZED (
    SELECT p, e, coalesce(m.y, b.y) AS y FROM book{r} b LEFT JOIN means{r} m USING (p, e)
)"""

    steps = [step(r) for r in range(rounds) for step in (assigned, moved)] + [assigned(rounds)]
    return f"""
WITH vectors AS (
    SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) AS k,
           list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), parts AS MATERIALIZED (
    SELECT p, k, list_slice(v, p * (len(v) // {parts}) + 1, (p + 1) * (len(v) // {parts})) AS x
    FROM vectors, LATERAL (SELECT unnest(range({parts})) AS p)
), book0 AS MATERIALIZED (SELECT p, k - 1 AS e, x AS y FROM parts WHERE k <= {entries}
), {", ".join(steps)}, coded AS (
    SELECT k, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error
    FROM assigned{rounds} GROUP BY k
), digest AS (
    SELECT sha256(string_agg(array_to_string(y, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds}
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN vectors USING (k), digest
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_exact_top_k": OP3, "op4_warc": OP4, "op5_exact_dedup": OP5, "op11_vector_codes": _lloyd(), "op12_prefix_trie": OP12, "op13_main_text": OP13}

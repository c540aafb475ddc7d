"""DuckDB SQL of the conversation trie: every prefix spelled out, subtrees by joining each node to all above it."""

from __future__ import annotations

from millrace.llm.merkle_sql import crc32


def trie_sql() -> str:
    return rf"""
    WITH t AS MATERIALIZED (SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS x,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS nth
        FROM conversations WHERE conv_id IS NOT NULL),
    c AS MATERIALIZED (SELECT conv_id, count(*) AS n, {crc32("conv_id::VARCHAR")} % 4 AS h, conv_id - conv_id % 20 AS head FROM t GROUP BY conv_id),
    h AS MATERIALIZED (SELECT c.*, least(c.h, coalesce(b.n, 0)) AS taken, taken + greatest(0, c.n - c.h) AS length FROM c LEFT JOIN c b ON c.head = b.conv_id),
    rebuilt AS (SELECT h.conv_id, t.nth AS d, length, r, x FROM h JOIN t ON t.conv_id = h.head WHERE t.nth <= h.taken
        UNION ALL SELECT t.conv_id, t.nth - h.h + h.taken, length, r, x FROM h JOIN t ON t.conv_id = h.conv_id WHERE t.nth > h.h),
    keyed AS (SELECT conv_id, d, length, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS w,
        sha256(string_agg(sha256(strlen(r) || ':' || r || x), '') OVER (PARTITION BY conv_id ORDER BY d)) AS k FROM rebuilt),
    p AS MATERIALIZED (SELECT conv_id, d, length, w, k, coalesce(lag(k) OVER (PARTITION BY conv_id ORDER BY d), '') AS pk FROM keyed
        UNION ALL SELECT conv_id, 0, length, 0, '', NULL FROM h),
    n AS MATERIALIZED (SELECT d, k, any_value(pk) AS pk, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(w) AS w,
        coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE d = length), '') AS ids FROM p GROUP BY d, k),
    kids AS (SELECT d - 1 AS d, pk AS k, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1, 2),
    m AS MATERIALIZED (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN kids USING (d, k)),
    sub AS (SELECT a.d, a.k, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum((n_convs - 1) * m.w) AS saved_tokens
        FROM m JOIN p a ON a.conv_id = m.conv_id AND a.d <= m.d GROUP BY a.d, a.k)
    SELECT m.conv_id, m.d AS depth, u.conv_id AS parent_conv_id, m.n_convs, m.n_children::BIGINT AS n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens, sha256(m.ids) AS ends_sha256
    FROM m JOIN sub USING (d, k) LEFT JOIN m u ON u.d = m.d - 1 AND u.k = m.pk"""

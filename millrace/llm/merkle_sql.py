"""DuckDB SQL of the Merkle manifest, its levels written out."""

from __future__ import annotations

#: Levels written out: 16^6 rows a source, 16^3 sources.
LEVELS, UPPER = 6, 3


def crc32(text: str) -> str:
    """SQL of the checksum of a short ASCII text, bit by bit."""
    step = "list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    codes = f"list_transform(string_split({text}, ''), lambda c: ord(c)::BIGINT)"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {codes}), lambda a, b: {step}), 4294967295)"


def climbed(name: str, levels: int) -> list[str]:
    """From nodes (s, pos, node) called ``name``0: runs ``name``r0.., and the nodes above."""
    out = []
    for k in range(levels):
        out.append(f"{name}r{k} AS MATERIALIZED (SELECT s, pos // 16 AS pos, max(n) AS n, list(node ORDER BY pos) AS run FROM (SELECT *, count(*) OVER (PARTITION BY s) AS n FROM {name}{k}) GROUP BY s, pos // 16)")
        out.append(f"{name}{k + 1} AS MATERIALIZED (SELECT s, pos, CASE WHEN n = 1 THEN run[1] ELSE sha256(array_to_string(run, '')) END AS node FROM {name}r{k})")
    return out


def folded(name: str, runs: str, levels: int) -> list[str]:
    """Leaves ``name``0 (.., s, p, up, proof) taken up along the runs."""
    return [
        f"""{name}{k + 1} AS MATERIALIZED (SELECT doc_id, leaf, s, p // 16 AS p, CASE WHEN n = 1 THEN up ELSE sha256(pre || up || post) END AS up,
        CASE WHEN n = 1 THEN proof ELSE proof || pre || post END AS proof
        FROM (SELECT d.*, r.n, array_to_string(r.run[1:d.p % 16], '') AS pre, array_to_string(r.run[d.p % 16 + 2:], '') AS post
        FROM {name}{k} d JOIN {runs}r{k} r ON d.s = r.s AND d.p // 16 = r.pos))"""
        for k in range(levels)
    ]


def manifest_sql() -> str:
    field = lambda c: f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"
    leaf = lambda text: "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    steps = [
        f"""leaves AS MATERIALIZED (SELECT doc_id, coalesce('=' || source, '-') AS s, {leaf("text")} AS leaf,
        CASE WHEN {crc32("doc_id::VARCHAR")} % 5 = 0 THEN {leaf(lower)} END AS tampered FROM documents)""",
        "placed AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves)",
        "c0 AS (SELECT s, pos, leaf AS node FROM placed)",
        *climbed("c", LEVELS),
        f"u0 AS MATERIALIZED (SELECT '' AS s, row_number() OVER (ORDER BY s) - 1 AS pos, node, s AS source FROM c{LEVELS})",
        *climbed("u", UPPER),
        "d0 AS (SELECT doc_id, leaf, s, pos AS p, coalesce(tampered, leaf) AS up, '' AS proof FROM placed)",
        *folded("d", "c", LEVELS),
        f"e0 AS MATERIALIZED (SELECT d.doc_id, d.leaf, u.s, u.pos AS p, d.up, d.proof FROM d{LEVELS} d JOIN u0 u ON d.s = u.source)",
        *folded("e", "u", UPPER),
    ]
    # equal (doc_id, leaf) rows come in any order there, but a row's subroot goes by its source alone
    return (
        "WITH " + ",\n".join(steps) + f"""
        SELECT e.doc_id, e.leaf, b.subroot, t.node AS root, sha256(e.proof) AS proof_sha256, e.up AS folded_root, e.up = t.node AS verified
        FROM e{UPPER} e JOIN (SELECT DISTINCT p.doc_id, p.leaf, u.node AS subroot FROM placed p JOIN u0 u ON p.s = u.source) b
        ON e.doc_id IS NOT DISTINCT FROM b.doc_id AND e.leaf = b.leaf CROSS JOIN u{UPPER} t"""
    )

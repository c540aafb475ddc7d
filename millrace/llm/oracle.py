"""DuckDB SQL that gives the rows of the queries that SQL can express."""

from __future__ import annotations

SPACES = r"\x20\x09-\x0D"
WORDS = rf"regexp_extract_all(coalesce(text, ''), '[^{SPACES}]+')"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
KEY = LOWER.format("trim({}, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")

#: Lines found in many documents go; {docs} names the table.
LINES_KEPT = f"""
    line_rows AS (SELECT *, string_split(coalesce(text, ''), chr(10)) AS all_lines FROM {{docs}}),
    line_keys AS (SELECT DISTINCT doc_id, {KEY.format("unnest(all_lines)")} AS k FROM line_rows),
    common_keys AS (SELECT k FROM line_keys WHERE k <> '' GROUP BY k HAVING count(*) >= 10),
    line_kept AS (
        SELECT line_rows.*, list_filter(all_lines, lambda x: NOT list_contains(ks, {KEY.format("x")})) AS kept_lines
        FROM line_rows, (SELECT coalesce(list(k), []) AS ks FROM common_keys))"""

OP5 = f"""
WITH {LINES_KEPT.format(docs="documents")}
SELECT doc_id, len(all_lines)::BIGINT AS n_lines, (len(all_lines) - len(kept_lines))::BIGINT AS n_dropped,
    sha256(array_to_string(kept_lines, chr(10))) AS kept_sha256
FROM line_kept
"""

#: Shingle sets, links and the smallest reachable doc_id; {docs} names the table.
NEAR = f"""
    near_words AS (SELECT doc_id, {LOWER.format("coalesce(text, '')")} AS text FROM {{docs}}),
    near_lists AS (SELECT doc_id, {WORDS} AS w FROM near_words),
    near_sets AS (
        SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
            ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) END) AS g
        FROM near_lists),
    near_sizes AS (SELECT doc_id, count(*) AS n FROM near_sets GROUP BY doc_id),
    near_links AS (
        SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM near_sets x JOIN near_sets y USING (g) WHERE x.doc_id <> y.doc_id GROUP BY ALL)
        JOIN near_sizes p ON p.doc_id = a JOIN near_sizes q ON q.doc_id = b
        WHERE 100 * c >= 75 * (p.n + q.n - c)),
    near_reach AS (SELECT a, b FROM near_links UNION SELECT r.a, l.b FROM near_reach r JOIN near_links l ON r.b = l.a),
    near_least AS (SELECT a AS doc_id, least(a, min(b)) AS component_id FROM near_reach GROUP BY a)"""

OP4 = f"""
WITH RECURSIVE {NEAR.format(docs="documents")}
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id,
    coalesce(component_id, doc_id) = doc_id AS kept
FROM documents LEFT JOIN near_sizes USING (doc_id) LEFT JOIN near_least USING (doc_id)
"""

#: Quality measures and the verdict; {docs} names the table.
QUALITY = f"""
    q_rows AS (SELECT *, row_number() OVER () AS rid, {WORDS} AS w, list_filter(string_split(coalesce(text, ''), chr(10)),
        lambda x: regexp_matches(x, '[^{SPACES}]')) AS full_lines FROM {{docs}}),
    q_windows AS (SELECT rid, unnest(range(1, len(w) - 1)) AS i, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i:i+2])) AS g FROM q_rows WHERE len(w) >= 3),
    q_twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM q_windows) WHERE c >= 2),
    q_repeat AS (SELECT rid, count(DISTINCT i + d) AS n_repeat_words FROM q_twice, (VALUES (0), (1), (2)) t(d) GROUP BY rid),
    q_counts AS (
        SELECT q_rows.*, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
            len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]'))::BIGINT AS n_symbols,
            (len(full_lines) - len(list_distinct(full_lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
        FROM q_rows LEFT JOIN q_repeat USING (rid)),
    q_base AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM q_counts),
    q_left AS (SELECT *, regexp_replace(text, '[A-Za-z\u00AA\u00BA\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F\u1E00-\u1EFF]', '', 'g') AS rest FROM q_base),
    q_letters AS (SELECT *, length(text) - length(rest) AS n_latin, length(regexp_replace(rest, '[^\\pL]', '', 'g')) AS n_other FROM q_left),
    q_all AS (
        SELECT *, NOT base_failed AND NOT (100 * n_symbols > 30 * n_words) AND word_chars BETWEEN 2 * n_words AND 15 * n_words
            AND NOT (100 * n_dup_lines > 50 * len(full_lines))
            AND NOT (100 * list_max(map_values(list_histogram(w))) > 30 * n_words) AND NOT (list_entropy(string_split(text, '')) < 2)
            AND NOT (100 * least(n_latin, n_other) > 40 * (n_latin + n_other)) AS kept
        FROM q_letters)"""

OP10 = f"""
WITH {QUALITY.format(docs="documents")}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM q_all
"""

#: Each participant's rendering of a dialogue; a row without conv_id is a dialogue of its own.
OP3 = """
WITH turns AS (
    SELECT *, CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS alone FROM (
        SELECT DISTINCT conv_id, turn, replace(coalesce(role, 'unknown'), '<|', '< |') AS role, replace(coalesce(text, ''), '<|', '< |') AS text FROM conversations)),
seen AS (
    SELECT t.*, s.role AS perspective, t.role = s.role AS own,
        CASE WHEN t.role = s.role THEN '<|assistant|>' WHEN t.role = 'system' THEN '<|system|>' ELSE '<|user name=' || t.role || '|>' END || chr(10) AS head,
        t.text || chr(10) || '<|end|>' || chr(10) AS body
    FROM turns t JOIN (SELECT DISTINCT conv_id, alone, role FROM turns WHERE role <> 'system') s
        ON t.conv_id IS NOT DISTINCT FROM s.conv_id AND t.alone IS NOT DISTINCT FROM s.alone),
placed AS (
    SELECT *, sum(length(head) + length(body)) OVER w - length(body) AS start, sum(length(head) + length(body)) OVER w AS stop
    FROM seen WINDOW w AS (PARTITION BY conv_id, alone, perspective ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING))
SELECT conv_id, perspective, count(*)::BIGINT AS n_turns, string_agg(head || body, '' ORDER BY turn NULLS FIRST, role, text) AS rendered,
    coalesce(string_agg(start || ':' || stop, ',' ORDER BY turn NULLS FIRST, role, text) FILTER (own), '') AS mask,
    coalesce(sum(length(body)) FILTER (own), 0)::BIGINT AS n_masked
FROM placed GROUP BY conv_id, alone, perspective
"""


def licence_sql() -> str:
    """The licence scan: sentences by the table of known ones, then one step for each rule."""
    from millrace.llm.licenses import ENDS, NOISE, RULES, SPDX_GAP, WRAPPED, known_sentences

    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    table = ", ".join(f"{quoted(s)}: {quoted(i)}" for s, i in known_sentences().items())
    normal = f"trim(regexp_replace(lower(s), {quoted(NOISE)}, ' ', 'g'))"
    ids = lambda ends: f"list_filter(list_transform(string_split_regex(text, {quoted(ends)}), lambda s: known[{normal}]), lambda i: i IS NOT NULL)"
    steps, last = [], "s0"
    for k, (name, sought) in enumerate(RULES, 1):
        pattern = quoted("".join(f"|{i}|" for i in sought))
        steps.append(
            f"s{k} AS (SELECT doc_id, ids, replace(rest, {pattern}, '') AS rest, CASE WHEN contains(rest, {pattern}) THEN list_append(licences, {quoted(name)}) ELSE licences END AS licences FROM {last})"
        )
        last = f"s{k}"
    return f"""
WITH table_of AS (SELECT MAP {{{table}}} AS known),
texts AS (SELECT doc_id, regexp_replace(coalesce(text, ''), {quoted(SPDX_GAP)}, '\\1', 'g') AS text FROM documents),
both_ways AS (SELECT doc_id, {ids(ENDS)} AS a, {ids(WRAPPED)} AS b FROM texts, table_of),
best AS (SELECT doc_id, CASE WHEN len(b) > len(a) THEN b ELSE a END AS ids FROM both_ways),
s0 AS (SELECT doc_id, ids, array_to_string(list_transform(ids, lambda i: '|' || i || '|'), '') AS rest, []::VARCHAR[] AS licences FROM best),
{", ".join(steps)}
SELECT doc_id, len(ids)::BIGINT AS n_sentences, array_to_string(ids, ',') AS sentence_ids,
    array_to_string(list_sort(list_distinct(licences)), ',') AS licences,
    ((length(rest) - length(replace(rest, '|', ''))) // 2)::BIGINT AS n_unmatched
FROM {last}
"""

"""Conversation trie against a plain one, with ties, nulls, nested ends and a long conversation."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest

from millrace.llm import trie, trie_sql


def expected(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    said = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c in said:
        h = zlib.crc32(str(c).encode()) % 4
        head = c - (c % 20 if c >= 0 else -(-c % 20))
        rebuilt[c] = said.get(head, [])[:h] + said[c][h:]
    members, kids = defaultdict(list), defaultdict(set)
    for c, v in rebuilt.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
            if d:
                kids[tuple(v[: d - 1])].add(tuple(v[:d]))
    leaves, saved = {}, {}
    for key in sorted(members, key=len, reverse=True):
        own_tokens = (len(members[key]) - 1) * len(key[-1][1].encode().split()) if key else 0
        leaves[key] = sum(leaves[k] for k in kids[key]) if kids[key] else 1
        saved[key] = own_tokens + sum(saved[k] for k in kids[key])
    out = []
    for key, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(rebuilt[c]) == len(key))))
        parent = min(members[key[:-1]]) if key else None
        out.append((min(m), len(key), parent, len(m), len(kids[key]), leaves[key], saved[key], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def made(seed):
    rng = random.Random(seed)
    said = [(r, t) for r in ("user", None, "assistant") for t in ("hi there", "", None, "a  b\tc", "long " * 500)]
    rows = []
    for c in [*range(90), -5, -25, 2**40, 777]:
        if rng.random() < 0.85:
            pick = said[: rng.choice([2, 4, 15])]
            rows += [(c, rng.choice([None, i, i, 1]), *rng.choice(pick)) for i in range(rng.choice([0, 1, 1, 2, 3, 5, 9]))]
    for n in range(200, 240):  # each the beginning of the next, and branches off a long one
        rows += [(n, i, "user", f"same {i}") for i in range(n - 199 + 3 * (n == 230) * 20)]
    rows += [(300 + n, i, "user", f"same {i}" if i < n else f"own {n}") for n in range(0, 30, 3) for i in range(n + 2)]
    rows += [(None, 1, "user", "nobody's")] * 3 + [(400, None, "user", "again")] * 40
    return rows


SHAPE = "conv_id long, turn long, role string, text string, depth string, path int"


@pytest.mark.parametrize("seed", [1, 2])
def test_nodes_against_a_plain_trie(spark, seed):
    rows = made(seed)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SHAPE).repartition(3)
    got = sorted((tuple(r) for r in trie.nodes(df).collect()), key=repr)
    assert got == expected(rows)


def test_sql_gives_the_same(spark):
    rows = made(3)
    conversations = spark.createDataFrame([(*r, "x", 1) for r in rows], SHAPE).toArrow()  # noqa: F841  read by the SQL
    assert sorted(duckdb.sql(trie_sql.trie_sql()).fetchall(), key=repr) == expected(rows)


def test_no_conversation(spark):
    assert trie.nodes(spark.createDataFrame([], SHAPE)).collect() == []
    assert trie.nodes(spark.createDataFrame([(None, 1, "a", "b", "c", 1)], SHAPE)).collect() == []
    only = trie.nodes(spark.createDataFrame([(5, 1, "a", "b", "c", 1)], SHAPE)).collect()
    assert sorted(map(tuple, only)) == expected([(5, 1, "a", "b")])


def test_ends_of_many_conversations_are_hashed_in_stretches(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK", 7)
    rows = [(c, i, "u", "same") for c in range(500) for i in range(5)]
    got = sorted((tuple(r) for r in trie.nodes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()), key=repr)
    assert got == expected(rows)

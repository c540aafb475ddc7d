"""Merkle manifest against a plain tree, with small blocks and odd rows."""

from __future__ import annotations

import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from millrace.llm import merkle, merkle_sql, scans
from millrace.storage import saved

H = lambda *x: hashlib.sha256("".join(x).encode()).hexdigest()
NAMES = ("doc_id", "source", "lang", "n_chars", "text")
SHAPE = "doc_id long, text string, lang string, source string, n_chars long, tree string, node int"


def leaf_of(row):
    return H(*("-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in NAMES))


def tree_of(nodes):
    """Root, and each node's siblings by level with the node's place among them."""
    found = [[] for _ in nodes]
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(at):
            run = nodes[p // 16 * 16 : p // 16 * 16 + 16]
            found[i].append((run, p % 16))
        nodes = [H(*nodes[i : i + 16]) for i in range(0, len(nodes), 16)]
        at = [p // 16 for p in at]
    return nodes[0], found


def expected(rows):
    by = {}
    for r in rows:
        by.setdefault("" if r["source"] is None else "=" + r["source"], []).append(r)
    for s in by:
        by[s].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
    order = sorted(by, key=str.encode)
    each = {s: tree_of([leaf_of(r) for r in by[s]]) for s in order}
    if not order:
        return []
    root, upper = tree_of([each[s][0] for s in order])
    out = []
    for s, above in zip(order, upper, strict=True):
        for r, path in zip(by[s], each[s][1], strict=True):
            levels, own = path + above, leaf_of(r)
            up = own
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and r["text"] is not None:
                up = leaf_of({**r, "text": r["text"].translate({c: c + 32 for c in range(65, 91)})})
            for run, p in levels:
                up = H(*run[:p], up, *run[p + 1 :])
            proof = H(*(x for run, p in levels for i, x in enumerate(run) if i != p))
            out.append((r["doc_id"], own, each[s][0], root, proof, up, up == root))
    return sorted(out, key=repr)


def made(n, seed=1):
    rng = random.Random(seed)
    sources = [None, "", "a", "Ä", "é", "z", "=", "-"]
    rows = [
        (rng.choice([None, i, i, i]), rng.choice([None, "", "Some Text", "lower", f"Text {i} ÄÖ", "X" * 3000]), rng.choice(["en", None]), rng.choice(sources + ["hot"] * 6), rng.choice([None, i]), "t", 3)
        for i in range(n)
    ]
    return rows + rows[:9] * 3


def frame(spark, rows):
    return spark.createDataFrame(rows, SHAPE).repartition(3)


def dicts(rows):
    return [dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r, strict=False)) for r in rows]


@pytest.mark.parametrize(("n", "levels"), [(0, 3), (1, 3), (900, 1), (700, 2), (17, 3)])
def test_report_against_a_plain_tree(spark, n, levels):
    rows = made(n) if n > 1 else [(7, "A b", None, None, 4, "t", 3)] * n
    got = sorted((tuple(r) for r in merkle.report(frame(spark, rows), levels=levels).collect()), key=repr)
    assert got == expected(dicts(rows))


def test_one_source_each(spark):
    rows = [(i, "Text", "en", f"s{i}", 4, "t", 3) for i in range(300)]
    got = sorted((tuple(r) for r in merkle.report(frame(spark, rows), levels=1).collect()), key=repr)
    assert got == expected(dicts(rows))


def test_sql_gives_the_same(spark):
    rows = [r for r in made(400, 3) if r[0] is not None]
    documents = frame(spark, rows).toPandas()  # noqa: F841  read by the SQL
    documents["doc_id"] = documents["doc_id"].astype("int64")
    documents["n_chars"] = documents["n_chars"].astype("Int64")
    got = sorted(duckdb.sql(merkle_sql.manifest_sql()).fetchall(), key=repr)
    assert got == expected(dicts(rows))


def test_paths_fold_to_the_root(spark):
    rows = merkle.authenticated(frame(spark, made(300)), levels=1).collect()
    assert {merkle.folded(r["leaf"], [tuple(p) for p in r["path"]]) for r in rows} == {rows[0]["root"]}


def test_traversal_holds_bounded_runs():
    for n in (1, 15, 16, 17, 255, 256, 257, 1000, 4095, 4096):
        nodes = [H(str(i)) for i in range(n)]
        root, plain = tree_of(nodes)
        found = list(merkle.traversed(nodes, merkle.depth(n)))
        assert [[("".join(r[:p]), "".join(r[p + 1 :])) for r, p in levels] for levels in plain] == found
        assert merkle.top(nodes, merkle.depth(n)) == root


def test_running_totals(spark):
    rng = random.Random(8)
    rows = [("hot" if rng.random() < 0.5 else f"g{rng.randint(0, 30)}", rng.randint(0, 9), rng.randint(-5, 99), rng.choice([None, rng.randint(0, 9)])) for _ in range(3000)]
    df = saved(spark.createDataFrame(rows, "g string, o int, v long, w int"), "scan-test")
    laid = scans.laid_out(df, ["g"], ["o", "v", "w"], "scan-laid")
    totals = {"s": ("sum", F.col("v")), "x": ("xor", F.col("v")), "l": ("last", F.col("w"))}
    for backwards in (False, True):
        for before in (False, True):
            got = sorted(scans.running(laid, ["g"], totals, backwards, before).collect(), key=lambda r: r[scans.ROW], reverse=backwards)
            assert len(got) == len(rows)
            held = {}
            for r in got:
                s, x, last = held.get(r["g"], (0, 0, None))
                after = (s + r["v"], x ^ r["v"], last if r["w"] is None else r["w"])
                assert (r["s"], r["x"], r["l"]) == ((s, x, last) if before else after)
                held[r["g"]] = after

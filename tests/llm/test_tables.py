"""Operators over whole tables: against brute force, and in odd cases."""

from __future__ import annotations

import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import ann, components, minhash, mixing, toxicity


def near(texts):
    """Shingle sets and components by comparing all pairs."""
    sets = {}
    for i, t in texts.items():
        w = (t or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    least = {i: i for i in texts}
    root = lambda i: i if least[i] == i else root(least[i])
    for a in texts:
        for b in texts:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                least[y] = x
    return {i: (i, len(sets[i]), root(i), root(i) == i) for i in texts}


def changed(rng, words, share):
    return [w if rng.random() > share else f"n{rng.randint(0, 10**6)}" for w in words]


@pytest.fixture(scope="module")
def documents():
    rng = random.Random(4)
    texts: dict[int, str | None] = {1: None, 2: "", 3: " \n", 4: "two words", 5: "TWO  words", 6: "x " * 4000}
    for group in range(12):
        base = [f"w{rng.randint(0, 5000)}" for _ in range(rng.choice([8, 40, 200]))]
        for copy in range(rng.choice([2, 3, 14])):
            texts[len(texts) + 1] = " ".join(changed(rng, base, rng.choice([0, 0.01, 0.03, 0.05, 0.2])))
    passage = [f"p{k}" for k in range(60)]
    for k in range(30):  # many documents share a passage and little else
        texts[len(texts) + 1] = " ".join([f"q{k}_{i}" for i in range(15)] + passage + [f"r{k}_{i}" for i in range(15)])
    base = [f"h{k}" for k in range(120)]
    for k in range(60):  # a large group whose members are not all alike
        texts[len(texts) + 1] = " ".join(changed(rng, base, 0.02))
    return texts


@pytest.mark.parametrize(("rounds", "chunk"), [(0, 3), (6, 256)])
def test_minhash_against_all_pairs(spark, documents, monkeypatch, rounds, chunk):
    """With and without contraction before the last comparison, its classes in many chunks or in one."""
    monkeypatch.setattr(minhash, "ROUNDS", rounds)
    monkeypatch.setattr(minhash, "CHUNK", chunk)
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in documents.items()], "doc_id bigint, text string, node string, n_shingles int")
    got = {r["doc_id"]: tuple(r) for r in minhash.near_duplicates(df.repartition(3)).collect()}
    assert got == near(documents)


def test_minhash_moves_bitmaps_without_their_sets(spark, documents, monkeypatch):
    plans, save = {}, minhash.saved
    monkeypatch.setattr(minhash, "ROUNDS", 0)
    monkeypatch.setattr(minhash, "saved", lambda df, label: plans.update({label: df._jdf.queryExecution().executedPlan().toString()}) or save(df, label))
    minhash.near_duplicates(spark.createDataFrame(list(documents.items()), "doc_id bigint, text string")).count()
    assert "bits" in plans["minhash-flagged"]
    assert "shingles" not in plans["minhash-flagged"]


def test_minhash_odd_rows(spark):
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(7, text), (7, text), (3, text), (9, "entirely different words stand here now"), (9, text), (None, text), (11, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted((tuple(r) for r in minhash.near_duplicates(df).collect()), key=repr)
    want = [(7, 26, 3, False), (7, 26, 3, False), (3, 26, 3, True), (9, 2, 3, False), (9, 26, 3, False), (None, 26, None, True), (11, 0, 11, True)]
    assert got == sorted(want, key=repr)
    assert sorted(r["doc_id"] or 0 for r in minhash.keep_one(df).collect()) == [0, 3, 11]
    assert minhash.near_duplicates(df.limit(0)).collect() == []


def test_signature_is_circulant():
    s = minhash.shingles("one two three four five six seven eight nine ten")
    places = minhash.permuted((s ^ (s >> np.uint64(32))).astype(np.uint32), 0x5BD1E995)
    for k in (0, 1, 77):
        shifted = (places.astype(np.uint64) + np.uint64(k)) % np.uint64(1 << 32)
        assert minhash.signature(s)[k] == minhash.permuted(shifted.astype(np.uint32), 0x1B873593).min()
    one = np.arange(1 << 16, dtype=np.uint32)
    assert len(np.unique(minhash.permuted(one.copy(), 5))) == len(one)
    rng = np.random.default_rng(0)
    x = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    agree = (minhash.signature(np.unique(x[:2000])) == minhash.signature(np.unique(x[500:2500]))).mean()
    assert abs(agree - 0.6) < 0.15


def test_components(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (5, 5)], "a bigint, b bigint")
    got = {r["node"]: r["label"] for r in components.components(chain).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}
    assert components.components(chain.limit(0)).collect() == []


def test_targets():
    assert mixing.targets([100, 100, 100], [1, 2, 3]) == [50, 100, 150]
    got = mixing.targets([1000, 10, 0], [1, 2, 3])
    assert got[1] == 30 and got[2] == 0 and got[0] == pytest.approx(980)
    assert mixing.targets([], []) == []


def test_permutations_and_draws():
    for n in (1, 2, 7, 64, 1000):
        got = mixing.permuted(np.arange(n), np.full(n, n), np.full(n, 9, np.uint64))
        assert sorted(got) == list(range(n))
    counts = mixing.drawn([100, 5, 0, 300], 8, 1)
    assert counts.sum(axis=0).tolist() == [100, 5, 0, 300] and set(counts.sum(axis=1)) <= {50, 51}


def test_mixing(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_WORDS", 8)
    monkeypatch.setattr(mixing, "CHUNK_ROWS", 16)
    monkeypatch.setattr(mixing, "SHARD_SLOTS", 48)
    rng = random.Random(6)
    rows = [(i if i % 19 else None, None if i == 4 else " ".join(f"d{i}_{k}" for k in range(rng.randint(0, 60))), rng.choice(["b", "a", "z", "é", None]), 1) for i in range(200)]
    rows += [rows[50], rows[50]]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, mix_row int")
    got = [tuple(r) for r in mixing.taken(df).collect()]
    again = [tuple(r) for r in mixing.taken(df.repartition(5)).collect()]
    assert sorted(got, key=repr) == sorted(again, key=repr) and len(got) == len(rows)
    sizes = defaultdict(int)
    for _, t, s, _ in rows:
        sizes[s] += len((t or "").split())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    goal = dict(zip(order, mixing.targets([sizes[s] for s in order], [i % 3 + 1 for i in range(len(order))]), strict=True))
    assert {(r[2], round(r[3], 6)) for r in got} == {(sizes[s], round(goal[s], 6)) for s in order}
    took = defaultdict(int)
    for _, size, source_size, _, taken, _ in got:
        assert 0 <= taken <= 3 * size
        took[source_size] += taken
    assert all(abs(took[sizes[s]] - goal[s]) <= 12 for s in order)
    mixed = mixing.mixture(df)
    assert mixed.columns == df.columns
    words = defaultdict(int)
    for r in mixed.collect():
        words[r["doc_id"]] += len(r["text"].split())
        assert all(w.startswith("d") for w in r["text"].split())
    by_doc = defaultdict(int)
    for d, *_, taken, _ in got:
        by_doc[d] += taken
    assert {d: n for d, n in by_doc.items() if n} == dict(words)
    assert mixing.taken(df.limit(0)).collect() == [] and mixing.mixture(df.limit(0)).collect() == []


def mix_by_hand(rows, order, goal):
    """taken and first shard of every row, and the shards, slot by slot from the seed."""
    import xxhash

    def place_of(index, n, key):
        half = max(1, math.ceil(math.log2(max(2, n)) / 2))
        mask, whole = (1 << half) - 1, (1 << 64) - 1
        while True:
            high, low = index >> half, index & mask
            for turn in range(4):
                x = ((low + key + turn) & whole) * 0x9E3779B97F4A7C15 & whole
                x = (x ^ (x >> 31)) * 0xBF58476D1CE4E5B9 & whole
                high, low = low, high ^ ((x ^ (x >> 29)) & mask)
            index = high << half | low
            if index < n:
                return index

    n_chunks = max(1, len(rows) // mixing.CHUNK_ROWS)
    streams = {s: [] for s in order}
    for at, (d, t, s, _) in enumerate(rows):
        h = xxhash.xxh3_64_intdigest((t or "").encode()) >> 1
        chunk = (xxhash.xxh3_64_intdigest(f"{d} {h}".encode(), mixing.SEED) >> 1) % n_chunks
        streams[s].append((chunk, d is not None, d or 0, len((t or "").split()), h, at))
    words = {s: [(w, at) for *_, at in sorted(own) for w in (rows[at][1] or "").split()] for s, own in streams.items()}
    n_blocks = {s: -(-len(w) // mixing.BLOCK_WORDS) for s, w in words.items()}
    slots = [min(3 * n_blocks[s], round(goal[s] * n_blocks[s] / len(words[s]))) if words[s] else 0 for s in order]
    counts = mixing.drawn(slots, -(-sum(slots) // mixing.SHARD_SLOTS), mixing.SEED)
    taken, first, shards, used = defaultdict(int), {}, [], [0] * len(order)
    for k, row in enumerate(counts):
        for i, s in enumerate(order):
            for _ in range(row[i]):
                turn, place = divmod(used[i], n_blocks[s])
                used[i] += 1
                key = ((i + 1) * 0xD1342543DE82EF95 + mixing.SEED) % (1 << 64)
                block = place_of(place, n_blocks[s], key)
                held = words[s][block * mixing.BLOCK_WORDS : (block + 1) * mixing.BLOCK_WORDS]
                for _, at in held:
                    taken[at] += 1
                    first.setdefault(at, k)
                shards.append((k, s, block, turn, len(held), " ".join(w for w, _ in held)))
    return [(rows[at][0], len((rows[at][1] or "").split()), taken[at], first.get(at)) for at in range(len(rows))], shards


def test_mixing_by_hand(spark, monkeypatch):
    """Draws, permutations and blocks recomputed from the seed, without Spark."""
    monkeypatch.setattr(mixing, "BLOCK_WORDS", 8)
    monkeypatch.setattr(mixing, "CHUNK_ROWS", 16)
    monkeypatch.setattr(mixing, "SHARD_SLOTS", 40)
    rng = random.Random(16)
    rows = [(i if i % 19 else None, None if i == 4 else " ".join(f"d{i}_{k}" for k in range(rng.randint(0, 60))), rng.choice(["b", "b", "b", "z", None]), 1) for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, place int").repartition(3)
    sizes = defaultdict(int)
    for _, t, s, _ in rows:
        sizes[s] += len((t or "").split())
    order = ["b", "z", None]
    goal = dict(zip(order, mixing.targets([sizes[s] for s in order], [1, 2, 3]), strict=True))
    docs, shards = mix_by_hand(rows, order, goal)
    got = mixing.taken(df).select("doc_id", "size", "taken", "first_shard").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(docs, key=repr)
    slots = mixing.packed(df).collect()
    assert sorted(((r["shard"], r["source"], r["block"], r["turn"], r["n_words"], r["words"]) for r in slots), key=repr) == sorted(shards, key=repr)
    places = defaultdict(list)
    for r in slots:
        places[r["shard"]].append(r["place"])
    assert len(places) > 3 and all(sorted(p) == list(range(len(p))) for p in places.values())
    mixed = [[r["source"] for r in sorted(slots, key=lambda r: r["place"]) if r["shard"] == k] for k in places]
    assert any(m != sorted(m, key=order.index) for m in mixed)
    assert mixing.packed(df.limit(0)).collect() == []


def test_cut_words_keeps_what_lies_between():
    text = " a  b\nc d e "
    assert mixing.cut_words(text, [{"first": 0, "words": 3}, {"first": 3, "words": 2}]) == text
    assert mixing.cut_words(text, [{"first": 1, "words": 2}, {"first": 4, "words": 1}]) == "b\nc\ne "


def nearest(rows, k):
    fine = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, v in fine:
        if q % 50 == 0:
            scores = sorted((-round(float((v * w).sum() / np.sqrt((v * v).sum() * (w * w).sum())), 12), i) for i, w in fine if i != q)
            out[q] = [i for _, i in scores[:k]]
    return out


def test_neighbours(spark, monkeypatch):
    monkeypatch.setattr(ann, "LIST_ROWS", 40)
    monkeypatch.setattr(ann, "BLOCK", 64)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(8, 12))
    rows = [(i, [float(np.float32(x)) for x in centres[i % 8] + 0.3 * rng.normal(size=12)]) for i in range(1200)]
    rows[100] = (100, [0.0] * 12)
    rows[150], rows[151], rows[200] = (150, None), (151, [None] + [1.0] * 11), (200, [float("nan")] + [1.0] * 11)
    same = rows[300][1]
    rows += [(i, same) for i in range(2000, 2400)] + [(None, same), rows[5], rows[5], (5000, [1.0, 2.0])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id bigint, embedding array<float>, list int")
    got = ann.search(df, df.where("vec_id % 50 = 0")).orderBy("query_id", "rank").collect()
    want = nearest([r for r in rows if r[0] != 5000], 5)
    found = defaultdict(list)
    for r in got:
        found[r["query_id"]].append(r["vec_id"])
        assert r["rank"] == len(found[r["query_id"]])
    assert set(found) == set(want)
    hits = sum(len(set(found[q]) & set(want[q])) for q in want)
    assert hits / sum(len(v) for v in want.values()) >= 0.9
    assert found[2000] == [300, 2001, 2002, 2003, 2004]
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])], "vec_id bigint, embedding array<double>")
    assert [r["vec_id"] for r in ann.search(few, few.where("vec_id = 0")).orderBy("rank").collect()] == [2, 1]
    assert ann.search(few.limit(0), few.limit(0)).collect() == []


def test_neighbours_that_tie_and_odd_sizes(spark):
    """Rescaled copies tie: the smaller ids win. Very large and very small components count like others."""
    rows = [(1000 - k, [2.0**k, 2.0 ** (k + 1)]) for k in range(40)] + [(50, [3.0, 6.0]), (7, [2.0**700, -(2.0**700)]), (8, [2.0**-700, -(2.0**-700)]), (100, [5.0, -5.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = ann.search(df, df.where("vec_id in (50, 100)")).orderBy("query_id", "rank").collect()
    assert [r["vec_id"] for r in got if r["query_id"] == 50] == [961, 962, 963, 964, 965]
    assert [(r["vec_id"], round(r["score"], 12)) for r in got if r["query_id"] == 100][:2] == [(7, 1.0), (8, 1.0)]
    assert len(got) == 10 and all(np.isfinite(r["score"]) for r in got)
    far = np.array([[1e200, 1e-200], [3e-300, 4e-300], [3.0, 4.0]])
    assert ann.cosines(far, far).tolist() == pytest.approx([1.0] * 3) and ann.cosines(far[1:2], far[2:]).tolist() == pytest.approx([1.0])


def test_queries_with_small_lists_read_on(spark, monkeypatch):
    monkeypatch.setattr(ann, "LIST_ROWS", 8)
    monkeypatch.setattr(ann, "calibrated", lambda *a: (1.0, 1))
    rng = np.random.default_rng(5)
    rows = [(i, (10 * np.eye(6)[i % 6] + 0.01 * rng.normal(size=6)).tolist()) for i in range(60)] + [(100, [-1.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = ann.search(df, df.where("vec_id = 100")).orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == nearest([(i, v) for i, v in rows], 5)[100]


def test_graph_finds_nearest_centroids():
    rng = np.random.default_rng(1)
    points = ann.unit(rng.normal(size=(400, 16)))
    graph = ann.Graph(points)
    queries = ann.unit(rng.normal(size=(50, 16)))
    ids, _ = graph.search(queries, 24)
    assert (ids[:, 0] == (queries @ points.T).argmax(axis=1)).mean() > 0.95


def test_toxicity(spark):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(600):
        toxic = i % 4 == 0
        words = [f"word{rng.randint(0, 300)}" for _ in range(30)] + (["dreadful"] if toxic else [])
        if rng.random() < (0.7 if toxic else 0.05):
            words.append("women")  # a spurious sign, which the penalty takes away
        rows.append((i, " ".join(rng.sample(words, len(words))), 1))
        labels.append((i, 1, int(toxic)))
    rows += [(700, None, 1), (701, "", 1), (None, "dreadful", 1), (5, rows[5][1], 1)]
    labels += [(9999, 1, 1), (702, 1, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    marked = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = toxicity.scored(docs, marked).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    truth = {i: t for i, _, t in labels}
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert held and sum(r["predicted"] == truth[r["doc_id"]] for r in held) / len(held) > 0.97
    model = toxicity.trained(docs, marked)
    gap = abs(model.score("the women came") - model.score("the men came"))
    monkey = toxicity.COUNTERFACTUAL
    toxicity.COUNTERFACTUAL = 0.0
    free = toxicity.trained(docs, marked)
    toxicity.COUNTERFACTUAL = monkey
    assert gap < 0.5 * abs(free.score("the women came") - free.score("the men came")) and model.score("some women came") < 0.5
    nobody = toxicity.scored(docs, marked.limit(0)).select(F.countDistinct("score"), F.max("predicted")).first()
    assert tuple(nobody) == (1, 0) and toxicity.scored(docs.limit(0), marked).collect() == []


def test_counterfactuals_act_on_the_corpus(spark):
    """Texts without any of the given terms bring neutral terms of their own, and swapping them changes scores less."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    held = toxicity.trained(docs, labels)
    free = toxicity.trained(docs, labels, penalty=0.0)
    assert held.n_pairs == free.n_pairs > 0 and held.swap == free.swap
    assert not {t for terms in toxicity.IDENTITIES for t in terms} & {w for r in docs.select("text").collect() for w in toxicity.words_of(r[0] or "")}
    rows = docs.join(labels.where("toxic = 0"), "doc_id").where("crc32(cast(doc_id as string)) % 5 = 0").select("text").collect()
    pairs = [(t, " ".join(other)) for (t,) in rows if (other := toxicity.swapped(toxicity.words_of(t or ""), held.swap))]
    change = lambda m: sum(abs(m.score(a) - m.score(b)) for a, b in pairs)
    wrong = lambda m: sum(m.score(a) >= 0.5 for a, _ in pairs)
    assert pairs and change(held) < 0.5 * change(free) and wrong(held) <= wrong(free)


def test_swaps_and_pairs_of_neutral_terms(spark):
    assert toxicity.swaps([("a", "b", "c"), ("c", "d"), ("e", "e")]) == {"a": "b", "b": "c", "c": "a"}
    rows = [(i % 2, i, ["east", "west"] if i % 4 < 2 else ["north", "south"]) for i in range(40)] + [(1, 50 + i, ["vile"]) for i in range(5)]
    df = spark.createDataFrame(rows, "toxic int, place bigint, words array<string>")
    limits, toxicity.TERM_SHARE = toxicity.TERM_SHARE, (0.0, 1.0)
    try:
        assert sorted(toxicity.neutral_terms(df)) == [("east", "west"), ("north", "south")] and toxicity.neutral_terms(df.where("toxic = 1")) == []
    finally:
        toxicity.TERM_SHARE = limits


def test_pipeline_stages(spark, tmp_path):
    """Each stage on its own input: what it keeps and what it changes."""
    import corpus_pipeline
    from millrace.llm import bpe, quality, tokenizer_files

    rng = random.Random(9)
    rows = []
    for i in range(60):
        lines = [" ".join(f"w{rng.randint(0, 4000)}" for _ in range(25)) for _ in range(4)]
        rows.append((i, "\n".join([*lines, "the same footer on every page"]), "en", f"s{i % 3}", 0))
    rows += [(100 + i, rows[i][1] + " tail", "en", "s0", 0) for i in range(10)] + [(200, None, None, None, None), (201, "few words", "en", "s1", 9)]
    shape = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    docs = spark.createDataFrame(rows, shape)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "near dedup", "mixing", "bpe"]
    (_, good), (_, lines_), (_, one), (_, mix), (_, tok) = corpus_pipeline.STAGES
    a = good(spark, docs, "")
    kept = {r["doc_id"]: r["text"] for r in a.collect()}
    assert set(kept) == {r[0] for r in rows if r[1] and quality.rejected_by(r[1], quality.RULES) is None} and 201 not in kept
    b = lines_(spark, a, "")
    clean = {r["doc_id"]: r["text"] for r in b.collect()}
    assert clean[20] == kept[20].removesuffix("\nthe same footer on every page") and all(r["n_chars"] == len(r["text"]) for r in b.collect())
    c = one(spark, b, "")
    alone = {r["doc_id"] for r in c.collect()}
    assert alone == {i for i, (_, _, _, own) in near(clean).items() if own}
    d = mix(spark, c, "")
    assert a.columns == b.columns == c.columns == d.columns == docs.columns
    e = tok(spark, d, "").collect()
    model = bpe.ByteBpe(tokenizer_files.path())
    texts = [(r["doc_id"], len(model.encode(r["text"]))) for r in d.collect()]
    assert sorted((r["doc_id"], r["n_tokens"]) for r in e) == sorted(texts) and {i for i, _ in texts} <= alone
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect()), key=repr) == sorted(map(tuple, e), key=repr)


def plain_search(rows, asked, k=5):
    """All pairs of one length; (vec_id, vector) once."""
    found = {(i, tuple(v)) for i, v in rows}
    out = []
    for a, v in sorted(found):
        if a in asked:
            best = {}
            for x, w in found:
                if x != a and len(w) == len(v):
                    best[x] = max(best.get(x, -2), float(ann.cosines(np.array([v]), np.array([w]))[0]))
            out.append((a, best))
    merged = defaultdict(dict)
    for a, best in out:
        for x, s in best.items():
            merged[a][x] = max(merged[a].get(x, -2), s)
    return {a: [x for _, x in sorted((-round(s, 9), x) for x, s in best.items())[:k]] for a, best in merged.items()}


@pytest.mark.parametrize("case", ["one", "equal", "two", "lengths", "none"])
def test_search_of_odd_tables(spark, case):
    rng = np.random.default_rng(4)
    rows = {
        "one": [(50, [1.0, 2.0])],
        "equal": [(i, [3.0, 1.0]) for i in range(60)],
        "two": [(0, [1.0, 0.0]), (1, [0.0, 1.0])],
        "lengths": [(i, rng.normal(size=2 + i % 3).round(3).tolist()) for i in range(90)] + [(0, [1.0] * 7)],
        "none": [(0, [0.0, 0.0]), (50, [float("nan"), 1.0])],
    }[case]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = defaultdict(list)
    for r in ann.search(df, df.where("vec_id % 50 = 0")).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append(r["vec_id"])
        assert r["rank"] == len(got[r["query_id"]])
    assert got == plain_search(rows if case != "none" else [], {i for i, _ in rows if i % 50 == 0})


def test_search_over_many_blocks_and_short_lists(spark, monkeypatch):
    """Small blocks, a list with most vectors, and queries whose own lists hold too few: every pair that should meet does."""
    for name, value in {"BLOCK": 16, "LIST_ROWS": 8, "DIRECT": 20}.items():
        monkeypatch.setattr(ann, name, value)
    rng = np.random.default_rng(9)
    heap = ann.unit(rng.normal(size=(1, 8)) + 0.01 * rng.normal(size=(300, 8)))
    far = ann.unit(rng.normal(size=(100, 8)))
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([heap, far]))] + [(1000 + i, rng.normal(size=5).tolist()) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    asked = {i for i, _ in rows if i % 20 == 0}
    got = defaultdict(list)
    for r in ann.search(df, df.where("vec_id % 20 = 0")).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append(r["vec_id"])
    want = plain_search(rows, asked)
    assert got.keys() == want.keys() and all(len(v) == 5 for v in got.values())
    assert np.mean([len(set(got[a]) & set(want[a])) / 5 for a in want]) >= 0.9


def test_toxicity_gradient_against_differences():
    """The gradient of loss, ridge and penalty, recomputed by finite differences; the loss, recomputed row by row."""
    import pyarrow as pa

    rng = np.random.default_rng(6)
    chosen, n = np.arange(0, 40, 2), 25
    lists = lambda least: pa.array([sorted(rng.choice(40, rng.integers(least, 9), replace=False).tolist()) for _ in range(n)], pa.list_(pa.int32()))
    plain, plus = lists(0), lists(0)
    minus = pa.array([x if i % 4 else None for i, x in enumerate(lists(0).to_pylist())], pa.list_(pa.int32()))
    plus = pa.array([x if i % 4 else None for i, x in enumerate(plus.to_pylist())], pa.list_(pa.int32()))
    labels = rng.integers(0, 2, n)
    objective = toxicity.Objective(labels, plain, plus, minus, chosen, 1.5)
    w, b = rng.normal(size=len(chosen)), 0.3
    loss, gradient = objective.at(w, b)
    weight = dict(zip(chosen.tolist(), w, strict=True))
    total = lambda features: sum(weight.get(f, 0.0) for f in features)
    scores = [1 / (1 + math.exp(-b - total(x))) for x in plain.to_pylist()]
    own = -sum(math.log(p if y else 1 - p) for p, y in zip(scores, labels, strict=True)) / n + toxicity.RIDGE / 2 * float((w * w).sum())
    changes = [total(x) - total(y) for x, y in zip(plus.to_pylist(), minus.to_pylist(), strict=True) if x is not None]
    assert objective.n_pairs == len(changes) and loss == pytest.approx(own + 1.5 * sum(d * d for d in changes) / len(changes))
    for k in range(len(chosen) + 1):
        step = np.zeros(len(chosen) + 1)
        step[k] = 1e-6
        up, down = (objective.at(w + s * step[:-1], b + s * step[-1])[0] for s in (1, -1))
        assert gradient[k] == pytest.approx((up - down) / 2e-6, abs=1e-6)


def test_neutral_mentions_of_terms_that_the_corpus_lacks(spark):
    """Toxic words begin like an identity term: without the penalty neutral mentions of it are false positives, with it none."""
    rng = random.Random(12)
    rows, labels = [], []
    for i in range(900):
        words = [f"word{rng.randint(0, 300)}" for _ in range(20)]
        if i % 3 == 0:
            words += rng.sample(["muslimzz", "muslimqq", "muslimvv"], 2)
        rows.append((i, " ".join(rng.sample(words, len(words)))))
        labels.append((i, 1, int(i % 3 == 0)))
    docs, marked = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    held, free = toxicity.trained(docs, marked), toxicity.trained(docs, marked, penalty=0.0)
    clean = [t for i, t in rows if i % 3]
    wrong = lambda model, term: sum(model.score(f"{t} {term}") >= 0.5 for t in clean) / len(clean)
    assert wrong(free, "muslim") > 0.5 and wrong(held, "muslim") < 0.05 and wrong(held, "christian") < 0.05
    toxic = [t for i, t in rows if not i % 3]
    assert sum(held.score(t) >= 0.5 for t in toxic) / len(toxic) > 0.95
    assert held.n_pairs == free.n_pairs == sum(1 for i in range(900) if zlib.crc32(str(i).encode()) % 5)


def test_mixing_deals_texts_once_to_place_them(spark):
    """Rows are joined with their chunks and numbered by one exchange."""
    docs = spark.createDataFrame([(1, "a b", "x"), (2, "c", None)], "doc_id bigint, text string, source string")
    own = mixing.sized(docs, "doc_id", "text").withColumn("mix_chunk", F.lit(0))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = mixing.placed(own, own.drop("text"), "doc_id", "source", mixing.Plan([("x", 2), (None, 1)]))
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") <= 4, plan
    assert sorted((r["doc_id"], r["mix_index"], r["mix_row"], r["mix_start"]) for r in found.collect()) == [(1, 0, 1, 0), (2, 1, 1, 0)]

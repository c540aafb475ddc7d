"""Packing: every id in exactly one piece, little padding, the library's ids, odd rows."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from millrace.llm import packing, tokenizer_files

PATH = tokenizer_files.path("word_bpe_49k.json")
ODD = [None, "", " ", "\n\t ", "plain words here", "Ünïcode İstanbul ΣΑΣ́ é", "<|endoftext|> in<|startoftext|>side", "a\x1cb\x85c d e", "don't I'LL 1234", "naïvë ̈x", "日本語 テキスト 😀👍🏽"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids + [1]


def test_words_give_the_librarys_ids(library, monkeypatch):
    monkeypatch.setattr(packing, "STRETCH", 7)
    own = packing.Words(PATH)
    rng = random.Random(3)
    made = ["".join(rng.choice("ab cd\n'\tÉ é́ 1ſ<|> ") for _ in range(40)) for _ in range(200)]
    for t in [*ODD[1:], *made]:
        assert np.frombuffer(own.encode(t), "<u4").tolist() == library.encode(t, add_special_tokens=False).ids


def held(rows, texts, library, size):
    """Checks pieces against the documents; returns the padding."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert by_doc.keys() == texts.keys()
    for doc, pieces in by_doc.items():
        ids, at = ids_of(library, texts[doc]), 0
        for p in sorted(pieces, key=lambda r: r["start"]):
            assert p["start"] == at and p["length"] > 0 and p["doc_tokens"] == len(ids)
            at += p["length"]
            assert p["ids_crc32"] == zlib.crc32(np.array(ids[p["start"] : at], "<u4").tobytes())
        assert at == len(ids)
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda r: r["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= size
        padding += 0 if at & (at - 1) == 0 else size - at
    return padding


def test_report_of_odd_rows(spark, library):
    rng = random.Random(5)
    texts = dict(enumerate([*ODD, *(" ".join(rng.choice(["tree", "house", "Wasser", "naïve"]) for _ in range(rng.choice([3, 40, 700, 5000]))) for _ in range(60))]))
    df = spark.createDataFrame([(i, t, "x") for i, t in texts.items()], "doc_id long, text string, length string").repartition(3)
    assert held(packing.report(df, PATH).collect(), texts, library, 2048) == 0
    assert held(packing.report(df, PATH, 64).collect(), texts, library, 64) == 0


def test_null_ids_and_repeated_rows(spark):
    df = spark.createDataFrame([(None, "one two"), (None, "one two"), (4, None)], "doc_id long, text string").coalesce(1)
    rows = packing.report(df, PATH).collect()
    assert sum(r["length"] for r in rows) == 7 and sum(r["length"] for r in rows if r["doc_id"] is None) == 6
    assert {(r["doc_id"], r["doc_tokens"]) for r in rows} == {(None, 3), (4, 1)}
    assert packing.report(df.limit(0), PATH).collect() == []


def sums_of_squares(counts, size, length):
    """Brute force: the sum after each possible placement."""
    out = {}
    for level in [0, *(h for h in range(1, size - length + 1) if counts[h])]:
        after = counts.copy()
        after[level] -= 1 if level else 0
        if level + length < size:
            after[level + length] += 1
        out[level] = int((after[1:size] ** 2).sum())
    return out


def test_best_level_against_brute_force():
    rng = np.random.default_rng(2)
    packer = packing.Packer(16)
    for _ in range(2000):
        packer.counts[1:16] = rng.integers(0, 4, 15)
        length = int(rng.integers(1, 16))
        found = sums_of_squares(packer.counts, 16, length)
        least = min(found.values())
        assert packer.best_level(length) == max(h for h, s in found.items() if s == least)


@pytest.mark.parametrize("lengths", [[9] * 500, [3, 5, 7, 11] * 200, [16] * 5, [1] * 31, [40, 17, 2] * 50])
def test_bounded_open_windows_and_whole_results(lengths):
    packer = packing.Packer(16, most_open=8)
    for i, n in enumerate(lengths):
        packer.add(i, np.arange(n, dtype="<u4").tobytes())
        assert packer.n_open <= 8 and packer.n_open == packer.counts.sum() == sum(map(len, packer.levels))
    packer.finish()
    taken = sorted((p.doc, p.start, p.length) for w in packer.done for p in w)
    assert sum(n for *_, n in taken) == sum(lengths)
    for a, b in zip(taken, taken[1:], strict=False):
        assert b[1] == (a[1] + a[2] if a[0] == b[0] else 0)
    fills = [sum(p.length for p in w) for w in packer.done]
    assert all(f <= 16 and f & (f - 1) == 0 for f in fills)


def test_sequences_are_padded(spark, library):
    df = spark.createDataFrame([(1, "one two three"), (2, "four")], "doc_id long, text string").coalesce(1)
    pieces = packing.pack(df, PATH)
    found = packing.sequences(pieces).collect()
    ids = {r["sequence_id"]: r["ids"] for r in found}
    assert sorted(x for v in ids.values() for x in v) == sorted(ids_of(library, "one two three") + ids_of(library, "four"))
    uneven = packing.sequences(pieces.where("length > 0").limit(1).withColumn("ids", pieces["ids"]), 8, -1)
    assert all(len(r["ids"]) in (1, 2, 4, 8) for r in uneven.collect())

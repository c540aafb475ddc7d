"""Operators that look at one text at a time, or at lines: against brute force, and in odd cases."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import time
import tracemalloc
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.llm import bpe, chat, licenses, lines, pii, quality, tokenizer_files

ODD = [None, "", " ", "\n\n", "a", "Ünïcode ß x\x1cy", "word " * 3000, "x" * 5000, "same line\nsame line\nother", "a b c a b c a b c", "# * $ % | < > &", "tab\tand\x0bvt"]


def frame(spark, texts, **more):
    """Documents, with columns whose names clash with what operators add."""
    rows = [(i if i != 3 else None, t, "x", 1, True) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, kept string, n_words int, mix_size boolean")


def test_bpe_equals_the_library(spark):
    tokenizers = pytest.importorskip("tokenizers")
    path = tokenizer_files.path()
    own, library = bpe.ByteBpe(path), tokenizers.Tokenizer.from_file(path)
    rng = random.Random(1)
    signs = list(" \n\t ab'sl1é 　.!²ßЖ中😀")
    texts = [t or "" for t in ODD] + ["".join(rng.choice(signs) for _ in range(60)) for _ in range(300)]
    texts += ["a<|endoftext|>b <|endoftext|>", "it's we'll I'D 12 3.5", "ab" * 4000]
    for t in texts:
        ids = own.encode(t)
        assert ids == library.encode(t, add_special_tokens=False).ids
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False) == t
    assert own.decode([0, 99_999_999, 1]) == own.decode([0, 1])
    got = bpe.digests(frame(spark, ODD), path).collect()
    want = [(i if i != 3 else None, own.encode(t or ""), t or "") for i, t in enumerate(ODD)]
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    assert [tuple(r) for r in got] == [(i, len(ids), sha(",".join(map(str, ids))), sha(t)) for i, ids, t in want]
    both = bpe.decode(bpe.encode(frame(spark, ODD), path), path, text="back").collect()
    assert [r["back"] for r in both] == [t or "" for t in ODD] and both[0]["mix_size"] is True
    assert bpe.digests(frame(spark, []), path).collect() == []


def test_forced_cuts_cross_no_token():
    own = bpe.ByteBpe(tokenizer_files.path())
    inside = {(a, b) for i, t in own.token_bytes.items() if i not in own.special.values() for a, b in zip(t, t[1:], strict=False)}
    assert all((own.byte_ranks[a << 8 | b] == bpe.FORCED) == ((a, b) not in inside) for a in range(256) for b in range(256))


def test_quality_against_brute_force(spark):
    texts = [*ODD, "good words stand here in a row " + " ".join(f"w{i}" for i in range(60)), "!!&& " * 80 + " ".join(f"w{i}" for i in range(300)), ("l1 a b c\n" * 3 + "l2\n") * 4]
    got = {r["doc_id"]: r for r in quality.report(frame(spark, texts)).collect()}
    for i, t in enumerate(texts):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        windows = Counter(zip(w, w[1:], w[2:], strict=False))
        places = {p + d for p, x in enumerate(zip(w, w[1:], w[2:], strict=False)) if windows[x] > 1 for d in range(3)}
        full = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        symbols = len(re.findall(r"[#*$%&|<>]", t or ""))
        base = len(w) < 50 or 100 * len(places) > 50 * len(w)
        chars = sum(map(len, w))
        extra = 100 * symbols > 30 * len(w) or not 2 * len(w) <= chars <= 15 * len(w) or 100 * (len(full) - len(set(full))) > 50 * len(full)
        r = got[i if i != 3 else None]
        assert tuple(r)[1:8] == (len(w), chars, symbols, len(full) - len(set(full)), len(places), base, not base and not extra), i
    kept = quality.keep(frame(spark, texts))
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in got.items() if r["kept"]} and kept.columns == frame(spark, []).columns
    assert quality.report(frame(spark, [])).collect() == []


def test_cascade_order():
    always, never = (lambda m: True), (lambda m: False)
    fixed = lambda costs: lambda rule, measures: (costs[rule.name], [rule.rejects(m) for m in measures])
    cheap, dear = quality.Rule("cheap", lambda m: m.n_words % 2 == 0), quality.Rule("dear", always)
    sample = ["w " * k for k in range(1, 21)]
    assert [r.name for r in quality.ordered(sample, (dear, cheap), fixed({"cheap": 1.0, "dear": 4.0}))] == ["cheap", "dear"]
    # what "same" rejects is gone once "cheap" has run, so "other" comes before it although it rejects less alone
    same, other = quality.Rule("same", cheap.rejects), quality.Rule("other", lambda m: m.n_words == 1)
    assert [r.name for r in quality.ordered(sample, (same, other, cheap), fixed({"same": 1.5, "other": 1.0, "cheap": 1.0}))] == ["cheap", "other", "same"]
    assert quality.ordered([], (dear, cheap)) == (dear, cheap)
    asked = []
    rules = (quality.Rule("a", always), quality.Rule("b", lambda m: asked.append(1) or False))
    assert quality.rejected_by("text", rules) == "a" and not asked and quality.rules_run("text", rules) == 1 and quality.rules_run("t", (quality.Rule("n", never),) * 3) == 3


def test_cascade_saves_work_whatever_comes_first(spark):
    """The first rows of the table are unlike the rest: the sample is drawn from all, and its order runs fewest rules."""
    first = [" ".join(f"w{i}_{k}" for k in range(60)) + " #" * 80 for i in range(600)]
    rest = ["few words" if i % 5 else " ".join(f"w{i}_{k}" for k in range(80)) for i in range(5000)]
    df = frame(spark, first + rest)
    some = quality.sampled(df)
    assert len(some) == quality.SAMPLE_ROWS and sum(t == "few words" for t in some) > 200 and sorted(some) == sorted(quality.sampled(df.repartition(7)))
    costs = {r.name: 1.0 for r in quality.RULES}
    order = quality.ordered(some, quality.RULES, lambda rule, measures: (costs[rule.name], [rule.rejects(m) for m in measures]))
    runs = {rules: sum(quality.rules_run(t, rules) for t in first + rest) for rules in itertools.permutations(quality.RULES)}
    assert runs[order] == min(runs.values()) < runs[order[::-1]] / 2


def brute_lines(rows, min_docs, min_chars=1):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    held = {(d, key(x)) for d, t in rows for x in (t or "").split("\n")}
    common = {k for k, n in Counter(k for _, k in held).items() if n >= min_docs and len(k) >= min_chars}
    return [(d, (t or "").split("\n"), [x for x in (t or "").split("\n") if key(x) not in common]) for d, t in rows]


def test_lines_against_brute_force(spark):
    rng = random.Random(2)
    pool = ["Common LINE", " common line\t", "rare one", "É big", "é big", "", "  ", "zzz", "solo", "\x1c edge"]
    rows = [(i if i % 17 else None, None if i == 5 else "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 6))) + f"\nown {i}") for i in range(60)] + [(1, "rare one\nx")] * 3
    df = spark.createDataFrame([(*r, "y") for r in rows], "doc_id bigint, text string, t1 string")
    want = brute_lines(rows, 10)
    sha = lambda x: hashlib.sha256("\n".join(x).encode()).hexdigest()
    got = lines.digests(df, n_batches=5, fanout=2).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(d, len(a), len(a) - len(k), sha(k)) for d, a, k in want], key=repr)
    kept = lines.dedup(df)
    assert kept.columns == df.columns
    assert sorted((tuple(r) for r in kept.collect()), key=repr) == sorted([(d, None if t is None else "\n".join(k), "y") for (d, t), (_, _, k) in zip(rows, want, strict=True)], key=repr)
    assert lines.digests(df.limit(0)).collect() == []


def test_copies_of_a_text_are_dealt_by_their_number(spark, monkeypatch):
    """A third of all rows is one text, another third alike in all columns, many are empty: no key holds more than its share."""
    monkeypatch.setattr(lines, "SHARE", 16)
    monkeypatch.setattr(lines, "FEW", 5)
    rows = [(k, "same\nown lines", k) for k in range(200)] + [(7, "twice\nsame", 0)] * 200 + [(k, None, 1) for k in range(100)] + [(k, f"rare {k}\nsame", 2) for k in range(1000, 1100)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, more int").repartition(5)
    keyed = lines.with_common(df, "doc_id", "text", **lines.PRODUCTION)
    held = keyed.groupBy("t1", "t2", "t3").count().orderBy("count").collect()
    assert keyed.count() == 600 and held[-1]["count"] <= 3 * 600 / 16 and len({(r["t1"], r["t2"]) for r in held}) == 103
    assert {(r["t1"], r["t2"]) for r in held if r["t3"] > 0} == set(lines.hot_texts(lines.hashed_lines(df, "doc_id", "text", 2, 1)))
    want = brute_lines([(d, t) for d, t, _ in rows], 10)
    got = [(r["doc_id"], r["text"]) for r in lines.dedup(df).collect()]
    assert sorted(got, key=repr) == sorted([(d, None if t is None else "\n".join(k)) for (d, t, _), (_, _, k) in zip(rows, want, strict=True)], key=repr)
    assert {r["kept_sha256"] for r in lines.digests(df.where("text is null")).collect()} == {hashlib.sha256(b"").hexdigest()}


def test_levels_are_compacted(spark):
    runs = lines.Runs(spark, min_docs=2, fanout=2)
    for k in range(5):
        runs.add(spark.createDataFrame([(k, 7, 7), (k, k, k)], "doc bigint, h1 bigint, h2 bigint"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert [tuple(r) for r in runs.common().collect()] == [(7, 7)]
    again = lines.Runs(spark, min_docs=2, fanout=2, path=runs.path)  # as another session finds it
    again.add(spark.createDataFrame([(9, 7, 7), (9, 3, 3), (9, 8, 8)], "doc bigint, h1 bigint, h2 bigint"))
    assert sorted(tuple(r) for r in again.common().collect()) == [(3, 3), (7, 7)]
    last = again.run(again.levels[0][-1]).select("h1", "n_docs", "crosses").collect()
    assert sorted(map(tuple, last)) == [(3, 1, True), (8, 1, False)]  # 7 is common already: joined away
    with pytest.raises(OSError):  # another writer was first
        runs.add(spark.createDataFrame([(10, 1, 1)], "doc bigint, h1 bigint, h2 bigint"))
    known = {t.name for t in spark.catalog.listTables()}
    again.close()
    runs.close()
    assert not {t.name for t in spark.catalog.listTables()} & {n for n in known if n.startswith("lines_")}


def test_batches_meet_runs_bucket_by_bucket(spark):
    """The runs are read as they lie: only the batch is shuffled."""
    runs = lines.Runs(spark, min_docs=2, fanout=4)
    for k in range(2):
        runs.add(spark.createDataFrame([(k, i, i) for i in range(k, 50)], "doc bigint, h1 bigint, h2 bigint"))
    batch = spark.range(100).selectExpr("id as h1", "id as h2").groupBy("h1", "h2").count()
    for k, run in enumerate(runs.runs()):
        batch = batch.join(run.select("h1", "h2", F.col("n_docs").alias(f"r{k}")).hint("merge"), ["h1", "h2"], "left")
    plan = batch._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Bucketed: true") == 2, plan
    runs.close()


def brute_pii(t):
    found = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    found += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and sum(int(c) * (1 + i % 2) - 9 * (int(c) * (1 + i % 2) > 9) for i, c in enumerate(digits[::-1])) % 10 == 0:
            found.append(("card", m.start(), m.end()))
    return found + [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


def test_pii_patterns_against_regex():
    rng = random.Random(3)
    signs = list("a.@+- ()0123456789b\n")
    texts = ["".join(rng.choice(signs) for _ in range(80)) for _ in range(3000)] + ["a@b.c@d.e.f", "x@@y.z", "4111 1111 1111 1111", "1.2.3.4.5.6.7.8", "٣@x.y", "999999999999.1.1.1"]
    for t in texts:
        assert pii.base_spans(t) == brute_pii(t)


@pytest.fixture(scope="module")
def field():
    return pii.Field().fit(pii.made_up(400))


def test_pii_long_runs_stay_linear(field):
    assert pii.all_spans("1" * 200_000, field) == [] and pii.base_spans("0" * 6000 + ".1.2.3") == [("ip", 0, 6006)]
    assert len(pii.all_spans("a@b.com 1.2.3.4 " * 5000, field)) == 10_000


def test_pii_of_a_megabyte_of_numbers(field):
    rng = random.Random(1)
    text = " ".join(str(rng.randint(10**7, 10**8)) for _ in range(111_000))
    tracemalloc.start()
    began = time.perf_counter()
    assert pii.all_spans(text, field) == []
    took, peak = time.perf_counter() - began, tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert took < 120 and peak < 200e6  # tracing makes it many times slower


def test_pruned_search_is_the_full_one(field):
    """Leaving out segments that can't count changes nothing."""
    rng = random.Random(15)
    words = ["joe", "(at)", "@", "mail", "[dot]", ".", "com", "4111", "1111", "+49", "0049", "171", "10[.]2[.]3[.]4", "12", ",", "(", ")"]
    full = pii.Field(field.weights)
    full.only_well_formed = lambda: False
    for _ in range(150):
        t = "".join(rng.choice(words) + rng.choice(["", " ", "-"]) for _ in range(14))
        assert field.best(t) == full.best(t)


def test_field_finds_disguises_and_leaves_clean_text(field):
    assert pii.all_spans("write to joe.doe[at]mail[dot]org today", field) == [("email", 9, 32)]
    assert pii.all_spans("server 10[.]20[.]30[.]40 is up", field) == [("ip", 7, 24)]
    for clean in ("just some words, 12 of them", "see 2024-05-06 12:30:45", "rated 4.5 @ home", "1eb9c654e721b4f812088970e66a6345cee33dd6", ""):
        assert pii.all_spans(clean, field) == []
    held = pii.made_up(300, seed=77)
    assert sum(field.best(w) == gold for w, gold in held) / len(held) > 0.9
    long = "word " * 20000 + "a@b.co"
    assert pii.all_spans(long, field) == [("email", 100000, 100006)]


def test_dynamic_programming_is_best(field):
    """Against every choice of segments of a short window."""
    n, spans, table = field.prepared("ab@c.de 12345678")
    score = field.scores(table) - pii.MARGIN

    def best(at):
        return max([0.0] if at >= n else [best(at + 1), *(score[s].max() + best(j) for s, (i, j, _, _) in enumerate(spans) if i == at)])

    chosen = field.best("ab@c.de 12345678")
    at = {(a, b): s for s, (_, _, a, b) in enumerate(spans)}
    assert sum(score[at[a, b], pii.KINDS.index(k)] for k, a, b in chosen) == pytest.approx(best(0))


def test_pii_report_odd_cases(spark, field):
    texts = [*ODD, "mail a@b.co and 4111 1111 1111 1111"]
    got = pii.report(frame(spark, texts), field=field).collect()
    assert len(got) == len(texts) and got[0]["n_email"] == 0 and got[0]["spans"] == "" and got[0]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert got[-1]["spans"] == "email:5:11,card:16:35" and pii.report(frame(spark, []), field=field).collect() == []


def brute_chat(rows, stretch=None):
    """Each turn rendered for each participant, one after another."""
    safe = lambda x: x.replace("<|", "< |")
    turns = {(c, t, safe(r or "unknown"), safe(x or "")) for c, t, r, x in rows}
    dialogues: dict = {}
    for c, t, r, x in turns:
        part = None if stretch is None or t is None else t // stretch
        dialogues.setdefault((c, part, None if c is not None else (t, r, x)), []).append((t is not None, t or 0, r, x))
    speakers: dict = {}
    for c, t, r, x in turns:
        if r != "system":
            speakers.setdefault((c, None if c is not None else (t, r, x)), set()).add(r)
    out = []
    for (c, part, alone), own in dialogues.items():
        for who in speakers.get((c, alone), ()):
            text, mask, n = "", [], 0
            for _, _, r, x in sorted(own):
                text += "<|assistant|>\n" if r == who else "<|system|>\n" if r == "system" else f"<|user name={r}|>\n"
                start = len(text)
                text += f"{x}\n<|end|>\n"
                if r == who:
                    mask.append(f"{start}:{len(text)}")
                    n += len(text) - start
            out.append((c, who, *([part] if stretch else []), len(own), text, ",".join(mask), n))
    return sorted(out, key=repr)


def test_chat(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "ann", "hi"), (1, 2, "bob", "yo"), (1, 2, "bob", "yo"), (1, 3, None, None), (2, 0, "system", "x"), (None, 0, "ann", "n"), (None, 0, "ann", "n"), (None, 4, "bob", "é"), (None, None, "system", "q")]
    rows += [(3, 200, "ann", "late"), (3, 1, "ann", "é"), (3, None, "bob", "first <|end|> of all"), (3, 1, "<|assistant|>", "who"), (4, 63, "ann", "a"), (4, 64, "bob", "b")]
    rng = random.Random(12)
    rows += [(7, k // 2, rng.choice(["ann", "bob", "cy", "system"]), "x" * rng.randint(0, 9)) for k in range(400)]  # long, with ties
    rows += [(8, None, rng.choice(["ann", "bob"]), f"t{k}") for k in range(50)]
    df = spark.createDataFrame([(*r, 5) for r in rows], "conv_id bigint, turn bigint, role string, text string, stretch int")
    got = chat.perspectives(df)
    assert got.columns == ["conv_id", "perspective", "n_turns", "rendered", "mask", "n_masked"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_chat(rows)
    cut = chat.perspectives(df, stretch=64)
    assert {(r["conv_id"], r["stretch"]) for r in cut.where("conv_id in (4, 8)").collect()} == {(4, 0), (4, 1), (8, None)}
    own = sorted(tuple(r) for r in cut.where("conv_id in (1, 4, 7)").collect())
    assert own == sorted(brute_chat([r for r in rows if r[0] in (1, 4, 7)], 64))
    assert chat.perspectives(df.limit(0)).collect() == []


def test_licenses(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is\nfurnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    texts = [*ODD, "Words.\nReleased under the MIT License.\nMore.", "Licensed under CC BY-NC 4.0.", mit, "We licensed under the table. Released under the MIT License. Licensed under the Apache License, Version 2.0.", "You may not use this file except in compliance with the License."]
    got = [tuple(r)[1:] for r in licenses.scan(frame(spark, texts)).collect()]
    n = len(ODD)
    assert got[:n] == [(0, "", "", 0)] * n
    assert got[n:] == [(1, "ref-MIT", "MIT", 0), (1, "ref-CC-BY-NC-4.0", "CC-BY-NC-4.0", 0), (2, "mit-grant,mit-notice", "MIT", 0), (2, "ref-MIT,ref-Apache-2.0", "Apache-2.0,MIT", 0), (1, "apache-comply", "", 1)]
    assert all(any(s in sentence for s in licenses.SIGNS) for sentence in licenses.known_sentences())
    assert licenses.scan(frame(spark, [])).collect() == []


def test_licenses_in_any_spacing(spark):
    """Line breaks, spaces and markup between the words of a known sentence change nothing."""
    texts = ["Released under\nGPL 2.0", "Released under the\nGPL v2", "Released under **MIT**", "Distributed under (CC BY 4.0)", "published   under\t_apache_ 2.0", "> This is free and unencumbered software released into the public\n> domain.", "Nothing is\nunder here"]
    got = [tuple(r)[1:] for r in licenses.scan(frame(spark, texts)).collect()]
    assert got[:-1] == [(1, f"ref-{x}", x, 0) for x in ("GPL-2.0", "GPL-2.0", "MIT", "CC-BY-4.0", "Apache-2.0")] + [(1, "public-domain", "Unlicense", 0)]
    assert got[-1] == (0, "", "", 0)
    known = list(licenses.known_sentences())
    assert all(set(licenses.SIGNS) & set(s.split()) for s in known) and all(s.isalnum() for s in licenses.SIGNS)
    for joint in ("\n", "  ", " ** ", "\n> "):
        spread = licenses.scan(frame(spark, [joint.join(s.upper().split(" ")) for s in known])).collect()
        assert [r["sentence_ids"] for r in spread] == list(licenses.known_sentences().values())


def test_field_finds_disguises_beside_plain_ones(field):
    """A plain item on a line hides none of its neighbours."""
    lines_of = {
        "Tel 0049 171 234 5678, +49 30 1234567": [("phone", 4, 21), ("phone", 23, 37)],
        "pay 4111.1111.1111.1111, 4111 1111 1111 1111": [("card", 4, 23), ("card", 25, 44)],
        "0049 171 234 5678 | 10.1.2.3": [("ip", 20, 28), ("phone", 0, 17)],
        "+49 30 1234567, 0049 171 234 5678, 10.1.2.3": [("ip", 35, 43), ("phone", 0, 14), ("phone", 16, 33)],
    }
    for t, want in lines_of.items():
        assert pii.all_spans(t, field) == want
    for clean in ("10.1.2.3 2024-05-06 12:30:45", "on 2024-05-06 12:30 from 10.1.2.3, 1234567", "+49 30 1234567, 12345678"):
        assert pii.all_spans(clean, field) == pii.base_spans(clean)


def test_field_learns_nothing_from_unlabelled_rows(spark):
    """Many copies of a disguised item don't teach it as clean, and the other rows keep their spans."""
    copies = "reach us: joe (at) mail (dot) org, ann (at) mail (dot) org; tel 0049 171 234 5678 or 10[.]20[.]30[.]40"
    alone = [r["spans"] for r in pii.report(frame(spark, [copies, "sue[at]mail[dot]net"])).collect()]
    among = [r["spans"] for r in pii.report(frame(spark, [copies] * 400 + [copies, "sue[at]mail[dot]net"])).collect()]
    assert alone[0].count("email") == 2 and alone[0].count("ip") == alone[0].count("phone") == 1 and alone[1] == "email:0:19"
    assert among == [alone[0]] * 401 + alone[1:]


APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
BSD_2 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
BSD_AS_IS = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE."""
GNU = """This {what} is free software{a} you can redistribute it and/or modify
it under the terms of the GNU {word} Public License as published by
the Free Software Foundation{b} either version {v} of the License, or
(at your option) any later version.

This {what} is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU {word} Public License for more details."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE."""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""


def test_licenses_of_standard_headers(spark):
    want = [
        (APACHE, "Apache-2.0"), (BSD_2 + BSD_AS_IS, "BSD-2-Clause"), (BSD_2 + BSD_THIRD + BSD_AS_IS, "BSD-3-Clause"), (BSD_2 + BSD_THIRD, "BSD-3-Clause"), (ISC, "ISC"), (MPL, "MPL-2.0"),
        (GNU.format(what="program", a=";", b=";", v="2", word="General"), "GPL-2.0-or-later"), (GNU.format(what="program", a=":", b=",", v="3", word="General"), "GPL-3.0-or-later"),
        (GNU.format(what="library", a=";", b=";", v="2.1", word="Lesser General"), "LGPL-2.1-or-later"), (GNU.format(what="program", a=":", b=",", v="3", word="Lesser General"), "LGPL-3.0-or-later"),
        (GNU.format(what="program", a=":", b=",", v="3", word="Affero General"), "AGPL-3.0-or-later"),
    ]
    for sign in ("# ", " * ", "// "):
        want += [("\n".join(sign + x for x in t.split("\n")), name) for t, name in want[:11]]
    want += [(f"// SPDX-License-Identifier:{gap}{x}\nint main();", x) for gap in ("", " ", " \t") for x in licenses.SPDX]
    got = licenses.scan(frame(spark, [t for t, _ in want])).collect()
    assert [r["licences"] for r in got] == [name for _, name in want]
    assert [r["n_unmatched"] for r in got[:11]] == [0] * 11


def test_quality_sample_is_that_of_all_rows(spark):
    """The bound on the hash changes nothing: few rows, many rows, rows mostly too long, one row many times."""
    tables = {
        "few": [(i, f"a b {i}") for i in range(7)], "many": [(i, f"a b {i}") for i in range(3000)],
        "long": [(i, "x" * (70_000 if i % 50 else 5)) for i in range(600)], "copies": [(1, "same")] * 2000 + [(2, None), (3, "")],
    }
    for rows in tables.values():
        df = spark.createDataFrame(rows, "doc_id bigint, text string")
        hashed = df.where("length(text) <= 65536").selectExpr("xxhash64(doc_id, text) AS h", "text").collect()
        assert quality.sampled(df, rows=10) == [r.text for r in sorted(hashed)[:10]]


def test_content_rules_see_few_texts_and_match_sql(spark, tmp_path, monkeypatch):
    """Evaluations in a report stay below rows times rules; each content rule rejects its own kind, in SQL as here."""
    import duckdb

    from millrace.llm import oracle

    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6))
    good = [" ".join(word() for _ in range(rng.randint(60, 300))) for _ in range(300)]
    kinds = {
        "one_word": " ".join(x for _ in range(90) for x in ("again", word(), word())), "entropy": " ".join(rng.choice(["aaab", "baaa", "abaa", "aaba", "aabb"]) + "a" * rng.randint(0, 9) for _ in range(400)),
        "mixed_scripts": " ".join(word() + " " + "".join(rng.choice("абвгдежзиклмнопрст") for _ in range(6)) for _ in range(80)), "greek": " ".join("".join(rng.choice("αβγδεζηθικλμνξοπ") for _ in range(5)) for _ in range(90)),
    }
    texts = [*good, *kinds.values(), *["short text"] * 200, None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in quality.report(df).collect()}
    own = {name: got[len(good) + i] for i, name in enumerate(kinds)}
    assert own["one_word"]["rejected_by"] == "one_word" and own["mixed_scripts"]["rejected_by"] == "mixed_scripts" and not own["entropy"]["kept"] and own["greek"]["kept"]
    assert all(got[i]["kept"] for i in range(len(good)))
    documents = df.toArrow()  # noqa: F841  read by the SQL
    assert sorted(duckdb.sql(oracle.OP10).fetchall()) == sorted(tuple(r)[:8] for r in got.values())
    order = quality.sampled_order(df, known=quality.REPORTED)
    ran = sum(quality.rules_run(t or "", order) for t in texts)
    assert ran <= len(texts) * len(order) - 200 * (len(order) - 2) < len(texts) * len(order)
    assert order[0].name == "few_words"

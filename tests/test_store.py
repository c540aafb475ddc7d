"""The store: stages, deltas, buckets that split, reads that skip parts, counters of one query."""

from __future__ import annotations

import json
from collections import defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millrace.operators import buckets
from millrace.operators.store import MAX_DELTAS, Store
from millrace.plans.contract import compiled
from millrace.sources import landing


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_stage_is_atomic(spark, tmp_path):
    store = Store(spark, str(tmp_path / "db"))
    own = spark.createDataFrame([(1, "x", 1, 2, "h", "t", 0)], "fixture_id bigint, identifier string, element bigint, value bigint, side string, ingested_at string, seq int")
    with pytest.raises(ZeroDivisionError), store.stage():
        store.upsert("fixture_stats", own, ["seq"])
        raise ZeroDivisionError
    assert store.read("fixture_stats").isEmpty()
    with store.stage():
        assert store.upsert("fixture_stats", own, ["seq"]) == 1
    assert store.read("fixture_stats").count() == 1
    store.fail()
    assert store.upsert("fixture_stats", own, ["seq"]) == 0


STATS = "fixture_id bigint, identifier string, element bigint, value bigint, side string, ingested_at string, seq int"


def test_two_writers_and_crashes(spark, tmp_path):
    one = lambda i: spark.createDataFrame([(i, "x", 1, 2, "h", "t", 0)], STATS)
    a, b = (Store(spark, str(tmp_path / "db")) for _ in range(2))
    a.upsert("fixture_stats", one(1), ["seq"])
    with pytest.raises(OSError), a.stage():  # both began at one version: the later commit fails, nothing is lost
        a.upsert("fixture_stats", one(2), ["seq"])
        b.upsert("fixture_stats", one(3), ["seq"])
    assert rows(b.read("fixture_stats").select("fixture_id")) == [(1,), (3,)]
    (tmp_path / "db" / "manifest-000000000009.json.tmp").write_text("{half")  # a writer that died before its rename
    a.upsert("fixture_stats", one(4), ["seq"])
    assert rows(a.read("fixture_stats").select("fixture_id")) == [(1,), (3,), (4,)]
    versions = lambda: len(list((tmp_path / "db" / "fixture_stats").iterdir()))
    assert versions() == 4 and a.vacuum() == 3 and versions() == 3  # three deltas are shown; the failed one and two manifests go
    a.compact("fixture_stats")
    assert versions() == 4 and a.vacuum() == 4 and versions() == 1 and a.read("fixture_stats").count() == 3


def test_tables_of_the_layout_before_buckets(spark, tmp_path):
    store = Store(spark, str(tmp_path / "db"))
    store.upsert("fixture_stats", spark.createDataFrame([(1, "x", 1, 2, "h", "t", 0)], STATS), ["seq"])
    path = store.manifest()["fixture_stats"].paths[0]
    landing.commit(spark, store.root, 2, {"fixture_stats": path})
    assert store.read("fixture_stats").count() == 1
    store.upsert("fixture_stats", spark.createDataFrame([(2, "x", 1, 2, "h", "t", 0)], STATS), ["seq"])
    assert store.manifest()["fixture_stats"].rows == 2 and store.read("fixture_stats").count() == 2


def test_stored_tables_declare_what_wrote_them(spark, tmp_path):
    from dataclasses import replace

    from millrace.plans.contract import Contract

    now = compiled()["fixture_stats"]
    store = Store(spark, str(tmp_path / "db"), Contract((replace(now, key=("fixture_id", "element")),)))
    store.upsert("fixture_stats", spark.createDataFrame([(1, "x", 1, 2, "h", "t", 0)], STATS), ["seq"])
    assert store.validate().status == "valid"
    assert Store(spark, store.root, Contract((now,))).validate().constraint_mismatches == ["fixture_stats: key"]



def stats(spark, found):
    return spark.createDataFrame([(i, "x", e, v, "h", "t", 0) for i, e, v in found], STATS)


def held(store):
    return {(r.fixture_id, r.element): r.value for r in store.read("fixture_stats").collect()}


def folders(version):
    return {b: [p.path for p in parts] for b, parts in version.buckets.items()}


def test_deltas_are_read_folded_and_split(spark, tmp_path):
    """Against a dictionary: rows of every merge, and parts that a merge leaves alone."""
    store = Store(spark, str(tmp_path / "db"), bucket_rows=8)
    wanted = {}

    def put(found):
        store.upsert("fixture_stats", stats(spark, found), ["seq"])
        wanted.update({(i, e): v for i, e, v in found})
        assert held(store) == wanted and store.validate().constraint_mismatches == []
        return store.manifest()["fixture_stats"]

    assert folders(put([(1, 1, 0), (2, 2, 0)])).keys() == {""}
    assert len(put([(1, 1, 1), (3, 2, 0)]).buckets[""]) == 2  # a delta beside the part
    first = put([(i, e, 1) for i in range(5) for e in range(8)])
    assert len(first.buckets) >= 5 and all(len(parts) <= 1 and sum(p.rows for p in parts) <= 16 for parts in first.buckets.values())
    second = put([(1, 3, 2)])
    assert sum(second.buckets[b] != first.buckets.get(b) for b in second.buckets) == 1
    for n in range(MAX_DELTAS):  # the ninth delta of one bucket folds it, and no other
        last = put([(1, 3, 3 + n)])
    assert sum(len(parts) > 1 for parts in last.buckets.values()) == 0
    assert sum(last.buckets[b] != first.buckets[b] for b in first.buckets) == 1
    store.vacuum()
    assert held(store) == wanted
    store.upsert("fixture_stats", stats(spark, [(1, 3, 99)]), ["seq"])
    before = held(store)
    store.compact("fixture_stats")
    assert held(store) == before and all(len(parts) <= 1 for parts in store.manifest()["fixture_stats"].buckets.values())


def test_tasks_follow_rows(spark, tmp_path, monkeypatch):
    """A task of a read or fold has a bounded number of rows, however well they compress, and sorts none before its shuffle."""
    monkeypatch.setattr("millrace.operators.store.TASK_ROWS", 100)
    monkeypatch.setattr("millrace.operators.store.FILE_ROWS", 100)
    store = Store(spark, str(tmp_path / "db"), bucket_rows=400)
    made = lambda n, value: spark.range(n).selectExpr("id as fixture_id", "'x' as identifier", "id % 2 as element", f"{value}L as value", "'h' as side", "'t' as ingested_at", "0 as seq")
    store.upsert("fixture_stats", made(3000, 1), ["seq"])
    store.upsert("fixture_stats", made(300, 2), ["seq"])
    version = store.manifest()["fixture_stats"]
    sizes = [spark.read.parquet(str(f)).count() for parts in version.buckets.values() if parts for f in Path(parts[0].path).glob("*.parquet")]
    assert sum(sizes) == 3000 and max(sizes) < 200
    found = store.read("fixture_stats")
    assert "WindowGroupLimit" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.rdd.getNumPartitions() >= 33
    assert sorted(found.groupBy("value").count().collect()) == [(1, 2700), (2, 300)]


def test_buckets_of_two_rounds_split_by_key(spark, tmp_path):
    """A million rows of two rounds: buckets of at most twice the bound, and changes that touch one of them."""
    store, most = Store(spark, str(tmp_path / "db"), bucket_rows=50_000), 50_000
    table = compiled()["gameweeks"]
    ids = spark.range(1_000_000).select(F.expr("id div 2").alias("element_id"), (F.col("id") % 2 + 1).alias("round"), F.lit(0).alias("seq"))
    full = ids.select(*[F.col(c) if c in ids.columns else F.lit(None).cast(table.schema[c].dataType).alias(c) for c in table.column_names], "seq")
    assert store.upsert("gameweeks", full, ["seq"]) == 1_000_000
    first = store.manifest()["gameweeks"]
    sizes = [sum(p.rows for p in parts) for parts in first.buckets.values() if parts]
    assert sum(sizes) == 1_000_000 and max(sizes) <= 2 * most and len(sizes) >= 16
    assert store.upsert("gameweeks", full.where("element_id = 77 and round = 2"), ["seq"]) == 1
    second = store.manifest()["gameweeks"]
    assert [b for b in second.buckets if second.buckets[b] != first.buckets[b]] == [b for b in second.buckets if len(second.buckets[b]) == 2]
    one = next(b for b in second.buckets if len(second.buckets[b]) == 2)
    parts = [Path(p.removeprefix("file:")).name for p in first.paths]
    assert len(parts) == len(set(parts))
    # new elements into that bucket alone until it is split: the others keep their parts
    address = buckets.bits(buckets.address(table), buckets.BITS)
    more = spark.range(10**6, 5 * 10**6).select(F.col("id").alias("element_id"), F.explode(F.expr("array(1L, 2L)")).alias("round"), F.lit(0).alias("seq"))
    more = more.where(address.startswith(one)).select(*[F.col(c) if c in more.columns else F.lit(None).cast(table.schema[c].dataType).alias(c) for c in table.column_names], "seq")
    given = store.upsert("gameweeks", more, ["seq"])
    third = store.manifest()["gameweeks"]
    assert given > most and one not in third.buckets and {b for b in third.buckets if b not in second.buckets} == {b for b in third.buckets if b.startswith(one)}
    assert all(third.buckets[b] == second.buckets[b] for b in second.buckets if b != one)
    assert store.read("gameweeks").count() == 1_000_000 + given
    # reads for values open what can hold them
    asked = store.where("gameweeks", round=2, element_id=77)
    assert asked.count() == 1 and len({Path(f).parent.name for f in asked.inputFiles()}) == 1
    by_round = store.where("gameweeks", round=1)
    opened = {Path(f).parent.name for f in by_round.inputFiles()}
    assert by_round.count() == store.read("gameweeks").where("round = 1").count()
    assert 0 < len(opened) < len([b for b in third.buckets if third.buckets[b]]) * 2 / 3
    assert store.where("gameweeks", round=3).inputFiles() == [] and store.where("gameweeks", round=3).count() == 0


def test_reads_for_values_see_later_deltas(spark, tmp_path):
    """A delta that is out of range for the value asked must still hide the older row."""
    store = Store(spark, str(tmp_path / "db"))
    store.upsert("fixture_stats", stats(spark, [(1, 1, 5), (2, 1, 5), (3, 1, 7)]), ["seq"])
    store.upsert("fixture_stats", stats(spark, [(1, 1, 9)]), ["seq"])
    ask = lambda **values: sorted((r.fixture_id, r.value) for r in store.where("fixture_stats", **values).collect())
    assert ask(value=5) == [(2, 5)] and ask(value=(7, None)) == [(1, 9), (3, 7)] and ask(fixture_id=(2, 3), value=(None, 6)) == [(2, 5)]
    assert ask(fixture_id=1) == [(1, 9)] and ask(fixture_id=4) == [] and ask(element=1, side="h", fixture_id=3) == [(3, 7)]
    assert ask(fixture_id=2, identifier="x", element=1, side="h") == [(2, 5)]
    assert store.where("fixture_stats", fixture_id=(2, None)).inputFiles() == [f for f in store.read("fixture_stats").inputFiles() if "v-000000001" in f]
    assert Store(spark, str(tmp_path / "none")).where("fixture_stats", value=1).count() == 0


def record(**more):
    return {"fixture_id": 1, "identifier": "x", "element": 1, "value": 2, "side": "h"} | more


def variants(spark, records):
    return spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)], "pos int, j string").select("pos", F.parse_json("j").alias("record"))


def test_validated_merge_is_one_query(spark, tmp_path):
    """Counters, valid rows and rejects come from one query of a shuffle and a write; nothing is held in memory."""
    store = Store(spark, str(tmp_path / "db"))
    found = [record(), record(value="x"), record(element=2), record(element=2, value=8), record(odd=1), record(element=None)]
    own = variants(spark, found)
    own.count()
    tracker, group = spark.sparkContext.statusTracker(), "one-merge"
    spark.sparkContext.setJobGroup(group, "a validated merge")
    try:
        tally, bad = store.upsert_records("fixture_stats", own, ["pos"])
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(tracker.getJobIdsForGroup(group)) <= 2  # the shuffle's map side and the write
    assert (tally.fetched, tally.validated, tally.written, tally.skipped) == (6, 3, 3, 3)
    assert rows(store.read("fixture_stats").select("element", "value")) == [(1, 2), (2, 8)]
    assert sorted(r["_errors"][0] for r in bad.collect()) == ["element: null", "unknown: odd", "value: not int"]
    assert all(json.loads(r["record"])["fixture_id"] == 1 for r in bad.collect())
    assert store.manifest()["fixture_stats"].rows == 2
    tally, bad = store.upsert_records("fixture_stats", variants(spark, []), ["pos"])
    assert tally.fetched == 0 and bad.count() == 0 and store.read("fixture_stats").count() == 2
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_projected_merge(spark, tmp_path):
    store = Store(spark, str(tmp_path / "db"))
    found = variants(spark, [record(), record(element=2), record(odd=1)])
    tally, bad = store.upsert_records("fixture_stats", found, ["pos"], project=lambda df: df.where("element = 2"))
    assert (tally.fetched, tally.validated, tally.written, bad.count()) == (3, 2, 1, 1)
    with pytest.raises(ValueError, match="impossible"):
        store.upsert_records("fixture_stats", found, ["pos"], project=lambda df: df.union(df))
    assert store.read("fixture_stats").count() == 1


def test_logs_fold_and_keep_their_order(spark, tmp_path, monkeypatch):
    from millrace.operators import store as module
    from millrace.operators.validate import Tally

    monkeypatch.setattr(module, "TAIL", 5)
    store = Store(spark, str(tmp_path / "db"))
    wanted = defaultdict(list)
    for run in range(4):
        for stage in ("a", "b", "c"):
            store.record_stage(f"t{run}", Tally(stage, 3, 2, 2))
            wanted[f"t{run}"].append(stage)
        store.set_status(f"t{run}", "FAILED_PARTIAL")
        store.set_metadata({"k": str(run), f"k{run}": "x"})
    runs = store.read("_runs").orderBy("run_id").collect()
    assert [(r.started_at, r.stage) for r in runs] == [(t, s) for t in wanted for s in wanted[t]] and len({r.run_id for r in runs}) == 12
    assert {r.status for r in runs} == {"FAILED_PARTIAL"} and {r.skipped for r in runs} == {1}
    assert {r.key: r.value for r in store.read("_metadata").collect()} == {"k": "3", "k0": "x", "k1": "x", "k2": "x", "k3": "x"}
    store.vacuum()
    assert store.read("_runs").count() == 12 and store.read("_metadata").count() == 5


def test_published_tables(spark, tmp_path):
    """Registered over the visible version, widened by an added column, read back for drift, seen by another session."""
    from dataclasses import replace

    from millrace.plans.contract import Contract, columns

    now = compiled()["fixture_stats"]
    old = replace(now, columns=columns("fixture_id:int identifier:str element:int side:str"))
    wider = Contract((replace(now, columns=(*old.columns, *columns("value:int?"))),))
    store = Store(spark, str(tmp_path / "db"), Contract((old,)), bucket_rows=20)
    spark.sql(f"CREATE DATABASE published LOCATION '{tmp_path}/cat'")
    try:
        store.upsert("fixture_stats", stats(spark, [(i, i % 3, 0) for i in range(100)]), ["seq"])
        store.upsert("fixture_stats", stats(spark, [(1, 1, 0)]), ["seq"])
        ran = store.publish("published")
        assert ran[0].startswith("CREATE TABLE") and "ADD PARTITION" in ran[1]
        other = spark.newSession()
        assert other.sql("SELECT count(*), count(DISTINCT fixture_id) FROM published.fixture_stats").first()[:] == (100, 100)
        assert store.validate("published").status == "valid" == store.validate().status
        assert Store(spark, store.root, wider).validate("published").missing_columns == ["fixture_stats.value"]
        later = Store(spark, store.root, wider, bucket_rows=20)
        later.upsert("fixture_stats", stats(spark, [(7, 1, 5), (200, 1, 6)]), ["seq"])
        ran = later.publish("published")
        assert any("ADD COLUMNS (value BIGINT)" in sql for sql in ran) and not any(sql.startswith("CREATE") for sql in ran)
        later.vacuum()
        assert later.validate("published").status == "valid"
        other.catalog.refreshTable("published.fixture_stats")  # it has read the table before
        got = other.sql("SELECT fixture_id, value FROM published.fixture_stats WHERE value IS NOT NULL").collect()
        assert sorted(map(tuple, got)) == [(7, 5), (200, 6)] and other.sql("SELECT count(*) FROM published.fixture_stats").first()[0] == 101
    finally:
        spark.sql("DROP DATABASE published CASCADE")

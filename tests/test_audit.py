from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import audit, merge, select
from millrace.plans.sql import Session

RUNS = [(1, "t1", "core", 10, 10, 10, 0, 0, None), (2, "t1", "fixtures", 5, 4, 4, 1, 0, None), (3, "t2", "core", 0, 0, 0, 0, 1, None), (4, "t3", "core", 3, 3, 3, 0, 0, None)]


def test_totals_and_reports(spark):
    runs = spark.createDataFrame(RUNS, audit.RUNS)
    assert {r["started_at"]: r["status"] for r in audit.totals(runs).collect()} == {"t1": "FAILED_PARTIAL", "t2": "FAILED", "t3": "SUCCESS"}
    assert [r["run_id"] for r in audit.recent(runs, 2).collect()] == [4, 3]
    assert [(r["run_id"], r["pct"]) for r in audit.skipping(runs).collect()] == [(2, 20.0)]
    rounds = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (2, 5)], "round bigint, element_id bigint")
    assert [tuple(r) for r in audit.players_by_round(rounds).collect()] == [(1, 2), (2, 1)]
    old = spark.createDataFrame([(1, "t0", "core", 9, 7, 2, 0)], "run_id bigint, started_at string, stage string, fetched bigint, upserted bigint, skipped bigint, errors bigint")
    row = audit.migrated_runs(old).first()
    assert (row["validated"], row["written"], row["status"]) == (7, 7, None) and "upserted" not in row.asDict()


def test_status_precedence(spark):
    cases = [(True, 0, 0, "FAILED"), (False, 1, 5, "FAILED"), (False, 0, 5, "FAILED_PARTIAL"), (False, 0, 0, "SUCCESS")]
    df = spark.createDataFrame(cases, "strict boolean, errors int, skipped int, want string")
    assert df.where(select.status(F.col("strict"), F.col("errors"), F.col("skipped")) != F.col("want")).isEmpty()


def test_upsert_replaces_the_whole_row(spark):
    old = spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "id bigint, name string, n int")
    new = spark.createDataFrame([(2, None, 7, 1), (2, "c", None, 2), (3, "d", 8, 1)], "id bigint, name string, n int, seq int")
    assert sorted(map(tuple, merge.upsert(old, new, ["id"], ["seq"]).collect())) == [(1, "a", 5), (2, "c", None), (3, "d", 8)]
    assert sorted(map(tuple, merge.insert_or_ignore(old, new, ["id"], ["seq"]).collect())) == [(1, "a", 5), (2, "b", 6), (3, "d", 8)]
    assert sorted(map(tuple, merge.upsert(old.limit(0), new, ["id"], ["seq"]).collect())) == [(2, "c", None), (3, "d", 8)]


def test_current_round(spark):
    shape = "id bigint, c boolean, n boolean, f boolean"
    ask = lambda rows: select.current_round(spark.createDataFrame(rows, shape), "id", "c", "n", "f").first()[0]
    assert ask([(1, False, False, True), (2, True, False, False), (3, False, True, False)]) == 2
    assert ask([(1, False, False, True), (3, False, True, False)]) == 2
    assert ask([(1, False, False, True), (2, False, False, True)]) == 2
    assert ask([]) is None


def test_sql_with_parameters(spark):
    own = Session(spark, {"t": spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, name string")})
    assert [tuple(r) for r in own.query("SELECT name FROM t WHERE id = ?", [2]).collect()] == [("b",)]
    spark.range(3).createOrReplaceTempView("t")  # the caller's own
    assert own.query("SELECT count(*) FROM t").first()[0] == 2 and spark.table("t").count() == 3
    spark.catalog.dropTempView("t")
    assert own.query("SELECT count(*) FROM t").first()[0] == 2 and "t" not in {x.name for x in spark.catalog.listTables()}

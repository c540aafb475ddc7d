from __future__ import annotations

import json
import re

import pytest
from pyspark.sql import functions as F
from records import record

from millrace.functions import coerce, scalars
from millrace.operators import validate
from millrace.plans.contract import compiled

CASES = [
    ("1.20", "float", 1.2), ("5", "int", 5), (" 5 ", "int", 5), ("5.0", "int", 5), (5.5, "int", None), ("1e3", "int", None), (True, "int", 1), (True, "float", 1.0),
    (5, "str", None), ("x", "str", "x"), (1, "bool", True), ("yes", "bool", True), ("off", "bool", False), (2, "bool", None), ("nan", "float", None), (7.0, "int", 7),
    ([1], "int", None), ({"a": 1}, "str", None), ("", "int", None), (9223372036854775807, "int", 9223372036854775807),
]


def test_coercion_matrix(spark):
    rows = spark.createDataFrame([(i, json.dumps(v)) for i, (v, _, _) in enumerate(CASES)], "i int, j string").withColumn("v", F.try_parse_json("j"))
    for kind in ("int", "float", "str", "bool"):
        got = {r[0]: r[1] for r in rows.select("i", F.expr(coerce.COERCE[kind]("v"))).collect()}
        for i, (value, wanted_kind, want) in enumerate(CASES):
            if wanted_kind == kind:
                assert got[i] == want, (value, kind)


def run(spark, table, records):
    rows = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)], "pos int, j string").select("pos", F.try_parse_json("j").alias("record"))
    return {r["pos"]: r for r in validate.checked(rows, compiled()[table]).collect()}


def test_valid_record_takes_defaults(spark):
    got = run(spark, "players", [record("players", scout_note="x")])[0]
    assert got["_errors"] == [] and got["minutes"] == 0 and got["influence"] == 0.0 and got["in_dreamteam"] == 0 and got["news"] is None


def test_refused_records(spark):
    bad = [
        record("teams", surprise=1), {k: v for k, v in record("teams").items() if k != "name"}, record("teams", strength=None),
        record("teams", strength="many"), record("teams", name=5), record("teams", played=None), [1, 2], record("teams", form=None, team_division=None),
    ]
    got = run(spark, "teams", bad)
    assert [bool(got[i]["_errors"]) for i in range(8)] == [True] * 7 + [False]
    assert got[0]["_errors"] == ["unknown: surprise"] and got[1]["_errors"] == ["name: missing"] and got[2]["_errors"] == ["strength: null"]


def test_alias_and_required_nullable(spark):
    own = record("gameweeks")
    own.pop("element_id")
    got = run(spark, "gameweeks", [own | {"element": 3}, own | {"element_id": 3}, own | {"element": 3, "element_id": 3}])
    assert got[0]["element_id"] == 3 and got[1]["element_id"] == 3 and got[2]["_errors"] == ["element_id: given twice"]
    types = record("element_types")
    got = run(spark, "element_types", [types | {"squad_min_select": None}, {k: v for k, v in types.items() if k != "squad_min_select"}])
    assert got[0]["_errors"] == [] and got[1]["_errors"] == ["squad_min_select: missing"]


@pytest.mark.parametrize("table", [t.name for t in compiled().tables])
def test_probes(spark, table):
    own = [p for p in compiled().probes() if p["table"] == table and p["case"] != "unique"]
    bad = [({k: v for k, v in record(table).items() if k != p["column"]} if p["case"] == "missing" else record(table) | {p["column"]: None}) for p in own]
    got = run(spark, table, [*bad, record(table)])
    assert all(got[i]["_errors"] for i in range(len(bad))) and not got[len(bad)]["_errors"]


def test_counters():
    whole = validate.Tally("core", errors=0) + validate.Tally("a", 5, 4, 4) + validate.Tally("b", 2, 2, 2)
    assert (whole.fetched, whole.validated, whole.written, whole.skipped) == (7, 6, 6, 1) and whole.trouble == "skipped_records" and str(whole) == "core: 7 read, 6 valid, 6 written, 1 skipped, 0 errors"
    for bad in ((1, 2, 0, 0), (2, 1, 2, 0), (-1, 0, 0, 0), (1, 1, 1, -1)):
        with pytest.raises(ValueError):
            validate.Tally("x", *bad)


def test_scalars(spark):
    row = spark.sql("select 1 as p, 9 as q, 55 as c, '' as w, 'A' as f, 'B' as s, '2024-08-16T17:30:00Z' as d").select(
        scalars.position(F.col("p")), scalars.position(F.col("q")), scalars.cost_in_millions(F.col("c")), scalars.display_name(F.col("w"), F.col("f"), F.col("s")),
        scalars.parsed_deadline(F.col("d")).cast("string"), scalars.skip_percent(F.lit(1), F.lit(0)),
    ).first()
    assert list(row) == ["GKP", "UNK", 5.5, "A B", "2024-08-16 17:30:00", None]


def test_generated_code_stays_small(spark):
    """The JVM compiles methods of up to 8,000 bytes only; a table of a hundred columns stays below it."""
    rows = spark.range(3).select(F.parse_json(F.concat(F.lit('{"round":'), F.col("id"), F.lit("}"))).alias("record"))
    plan = validate.checked(rows, compiled()["gameweeks"])._jdf.queryExecution()
    said = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(plan, "codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", said)]
    assert sizes and max(sizes) < 8000, sizes


def test_valid_rows_cost_no_reasons_and_no_copies_of_their_values(spark):
    """Keys are listed without the values under them, and reasons put together for wrong rows alone."""
    rows = [record("fixture_stats"), record("fixture_stats", odd={"a": [1]}), [], {}]
    df = spark.createDataFrame([(json.dumps(r),) for r in rows], "j string").select(F.parse_json("j").alias("record"))
    found = validate.checked(df, compiled()["fixture_stats"])
    plan = found._jdf.queryExecution().analyzed().toString()
    assert "MapType(StringType,VariantType" not in plan and "map<string,variant>" not in plan
    errors = found.select(F.expr("_errors"))._jdf.queryExecution().optimizedPlan().expressions().toString()
    assert errors.index("CASE WHEN") < errors.index("concat(")
    missing = [f"{c}: missing" for c in ("fixture_id", "identifier", "element", "value", "side")]
    assert [r["_errors"] for r in found.collect()] == [[], ["unknown: odd"], ["not an object"], missing]

from __future__ import annotations

import json
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from records import bootstrap, fixtures, history, live, record

from millrace import cli
from millrace.operators import drift, merge, smoke
from millrace.operators.store import Store
from millrace.plans.contract import compiled
from millrace.plans.runner import Run, exit_code, players_by_cache, rounds_to_read
from millrace.sources import landing, rest
from millrace.sources.fetch import Fetcher
from millrace.streaming.incremental import merge_rounds


@pytest.fixture
def raw(tmp_path):
    base = tmp_path / "raw"
    (base / "players").mkdir(parents=True)
    files = {"bootstrap.json": bootstrap(), "fixtures.json": fixtures(), "gw_1.json": live(1, 2), "gw_2.json": live(1), "players/1.json": history(1), "players/2.json": {"history": []}}
    for name, payload in files.items():
        (base / name).write_text(json.dumps(payload))
    return base


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_whole_run_and_replay(spark, raw, tmp_path):
    store = Store(spark, str(tmp_path / "db"))
    first = Run(spark, store, str(raw))
    assert first.run() == "SUCCESS" and exit_code("SUCCESS") == 0
    assert {r.stage: (r.fetched, r.skipped, r.errors) for r in first.results} == {"core": (12, 0, 0), "fixtures": (6, 0, 0), "gameweeks": (3, 0, 0), "player_histories": (2, 0, 0)}
    assert rows(store.query("SELECT element, value, side FROM fixture_stats WHERE identifier = 'goals_scored'")) == [(1, 9, "a"), (2, 1, "a")]
    assert rows(store.query("SELECT top_element_points, chip_plays_json FROM events WHERE id = ?", [1])) == [(17, '[{"chip_name":"b","num_played":3}]')]
    assert rows(store.query("SELECT id, top_element_points, chip_plays_json FROM events WHERE id > 1")) == [(2, None, None), (3, None, None)]
    before = {t.name: rows(store.read(t.name).drop("ingested_at")) for t in compiled().tables}
    assert Run(spark, store, str(raw)).run() == "SUCCESS"
    assert before == {t.name: rows(store.read(t.name).drop("ingested_at")) for t in compiled().tables}
    for t in compiled().tables:
        assert merge.repeated_keys(store.read(t.name), list(t.key)).isEmpty()
    runs = rows(store.query("SELECT stage, status FROM _runs"))
    assert len(runs) == 8 and {s for _, s in runs} == {"SUCCESS"}
    meta = dict(rows(store.query("SELECT key, value FROM _metadata")))
    assert meta["total_players"] == "3" and meta["current_gameweek"] == "2" and "last_successful_run_at" in meta
    assert store.validate().status == "valid"


def test_partial_and_strict(spark, raw, tmp_path):
    broken = bootstrap()
    broken["elements"].append(record("players", id=None))
    (raw / "bootstrap.json").write_text(json.dumps(broken))
    (raw / "players/9.json").write_text("{not json")
    store = Store(spark, str(tmp_path / "a"))
    run = Run(spark, store, str(raw))
    assert run.run() == "FAILED" and store.read("player_histories").count() == 2  # one file's error stops nothing else
    assert run.rejected["players"].count() == 1
    (raw / "players/9.json").unlink()
    assert Run(spark, Store(spark, str(tmp_path / "b")), str(raw)).run() == "FAILED_PARTIAL"
    strict = Store(spark, str(tmp_path / "c"))
    assert Run(spark, strict, str(raw), strict=True).run() == "FAILED" and exit_code("FAILED") == 1
    assert strict.read("players").count() == 3 and strict.read("fixtures").count() == 0
    assert [tuple(r) for r in strict.query("SELECT stage, status FROM _runs").collect()] == [("core", "FAILED")]
    assert strict.read("_metadata").count() == 0
    held = Store(spark, str(tmp_path / "d"))
    assert Run(spark, held, str(raw), strict=True, strict_no_commit=True).run() == "FAILED" and held.read("players").count() == 0


def test_missing_bootstrap_fails(spark, raw, tmp_path):
    (raw / "bootstrap.json").unlink()
    with pytest.raises(RuntimeError):
        Run(spark, Store(spark, str(tmp_path / "db")), str(raw)).run()


class Api(BaseHTTPRequestHandler):
    asked: list[str] = []
    missing: set[str] = set()

    def do_GET(self):  # noqa: N802
        self.asked.append(self.path)
        answers = {"/bootstrap-static/": bootstrap(), "/fixtures/": fixtures()}
        kind, *rest = self.path.strip("/").split("/")
        body = answers.get(self.path) or (live(1, 2) if kind == "event" else history(int(rest[0])))
        self.send_response(404 if self.path in self.missing else 200)
        self.end_headers()
        self.wfile.write(json.dumps(body).encode())

    def log_message(self, *_):
        pass


def test_fetching_run(spark, tmp_path, monkeypatch):
    """The second run fetches only what is new, a forced one everything, and one missing player stops no other."""
    monkeypatch.setattr(rest, "MAX_RATE", 1000.0)
    server = ThreadingHTTPServer(("127.0.0.1", 0), Api)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    store, raw = Store(spark, str(tmp_path / "db")), str(tmp_path / "raw")
    fetcher = Fetcher(spark, f"http://127.0.0.1:{server.server_port}", raw)
    everything = ["/bootstrap-static/", *(f"/element-summary/{i}/" for i in (1, 2, 3)), "/event/1/live/", "/event/2/live/", "/fixtures/"]
    Api.missing.add("/element-summary/3/")
    assert Run(spark, store, raw, fetcher=fetcher).run() == "FAILED" and sorted(Api.asked) == everything
    assert store.read("player_histories").count() == 4 and store.read("gameweeks").count() == 4
    Api.missing.clear()
    Api.asked.clear()
    second = Run(spark, store, raw, fetcher=fetcher)
    assert second.run() == "SUCCESS" and sorted(Api.asked) == ["/bootstrap-static/", "/element-summary/3/", "/event/2/live/", "/fixtures/"]
    assert {r.stage: r.fetched for r in second.results}["gameweeks"] == 2 and store.read("player_histories").count() == 6
    assert set(second.seconds) == {"core", "fixtures", "gameweeks", "player_histories"}
    Api.asked.clear()
    assert Run(spark, store, raw, fetcher=fetcher, force=True).run() == "SUCCESS" and sorted(Api.asked) == everything
    server.shutdown()


def test_incremental_selection(spark):
    events = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (3, 0, 1)], "id bigint, finished bigint, is_current bigint")
    done = spark.createDataFrame([(1,), (3,)], "round bigint")
    assert rows(rounds_to_read(events, done)) == [(2,), (3,)]
    assert rows(rounds_to_read(events, done, force=True)) == [(1,), (2,), (3,)]
    ids = spark.createDataFrame([(1,), (2,)], "player bigint")
    cached, uncached = players_by_cache(ids, spark.createDataFrame([(2,)], "player bigint"))
    assert rows(cached) == [(2,)] and rows(uncached) == [(1,)]


def test_stream_merges_new_files(spark, raw, tmp_path):
    store = Store(spark, str(tmp_path / "db"))
    for minutes, name in ((90, None), (12, "gw_3.json")):
        if name:
            (raw / name).write_text(json.dumps(live(1, 5, minutes=minutes)))
        query = merge_rounds(spark, store, str(raw), str(tmp_path / "checkpoint"))
        query.awaitTermination(120)
        assert query.exception() is None
    assert rows(store.read("gameweeks").select("element_id", "round", "minutes")) == [(1, 1, 90), (1, 2, 90), (1, 3, 12), (2, 1, 90), (5, 3, 12)]


def test_drift(spark):
    contract = compiled()
    live_tables = {t.name: drift.LiveTable(t.schema, t.key, t.cluster_by) for t in contract.tables}
    assert drift.validate(contract, live_tables).exit_code == 0
    from dataclasses import replace

    from pyspark.sql import types as T

    teams = live_tables["teams"]
    extra = live_tables | {"teams": replace(teams, schema=T.StructType([*teams.schema.fields, T.StructField("more", T.StringType())]))}
    assert drift.validate(contract, extra).status == "drift" and drift.validate(contract, extra).exit_code == 2
    gone = {k: v for k, v in live_tables.items() if k != "teams"}
    assert drift.validate(contract, gone).missing_tables == ["teams"]
    other = T.StructType([T.StructField(f.name, T.StringType(), f.nullable) for f in teams.schema.fields])
    assert drift.validate(contract, live_tables | {"teams": replace(teams, schema=other)}).status == "invalid"
    loose = T.StructType([T.StructField(f.name, f.dataType, True) for f in teams.schema.fields])
    assert drift.validate(contract, live_tables | {"teams": replace(teams, schema=loose)}).constraint_mismatches
    assert drift.validate(contract, live_tables | {"fixture_stats": replace(live_tables["fixture_stats"], key=())}).status == "invalid"
    with pytest.raises(RuntimeError):
        drift.migrated(spark.createDataFrame([(1,)], "id bigint"), contract["teams"])
    narrow = spark.createDataFrame([], T.StructType([f for f in teams.schema.fields if f.name != "form"]))
    assert "form" in drift.migrated(narrow, contract["teams"]).columns


def test_smoke(spark, raw):
    contract = compiled()
    assert smoke.bootstrap(landing.documents(spark, str(raw / "bootstrap.json")), contract).ok
    assert smoke.fixtures(landing.documents(spark, str(raw / "fixtures.json")), contract).ok
    assert smoke.history(landing.documents(spark, str(raw / "players/*.json")), contract).ok
    broken = bootstrap()
    del broken["teams"], broken["elements"][1]["web_name"]
    broken["events"] = {}
    (raw / "bootstrap.json").write_text(json.dumps(broken))
    assert smoke.bootstrap(landing.documents(spark, str(raw / "bootstrap.json")), contract).problems == ["elements: missing field web_name", "teams: missing", "events: not a list"]


def test_command_line(spark, raw, tmp_path, capsys):
    places = ["--db", str(tmp_path / "db"), "--raw-dir", str(raw)]
    assert cli.main(["status", *places], spark) == 0 and capsys.readouterr().out == "no runs yet\n\nno metadata yet\n"
    assert cli.main(places, spark) == 0 and cli.main(["inspect", *places], spark) == 0
    shown = capsys.readouterr().out.splitlines()
    assert shown[0].split() == list(cli.RUN_COLUMNS) and [line.split()[1] for line in shown[1:5]] == ["player_histories", "gameweeks", "fixtures", "core"]
    assert len({line.index(line.split()[1]) for line in shown[:5]}) == 1  # columns stand below each other
    assert {line.split()[0] for line in shown[7:]} == {"current_gameweek", "last_successful_run_at", "total_players"}
    assert cli.main(["schema", "validate", *places], spark) == 0 and capsys.readouterr().out == "schema: valid\n"
    (raw / "fixtures.json").write_text("{}")
    assert cli.main(["smoke-test", *places], spark) == 1
    assert capsys.readouterr().out.splitlines() == ["bootstrap: ok", "fixtures: failed", "  fixtures: not a list", "history: ok"]
    assert cli.report_lines(drift.Report("drift", extra_columns=["teams.more"])) == ["schema: drift", "  extra column: teams.more"]
    with pytest.raises(SystemExit):
        cli.main(["run", "--rate", "0"], spark)


def test_artifacts(tmp_path, spark):
    contract = compiled()
    assert json.loads(contract.as_json())["tables"]["gameweeks"]["key"] == ["element_id", "round"]
    assert "players" in json.loads(contract.rules_json()) and "CREATE TABLE IF NOT EXISTS db.players" in contract.ddl("db")
    assert contract["players"].add_column_sql("db", "news").startswith("ALTER TABLE")
    with pytest.raises(RuntimeError):
        contract["players"].add_column_sql("db", "id")
    spark.sql("CREATE DATABASE IF NOT EXISTS contract_test")
    for t in contract.tables:
        spark.sql(t.create_sql("contract_test"))
    assert [f.name for f in spark.table("contract_test.teams").schema] == contract["teams"].column_names
    spark.sql("DROP DATABASE contract_test CASCADE")


def test_catalogue_is_complete(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0

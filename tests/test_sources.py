from __future__ import annotations

import io
import json
import threading
import urllib.error
from datetime import UTC, datetime
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest

from millrace import config
from millrace.cli import main, parser
from millrace.sources import landing, rest


def test_waits():
    assert rest.backoff(1, jitter=0) == 1 and rest.backoff(3, jitter=0.5) == 4.5 and rest.backoff(20) == 60
    assert rest.retry_after("7") == 7 and rest.retry_after("-1") == 0 and rest.retry_after(None) == 30 and rest.retry_after("soon") == 30
    assert rest.retry_after("Fri, 01 Jan 2021 00:00:10 GMT", datetime(2021, 1, 1, tzinfo=UTC)) == 10
    assert rest.clamped_rate(50) == 10 and rest.clamped_rate(3) == 3
    with pytest.raises(ValueError):
        rest.clamped_rate(0)


def test_token_bucket():
    at, slept = [0.0], []
    bucket = rest.TokenBucket(10, 2, clock=lambda: at[0], sleep=lambda s: (slept.append(s), at.__setitem__(0, at[0] + s)))
    for _ in range(5):
        bucket.take()
    assert sum(slept) == pytest.approx(0.3)


class Answer(io.BytesIO):
    status = 200


def test_fetch_retries_and_gives_up():
    bucket, waits = rest.TokenBucket(1e6, 100), []

    def opener(answers):
        def open_(url, timeout):
            x = answers.pop(0)
            if isinstance(x, int):
                raise urllib.error.HTTPError(url, x, "", {"Retry-After": "2"}, None)
            if isinstance(x, Exception):
                raise x
            return Answer(x)

        return open_

    ask = lambda answers, **k: rest.fetch("http://x", bucket, opener=opener(answers), sleep=waits.append, **k)
    assert ask([429, 503, TimeoutError(), b"{bad", b'{"a": 1}']) == (200, '{"a": 1}') and waits[0] == 2
    assert ask([404, b"{}"]) == (404, None)
    assert ask([500, 500], retries=2) == (500, None)


def test_rest_source(spark):
    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):  # noqa: N802
            self.send_response(404 if self.path.endswith("/3") else 200)
            self.end_headers()
            self.wfile.write(json.dumps({"path": self.path}).encode())

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    spark.dataSource.register(rest.RestSource)
    got = spark.read.format("millrace_rest").options(base_url=f"http://127.0.0.1:{server.server_port}", endpoint="item/{id}", ids="1,2,3").load()
    assert sorted((r["id"], r["status"], r["body"]) for r in got.collect()) == [("1", 200, '{"path": "/item/1"}'), ("2", 200, '{"path": "/item/2"}'), ("3", 404, None)]
    server.shutdown()


def test_waits_that_servers_ask_for():
    assert rest.retry_after("1e999") == 30 and rest.retry_after("9" * 12) == rest.LONGEST_WAIT_S and rest.retry_after(" 2.5 ") == 2.5
    assert rest.retry_after("Fri, 01 Jan 2021 00:00:10 GMT", datetime(2022, 1, 1, tzinfo=UTC)) == 0


def test_versions_are_made_once(spark, tmp_path):
    folder = str(tmp_path / "v")
    assert landing.newest(spark, folder) == (0, None)
    landing.commit(spark, folder, 1, {"a": 1})
    with pytest.raises(OSError):
        landing.commit(spark, folder, 1, {"a": 2})
    landing.commit(spark, folder, 2, {"a": 3})
    assert landing.newest(spark, folder) == (2, {"a": 3}) and not list((tmp_path / "v").glob("*.tmp"))


def test_landing(spark, tmp_path):
    landing.write_json(spark, str(tmp_path / "gw_4.json"), {"é": [1]})
    landing.write_json(spark, str(tmp_path / "gw_4.json"), {"é": [2]})
    assert [p.name for p in tmp_path.glob("*.json")] == ["gw_4.json"] and "é" in (tmp_path / "gw_4.json").read_text()
    assert [r["round"] for r in landing.rounds(landing.listing(spark, str(tmp_path / "gw_*.json"))).collect()] == [4]
    assert landing.listing(spark, str(tmp_path / "none_*.json")).isEmpty()


def test_config_and_cli(spark, tmp_path, monkeypatch, capsys):
    file = tmp_path / "c.yaml"
    file.write_text("# note\nwarehouse: w1 # here\nraw_dir: 'r1'\n")
    assert config.resolve(file=str(file)) == config.Config("w1", "r1")
    monkeypatch.setenv("MILLRACE_WAREHOUSE", "w2")
    assert config.resolve(file=str(file)).warehouse == "w2" and config.resolve("w3", file=str(file)).warehouse == "w3"
    with pytest.raises(SystemExit):
        parser().parse_args(["status", "--odd"])
    assert main(["schema", "export", "--out", str(tmp_path / "s.json")]) == 0 and "players" in (tmp_path / "s.json").read_text()
    assert main(["status", "--warehouse", str(tmp_path / "w")], spark) == 0
    assert main(["schema", "validate", "--warehouse", str(tmp_path / "w")], spark) == 1

"""Leases of one rate, strict ends, and smoke tests of what was fetched, against a local server."""

from __future__ import annotations

import json
import threading
import time
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from records import bootstrap, fixtures, history

from millrace import cli
from millrace.sources import fetch, rest
from millrace.sources.fetch import Fetcher


class Api(BaseHTTPRequestHandler):
    def do_GET(self):  # noqa: N802
        self.server.asked.append((time.monotonic(), self.path))
        kind, *rest_of = self.path.strip("/").split("/")
        body = {"bootstrap-static": bootstrap, "fixtures": fixtures}.get(kind, lambda: history(int(rest_of[0])))()
        if kind in self.server.broken:
            del body["elements"][0]["web_name"]
        self.send_response(404 if self.path in self.server.missing else 200)
        self.end_headers()
        self.wfile.write(json.dumps(body).encode())

    def log_message(self, *_):
        pass


@pytest.fixture
def server():
    own = ThreadingHTTPServer(("127.0.0.1", 0), Api)
    own.asked, own.missing, own.broken = [], set(), set()
    threading.Thread(target=own.serve_forever, daemon=True).start()
    yield own
    own.shutdown()


def base(server):
    return f"http://127.0.0.1:{server.server_port}"


def test_a_slow_task_leaves_its_share_to_the_others():
    """Ten tokens a second over five tasks, one of which hardly takes any; never more than the rate."""
    taken, ends = [], time.monotonic() + 3

    def work(pause: float) -> None:
        bucket = rest.LeasedBucket(leases.address)
        while time.monotonic() < ends:
            bucket.take()
            taken.append((time.monotonic(), pause))
            time.sleep(pause)

    with rest.Leases(10) as leases:
        threads = [threading.Thread(target=work, args=(p,)) for p in (3, 0, 0, 0, 0)]
        [t.start() for t in threads]
        [t.join() for t in threads]
    fast = [t for t, pause in taken if not pause and t < ends]
    assert len(fast) >= 26  # a split rate gives the four others 24 at most
    times = sorted(t for t, _ in taken)
    assert all(b - a >= 0.95 - 0.1 for a, b in zip(times, times[10:], strict=False))


def test_the_first_failure_ends_a_strict_fetch(spark, server, tmp_path):
    server.missing.add("/element-summary/2/")
    ids = list(range(40))
    loose = Fetcher(spark, base(server), str(tmp_path / "loose"))
    assert loose.land("history", ids, "t") == 1 and len(server.asked) == 40
    times = sorted(t for t, _ in server.asked)
    assert times[-1] - times[0] >= 39 / 10 * 0.9  # one rate for all tasks
    server.asked.clear()
    strict = Fetcher(spark, base(server), str(tmp_path / "strict"), strict=True)
    assert strict.land("history", ids, "t") == 1 and 0 < len(server.asked) < 30
    assert fetch.bodies(spark, strict.raw_dir, "history").count() == len(server.asked)


def test_smoke_test_of_fetched_bodies(spark, server, tmp_path, capsys):
    places = ["--db", str(tmp_path / "db"), "--raw-dir", str(tmp_path / "raw")]
    assert cli.main(["smoke-test", *places], spark) == 1  # nothing is there
    assert [line.strip() for line in capsys.readouterr().out.splitlines()] == [
        "bootstrap: failed", "bootstrap: no document", "fixtures: failed", "fixtures: no document", "history: failed", "history: no players",
    ]
    assert cli.main(["smoke-test", *places, "--base-url", base(server)], spark) == 0
    assert capsys.readouterr().out.splitlines() == ["bootstrap: ok", "fixtures: ok", "history: ok"]
    assert sorted({p for _, p in server.asked}) == ["/bootstrap-static/", *(f"/element-summary/{i}/" for i in (1, 2, 3)), "/fixtures/"]
    assert cli.main(["smoke-test", *places], spark) == 0  # what was fetched then
    server.broken.add("bootstrap-static")
    assert cli.main(["smoke-test", *places, "--base-url", base(server)], spark) == 1
    assert "  elements: missing field web_name" in capsys.readouterr().out.splitlines()

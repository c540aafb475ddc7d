"""REST source: JSON endpoints as rows of (endpoint, id, status, body), one request an id.

Ids are split over partitions. Each request takes a token, leased from the driver (``Leases``), so that all
tasks share one rate and what a slow one leaves the others use; without such leases the rate is split over
the partitions. Either way the source never asks for more than ``rate`` documents a second in all. A request is
tried again after the waits below; what fails in the end is a row with a null body, so that one id's failure
stops no other, unless the leases are to end with the first failure.
"""

from __future__ import annotations

import json
import math
import random
import re
import socket
import socketserver
import threading
import time
import urllib.error
import urllib.request
from collections.abc import Iterator
from datetime import UTC, datetime
from email.utils import parsedate_to_datetime

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# The limits that requests keep to.
DEFAULT_RATE, MAX_RATE, MAX_CONCURRENT = 10.0, 10.0, 10
MAX_RETRIES, TIMEOUT_S, BACKOFF_CAP_S, RETRY_AFTER_S = 5, 30.0, 60.0, 30.0
RETRYABLE = frozenset({500, 502, 503, 504})
#: What a server may make a task wait at most.
LONGEST_WAIT_S = 3600.0


def clamped_rate(rate: float) -> float:
    """At most ``MAX_RATE``; a rate has to be positive."""
    if rate <= 0:
        raise ValueError("rate must be positive")
    return min(rate, MAX_RATE)


def backoff(failures: int, base: float = 0.0, jitter: float | None = None) -> float:
    """Seconds to wait after so many failed attempts: doubled each time, moved by chance, up to the cap."""
    chance = random.random() if jitter is None else jitter
    return BACKOFF_CAP_S if failures > 32 else min(BACKOFF_CAP_S, math.ldexp(1.0, failures - 1) + base + chance)


#: delay-seconds of RFC 9110, and the fractions and signs that some servers send.
DELAY = re.compile(r"[+-]?[0-9]{1,12}(?:\.[0-9]*)?")


def seconds_until(date: str, now: datetime | None) -> float | None:
    """From ``now`` to an HTTP date (UTC if it names no zone); None if it isn't one."""
    try:
        at = parsedate_to_datetime(date)
    except (TypeError, ValueError):
        return None
    return (at.replace(tzinfo=at.tzinfo or UTC) - (now or datetime.now(UTC))).total_seconds()


def retry_after(header: str | None, now: datetime | None = None) -> float:
    """Seconds that a Retry-After header asks for, at most ``LONGEST_WAIT_S``; missing or malformed gives the default."""
    value = (header or "").strip()
    asked = float(value) if DELAY.fullmatch(value) else seconds_until(value, now)
    return RETRY_AFTER_S if asked is None else min(LONGEST_WAIT_S, max(0.0, asked))


class TokenBucket:
    """Lets through ``rate`` requests a second, ``capacity`` at once."""

    def __init__(self, rate: float, capacity: int = 1, clock=time.monotonic, sleep=time.sleep):
        if rate <= 0 or capacity < 1:
            raise ValueError("rate must be positive and capacity at least 1")
        self.rate, self.capacity, self.clock, self.sleep = rate, capacity, clock, sleep
        self.tokens, self.at = float(capacity), clock()

    def take(self) -> None:
        """Waits for a token."""
        while True:
            now = self.clock()
            self.tokens, self.at = min(self.capacity, self.tokens + (now - self.at) * self.rate), now
            if self.tokens >= 1 - 1e-9:
                self.tokens -= 1
                return
            self.sleep((1 - self.tokens) / self.rate)


class Stopped(Exception):
    """The leases have ended: a strict run met a failure."""


class Leases:
    """One rate for all tasks, given out by the driver: a line asks for a token, the answer is the time to wait for it.

    Tokens are spaced by the rate, one at a time. With ``strict`` the first failure reported ends all further
    leases. Tasks reach it at the driver's own address. Use it as a context manager.
    """

    def __init__(self, rate: float, strict: bool = False, host: str = "127.0.0.1", clock=time.monotonic):
        self.rate, self.strict, self.host, self.clock = clamped_rate(rate), strict, host, clock
        self.lock, self.free, self.ended = threading.Lock(), clock(), False

    def answer(self, asked: str) -> str:
        with self.lock:
            if asked == "failed":
                self.ended |= self.strict
            elif not self.ended:
                now = self.clock()
                at = max(now, self.free)
                self.free = at + 1 / self.rate
                return f"{at - now:.6f}"
        return "stop" if self.ended else "0"

    def __enter__(self) -> Leases:
        own = self

        class Handler(socketserver.StreamRequestHandler):
            def handle(self) -> None:
                for line in self.rfile:
                    self.wfile.write(f"{own.answer(line.decode().strip())}\n".encode())

        class Server(socketserver.ThreadingTCPServer):
            daemon_threads, allow_reuse_address = True, True

        self.server = Server((self.host, 0), Handler)
        threading.Thread(target=self.server.serve_forever, daemon=True).start()
        self.address = f"{self.host}:{self.server.server_address[1]}"
        return self

    def __exit__(self, *_) -> None:
        self.server.shutdown()
        self.server.server_close()


class LeasedBucket:
    """A task's end of ``Leases``, with the interface of ``TokenBucket``."""

    def __init__(self, address: str, sleep=time.sleep):
        host, port = address.rsplit(":", 1)
        self.sleep = sleep
        self.link = socket.create_connection((host, int(port)), timeout=TIMEOUT_S).makefile("rw")

    def ask(self, what: str) -> str:
        self.link.write(f"{what}\n")
        self.link.flush()
        return self.link.readline().strip()

    def take(self) -> None:
        told = self.ask("token")
        if not told or told == "stop":
            raise Stopped
        self.sleep(float(told))

    def failed(self) -> None:
        self.ask("failed")


def fetch(url: str, bucket: TokenBucket | LeasedBucket, retries: int = MAX_RETRIES, timeout: float = TIMEOUT_S, opener=urllib.request.urlopen, sleep=time.sleep) -> tuple[int | None, str | None]:
    """(status, body) of ``url``: a token for every attempt, none held while waiting.

    429 waits as the server asks; 500, 502, 503, 504, lost connections, timeouts and bodies that
    aren't JSON are tried again; other statuses end it with a null body.
    """
    status = None
    for attempt in range(1, retries + 1):
        bucket.take()
        wait = backoff(attempt)
        try:
            with opener(url, timeout=timeout) as answer:
                status, body = answer.status, answer.read().decode("utf-8")
            json.loads(body)
            return status, body
        except urllib.error.HTTPError as e:
            status = e.code
            if status == 429:
                wait = retry_after(e.headers.get("Retry-After"))
            elif status not in RETRYABLE:
                return status, None
        except (urllib.error.URLError, TimeoutError, ConnectionError, ValueError):
            pass
        if attempt < retries:
            sleep(wait)
    return status, None


class Ids(InputPartition):
    def __init__(self, ids: list[str]):
        self.ids = ids


class RestReader(DataSourceReader):
    def __init__(self, options: dict):
        self.base = options["base_url"].rstrip("/")
        self.endpoint = options["endpoint"]
        self.ids = [x for x in options.get("ids", "").split(",") if x] or [""]
        self.rate = clamped_rate(float(options.get("rate", DEFAULT_RATE)))
        self.retries = int(options.get("retries", MAX_RETRIES))
        self.leases = options.get("leases")
        self.parts = min(len(self.ids), int(options.get("partitions", MAX_CONCURRENT)), MAX_CONCURRENT)

    def partitions(self) -> list[InputPartition]:
        return [Ids(self.ids[k :: self.parts]) for k in range(self.parts)]

    def read(self, partition: Ids) -> Iterator[tuple]:
        bucket = LeasedBucket(self.leases) if self.leases else TokenBucket(self.rate / self.parts)
        for one in partition.ids:
            try:
                status, body = fetch(f"{self.base}/{self.endpoint.format(id=one).lstrip('/')}", bucket, self.retries)
            except Stopped:
                return
            if body is None and self.leases:
                bucket.failed()
            yield self.endpoint, one or None, status, body


class RestSource(DataSource):
    """``spark.read.format("millrace_rest")`` with options base_url, endpoint (``{id}`` for each of ids), ids, rate, retries, leases (address)."""

    @classmethod
    def name(cls) -> str:
        return "millrace_rest"

    def schema(self) -> str:
        return "endpoint string, id string, status int, body string"

    def reader(self, schema) -> DataSourceReader:
        return RestReader(dict(self.options))

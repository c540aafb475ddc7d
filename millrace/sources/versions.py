"""A stream of file versions: every file of some globs once for each time it is written.

An offset names all files that are there with their times of modification, so a batch is the difference
of two offsets, the same after a restart, and a file written over comes again. An offset has an entry a
file: for folders of documents and of Parquet parts, not for millions of small files. The source's
Python processes have no file systems of Spark's; the driver lists for them, over a socket, so any
store that Spark reads will do.
"""

from __future__ import annotations

import json
import socket
import socketserver
import threading
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

TIMEOUT_S = 60


class Listing:
    """Answers each connection with the files of ``globs``: {path: milliseconds of its last writing}, as JSON."""

    def __init__(self, spark: SparkSession, globs: list[str]):
        self.spark, self.globs = spark, globs
        self.host = spark.conf.get("spark.driver.host", "127.0.0.1")

    def files(self) -> dict[str, int]:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        found = {}
        for glob in self.globs:
            at = jvm.org.apache.hadoop.fs.Path(glob)
            for f in at.getFileSystem(conf).globStatus(at) or []:
                if f.isFile():
                    found[f.getPath().toString()] = f.getModificationTime()
        return dict(sorted(found.items()))

    def start(self) -> Listing:
        own = self

        class Handler(socketserver.StreamRequestHandler):
            def handle(self) -> None:
                try:
                    answer = {"files": own.files()}
                except Exception as e:  # told to the one who asked, whose query fails with it
                    answer = {"error": str(e)}
                self.wfile.write(json.dumps(answer).encode())

        class Server(socketserver.ThreadingTCPServer):
            daemon_threads, allow_reuse_address = True, True

        self.server = Server((self.host, 0), Handler)
        threading.Thread(target=self.server.serve_forever, daemon=True).start()
        self.address = f"{self.host}:{self.server.server_address[1]}"
        return self

    def close(self) -> None:
        self.server.shutdown()
        self.server.server_close()


def asked(address: str) -> dict[str, int]:
    host, port = address.rsplit(":", 1)
    with socket.create_connection((host, int(port)), timeout=TIMEOUT_S) as link, link.makefile("rb") as answer:
        found = json.loads(answer.read())
    if "error" in found:
        raise OSError(f"listing failed: {found['error']}")
    return found["files"]


class Slice(InputPartition):
    def __init__(self, versions: list[tuple[str, int]]):
        self.versions = versions


def changed(start: dict[str, int], end: dict[str, int]) -> list[tuple[str, int]]:
    """The versions that ``end`` shows and ``start`` doesn't."""
    return [(path, at) for path, at in end.items() if start.get(path) != at]


class VersionReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.address = options["listing"]

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return asked(self.address)

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [Slice(changed(start, end))]  # names alone: what they hold is read by Spark

    def read(self, partition: Slice) -> Iterator[tuple]:
        yield from partition.versions

    def commit(self, end: dict) -> None:
        pass


class VersionSource(DataSource):
    """``spark.readStream.format("millrace_versions")`` with the option listing (address of a ``Listing``)."""

    @classmethod
    def name(cls) -> str:
        return "millrace_versions"

    def schema(self) -> str:
        return "path string, written bigint"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return VersionReader(dict(self.options))

"""Fetching: REST bodies land as Parquet rows under the raw folder, written by the tasks that fetched them.

Every run appends a folder of its own to an endpoint's; the latest body of an id counts. A folder is
complete or not there, so what has landed tells what need not be fetched again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources import landing, rest

# The paths of the API's documents.
ENDPOINTS = {"bootstrap": "bootstrap-static/", "fixtures": "fixtures/", "live": "event/{id}/live/", "history": "element-summary/{id}/"}
BODIES = "endpoint string, id string, status int, body string, fetched_at string"


def folder(raw_dir: str, name: str) -> str:
    return f"{raw_dir}/fetched/{name}"


def bodies(spark: SparkSession, raw_dir: str, name: str) -> DataFrame:
    """All that was fetched from an endpoint, failures (null body) among it."""
    path = folder(raw_dir, name)
    if not landing.exists(spark, f"{path}/*"):
        return spark.createDataFrame([], BODIES)
    return spark.read.schema(BODIES).option("recursiveFileLookup", True).parquet(path)


def documents(spark: SparkSession, raw_dir: str, name: str) -> DataFrame:
    """(path, id, fetched_at, document) of the latest body of each id."""
    rows = bodies(spark, raw_dir, name).where("body is not null")
    last = rows.groupBy("id").agg(F.max("fetched_at").alias("fetched_at"), F.max_by("body", "fetched_at").alias("body"))
    path = F.concat_ws("/", F.lit(name), "id")
    return last.select(path.alias("path"), F.col("id").cast("bigint").alias("id"), "fetched_at", F.try_parse_json("body").alias("document"))


@dataclass(frozen=True)
class Fetcher:
    """Fetches endpoints below ``base_url`` into ``raw_dir``, at most ``rate`` documents a second."""

    spark: SparkSession
    base_url: str
    raw_dir: str
    rate: float = rest.DEFAULT_RATE
    retries: int = rest.MAX_RETRIES
    #: End all requests of an endpoint with the first that fails.
    strict: bool = False

    def land(self, name: str, ids: list[int] | None, stamp: str) -> int:
        """Fetches ``name``, once for each of ``ids`` if it has such; returns how many failed in the end.

        The ids are an option of the source, so they pass through the driver: at the highest rate a day
        has fewer than a million of them.
        """
        if ids is not None and not ids:
            return 0
        self.spark.dataSource.register(rest.RestSource)
        options = {"base_url": self.base_url, "endpoint": ENDPOINTS[name], "rate": str(self.rate), "retries": str(self.retries), "ids": ",".join(map(str, ids or []))}
        path = f"{folder(self.raw_dir, name)}/{stamp.replace(':', '').replace('+', 'Z')}"
        with rest.Leases(self.rate, self.strict, self.spark.conf.get("spark.driver.host", "127.0.0.1")) as leases:
            got = self.spark.read.format("millrace_rest").options(**options, leases=leases.address).load()
            got.withColumn("fetched_at", F.lit(stamp)).write.parquet(path)
        return self.spark.read.schema(BODIES).parquet(path).where("body is null").count()

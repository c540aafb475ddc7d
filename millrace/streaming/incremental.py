"""Incremental ingest as a stream: what lands, is written over or is fetched is merged once a version; the checkpoint remembers."""

from __future__ import annotations

import logging
import threading
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators import flatten
from millrace.operators.store import Store
from millrace.sources import fetch, landing, versions

LOG = logging.getLogger(__name__)


@dataclass(frozen=True)
class Feed:
    """A table's documents: landing files (a glob, and how a name gives the id) and an endpoint's fetched bodies."""

    table: str
    glob: str
    endpoint: str
    id_name: str
    named: Callable[[DataFrame], DataFrame]
    #: (documents, columns to keep) to records.
    records: Callable[[DataFrame, tuple[str, ...]], DataFrame]


ROUNDS = Feed("gameweeks", "gw_*.json", "live", "round", landing.rounds, flatten.live_elements)
PLAYERS = Feed("player_histories", "players/*.json", "history", "player", landing.players, flatten.histories)


def documents(spark: SparkSession, feed: Feed, paths: list[str]) -> DataFrame | None:
    """(path, landed, id, document) of landing files and fetched parts; None if there are none."""
    parts = [p for p in paths if p.endswith(".parquet")]
    files = [p for p in paths if not p.endswith(".parquet")]
    found = []
    if files:
        raw = spark.read.text(files, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").alias("landed"), "value")
        found.append(feed.named(raw).select("path", "landed", feed.id_name, F.try_parse_json("value").alias("document")))
    if parts:
        bodies = spark.read.schema(fetch.BODIES).parquet(*parts).where("body is not null")
        path = F.concat_ws("/", F.lit(feed.endpoint), "id")
        found.append(bodies.select(path.alias("path"), F.col("fetched_at").try_cast("timestamp").alias("landed"), F.col("id").try_cast("bigint").alias(feed.id_name), F.try_parse_json("body").alias("document")))
    return reduce(DataFrame.union, found) if found else None


def merge_versions(spark: SparkSession, store: Store, raw_dir: str, checkpoint: str, feed: Feed) -> StreamingQuery:
    """Merges the documents of ``feed`` written or fetched since the last call, then ends.

    A file that is written over is merged again, and so are the bodies of a new fetch: each version once.
    Of several documents of one id in one batch the later one wins, by the file's time or the fetch's; a
    batch stands over those before it. A file removed before its batch is read is passed over, with a
    warning. A document that isn't JSON gives no records. A batch that is run again after a failure
    gives the same rows.
    """
    listing = versions.Listing(spark, [f"{raw_dir}/{feed.glob}", f"{fetch.folder(raw_dir, feed.endpoint)}/*/*.parquet"]).start()

    def merge(batch: DataFrame, _: int) -> None:
        wanted = [r["path"] for r in batch.collect()]  # names of new files, a scan's driver holds as many
        there = listing.files()
        gone = [p for p in wanted if p not in there]
        if gone:
            LOG.warning("%s: %d files were removed before they were read, among them %s", feed.table, len(gone), gone[0])
        found = documents(spark, feed, [p for p in wanted if p in there])
        if found is not None:
            records = feed.records(found, ("path", feed.id_name, "landed")).withColumnRenamed(feed.id_name, "seq_id")
            with store.stage():
                store.upsert_records(feed.table, records, ["seq_id", "landed", "path", "pos"])

    try:
        spark.dataSource.register(versions.VersionSource)
        stream = spark.readStream.format("millrace_versions").option("listing", listing.address).load()
        query = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    except Exception:
        listing.close()
        raise

    def end() -> None:
        try:
            query.awaitTermination()
        except Exception:  # the caller sees it by the query itself
            LOG.debug("the stream of %s failed", feed.table)
        finally:
            listing.close()

    threading.Thread(target=end, daemon=True).start()
    return query


def merge_rounds(spark: SparkSession, store: Store, raw_dir: str, checkpoint: str) -> StreamingQuery:
    """Live rounds as a stream of versions: ``gw_*.json``, and the fetched rounds."""
    return merge_versions(spark, store, raw_dir, checkpoint, ROUNDS)


def merge_histories(spark: SparkSession, store: Store, raw_dir: str, checkpoint: str) -> StreamingQuery:
    """Players' histories as a stream of versions: ``players/*.json``, and the fetched histories."""
    return merge_versions(spark, store, raw_dir, checkpoint, PLAYERS)

"""The ingest run: what is fetched or has landed to validated, merged tables, stage by stage."""

from __future__ import annotations

import logging
import time
from dataclasses import dataclass, field, replace
from functools import reduce
from operator import add

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import audit, flatten, select
from millrace.operators.store import Store, now
from millrace.operators.validate import Tally
from millrace.sources import fetch, landing


LOG = logging.getLogger(__name__)


class StrictFailure(RuntimeError):
    """A strict run met skipped records or errors."""


@dataclass
class Run:
    """One run over a landing folder: ``bootstrap.json``, ``fixtures.json``, ``gw_*.json``, ``players/*.json`` and what was fetched.

    With a ``fetcher`` the two core documents, the rounds and the players that haven't landed yet are
    fetched first (all of them with ``force``; the current round in any case), and of the rounds only
    those are merged again. A fetched document stands before a file of the same id.
    """

    spark: SparkSession
    store: Store
    raw_dir: str
    strict: bool = False
    #: In strict mode, leave out the commit of a stage that has skipped records.
    strict_no_commit: bool = False
    fetcher: fetch.Fetcher | None = None
    force: bool = False
    results: list[Tally] = field(default_factory=list)
    rejected: dict[str, DataFrame] = field(default_factory=dict)
    seconds: dict[str, float] = field(default_factory=dict)

    def documents(self, name: str) -> DataFrame:
        path = f"{self.raw_dir}/{name}"
        if not landing.exists(self.spark, path):
            return self.spark.createDataFrame([], "path string, document variant")
        return landing.documents(self.spark, path)

    def single(self, name: str) -> tuple[DataFrame, int]:
        """The one document of an endpoint, and how many failed fetches of it there were."""
        failed = self.fetcher.land(name, None, self.started_at) if self.fetcher else 0
        fetched = fetch.documents(self.spark, self.raw_dir, name).select("path", "document")
        return (self.documents(f"{name}.json") if fetched.isEmpty() else fetched), failed

    def several(self, name: str, files: DataFrame, id_name: str) -> DataFrame:
        """(path, id, fetched_at, document) of an endpoint's documents: the fetched ones, and the files of other ids."""
        fetched = fetch.documents(self.spark, self.raw_dir, name).withColumnRenamed("id", id_name)
        rest = files.join(fetched.select(id_name), id_name, "left_anti").withColumn("fetched_at", F.lit(None).cast("string"))
        return fetched.unionByName(rest)

    def _merge(self, table: str, records: DataFrame, sequence: list[str]) -> Tally:
        result, bad = self.store.upsert_records(table, records, sequence, self.started_at)
        self.rejected[table] = bad
        return result

    def core(self) -> Tally:
        """Players, teams, season rounds and positions of the bootstrap document."""
        document, failed = self.single("bootstrap")
        if document.where("document is not null").isEmpty():
            raise RuntimeError("the bootstrap document is missing or isn't JSON")
        frames = {
            "players": flatten.bootstrap_list(document, "elements"), "teams": flatten.bootstrap_list(document, "teams"),
            "events": flatten.season_events(document), "element_types": flatten.bootstrap_list(document, "element_types"),
        }
        return reduce(add, [self._merge(t, df, ["pos"]) for t, df in frames.items()], Tally("core", errors=failed))

    def fixtures(self) -> Tally:
        document, failed = self.single("fixtures")
        if document.where("document is not null").isEmpty():
            return Tally("fixtures", errors=1)
        parts = [self._merge("fixtures", flatten.fixtures(document), ["pos"])]
        parts.append(self._merge("fixture_stats", flatten.fixture_stats(document), ["pos_fixture", "pos_stat", "pos_side", "pos_entry"]))
        return reduce(add, parts, Tally("fixtures", errors=failed))

    def gameweeks(self) -> Tally:
        """Live rounds, later rounds winning; of two files of one round the one with the later name."""
        files = landing.rounds(self.documents("gw_*.json"))
        failed, documents = 0, self.several("live", files, "round")
        if self.fetcher:
            wanted = rounds_to_read(self.store.read("events"), documents.select("round").distinct(), self.force)
            failed = self.fetcher.land("live", sorted(r["round"] for r in wanted.collect()), self.started_at)
            documents = self.several("live", files, "round").where(F.col("fetched_at") == self.started_at)
        records = flatten.live_elements(documents).withColumnRenamed("round", "seq_round")
        return self._counted("gameweeks", documents, records, ["seq_round", "path", "pos"], failed)

    def player_histories(self) -> Tally:
        files = landing.players(self.documents("players/*.json"))
        failed, documents = 0, self.several("history", files, "player")
        if self.fetcher:
            ids = self.store.read("players").select(F.col("id").alias("player"))
            _, uncached = players_by_cache(ids, documents.select("player").distinct(), self.force)
            failed = self.fetcher.land("history", sorted(r["player"] for r in uncached.collect()), self.started_at)
            documents = self.several("history", files, "player")
        return self._counted("player_histories", documents, flatten.histories(documents), ["player", "path", "pos"], failed)

    def _counted(self, table: str, documents: DataFrame, records: DataFrame, sequence: list[str], failed: int) -> Tally:
        """Merges; a document that isn't JSON is an error and stops nothing else."""
        broken = documents.where("document is null").count()
        return self._merge(table, records, sequence) + Tally(table, errors=broken + failed)

    def run(self) -> str:
        """All stages in order; returns the run's status. A strict run stops behind the first stage with trouble."""
        self.started_at = now()
        status = None
        if self.fetcher and self.strict:
            self.fetcher = replace(self.fetcher, strict=True)
        try:
            for stage in (self.core, self.fixtures, self.gameweeks, self.player_histories):
                began = time.monotonic()
                with self.store.stage():
                    result = stage()
                    if self.strict and self.strict_no_commit and result.trouble:
                        raise StrictFailure(result.trouble)
                self.results.append(result)
                self.seconds[result.stage] = time.monotonic() - began
                if result.skipped > audit.SKIP_WARNING * result.fetched:
                    LOG.warning("%s: %.1f %% of the records were skipped", result.stage, 100 * result.skipped / result.fetched)
                self.store.record_stage(self.started_at, result)
                if self.strict and result.trouble:
                    raise StrictFailure(result.trouble)
        except StrictFailure:
            status = "FAILED"
            self.store.fail()
        except Exception:
            self.store.fail()
            self.store.set_status(self.started_at, "FAILED")
            raise
        return self.store.finalize(self.started_at, status, None if status else self.metadata())

    def metadata(self) -> dict[str, str]:
        events = self.store.read("events")
        current = events.agg(F.min(F.when(F.col("is_current") == 1, F.col("id")))).first()[0]
        found = {"total_players": str(self.store.read("players").count())}
        return found | ({"current_gameweek": str(current)} if current is not None else {})


def rounds_to_read(events: DataFrame, done: DataFrame, force: bool = False) -> DataFrame:
    """(round): finished rounds whose file isn't there yet (all of them if forced), and the current one in any case."""
    finished = events.where("finished = 1").select(F.col("id").alias("round"))
    current = events.where("is_current = 1").orderBy("id").limit(1).select(F.col("id").alias("round"))
    wanted = finished if force else finished.join(done.select("round"), "round", "left_anti")
    return wanted.union(current).distinct()


def players_by_cache(ids: DataFrame, done: DataFrame, force: bool = False) -> tuple[DataFrame, DataFrame]:
    """(cached, uncached) of ``ids`` (player) against the files that are there."""
    if force:
        return ids.limit(0), ids
    return select.already_done(ids, done, ["player"]), ids.join(done.select("player"), "player", "left_anti")


def exit_code(status: str) -> int:
    return 0 if status == "SUCCESS" else 1

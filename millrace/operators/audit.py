"""Run audit: stage counters, run status, metadata, and the queries over them."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.scalars import skip_percent
from millrace.operators.select import status

RUNS = "run_id bigint, started_at string, stage string, fetched bigint, validated bigint, written bigint, skipped bigint, errors bigint, status string"
METADATA = "key string, value string, updated_at string"
COUNTERS = ("fetched", "validated", "written", "skipped", "errors")
#: Stage rows that a report shows.
RECENT = 5
#: Share of skipped records from which a warning is due.
SKIP_WARNING = 0.01

SHAPES = {"_runs": RUNS, "_metadata": METADATA}


@dataclass(frozen=True)
class Log:
    """A small table of the store's own: files, rows appended since they were written, and statuses by run."""

    files: list[str] = field(default_factory=list)
    rows: list[list] = field(default_factory=list)
    statuses: dict[str, str] = field(default_factory=dict)
    next: int = 1

    @classmethod
    def of(cls, found: str | dict) -> Log:
        """From a manifest, of earlier layouts too; their rows are numbered below the next ones."""
        if isinstance(found, str) or "parts" in found:
            return cls([found] if isinstance(found, str) else [path for path, _ in found["parts"].values()], next=1 << 32)
        return cls(**found)

    @property
    def paths(self) -> list[str]:
        return self.files


def shown(spark: SparkSession, name: str, log: Log | None) -> DataFrame:
    """The table of a log: for metadata the last row of each key, for runs the last status of each run."""
    log = log or Log()
    rows = spark.createDataFrame([tuple(r) for r in log.rows], SHAPES[name])
    if log.files:
        old = spark.read.parquet(*log.files)
        rows = (migrated_runs(old) if name == "_runs" else old.join(rows.select("key"), "key", "left_anti")).select(*rows.columns).unionByName(rows)
    if log.statuses:
        last = spark.createDataFrame(list(log.statuses.items()), "started_at string, last string")
        rows = rows.join(last, "started_at", "left").withColumn("status", F.coalesce("last", "status")).select(*rows.columns)
    return rows


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n) of all tables given."""
    each = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, each)


def totals(runs: DataFrame) -> DataFrame:
    """Counters summed over the stages of each run, with the run's status."""
    summed = runs.groupBy("started_at").agg(*[F.sum(c).alias(c) for c in COUNTERS])
    return summed.withColumn("status", status(F.lit(False), F.col("errors"), F.col("skipped")))


def recent(runs: DataFrame, n: int = RECENT) -> DataFrame:
    return runs.orderBy(F.desc("started_at"), F.desc("run_id")).limit(n)


def latest_metadata(metadata: DataFrame) -> DataFrame:
    return metadata.orderBy(F.desc("updated_at"), "key")


def skipping(runs: DataFrame, percent: float = 0.0) -> DataFrame:
    """Stages of which more than ``percent`` of the records were skipped."""
    rate = runs.withColumn("pct", skip_percent(F.col("skipped"), F.col("fetched")))
    return rate.where(F.col("pct") > percent)


def players_by_round(gameweeks: DataFrame) -> DataFrame:
    return gameweeks.groupBy("round").agg(F.count_distinct("element_id").alias("players")).orderBy("round")


def migrated_runs(runs: DataFrame) -> DataFrame:
    """Runs of an older layout: validated and written from the former single counter, status unknown."""
    if "upserted" in runs.columns:
        for c in ("validated", "written"):
            old = F.col("upserted")
            runs = runs.withColumn(c, F.coalesce(F.col(c), old) if c in runs.columns else old)
        runs = runs.drop("upserted")
    if "status" not in runs.columns:
        runs = runs.withColumn("status", F.lit(None).cast("string"))
    return runs

"""Versioned Parquet tables behind numbered manifests.

Every write makes a new folder; a stage's tables become visible together with the next manifest, which is
made whole or not at all and never written over: of two writers that began at one version the second
fails. Readers keep the version they started with. After a failure the store takes no more data.

A table is a directory of buckets, kept in the manifest (``operators/buckets.py``). A merge writes a delta:
its rows, one for each key, dealt by bucket. A bucket's parts are put together when it is read, the later
merge winning by key. When a bucket has many deltas, or more rows than it should, that bucket alone is
folded into one part, or split by further bits of its rows' addresses. The manifest holds rows, least and
greatest values of each part, so a read for given values opens only the parts that can hold them.

Run rows, statuses and metadata are appended to the manifest itself, without any Spark job, and folded into
a Parquet file now and then.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Callable, Iterator
from dataclasses import asdict, replace
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from millrace.operators import audit, buckets, catalogue, drift, merge, validate
from millrace.operators.buckets import BUCKET, Part, Version
from millrace.plans.contract import Contract, Table, compiled
from millrace.plans.sql import Session
from millrace.sources import landing

#: Rows of a bucket from which a fold splits it; some GB, which one fold may well rewrite.
BUCKET_ROWS = 4_000_000
#: Deltas of a bucket at most; then it is folded.
MAX_DELTAS = 8
#: Tasks at most that write one bucket of a delta.
SALTS = 8
#: Rows that a task puts together, of buckets with several parts, and rows of a file that a fold writes. Shuffled bytes tell
#: little of a task's memory, since stored columns repeat.
TASK_ROWS, FILE_ROWS = 250_000, 1_000_000
#: Rows of runs, statuses and metadata that the manifest holds before they are folded.
TAIL = 200
REJECTED = "rejected"


def now() -> str:
    return datetime.now(UTC).isoformat()


class Store:
    """Tables of a contract, runs and metadata under ``root``."""

    def __init__(self, spark: SparkSession, root: str, contract: Contract | None = None, bucket_rows: int = BUCKET_ROWS):
        self.spark, self.root, self.contract = spark, root.rstrip("/"), contract or compiled()
        self.bucket_rows = bucket_rows
        self.failed = False
        self._staged: dict[str, Version | audit.Log] | None = None
        self._base = 0

    # what is visible

    def manifest(self) -> dict[str, Version | audit.Log]:
        """Each table's visible version."""
        return self._shown(landing.newest(self.spark, self.root)[1])

    def _shown(self, found: dict | None) -> dict[str, Version | audit.Log]:
        return {name: (audit.Log if name.startswith("_") else Version).of(v) for name, v in (found or {}).items()}

    def read(self, name: str) -> DataFrame:
        """The visible version, or an empty frame of the contract's shape."""
        return self._scan(name, self.manifest().get(name))

    def where(self, name: str, **values) -> DataFrame:
        """The visible rows with these values: a column is a value, or a pair of least and greatest ones (null: open).

        Only parts that can hold such rows are opened: by the address of the layout's column, or of the whole
        key, where these are given, and by the least and greatest values of each part.
        """
        version = self.manifest().get(name)
        bounds = {c: v if isinstance(v, tuple) else (v, v) for c, v in values.items()}
        if version:
            table = self.contract[name]
            exact = {c: v[0] for c, v in bounds.items() if v[0] is not None and v[0] == v[1]}
            version = buckets.pruned(version, table, bounds, buckets.address_bits(self.spark, table, exact))
        found = self._scan(name, version)
        for c, (low, high) in bounds.items():
            found = found.where((F.col(c) >= F.lit(low)) if low is not None else F.lit(True)).where((F.col(c) <= F.lit(high)) if high is not None else F.lit(True))
        return found

    def _scan(self, name: str, version: Version | audit.Log | None) -> DataFrame:
        if name.startswith("_"):
            return audit.shown(self.spark, name, version)
        if not version or not version.paths:
            return self.spark.createDataFrame([], self.contract[name].schema)
        return self._rows(version).drop(BUCKET)

    def _rows(self, version: Version) -> DataFrame:
        """Rows of a version with their bucket; of a bucket of several parts the latest for each key."""
        schema = version.schema and T._parse_datatype_string(version.schema)

        def of(paths: list[str]) -> DataFrame:
            found = (self.spark.read.schema(schema) if schema else self.spark.read).parquet(*paths)
            at = F.col("_metadata.file_path")
            return found.select("*", F.regexp_extract(at, f"{BUCKET}=b([01]*)", 1).alias(BUCKET), F.regexp_extract(at, "/v-([^/]*)/", 1).alias("__from"))

        single = [parts[0].path for parts in version.buckets.values() if len(parts) == 1]
        several = [p for parts in version.buckets.values() if len(parts) > 1 for p in parts]
        clean = of(single) if single else None
        mixed = None
        if several:
            tasks = max(1, -(-sum(p.rows for p in several) // TASK_ROWS))
            dealt = of([p.path for p in several]).repartition(tasks, BUCKET, *version.key)
            mixed = merge.first_of_few(dealt, [BUCKET, *version.key], F.desc("__from"))
        return (clean.unionByName(mixed) if single and several else clean if single else mixed).drop("__from")

    def query(self, sql: str, params: list | None = None) -> DataFrame:
        """Any query over the visible tables."""
        visible = self.manifest()
        names = [*(t.name for t in self.contract.tables), "_runs", "_metadata"]
        return Session(self.spark, {n: self._scan(n, visible.get(n)) for n in names}).query(sql, params)

    def live(self) -> dict[str, drift.LiveTable]:
        """What the stored tables declare: the shape of their files, and what was written down beside them."""
        found = {}
        for name, version in self.manifest().items():
            if not name.startswith("_") and version.paths:
                schema = self.spark.read.parquet(version.paths[0]).schema
                own = T._parse_datatype_string(version.schema).names if version.schema else schema.names
                schema = T.StructType([f for f in schema.fields if f.name in own])  # deltas hold what they were ordered by too
                for f in schema.fields:  # Parquet readers call every column nullable
                    f.nullable = f.name not in version.not_null
                found[name] = drift.LiveTable(schema, tuple(version.key), tuple(version.cluster_by))
        return found

    def validate(self, database: str | None = None) -> drift.Report:
        """The contract against the stored tables, or against those of a database of Spark's catalogue."""
        return drift.validate(self.contract, catalogue.tables(self.spark, database, self.contract) if database else self.live())

    def publish(self, database: str) -> list[str]:
        """Registers the stored tables in Spark's catalogue, as of the visible version; returns the statements run.

        Every bucket is folded first and is a partition whose folder the catalogue names, so nothing is copied.
        A table that is registered gets the columns it lacks and the partitions that have changed since. Its
        readers see the published version until ``vacuum`` removes it: publish again before that. A session that
        has read a table before refreshes it, as for any table that another session changes.
        """
        ran = []
        for table in self.contract.tables:
            if table.name in self.manifest():
                self.compact(table.name)
                parts = {b: held[0].path for b, held in self.manifest()[table.name].buckets.items() if held}
                ran += catalogue.registered(self.spark, database, table, parts, f"{self.root}/{table.name}")
        return ran

    # writes

    @contextlib.contextmanager
    def stage(self) -> Iterator[None]:
        """What is written inside becomes visible together at the end, or not at all."""
        if self._staged is not None:
            raise RuntimeError("a stage is open already")
        self._base, before = landing.newest(self.spark, self.root)
        self._staged = {}
        try:
            yield
            if self._staged:
                tables = self._shown(before) | self._staged
                landing.commit(self.spark, self.root, self._base + 1, {name: asdict(version) for name, version in tables.items()})
        finally:
            self._staged = None

    def _within(self) -> contextlib.AbstractContextManager:
        """The open stage, or one for a single write."""
        return self.stage() if self._staged is None else contextlib.nullcontext()

    def vacuum(self) -> int:
        """Removes folders that the newest manifest doesn't show, and older manifests; returns how many.

        Readers that hold an older version lose it: call it when none is at work.
        """
        jvm = self.spark._jvm
        number, manifest = landing.newest(self.spark, self.root)
        top = jvm.org.apache.hadoop.fs.Path(self.root)
        fs = top.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = lambda glob: [f.getPath() for f in fs.globStatus(jvm.org.apache.hadoop.fs.Path(top, glob)) or []]
        end = lambda path: path.rsplit("/v-", 1)[-1]
        parts = {end(path) for v in self._shown(manifest).values() for path in v.paths}
        folders = {p.split("/", 1)[0] for p in parts}
        old = [p for p in found("manifest-*.json") if p.getName() != landing.VERSION.format(self.root, number).rsplit("/", 1)[-1]]
        for p in found("*/v-*"):
            if end(p.toString()) not in folders:
                old.append(p)
            elif end(p.toString()) not in parts:
                old += [b for b in found(f"{p.getParent().getName()}/{p.getName()}/{BUCKET}=*") if end(b.toString()) not in parts]
        for p in old:
            fs.delete(p, True)
        return len(old)

    def fail(self) -> None:
        """From now on data and metadata are not written; a run's status still is."""
        self.failed = True

    def _version(self, name: str) -> Version | audit.Log | None:
        """The version that the open stage has written, or the visible one."""
        return (self._staged or {}).get(name) or self.manifest().get(name)

    def _folder(self, name: str, number: int) -> str:
        """A new folder; of two folders of a table the one of the later merge has the later name."""
        return f"{self.root}/{name}/v-{number:09d}-{uuid.uuid4().hex}"

    def _current(self, table: Table) -> Version:
        """The table's version in the contract's shape; one of another shape is written anew."""
        old = self._version(table.name)
        new = buckets.empty(table)
        if not old or not old.paths:
            return new
        if old.shape == new.shape:
            return old
        rows = drift.migrated(self._rows(old).drop(BUCKET), table).select(*table.column_names, F.lit("").alias(BUCKET))
        return self._written(table, replace(new, merges=old.merges), [""], merge.latest(rows, list(table.key), *map(F.col, table.key)))

    def _written(self, table: Table, version: Version, old: list[str], rows: DataFrame) -> Version:
        """``rows`` as the one part of each of the buckets ``old``, which are split where they hold more than they should."""
        slot = buckets.slot(table)
        counted = rows.groupBy(BUCKET, slot.alias("slot")).count().collect()  # as many as slots and buckets at most
        held: dict[str, dict[int, int]] = {b: {} for b in old}
        for r in counted:
            held[r[BUCKET]][r["slot"]] = r["count"]
        leaves = [leaf for b in old for leaf in buckets.planned(b, held[b], self.bucket_rows)]
        number = version.merges + 1
        folder = self._folder(table.name, number)
        if len(leaves) > 1:  # each bucket has tasks of its own, a file each
            files = max(1, -(-min(self.bucket_rows, sum(r["count"] for r in counted)) // FILE_ROWS))
            rows = buckets.routed(rows.drop(BUCKET), table, leaves, "__nth")
            nth = F.col("__nth") * files + F.pmod(F.xxhash64(*table.key), F.lit(files))
            rows = rows.repartitionById(len(leaves) * files, nth.cast("int")).drop("__nth")
        elif leaves != old:
            rows = buckets.routed(rows.drop(BUCKET), table, leaves)
        rows = rows.withColumn(BUCKET, F.concat(F.lit("b"), BUCKET))
        rows.sortWithinPartitions(BUCKET, *table.cluster_by).write.partitionBy(BUCKET).parquet(folder)
        parts = self._parts(table, folder)
        kept = {b: p for b, p in version.buckets.items() if b not in old}
        return replace(version, buckets=kept | {b: [parts[b]] if b in parts else [] for b in leaves}, merges=number)

    def _parts(self, table: Table, folder: str) -> dict[str, Part]:
        """What was written to a folder: rows and ranges by bucket."""
        written = self.spark.read.parquet(folder).groupBy(BUCKET).agg(F.count("*").alias("n"), *buckets.ranges(table)).collect()
        return {r[BUCKET][1:]: Part(f"{folder}/{BUCKET}={r[BUCKET]}", r["n"], buckets.range_of(table, r.asDict())) for r in written}

    def _merge(self, table: Table, incoming: DataFrame, sequence: list[str], bad: Column | None = None, more: tuple[str, ...] = ()) -> tuple[dict, str | None]:
        """Within the open stage, a delta of ``incoming``: the last row by ``sequence`` for each key.

        Rows that are ``bad`` are written beside it, with the columns ``more``. Returns the counters given and
        good, and the folder of the bad rows. They are counted in the tasks that write, which count once
        however often a task or a stage before them is run.
        """
        version = self._current(table)
        number = version.merges + 1
        folder = self._folder(table.name, number)
        good = F.lit(True) if bad is None else ~bad
        several = list(version.buckets) != [""]
        columns = [*table.column_names, *dict.fromkeys([*sequence, *more])]
        rows = incoming.select(*columns, good.alias("__good"))
        rows = rows.withColumn("__own", F.when(~F.col("__good"), F.monotonically_increasing_id()))
        rows = buckets.routed(rows, table, list(version.buckets))
        rows = rows.withColumn(BUCKET, F.when(F.col("__good"), F.concat(F.lit("b"), BUCKET)).otherwise(F.lit(REJECTED)))
        spread = [BUCKET, "__salt"] if several else []
        if several:  # a few files for each bucket, and no bucket is one task
            rows = rows.withColumn("__salt", F.pmod(F.xxhash64(*table.key, "__own"), F.lit(SALTS))).repartition(*spread)
        order = [F.desc_nulls_last(s) for s in sequence]
        # sorted once: the window's order begins with what the writer and the layout ask for, the key has the rest
        layout = list(dict.fromkeys([*[BUCKET] * (several or bad is not None), *(c for c in table.cluster_by if c in table.key), *table.key]))
        nth = F.row_number().over(W.Window.partitionBy(*layout, "__own", *spread[1:]).orderBy(*order))
        own = F.col("__good") & (F.col("__nth") == 1)
        seen = Observation()
        rows = rows.withColumn("__nth", nth).observe(
            seen, F.count("*").alias("given"), F.count_if("__good").alias("good"), F.count_if(own).alias("n"), *buckets.ranges(table, own)
        )
        rows = rows.where("__nth = 1").select(BUCKET, *columns)
        if several and not set(table.cluster_by) <= set(table.key):
            rows = rows.sortWithinPartitions(BUCKET, *table.cluster_by)
        rows.write.partitionBy(BUCKET).parquet(folder)
        counted = {"given": 0, "good": 0, "n": 0} | seen.get
        rejected = None
        if counted["given"] > counted["good"]:
            rejected = f"{self.root}/_rejects/{table.name}/{uuid.uuid4().hex}"
            landing.move(self.spark, f"{folder}/{BUCKET}={REJECTED}", rejected)
        if counted["n"]:
            parts = self._parts(table, folder) if several else {"": Part(f"{folder}/{BUCKET}=b", counted["n"], buckets.range_of(table, counted))}
            after = {b: [*held, parts[b]] if b in parts else held for b, held in version.buckets.items()}
            version = replace(version, buckets=after, merges=number)
            full = [b for b in parts if buckets.is_full(after[b], self.bucket_rows, MAX_DELTAS)]
            if full:
                version = self._folded(table, version, full)
            self._staged[table.name] = version
        return counted, rejected

    def _folded(self, table: Table, version: Version, full: list[str]) -> Version:
        """The buckets ``full`` in one part each, split where that is too large; the others keep their parts."""
        rows = self._rows(replace(version, buckets={b: version.buckets[b] for b in full}))
        return self._written(table, version, full, rows.select(BUCKET, *table.column_names))

    def compact(self, name: str) -> None:
        """Folds every bucket that has more than one part."""
        if self.failed:
            return
        with self._within():
            version = self._current(self.contract[name])
            several = [b for b, parts in version.buckets.items() if len(parts) > 1]
            self._staged[name] = self._folded(self.contract[name], version, several) if several else version

    def upsert(self, name: str, rows: DataFrame, sequence: list[str]) -> int:
        """Merges ``rows`` by the table's key, the last by ``sequence`` winning; returns the rows given."""
        if self.failed:
            return 0
        with self._within():
            return self._merge(self.contract[name], rows, sequence)[0]["given"]

    def upsert_records(
        self, name: str, records: DataFrame, sequence: list[str], ingested_at: str | None = None, project: Callable[[DataFrame], DataFrame] | None = None
    ) -> tuple[validate.Tally, DataFrame]:
        """Validates VARIANT records and merges the valid ones: the counters, and the rows set aside with their reasons.

        Both are written, and counted, in one query. ``project`` may change the valid rows before they are
        merged, but not add any: more rows written than found valid are an error. Then what is set aside is
        written by a query of its own. It is kept under ``_rejects``, its record as text.
        """
        table = self.contract[name]
        own = records.select("record", *sequence)
        rows = validate.checked(own, table)
        set_aside = F.size("_errors") > 0
        shape = T.StructType([*(rows.schema[c] for c in sequence if c not in table.column_names), *(rows.schema[c.name] for c in table.columns)])
        shape = shape.add("record", T.StringType()).add("_errors", T.ArrayType(T.StringType()))
        if self.failed:
            return validate.Tally(name), self.spark.createDataFrame([], shape)
        rows = rows.withColumn("ingested_at", F.lit(ingested_at or now()))
        text = F.when(set_aside, F.to_json("record")).alias("record")
        with self._within():
            if project:
                seen = Observation()
                path = f"{self.root}/_rejects/{name}/{uuid.uuid4().hex}"
                counting = rows.observe(seen, F.count("*").alias("given"), F.count_if(~set_aside).alias("good"))
                counting.where(set_aside).select(*[c for c in shape.names if c != "record"], text).write.parquet(path)
                counted, bad = seen.get, path
                written = self._merge(table, project(rows.where(~set_aside).drop("record", "_errors")), sequence)[0]["given"]
            else:
                counted, bad = self._merge(table, rows.withColumn("record", text), sequence, set_aside, ("record", "_errors"))
                written = counted["good"]
            result = validate.Tally(name, counted["given"], counted["good"], written)
        found = self.spark.read.schema(shape).parquet(bad) if bad and result.skipped else self.spark.createDataFrame([], shape)
        return result, found

    # audit

    def _log(self, name: str) -> audit.Log:
        return self._version(name) or audit.Log()

    def _appended(self, name: str, log: audit.Log) -> None:
        """Within the open stage; a log whose tail is long is folded into its file first."""
        if len(log.rows) + len(log.statuses) > TAIL:
            folder = self._folder(name, log.next)
            audit.shown(self.spark, name, log).coalesce(1).write.parquet(folder)
            log = audit.Log([folder], next=log.next)
        self._staged[name] = log

    def record_stage(self, run_started: str, result: validate.Tally) -> None:
        """Appends a stage's row; reads and runs nothing but the manifest."""
        if self.failed:
            return
        with self._within():
            log = self._log("_runs")
            row = [log.next, run_started, result.stage, result.fetched, result.validated, result.written, result.skipped, result.errors, None]
            self._appended("_runs", replace(log, rows=[*log.rows, row], next=log.next + 1))

    def set_status(self, run_started: str, status: str) -> None:
        """The status of all of a run's stages; written after a failure too."""
        with self._within():
            log = self._log("_runs")
            self._appended("_runs", replace(log, statuses=log.statuses | {run_started: status}))

    def set_metadata(self, values: dict[str, str]) -> None:
        if self.failed or not values:
            return
        stamp = now()
        with self._within():
            log = self._log("_metadata")
            own = {r[0]: r for r in log.rows} | {k: [k, str(v), stamp] for k, v in values.items()}
            self._appended("_metadata", replace(log, rows=list(own.values()), next=log.next + 1))

    def finalize(self, run_started: str, status: str | None = None, metadata: dict[str, str] | None = None) -> str:
        """Status and metadata in one swap; the status comes from the run's counters if it isn't given."""
        if status is None:
            found = audit.totals(self._scan("_runs", self._log("_runs")).where(F.col("started_at") == run_started)).first()
            status = found["status"] if found else "SUCCESS"
        with self.stage():
            self.set_status(run_started, status)
            if status == "SUCCESS":
                self.set_metadata({"last_successful_run_at": now()} | (metadata or {}))
            else:
                self.set_metadata(metadata or {})
        return status

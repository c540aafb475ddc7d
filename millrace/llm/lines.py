"""Line dedup over levelled sorted runs of line hashes.

A run is a table of line hashes with document counts, kept in buckets by hash and sorted within them.
Each batch of documents brings the hashes of its lines; it is merge-joined with the runs bucket by
bucket. A line that the runs already show in enough documents is left out; what is left becomes a run of
its own, with a mark on the lines that cross the limit in this batch. Before a batch a level that holds
``fanout`` runs is merged into one run of the next level. The marked lines of all runs are the common
ones, and every document loses them. Runs live in a folder with a manifest and can be opened again.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import SPACES, by_batch, texts
from millrace.sources import landing
from millrace.storage import saved, work_path

STRIP = SPACES.encode()
KEY = ["h1", "h2"]
HALF = 1 << 63


def line_key(line: str) -> bytes:
    """The line without white space at its ends, A-Z in lower case."""
    return line.encode().strip(STRIP).lower()  # bytes lower only A-Z


def line_hash(key: bytes) -> tuple[int, int]:
    """128 bits as two signed halves."""
    x = xxhash.xxh3_128_intdigest(key)
    return (x >> 64) - HALF, (x & (2 * HALF - 1)) - HALF


def text_hash(text: str) -> tuple[int, int]:
    return line_hash(b"\0" + text.encode())


RUN = "h1 bigint, h2 bigint, n_docs bigint, crosses boolean"


class Runs:
    """Sorted runs in levels under ``path``: opened again if there are some, else begun anew."""

    def __init__(self, spark: SparkSession, min_docs: int = 10, fanout: int = 2, path: str | None = None):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.path = path or work_path(spark, "lines-runs")
        self.version, found = landing.newest(spark, self.path)
        found = found or {"levels": [], "buckets": int(spark.conf.get("spark.sql.shuffle.partitions"))}
        self.levels: list[list[str]] = found["levels"]
        self.buckets: int = found["buckets"]
        self.tables: dict[str, str] = {}

    def run(self, name: str) -> DataFrame:
        """A run as a bucketed table, which joins with others bucket by bucket without a shuffle."""
        if name not in self.tables:
            self.tables[name] = f"lines_{uuid.uuid4().hex}"
            layout = f"CLUSTERED BY (h1, h2) SORTED BY (h1, h2) INTO {self.buckets} BUCKETS"
            self.spark.sql(f"CREATE TABLE {self.tables[name]} ({RUN}) USING parquet {layout} LOCATION '{self.path}/{name}'")
        return self.spark.table(self.tables[name])

    def runs(self) -> list[DataFrame]:
        return [self.run(name) for level in self.levels for name in level]

    def close(self) -> None:
        """Takes the runs' names out of the session's catalogue; the files stay."""
        for name in self.tables.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.tables = {}

    def _write(self, rows: DataFrame) -> str:
        name = f"run-{uuid.uuid4().hex}"
        self.tables[name] = f"lines_{uuid.uuid4().hex}"
        rows.select("h1", "h2", "n_docs", "crosses").write.bucketBy(self.buckets, *KEY).sortBy(*KEY).option("path", f"{self.path}/{name}").saveAsTable(self.tables[name])
        return name

    def _merged(self, left: str, right: str) -> str:
        """Two runs merged bucket by bucket (not a union: Spark 4.1 may take the union of two bucketed scans for bucketed itself)."""
        a = self.run(left).select(*KEY, F.col("n_docs").alias("n_a"), F.col("crosses").alias("crosses_a")).hint("merge")
        b = self.run(right).select(*KEY, F.col("n_docs").alias("n_b"), F.col("crosses").alias("crosses_b"))
        docs = F.coalesce("n_a", F.lit(0)) + F.coalesce("n_b", F.lit(0))
        crosses = F.coalesce("crosses_a", F.lit(False)) | F.coalesce("crosses_b", F.lit(False))
        return self._write(a.join(b, KEY, "full").select(*KEY, docs.alias("n_docs"), crosses.alias("crosses")))

    def _commit(self) -> None:
        self.version += 1
        landing.commit(self.spark, self.path, self.version, {"levels": self.levels, "buckets": self.buckets})

    def compact(self) -> None:
        """Merges each level that holds ``fanout`` runs into a run of the next."""
        level = 0
        while level < len(self.levels):
            if len(self.levels[level]) >= self.fanout:
                name = reduce(self._merged, self.levels[level])
                if level + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[level + 1].append(name)
                self.levels[level] = []
                self._commit()
            level += 1

    def common(self) -> DataFrame:
        """Hashes of the lines found in at least ``min_docs`` documents, each once: a line crosses the limit in one batch."""
        crossing = [r.where("crosses").select(*KEY) for r in self.runs()]
        return reduce(DataFrame.union, crossing) if crossing else self.spark.createDataFrame([], "h1 bigint, h2 bigint")

    def add(self, batch: DataFrame) -> None:
        """A batch of (document, h1, h2), each pair once, of documents that no other batch holds."""
        self.compact()
        counted = batch.groupBy(*KEY).agg(F.count("*").alias("own"))
        before = F.lit(0)
        for k, run in enumerate(self.runs()):
            counted = counted.join(run.select(*KEY, F.col("n_docs").alias(f"run{k}")).hint("merge"), KEY, "left")
            before = before + F.coalesce(f"run{k}", F.lit(0))
        open_ = counted.withColumn("before", before.cast("bigint")).where(F.col("before") < self.min_docs)
        crosses = F.col("before") + F.col("own") >= self.min_docs
        name = self._write(open_.select(*KEY, F.col("own").alias("n_docs"), crosses.alias("crosses")))
        if not self.levels:
            self.levels.append([])
        self.levels[0].append(name)
        self._commit()


def hashed_lines(df: DataFrame, doc_id: str, text: str, n_batches: int, min_chars: int) -> DataFrame:
    """Per row of ``df`` and different line key in it: batch, document, hash of the text, hash of the line.

    ``first`` marks one entry of each row; a row without keys has one entry, whose line is null.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[tuple] = []
        for doc, t in zip(batch.column("doc").to_pylist(), texts(batch, "text"), strict=True):
            of_text, part = text_hash(t), xxhash.xxh3_64_intdigest(str(doc).encode()) % n_batches
            keys = {k for k in map(line_key, t.split("\n")) if len(k) >= min_chars and len(k.decode()) >= min_chars}
            hashes = [line_hash(k) for k in keys] or [(None, None)]
            out += [(part, doc, *of_text, *h, n == 0) for n, h in enumerate(hashes)]
        names = ["batch", "doc", "t1", "t2", *KEY, "first"]
        kinds = [pa.int32(), pa.int64(), *[pa.int64()] * 4, pa.bool_()]
        columns = zip(*out, strict=True) if out else [[]] * 7
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return df.selectExpr(f"cast(`{doc_id}` as bigint) as doc", f"`{text}` as text").mapInArrow(
        by_batch(run), "batch int, doc bigint, t1 bigint, t2 bigint, h1 bigint, h2 bigint, first boolean"
    )


def hot_texts(held: DataFrame) -> dict[tuple[int, int], int]:
    """The texts that are more than one in ``SHARE`` of all rows, so fewer than ``SHARE``, and the tasks that each is dealt to."""
    each = held.where("first")
    most = max(each.count() / SHARE, FEW)
    rows = each.groupBy("t1", "t2").agg(F.count("*").alias("n")).where(F.col("n") > most).collect()
    return {(r["t1"], r["t2"]): math.ceil(r["n"] / most) for r in rows}


def common_by_text(
    df: DataFrame, doc_id: str, text: str, min_docs: int, min_chars: int, n_batches: int, fanout: int
) -> tuple[DataFrame, dict[tuple[int, int], int]]:
    """Per different text that holds common lines: t1, t2, and the hashes of those lines; and the texts of many rows.

    Rows that share a doc_id are one document for the count; rows with a null doc_id are together one.
    """
    spark = df.sparkSession
    path = work_path(spark, "lines-held")
    lines = hashed_lines(df, doc_id, text, n_batches, min_chars)
    lines.write.partitionBy("batch").parquet(path)
    held = spark.read.schema(lines.schema).parquet(path)
    runs = Runs(spark, min_docs, fanout)
    for k in range(n_batches):
        runs.add(held.where((F.col("batch") == k) & F.col("h1").isNotNull()).select("doc", *KEY).distinct())  # reads its own files alone
    common = saved(runs.common(), "lines-common")
    runs.close()
    found = held.select("t1", "t2", *KEY).join(common, KEY, "left_semi").distinct()
    return found.groupBy("t1", "t2").agg(F.collect_list(F.struct(*KEY)).alias("common")), hot_texts(held)


def stripped(batch: pa.RecordBatch) -> list[tuple[str, int, int]]:
    """Per row: the text without its common lines, lines before, lines dropped."""
    out = []
    for t, common in zip(texts(batch, "text"), batch.column("common").to_pylist(), strict=True):
        lines = t.split("\n")
        kept = lines
        if common:
            drop = {(x["h1"], x["h2"]) for x in common}
            kept = [x for x in lines if not (k := line_key(x)) or line_hash(k) not in drop]
        out.append(("\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def with_common(df: DataFrame, doc_id: str, text: str, **how) -> DataFrame:
    """``df`` with its text's hash (t1, t2) and the common lines in it, null if there are none.

    Copies of one text are dealt to tasks by the number of its rows, so that no key holds more than one in
    ``SHARE`` of them, whatever their doc_ids are.
    """
    spark = df.sparkSession
    found, hot = common_by_text(df, doc_id, text, **how)
    dealt = spark.createDataFrame([(*k, n) for k, n in hot.items()], "t1 bigint, t2 bigint, tasks int")  # fewer than SHARE rows
    found = found.join(F.broadcast(dealt), ["t1", "t2"], "left")
    found = found.withColumn("t3", F.explode(F.sequence(F.lit(0), F.coalesce("tasks", F.lit(1)) - 1))).drop("tasks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[int] = Counter()

        def salt(row: int, others: list, tasks: int) -> int:
            own = xxhash.xxh3_64_intdigest(repr([c[row].as_py() for c in others]).encode())
            seen[own] += 1  # rows alike in all columns are dealt in turn, in whatever order the partition comes
            return (own + seen[own]) % tasks

        def keyed(batch: pa.RecordBatch) -> pa.RecordBatch:
            pairs = [text_hash(t) for t in texts(batch, text)]
            others = [c for c, n in zip(batch.columns, batch.schema.names, strict=True) if n != text]
            salts = [salt(row, others, hot[p]) if p in hot else 0 for row, p in enumerate(pairs)]
            added = [pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)]
            return pa.RecordBatch.from_arrays([*batch.columns, *added, pa.array(salts, pa.int32())], [*batch.schema.names, "t1", "t2", "t3"])

        yield from by_batch(keyed)(batches)

    more = [T.StructField(c, T.LongType()) for c in ("t1", "t2")]
    keyed = df.mapInArrow(run, T.StructType([*df.schema.fields, *more, T.StructField("t3", T.IntegerType())]))
    return keyed.join(found, ["t1", "t2", "t3"], "left")


#: The contract's limits, and how many batches the runs are built from.
PRODUCTION = {"min_docs": 10, "min_chars": 1, "n_batches": 6, "fanout": 2}
#: A text's copies are dealt so that a key holds at most one in so many rows, or ``FEW``.
SHARE, FEW = 4096, 64


def digests(df: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """Per row: doc_id, n_lines, n_dropped, kept_sha256 of the text without its common lines.

    A null or empty text is one empty line. Rows that repeat get the same result each.
    """
    how = PRODUCTION | how
    own = df.selectExpr(f"cast(`{doc_id}` as bigint) as doc_id", f"`{text}` as text")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = stripped(batch)
        sha = [hashlib.sha256(t.encode()).hexdigest() for t, _, _ in rows]
        n_lines, n_dropped = (pa.array([r[k] for r in rows], pa.int64()) for k in (1, 2))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), n_lines, n_dropped, pa.array(sha, pa.string())],
            ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
        )

    return (
        with_common(own, "doc_id", "text", **how)
        .select("doc_id", "text", "common")
        .mapInArrow(by_batch(run), "doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string")
    )


def dedup(df: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``df`` with each text stripped of its common lines, all other columns as they were.

    A null text stays null; a text of nothing but common lines becomes empty.
    """
    how = PRODUCTION | how
    names = [f"c{k}" for k in range(len(df.columns))]
    at = names[df.columns.index(text)]
    plain = df.toDF(*names)
    found = with_common(
        plain.withColumnRenamed(at, "text"), names[df.columns.index(doc_id)], "text", **how
    )
    keep = [n if n != at else "text" for n in names]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        new = [None if old is None else r[0] for old, r in zip(batch.column("text").to_pylist(), stripped(batch), strict=True)]
        columns = [pa.array(new, pa.string()) if n == "text" else batch.column(n) for n in keep]
        return pa.RecordBatch.from_arrays(columns, keep)

    schema = found.select(*keep).schema
    return found.select(*keep, "common").mapInArrow(by_batch(run), schema).toDF(*df.columns)

"""Shared working folders: everything written between jobs goes where all executors can read it."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Where the setting is absent, as in local tests, a folder of this machine is set instead; on a cluster,
    whose executors couldn't read it, that is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="millrace-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


#: Where ``settled`` collects the paths that its own calls are given; each thread has its own.
_collected: ContextVar[list[str] | None] = ContextVar("collected", default=None)


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder, removed when the driver's JVM ends."""
    path = f"{shared_dir(spark)}/millrace/{label}-{uuid.uuid4().hex}"
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    collected = _collected.get()
    if collected is not None:
        collected.append(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Removes a working folder that nothing reads any more."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def saved(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = work_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(spark: SparkSession, label: str, make: Callable[[], DataFrame]) -> tuple[DataFrame, str]:
    """What ``make`` gives, saved, and its path; what was saved on the way to it, by calls of its own, is removed."""
    path = work_path(spark, label)
    made: list[str] = []
    outer = _collected.set(made)
    try:
        df = make()
        df.write.parquet(path)
    finally:
        _collected.reset(outer)
    for done in made:
        remove(spark, done)
    return spark.read.schema(df.schema).parquet(path), path

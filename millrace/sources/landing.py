"""Landing files: one JSON document a file, read whole as VARIANT, and written atomically."""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def documents(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, document): each file's JSON; a file that doesn't parse has a null document."""
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return raw.select("path", F.try_parse_json("value").alias("document"))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path, or any path of a glob, is there, in whatever store it names."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at)
    return found is not None and len(found) > 0


def read_json(spark: SparkSession, path: str) -> object | None:
    """A small JSON file, read by the driver; None if it isn't there."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        return json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def listing(spark: SparkSession, path: str) -> DataFrame:
    """(path) of the files of a glob, without reading them; none gives an empty frame."""
    if not exists(spark, path):
        return spark.createDataFrame([], "path string")
    return spark.read.format("binaryFile").load(path).select("path")


def rounds(df: DataFrame) -> DataFrame:
    """With the round that the file's name holds."""
    return df.withColumn("round", F.regexp_extract("path", r"gw_(\d+)(?:\.\d+)?\.json$", 1).try_cast("bigint"))


def players(df: DataFrame) -> DataFrame:
    """With the player that the file's name holds."""
    return df.withColumn("player", F.regexp_extract("path", r"(\d+)\.json$", 1).try_cast("bigint"))


def write_json(spark: SparkSession, path: str, payload: object, replace: bool = True) -> None:
    """Writes beside the target and renames in one step, so that readers see all of the old or all of the new.

    Without ``replace`` a file that is there already is an error, and stays as it is.
    """
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    target = fs.makeQualified(target)
    beside = target.suffix(f".{uuid.uuid4().hex}.tmp")
    out = fs.create(beside, False)
    try:
        out.write(bytearray(json.dumps(payload, indent=2, ensure_ascii=False).encode()))
    finally:
        out.close()
    kinds = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(kinds, 1)
    how[0] = kinds.OVERWRITE if replace else kinds.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(beside, target, how)
    except Exception as e:
        fs.delete(beside, False)
        raise OSError(f"can't write {path}") from e


def move(spark: SparkSession, old: str, new: str) -> None:
    """Renames a folder, whose new parent is made if it isn't there."""
    jvm = spark._jvm
    at, to = jvm.org.apache.hadoop.fs.Path(old), jvm.org.apache.hadoop.fs.Path(new)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(to.getParent())
    if not fs.rename(at, to):
        raise OSError(f"can't rename {old}")


VERSION = "{}/manifest-{:012d}.json"


def newest(spark: SparkSession, folder: str) -> tuple[int, object | None]:
    """Number and content of the folder's highest version; 0 and None before the first."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(f"{folder}/manifest-*.json")
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at) or []
    numbers = [int(m[1]) for f in found if (m := re.fullmatch(r"manifest-(\d+)\.json", f.getPath().getName()))]
    return (max(numbers), read_json(spark, VERSION.format(folder, max(numbers)))) if numbers else (0, None)


def commit(spark: SparkSession, folder: str, number: int, payload: object) -> None:
    """Makes ``payload`` version ``number``; an error if another writer has made that version."""
    write_json(spark, VERSION.format(folder, number), payload, replace=False)

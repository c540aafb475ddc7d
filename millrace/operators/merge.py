"""Keyed merges as union and window: one shuffle by key, the winner kept, the rest pruned before it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W


def latest(df: DataFrame, key: list[str], *order: Column) -> DataFrame:
    """One row for each key: the first by ``order``, which should end in a unique column."""
    nth = F.row_number().over(W.Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("__nth", nth).where(F.col("__nth") == 1).drop("__nth")


def first_of_few(df: DataFrame, key: list[str], *order: Column) -> DataFrame:
    """As ``latest``, for keys that have a few rows each, such as a table's parts.

    Spark sorts the input of a filter on row numbers before its shuffle too, to leave rows out early; here
    that would hold all rows of a file in memory and leave none out.
    """
    before = F.lag(F.lit(True)).over(W.Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("__before", before).where(F.col("__before").isNull()).drop("__before")


def upsert(existing: DataFrame, incoming: DataFrame, key: list[str], sequence: list[str]) -> DataFrame:
    """All keys of both; a key of ``incoming`` replaces the whole row, its last by ``sequence`` winning.

    Nulls overwrite too. ``incoming`` has the columns of ``existing`` and the sequence columns.
    """
    columns = existing.columns
    old = existing.select(*columns, F.lit(0).alias("__new"), *[F.lit(None).cast(incoming.schema[s].dataType).alias(s) for s in sequence])
    new = incoming.select(*columns, F.lit(1).alias("__new"), *sequence)
    order = [F.desc("__new"), *[F.desc_nulls_last(s) for s in sequence]]
    return latest(old.unionByName(new), key, *order).select(*columns)


def insert_or_ignore(existing: DataFrame, incoming: DataFrame, key: list[str], sequence: list[str]) -> DataFrame:
    """All rows of ``existing``, and of the keys it lacks the first row of ``incoming``."""
    first = latest(incoming, key, *[F.asc_nulls_first(s) for s in sequence])
    return existing.unionByName(first.join(existing.select(*key), key, "left_anti").select(*existing.columns))


def repeated_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that more than one row has, for the check after a write."""
    return df.groupBy(*key).agg(F.count("*").alias("rows")).where("rows > 1")

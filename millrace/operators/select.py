"""Structural operators: projections, explodes, incremental selection, set operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def drop_prefix(df: DataFrame, prefix: str) -> DataFrame:
    """Without the columns whose name starts with ``prefix``."""
    return df.select(*[f"`{c}`" for c in df.columns if not c.startswith(prefix)])


def sides(df: DataFrame, keep: list[str], pairs: dict[str, str], side: str = "side", value: str = "value") -> DataFrame:
    """Unpivot: one row for each side, in the order given."""
    each = F.array(*[F.struct(F.lit(k).alias(side), F.col(c).alias(value)) for k, c in pairs.items()])
    return df.select(*keep, F.explode(each).alias("__side")).select(*keep, f"__side.{side}", f"__side.{value}")


def pending(wanted: DataFrame, done: DataFrame, key: list[str], always: Column) -> DataFrame:
    """Incremental selection: what isn't done yet, and what is always read again."""
    return wanted.join(done.select(*key), key, "left_anti").unionByName(wanted.where(always)).dropDuplicates(key)


def already_done(wanted: DataFrame, done: DataFrame, key: list[str]) -> DataFrame:
    return wanted.join(done.select(*key), key, "left_semi")


def current_round(rounds: DataFrame, number: str, is_current: str, is_next: str, finished: str) -> DataFrame:
    """One row: the current round, else the one before the next, else the last finished one."""
    at = F.min(F.when(F.col(is_current), F.col(number)))
    before = F.min(F.when(F.col(is_next), F.col(number))) - 1
    last = F.max(F.when(F.col(finished), F.col(number)))
    return rounds.agg(F.coalesce(at, before, last).alias("current_round"))


def status(strict: Column, errors: Column, skipped: Column) -> Column:
    """FAILED if a strict gate closed or for errors, FAILED_PARTIAL for skipped records, else SUCCESS."""
    trouble = strict | (errors > 0)
    return F.when(trouble, "FAILED").when(skipped > 0, "FAILED_PARTIAL").otherwise("SUCCESS")

"""Scalar functions of the data model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels of the position codes.
POSITIONS = {1: "GKP", 2: "DEF", 3: "MID", 4: "FWD"}


def cost_in_millions(cost: Column) -> Column:
    """Prices are tenths of millions."""
    return cost / F.lit(10.0)


def position(code: Column) -> Column:
    """Label of a position code, ``UNK`` for any other."""
    pairs = [F.lit(x) for pair in POSITIONS.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), code.cast("int")), F.lit("UNK"))


def display_name(short: Column, first: Column, second: Column) -> Column:
    """The short name, or first and second if that is null or empty."""
    return F.coalesce(F.nullif(short, F.lit("")), F.concat_ws(" ", first, second))


def skip_percent(skipped: Column, fetched: Column) -> Column:
    """Share of skipped records in percent with one decimal, null if nothing was fetched."""
    return F.round(F.lit(100.0) * skipped / F.nullif(fetched, F.lit(0)), 1)


def parsed_deadline(text: Column) -> Column:
    """ISO text, with Z or an offset, as a timestamp; null if it isn't one."""
    return F.try_to_timestamp(F.replace(text, F.lit("Z"), F.lit("+00:00")))

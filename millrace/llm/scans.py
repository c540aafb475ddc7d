"""Running totals over groups of any size: rows are sorted over range partitions, and what each partition
holds of a group is carried into the next ones, so that no group has to be in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from millrace.storage import saved

#: Columns of a layout: the range partition, and the row's place over all of them.
PART, ROW = "__part", "__row"


def laid_out(df: DataFrame, group: list[str], order: list[str], label: str) -> DataFrame:
    """``df`` sorted by ``group`` and ``order`` (nulls first), saved, with ``PART`` and ``ROW``.

    ``df`` should be read from files: rows equal in all of these are told apart by their place there, so
    they spread over partitions too. Group columns must not be null.
    """
    keys = [F.asc_nulls_first(c) for c in [*group, *order, "__tie"]]
    placed = df.withColumn("__tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys).drop("__tie")
    return saved(placed.withColumn(ROW, F.monotonically_increasing_id()).withColumn(PART, F.shiftright(ROW, 33)), label)


def running(rows: DataFrame, group: list[str], totals: dict[str, tuple[str, Column]], backwards: bool = False, before: bool = False) -> DataFrame:
    """Rows of a layout with a running total for each of ``totals``: name to ("sum", "xor" or "last", expression).

    A total is over the rows of the group up to the own one, or ``before`` it; ``backwards``: from the group's
    end. A sum of nothing is 0, and so is the xor; "last" is the last value that isn't null. Expressions see
    the layout's columns only.
    """
    merge = {"sum": F.sum, "xor": F.bit_xor, "last": lambda c: F.last(c, ignorenulls=True)}
    end = F.min_by if backwards else F.max_by
    turned = F.desc if backwards else F.asc
    values = {name: f"__v_{name}" for name in totals}
    valued = rows.withColumns({values[name]: e for name, (_, e) in totals.items()})

    def whole(name: str, kind: str) -> Column:
        v = F.col(values[name])
        return (end(v, F.when(v.isNotNull(), F.col(ROW))) if kind == "last" else merge[kind](v)).alias(name)

    parts = valued.groupBy(PART, *group).agg(*[whole(name, kind) for name, (kind, _) in totals.items()])
    earlier = W.Window.partitionBy(*group).orderBy(turned(PART)).rowsBetween(W.Window.unboundedPreceding, -1)
    carried = parts.select(PART, *group, *[merge[kind](name).over(earlier).alias(f"__c_{name}") for name, (kind, _) in totals.items()])
    within = W.Window.partitionBy(PART, *group).orderBy(turned(ROW)).rowsBetween(W.Window.unboundedPreceding, -1 if before else 0)
    joined = valued.join(carried, [PART, *group])
    found = {}
    for name, (kind, _) in totals.items():
        own, past = merge[kind](values[name]).over(within), F.col(f"__c_{name}")
        if kind == "last":
            found[name] = F.coalesce(own, past)
        else:
            own, past = F.coalesce(own, F.lit(0)), F.coalesce(past, F.lit(0))
            found[name] = own + past if kind == "sum" else own.bitwiseXOR(past)
    return joined.withColumns(found).drop(*values.values(), *[f"__c_{name}" for name in totals])

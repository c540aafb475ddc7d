"""The directory of a stored table's buckets: which rows go where, which parts a read needs, how a bucket splits.

A row's address has ``SLOT_BITS`` bits by the column that rows arrive by (``Table.bucket_by``), then bits by the
whole key. A bucket is a prefix of addresses; the buckets of a table cover all of them. So rows that arrive
together lie together, and a bucket whose rows share that column splits by their keys.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.plans.contract import Table

BUCKET = "__bucket"
SLOT_BITS, KEY_BITS = 12, 48
BITS = SLOT_BITS + KEY_BITS
#: Longest text that is kept as a part's least or greatest value.
RANGE_TEXT = 64


@dataclass(frozen=True)
class Part:
    """A folder of a bucket's rows: how many, and by column the least and greatest value."""

    path: str
    rows: int = 0
    ranges: dict[str, list] = field(default_factory=dict)


@dataclass(frozen=True)
class Version:
    """What is visible of a table: the parts of each bucket, the earliest first; merges so far; what its files declare."""

    buckets: dict[str, list[Part]] = field(default_factory=lambda: {"": []})
    merges: int = 0
    shape: str = ""
    schema: str = ""
    key: list[str] = field(default_factory=list)
    cluster_by: list[str] = field(default_factory=list)
    not_null: list[str] = field(default_factory=list)

    @classmethod
    def of(cls, found: str | dict) -> Version:
        """From a manifest; one of an earlier layout is a single bucket without a shape, so that it is written anew."""
        if isinstance(found, str):
            return cls({"": [Part(found)]})
        if "parts" in found:
            return cls({"": [Part(path, rows) for path, rows in found["parts"].values()]} if len(found["parts"]) == 1 else {f"{i:b}".zfill(BITS): [Part(path, rows)] for i, (path, rows) in enumerate(found["parts"].values())})
        return cls(**found | {"buckets": {b: [Part(**p) for p in parts] for b, parts in found["buckets"].items()}})

    @property
    def paths(self) -> list[str]:
        return [p.path for parts in self.buckets.values() for p in parts]

    @property
    def rows(self) -> int:
        """Rows of all parts; a key that several of a bucket's parts hold counts in each."""
        return sum(p.rows for parts in self.buckets.values() for p in parts)


def empty(table: Table) -> Version:
    """A table without rows, as the contract wants it."""
    shape = f"{table.schema.simpleString()} by {table.bucket_by} of {','.join(table.key)}, {','.join(table.cluster_by)}, {SLOT_BITS}"
    required = [f.name for f in table.schema.fields if not f.nullable]
    return Version(shape=shape, schema=table.schema.simpleString(), key=list(table.key), cluster_by=list(table.cluster_by), not_null=required)


def typed(table: Table, name: str, value: Column | None = None) -> Column:
    return (F.col(name) if value is None else value).cast(table.schema[name].dataType)


def slot(table: Table, value: Column | None = None) -> Column:
    """The address' first bits, as a number."""
    return F.pmod(F.xxhash64(typed(table, table.bucket_by, value)), F.lit(1 << SLOT_BITS))


def address(table: Table, values: dict[str, Column] | None = None) -> Column:
    own = values or {c: F.col(c) for c in {*table.key, table.bucket_by}}
    by_key = F.xxhash64(*[typed(table, c, own[c]) for c in table.key]).bitwiseAND(F.lit((1 << KEY_BITS) - 1))
    return F.shiftleft(slot(table, own[table.bucket_by]), KEY_BITS).bitwiseOR(by_key)


def bits(number: Column, n: int) -> Column:
    return F.lpad(F.bin(number), n, "0")


def address_bits(spark: SparkSession, table: Table, exact: dict[str, object]) -> str:
    """The bits of an address that given values settle: all for the whole key, the slot's for the layout's column, or none."""
    own = {c: F.lit(v) for c, v in exact.items()}
    if {*table.key, table.bucket_by} <= exact.keys():
        found = bits(address(table, own), BITS)
    elif table.bucket_by in exact:
        found = bits(slot(table, own[table.bucket_by]), SLOT_BITS)
    else:
        return ""
    return spark.range(1).select(found).first()[0]


def routed(rows: DataFrame, table: Table, leaves: list[str], nth: str | None = None) -> DataFrame:
    """``rows`` with the bucket, out of ``leaves``, that their address starts with, and as ``nth`` its place among them.

    The leaves have few different lengths: a row asks for its prefix of each, and one of them is there. The
    directory has a row for each bucket, some 50,000 at 100 TB.
    """
    if leaves == [""]:
        return rows.withColumns({BUCKET: F.lit("")} | ({nth: F.lit(0)} if nth else {}))
    lengths = sorted({len(b) for b in leaves})
    listed = ", ".join(f"({len(b)}, {int(b or '0', 2)}L, '{b}', {i})" for i, b in enumerate(leaves))
    directory = rows.sparkSession.sql(f"SELECT * FROM VALUES {listed} AS t(__length, __prefix, {BUCKET}, {nth or '__nth'})")
    if not nth:
        directory = directory.drop("__nth")
    asked = rows.withColumn("__at", address(table)).withColumn("__length", F.explode(F.lit(lengths)))
    asked = asked.withColumn("__prefix", F.expr(f"shiftright(__at, {BITS} - __length)"))
    return asked.join(directory, ["__length", "__prefix"]).drop("__at", "__length", "__prefix")


def planned(bucket: str, slots: dict[int, int], most: int) -> list[str]:
    """The buckets that ``bucket``, with so many rows in each slot, becomes so that each has about ``most`` rows at most.

    Within a slot rows lie evenly, since their bits come from their keys' hash. Addresses of 60 bits end the splits.
    """
    waiting, out = [(bucket, float(sum(slots.values())))], []
    while waiting:
        b, rows = waiting.pop()
        if rows <= most or len(b) == BITS:
            out.append(b)
        elif len(b) < SLOT_BITS:
            left = SLOT_BITS - len(b) - 1
            for half in (f"{b}1", f"{b}0"):
                waiting.append((half, float(sum(n for s, n in slots.items() if s >> left == int(half, 2)))))
        else:
            waiting += [(f"{b}1", rows / 2), (f"{b}0", rows / 2)]
    return out


def is_full(parts: list[Part], most: int, deltas: int) -> bool:
    """Whether a bucket should be folded: many deltas, or perhaps twice the rows that it should have."""
    return len(parts) > deltas + 1 or sum(p.rows for p in parts) > 2 * most


def range_columns(table: Table) -> list[str]:
    return list(dict.fromkeys([*table.key, *table.cluster_by]))


def ranges(table: Table, of: Column | None = None) -> list[Column]:
    """Aggregates: least and greatest value of the columns that reads are pruned by."""
    own = lambda c: F.col(c) if of is None else F.when(of, F.col(c))
    return [f(own(c)).alias(f"{name}_{c}") for c in range_columns(table) for name, f in (("low", F.min), ("high", F.max))]


def range_of(table: Table, found: dict) -> dict[str, list]:
    """From a row of these aggregates; long texts, and values that JSON has no form for, are left out."""
    out = {}
    for c in range_columns(table):
        low, high = found.get(f"low_{c}"), found.get(f"high_{c}")
        if all(isinstance(v, (int, float)) or isinstance(v, str) and len(v) <= RANGE_TEXT for v in (low, high)):
            out[c] = [low, high]
    return out


def pruned(version: Version, table: Table, bounds: dict[str, tuple], known: str) -> Version:
    """The parts that can hold rows within ``bounds`` whose addresses start with ``known``.

    A part's rows of other keys can't matter, so ranges of key columns rule out single parts. Those of other
    columns rule out a bucket as a whole only, since a later part may hold another value for a key.
    """

    def may(part: Part, column: str) -> bool:
        low, high = bounds[column]
        least, greatest = part.ranges.get(column, (None, None))
        return least is None or not (low is not None and greatest < low or high is not None and least > high)

    found = {}
    for b, parts in version.buckets.items():
        n = min(len(b), len(known))
        if b[:n] == known[:n]:
            own = [p for p in parts if all(may(p, c) for c in bounds if c in table.key)]
            if all(any(may(p, c) for p in own) for c in bounds if c not in table.key):
                found[b] = own
    return Version(**{**version.__dict__, "buckets": found})

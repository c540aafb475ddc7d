"""The contract: tables, columns, keys and drop rules, and what is compiled from it."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from functools import lru_cache

from pyspark.sql import types as T

SPARK_TYPES = {"int": "BIGINT", "float": "DOUBLE", "str": "STRING", "bool": "BIGINT"}
VERSION = "1.0.0"
#: Stamped at write; not part of a record.
SYSTEM_COLUMNS = ("ingested_at",)


@dataclass(frozen=True)
class Column:
    """A column: type, whether null is allowed, and what stands for a missing key."""

    name: str
    type: str
    nullable: bool = False
    required: bool = True
    default: object = None
    aliases: tuple[str, ...] = ()

    @property
    def inputs(self) -> tuple[str, ...]:
        return (self.name, *self.aliases)

    @property
    def ddl(self) -> str:
        return f"{self.name} {SPARK_TYPES[self.type]}" + ("" if self.nullable else " NOT NULL")


@dataclass(frozen=True)
class Table:
    """A table: columns, key, how its rows are laid out, and keys of the raw record that are dropped."""

    name: str
    columns: tuple[Column, ...]
    key: tuple[str, ...]
    grain: str
    cluster_by: tuple[str, ...] = ()
    drop_keys: tuple[str, ...] = ()
    drop_prefixes: tuple[str, ...] = ()
    notes: dict[str, str] = field(default_factory=dict, hash=False)

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns] + list(SYSTEM_COLUMNS)

    @property
    def schema(self) -> T.StructType:
        """Columns as persisted; the system columns are nullable text."""
        own = [T.StructField(c.name, T._parse_datatype_string(SPARK_TYPES[c.type]), c.nullable, {"note": self.notes.get(c.name, "")}) for c in self.columns]
        return T.StructType([*own, *(T.StructField(s, T.StringType(), True, {"source": "system"}) for s in SYSTEM_COLUMNS)])

    @property
    def bucket_by(self) -> str:
        """The column whose hash deals the rows into buckets: the first of the layout that is in the key, or the key's first."""
        return next((c for c in self.cluster_by if c in self.key), self.key[0])

    def create_sql(self, database: str, partition: str | None = None, location: str | None = None) -> str:
        """``partition``: a text column behind the contract's that the table's folders are told apart by."""
        columns = ",\n  ".join([c.ddl for c in self.columns] + [f"{s} STRING" for s in SYSTEM_COLUMNS] + [f"{partition} STRING"] * bool(partition))
        required = ",".join(c.name for c in self.columns if not c.nullable)
        properties = f"'millrace.not_null' = '{required}', 'millrace.key' = '{','.join(self.key)}', 'millrace.grain' = '{self.grain}', 'millrace.cluster_by' = '{','.join(self.cluster_by)}'"
        where = f"PARTITIONED BY ({partition})\n" * bool(partition) + f"LOCATION '{location}'\n" * bool(location)
        return f"CREATE TABLE IF NOT EXISTS {database}.{self.name} (\n  {columns}\n) USING parquet\n{where}TBLPROPERTIES ({properties})"

    def add_column_sql(self, database: str, name: str) -> str:
        """Additive migration: only a nullable column that isn't in the key can be added."""
        known = {c.name: c for c in self.columns}
        if name not in SYSTEM_COLUMNS and (not known[name].nullable or name in self.key):
            raise RuntimeError(f"{self.name}.{name} needs a manual migration")
        kind = "STRING" if name in SYSTEM_COLUMNS else SPARK_TYPES[known[name].type]
        return f"ALTER TABLE {database}.{self.name} ADD COLUMNS ({name} {kind})"


def columns(spec: str) -> tuple[Column, ...]:
    """Columns from ``name:type`` items: ``?`` nullable and null if missing, ``=x`` default, ``!?`` nullable but required, ``<alias``."""
    out = []
    for item in spec.split():
        name, kind = item.split(":")
        kind, _, alias = kind.partition("<")
        kind, has_default, default = kind.partition("=")
        nullable, forced = kind.endswith("?"), kind.endswith("!?")
        kind = kind.rstrip("?").rstrip("!")
        value = {"int": int, "float": float, "str": str, "bool": lambda x: x == "true"}[kind](default) if has_default else None
        out.append(Column(name, kind, nullable, not has_default and (forced or not nullable), value, (alias,) if alias else ()))
    return tuple(out)


@dataclass(frozen=True)
class Contract:
    """All tables by name, and the artifacts made from them."""

    tables: tuple[Table, ...]
    version: str = VERSION

    def __getitem__(self, name: str) -> Table:
        return next(t for t in self.tables if t.name == name)

    def as_dict(self) -> dict:
        """The schema contract: tables by name, columns in order."""
        of = lambda c: {"name": c.name, "type": SPARK_TYPES[c.type], "nullable": c.nullable, "primary_key": False, "source": "model"}
        system = [{"name": s, "type": "STRING", "nullable": True, "primary_key": False, "source": "system"} for s in SYSTEM_COLUMNS]
        tables = {}
        for t in sorted(self.tables, key=lambda t: t.name):
            own = [of(c) | {"primary_key": t.key == (c.name,)} for c in t.columns]
            tables[t.name] = {"grain": t.grain, "key": list(t.key), "cluster_by": list(t.cluster_by), "columns": own + system}
        return {"version": self.version, "tables": tables}

    def as_json(self) -> str:
        return json.dumps(self.as_dict(), indent=2, sort_keys=True) + "\n"

    def rules_json(self) -> str:
        """What a validator needs: required and nullable columns, keys, allowed input names."""
        rules = {
            t.name: {
                "required": [c.name for c in t.columns if c.required], "nullable": [c.name for c in t.columns if c.nullable],
                "unique": list(t.key), "allowed": [k for c in t.columns for k in c.inputs], "dropped": list(t.drop_keys), "dropped_prefixes": list(t.drop_prefixes),
            }
            for t in self.tables
        }
        return json.dumps(rules, indent=2, sort_keys=True) + "\n"

    def ddl(self, database: str) -> str:
        return ";\n\n".join(t.create_sql(database) for t in self.tables) + ";\n"

    def probes(self) -> list[dict]:
        """Cases for generated tests: per table a column without which, or null in which, a row is refused."""
        out = []
        for t in self.tables:
            out += [{"table": t.name, "column": c.name, "case": "missing"} for c in t.columns if c.required]
            out += [{"table": t.name, "column": c.name, "case": "null"} for c in t.columns if not c.nullable]
            out.append({"table": t.name, "column": ",".join(t.key), "case": "unique"})
        return out


@lru_cache(maxsize=1)
def compiled() -> Contract:
    from millrace.plans.tables import TABLES

    return Contract(TABLES)

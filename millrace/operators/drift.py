"""Contract against live tables: what is missing, extra or different, and additive migration."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.coerce import quoted
from millrace.plans.contract import Contract, Table

REPORT = "table_name string, column_name string, kind string, expected string, actual string"


def type_name(kind: T.DataType) -> str:
    return kind.simpleString().upper()


def column_differences(wanted: list[tuple[str, str, str]], live: dict[str, T.StructType]) -> list[tuple]:
    """(table, column, kind, expected, actual) of each column that differs: kind is missing, extra or type (compared without case).

    The full outer join of two catalogues, which are on the driver anyway and have a row for each column.
    """
    expected = {(table, column): kind for table, column, kind in wanted}
    actual = {(table, f.name): type_name(f.dataType) for table, schema in live.items() for f in schema.fields}
    found = []
    for at in sorted(expected.keys() | actual.keys()):
        want, has = expected.get(at), actual.get(at)
        if want is None or has is None or want.upper() != has.upper():
            found.append((*at, "missing" if has is None else "extra" if want is None else "type", want, has))
    return found


def column_report(spark: SparkSession, wanted: list[tuple[str, str, str]], live: dict[str, T.StructType]) -> DataFrame:
    """One row for each column that differs."""
    return spark.createDataFrame(column_differences(wanted, live), REPORT)


@dataclass(frozen=True)
class LiveTable:
    """What a stored table declares."""

    schema: T.StructType
    key: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()


@dataclass
class Report:
    """valid, drift (extra columns only) or invalid, with the reasons."""

    status: str
    missing_tables: list[str] = field(default_factory=list)
    missing_columns: list[str] = field(default_factory=list)
    extra_columns: list[str] = field(default_factory=list)
    type_mismatches: list[str] = field(default_factory=list)
    constraint_mismatches: list[str] = field(default_factory=list)

    @property
    def exit_code(self) -> int:
        return {"valid": 0, "invalid": 1, "drift": 2}[self.status]


def validate(contract: Contract, live: dict[str, LiveTable]) -> Report:
    """Tables, columns, types, nullability, keys and layout of ``live`` against the contract; other tables are ignored."""
    report = Report("valid", missing_tables=sorted(t.name for t in contract.tables if t.name not in live))
    own = [t for t in contract.tables if t.name in live]
    wanted = [(t.name, f.name, type_name(f.dataType)) for t in own for f in t.schema.fields]
    lists = {"missing": report.missing_columns, "extra": report.extra_columns, "type": report.type_mismatches}
    for table, column, kind, *_ in column_differences(wanted, {t.name: live[t.name].schema for t in own}):
        lists[kind].append(f"{table}.{column}")
    for t in own:
        found = live[t.name]
        names = {f.name: f for f in found.schema.fields}
        report.constraint_mismatches += [
            f"{t.name}.{f.name}: nullable" for f in t.schema.fields if f.name in names and f.nullable != names[f.name].nullable
        ]
        if set(found.key) != set(t.key):
            report.constraint_mismatches.append(f"{t.name}: key")
        if set(found.cluster_by) != set(t.cluster_by):
            report.constraint_mismatches.append(f"{t.name}: layout")
    wrong = report.missing_tables or report.missing_columns or report.type_mismatches or report.constraint_mismatches
    report.status = "invalid" if wrong else "drift" if report.extra_columns else "valid"
    return report


#: JSON types that a contract type takes.
TAKES = {"int": "^(BIGINT|DECIMAL|DOUBLE|FLOAT|STRING|BOOLEAN)", "float": "^(BIGINT|DECIMAL|DOUBLE|FLOAT|STRING|BOOLEAN)", "str": "^STRING", "bool": "^(BOOLEAN|BIGINT|STRING)"}


def observed(df: DataFrame, table: Table, record: str = "record") -> DataFrame:
    """What VARIANT records hold against the contract, a row for each column: n_missing, n_null, n_other (of a type that it doesn't take), types seen.

    One pass and one aggregate of a row a column; a record that isn't an object lacks every column.
    """
    kind = lambda c: F.expr("coalesce(" + ", ".join(f"schema_of_variant(try_variant_get(`{record}`, {quoted(f'$.{k}')}, 'variant'))" for k in c.inputs) + ")")
    each = F.array(*[F.struct(F.lit(c.name).alias("column_name"), F.lit(c.type).alias("expected"), F.lit(TAKES[c.type]).alias("takes"), kind(c).alias("kind")) for c in table.columns])
    seen = df.select(F.explode(each).alias("x")).select("x.*")
    short = F.regexp_extract("kind", "^[A-Z]+", 0)
    return seen.groupBy("column_name", "expected").agg(
        F.count_if(F.col("kind").isNull()).alias("n_missing"),
        F.count_if(F.col("kind") == "VOID").alias("n_null"),
        F.count_if((F.col("kind") != "VOID") & ~F.regexp_like("kind", F.col("takes"))).alias("n_other"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("kind") != "VOID", short))), ",").alias("types"),
    )


def migrated(df: DataFrame, contract_table, defaults: dict[str, object] | None = None) -> DataFrame:
    """``df`` with the contract's missing columns as nulls; one that may not be null needs a manual migration."""
    known = {c.name: c for c in contract_table.columns}
    for f in contract_table.schema.fields:
        if f.name in df.columns:
            continue
        if f.name in known and (not known[f.name].nullable or f.name in contract_table.key):
            raise RuntimeError(f"{contract_table.name}.{f.name} needs a manual migration")
        df = df.withColumn(f.name, F.lit((defaults or {}).get(f.name)).cast(f.dataType))
    return df

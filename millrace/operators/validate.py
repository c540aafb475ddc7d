"""Row validation against a contract: expressions that list a row's errors, in a single pass.

A raw record is a VARIANT. For every contract column there is a value and perhaps an error; a row with
no error is valid, the others are set aside with their reasons.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from millrace.functions.coerce import COERCE, listed, quoted
from millrace.plans.contract import Column, Table

PERSISTED = {"int": "bigint", "float": "double", "str": "string", "bool": "bigint"}
VALIDATED = {"int": "bigint", "float": "double", "str": "string", "bool": "boolean"}


def unknown_keys(keys: str, allowed: list[str], prefixes: tuple[str, ...] = ()) -> str:
    """SQL text: those of ``keys``, an array, that are neither allowed nor start with one of the dropped prefixes."""
    rest = f"array_except({keys}, array({listed(allowed)}))"
    dropped = " OR ".join(f"startswith(k, {quoted(p)})" for p in prefixes)
    return f"filter({rest}, k -> NOT ({dropped}))" if prefixes else rest


def spec(c: Column) -> str:
    """SQL text of what a cell needs to know of its contract column; a null message is no error."""
    default = "NULL" if c.required or c.default is None else quoted(str(int(c.default) if c.type == "bool" else c.default))
    n, d, t = (default if c.type in types else "NULL" for types in (("int", "bool"), ("float",), ("str",)))
    absent = f"named_struct('given', false, 'k', CAST(NULL AS STRING), 'n', CAST({n} AS BIGINT), 'd', CAST({d} AS DOUBLE), 't', CAST({t} AS STRING))"
    own = {
        "type": quoted(c.type), "absent": absent, "missing": quoted(f"{c.name}: missing") if c.required else "CAST(NULL AS STRING)",
        "void": "CAST(NULL AS STRING)" if c.nullable else quoted(f"{c.name}: null"), "other": quoted(f"{c.name}: not {c.type}"),
    }
    return f"named_struct({', '.join(f'{quoted(k)}, {v}' for k, v in own.items())})"


#: A value coerced to its column's type, in the field of that type; a key that the record lacks has its default.
OF_TYPE = {t: f(*("r.v", "r.k")) for t, f in COERCE.items()}
CELL = f"""CASE WHEN r IS NULL THEN s.absent
ELSE named_struct('given', true, 'k', r.k, 'n', CASE WHEN s.type = 'int' THEN {OF_TYPE['int']} WHEN s.type = 'bool' THEN CAST({OF_TYPE['bool']} AS BIGINT) END,
'd', CASE WHEN s.type = 'float' THEN {OF_TYPE['float']} END, 't', CASE WHEN s.type = 'str' THEN {OF_TYPE['str']} END) END"""
#: What is wrong with it: lacking, an explicit null, or not of the type; null if nothing is.
ERROR = """CASE WHEN NOT c.given THEN s.missing WHEN c.k = 'VOID' THEN s.void
WHEN c.n IS NULL AND c.d IS NULL AND c.t IS NULL THEN s.other END"""
FIELD = {"int": "n", "bool": "n", "float": "d", "str": "t"}


def checked(df: DataFrame, table: Table, record: str = "record", persisted: bool = True) -> DataFrame:
    """``df`` with a column for each contract column and ``_errors``, an array of reasons.

    A missing key takes its default, or is an error if it has none; an explicit null is an error where
    the column isn't nullable; a value that can't be coerced is an error. A record that isn't a JSON
    object has one error. Of two names for one column only one may be given.

    All values are taken from the record at once and lie in an array, in the contract's order, over which
    one function types and coerces them. An expression of its own for each of a hundred columns would be
    planned for seconds, and the method that Spark makes of them is too large for the JVM to compile.
    """
    own = [f"`{c}`" for c in df.columns]
    names = list(dict.fromkeys(k for c in table.columns for k in c.inputs))
    inside = f"try_variant_get(`{record}`, '$', {quoted(f'struct<{", ".join(f"`{k}`: variant" for k in names)}>')}) AS __in"
    keys = f"map_keys(try_variant_get(`{record}`, '$', 'map<string,struct<>>')) AS __keys"  # of no type that would be copied
    raw = [[f"__in.`{k}`" for k in c.inputs] for c in table.columns]
    values = f"array({', '.join(f'coalesce({", ".join(r)})' if len(r) > 1 else r[0] for r in raw)})"
    specs = f"array({', '.join(map(spec, table.columns))})"
    cells = f"zip_with(transform({values}, v -> CASE WHEN v IS NOT NULL THEN named_struct('v', v, 'k', schema_of_variant(v)) END), {specs}, (r, s) -> {CELL}) AS __cells"
    unknown = unknown_keys("__keys", [*names, *table.drop_keys], table.drop_prefixes)
    clean = ["__keys IS NOT NULL", "size(__unknown) = 0", "NOT exists(__wrong, e -> e IS NOT NULL)"]
    wrong, found, upto = f"CASE WHEN __keys IS NULL THEN CAST(array() AS array<string>) ELSE zip_with(__cells, {specs}, (c, s) -> {ERROR}) END", [], 0
    for i, (c, r) in enumerate(zip(table.columns, raw, strict=True), 1):
        if c.aliases:  # said behind what else is wrong with the column
            times = " + ".join(f"CAST({x} IS NOT NULL AS INT)" for x in r)
            found += [f"slice(__wrong, {upto + 1}, {i - upto})", f"array(CASE WHEN {times} > 1 THEN {quoted(f'{c.name}: given twice')} END)"]
            upto = i
            clean.append(f"{times} <= 1")
    found.append(f"slice(__wrong, {upto + 1}, {len(raw) - upto})" if upto else "__wrong")
    first = "array(CASE WHEN __keys IS NULL THEN 'not an object' END, CASE WHEN size(__unknown) > 0 THEN concat('unknown: ', array_join(__unknown, ', ')) END)"
    kinds = PERSISTED if persisted else VALIDATED
    columns = [f"CAST(__cells[{i}].{FIELD[c.type]} AS {kinds[c.type]}) AS `{c.name}`" for i, c in enumerate(table.columns)]
    taken = df.selectExpr(*own, inside, keys).selectExpr("*", cells, f"{unknown} AS __unknown").selectExpr("*", f"{wrong} AS __wrong")
    # most rows have no reasons to put together
    errors = f"CASE WHEN {' AND '.join(clean)} THEN CAST(array() AS array<string>) ELSE array_compact(concat({', '.join([first, *found])})) END AS _errors"
    return taken.selectExpr(*own, *columns, errors)


def split(checked_rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, set aside) of rows with ``_errors``."""
    return checked_rows.where(F.size("_errors") == 0).drop("_errors"), checked_rows.where(F.size("_errors") > 0)


def counts(df: DataFrame, valid: SparkColumn, *by: str) -> DataFrame:
    """fetched, validated and skipped in one aggregate, by the columns given."""
    return df.groupBy(*by).agg(F.count("*").alias("fetched"), F.count_if(valid).alias("validated"), F.count_if(~valid).alias("skipped"))


@dataclass(frozen=True)
class Tally:
    """What a stage has read, found valid, written and met as errors; what isn't valid was skipped."""

    stage: str
    fetched: int = 0
    validated: int = 0
    written: int = 0
    errors: int = 0

    def __post_init__(self) -> None:
        if not self.fetched >= self.validated >= self.written >= 0 <= self.errors:
            raise ValueError(f"impossible counters: {self}")

    @classmethod
    def of(cls, stage: str, row: Row, written: int = 0, errors: int = 0) -> Tally:
        """From a row of ``counts``."""
        return cls(stage, row["fetched"], row["validated"], written, errors)

    def __add__(self, other: Tally) -> Tally:
        return Tally(self.stage, self.fetched + other.fetched, self.validated + other.validated, self.written + other.written, self.errors + other.errors)

    @property
    def skipped(self) -> int:
        return self.fetched - self.validated

    @property
    def trouble(self) -> str | None:
        """Why a strict run stops here; null if it needn't."""
        found = {"validation_error": self.errors, "skipped_records": self.skipped}
        return next((why for why, n in found.items() if n), None)

    def __str__(self) -> str:
        shown = {"read": self.fetched, "valid": self.validated, "written": self.written, "skipped": self.skipped, "errors": self.errors}
        return f"{self.stage}: " + ", ".join(f"{n} {what}" for what, n in shown.items())

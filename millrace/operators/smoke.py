"""Structural checks of landing documents: are the keys that the flatteners read still there?"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.plans.contract import Contract

#: Records of a list that are looked at.
SAMPLE = 5


@dataclass
class Outcome:
    """What didn't hold; nothing means that all did."""

    problems: list[str] = field(default_factory=list)

    @property
    def ok(self) -> bool:
        return not self.problems


def missing_keys(document: DataFrame, path: str, required: list[str], label: str) -> list[str]:
    """Of the first records at ``path``: required keys that one lacks; or that there is no list."""
    kind = F.schema_of_variant(F.try_variant_get("document", path, "variant"))
    got = document.select(kind.alias("kind"), F.try_variant_get("document", path, "array<variant>").alias("rows")).first()
    if got is None or got["kind"] is None:
        return [f"{label}: missing"]
    if not got["kind"].startswith("ARRAY"):
        return [f"{label}: not a list"]
    rows = document.select(F.explode(F.slice(F.try_variant_get("document", path, "array<variant>"), 1, SAMPLE)).alias("r"))
    keys = rows.select(F.array_except(F.array(*[F.lit(k) for k in required]), F.coalesce(F.json_object_keys(F.to_json("r")), F.expr("cast(array() as array<string>)"))).alias("m"))
    return [f"{label}: missing field {r[0]}" for r in keys.select(F.explode("m")).distinct().orderBy("col").collect()]


def required_inputs(contract: Contract, table: str) -> list[str]:
    return [c.name for c in contract[table].columns if c.required and not c.aliases]


def bootstrap(document: DataFrame, contract: Contract) -> Outcome:
    if document.isEmpty():
        return Outcome(["bootstrap: no document"])
    lists = {"elements": "players", "teams": "teams", "events": "events", "element_types": "element_types"}
    return Outcome([p for name, table in lists.items() for p in missing_keys(document, f"$.{name}", required_inputs(contract, table), name)])


def fixtures(document: DataFrame, contract: Contract) -> Outcome:
    if document.isEmpty():
        return Outcome(["fixtures: no document"])
    return Outcome(missing_keys(document, "$", required_inputs(contract, "fixtures"), "fixtures"))


def history(documents: DataFrame, contract: Contract) -> Outcome:
    """Of the first player with a history; empty histories pass, no player at all doesn't."""
    if documents.isEmpty():
        return Outcome(["history: no players"])
    filled = documents.where(F.size(F.try_variant_get("document", "$.history", "array<variant>")) > 0).orderBy("path").limit(1)
    if filled.isEmpty():
        return Outcome()
    return Outcome(missing_keys(filled, "$.history", required_inputs(contract, "player_histories"), "history"))

"""Flatteners: JSON documents to one VARIANT record per row, with the sequence that decides which row wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def items(df: DataFrame, document: str, path: str, keep: list[str], kind: str = "variant") -> DataFrame:
    """One row for each entry of the list at ``path``: ``record`` and ``pos``; no list gives no rows.

    ``kind``: what is taken of an entry; parts that aren't of it are null. Every level taken as VARIANT is a copy
    of all below it, so a nested entry is taken at once.
    """
    own = df.select(*keep, F.try_variant_get(document, path, f"array<{kind}>").alias("__items"))
    return own.select(*keep, F.posexplode("__items").alias("pos", "record"))


def bootstrap_list(df: DataFrame, name: str) -> DataFrame:
    """Records of one of the bootstrap document's lists."""
    return items(df, "document", f"$.{name}", ["path"])


def fixtures(df: DataFrame) -> DataFrame:
    return items(df, "document", "$", ["path"])


def live_elements(df: DataFrame, keep: tuple[str, ...] = ("path", "round")) -> DataFrame:
    """Records of a live round with the columns ``keep``: the element's id and the round, then its statistics, whose keys win.

    Entries that aren't objects or have no id are passed over. The round is the file's, not the payload's.
    """
    each = items(df, "document", "$.elements", list(keep), "struct<id: variant, stats: map<string,variant>>").select("*", "record.id")
    each = each.where(given("id")).select(*keep, "pos", "id", F.coalesce("record.stats", F.expr("cast(map() as map<string,variant>)")).alias("stats"))
    identity = F.create_map(F.lit("element_id"), F.col("id"), F.lit("round"), F.col("round").cast("bigint").cast("variant"))
    both = F.map_concat(F.map_filter(identity, lambda k, v: ~F.map_contains_key("stats", k)), "stats")
    return each.select(*keep, "pos", F.to_variant_object(both).alias("record"))


def fixture_stats(df: DataFrame) -> DataFrame:
    """Records of each statistic's entries: fixture, identifier, element, value and side, home before away.

    A fixture without an id gives none; a missing identifier is empty text.
    """
    entries = "array<struct<element: variant, value: variant>>"
    fixture = f"struct<id: variant, stats: array<struct<identifier: variant, h: {entries}, a: {entries}>>>"
    each = items(df, "document", "$", ["path"], fixture).select("path", F.col("pos").alias("pos_fixture"), "record.id", "record.stats")
    each = each.where(given("id")).select("path", "pos_fixture", "id", F.posexplode("stats").alias("pos_stat", "stat"))
    name = F.coalesce("stat.identifier", F.lit("").cast("variant"))
    both = F.array(*[F.struct(F.lit(i).alias("pos_side"), F.lit(s).alias("side"), F.col(f"stat.{s}").alias("entries")) for i, s in enumerate("ha")])
    one = each.select("path", "pos_fixture", "pos_stat", "id", name.alias("identifier"), F.explode(both).alias("x"))
    entry = one.select("path", "pos_fixture", "pos_stat", "x.pos_side", "id", "identifier", "x.side", F.posexplode("x.entries").alias("pos_entry", "entry"))
    own = ["path", "pos_fixture", "pos_stat", "pos_side", "pos_entry"]
    entry = entry.select(*own, "id", "identifier", "side", "entry.element", "entry.value")
    # a key that an entry lacks is lacking in its record; few do
    parts = {"fixture_id": F.col("id"), "identifier": F.col("identifier"), "element": F.col("element"), "value": F.col("value"), "side": F.col("side").cast("variant")}
    whole = F.struct(*[c.alias(k) for k, c in parts.items()])
    fields = F.map_from_arrays(F.array(*map(F.lit, parts)), F.array(*parts.values()))
    lacking = F.to_variant_object(F.map_filter(fields, lambda k, v: v.isNotNull()))
    record = F.when(F.col("element").isNotNull() & F.col("value").isNotNull(), F.to_variant_object(whole)).otherwise(lacking)
    return entry.select(*own, record.alias("record"))


def season_events(df: DataFrame) -> DataFrame:
    """Records of the season's rounds, with the top element's points and the chips as JSON text.

    No top element, or one without points: null. No chips, or an empty list: null.
    """
    each = items(df, "document", "$.events", ["path"], "map<string,variant>").withColumnRenamed("record", "base")
    each = each.where("base is not null").select("path", "pos", "base", F.element_at("base", "chip_plays").alias("plays"), F.try_variant_get(F.element_at("base", "top_element_info"), "$.points", "variant").alias("points"))
    null = F.parse_json(F.lit("null"))
    chips = F.when(F.size(F.try_variant_get("plays", "$", "array<variant>")) > 0, F.to_json("plays")).cast("variant")
    made = F.create_map(F.lit("top_element_points"), F.coalesce("points", null), F.lit("chip_plays_json"), F.coalesce(chips, null))
    rest = F.map_filter("base", lambda k, v: ~k.isin("top_element_points", "chip_plays_json"))
    return each.select("path", "pos", F.to_variant_object(F.map_concat(rest, made)).alias("record"))


def given(value: str) -> Column:
    """Whether a VARIANT is there and no JSON null."""
    return F.col(value).isNotNull() & ~F.is_variant_null(value)


def histories(df: DataFrame, keep: tuple[str, ...] = ("path", "player")) -> DataFrame:
    """Records of a player's history with the columns ``keep``; an empty or missing one gives none."""
    return items(df, "document", "$.history", list(keep))


def chip_view(events: DataFrame) -> DataFrame:
    """Events with the chips as a typed array."""
    return events.withColumn("chip_plays", F.from_json("chip_plays_json", "array<struct<chip_name:string,num_played:bigint>>"))

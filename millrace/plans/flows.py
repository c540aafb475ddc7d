"""Registered queries through the ingest's own operators: JSON documents are made from the tables and go the whole way."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import audit, drift, flatten, validate
from millrace.operators.store import Store
from millrace.plans import runner
from millrace.plans.catalogue import LINE_ORDER, Query, read
from millrace.plans.contract import Contract, Table, columns, compiled
from millrace.sources import fetch
from millrace.storage import work_path
from millrace.streaming.incremental import merge_rounds

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__], ORACLE_SQL[fn.__name__] = fn, sql
        return fn

    return register


def field(name: str, kind: str = "bigint") -> Column:
    return F.try_variant_get("record", f"$.{name}", kind).alias(name)


def documents(rows: DataFrame, by: str, key: str, document: Column) -> DataFrame:
    """One JSON document for each value of ``by``, as if read from a file."""
    made = rows.groupBy(F.col(by).alias(key)).agg(F.to_json(document).alias("text"))
    return made.select(F.lit("file").alias("path"), key, F.try_parse_json("text").alias("document"))


def listed(name: str, each: Column) -> Column:
    return F.struct(F.collect_list(each).alias(name))


@query("SELECT c_custkey AS id, c_nationkey AS team FROM customer")
def flatten_core_list(spark, sf_dir):
    each = F.struct(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("team"))
    made = documents(read(spark, sf_dir, "customer"), "c_nationkey", "key", listed("elements", each))
    return flatten.bootstrap_list(made, "elements").select(field("id"), field("team"))


@query("SELECT l_linenumber::BIGINT AS element_id, l_orderkey::BIGINT AS round, CAST(l_quantity AS BIGINT) AS minutes FROM lineitem")
def flatten_live_elements(spark, sf_dir):
    stats = F.struct(F.col("l_quantity").cast("bigint").alias("minutes"))
    each = F.struct(F.col("l_linenumber").alias("id"), stats.alias("stats"))
    made = documents(read(spark, sf_dir, "lineitem"), "l_orderkey", "round", listed("elements", each))
    return flatten.live_elements(made).select(field("element_id"), field("round"), field("minutes"))


@query("""SELECT l_orderkey::BIGINT AS fixture_id, 'quantity' AS identifier, l_partkey::BIGINT AS element, CAST(l_quantity AS BIGINT) AS value, 'h' AS side FROM lineitem
UNION ALL SELECT l_orderkey, 'line', l_partkey, l_linenumber, 'a' FROM lineitem""")
def flatten_fixture_stats(spark, sf_dir):
    def fixture(line: Column) -> Column:
        entry = lambda value: F.array(F.struct(line["l_partkey"].alias("element"), value.cast("bigint").alias("value")))
        quantity = F.struct(F.lit("quantity").alias("identifier"), entry(line["l_quantity"]).alias("h"), F.slice(entry(line["l_quantity"]), 1, 0).alias("a"))
        number = F.struct(F.lit("line").alias("identifier"), F.slice(entry(line["l_linenumber"]), 1, 0).alias("h"), entry(line["l_linenumber"]).alias("a"))
        return F.struct(F.col("l_orderkey").alias("id"), F.array(quantity, number).alias("stats"))

    # lines are gathered as they are; what the document says of each is made behind the shuffle
    lines = F.collect_list(F.struct("l_partkey", "l_quantity", "l_linenumber"))
    made = documents(read(spark, sf_dir, "lineitem"), "l_orderkey", "key", F.transform(lines, fixture))
    return flatten.fixture_stats(made).select(field("fixture_id"), field("identifier", "string"), field("element"), field("value"), field("side", "string"))


@query("""SELECT o_orderkey::BIGINT AS id, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END::BIGINT AS top_element_points,
    CASE WHEN o_orderstatus = 'F' THEN '[{"chip_name":"F","num_played":1}]' END AS chip_plays_json FROM orders""")
def flatten_season_events(spark, sf_dir):
    top = F.when(F.expr("o_orderkey % 2 = 0"), F.struct(F.col("o_custkey").alias("points")))
    chip = F.array(F.struct(F.col("o_orderstatus").alias("chip_name"), F.lit(1).alias("num_played")))
    each = F.struct(F.col("o_orderkey").alias("id"), top.alias("top_element_info"), F.when(F.col("o_orderstatus") == "F", chip).otherwise(F.slice(chip, 1, 0)).alias("chip_plays"))
    made = documents(read(spark, sf_dir, "orders"), "o_custkey", "key", listed("events", each))
    return flatten.season_events(made).select(field("id"), field("top_element_points"), field("chip_plays_json", "string"))


@query("SELECT user_id::BIGINT AS player, event_id::BIGINT AS round, CAST(round(value) AS BIGINT) AS minutes FROM events")
def flatten_histories(spark, sf_dir):
    each = F.struct(F.col("event_id").alias("round"), F.round("value").cast("bigint").alias("minutes"))
    made = documents(read(spark, sf_dir, "events"), "user_id", "player", listed("history", each))
    return flatten.histories(made).select(F.col("player").cast("bigint").alias("player"), field("round"), field("minutes"))


@query("""SELECT event_id, array_to_string(list_filter([CASE WHEN event_id % 7 = 0 THEN 'unknown: odd' END, CASE WHEN event_id % 5 = 0 THEN 'element: missing' END,
    CASE WHEN event_id % 11 = 0 THEN 'value: not int' END, CASE WHEN event_id % 13 = 0 THEN 'side: null' END], lambda x: x IS NOT NULL), '; ') AS reasons FROM events""")
def validate_records(spark, sf_dir):
    """Rows through the contract of a table: what is missing, null, unknown or of another type."""
    parts = F.create_map(
        F.lit("fixture_id"), F.col("event_id").cast("string"), F.lit("identifier"), F.to_json(F.struct(F.lit("x"))).substr(9, 3),
        F.lit("value"), F.when(F.expr("event_id % 11 = 0"), F.lit('"x"')).otherwise(F.lit('"7.0"')),
        F.lit("side"), F.when(F.expr("event_id % 13 = 0"), F.lit("null")).otherwise(F.lit('"h"')),
        F.lit("element"), F.when(F.expr("event_id % 5 <> 0"), F.col("user_id").cast("string")), F.lit("odd"), F.when(F.expr("event_id % 7 = 0"), F.lit("1")),
    )
    pairs = F.transform(F.map_entries(F.map_filter(parts, lambda k, v: v.isNotNull())), lambda e: F.concat(F.lit('"'), e["key"], F.lit('":'), e["value"]))
    text = F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}"))
    rows = read(spark, sf_dir, "events").select("event_id", F.try_parse_json(text).alias("record"))
    return validate.checked(rows, compiled()["fixture_stats"]).select("event_id", F.array_join("_errors", "; ").alias("reasons"))


def lines_as_stats(lines: DataFrame) -> DataFrame:
    return lines.select(
        F.col("l_orderkey").cast("bigint").alias("fixture_id"), F.lit("q").alias("identifier"), F.col("l_linenumber").cast("bigint").alias("element"),
        F.col("l_quantity").cast("bigint").alias("value"), F.lit("h").alias("side"), F.lit("t").alias("ingested_at"), "l_shipdate", "l_partkey", "l_extendedprice", "l_suppkey",
    )


SEQUENCE = ["l_shipdate", "l_partkey", "l_extendedprice", "l_suppkey"]


@query(f"""WITH l AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER}) AS n FROM lineitem)
SELECT l_orderkey::BIGINT AS fixture_id, l_linenumber::BIGINT AS element, CASE WHEN l_orderkey % 3 = 0 THEN -1 ELSE CAST(l_quantity AS BIGINT) END AS value,
    CASE WHEN l_orderkey % 3 = 0 THEN 'a' ELSE 'h' END AS side FROM l WHERE n = 1""")
def store_upsert(spark, sf_dir):
    """Two merges into a stored table: the last by sequence wins within one, the later merge over the earlier."""
    store = Store(spark, work_path(spark, "store"))
    rows = lines_as_stats(read(spark, sf_dir, "lineitem"))
    store.upsert("fixture_stats", rows, SEQUENCE)
    store.upsert("fixture_stats", rows.where("fixture_id % 3 = 0").withColumn("value", F.lit(-1).cast("bigint")).withColumn("side", F.lit("a")), SEQUENCE)
    return store.read("fixture_stats").select("fixture_id", "element", "value", "side")


@query("""SELECT event_type AS stage, count(*)::BIGINT AS fetched, count(*) FILTER (value >= 10)::BIGINT AS validated, count(*) FILTER (value >= 10)::BIGINT AS written,
    count(*) FILTER (NOT value >= 10)::BIGINT AS skipped, 0::BIGINT AS errors, CASE WHEN (SELECT count(*) FROM events WHERE NOT value >= 10) > 0 THEN 'FAILED_PARTIAL' ELSE 'SUCCESS' END AS status
FROM events GROUP BY event_type""")
def store_run_audit(spark, sf_dir):
    """Counters of stages recorded, summed to a status, and the status written back to all of the run."""
    store = Store(spark, work_path(spark, "store"))
    counted = validate.counts(read(spark, sf_dir, "events"), F.col("value") >= 10, "event_type").orderBy("event_type")
    for row in counted.collect():  # one row a stage
        store.record_stage("now", validate.Tally.of(row["event_type"], row, written=row["validated"]))
    store.finalize("now", metadata={"n_stages": "all"})
    return store.read("_runs").select("stage", "fetched", "validated", "written", "skipped", "errors", "status")


@query("SELECT 'n_orders' AS key, count(*)::VARCHAR AS value FROM orders UNION ALL SELECT 'n_events', count(*)::VARCHAR FROM events")
def store_metadata(spark, sf_dir):
    """Keys written twice: the last value stays."""
    store = Store(spark, work_path(spark, "store"))
    store.set_metadata({"n_orders": "old", "n_events": "old"})
    store.set_metadata({f"n_{t}": str(read(spark, sf_dir, t).count()) for t in ("orders", "events")})
    return audit.latest_metadata(store.read("_metadata")).select("key", "value")


@query("""SELECT * FROM (VALUES ('missing column', 'fixture_stats.side'), ('extra column', 'fixture_stats.more'), ('type', 'fixture_stats.value'),
    ('constraint', 'fixture_stats.element: nullable'), ('constraint', 'fixture_stats.key'), ('constraint', 'fixture_stats: layout')) t(kind, what)
WHERE what <> 'fixture_stats.key' UNION ALL SELECT 'constraint', 'fixture_stats: key'""")
def store_drift(spark, sf_dir):
    """A table that an older contract wrote against today's: what its files and declarations differ in."""
    now = compiled()["fixture_stats"]
    old = replace(now, columns=columns("fixture_id:int identifier:str element:int? value:str more:str?"), key=("fixture_id", "identifier"), cluster_by=())
    store = Store(spark, work_path(spark, "store"), Contract((old,)))
    rows = lines_as_stats(read(spark, sf_dir, "lineitem")).withColumn("value", F.col("value").cast("string")).withColumn("more", F.lit("x"))
    store.upsert("fixture_stats", rows, SEQUENCE)
    report = Store(spark, store.root, Contract((now,))).validate()
    kinds = {"missing column": report.missing_columns, "extra column": report.extra_columns, "type": report.type_mismatches, "constraint": report.constraint_mismatches}
    return spark.createDataFrame([(kind, what) for kind, found in kinds.items() for what in found], "kind string, what string")


@query("""SELECT o_orderkey AS round FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 4 <> 0
UNION SELECT min(o_orderkey) FROM orders WHERE o_orderstatus = 'P'""")
def select_rounds(spark, sf_dir):
    """Finished rounds that haven't landed, and the current one."""
    orders = read(spark, sf_dir, "orders")
    flags = orders.select(F.col("o_orderkey").alias("id"), (F.col("o_orderstatus") == "F").cast("int").alias("finished"), (F.col("o_orderstatus") == "P").cast("int").alias("is_current"))
    return runner.rounds_to_read(flags, orders.where("o_orderkey % 4 = 0").select(F.col("o_orderkey").alias("round")))


@query("SELECT c_custkey AS player, c_custkey IN (SELECT o_custkey FROM orders) AS cached FROM customer")
def select_players(spark, sf_dir):
    ids = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("player"))
    cached, uncached = runner.players_by_cache(ids, read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("player")))
    return cached.withColumn("cached", F.lit(True)).union(uncached.withColumn("cached", F.lit(False)))


def records(rows: DataFrame, keep: list[str], fields: dict[str, Column]) -> DataFrame:
    """``keep`` and a VARIANT record of the fields; a null field is lacking, one of ``"null"`` is an explicit null."""
    pairs = F.concat_ws(",", *[F.concat(F.lit(f'"{k}":'), v) for k, v in fields.items()])  # passes over nulls
    return rows.select(*keep, F.parse_json(F.concat(F.lit("{"), pairs, F.lit("}"))).alias("record"))


def text(value: Column) -> Column:
    return F.concat(F.lit('"'), value, F.lit('"'))


DEFAULTS = Table("t", columns("id:int kind:str=view score:float=1.5 seen:bool=true owner:int<user note:str?"), ("id",), "one row an event")


@query("""SELECT event_id AS id, CASE WHEN event_id % 3 = 0 THEN 'view' ELSE event_type END AS kind, CASE WHEN event_id % 4 = 0 THEN 1.5 ELSE user_id::DOUBLE END AS score,
    CASE WHEN event_id % 5 = 0 THEN 0 ELSE 1 END::BIGINT AS seen, CASE WHEN event_id % 6 = 0 THEN NULL ELSE user_id END::BIGINT AS owner, NULL::VARCHAR AS note,
    CASE WHEN event_id % 6 = 0 THEN 'owner: given twice; owner: not int' ELSE '' END AS reasons FROM events""")
def record_defaults(spark, sf_dir):
    """Missing keys take their defaults, another name stands for a column, and of two names only one may be given."""
    fields = {
        "id": F.col("event_id").cast("string"), "kind": F.when(F.expr("event_id % 3 <> 0"), text(F.col("event_type"))), "score": F.when(F.expr("event_id % 4 <> 0"), F.col("user_id").cast("string")),
        "seen": F.when(F.expr("event_id % 5 = 0"), F.lit('"off"')), "user": F.when(F.expr("event_id % 6 <> 0 or event_id % 2 = 0"), F.col("user_id").cast("string")),
        "owner": F.when(F.expr("event_id % 6 = 0"), F.lit('"nobody"')),
    }
    found = validate.checked(records(read(spark, sf_dir, "events"), [], fields), DEFAULTS)
    return found.select("id", "kind", "score", "seen", "owner", "note", F.array_join(F.array_sort("_errors"), "; ").alias("reasons"))


@query("""WITH c AS (SELECT count(*) AS n, count(*) FILTER (l_orderkey % 7 = 0 AND l_linenumber = 1) AS bad, count(*) FILTER (l_orderkey % 11 = 0) AS odd,
    count(*) FILTER (l_orderkey % 7 = 0 AND l_linenumber = 1 OR l_orderkey % 11 = 0) AS either, count(DISTINCT (l_orderkey, l_linenumber)) FILTER (NOT (l_orderkey % 7 = 0 AND l_linenumber = 1 OR l_orderkey % 11 = 0)) AS keys FROM lineitem)
SELECT unnest(['fetched', 'validated', 'written', 'skipped', 'stored', 'value: not int', 'unknown: odd']) AS what, unnest([n, n - either, n - either, either, keys, bad, odd])::BIGINT AS n FROM c""")
def store_records(spark, sf_dir):
    """Records validated and merged in one query: the counters, the rows stored, and how often each reason set a record aside."""
    store = Store(spark, work_path(spark, "store"))
    own = read(spark, sf_dir, "lineitem").withColumn("bad", F.expr("l_orderkey % 7 = 0 and l_linenumber = 1"))
    fields = {
        "fixture_id": F.col("l_orderkey").cast("string"), "identifier": F.lit('"q"'), "element": F.col("l_linenumber").cast("string"), "side": F.lit('"h"'),
        "value": F.when(F.col("bad"), F.lit('"many"')).otherwise(F.col("l_quantity").cast("bigint").cast("string")), "odd": F.when(F.expr("l_orderkey % 11 = 0"), F.lit("1")),
    }
    tally, aside = store.upsert_records("fixture_stats", records(own, SEQUENCE, fields), SEQUENCE)
    counted = {"fetched": tally.fetched, "validated": tally.validated, "written": tally.written, "skipped": tally.skipped}
    reasons = aside.select(F.explode("_errors").alias("what")).groupBy("what").agg(F.count("*").alias("n"))
    stored = store.read("fixture_stats").agg(F.count("*").alias("n")).select(F.lit("stored").alias("what"), "n")
    return spark.createDataFrame(list(counted.items()), "what string, n bigint").union(stored).union(reasons)


@query(f"""WITH l AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER}) AS n FROM lineitem)
SELECT l_orderkey::BIGINT AS fixture_id, CAST(l_quantity AS BIGINT) AS value FROM l WHERE n = 1 AND l_linenumber = 2 AND l_quantity >= 30""")
def store_where(spark, sf_dir):
    """Rows of one layout value from a store of several buckets: parts that can't hold them stay closed."""
    store = Store(spark, work_path(spark, "store"), bucket_rows=20_000)
    store.upsert("fixture_stats", lines_as_stats(read(spark, sf_dir, "lineitem")), SEQUENCE)
    return store.where("fixture_stats", element=2, value=(30, None)).select("fixture_id", "value")


@query(f"""WITH l AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER}) AS n FROM lineitem)
SELECT l_linenumber::BIGINT AS element, count(*)::BIGINT AS n, sum(CAST(l_quantity AS BIGINT))::BIGINT AS total FROM l WHERE n = 1 GROUP BY l_linenumber""")
def store_published(spark, sf_dir):
    """A stored table registered in the catalogue and read by SQL there."""
    root, database = work_path(spark, "store"), f"millrace_{uuid.uuid4().hex}"
    store = Store(spark, root, bucket_rows=50_000)
    store.upsert("fixture_stats", lines_as_stats(read(spark, sf_dir, "lineitem")), SEQUENCE)
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/catalogue'")
    store.publish(database)
    return spark.sql(f"SELECT element, count(*) AS n, sum(value) AS total FROM {database}.fixture_stats GROUP BY element")


@query("""SELECT event_type AS started_at, count(*)::BIGINT AS fetched, count(*) FILTER (value >= 10)::BIGINT AS validated, count(*) FILTER (value >= 10)::BIGINT AS written,
    count(*) FILTER (NOT value >= 10)::BIGINT AS skipped, 0::BIGINT AS errors, CASE WHEN count(*) FILTER (NOT value >= 10) > 0 THEN 'FAILED_PARTIAL' ELSE 'SUCCESS' END AS status FROM events GROUP BY event_type""")
def store_run_totals(spark, sf_dir):
    """Several runs of three stages each, appended to the log and summed by run."""
    store = Store(spark, work_path(spark, "store"))
    own = read(spark, sf_dir, "events").withColumn("stage", F.expr("user_id % 3"))
    for r in validate.counts(own, F.col("value") >= 10, "event_type", "stage").orderBy("event_type", "stage").collect():  # three rows a type
        store.record_stage(r["event_type"], validate.Tally.of(str(r["stage"]), r, written=r["validated"]))
    return audit.totals(store.read("_runs"))


WATCHED = Table("orders", columns("o_orderkey:int o_custkey:int o_totalprice:str o_clerk:str? o_note:str?"), ("o_orderkey",), "one row an order")


@query("""SELECT unnest(['o_orderkey', 'o_custkey', 'o_totalprice', 'o_clerk', 'o_note']) AS column_name, unnest(['int', 'int', 'str', 'str', 'str']) AS expected,
    unnest([0, count(*) FILTER (o_orderstatus = 'P'), 0, 0, count(*)])::BIGINT AS n_missing, unnest([0, count(*) FILTER (o_orderstatus = 'F'), 0, 0, 0])::BIGINT AS n_null,
    unnest([0, 0, count(*) FILTER (o_orderkey % 2 = 0), 0, 0])::BIGINT AS n_other, unnest(['BIGINT', 'BIGINT', 'BIGINT,STRING', 'STRING', '']) AS types FROM orders""")
def observed_drift(spark, sf_dir):
    """What the records of a table hold against a contract that has one column too many and one of another type."""
    status = F.col("o_orderstatus")
    fields = {
        "o_orderkey": F.col("o_orderkey").cast("string"), "o_custkey": F.when(status == "F", F.lit("null")).when(status != "P", F.col("o_custkey").cast("string")),
        "o_totalprice": F.when(F.expr("o_orderkey % 2 = 0"), F.col("o_totalprice").cast("bigint").cast("string")).otherwise(F.lit('"dear"')), "o_clerk": text(F.col("o_orderpriority")),
    }
    return drift.observed(records(read(spark, sf_dir, "orders"), [], fields), WATCHED)


@query("SELECT user_id % 38 AS round, count(DISTINCT event_id % 500)::BIGINT AS players FROM events GROUP BY 1")
def players_by_round(spark, sf_dir):
    own = read(spark, sf_dir, "events").selectExpr("user_id % 38 as round", "event_id % 500 as element_id")
    return audit.players_by_round(own)


@query("""SELECT run_id, started_at, stage, fetched, validated, validated AS written, skipped, 0::BIGINT AS errors, NULL::VARCHAR AS status FROM
(SELECT user_id AS run_id, 'then' AS started_at, event_type AS stage, count(*)::BIGINT AS fetched, count(*) FILTER (value >= 10)::BIGINT AS validated, count(*) FILTER (NOT value >= 10)::BIGINT AS skipped FROM events GROUP BY ALL)""")
def runs_of_older_layout(spark, sf_dir):
    """Run rows with the former single counter, as today's log shows them."""
    old = validate.counts(read(spark, sf_dir, "events"), F.col("value") >= 10, "user_id", "event_type").withColumnsRenamed({"user_id": "run_id", "event_type": "stage", "validated": "upserted"})
    old = old.withColumn("started_at", F.lit("then")).withColumn("errors", F.lit(0).cast("bigint"))
    return audit.migrated_runs(old).select("run_id", "started_at", "stage", "fetched", "validated", "written", "skipped", "errors", "status")


@query("""SELECT o_orderkey::BIGINT AS element_id, o_custkey::BIGINT AS round, (CASE WHEN o_custkey % 3 = 0 THEN 1000 ELSE 0 END + o_orderkey % 97)::BIGINT AS minutes FROM orders""")
def stream_versions(spark, sf_dir):
    """Rounds fetched twice, streamed after each fetch: bodies of all customers, then corrected ones of a third of them."""
    raw, store = work_path(spark, "raw"), Store(spark, work_path(spark, "store"))
    own, checkpoint = read(spark, sf_dir, "orders"), work_path(spark, "stream")
    for more, stamp in ((0, "2024-01-01T00:00:00+00:00"), (1000, "2024-01-02T00:00:00+00:00")):
        rows = own.where("o_custkey % 3 = 0") if more else own
        minutes = (F.expr("o_orderkey % 97") + more).cast("bigint").alias("minutes")
        each = F.struct(F.col("o_orderkey").alias("id"), F.struct(minutes).alias("stats"))
        bodies = rows.groupBy(F.col("o_custkey").cast("string").alias("id")).agg(F.to_json(listed("elements", each)).alias("body"))
        shape = [F.lit("live").alias("endpoint"), "id", F.lit(200).alias("status"), "body", F.lit(stamp).alias("fetched_at")]
        bodies.select(*shape).write.parquet(f"{fetch.folder(raw, 'live')}/{stamp[:10]}")
        merge_rounds(spark, store, raw, checkpoint).awaitTermination()
    return store.read("gameweeks").select("element_id", "round", "minutes")

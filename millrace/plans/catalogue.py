"""Registered queries and the SQL that each is held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from millrace.functions import coerce, scalars
from millrace.operators import audit, drift, merge, select, validate

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    """Registers a query under its function's name, with the SQL that gives the same rows."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__], ORACLE_SQL[fn.__name__] = fn, sql
        return fn

    return register


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (order, line) kept, joined to its order: lines and quantity by order status."""
    lines = merge.latest(read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], F.desc("l_shipdate"), F.desc("l_partkey"), F.desc("l_extendedprice"), F.desc("l_suppkey"))
    orders = read(spark, sf_dir, "orders")
    return (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .groupBy("o_orderstatus")
        .agg(F.count("*").alias("n_lines"), F.round(F.sum("l_quantity"), 2).alias("quantity"))
    )


LINE_ORDER = "l_shipdate DESC, l_partkey DESC, l_extendedprice DESC, l_suppkey DESC"
QUERIES["grain_join_rollup"] = flagship
ORACLE_SQL["grain_join_rollup"] = f"""
WITH l AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER}) AS n FROM lineitem)
SELECT o_orderstatus, count(*)::BIGINT AS n_lines, round(sum(l_quantity), 2) AS quantity
FROM l JOIN orders ON l_orderkey = o_orderkey WHERE n = 1 GROUP BY o_orderstatus"""


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 45")
def scan_project_filter(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem")
    return lines.where("l_returnflag = 'R' and l_quantity >= 45").select("l_orderkey", "l_linenumber", "l_quantity")


@query("SELECT * EXCLUDE (l_shipdate) FROM lineitem")
def prefix_drop_project(spark, sf_dir):
    return select.drop_prefix(read(spark, sf_dir, "lineitem"), "l_ship")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_extract(spark, sf_dir):
    return read(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, len(json_keys(props))::BIGINT AS n_keys FROM events")
def variant_unpack(spark, sf_dir):
    own = read(spark, sf_dir, "events").withColumn("v", F.try_parse_json("props"))
    k = F.expr(coerce.to_bigint("try_variant_get(v, '$.k', 'variant')"))
    return own.select("event_id", k.alias("k"), F.size(F.json_object_keys("props")).cast("bigint").alias("n_keys"))


@query("""SELECT vec_id, (i - 1)::BIGINT AS pos, round(embedding[i]::DOUBLE, 6) AS component
FROM embeddings, unnest(range(1, len(embedding) + 1)) t(i)""")
def array_explode(spark, sf_dir):
    own = read(spark, sf_dir, "embeddings")
    each = own.select("vec_id", F.posexplode("embedding").alias("pos", "x"))
    return each.select("vec_id", F.col("pos").cast("bigint").alias("pos"), F.round(F.col("x").cast("double"), 6).alias("component"))


@query("""SELECT l_orderkey, l_linenumber, 'h' AS side, l_discount AS rate FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'a', l_tax FROM lineitem""")
def unpivot_sides(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem")
    return select.sides(lines, ["l_orderkey", "l_linenumber"], {"h": "l_discount", "a": "l_tax"}, value="rate")


@query("SELECT l_orderkey, count(*)::BIGINT AS n_items, min(l_partkey) AS first_part FROM lineitem GROUP BY l_orderkey")
def nest_to_json(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem")
    nested = lines.groupBy("l_orderkey").agg(F.to_json(F.sort_array(F.collect_list(F.struct("l_partkey", "l_linenumber")))).alias("items"))
    size = F.json_array_length("items").cast("bigint")
    return nested.select("l_orderkey", size.alias("n_items"), F.get_json_object("items", "$[0].l_partkey").cast("bigint").alias("first_part"))


@query("""WITH v AS (SELECT event_id, value AS x, CASE WHEN event_id % 3 = 0 THEN CAST(CAST(round(value) AS BIGINT) AS VARCHAR)
        WHEN event_id % 3 = 1 THEN CAST(CAST(round(value) AS BIGINT) AS VARCHAR) || '.0' ELSE 'x' END AS raw FROM events)
SELECT event_id, raw, TRY_CAST(CASE WHEN TRY_CAST(raw AS DOUBLE) = floor(TRY_CAST(raw AS DOUBLE)) THEN TRY_CAST(raw AS DOUBLE) END AS BIGINT) AS coerced FROM v""")
def lax_cast_validate(spark, sf_dir):
    whole = F.round("value").cast("bigint").cast("string")
    raw = F.when(F.expr("event_id % 3 = 0"), whole).when(F.expr("event_id % 3 = 1"), F.concat(whole, F.lit(".0"))).otherwise("x")
    own = read(spark, sf_dir, "events").select("event_id", raw.alias("raw"))
    return own.withColumn("coerced", F.expr(coerce.integral("raw")))


@query("""SELECT event_type, count(*)::BIGINT AS fetched, count(*) FILTER (value >= 10)::BIGINT AS validated,
    count(*) FILTER (NOT value >= 10)::BIGINT AS skipped FROM events GROUP BY event_type""")
def validate_counts(spark, sf_dir):
    return validate.counts(read(spark, sf_dir, "events"), F.col("value") >= 10, "event_type")


@query("""SELECT event_id FROM events WHERE len(list_filter(json_keys(CASE WHEN event_id % 7 = 0 THEN '{"k": 1, "extra": 2}' ELSE props END), lambda k: k <> 'k')) > 0""")
def unknown_key_reject(spark, sf_dir):
    raw = F.when(F.expr("event_id % 7 = 0"), F.lit('{"k": 1, "extra": 2}')).otherwise(F.col("props"))
    own = read(spark, sf_dir, "events").select("event_id", raw.alias("raw"))
    return own.where(F.size(F.expr(validate.unknown_keys("json_object_keys(raw)", ["k"]))) > 0).select("event_id")


@query("SELECT event_id, coalesce(CASE WHEN event_id % 5 <> 0 THEN value END, 0.0) AS filled FROM events")
def default_fill(spark, sf_dir):
    missing = F.when(F.expr("event_id % 5 <> 0"), F.col("value"))
    return read(spark, sf_dir, "events").select("event_id", F.coalesce(missing, F.lit(0.0)).alias("filled"))


@query("""SELECT l_linenumber, CASE l_linenumber WHEN 1 THEN 'GKP' WHEN 2 THEN 'DEF' WHEN 3 THEN 'MID' WHEN 4 THEN 'FWD' ELSE 'UNK' END AS label,
    count(*)::BIGINT AS n FROM lineitem GROUP BY 1, 2""")
def position_lookup(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").groupBy("l_linenumber").agg(F.count("*").alias("n"))
    return lines.select("l_linenumber", scalars.position(F.col("l_linenumber")).alias("label"), "n")


@query("SELECT p_partkey, round(p_retailprice / 10.0, 4) AS cost FROM part")
def cost_scale(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_partkey", F.round(scalars.cost_in_millions(F.col("p_retailprice")), 4).alias("cost"))


@query("""SELECT p_partkey, coalesce(nullif(CASE WHEN p_partkey % 4 = 0 THEN '' ELSE p_name END, ''), p_brand || ' ' || p_type) AS name FROM part""")
def display_name(spark, sf_dir):
    short = F.when(F.expr("p_partkey % 4 = 0"), F.lit("")).otherwise(F.col("p_name"))
    return read(spark, sf_dir, "part").select("p_partkey", scalars.display_name(short, F.col("p_brand"), F.col("p_type")).alias("name"))


CHANGED = "SELECT o_orderkey, o_custkey, 'X' AS o_orderstatus, o_totalprice + 1 AS o_totalprice, {seq} AS seq FROM orders WHERE o_orderkey % 3 = 0 OR o_orderkey < 50"


def changed_orders(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    new = orders.where("o_orderkey % 3 = 0 or o_orderkey < 50").withColumn("o_orderstatus", F.lit("X")).withColumn("o_totalprice", F.col("o_totalprice") + 1)
    moved = new.where("o_orderkey < 50").withColumn("o_orderkey", F.col("o_orderkey") + 10_000_000)
    again = new.where("o_orderkey < 30").withColumn("o_orderstatus", F.lit("Y"))
    parts = [new.withColumn("seq", F.lit(1)), again.withColumn("seq", F.lit(2)), moved.withColumn("seq", F.lit(3))]
    return orders, parts[0].unionByName(parts[1]).unionByName(parts[2])


INCOMING = f"""new AS ({CHANGED.format(seq=1)}),
incoming AS (SELECT * FROM new UNION ALL SELECT o_orderkey, o_custkey, 'Y', o_totalprice, 2 FROM new WHERE o_orderkey < 30
    UNION ALL SELECT o_orderkey + 10000000, o_custkey, o_orderstatus, o_totalprice, 3 FROM new WHERE o_orderkey < 50)"""


@query(f"""WITH {INCOMING}, everything AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, 0 AS seq FROM orders UNION ALL SELECT * FROM incoming)
SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 2) AS o_totalprice FROM
(SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY seq DESC) AS n FROM everything) WHERE n = 1""")
def upsert_last_wins(spark, sf_dir):
    orders, incoming = changed_orders(spark, sf_dir)
    return merge.upsert(orders, incoming, ["o_orderkey"], ["seq"]).withColumn("o_totalprice", F.round("o_totalprice", 2))


@query(f"""WITH {INCOMING} SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 2) AS o_totalprice FROM orders
UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 2) FROM
(SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY seq) AS n FROM incoming WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders)) WHERE n = 1""")
def insert_or_ignore(spark, sf_dir):
    orders, incoming = changed_orders(spark, sf_dir)
    return merge.insert_or_ignore(orders, incoming, ["o_orderkey"], ["seq"]).withColumn("o_totalprice", F.round("o_totalprice", 2))


@query(f"""SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM
(SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER}) AS n FROM lineitem) WHERE n = 1""")
def dedupe_by_grain(spark, sf_dir):
    order = [F.desc(c) for c in ("l_shipdate", "l_partkey", "l_extendedprice", "l_suppkey")]
    return merge.latest(read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], *order).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query("SELECT l_orderkey, l_linenumber, count(*)::BIGINT AS rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def repeated_keys(spark, sf_dir):
    return merge.repeated_keys(read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""SELECT c_custkey FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')
UNION SELECT c_custkey FROM customer WHERE c_nationkey = 1""")
def incremental_anti(spark, sf_dir):
    done = read(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    wanted = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return select.pending(wanted, done, ["c_custkey"], F.col("c_nationkey") == 1).select("c_custkey")


@query("SELECT c_custkey, c_name FROM customer c WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)")
def cached_semi(spark, sf_dir):
    done = read(spark, sf_dir, "orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return select.already_done(read(spark, sf_dir, "customer").select("c_custkey", "c_name"), done, ["c_custkey"])


@query("""SELECT user_id, coalesce(min(event_id) FILTER (event_type = 'purchase' AND value > 60), min(event_id) FILTER (event_type = 'signup') - 1, max(event_id) FILTER (event_type = 'view')) AS current_round
FROM events GROUP BY user_id""")
def current_round(spark, sf_dir):
    own = read(spark, sf_dir, "events")
    at = F.min(F.when(F.expr("event_type = 'purchase' and value > 60"), F.col("event_id")))
    before = F.min(F.when(F.expr("event_type = 'signup'"), F.col("event_id"))) - 1
    last = F.max(F.when(F.expr("event_type = 'view'"), F.col("event_id")))
    return own.groupBy("user_id").agg(F.coalesce(at, before, last).alias("current_round"))


@query("""SELECT coalesce(min(event_id) FILTER (event_type = 'purchase' AND value > 1e9), min(event_id) FILTER (event_type = 'signup') - 1, max(event_id) FILTER (event_type = 'view')) AS current_round FROM events""")
def resolve_current(spark, sf_dir):
    own = read(spark, sf_dir, "events").selectExpr("event_id", "event_type = 'purchase' and value > 1e9 as c", "event_type = 'signup' as n", "event_type = 'view' as f")
    return select.current_round(own, "event_id", "c", "n", "f")


@query("""SELECT o_orderkey, c_name, n_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE o_totalprice > 450000""")
def join_inner(spark, sf_dir):
    o, c, n = (read(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    return o.where("o_totalprice > 450000").join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey).select("o_orderkey", "c_name", "n_name")


@query("""SELECT c_custkey, count(o_orderkey)::BIGINT AS n_orders FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey""")
def join_left(spark, sf_dir):
    o, c = read(spark, sf_dir, "orders"), read(spark, sf_dir, "customer")
    return c.join(o, o.o_custkey == c.c_custkey, "left").groupBy("c_custkey").agg(F.count("o_orderkey").alias("n_orders"))


@query("""SELECT s_suppkey, p_partkey FROM supplier FULL JOIN part ON s_suppkey = p_partkey""")
def join_full(spark, sf_dir):
    s, p = read(spark, sf_dir, "supplier"), read(spark, sf_dir, "part")
    return s.join(p, s.s_suppkey == p.p_partkey, "full").select("s_suppkey", "p_partkey")


@query("SELECT CAST(date_trunc('day', ts) AS DATE)::VARCHAR AS day, count(DISTINCT user_id)::BIGINT AS users FROM events GROUP BY 1")
def count_distinct_by_round(spark, sf_dir):
    day = F.date_format("ts", "yyyy-MM-dd").alias("day")
    return read(spark, sf_dir, "events").groupBy(day).agg(F.count_distinct("user_id").alias("users"))


@query("""SELECT 'orders' AS table_name, count(*)::BIGINT AS n FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem
UNION ALL SELECT 'events', count(*) FROM events UNION ALL SELECT 'customer', count(*) FROM customer""")
def table_counts_union(spark, sf_dir):
    return audit.table_counts({t: read(spark, sf_dir, t) for t in ("orders", "lineitem", "events", "customer")})


@query("""SELECT event_type, count(*) FILTER (value < 10)::BIGINT AS skipped, count(*)::BIGINT AS fetched, round(100.0 * count(*) FILTER (value < 10) / nullif(count(*), 0), 1)::DOUBLE AS pct
FROM events GROUP BY event_type HAVING count(*) FILTER (value < 10) > 0""")
def skip_pct(spark, sf_dir):
    own = read(spark, sf_dir, "events").groupBy("event_type").agg(F.count_if(F.expr("value < 10")).alias("skipped"), F.count("*").alias("fetched"))
    return own.where("skipped > 0").withColumn("pct", scalars.skip_percent(F.col("skipped"), F.col("fetched")).cast("double"))


@query("""SELECT day, fetched, errors, skipped, CASE WHEN errors > 0 THEN 'FAILED' WHEN skipped > 0 THEN 'FAILED_PARTIAL' ELSE 'SUCCESS' END AS status FROM
(SELECT CAST(date_trunc('hour', ts) AS VARCHAR) AS day, count(*)::BIGINT AS fetched, count(*) FILTER (event_type = 'error' AND value > 20)::BIGINT AS errors,
count(*) FILTER (value < 5)::BIGINT AS skipped FROM events GROUP BY 1)""")
def run_totals_status(spark, sf_dir):
    hour = F.date_format("ts", "yyyy-MM-dd HH:00:00").alias("day")
    own = read(spark, sf_dir, "events").groupBy(hour).agg(
        F.count("*").alias("fetched"), F.count_if(F.expr("event_type = 'error' and value > 20")).alias("errors"), F.count_if(F.expr("value < 5")).alias("skipped")
    )
    return own.withColumn("status", select.status(F.lit(False), F.col("errors"), F.col("skipped")))


@query("""SELECT event_type, user_id % 5 AS stage, count(*)::BIGINT AS fetched, count(*) FILTER (value >= 10)::BIGINT AS validated
FROM events GROUP BY ROLLUP (event_type, user_id % 5)""")
def stage_rollup(spark, sf_dir):
    own = read(spark, sf_dir, "events").withColumn("stage", F.expr("user_id % 5"))
    return own.rollup("event_type", "stage").agg(F.count("*").alias("fetched"), F.count_if(F.expr("value >= 10")).alias("validated"))


@query("SELECT event_id, user_id, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 5")
def recent_top_k(spark, sf_dir):
    return read(spark, sf_dir, "events").orderBy(F.desc("ts"), F.desc("event_id")).limit(5).select("event_id", "user_id", "event_type")


@query("SELECT c_nationkey AS k FROM customer EXCEPT ALL SELECT s_nationkey FROM supplier")
def set_difference(spark, sf_dir):
    return read(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k")).exceptAll(read(spark, sf_dir, "supplier").select("s_nationkey"))


WANTED = [("orders", "o_orderkey", "BIGINT"), ("orders", "o_custkey", "BIGINT"), ("orders", "o_note", "STRING"), ("orders", "o_orderstatus", "BIGINT"), ("nation", "n_name", "STRING")]


@query("""WITH wanted(table_name, column_name, type) AS (VALUES ('orders', 'o_orderkey', 'BIGINT'), ('orders', 'o_custkey', 'BIGINT'), ('orders', 'o_note', 'STRING'), ('orders', 'o_orderstatus', 'BIGINT'), ('nation', 'n_name', 'STRING')),
live(table_name, column_name, type) AS (VALUES ('orders', 'o_orderkey', 'BIGINT'), ('orders', 'o_custkey', 'BIGINT'), ('orders', 'o_orderstatus', 'STRING'), ('orders', 'o_totalprice', 'DOUBLE'),
    ('orders', 'o_orderdate', 'TIMESTAMP_NTZ'), ('orders', 'o_orderpriority', 'STRING'), ('nation', 'n_nationkey', 'INT'), ('nation', 'n_name', 'STRING'), ('nation', 'n_regionkey', 'INT'))
SELECT coalesce(w.table_name, l.table_name) AS table_name, coalesce(w.column_name, l.column_name) AS column_name,
    CASE WHEN l.column_name IS NULL THEN 'missing' WHEN w.column_name IS NULL THEN 'extra' ELSE 'type' END AS kind, w.type AS expected, l.type AS actual
FROM wanted w FULL JOIN live l USING (table_name, column_name) WHERE w.type IS DISTINCT FROM l.type""")
def schema_drift_report(spark, sf_dir):
    live = {t: read(spark, sf_dir, t).schema for t in ("orders", "nation")}
    return drift.column_report(spark, WANTED, live)


@query("""SELECT user_id, CAST(date_trunc('day', ts) AS DATE)::VARCHAR AS day, count(*)::BIGINT AS n_events, round(sum(value), 2) AS total
FROM events GROUP BY 1, 2""")
def player_round_fact(spark, sf_dir):
    day = F.date_format("ts", "yyyy-MM-dd").alias("day")
    return read(spark, sf_dir, "events").groupBy("user_id", day).agg(F.count("*").alias("n_events"), F.round(F.sum("value"), 2).alias("total"))


@query("SELECT o_orderkey, o_orderstatus, dense_rank() OVER (PARTITION BY o_orderstatus ORDER BY o_orderpriority)::BIGINT AS r FROM orders")
def ranked_window(spark, sf_dir):
    order = W.Window.partitionBy("o_orderstatus").orderBy("o_orderpriority")
    return read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.dense_rank().over(order).cast("bigint").alias("r"))


@query("""WITH RECURSIVE r(n) AS (SELECT 0::BIGINT UNION ALL SELECT n + 1 FROM r WHERE n < 4)
SELECT n, count(o_orderkey)::BIGINT AS n_orders FROM r LEFT JOIN orders ON o_orderkey % 5 = n GROUP BY n""")
def sql_passthrough(spark, sf_dir):
    from millrace.plans.sql import Session

    own = Session(spark, {"orders": read(spark, sf_dir, "orders")})
    return own.query("SELECT n.id AS n, count(o_orderkey) AS n_orders FROM range(5) n LEFT JOIN orders ON o_orderkey % ? = n.id GROUP BY n.id", [5])

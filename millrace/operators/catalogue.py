"""Stored tables in Spark's catalogue: created, widened and pointed at their folders by SQL, and read back."""

from __future__ import annotations

from pyspark.sql import SparkSession

from millrace.operators.buckets import BUCKET
from millrace.operators.drift import LiveTable
from millrace.plans.contract import Contract, Table


def registered(spark: SparkSession, database: str, table: Table, parts: dict[str, str], location: str) -> list[str]:
    """Makes ``table`` of ``database`` show the folders ``parts`` (by bucket); returns the statements run."""
    ran = []

    def run(sql: str) -> None:
        ran.append(sql)
        spark.sql(sql)

    name = f"{database}.{table.name}"
    if not spark.catalog.tableExists(name):
        run(table.create_sql(database, BUCKET, location))
    held = {f.name for f in spark.table(name).schema}
    for c in table.column_names:
        if c not in held:
            run(table.add_column_sql(database, c))
    old = {r["partition"].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    new = {f"b{b}": path for b, path in parts.items()}
    gone = [f"PARTITION ({BUCKET} = '{b}')" for b in sorted(old - new.keys())]
    if gone:
        run(f"ALTER TABLE {name} DROP IF EXISTS {', '.join(gone)}")
    added = [f"PARTITION ({BUCKET} = '{b}') LOCATION '{path}'" for b, path in sorted(new.items()) if b not in old]
    if added:
        run(f"ALTER TABLE {name} ADD {' '.join(added)}")
    for b in sorted(old & new.keys()):
        run(f"ALTER TABLE {name} PARTITION ({BUCKET} = '{b}') SET LOCATION '{new[b]}'")
    spark.catalog.refreshTable(name)
    return ran


def tables(spark: SparkSession, database: str, contract: Contract) -> dict[str, LiveTable]:
    """What the catalogue says of the contract's tables in ``database``, without the partition column."""
    found = {}
    for t in contract.tables:
        name = f"{database}.{t.name}"
        if spark.catalog.tableExists(name):
            schema = spark.table(name).schema
            properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
            listed = lambda key: tuple(x for x in properties.get(f"millrace.{key}", "").split(",") if x)  # noqa: B023, E731
            schema.fields = [f for f in schema.fields if f.name != BUCKET]
            schema.names = [f.name for f in schema.fields]
            for f in schema.fields:  # file tables call every column nullable, so that is a property too
                f.nullable = f.name not in listed("not_null")
            found[t.name] = LiveTable(schema, listed("key"), listed("cluster_by"))
    return found

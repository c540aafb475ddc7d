"""The SQL surface: any query over the registered tables, with positional parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class Session:
    """Tables under their names for its own queries alone: views of the caller with these names stay as they were."""

    def __init__(self, spark: SparkSession, tables: dict[str, DataFrame]):
        self.spark = spark
        self.tables = tables

    def query(self, sql: str, params: list | None = None) -> DataFrame:
        """``sql`` over the tables; ``?`` takes the parameters in order. The result stays a DataFrame.

        The names are resolved when the query is analysed, so they are needed no longer than this call.
        """
        views = {t.name for t in self.spark.catalog.listTables() if t.isTemporary}
        before = {name: self.spark.table(name) for name in self.tables if name in views}
        for name, df in self.tables.items():
            df.createOrReplaceTempView(name)
        try:
            return self.spark.sql(sql, args=params) if params else self.spark.sql(sql)
        finally:
            for name in self.tables:
                self.spark.catalog.dropTempView(name)
            for name, df in before.items():
                df.createOrReplaceTempView(name)

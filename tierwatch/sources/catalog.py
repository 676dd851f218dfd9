"""Inventories of tables and functions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F


def count_tables(tables: Mapping[tuple[str, str], DataFrame]) -> DataFrame:
    """Row count per (schema, table), ordered."""
    counts = [df.agg(F.count("*").alias("row_count"))
              .select(F.lit(schema).alias("table_schema"), F.lit(name).alias("table_name"), "row_count")
              for (schema, name), df in sorted(tables.items())]
    return reduce(DataFrame.unionByName, counts).orderBy("table_schema", "table_name")


def table_inventory(spark: SparkSession, schemas: Sequence[str]) -> DataFrame:
    """Row counts of the stored tables of some schemas, views left out."""
    found = {(schema, t.name): spark.table(f"`{schema}`.`{t.name}`")
             for schema in schemas for t in spark.catalog.listTables(schema)
             if t.tableType in ("MANAGED", "EXTERNAL")}
    if not found:
        return spark.createDataFrame([], "table_schema string, table_name string, row_count long")
    return count_tables(found)


def function_inventory(spark: SparkSession, schema: str) -> DataFrame:
    """User functions of a schema."""
    names = [(schema, f.name) for f in spark.catalog.listFunctions(schema)
             if not (f.className or "").startswith("org.apache.spark.sql.catalyst.")]
    return spark.createDataFrame(names, "function_schema string, function_name string").orderBy("function_name")


def create_schema(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{name}`")


def drop_schema(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP SCHEMA IF EXISTS `{name}` CASCADE")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")

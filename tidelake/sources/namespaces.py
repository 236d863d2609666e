"""Namespace and table housekeeping in the session catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def ensure_namespace(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {name}")


def drop_namespace(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP NAMESPACE IF EXISTS {name}")


def list_tables(spark: SparkSession, namespace: str) -> DataFrame:
    """Tables and views of a namespace. ``SHOW TABLES`` also names the session's temporary views, which belong to none."""
    return spark.sql(f"SHOW TABLES IN {namespace}").filter("NOT isTemporary")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def describe(spark: SparkSession, name: str) -> DataFrame:
    """Columns of a table, without the partition section Spark appends."""
    rows = spark.sql(f"DESCRIBE {name}")
    return rows.filter(~rows.col_name.startswith("#") & (rows.col_name != "")).distinct()

"""Raw layer: batch files added to the trips table."""

from __future__ import annotations

import posixpath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake import schemas
from tidelake.functions.trips import audit_ts
from tidelake.sources import tables
from tidelake.sources.files import read_trips


def to_bronze(raw: DataFrame, as_of: Column | str | None = None) -> DataFrame:
    return raw.withColumn("bronze_ingestion_ts", audit_ts(as_of))


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """All trips loaded so far; columns that a batch added are NULL in the others."""
    return tables.read(spark, path, merge=True).drop(tables.BATCH)


def read_batch(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The trips of one load; no file of another one is opened. Columns that the batch lacks are NULL."""
    return tables.read(spark, path, tables.batched(schemas.BRONZE_TRIPS)).filter(F.col(tables.BATCH) == key).drop(tables.BATCH)


def batch_key(csv_path: str, landing: str | None = None) -> str:
    """The file's path below the landing folder, or its whole path: equal names in other folders are other batches."""
    path = csv_path.rstrip("/")
    return posixpath.relpath(path, landing.rstrip("/")) if landing else path


def ingest_trips(
    spark: SparkSession, path: str, csv_path: str, as_of: Column | str | None = None, landing: str | None = None
) -> str | None:
    """Add one batch file as one partition; returns its key.

    A batch that is there already is not read again, and None is returned. A load that died is repeated
    over its own partition. Rows are taken as they come, also those without a trip id; ``missing_trip_ids``
    counts them.
    """
    key = batch_key(csv_path, landing)
    if tables.has_batch(spark, path, key):
        return None
    tables.put_batch(to_bronze(read_trips(spark, csv_path), as_of), path, key)
    return key


def missing_trip_ids(trips: DataFrame) -> DataFrame:
    return trips.agg(F.count_if(F.col("trip_id").isNull()).alias("missing_trip_ids"))


def batch_summary(trips: DataFrame, distinct: str | None = None, first_seen: str | None = None) -> DataFrame:
    """Rows and date range per batch file.

    ``distinct`` adds how many different values a column has, ``first_seen`` the
    earliest load time. Distinct values are collapsed per (batch, value) before
    they meet, so one giant batch does not end in one task.
    """
    columns = [
        F.count(F.lit(1)).alias("rows"),
        F.min("trip_date").alias("first_date"),
        F.max("trip_date").alias("last_date"),
    ]
    if distinct:
        columns.append(F.count_distinct(distinct).alias(f"distinct_{distinct}"))
    if first_seen:
        columns.append(F.min(first_seen).alias("first_ingested"))
    return trips.groupBy("source_file").agg(*columns).orderBy("source_file")

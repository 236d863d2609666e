"""CSV scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidelake import schemas


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """UTF-8 CSV with a header line.

    With a schema there is no inference pass over the data; without one the types are inferred, which only the catalog checks
    want. Columns are found by the names in the header, in whatever order they stand there; others are left
    out, a missing one is an error, and so is a file of the same folder with another header.
    """
    reader = spark.read.option("header", "true").option("encoding", "UTF-8")
    if schema is None:
        return reader.option("inferSchema", "true").csv(path)
    header = reader.csv(path).columns
    missing = [name for name in schema.names if name not in header]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    known = {f.name: f for f in schema.fields}
    found = T.StructType([known.get(name, T.StructField(name, T.StringType())) for name in header])
    return reader.option("enforceSchema", "false").schema(found).csv(path).select(*schema.names)


def read_trips(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.TRIPS_CSV)


def read_stops(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.STOPS)


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.STATIONS)

"""Tables as plain Parquet folders, written by Spark's own committers.

A table that grows is partitioned by ``batch``: a batch overwrites its own partition only, so writing it again, after a failure
or by mistake, leaves the same rows. Tables that are refreshed as a whole are those of ``refreshed``.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

BATCH = "batch"


def exists(spark: SparkSession, path: str) -> bool:
    """Is there a folder? A job that died before its first commit leaves one without files: empty, if read with a schema."""
    try:
        spark.read.schema("_ string").parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def read(spark: SparkSession, path: str, schema: StructType | None = None, merge: bool = False) -> DataFrame:
    """The rows of a table. With a schema an absent table is empty, and a column that older files lack is NULL.

    ``merge`` finds the union of all files' columns instead, which reads every footer.
    """
    if schema is None:
        return spark.read.option("mergeSchema", str(merge).lower()).parquet(path)
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def batched(schema: StructType) -> StructType:
    """The schema of a growing table of such rows."""
    return StructType([*schema.fields, StructField(BATCH, StringType())])


def put_batch(df: DataFrame, path: str, key: str) -> None:
    """Write the rows of one batch, in place of what the table may hold of it. ``key`` is not empty.

    The files of the batch appear with the commit of the job, so a job that dies leaves the table as it was.
    """
    if not key:
        raise ValueError("a batch needs a key")
    rows = df.withColumn(BATCH, F.lit(key))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(path)


def has_batch(spark: SparkSession, path: str, key: str) -> bool:
    """Is the batch there, with at least one row? Other partitions are not opened."""
    if not exists(spark, path):
        return False
    found = spark.read.schema(StructType([StructField(BATCH, StringType())])).parquet(path)
    return not found.filter(F.col(BATCH) == key).isEmpty()


def batch_keys(spark: SparkSession, path: str) -> set[str]:
    """Keys of all batches with a row: partition names and file footers are read, no column."""
    if not exists(spark, path):
        return set()
    keys = spark.read.schema(StructType([StructField(BATCH, StringType())])).parquet(path).select(BATCH).distinct()
    return {r[0] for r in keys.collect()}


def schema_diff(older: DataFrame, newer: DataFrame) -> DataFrame:
    """Columns that one of two tables has and the other has not, or has with another type."""
    spark = newer.sparkSession
    sides = [
        spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in df.schema.fields], f"column string, {name} string")
        for name, df in (("older", older), ("newer", newer))
    ]
    return sides[0].join(sides[1], "column", "full").filter(~F.col("older").eqNullSafe(F.col("newer")))

"""Tables that are refreshed as a whole: a refresh lies in a folder of its own, and readers take the newest complete one.

Spark marks a folder when its job has committed (``_SUCCESS``), so that mark is the switch: a refresh that dies, or is still
running, is not seen, and the rows before it stay readable. A refresh may read the table that it refreshes. Where a catalog is
configured, ``publish`` points a view at the newest folder, for readers that know names only.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_MARK = "_SUCCESS"
_FOLDER = re.compile(r"refresh=([0-9]{12})-[0-9a-f]{8}")


def files_of(spark: SparkSession, path: str):
    """The file system of a path, and the path, as Hadoop knows them: the store may be one that only Spark reaches."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def _refreshes(spark: SparkSession, path: str) -> list[tuple[int, str, bool]]:
    """Number, folder and completeness of every refresh, oldest first."""
    store, root = files_of(spark, path)
    if not store.exists(root):
        return []
    names = [status.getPath().getName() for status in store.listStatus(root)]
    folders = sorted((int(m[1]), m[0]) for name in names if (m := _FOLDER.fullmatch(name)))
    return [(n, f"{path}/{name}", store.exists(files_of(spark, f"{path}/{name}/{_MARK}")[1])) for n, name in folders]


def current(spark: SparkSession, path: str) -> str | None:
    """The folder of the newest complete refresh, or None if there is none."""
    return next((folder for _, folder, complete in reversed(_refreshes(spark, path)) if complete), None)


def exists(spark: SparkSession, path: str) -> bool:
    return current(spark, path) is not None


def read(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The rows of the newest complete refresh. With a schema, a table that was never built is empty; else it is an error."""
    folder = current(spark, path)
    if folder is None:
        if schema is None:
            raise FileNotFoundError(f"no complete refresh of {path}")
        return spark.createDataFrame([], schema)
    return (spark.read.schema(schema) if schema else spark.read).parquet(folder)


def replace(df: DataFrame, path: str, keep: int = 1, partition_by: Sequence[str] = (), options: dict[str, str] | None = None) -> str:
    """Write ``df`` as the new content of the table; returns its folder.

    Folders older than the last ``keep`` complete refreshes before this one go, so that reads under way when the table
    switches can end. Refreshes that died go with them. One refresh of a table is to run at a time.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    before = _refreshes(spark, path)
    number = 1 + max((n for n, *_ in before), default=0)
    folder = f"{path}/refresh={number:012d}-{uuid.uuid4().hex[:8]}"
    writer = df.write.options(**(options or {}))
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(folder)
    store, mark = files_of(spark, f"{folder}/{_MARK}")
    if not store.exists(mark):
        raise RuntimeError("refreshed tables need mapreduce.fileoutputcommitter.marksuccessfuljobs")
    complete = [f for _, f, done in before if done]
    kept = set(complete[-keep:] if keep else [])
    for _, old, _ in before:
        if old not in kept:
            store.delete(files_of(spark, old)[1], True)
    return folder


def publish(spark: SparkSession, name: str, path: str) -> None:
    """Point the view ``name`` at the newest complete refresh, in one statement of the catalog; columns may have changed."""
    folder = current(spark, path)
    if folder is None:
        raise FileNotFoundError(f"no complete refresh of {path}")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{folder}`")

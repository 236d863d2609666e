"""Tables that a stream adds to: its micro-batches as they come, and a base into which earlier ones are merged.

A micro-batch is a partition of its own, named by query and number, so a replay writes over itself. ``merge`` moves what is there
into a new base, without expired rows, and then removes the merged partitions. The base is a refreshed table: it
appears as a whole, and holds for each query the number up to which its batches are merged. Readers leave out the partitions that the
base has, so a merge that dies at any point, and a batch that is replayed after it was merged, change nothing. A batch that is
written meanwhile is a partition that the merge has not listed, and stays. Files are as many as batches since the last merge.

The base is clustered: rows lie in folders by a hash of their key, sorted by it, with Bloom filters. A lookup by key
opens the files of one folder and reads the row groups that may hold the key.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, StringType, IntegerType, BooleanType

from tidelake.sources import refreshed, tables

_NAME = re.compile(r"(.*)-([0-9]+)")
#: Folders of a base by key, and parts into which the rows of one folder are written where one key has most of them.
FOLDERS, PARTS = 16, 4
_FOLDER, _MARK = "_folder", "_mark"


def put(batch: DataFrame, path: str, key: str) -> None:
    """Write the rows of one micro-batch, in place of what the table may hold of it. ``key`` ends in a hyphen and its number."""
    if not _NAME.fullmatch(key):
        raise ValueError(f"{key!r} does not end in the number of a batch")
    tables.put_batch(batch, f"{path}/fresh", key)


def exists(spark: SparkSession, path: str) -> bool:
    return bool(_fresh(spark, path)) or refreshed.exists(spark, f"{path}/base")


def _fresh(spark: SparkSession, path: str) -> list[str]:
    """Keys of the micro-batches that lie beside the base, from one listing."""
    store, folder = refreshed.files_of(spark, f"{path}/fresh")
    if not store.exists(folder):
        return []
    names = [status.getPath().getName() for status in store.listStatus(folder)]
    return sorted(name.removeprefix(f"{tables.BATCH}=") for name in names if name.startswith(f"{tables.BATCH}="))


def _stored(schema: StructType) -> StructType:
    """Rows of a base: those of the table, their batch, a mark, and their folder."""
    return StructType([*tables.batched(schema).fields, StructField(_MARK, BooleanType()), StructField(_FOLDER, IntegerType())])


def _marks(spark: SparkSession, path: str) -> dict[str, int]:
    """Of each query the number up to which its batches are in the base: one row a query."""
    base = refreshed.current(spark, f"{path}/base")
    if base is None:
        return {}
    rows = spark.read.schema(StructType([StructField(tables.BATCH, StringType()), StructField(_FOLDER, IntegerType())])).parquet(base)
    marks = [_NAME.fullmatch(r[0]) for r in rows.filter(F.col(_FOLDER) == -1).select(tables.BATCH).collect()]
    return {m[1]: int(m[2]) for m in marks}


def _merged(key: str, marks: dict[str, int]) -> bool:
    query, number = _NAME.fullmatch(key).groups()
    return int(number) <= marks.get(query, -1)


def _folder_of(key: Column, folders: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(folders)).cast("int")


def _batches(spark: SparkSession, path: str, schema: StructType, keys: list[str]) -> DataFrame:
    folders = [f"{path}/fresh/{tables.BATCH}={key}" for key in keys]
    return spark.read.schema(tables.batched(schema)).option("basePath", f"{path}/fresh").parquet(*folders)


def _rows(spark: SparkSession, path: str, schema: StructType, keys: list[str], folder: int | None = None) -> DataFrame:
    """Base and the named batches beside it, with their batch."""
    names = tables.batched(schema).names
    base = refreshed.current(spark, f"{path}/base")
    parts = [_batches(spark, path, schema, keys)] if keys else []
    if base is not None:
        held = spark.read.schema(_stored(schema)).parquet(base)
        parts.append(held.filter(F.col(_FOLDER) >= 0 if folder is None else F.col(_FOLDER) == folder).select(*names))
    if not parts:
        return spark.createDataFrame([], tables.batched(schema))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def rows(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Every row of the table, each once. A table that no stream has written yet is empty; reading never creates one."""
    marks = _marks(spark, path)
    keys = [key for key in _fresh(spark, path) if not _merged(key, marks)]
    return _rows(spark, path, schema, keys).drop(tables.BATCH)


def lookup(spark: SparkSession, path: str, schema: StructType, key: str, value: str, folders: int = FOLDERS) -> DataFrame:
    """The rows of one key: of the base, one folder, and of that the row groups whose Bloom filter may hold the key.

    ``key`` and ``folders`` are those of the merges.
    """
    marks = _marks(spark, path)
    keys = [k for k in _fresh(spark, path) if not _merged(k, marks)]
    folder = spark.range(1).select(_folder_of(F.lit(value), folders)).first()[0]
    return _rows(spark, path, schema, keys, folder).filter(F.col(key) == value).drop(tables.BATCH)


def merge(
    spark: SparkSession, path: str, schema: StructType, key: str, alive: Column | None = None, folders: int = FOLDERS, expected: int = 100_000
) -> int:
    """Merge the batches that are there into a new base without the rows that are not ``alive``; returns how many batches went.

    It may run beside the stream, one merge of a table at a time. The merged rows are written again, so the cost is that of the
    living rows, whatever was written before. An absent table stays absent. ``expected`` distinct keys size the filters.
    """
    found, marks = _fresh(spark, path), _marks(spark, path)
    if not found and (not marks or alive is None):
        return 0
    fresh = [k for k in found if not _merged(k, marks)]
    kept = _rows(spark, path, schema, fresh)
    kept = kept if alive is None else kept.filter(F.coalesce(alive, F.lit(True)))
    for k in fresh:
        query, number = _NAME.fullmatch(k).groups()
        marks[query] = max(int(number), marks.get(query, -1))
    done = spark.createDataFrame([(f"{q}-{n}",) for q, n in marks.items()], f"{tables.BATCH} string")
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    marked = done.coalesce(1).select(*blank, tables.BATCH, F.lit(True).alias(_MARK), F.lit(-1).alias(_FOLDER))
    held = kept.withColumn(_MARK, F.lit(False)).withColumn(_FOLDER, F.coalesce(_folder_of(F.col(key), folders), F.lit(0)))
    # A key that has most of the rows is written by several tasks, so its folder has that many files.
    spread = held.repartition(folders, _FOLDER, F.pmod(F.xxhash64(*schema.names), F.lit(PARTS)))
    both = spread.sortWithinPartitions(_FOLDER, key).unionByName(marked)
    options = {f"parquet.bloom.filter.enabled#{key}": "true", f"parquet.bloom.filter.expected.ndv#{key}": str(expected)}
    refreshed.replace(both, f"{path}/base", partition_by=[_FOLDER], options=options)
    for k in found:
        store, folder = refreshed.files_of(spark, f"{path}/fresh/{tables.BATCH}={k}")
        store.delete(folder, True)
    return len(found)

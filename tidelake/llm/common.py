"""Helpers shared by the text operators."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.session import scratch, shared_root

#: Six white-space bytes separate words everywhere in this subpackage; ``bytes.split()`` splits at the same six.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

#: Rows of a table whose rows are a few numbers wide; below it, the table may be broadcast (some tens of MB).
MAX_BROADCAST_ROWS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a whole table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and keep it in the shared checkpoint folder, so that lost executors cost no rerun."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(df.sparkSession))
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and read it back from files in the shared folder, for steps that repeat.

    A settled table keeps its planned size, which joins multiply: where each round joins what the last one joined, that number
    soon has more digits than the driver can hold. Files have the size they have.
    """
    path = scratch(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(settled: DataFrame) -> DataFrame:
    """A hint to broadcast a settled table of narrow rows, only if its counted rows are within the bound.

    Beyond the bound the planner shuffles both sides, and adaptive execution splits skewed keys.
    """
    return F.broadcast(settled) if settled.count() <= MAX_BROADCAST_ROWS else settled


def word_count(text: Column) -> Column:
    """Number of words; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hex_digest(ids_or_bytes: bytes) -> str:
    return hashlib.sha256(ids_or_bytes).hexdigest()


def texts_of(column: pa.Array) -> list[str]:
    """Python strings of an Arrow string column, nulls as empty."""
    return [x or "" for x in column.to_pylist()]


def bytes_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of an Arrow string column, nulls as empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def slices(batches: Iterable[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the texts of each hold about ``most`` bytes (one text may be longer)."""
    for batch in batches:
        at, size = 0, 0
        column_at = batch.schema.get_field_index(column)
        sizes = pa.compute.binary_length(batch.column(column_at)).to_pylist()
        for i, n in enumerate(sizes):
            if size and size + (n or 0) > most:
                yield batch.slice(at, i - at)
                at, size = i, 0
            size += n or 0
        if at < batch.num_rows:
            yield batch.slice(at)
